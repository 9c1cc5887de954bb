"""Batches that are released once every table of theirs has been reported, in whatever order and however often."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Batches are kept in this many groups by a hash of their id, as every group costs a call of Python in each trigger. A
#: checkpoint holds for one number only.
SHARDS = 4096
#: What is known of the batches of a shard, in step: the tables reported so far (a bit each, as a hexadecimal number), the
#: latest moment among reports in milliseconds, and whether it was released.
STATE = "batches ARRAY<STRING>, reported ARRAY<STRING>, latest ARRAY<BIGINT>, released ARRAY<BOOLEAN>"
VERDICT = "batch_id STRING, complete BOOLEAN, missing ARRAY<STRING>"


def verdicts(reports: DataFrame, expected: Iterable[str], within: str) -> DataFrame:
    """batch_id, complete and missing (tables): one row for each batch, from a stream of batch_id, table_name, written_at.

    A batch is released, as complete, by the report of the last of its expected tables. Repeated reports, also those that
    come after, change nothing, nor do reports of other tables or with a null. A batch that lacks tables when the
    stream's time has passed its latest report by `within` is given up, as incomplete. Reports older than that are
    late and dropped. The state of a batch is a bit for each table, and is forgotten at that time. A trigger reads and
    writes the states of the shards that its reports fall into.
    """
    wanted = sorted(set(expected))
    if not wanted:
        raise ValueError("a batch without tables would never be complete")
    delay = int(reports.sparkSession.sql(f"SELECT unix_millis(timestamp_millis(0) + INTERVAL {within}) AS ms").first().ms)

    bits = {table: 1 << i for i, table in enumerate(wanted)}
    every = (1 << len(wanted)) - 1

    def judge(_shard: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = {}
        if state.exists:
            for batch, reported, latest, released in zip(*state.get, strict=True):
                known[batch] = (int(reported, 16), latest, released)
        passed = state.getCurrentWatermarkMs()
        news: dict[str, tuple[int, int]] = {}
        # A shard whose time is over comes without reports.
        for frame in () if state.hasTimedOut else frames:
            frame = frame[frame["ms"] >= passed]
            for batch, table, ms in zip(frame["batch_id"], frame["table_name"], frame["ms"].tolist(), strict=True):
                tables, latest = news.get(batch, (0, 0))
                news[batch] = (tables | bits[table], max(latest, ms))
        found = []
        # A batch whose time is over may still have a late report in this trigger.
        for batch in [b for b, (_, at, _) in known.items() if at + delay < passed or (b in news and at + delay == passed)]:
            reported, _, released = known.pop(batch)
            if not released:
                found.append((batch, False, [table for table in wanted if not reported & bits[table]]))
        for batch, (tables, ms) in news.items():
            reported, latest, released = known.get(batch, (0, 0, False))
            reported |= tables
            if not released and reported == every:
                released = True
                found.append((batch, True, []))
            known[batch] = (reported, max(latest, ms), released)
        if known:
            reported, latest, released = (list(values) for values in zip(*known.values(), strict=True))
            state.update((list(known), [f"{tables:x}" for tables in reported], latest, released))
            state.setTimeoutTimestamp(max(min(latest) + delay, passed + 1))
        elif state.exists:
            state.remove()
        if found:
            yield pd.DataFrame(found, columns=["batch_id", "complete", "missing"])

    # A null is no report.
    known = reports.where(F.col("batch_id").isNotNull() & F.col("written_at").isNotNull() & F.col("table_name").isin(wanted))
    at = F.col("written_at").cast("timestamp")
    shard = F.pmod(F.xxhash64("batch_id"), F.lit(SHARDS)).cast("int").alias("shard")
    timed = known.select(shard, "batch_id", "table_name", at.alias("at"), F.unix_millis(at).alias("ms")).withWatermark("at", within)
    return timed.groupBy("shard").applyInPandasWithState(
        judge, VERDICT, STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def complete_batches(reports: DataFrame, expected: Sequence[str], within: str) -> DataFrame:
    """batch_id of each batch when it is complete, once."""
    return verdicts(reports, expected, within).where("complete").select("batch_id")
