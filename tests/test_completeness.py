"""Batches released by a stream when all their tables are reported."""

import random
from datetime import datetime, timedelta

import pytest

from starloom.streaming import completeness
from starloom.streaming.completeness import complete_batches, verdicts

SCHEMA = "batch_id STRING, table_name STRING, written_at TIMESTAMP"
TABLES = ["design", "sales_order", "staff"]
NOON = datetime(2024, 1, 1, 12)


def run(spark, tmp_path, files, query=verdicts, within="1 HOUR", more=()):
    """The rows of a stream that reads a file a trigger; `more` files come after a restart."""
    reports, out = f"{tmp_path}/reports", f"{tmp_path}/out"

    def pass_(some):
        for rows in some:
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(reports)
        arriving = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(reports)
        stream = (
            query(arriving, TABLES, within)
            .writeStream.option("checkpointLocation", f"{tmp_path}/progress")
            .trigger(availableNow=True)
            .start(out, format="parquet")
        )
        stream.awaitTermination()
        if stream.exception():
            raise stream.exception()

    pass_(files)
    if more:
        pass_(more)
    return sorted(tuple(r) for r in spark.read.parquet(out).collect())


def report(batch, table, minutes=0):
    return (batch, table, NOON + timedelta(minutes=minutes))


def test_each_batch_once_whatever_the_order(spark, tmp_path):
    each = [report(b, t, random.Random(b + t).randrange(30)) for b in ("b1", "b2", "b3") for t in TABLES]
    each.remove(next(r for r in each if r[:2] == ("b3", "staff")))
    shuffled = each * 2
    random.Random(5).shuffle(shuffled)
    files = [shuffled[i::3] for i in range(3)]
    assert run(spark, tmp_path, files, complete_batches, more=[each[:4]]) == [("b1",), ("b2",)]


def test_a_batch_that_lacks_a_table_is_given_up(spark, tmp_path):
    files = [
        [report("b0", "staff"), report("b1", "design"), report("b1", "staff", 5), report("b2", "design", 1)],
        [report("b2", "staff", 50), report("b2", "sales_order", 55)],
        # Time passes; what comes late then changes nothing.
        [report("b3", "design", 300)],
        [report("b1", "sales_order", 6), report("b3", "staff", 301)],
        [report("b3", "sales_order", 302)],
    ]
    given_up = ("b0", False, ["design", "sales_order"])
    assert run(spark, tmp_path, files) == [given_up, ("b1", False, ["sales_order"]), ("b2", True, []), ("b3", True, [])]


def test_nulls_and_other_tables_are_no_reports(spark, tmp_path):
    rows = [report("b1", t) for t in TABLES[:2]] + [report("b1", None), report(None, "staff"), report("b1", "log")]
    rows.append(("b1", "staff", None))
    assert run(spark, tmp_path, [rows], complete_batches) == []
    assert run(spark, tmp_path, [[report("b1", "staff", 1)]], complete_batches) == [("b1",)]


def test_no_tables_are_refused(spark):
    with pytest.raises(ValueError, match="without tables"):
        verdicts(spark.createDataFrame([], SCHEMA), [], "1 HOUR")


def test_batches_that_share_a_shard_keep_their_own_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(completeness, "SHARDS", 1)
    files = [
        [report("b0", "staff"), report("b1", "design"), report("b2", "design", 50), report("b2", "staff", 51)],
        [report("b2", "sales_order", 55), report("b3", "design", 55)],
        [report("b4", "design", 130)],
        # Past the hour of b0 and b1 only: b3, in the same shard, is still open and then completed.
        [report("b3", "staff", 131), report("b3", "sales_order", 132), report("b1", "staff", 6)],
    ]
    given_up = [("b0", False, ["design", "sales_order"]), ("b1", False, ["sales_order", "staff"])]
    assert run(spark, tmp_path, files) == [*given_up, ("b2", True, []), ("b3", True, [])]


def test_calls_of_python_are_bounded_by_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(completeness, "SHARDS", 8)
    files = [[report(f"b{k}", t) for k in range(300)] for t in TABLES]
    assert run(spark, tmp_path, files, complete_batches) == sorted((f"b{k}",) for k in range(300))
    keys = spark.read.format("statestore").load(f"{tmp_path}/progress").count()
    assert keys <= 8


def test_more_tables_than_bits_of_a_long(spark, tmp_path):
    many = [f"t{k:03d}" for k in range(70)]
    files = [[report("b1", t) for t in many[:60]], [report("b1", t) for t in many[60:]] + [report("b2", many[69])]]
    query = lambda reports, _, within: verdicts(reports, many, within)
    assert run(spark, tmp_path, files, query) == [("b1", True, [])]
