"""Writers of immutable snapshots and of the manifest that makes a batch visible."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import astuple, dataclass
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.functions.text import JSON_FORMAT, upload_line
from starloom.storage import children, exists, log_path, manifest_path, snapshot_key, snapshot_path

# Manifest columns and states.
MANIFEST = (
    "batch_id STRING, table_name STRING, path STRING, status STRING, row_count BIGINT, written_at TIMESTAMP_NTZ"
)
UPLOADED = "uploaded"
SKIPPED_EMPTY = "skipped_empty"

JOBS_AT_ONCE = 8
LANDED_RECORDS = 250_000


@dataclass(frozen=True)
class Written:
    batch_id: str
    table_name: str
    path: str
    status: str
    row_count: int
    written_at: datetime


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON Lines: every task writes its own file, which one array per table would not allow."""
    df.write.mode(mode).options(**JSON_FORMAT).json(path)


def write_landed(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON Lines as a batch lands them: compressed, as a batch is written and read as text, some 320 bytes an order.

    A compressed file is read by one task, so a file holds LANDED_RECORDS at most. The codec is a quick one. Spark tells it
    by the files' ending; files that others land may be plain.
    """
    options = {**JSON_FORMAT, "compression": "lz4", "maxRecordsPerFile": LANDED_RECORDS}
    df.write.mode(mode).options(**options).json(path)


def write_json_array(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One array in one file, for those who ask for that format. One task writes it, row after row; land JSON Lines
    where there is a choice."""
    n = df.count()
    if n == 0:
        df.sparkSession.range(1).select(F.lit("[]").alias("value")).coalesce(1).write.mode(mode).text(path)
        return
    place = F.monotonically_increasing_id()
    start, end = F.when(place == 0, "[").otherwise(","), F.when(place == n - 1, "]").otherwise("")
    record = F.to_json(F.struct(*df.columns), JSON_FORMAT)
    df.coalesce(1).select(F.concat(start, record, end).alias("value")).write.mode(mode).text(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write `df` and return its row count, observed by the write itself."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def each_at_once(spark: SparkSession, tasks: Iterable[Callable[[], object]]) -> list:
    """Run independent write jobs side by side, so that small tables do not queue behind large ones."""
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
        return [f.result() for f in futures]


@contextmanager
def under_way(spark: SparkSession, tasks: Mapping[str, Callable[[], object]]) -> Iterator[dict[str, Future]]:
    """Start independent jobs and give their futures by name. All have ended when the block is left."""
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        yield {name: pool.submit(inheritable_thread_target(spark)(task)) for name, task in tasks.items()}


def is_complete(spark: SparkSession, zone: str, batch: str) -> bool:
    return exists(spark, f"{manifest_path(zone, batch)}/_SUCCESS")


def require_incomplete(spark: SparkSession, zone: str, batch: str) -> None:
    if is_complete(spark, zone, batch):
        raise FileExistsError(f"batch {batch} is complete in {zone}; snapshots are immutable")


def write_batch(
    spark: SparkSession,
    zone: str,
    batch: str,
    tables: dict[str, Callable[[], DataFrame]],
    write: Callable[[DataFrame, str, str], None],
    at: datetime,
    seal: Callable[[list[Written]], object] | None = None,
) -> DataFrame:
    """Build and write every table, several at once, then the manifest of the batch, and return it.

    The manifest comes last and makes the batch complete. A complete batch is immutable; what a failed
    attempt left of an incomplete one is replaced. `seal` runs between the tables and the manifest, for what belongs
    to a complete batch.
    """
    require_incomplete(spark, zone, batch)

    def job(name: str, build: Callable[[], DataFrame]) -> Written:
        path = snapshot_path(zone, batch, name)
        rows = write_counted(build(), lambda counted: write(counted, path, "overwrite"))
        return Written(batch, name, path, UPLOADED if rows else SKIPPED_EMPTY, rows, at)

    written = each_at_once(spark, [lambda n=n, b=build: job(n, b) for n, build in tables.items()])
    if seal is not None:
        seal(written)
    manifest = manifest_of(spark, written)
    manifest.coalesce(1).write.mode("overwrite").json(manifest_path(zone, batch))
    return manifest


def manifest_of(spark: SparkSession, written: Iterable[Written]) -> DataFrame:
    return spark.createDataFrame([astuple(w) for w in written], MANIFEST)


def read_manifest(spark: SparkSession, zone: str, batch: str = "*") -> DataFrame:
    return spark.read.schema(MANIFEST).json(manifest_path(zone, batch))


def complete_batches(spark: SparkSession, zone: str) -> list[str]:
    """Ids of the complete batches of a zone, oldest first; ids sort by time."""
    folders = children(spark, manifest_path(zone, ""))
    return sorted(b for b in folders if is_complete(spark, zone, b))


def manifest_lines(manifest: DataFrame) -> DataFrame:
    """The log text of a manifest: one line per uploaded table, with the table's place inside the zone."""
    at = F.date_format("written_at", "yyyy-MM-dd HH:mm:ss")
    key = F.format_string(snapshot_key("%2$s", "%1$s", ".json"), "batch_id", "table_name")
    return manifest.where(F.col("status") == UPLOADED).select(upload_line(key, at).alias("line"))


def write_log(manifest: DataFrame, zone: str, at: datetime) -> str | None:
    """Write the log text of one batch; nothing is written when nothing was uploaded."""
    lines = manifest_lines(manifest)
    if lines.isEmpty():
        return None
    path = log_path(zone, at)
    lines.coalesce(1).write.mode("overwrite").text(path)
    return path


def batch_status(results: DataFrame, by: str, ok: Column, code: Column) -> DataFrame:
    """Per batch: did every write succeed, and which codes did the others report.

    The codes come as a list, so they must be a closed set, as the states of a manifest are. `status_counts` counts
    any codes.
    """
    return results.groupBy(by).agg(
        F.bool_and(ok).alias("all_ok"), F.sort_array(F.collect_set(F.when(~ok, code))).alias("bad_codes")
    )


def status_counts(results: DataFrame, by: str, ok: Column, code: Column) -> DataFrame:
    """Per batch: did every write succeed, and how many different codes did the others report.

    Codes are made distinct by a grouping of their own, so no task holds all codes of a batch.
    """
    each = results.groupBy(F.col(by), F.when(~ok, code).alias("_code")).agg(F.bool_and(ok).alias("_ok"))
    return each.groupBy(by).agg(F.bool_and("_ok").alias("all_ok"), F.count("_code").alias("n_bad_codes"))
