"""Extracts of what has changed, and the merge that keeps a whole snapshot up to date.

Every complete extract keeps a watermark per table: the newest change that it has seen. The next one lands rows from the
watermark on, those at the very moment of it once more, as others may have been written in that moment after it was
read. The merge replaces rows by key, so landing a row twice changes nothing.

The merged zone has the layout of a landed zone, one whole snapshot a batch, so the other stages work from it as they do
from a full extract.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.sinks.snapshots import (
    complete_batches,
    read_manifest,
    write_batch,
    write_landed,
    write_log,
)
from starloom.sources.snapshots import read_json
from starloom.sources.tables import Source, latest_per_key
from starloom.specs import SOURCES
from starloom.storage import exists, snapshot_path, watermark_path

#: The column that tells when a row was last changed.
CHANGED = "last_updated"
WATERMARK = "table_name STRING, watermark STRING"
LANDED = "_landed"


def watermarks(spark: SparkSession, zone: str, before: str | None = None) -> dict[str, str]:
    """The newest change seen per table, as text, by the last complete extract (before a batch)."""
    for batch in reversed(complete_batches(spark, zone)):
        path = watermark_path(zone, batch)
        if (before is None or batch < before) and exists(spark, path):
            rows = spark.read.schema(WATERMARK).json(path).collect()
            return {r.table_name: r.watermark for r in rows if r.watermark is not None}
    return {}


def changes(df: DataFrame, watermark: str | None, column: str = CHANGED) -> DataFrame:
    """Rows changed at the watermark or after it, and rows that do not tell. All rows where there is no watermark."""
    if watermark is None or column not in df.columns:
        return df
    mark = F.lit(watermark).cast(df.schema[column].dataType)
    return df.where((F.col(column) >= mark) | F.col(column).isNull())


def extract_changes(
    spark: SparkSession, source: Source, zone: str, batch: str, at: datetime, tables: Iterable[str] | None = None
) -> DataFrame:
    """Land what has changed in every table since the last complete extract of the zone. Returns the manifest.

    The new watermarks are the greatest values that the writes themselves see; they are stored before the manifest, so
    a complete batch always has them. A table that lands nothing keeps its watermark. Tables without the column are landed
    whole. Rows that were deleted at the source are not seen; land a full extract into a new zone for these.
    """
    names = list(tables or source.tables())
    known = watermarks(spark, zone, before=batch)
    seen: dict[str, Observation] = {}

    def build(name: str) -> DataFrame:
        df = changes(source.read(name), known.get(name))
        if CHANGED not in df.columns:
            return df
        seen[name] = Observation()
        return df.observe(seen[name], F.max(CHANGED).cast("string").alias("watermark"))

    def seal(_: list) -> None:
        found = {name: watch.get["watermark"] for name, watch in seen.items()}
        rows = [(name, found.get(name) or known.get(name)) for name in names]
        marks = spark.createDataFrame(rows, WATERMARK).coalesce(1)
        marks.write.mode("overwrite").option("ignoreNullFields", "false").json(watermark_path(zone, batch))

    manifest = write_batch(spark, zone, batch, {n: lambda n=n: build(n) for n in names}, write_landed, at, seal)
    write_log(manifest, zone, at)
    return manifest


def merged(before: DataFrame, landed: DataFrame, key: str, column: str = CHANGED) -> DataFrame:
    """`before` with every row of `landed` in place of the one with its key, or added.

    Of versions of a key the one changed last stays; where two were changed in the same moment, the landed one. Rows that
    no landed key touches only pass an anti join with the landed keys. A null key is no key: such rows stay
    side by side, one of each kind.
    """
    keyed = landed.where(F.col(key).isNotNull())
    keys = keyed.select(key).distinct()
    untouched = before.join(keys, key, "left_anti")
    rivals = before.join(keys, key, "left_semi").withColumn(LANDED, F.lit(0))
    newest = latest_per_key(rivals.unionByName(keyed.withColumn(LANDED, F.lit(1))), [key], column, LANDED).drop(LANDED)
    keyless = before.where(F.col(key).isNull()).unionByName(landed.where(F.col(key).isNull())).distinct()
    return untouched.where(F.col(key).isNotNull()).unionByName(newest).unionByName(keyless).select(*before.columns)


def merge_changes(
    spark: SparkSession, landed_zone: str, merged_zone: str, batch: str, at: datetime, keys: Mapping[str, str] | None = None,
    schemas: Mapping[str, str] | None = None,
) -> DataFrame:
    """Bring the whole snapshot before up to date with a landed batch, as a batch of the merged zone. Returns its manifest.

    A table is merged by its key: the one in `keys`, or the first declared column. Tables that were not landed are
    carried over; without a batch before, what was landed is the snapshot. Batches are merged in their order: one whose
    landed predecessor has not been merged yet is refused, as its changes would be lost.
    """
    schemas = {**SOURCES, **(schemas or {})}
    done = [b for b in complete_batches(spark, merged_zone) if b < batch]
    missed = [b for b in complete_batches(spark, landed_zone) if (not done or b > done[-1]) and b < batch]
    if missed:
        raise ValueError(f"batches {missed} were landed before {batch} and are not merged yet")
    landed = {r.table_name for r in read_manifest(spark, landed_zone, batch).collect()}
    earlier = {r.table_name for r in read_manifest(spark, merged_zone, done[-1]).collect()} if done else set()

    def build(name: str) -> DataFrame:
        schema = schemas[name]
        new = read_json(spark, snapshot_path(landed_zone, batch, name), schema) if name in landed else None
        old = read_json(spark, snapshot_path(merged_zone, done[-1], name), schema) if name in earlier else None
        if new is None or old is None:
            return old if new is None else new
        if CHANGED not in new.columns:
            return new
        return merged(old, new, (keys or {}).get(name) or new.columns[0])

    tables = {name: lambda name=name: build(name) for name in sorted(landed | earlier)}
    return write_batch(spark, merged_zone, batch, tables, write_landed, at)


