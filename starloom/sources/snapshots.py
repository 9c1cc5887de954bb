"""Readers of landed snapshots. Schemas are declared, so no read costs an inference pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.text import doubled_backslashes
from starloom.sources.arrays import is_flat, read_array
from starloom.specs import SOURCES, WAREHOUSE
from starloom.storage import snapshot_path

LAYOUTS = ("lines", "array")


def read_json(
    spark: SparkSession, path: str | Sequence[str], schema: str, layout: str = "lines", raw_escapes: bool = False
) -> DataFrame:
    """JSON records; a malformed record fails the read.

    `lines`: one record, or one array of records, per line; files split over tasks. `array`: one array
    per file, over any number of lines; files split over tasks too, unless records hold other records, when a file is
    one task.
    `raw_escapes` keeps every backslash as a literal character, as older snapshots were read.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    if layout == "array" and is_flat(schema):
        return read_array(spark, path, schema, raw_escapes)
    if not raw_escapes:
        return spark.read.schema(schema).json(path, multiLine=layout == "array", mode="FAILFAST")
    text = spark.read.text(path, wholetext=layout == "array").where(F.trim("value") != "")
    records = F.from_json(doubled_backslashes(F.col("value")), f"array<struct<{schema}>>", {"mode": "FAILFAST"})
    return text.select(F.inline(records))


def read_csv(
    spark: SparkSession, path: str | Sequence[str], schema: str, index: str | None = None
) -> DataFrame:
    """CSV with a header. `index` names a leading column to leave out, such as a row number."""
    columns = f"`{index}` STRING, {schema}" if index else schema
    df = spark.read.schema(columns).csv(path, header=True, mode="FAILFAST", enforceSchema=True)
    return df.drop(index) if index else df


def read_parquet(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None, schema: str | None = None
) -> DataFrame:
    """Parquet with the columns in declared order, the key first. A given schema saves reading a footer."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(*([path] if isinstance(path, str) else path))
    return df.select(*columns) if columns else df


def read_landed(spark: SparkSession, zone: str, batch: str, table: str, **options) -> DataFrame:
    """An operational table as landed by one extract."""
    return read_json(spark, snapshot_path(zone, batch, table), SOURCES[table], **options)


def read_processed(spark: SparkSession, zone: str, batch: str, table: str) -> DataFrame:
    """A star-schema table as written by one transform."""
    return read_parquet(spark, snapshot_path(zone, batch, table), schema=WAREHOUSE[table].processed_ddl)
