"""Snapshots in sorted buckets of a key, which later checks, groupings and joins on that key need not shuffle.

A bucketed snapshot is a folder of Parquet files and a small description beside it. `attach` makes it a table of any
session again, as Spark takes the buckets from the table and not from the files.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from starloom.storage import exists

SPEC = "key STRING, buckets INT, schema STRING"


@dataclass(frozen=True)
class Buckets:
    """How a snapshot is divided, and its columns as DDL."""

    key: str
    buckets: int
    schema: str


def _spec_path(path: str) -> str:
    return f"{path.rstrip('/')}_buckets"


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _create(spark: SparkSession, name: str, path: str, spec: Buckets) -> None:
    at = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({spec.schema}) USING parquet CLUSTERED BY ({_quoted(spec.key)}) "
        f"SORTED BY ({_quoted(spec.key)}) INTO {spec.buckets} BUCKETS LOCATION '{at}'"
    )


def write_buckets(df: DataFrame, path: str, key: str, buckets: int, name: str) -> None:
    """Write `df` to a new folder in buckets of `key`, one sorted file each, and its description; the table `name`,
    which is used for that, is gone afterwards.

    Rows are shuffled once, the way the buckets are cut, so that each task writes one file. Tables that are joined on the
    key should have the same number of buckets. If one is a multiple of the other, Spark reads the finer table by the
    coarser one's buckets where spark.sql.bucketing.coalesceBucketsInJoin.enabled is set. All rows of a key are in one
    bucket: take keys that no large share of the rows has, such as primary keys and an order's key in its lines.
    """
    spark = df.sparkSession
    if exists(spark, path):
        raise FileExistsError(f"{path} is there; snapshots are immutable")
    spec = Buckets(key, buckets, ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields))
    _create(spark, name, path, spec)
    try:
        df.repartition(buckets, key).sortWithinPartitions(key).write.insertInto(name)
    finally:
        spark.sql(f"DROP TABLE {name}")
    spark.createDataFrame([tuple(asdict(spec).values())], SPEC).coalesce(1).write.parquet(_spec_path(path))


def spec_of(spark: SparkSession, path: str) -> Buckets:
    row = spark.read.schema(SPEC).parquet(_spec_path(path)).first()
    return Buckets(row["key"], row["buckets"], row["schema"])


@contextmanager
def attached(spark: SparkSession, paths: dict[str, str]) -> Iterator[dict[str, DataFrame]]:
    """Bucketed snapshots as tables of the session while a block runs, by name; their files stay."""
    made = []
    try:
        for name, path in paths.items():
            _create(spark, name, path, spec_of(spark, path))
            made.append(name)
        yield {name: spark.table(name) for name in paths}
    finally:
        for name in made:
            spark.sql(f"DROP TABLE {name}")
