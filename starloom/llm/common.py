"""What several operators share: word pattern, reading, cutting lineage, and checked broadcasts."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import settle  # noqa: F401  (the operators take it from here)

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows that Spark sends to a Python worker at once, at most. Texts may be long, and the JVM holds twice the batch.
BATCH_ROWS = 1000

#: A side is broadcast up to so many rows of a few fixed-width columns (about 16 MB); beyond it, it is shuffled.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df`, marked for a broadcast if a count of its rows proves it small. Give it settled tables only."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def unused(docs: DataFrame, name: str) -> str:
    """`name`, or a longer one, that no column of `docs` has. Columns are told apart without regard to case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether a document is kept from learning: by the checksum of its id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once: a lambda's variable stays one, where a column that is used repeatedly
    may be computed each time after the optimiser has moved it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def modest_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to BATCH_ROWS, unless they are smaller."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def in_tasks(docs: DataFrame, *columns: Column | str) -> DataFrame:
    """doc_id as text and other columns, for Python in tasks: pandas would turn whole numbers with nulls into floats."""
    modest_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("string"), *columns)


def from_tasks(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Undo `in_tasks`."""
    return rows.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def give_back() -> None:
    """Return memory that is free but held, by Arrow and by the C library, as workers stay for other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def portions(batches: Iterator[pd.DataFrame], rows: int = BATCH_ROWS) -> Iterator[pd.DataFrame]:
    """Batches cut into smaller ones, for functions whose arrays take many times the room of their rows."""
    for batch in batches:
        for first in range(0, len(batch), rows):
            yield batch.iloc[first : first + rows]
        del batch
        give_back()
