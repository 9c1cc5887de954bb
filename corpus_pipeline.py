"""A training-data pipeline over `documents`: each stage works on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import decontaminate, jaccard, mixing, sharding, toxicity
from starloom.llm.catalog import DOMAINS, WEIGHTS
from starloom.llm.common import table
from starloom.session import scratch_path, stage
from starloom.storage import discard

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Share of the tokens that the mixture takes, in hundredths.
MIXED = 90


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows not predicted toxic, by a model of all of `docs` and the labels that are not held out. Nulls, empty and long
    texts, repeated rows, empty tables and clashing names: as `toxicity.without_toxic` says."""
    return toxicity.without_toxic(docs, *toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones. Nulls, empty and long texts, repeated rows, empty tables and clashing
    names: as `jaccard.without_copies` says."""
    return jaccard.without_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows into which no benchmark item leaked. Nulls, empty and long texts, repeated rows, empty tables and clashing
    names: as `decontaminate.without_leaks` says."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the mixture takes, each at most once. Nulls, empty and long texts, repeated rows, empty tables and
    clashing names: as `mixing.chosen` says."""
    return mixing.chosen(docs, MIXED, seed="mix-1", domains=DOMAINS, weights=WEIGHTS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row. Nulls, empty and long texts, repeated rows, empty tables and clashing names: as
    `sharding.shard_documents` says."""
    return sharding.shard_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near copies", drop_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix),
    ("sharding", shard),
]

#: The toxicity model and tiling have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order. What is between two stages is written to the shared folder, and removed when the next stage
    has been written, also when a stage fails; the result reads only what Spark's cleaner keeps track of."""
    docs, written = table(spark, sf_dir, "documents"), []
    try:
        for name, step in STAGES[:-1]:
            path = scratch_path(spark, name.replace(" ", "-"))
            written.append(path)
            docs = stage(step(spark, docs, sf_dir), path)
            for old in written[:-1]:
                discard(spark, old)
            del written[:-1]
        return STAGES[-1][1](spark, docs, sf_dir)
    finally:
        for path in written:
            discard(spark, path)
