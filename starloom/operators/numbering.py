"""Dense surrogate keys 1..N without a global window.

A `row_number()` over the whole table runs in one task. Here the table is cut into ranges of the order
column, the ranges are counted on a scan of that one column, and each range is sorted by a task of its own
and numbered from its offset.

Equal order values are numbered by the other columns, in their order, nulls last. Rows that are equal in
all of these are the same row, so the numbers depend on the content of the table alone, not on its layout.

Both ways read `df` more than once, so it must stand on an immutable snapshot.

A lasting key is dense when it is given, and stays: later batches number only what they have not seen before.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.session import settle, stage
from starloom.storage import discard

RANGE_ROWS = 500_000
MAX_RANGES = 65_536
SKEW_FACTOR = 4
LONG_SPAN = 2**63 - 1
POSITION_BITS = 33


def with_dense_key(
    df: DataFrame,
    key: str,
    order_by: str,
    range_rows: int = RANGE_ROWS,
    max_ranges: int = MAX_RANGES,
    scratch: str | None = None,
) -> DataFrame:
    """`df` plus `key` = 1..N in ascending order of `order_by` (nulls last), then of the other columns.

    Columns of a type without an order, such as maps, cannot break ties and are passed over.

    `scratch` is a folder for written tables, if they are needed; whoever names it may discard it once
    the result has been written. Without one, they are checkpoints, which Spark's cleaner removes.
    """
    if not isinstance(df.schema[order_by].dataType, T.IntegralType):
        return _numbered_by_file(df, key, order_by, range_rows, max_ranges, scratch)

    column = F.col(order_by).cast("long")
    low, high, n = df.agg(F.min(column), F.max(column), F.count(F.lit(1))).first()
    ranges = max(1, min(max_ranges, math.ceil(n / range_rows)))
    if low is None:
        low, high = 0, 0
    if high - low > LONG_SPAN:
        return _numbered_by_file(df, key, order_by, range_rows, max_ranges, scratch)

    width = (high - low) // ranges + 1
    bucket = F.coalesce(F.call_function("div", column - F.lit(low), F.lit(width)), F.lit(ranges)).cast("int")
    # At most max_ranges + 1 rows of two numbers come back, whatever the size of the table.
    sizes = df.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("n")).orderBy("_bucket").collect()
    if max((r["n"] for r in sizes), default=0) > SKEW_FACTOR * max(range_rows, n // ranges):
        return _numbered_by_file(df, key, order_by, range_rows, max_ranges, scratch)

    # One task per range: after the sort, the position within the task is the position within the range.
    placed = (
        df.withColumn("_bucket", bucket)
        .repartitionById(ranges + 1, "_bucket")
        .sortWithinPartitions(*_content_order(df, order_by))
        .withColumn("_place", F.monotonically_increasing_id())
    )
    return _from_offsets(placed, key, "_bucket", sizes, df.columns)


def _content_order(df: DataFrame, order_by: str) -> list[Column]:
    """Orders rows by `order_by` and then by the other columns."""
    others = [f.name for f in df.schema.fields if f.name != order_by and _has_order(f.dataType)]
    return [F.col(f"`{c}`").asc_nulls_last() for c in (order_by, *others)]


def _has_order(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_order(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_has_order(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _from_offsets(placed: DataFrame, key: str, part: str, sizes: list, columns: list[str]) -> DataFrame:
    """Number rows by the sizes of the parts before theirs, plus their own position `_place` in the part.

    A `_place` is a monotonically_increasing_id(): task in the upper bits, position in the lower 33.
    The offsets are one row per part, at most MAX_RANGES + 1 of them, so they are safe to broadcast.
    """
    starts = accumulate((r["n"] for r in sizes), initial=1)
    offsets = placed.sparkSession.createDataFrame(
        [(r[part], start) for r, start in zip(sizes, starts)], f"{part} BIGINT, _start BIGINT"
    )
    position = F.col("_place").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    return placed.join(F.broadcast(offsets), part).select((F.col("_start") + position).alias(key), *columns)


def _numbered_by_file(
    df: DataFrame, key: str, order_by: str, range_rows: int, max_ranges: int, scratch: str | None
) -> DataFrame:
    """For any order column and any skew, at the price of two written tables.

    The rows are range-partitioned by the order column, the other columns and, for whole-row copies, the
    place that they were stored with. That place is unique and survives a retry, so one hot value, or a group of
    copies, spreads over many tasks. Every sorted task then stores its rows with their positions in it.
    """
    order = [*_content_order(df, order_by), F.col("_row")]
    staged = _kept(df.withColumn("_row", F.monotonically_increasing_id()), key, "input", scratch)
    parts = max(1, min(max_ranges, math.ceil(staged.count() / range_rows)))
    placed = _kept(
        staged.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .drop("_row")
        .withColumn("_place", F.monotonically_increasing_id()),
        key,
        "sorted",
        scratch,
    )
    if scratch is not None:
        discard(df.sparkSession, f"{scratch}/numbering-{key}/input")
    placed = placed.withColumn("_task", F.shiftright("_place", POSITION_BITS))
    sizes = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("n")).orderBy("_task").collect()
    return _from_offsets(placed, key, "_task", sizes, df.columns)


def _kept(df: DataFrame, key: str, name: str, scratch: str | None) -> DataFrame:
    """`df` computed once: in the folder that its owner will discard, or in one that Spark's cleaner removes."""
    return settle(df) if scratch is None else stage(df, f"{scratch}/numbering-{key}/{name}")


class NotAKey(ValueError):
    """Rows that cannot be told apart by what should identify them."""


def with_lasting_key(
    df: DataFrame, key: str, natural: str, known: DataFrame | None, keep: Callable[[DataFrame], DataFrame], **numbering
) -> DataFrame:
    """`df` plus `key`: the one that `known` (key, natural) has for the row, or a new one after all of these.

    New rows are numbered among themselves by `natural`, without gaps, so late rows never move others. Without known keys
    this is the dense numbering. `keep` stores the new pairs, once, and returns them as stored: a key that has been
    given is never computed again. `natural` must be there and differ in every row; NotAKey is raised otherwise.
    """
    broken = df.groupBy(natural).agg(F.count(F.lit(1)).alias("n")).where(f"n > 1 OR {natural} IS NULL").first()
    if broken is not None:
        raise NotAKey(f"{natural} {broken[0]} is held by {broken.n} rows; it does not identify them")
    ids, last = df.select(natural), 0
    if known is not None:
        known = known.select(key, natural)
        ids = ids.join(known, natural, "left_anti")
        last = known.agg(F.max(key)).first()[0] or 0
    added = with_dense_key(ids, key, natural, **numbering).withColumn(key, F.col(key) + F.lit(last))
    added = keep(added.select(key, natural))
    every = added if known is None else known.unionByName(added)
    return df.join(every, natural).select(key, *df.columns)
