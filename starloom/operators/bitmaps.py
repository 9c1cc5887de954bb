"""Sets of whole-number keys as bitmaps, and reference checks by their differences.

A word holds 64 neighbouring keys as the bits of one number. Words are made by `bit_or`, a hash aggregate that is combined
before the shuffle, so what moves is bounded by the range of the keys over 64, however often keys occur. Keys that
are scattered over a wide range are a word each, which is no more than grouping them would move.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.session import settle
from starloom.specs import ForeignKey

#: Keys in a word, and the power of two that it is.
KEYS, POWER = 64, 6
#: Words that are broadcast at most, of some 50 bytes each.
FEW = 500_000


def word_of(key: Column) -> Column:
    """The word of a key; of negative ones too, as the shift keeps the sign."""
    return F.shiftright(key.cast("bigint"), POWER)


def bit_of(key: Column) -> Column:
    """The key's bit in its word."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), key.cast("bigint").bitwiseAND(KEYS - 1).cast("int"))


def keys_in(word: Column, bits: Column) -> Column:
    """The keys of a word as an array, least first."""
    places = F.sequence(F.lit(0), F.lit(KEYS - 1))
    set_ = F.filter(places, lambda i: F.call_function("getbit", bits, i) == 1)
    return F.transform(set_, lambda i: word * KEYS + i)


def require_whole(df: DataFrame, column: str) -> None:
    kind = df.schema[column].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"{column} is of type {kind.simpleString()}; bitmaps are of whole numbers")


def bitmaps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, word, bits) of the distinct keys of every column, from one scan. Nulls are no keys."""
    for column in columns:
        require_whole(df, column)
    named = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("bigint").alias("_key")) for c in columns]
    each = df.select(F.explode(F.array(*named)).alias("_each")).select("_each.*").where("_key IS NOT NULL")
    words = each.select("column_name", word_of(F.col("_key")).alias("word"), bit_of(F.col("_key")).alias("bit"))
    return words.groupBy("column_name", "word").agg(F.bit_or("bit").alias("bits"))


def known_bitmaps(references: Sequence[ForeignKey], dimensions: dict[str, DataFrame]) -> DataFrame:
    """(column_name, word, known) of the keys that each reference may take. A dimension is scanned once however many
    columns refer to it."""
    columns: dict[tuple[str, str], list[str]] = {}
    for r in references:
        columns.setdefault((r.table, r.key), []).append(r.column)
    known = []
    for (table, key), names in columns.items():
        words = bitmaps(dimensions[table], [key]).withColumnRenamed("bits", "known").drop("column_name")
        known.append(words.withColumn("column_name", F.explode(F.array(*[F.lit(n) for n in names]))))
    return reduce(DataFrame.unionByName, known)


def missing_words(df: DataFrame, references: Sequence[ForeignKey], dimensions: dict[str, DataFrame]) -> DataFrame:
    """(column_name, word, bits) of the keys that are used and not known: the difference of two bitmaps."""
    used = bitmaps(df, [r.column for r in references])
    both = used.join(known_bitmaps(references, dimensions), ["column_name", "word"], "left")
    bits = F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("known", F.lit(0).cast("bigint"))))
    return both.select("column_name", "word", bits.alias("bits")).where("bits != 0")


def missing_keys(df: DataFrame, references: Sequence[ForeignKey], dimensions: dict[str, DataFrame]) -> DataFrame:
    """(column_name, key) of every missing reference of every column."""
    words = missing_words(df, references, dimensions)
    return words.select("column_name", F.explode(keys_in(F.col("word"), F.col("bits"))).alias("key"))


def orphan_counts(df: DataFrame, references: Sequence[ForeignKey], dimensions: dict[str, DataFrame]) -> DataFrame:
    """(column_name, value, n) for every missing reference of every column, as `quality.orphan_counts` gives.

    The words with missing keys are computed first, and rows are counted in a second scan. Up to `FEW` words are
    broadcast to that scan, so that of a sound table no row is moved at all; more of them meet the counts after values
    have been combined, so that a hot one is a row a task by then.
    """
    words = settle(missing_words(df, references, dimensions))
    named = [F.struct(F.lit(r.column).alias("column_name"), F.col(r.column).cast("bigint").alias("_key")) for r in references]
    rows = df.select(F.explode(F.array(*named)).alias("_each")).select("_each.*").where("_key IS NOT NULL")
    rows, at = rows.withColumn("word", word_of(F.col("_key"))), ["column_name", "word"]
    few = words.count() <= FEW
    if few:
        rows = _missing(rows.join(F.broadcast(words), at))
    counted = rows.groupBy(*at, "_key").agg(F.count(F.lit(1)).alias("n"))
    found = counted if few else _missing(counted.join(words, at))
    return found.select("column_name", F.col("_key").cast("string").alias("value"), "n")


def _missing(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("bits").bitwiseAND(bit_of(F.col("_key"))) != 0)
