"""Sharding by jump consistent hashing: no ring table, and only the share that must move does when shards are added.

Law `key`: the document id and the number of shards alone decide the shard. Equal texts under different ids
may thus lie in different shards; they can be found by their checksum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import bounded, settle

SHARDS = 24
OVERHEAD = 8

# A linear congruential generator modulo 2^48 whose products fit in 63 bits when taken by halves.
MULTIPLIER, INCREMENT, HALF = 25214903917, 11, 24
MASK, LOW = (1 << 48) - 1, (1 << 24) - 1


def seed_of(key: Column) -> Column:
    """48 bits of the key's digest; a null key counts as empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")


def _step(state: Column) -> Column:
    low = state.bitwiseAND(F.lit(LOW)) * F.lit(MULTIPLIER) + F.lit(INCREMENT)
    high = F.shiftleft((F.shiftright(state, HALF) * F.lit(MULTIPLIER)).bitwiseAND(F.lit(LOW)), HALF)
    return (low + high).bitwiseAND(F.lit(MASK))


def jump(key: Column, shards: int) -> Column:
    """Struct of `shard`, among `shards`, and `grown`, among one more.

    A key jumps from shard to shard, each time to one beyond it drawn by its own generator; where it would
    jump beyond the last shard it stays. So it only ever moves into a shard that is added.
    """

    def hop(at: Column, _: Column) -> Column:
        drawn = _step(at.state)
        target = F.floor((at.grown + 1) * (F.lit(2147483648.0) / (F.shiftright(drawn, 17) + 1)))
        moved = F.when(target < shards, target).otherwise(at.shard)
        return F.when(
            at.open & (target < shards + 1),
            F.struct(drawn.alias("state"), target.alias("grown"), moved.alias("shard"), F.lit(True).alias("open")),
        ).otherwise(F.struct(at.state, at.grown, at.shard, F.lit(False).alias("open")))

    zero = F.lit(0).cast("bigint")
    start = F.struct(
        seed_of(key).alias("state"), zero.alias("grown"), zero.alias("shard"), F.lit(True).alias("open")
    )
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(shards)),
        start,
        hop,
        lambda at: F.struct(at.shard.cast("int").alias("shard"), at.grown.cast("int").alias("grown")),
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size: UTF-8 bytes of the text (none for a null) plus 8. text_crc32: null for a null text. slot: place in the
    shard from 0, without gaps, by doc_id (nulls first), checksum and size; rows equal in all of these are
    interchangeable. A null doc_id is hashed as empty text. Rows that repeat keep a slot each. Other columns
    are ignored, whatever their names. An empty table gives an empty result.

    Slots need no window over a shard: rows are range-partitioned by place, even those of one key, and a
    place in a sorted task plus the rows of the shard in earlier tasks is the slot.
    """
    narrow = settle(
        docs.select(
            F.col("doc_id"),
            (F.coalesce(F.octet_length("text").cast("bigint"), F.lit(0)) + OVERHEAD).alias("size"),
            F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
            jump(F.col("doc_id"), shards).alias("to"),
            F.monotonically_increasing_id().alias("row"),
        ).select("doc_id", "size", "text_crc32", "to.shard", F.col("to.grown").alias("grown_shard"), "row")
    )
    order = ["shard", "doc_id", "text_crc32", "size", "row"]
    placed = settle(
        narrow.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    ).withColumn("task", F.shiftright("at", 33))
    runs = placed.groupBy("shard", "task").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    runs = settle(
        runs.select("shard", "task", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    )
    return placed.join(bounded(runs), ["shard", "task"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("at") + F.col("shift")).alias("slot"),
        "grown_shard",
    )
