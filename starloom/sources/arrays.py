"""A JSON array of any length, read by many tasks.

Text is split at every closing brace, so the file is cut like any other text file. A brace inside a string cuts a record in
two. Whether a piece begins inside a string follows from the quotes before it: their parity is counted per split in
a first scan, and carried over the splits of a file in their order. Splits without such cuts are parsed as they are
read; the pieces of the others are put together again by the tasks that read them, batch after batch. Only what a
record leaves in the splits that it crosses, at most two texts a split, is exchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.text import doubled_backslashes
from starloom.session import settle

END = "}"
SPLIT = ["file", "block"]
#: What is left of an array after its last record, or of an array without any.
TAIL = r"^\s*(\[\s*)?\]\s*$"
#: What stands before a record: the array's bracket, or the comma after the record before.
LEAD = r"^\s*[\[,]\s*"


class NotOneArray(ValueError):
    """A file that does not hold exactly one whole array."""


def is_flat(schema: str | T.StructType) -> bool:
    """Whether no field holds records of its own. Only then does every brace outside strings end a record."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def plain(inner: T.DataType) -> bool:
        if isinstance(inner, T.ArrayType):
            return plain(inner.elementType)
        return not isinstance(inner, (T.StructType, T.MapType, T.VariantType))

    return all(plain(f.dataType) for f in kind.fields)


def _pieces(spark: SparkSession, path: str | Sequence[str], raw_escapes: bool) -> DataFrame:
    """file, block, text, and whether the text holds an odd number of quotes that are not escaped."""
    text = F.col("value") if raw_escapes else F.regexp_replace("value", r"\\.", "")
    quotes = F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))
    return spark.read.text(path, lineSep=END).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("text"),
        (quotes % 2).cast("int").alias("odd"),
    )


def _tails(text: Column) -> Column:
    return F.count_if(text.rlike(TAIL))


def _splits(pieces: DataFrame) -> DataFrame:
    """Of every split: odd pieces, tails, whether it begins inside a string, and a number. A row a split, by hash aggregates."""
    counted = pieces.groupBy(*SPLIT).agg(F.sum("odd").alias("odd"), _tails(F.col("text")).alias("tails"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2
    counted = counted.withColumn("inside", inside.cast("int")).withColumn("cut", (F.col("odd") > 0) | (F.col("inside") == 1))
    return counted.withColumn("split", F.monotonically_increasing_id())


RECORDS = "text STRING"
#: What a split adds to others: the tails in it, and texts of records that it does not hold whole. `begins`: it holds the beginning.
ENDS = "split BIGINT, tails BIGINT, begins INT, text STRING"


def _joined(whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Puts pieces of cut splits together as they are read: RECORDS that a split holds whole, or its ENDS.

    A record goes on as long as the quotes up to a piece are odd, so a task holds a batch and one open record.
    """

    def ended(split: int, tails: int | None, begins: int | None, text: str | None) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string())
        values = [pa.array([v], kind) for v, kind in zip((split, tails, begins, text), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(values, ["split", "tails", "begins", "text"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, inside, begun, tails, opened = None, 0, True, 0, []

        def record() -> Iterator[pa.RecordBatch]:
            """The open record, at its end or that of the split."""
            if whole and begun and not inside:
                yield pa.RecordBatch.from_arrays([pa.array([END.join(opened)], pa.string())], ["text"])
            elif not whole and (inside or not begun):
                yield ended(split, None, int(begun), END.join(opened))

        def close() -> Iterator[pa.RecordBatch]:
            if opened:
                yield from record()
            if split is not None and not whole:
                yield ended(split, tails, None, None)

        for batch in batches:
            of = batch.column("split").to_numpy()
            cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
            for low, high in zip(cuts, cuts[1:]):
                if high == low:
                    continue
                rows = batch.slice(low, high - low)
                if of[low] != split:
                    yield from close()
                    split, inside, tails, opened = int(of[low]), rows.column("inside")[0].as_py(), 0, []
                    begun = not inside
                texts = rows.column("text")
                after = (inside + np.cumsum(rows.column("odd").to_numpy())) % 2
                begins = np.concatenate(([inside], after[:-1])) == 0
                tails += int(rows.column("tail").to_numpy()[begins].sum())
                inside = int(after[-1])
                starts = np.flatnonzero(begins)
                head = int(starts[0]) if len(starts) else len(texts)
                opened += texts.slice(0, head).to_pylist()
                if not len(starts):
                    continue
                if opened:
                    # It has ended, whatever this batch ends with.
                    open_at_end, inside = inside, 0
                    yield from record()
                    inside = open_at_end
                last = int(starts[-1]) if inside else len(texts)
                if whole and last > head:
                    offsets = pa.array(np.append(starts[: len(starts) - inside], last) - head, pa.int32())
                    lists = pa.ListArray.from_arrays(offsets, texts.slice(head, last - head))
                    yield pa.RecordBatch.from_arrays([pc.binary_join(lists, END)], ["text"])
                begun, opened = True, texts.slice(last).to_pylist()
        yield from close()

    return join


def _mended(pieces: DataFrame, splits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records of splits with cut strings, and the tails of these splits.

    The splits, a row each, go to the tasks that read the pieces, which thus stay in their order. A record that goes on into
    another split has a number there: that of the ends that began up to it.
    """
    cut = splits.where("cut").select(*SPLIT, "split", "inside")
    mine = pieces.join(F.broadcast(cut), SPLIT).select(
        "split", "inside", "odd", F.col("text").rlike(TAIL).cast("int").alias("tail"), "text"
    )
    ends = settle(mine.mapInArrow(_joined(whole=False), ENDS)).join(F.broadcast(cut.select(*SPLIT, "split")), "split")
    so_far = Window.partitionBy("file").orderBy("block", "begins").rowsBetween(Window.unboundedPreceding, 0)
    parts = F.sort_array(F.collect_list(F.struct("block", "begins", "text")))
    crossing = (
        ends.where("begins IS NOT NULL")
        .withColumn("number", F.sum("begins").over(so_far))
        .groupBy("file", "number")
        .agg(F.array_join(F.transform(parts, lambda p: p.text), END).alias("text"))
        .select("text")
    )
    records = mine.mapInArrow(_joined(whole=True), RECORDS).unionByName(crossing)
    return records, ends.where("tails IS NOT NULL").select("file", "tails")


def read_array(
    spark: SparkSession, path: str | Sequence[str], schema: str | T.StructType, raw_escapes: bool = False
) -> DataFrame:
    """The records of files that hold one JSON array each, in tasks that share a file.

    Records must be flat: see `is_flat`; one that holds another record is malformed here. A malformed record fails the read.
    A file without exactly one end of an array raises NotOneArray at once; an empty file has no records. White space
    between records does not matter. The files are scanned twice, once to count quotes, and splits with cut strings a third
    time, for what crosses them.
    """
    if not is_flat(schema):
        raise ValueError("records inside records cannot be split at braces; read them as whole documents")
    pieces = _pieces(spark, path, raw_escapes)
    splits = settle(_splits(pieces))
    texts, tails = pieces.select("text"), splits
    if not splits.where("cut").isEmpty():
        mended, cut_tails = _mended(pieces, splits)
        whole = splits.where(~F.col("cut")).select(*SPLIT)
        texts = pieces.join(F.broadcast(whole), SPLIT, "left_semi").select("text").unionByName(mended)
        tails = splits.where(~F.col("cut")).select("file", "tails").unionByName(cut_tails)
    broken = tails.groupBy("file").agg(F.sum("tails").alias("n")).where("n <> 1").first()
    if broken is not None:
        raise NotOneArray(f"{broken.file} holds {broken.n} ends of an array, not one")
    record = F.concat(F.regexp_replace("text", LEAD, ""), F.lit(END))
    record = doubled_backslashes(record) if raw_escapes else record
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    parsed = texts.where(~F.col("text").rlike(TAIL)).select(F.from_json(record, kind, {"mode": "FAILFAST"}).alias("r"))
    return parsed.select("r.*")
