"""Whitening of embeddings by exact covariances from polarisation.

Entries become whole numbers. For every dimension, and every sum of two dimensions, the squares of centred values are
summed exactly; the variance of a sum less the variances of its parts is twice their covariance. So no product of two
different dimensions is ever summed, and the covariance matrix is exact until it is divided once. Its eigenvectors give
the components; a row's place on each, over the root of its variance, is whitened.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import modest_batches, settle

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Scaled entries from this size on count as not finite: sums of squares of smaller ones fit in 38 digits up to 2^42 rows.
TOO_LARGE = float(1 << 40)
#: Directions with less than this share of the largest variance have no measurable variance, and give no component.
LEAST_SHARE = 1e-10
#: Whole numbers below this are summed by the machine; larger ones as Python's, exactly too.
SAFE = 1 << 62
#: Rows that are squared at once, so that arrays stay in the cache.
AT_ONCE = 500


@dataclass(frozen=True)
class Fit:
    """What every row is whitened with. All its parts are of the size of one vector, or of one vector for a component."""

    rows: int
    sums: tuple[int, ...]
    components: np.ndarray
    explained: tuple[float, ...]

    @property
    def base(self) -> tuple[int, ...]:
        """The mean of every dimension, rounded down: what is subtracted before anything is squared."""
        return tuple(s // self.rows for s in self.sums)


def whole(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows of a batch by length of vector: the length, the rows' places, and their entries as whole numbers.

    Rows whose vector is null or empty, or has an entry that is null, not finite or too large, are left out.
    """
    lists = batch.column(1)
    lists = lists.cast(pa.list_(pa.float64())) if lists.type != pa.list_(pa.float64()) else lists
    flat = lists.flatten()
    entries = flat.to_numpy(zero_copy_only=False)
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths[lengths > 0]):
        places = np.flatnonzero(lengths == length)
        matrix = np.floor(entries[starts[places, None] + np.arange(length)] * SCALE)
        with np.errstate(invalid="ignore"):
            kept = (np.abs(matrix) < TOO_LARGE).all(axis=1)
        if kept.any():
            yield int(length), places[kept], matrix[kept].astype(np.int64) + OFFSET


def centred(matrix: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Entries less their dimension's rounded mean: machine numbers if sums of squares of pairs fit, else Python's."""
    rest = matrix - base
    largest = int(np.abs(rest).max(initial=0))
    return rest if 4 * largest * largest * max(rest.shape) < SAFE else rest.astype(object)


def squares(values: np.ndarray) -> np.ndarray:
    return (values * values).sum(axis=0)


def polarised(rest: np.ndarray) -> np.ndarray:
    """Sums of squares of every dimension and of every sum of two, as a triangle in rows."""
    parts = []
    for i in range(rest.shape[1]):
        parts.append(squares(rest[:, i : i + 1]))
        parts.append(squares(rest[:, i : i + 1] + rest[:, i + 1 :]))
    return np.concatenate(parts)


def _as_text(values: np.ndarray) -> list[str]:
    return [str(int(v)) for v in values]


def dimensions(vectors: DataFrame, column: str) -> tuple[int, list[int]]:
    """Number of usable rows and exact sum of every dimension, of the commonest length of vectors (of equals the longest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            for length, _, matrix in whole(batch):
                held = totals.setdefault(length, [0, np.zeros(length, object)])
                held[0] += len(matrix)
                held[1] += matrix.sum(axis=0).astype(object)
        for length, (rows, sums) in totals.items():
            arrays = [[length] * length, [rows] * length, list(range(length)), _as_text(sums)]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["length", "rows", "dim", "total"])

    narrow = vectors.select(F.lit(None).cast("int").alias("_"), F.col(column).cast("array<double>"))
    parts = narrow.mapInArrow(run, "length bigint, rows bigint, dim bigint, total string")
    total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    sums = settle(parts.groupBy("length", "dim").agg(F.sum("rows").alias("rows"), total))
    best = sums.where("dim = 0").orderBy(F.desc("rows"), F.desc("length")).first()
    if best is None:
        return 0, []
    found = sums.where(F.col("length") == best["length"]).orderBy("dim").collect()
    return best["rows"], [int(r["total"]) for r in found]


def pair_squares(vectors: DataFrame, column: str, base: list[int]) -> list[int]:
    """Exact sums, over all usable rows, of the squares of centred values: the triangle of `polarised`.

    Tasks add up their rows; what is exchanged and sent to the driver has the size of a triangle of dimensions.
    """
    length = len(base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean = np.array(base, np.int64)
        held = np.zeros(length * (length + 1) // 2, object)
        for batch in batches:
            for found, _, matrix in whole(batch):
                if found == length:
                    for first in range(0, len(matrix), AT_ONCE):
                        held += polarised(centred(matrix[first : first + AT_ONCE], mean)).astype(object)
        if held.any():
            arrays = [pa.array(range(len(held)), pa.int64()), pa.array(_as_text(held))]
            yield pa.RecordBatch.from_arrays(arrays, ["cell", "total"])

    narrow = vectors.select(F.lit(None).cast("int").alias("_"), F.col(column).cast("array<double>"))
    parts = narrow.mapInArrow(run, "cell bigint, total string")
    sums = parts.groupBy("cell").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    out = [0] * (length * (length + 1) // 2)
    for row in sums:
        out[row["cell"]] = int(row["total"])
    return out


def covariance(rows: int, rest: list[int], triangle: list[int]) -> np.ndarray:
    """The covariance matrix from the variances of dimensions and of sums of two. `rest`: sums of the centred values.

    Centring at the rounded mean leaves a rest, which is taken off exactly: rows^2 times a variance is rows times
    the sum of squares less the square of the sum.
    """
    length = len(rest)
    spread, at = {}, 0
    for i in range(length):
        spread[i, i] = rows * triangle[at] - rest[i] ** 2
        for j in range(i + 1, length):
            spread[i, j] = rows * triangle[at + j - i] - (rest[i] + rest[j]) ** 2
        at += length - i
    matrix = np.zeros((length, length))
    for i in range(length):
        matrix[i, i] = spread[i, i] / rows**2
        for j in range(i + 1, length):
            matrix[i, j] = matrix[j, i] = (spread[i, j] - spread[i, i] - spread[j, j]) / (2 * rows**2)
    return matrix


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Fit | None:
    """Components by falling variance over all usable rows; None where there is no usable row."""
    modest_batches(vectors.sparkSession)
    rows, sums = dimensions(vectors, column)
    if rows == 0:
        return None
    base = [s // rows for s in sums]
    triangle = pair_squares(vectors, column, base)
    matrix = covariance(rows, [s - rows * b for s, b in zip(sums, base, strict=True)], triangle)
    values, directions = np.linalg.eigh(matrix)
    values, directions = values[::-1], directions[:, ::-1]
    kept = [k for k in range(min(components, len(values))) if values[k] > LEAST_SHARE * values[0] and values[k] > 0]
    trace = float(np.trace(matrix))
    return Fit(
        rows, tuple(sums), directions[:, kept] / np.sqrt(values[kept]), tuple(float(values[k] / trace) for k in kept)
    )


def project(vectors: DataFrame, fitted: Fit, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """One row per usable row: the key, `deviation` (sum over dimensions of (n * x - S)^2, exact, decimal(38,0), null
    beyond 38 digits) and `whitened`, an array of its places on the components."""
    modest_batches(vectors.sparkSession)
    length = len(fitted.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, base = fitted.rows, np.array(fitted.base, np.int64)
        rest = np.array([s - n * b for s, b in zip(fitted.sums, fitted.base, strict=True)], np.int64)
        constant = sum(int(r) ** 2 for r in rest)
        for batch in batches:
            for found, places, matrix in whole(batch):
                if found != length:
                    continue
                v = centred(matrix, base)
                safe = v.dtype != object and int(np.abs(v).max(initial=0)) * n * length < SAFE
                crossed = (v if safe else v.astype(object)) * rest
                deviation = [
                    str(n * n * int(a) - 2 * n * int(b) + constant)
                    for a, b in zip((v * v).sum(axis=1), crossed.sum(axis=1), strict=True)
                ]
                placed = (v.astype(np.float64) - rest / n) @ fitted.components
                width = placed.shape[1]
                ends = pa.array(np.arange(len(placed) + 1, dtype=np.int32) * width)
                lists = pa.ListArray.from_arrays(ends, pa.array(placed.ravel()))
                arrays = [batch.column(0).take(pa.array(places)), pa.array(deviation), lists]
                yield pa.RecordBatch.from_arrays(arrays, [key, "deviation", "whitened"])

    fields = [(key, vectors.schema[key].dataType), ("deviation", T.StringType()), ("whitened", T.ArrayType(T.DoubleType()))]
    narrow = vectors.select(key, F.col(column).cast("array<double>"))
    found = narrow.mapInArrow(run, T.StructType([T.StructField(*field) for field in fields]))
    return found.withColumn("deviation", F.expr("try_cast(deviation as decimal(38,0))"))


def identity_error(whitened: DataFrame, rows: int, width: int) -> float:
    """Largest absolute entry of the covariance of all whitened rows less the identity, measured on the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(width), np.zeros((width, width))
        for batch in batches:
            values = batch.column(0).flatten().to_numpy().reshape(-1, width)
            sums += values.sum(axis=0)
            products += values.T @ values
        held = np.concatenate([sums, products.ravel()])
        arrays = [pa.array(range(len(held)), pa.int64()), pa.array(held)]
        yield pa.RecordBatch.from_arrays(arrays, ["cell", "total"])

    parts = whitened.select("whitened").mapInArrow(run, "cell bigint, total double")
    total = np.zeros(width + width * width)
    for row in parts.groupBy("cell").agg(F.sum("total").alias("total")).collect():
        total[row["cell"]] = row["total"]
    mean = total[:width] / rows
    matrix = total[width:].reshape(width, width) / rows - np.outer(mean, mean)
    return float(np.abs(matrix - np.eye(width)).max(initial=0.0))


def whiten(
    vectors: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per usable row of `vectors` and component: the key, component (from 1), n, deviation, whitened,
    explained, identity_error.

    Not usable, and left out, are rows whose vector is null or empty, has another length than most, or holds an entry that
    is null, not finite, or too large for exact sums (2^40 / 64 and more). Directions without variance give no component:
    equal rows alone give an empty result, as an empty table does. Rows that repeat, or whose key is null, each count
    and have their rows. Other columns are ignored, whatever their names; a key named like a result is not allowed.
    """
    fitted = fit(vectors, column, components)
    width = 0 if fitted is None else len(fitted.explained)
    if width == 0:
        schema = "component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
        kinds = T.StructType([vectors.schema[key], *T.StructType.fromDDL(schema).fields])
        return vectors.sparkSession.createDataFrame([], kinds)
    placed = project(vectors, fitted, key, column)
    error = identity_error(placed, fitted.rows, width)
    explained = F.array(*[F.lit(share) for share in fitted.explained])
    return placed.select(key, "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        key,
        (F.col("at") + 1).alias("component"),
        F.lit(fitted.rows).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
