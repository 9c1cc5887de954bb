"""Exact sums and whitened rows against plain whole-number arithmetic."""

import math
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from compare import TESTDATA
from pyspark.sql import functions as F

from starloom.llm import catalog, whitening

NAN, INF = float("nan"), float("inf")


def usable(vectors):
    """Usable vectors as whole numbers, by their place in the input."""
    found = {}
    for place, vector in enumerate(vectors):
        if vector and all(c is not None and math.isfinite(c) and abs(math.floor(64 * c)) < 2**40 for c in vector):
            found[place] = [math.floor(64 * c) + 1_000_000 for c in vector]
    lengths = [len(x) for x in found.values()]
    most = max(lengths, key=lambda n: (lengths.count(n), n), default=0)
    return {place: x for place, x in found.items() if len(x) == most}


def exact_covariance(rows):
    n, d = len(rows), len(rows[0])
    mean = [Fraction(sum(x[i] for x in rows), n) for i in range(d)]
    return [[sum((x[i] - mean[i]) * (x[j] - mean[j]) for x in rows) / n for j in range(d)] for i in range(d)]


def check(vectors, found, key="vec_id"):
    """`found`: collected rows; vec_id is the place in the input."""
    rows = usable(vectors)
    n, sums = len(rows), [sum(column) for column in zip(*rows.values())]
    assert {r[key] for r in found} == set(rows)
    assert {r["n"] for r in found} == {n}
    exact = np.array([[float(c) for c in line] for line in exact_covariance(list(rows.values()))])
    values = np.linalg.eigvalsh(exact)[::-1]
    width = max(r["component"] for r in found)
    assert len(found) == n * width and width <= 32
    whitened = np.zeros((n, width))
    order = {place: k for k, place in enumerate(rows)}
    for r in found:
        assert r["deviation"] == sum((n * x - s) ** 2 for x, s in zip(rows[r[key]], sums))
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / exact.trace(), rel=1e-9)
        assert r["identity_error"] <= 1e-4
        whitened[order[r[key]], r["component"] - 1] = r["whitened"]
    assert len({r["identity_error"] for r in found}) == 1
    centred = np.array([[float(x - Fraction(s, n)) for x, s in zip(row, sums)] for row in rows.values()])
    # Rows times their coefficients give the components back; these are eigenvectors of the exact covariance.
    directions = np.linalg.lstsq(centred, whitened, rcond=None)[0] * np.sqrt(values[:width])
    assert np.allclose(centred @ directions / np.sqrt(values[:width]), whitened, atol=1e-8)
    assert np.allclose(whitened.T @ whitened / n, np.eye(width), atol=1e-6)


def test_query_on_a_sample_table(spark):
    path = TESTDATA / "sf0.001" / "embeddings.parquet"
    table = dict(duckdb.sql(f"SELECT vec_id, embedding FROM '{path}'").fetchall())
    ids = list(table)
    found = [r.asDict() for r in catalog.QUERIES["op13_whitening"](spark, str(TESTDATA / "sf0.001")).collect()]
    for r in found:
        r["vec_id"] = ids.index(r["vec_id"])
    check([table[i] for i in ids], found)


def generated(rows, width, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(rows, width)) @ rng.normal(size=(width, width)) * scale).tolist()


def frame(spark, vectors):
    return spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<double>").repartition(5)


@pytest.mark.parametrize("scale", [1.0, 1e7])
def test_rows_that_are_not_usable(spark, scale):
    vectors = generated(60, 4, 1, scale) + [None, [], [1.0, None, 2.0, 3.0], [NAN] * 4, [INF, 0.0, 0.0, 0.0], [1e300] * 4]
    vectors += [[1.0, 2.0]] * 5 + [vectors[0]] * 3
    df = frame(spark, vectors).withColumns({c: F.lit("x") for c in ("n", "at", "deviation", "whitened", "cell", "total")})
    check(vectors, whitening.whiten(df).collect())


def test_large_numbers_are_summed_exactly(spark):
    vectors = [[c * 2.0**33 for c in row] for row in generated(20, 3, 2, 0.2)]
    assert max(abs(c) * 64 for row in vectors for c in row) ** 2 * 20 > 2**63
    found = whitening.whiten(frame(spark, vectors)).collect()
    rows = usable(vectors)
    sums = [sum(column) for column in zip(*rows.values())]
    n = len(rows)
    assert n == 20
    for r in found:
        assert int(r["deviation"]) == sum((n * x - s) ** 2 for x, s in zip(rows[r["vec_id"]], sums))


def test_polarised_covariance_is_exact(spark):
    vectors = generated(50, 5, 3)
    df = frame(spark, vectors)
    n, sums = whitening.dimensions(df, "embedding")
    base = [s // n for s in sums]
    triangle = whitening.pair_squares(df, "embedding", base)
    matrix = whitening.covariance(n, [s - n * b for s, b in zip(sums, base)], triangle)
    exact = exact_covariance(list(usable(vectors).values()))
    assert matrix.tolist() == [[float(c) for c in line] for line in exact]


def test_directions_without_variance_give_no_component(spark):
    vectors = [[*row, 1.0, row[0]] for row in generated(40, 3, 4)]
    found = whitening.whiten(frame(spark, vectors)).collect()
    assert {r["component"] for r in found} == {1, 2, 3}
    check(vectors, found)


@pytest.mark.parametrize("vectors", [[], [None, []], [[1.0, 2.0]] * 4])
def test_nothing_to_whiten(spark, vectors):
    empty = whitening.whiten(frame(spark, vectors))
    assert empty.collect() == []
    assert empty.columns == whitening.whiten(frame(spark, generated(9, 2, 5))).columns


def test_null_keys_have_their_rows(spark):
    rows = [(None if k % 3 == 0 else k, v) for k, v in enumerate(generated(30, 2, 6))]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect()
    assert len(found) == 60 and sum(r["vec_id"] is None for r in found) == 20
