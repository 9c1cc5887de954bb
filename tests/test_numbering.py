import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.operators import numbering
from starloom.operators.numbering import with_dense_key


def check(df, order_by, **limits):
    """Numbers are 1..N without gaps, follow the order, and no row is lost or changed."""
    numbered = with_dense_key(df, "n", order_by, **limits)
    assert numbered.columns == ["n", *df.columns]
    got = sorted(numbered.collect(), key=lambda r: r.n)
    assert [r.n for r in got] == list(range(1, len(got) + 1))
    order = [r[order_by] for r in got]
    assert order == sorted(order, key=lambda v: (v is None, v if v is not None else 0))
    assert sorted(map(str, (tuple(r)[1:] for r in got))) == sorted(map(str, map(tuple, df.collect())))


def frame(spark, ids, kind="BIGINT"):
    return spark.createDataFrame([(i, f"v{k}") for k, i in enumerate(ids)], f"id {kind}, v STRING").repartition(3)


@pytest.fixture
def ways(monkeypatch):
    taken = []
    original = numbering._numbered_by_file

    def spy(*args):
        taken.append("file")
        return original(*args)

    monkeypatch.setattr(numbering, "_numbered_by_file", spy)
    return taken


def contents(numbered):
    return sorted((r.n, r.id, r.v) for r in numbered.collect())


@pytest.mark.parametrize("range_rows, way", [(1000, []), (10, ["file"])])
def test_ties_are_broken_by_content_whatever_the_layout(spark, ways, range_rows, way):
    rows = [(i % 5, f"v{i * 37 % 400}") for i in range(400)]
    expected = [(n, *r) for n, r in enumerate(sorted(rows), 1)]
    for tasks in (3, 7):
        df = spark.createDataFrame(rows, "id BIGINT, v STRING").repartition(tasks)
        assert contents(with_dense_key(df, "n", "id", range_rows=range_rows)) == expected
    assert ways == way * 2


def test_many_ranges(spark, ways):
    check(spark.range(5, 3005).select("id", (F.col("id") % 7).alias("v")).repartition(5), "id", range_rows=100)
    assert ways == []


def test_unordered_input_gaps_and_negatives(spark, ways):
    check(frame(spark, [17, -4, 0, 10**12, 3, 250, -(10**9)]), "id", range_rows=10)
    assert ways == []


def test_empty(spark):
    check(spark.createDataFrame([], "id BIGINT, v STRING"), "id")


def test_null_order_values_come_last(spark):
    check(frame(spark, [3, None, 1, None, 2]), "id")
    check(frame(spark, [None, None]), "id")


def test_hot_value_takes_the_file_way(spark, ways):
    ids = [5] * 400 + list(range(1000))
    check(frame(spark, ids), "id", range_rows=20)
    assert ways == ["file"]


def test_hot_copies_spread_over_files(spark, ways, tmp_path):
    """A third of all rows are copies of one row; no written file may hold them all."""
    copies = spark.range(600).select(F.lit(7).cast("bigint").alias("id"), F.lit("same").alias("v"))
    others = spark.range(1200).select("id", F.col("id").cast("string").alias("v"))
    numbered = with_dense_key(
        copies.union(others).repartition(6), "n", "id", range_rows=50, scratch=str(tmp_path / "numbers")
    )
    assert ways == ["file"]
    spread = numbered.where("v = 'same'").groupBy(F.input_file_name()).count().collect()
    assert len(spread) > 5 and max(r["count"] for r in spread) < 300
    check(copies.union(others), "id", range_rows=50)


def test_clustered_values_take_the_file_way(spark, ways):
    check(frame(spark, [*range(300), 10**9]), "id", range_rows=20)
    assert ways == ["file"]


def test_whole_long_range(spark, ways):
    check(frame(spark, [-(2**63), 2**63 - 1, 0]), "id")
    assert ways == ["file"]


def test_text_order(spark):
    check(
        spark.createDataFrame([(c,) for c in "hello world"], "id STRING").repartition(4), "id", range_rows=3
    )


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ids=st.lists(st.integers(-50, 50) | st.none(), max_size=60), rows=st.integers(1, 20))
def test_any_ids(spark, ids, rows):
    check(frame(spark, ids), "id", range_rows=rows)


def test_one_task_per_range_and_no_window(spark):
    df = spark.range(0, 5000).select("id", (F.col("id") * 2).alias("v"))
    plan = with_dense_key(df, "n", "id", range_rows=500)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
    assert "shufflepartitionidpassthrough" in plan
