"""Bitmaps of keys, and missing references as their differences."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.operators import bitmaps, quality
from starloom.specs import ForeignKey

REFERENCES = [ForeignKey("a", "d", "key"), ForeignKey("b", "d", "key"), ForeignKey("c", "e", "id")]
EDGES = [0, 1, 63, 64, -1, -64, -65, 2**31 - 1, -(2**31)]


def tables(spark, rows, d, e):
    used = spark.createDataFrame(rows, "a INT, b INT, c BIGINT")
    return used, {
        "d": spark.createDataFrame([(k,) for k in d], "key INT"),
        "e": spark.createDataFrame([(k,) for k in e], "id BIGINT"),
    }


def found(df):
    return sorted(tuple(r) for r in df.collect())


def expected(rows, d, e):
    counts = {}
    for row in rows:
        for name, value, known in zip("abc", row, (d, d, e), strict=True):
            if value is not None and value not in known:
                counts[name, str(value)] = counts.get((name, str(value)), 0) + 1
    return sorted((*k, n) for k, n in counts.items())


KEYS = st.one_of(st.none(), st.integers(-130, 130), st.sampled_from(EDGES))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(KEYS, KEYS, KEYS), max_size=40), d=st.sets(KEYS), e=st.sets(KEYS), few=st.booleans())
def test_counts_are_those_of_the_plain_check(spark, rows, d, e, few):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(bitmaps, "FEW", 500_000 if few else 0)
        used, dimensions = tables(spark, rows, d, e)
        assert found(bitmaps.orphan_counts(used, REFERENCES, dimensions)) == expected(rows, d, e)


def test_whole_range_of_longs(spark):
    ends = [2**63 - 1, -(2**63), 2**62, -1]
    used, dimensions = tables(spark, [(None, None, k) for k in ends * 2], [], ends[:1])
    keys = bitmaps.missing_keys(used, REFERENCES, dimensions)
    assert found(keys) == sorted(("c", k) for k in ends[1:])
    assert found(bitmaps.orphan_counts(used, REFERENCES, dimensions)) == sorted(("c", str(k), 2) for k in ends[1:])


def test_other_types_are_refused(spark):
    used = spark.createDataFrame([("x",)], "a STRING")
    with pytest.raises(TypeError, match="whole numbers"):
        bitmaps.bitmaps(used, ["a"])


def test_what_moves_is_words(spark):
    used = spark.range(0, 64_000, 1, 4).select((F.col("id") % 6400).cast("int").alias("a"))
    words = bitmaps.bitmaps(used, ["a"])
    text = words._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in text and "SortAggregate" not in text and text.count("Exchange") == 1
    assert words.count() == 100


def test_of_a_sound_table_no_row_is_moved(spark):
    used = spark.range(1000).select(F.col("id").cast("int").alias("a"))
    known = {"d": spark.range(1000).select(F.col("id").cast("int").alias("key"))}
    df = bitmaps.orphan_counts(used, REFERENCES[:1], known)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.index("BroadcastHashJoin") > text.index("partial_count")
    assert df.count() == 0 and quality.orphan_counts(used, REFERENCES[:1], known).count() == 0
