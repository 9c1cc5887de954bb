"""The shape of physical plans: what is read, what is shuffled, what is broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from starloom.catalog import queries
from starloom.catalog.roles import sample
from starloom.operators import quality, star
from starloom.plans import insight
from starloom.session import scratch_root, session, settle
from starloom.sources.tables import changed_since, latest_per_key
from starloom.specs import ForeignKey

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(text):
    return [set(re.findall(r"(\w+):", m)) for m in re.findall(r"ReadSchema: struct<([^>]*)", text)]


@pytest.fixture
def no_broadcast(spark):
    """Joins as they are planned when no side is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dim_date_reads_only_dates_in_one_scan_and_combines_first(spark):
    text = plan(star.dim_date(sample(spark, SF, "orders"), ["o_orderdate"]))
    assert read_columns(text) == [{"o_orderdate"}]
    assert text.count("Exchange") == 1 and text.count("HashAggregate") == 2


def test_filters_reach_the_scan(spark):
    text = plan(changed_since(sample(spark, SF, "events"), F.lit("2024-01-15").cast("timestamp_ntz"), "ts").select("user_id"))
    assert "GreaterThan(ts,2024-01-15" in text
    assert read_columns(text) == [{"ts", "user_id"}]
    text = plan(quality.numeric_misfits(sample(spark, SF, "orders").select("o_totalprice"), F.col("o_totalprice")))
    assert "GreaterThanOrEqual(o_totalprice" in text


def test_latest_version_combines_before_the_shuffle(spark):
    text = plan(latest_per_key(sample(spark, SF, "events").select("user_id", "ts", "value"), ["user_id"], "ts"))
    assert "partial_max(ts" in text and "Window" not in text
    # One scan for the greatest values, one for the rows. Only rows that have their key's greatest value are sorted.
    assert len(read_columns(text)) == 2
    assert "partial_max_by" in text


def test_status_counts_hold_no_list(spark):
    text = plan(queries.batch_status(spark, SF))
    assert "collect" not in text and "SortAggregate" not in text


def test_reference_check_shuffles_counts_not_rows(spark, no_broadcast):
    text = plan(
        quality.orphan_counts(
            sample(spark, SF, "lineitem"),
            [ForeignKey("l_partkey", "part", "p_partkey"), ForeignKey("l_suppkey", "supplier", "s_suppkey")],
            {"part": sample(spark, SF, "part"), "supplier": sample(spark, SF, "supplier")},
        )
    )
    assert [c for c in read_columns(text) if c & {"l_partkey", "l_suppkey"}] == [{"l_partkey", "l_suppkey"}]
    anti = text.index("LeftAnti")
    assert anti < text.index("partial_count"), "references are counted below the join"


def test_report_reads_the_fact_a_few_times(spark):
    scans = [c for c in read_columns(plan(queries.dq_report(spark, SF))) if any(n.startswith("o_") for n in c)]
    assert len(scans) <= 8


def test_orphan_rows_shuffle_distinct_references(spark, no_broadcast):
    lines = sample(spark, SF, "lineitem").select("l_orderkey", "l_partkey")
    text = plan(quality.orphan_rows(lines, "l_partkey", sample(spark, SF, "part"), "p_partkey"))
    assert {"l_partkey"} in read_columns(text)


def test_rollup_sums_before_it_meets_the_counterparties(spark, no_broadcast):
    orders = sample(spark, SF, "orders").withColumn("counterparty_id", F.col("o_custkey"))
    daily = insight.by_counterparty_day(orders, "o_orderdate", "o_totalprice")
    assert read_columns(plan(daily)) == [{"o_custkey", "o_totalprice", "o_orderdate"}]
    dates = settle(star.dim_date(orders, ["o_orderdate"]))
    text = plan(insight.country_years(settle(daily), dates, queries.dim_counterparty(spark, SF)))
    assert text.count("partial_sum") == 2
    assert "o_orderdate" not in "".join(re.findall("ReadSchema.*", plan(queries.bi_star_rollup(spark, SF))))


def test_null_safe_keys_hash(spark):
    assert "NestedLoop" not in plan(queries.nullsafe_join(spark, SF))
    assert "Cartesian" not in plan(queries.nullsafe_join(spark, SF))


@pytest.mark.parametrize("name", queries.QUERIES)
def test_no_query_has_a_cross_join_or_python_function(spark, name):
    if name in ("snapshot_stream", "stream_load_order", "star_batch_refresh", "manifest_lines", "manifest_states") or name.startswith("loaded_"):
        pytest.skip("runs whole batches")
    text = plan(queries.QUERIES[name](spark, SF))
    for word in ("NestedLoop", "Cartesian", "Python", "InPandas"):
        assert word not in text


def test_scratch_is_the_shared_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert session() is spark
