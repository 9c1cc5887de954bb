"""Snapshots in buckets: no shuffle by their key, in any session."""

import pytest
from pyspark.sql import functions as F

from starloom.catalog.queries import order_lines
from starloom.operators import quality
from starloom.sinks.buckets import attached, spec_of, write_buckets
from starloom.storage import children


@pytest.fixture
def wide(spark):
    """Joins as they are planned when no side is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def written(spark, tmp_path):
    orders = spark.range(100).selectExpr("id AS o_orderkey", "'O' AS o_orderstatus", "NULL AS `odd name`")
    orders = orders.withColumn("odd name", F.col("odd name").cast("struct<a:int,b:array<string>>"))
    lines = spark.range(300).selectExpr("id % 90 AS l_orderkey", "int(id % 2) AS l_linenumber", "double(id) AS l_extendedprice")
    nulls = spark.createDataFrame([(None, 1, 2.0)], lines.schema)
    paths = {"b_orders": f"{tmp_path}/it's orders", "b_lines": f"{tmp_path}/lines"}
    write_buckets(orders, paths["b_orders"], "o_orderkey", 4, "b_orders")
    write_buckets(lines.union(nulls), paths["b_lines"], "l_orderkey", 8, "b_lines")
    return paths, orders, lines.union(nulls)


def test_rows_and_description_come_back(spark, tmp_path):
    paths, orders, lines = written(spark, tmp_path)
    assert spec_of(spark, paths["b_lines"]).buckets == 8 and spec_of(spark, paths["b_orders"]).key == "o_orderkey"
    assert len([n for n in children(spark, paths["b_orders"]) if n.endswith(".parquet")]) == 4
    with attached(spark.newSession(), paths) as tables:
        assert tables["b_orders"].schema.simpleString() == orders.schema.simpleString()
        assert sorted(map(str, tables["b_lines"].collect())) == sorted(map(str, lines.collect()))
    assert not spark.catalog.tableExists("b_orders") and children(spark, paths["b_orders"])


def test_checks_groupings_and_joins_by_the_key_shuffle_nothing(wide, tmp_path):
    paths, orders, lines = written(wide, tmp_path)
    with attached(wide, paths) as tables:
        o, n = tables["b_orders"], tables["b_lines"]
        repeated = quality.duplicate_keys(n, ["l_orderkey", "l_linenumber"])
        assert "Exchange" not in plan(repeated) and repeated.count() > 0
        assert sorted(repeated.collect()) == sorted(quality.duplicate_keys(lines, ["l_orderkey", "l_linenumber"]).collect())
        wide.conf.set("spark.sql.bucketing.coalesceBucketsInJoin.enabled", "true")
        missing = o.join(n, o["o_orderkey"] == n["l_orderkey"], "left_anti")
        assert "Exchange" not in plan(missing) and missing.count() == 10
        wide.conf.unset("spark.sql.bucketing.coalesceBucketsInJoin.enabled")


def test_tables_of_equal_buckets_join_without_a_shuffle(wide, tmp_path):
    _, orders, lines = written(wide, tmp_path)
    paths = {"c_orders": f"{tmp_path}/c_orders", "c_lines": f"{tmp_path}/c_lines"}
    write_buckets(orders, paths["c_orders"], "o_orderkey", 4, "c_orders")
    write_buckets(lines, paths["c_lines"], "l_orderkey", 4, "c_lines")
    with attached(wide, paths) as tables:
        found = order_lines(tables["c_orders"], tables["c_lines"])
        assert "Exchange" not in plan(found)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, order_lines(orders, lines).collect()))


def test_a_folder_is_not_written_twice(spark, tmp_path):
    write_buckets(spark.range(3), f"{tmp_path}/t", "id", 2, "d_once")
    with pytest.raises(FileExistsError):
        write_buckets(spark.range(3), f"{tmp_path}/t", "id", 2, "d_once")
    with attached(spark, {"d_once": f"{tmp_path}/t"}) as tables:
        assert tables["d_once"].count() == 3
