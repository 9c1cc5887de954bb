import re

import pytest
from compare import differences, views

import __spark_entry__ as entry
from starloom.catalog.oracles import ORACLES
from starloom.catalog.queries import QUERIES
from starloom.session import scratch_root
from starloom.storage import children

SF = "sf0.001"


@pytest.fixture(scope="module")
def con():
    return views(SF)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_statement(spark, con, name):
    assert differences(spark, con, name, QUERIES[name], ORACLES[name], SF) is None


def test_queries_leave_only_checkpoints(spark):
    """After the queries above: what is left is kept track of by Spark's cleaner."""
    for name in ("json_array_split", "manifest_lines", "fact_tied_keys", "stable_keys", "bi_heatmap"):
        QUERIES[name](spark, f"/root/testdata/{SF}").collect()
    root = scratch_root(spark)
    mine = {spark.sparkContext._jsc.sc().getCheckpointDir().get().rsplit("/", 1)[1]}
    left = [n for n in children(spark, root) if n not in mine and not re.fullmatch("[0-9a-f-]{36}", n)]
    assert left == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "day_of_week", "revenue", "n"]
    assert df.count() > 0
