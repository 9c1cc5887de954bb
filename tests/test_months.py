"""Facts in folders by month: what a refresh writes, what readers see and what Spark reads."""

import re
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.sinks.months import fingerprints, of_days
from starloom.sinks.warehouse import FolderWarehouse
from starloom.storage import children

DAYS = [date(2024, 1, 5), date(2024, 1, 31), date(2024, 2, 1), date(2025, 2, 1), None]
FIRST, SECOND, THIRD, FOURTH = (f"2024010{n}_000000" for n in range(1, 5))


def fact(spark, rows):
    rows = [(i, day, None if price is None else Decimal(price), note) for i, day, price, note in rows]
    return spark.createDataFrame(rows, "id BIGINT, day DATE, price DECIMAL(10,2), note STRING")


def rows(prices=(1, 2, 3, 4, 5), days=DAYS):
    return [(i, day, price, None if i % 2 else "x") for i, (day, price) in enumerate(zip(days, prices, strict=True))]


def seen(target):
    return sorted((tuple(r) for r in target.table("t").drop("in_month").collect()), key=lambda r: r[0])


def written(target):
    """Version and month of every folder of files."""
    root = f"{target.root}/months/t/files"
    return {
        (v.removeprefix("version=")[:15], int(m.removeprefix("in_month=")))
        for v in children(target.spark, root)
        for m in children(target.spark, f"{root}/{v}")
        if m.startswith("in_month=")
    }


@pytest.fixture
def target(spark, tmp_path):
    return FolderWarehouse(spark, f"{tmp_path}/wh", by_month={"t": "day"})


def test_only_changed_months_are_written(spark, target):
    target.refresh(FIRST, {"t": fact(spark, rows())})
    assert written(target) == {(FIRST, m) for m in (202401, 202402, 202502, 0)}
    target.refresh(SECOND, {"t": fact(spark, rows((1, 2, 7, 4, 5)))})
    assert written(target) == {(FIRST, m) for m in (202401, 202402, 202502, 0)} | {(SECOND, 202402)}
    assert [r[2] for r in seen(target)] == [1, 2, 7, 4, 5]
    # January's files are the first batch's in all versions; February's go with the version that listed them last.
    target.refresh(THIRD, {"t": fact(spark, rows((1, 2, 7, 4, 6)))})
    assert written(target) == {(FIRST, m) for m in (202401, 202502, 0)} | {(SECOND, 202402), (THIRD, 0)}
    assert [r[2] for r in seen(target)] == [1, 2, 7, 4, 6]


def test_a_month_may_vanish_and_a_table_be_empty(spark, target):
    target.refresh(FIRST, {"t": fact(spark, rows())})
    target.refresh(SECOND, {"t": fact(spark, rows()[:2])})
    assert [r[0] for r in seen(target)] == [0, 1]
    target.refresh(THIRD, {"t": fact(spark, [])})
    assert seen(target) == [] and target.table("t").columns == ["id", "day", "price", "note", "in_month"]
    target.refresh(FOURTH, {"t": fact(spark, rows())})
    assert len(seen(target)) == 5


def test_rows_come_back_whole(spark, target):
    many = rows() * 3 + [(9, DAYS[0], None, "z")]
    target.refresh(FIRST, {"t": fact(spark, many)})
    assert seen(target) == sorted(many, key=lambda r: r[0])
    months = {r.id: r.in_month for r in target.table("t").collect()}
    assert months == {0: 202401, 1: 202401, 2: 202402, 3: 202502, 4: 0, 9: 202401}


def test_the_version_before_stays_readable(spark, target):
    target.refresh(FIRST, {"t": fact(spark, rows())})
    old = target.table("t")
    target.refresh(SECOND, {"t": fact(spark, rows((9, 9, 9, 9, 9)))})
    assert sorted(r.price for r in old.collect()) == [1, 2, 3, 4, 5]


def test_fingerprints_tell_values_places_and_copies_apart(spark):
    def of(*values):
        data = spark.createDataFrame([(DAYS[0], a, b) for a, b in values], "day DATE, a STRING, b STRING")
        return [tuple(r) for r in fingerprints(data, "day").collect()]

    assert of(("x", "y"), ("u", "v")) == of(("u", "v"), ("x", "y"))
    different = [of(("x", None)), of((None, "x")), of(("x", "x")), of(("x", None), ("x", None)), of((None, None))]
    assert len({str(d) for d in different}) == len(different)


def test_columns_named_as_folders_are_refused(spark, target):
    with pytest.raises(ValueError, match="In_Month"):
        target.refresh(FIRST, {"t": fact(spark, rows()).withColumn("In_Month", F.lit(1))})


def test_spark_reads_the_months_asked_for(spark, target):
    target.refresh(FIRST, {"t": fact(spark, rows())})
    dates = spark.createDataFrame([(d, d.year) for d in DAYS[:4]], "date_id DATE, year INT")
    target.refresh(SECOND, {"t": fact(spark, rows()), "dim_date": dates})
    asked = of_days(target.table("t"), "day", target.table("dim_date").where("year = 2025"))
    text = asked._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", text)
    assert [(r.id, r.in_month) for r in asked.collect()] == [(3, 202502)]
    direct = target.table("t").where("in_month BETWEEN 202401 AND 202412")
    assert re.search(r"PartitionFilters: \[[^\]]*in_month", direct._jdf.queryExecution().executedPlan().toString())
    assert direct.count() == 3
