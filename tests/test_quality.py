from decimal import ROUND_HALF_UP, Decimal, localcontext

import frames
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.operators import quality, star
from starloom.specs import SALES_TABLES, WAREHOUSE, Column, ForeignKey, Table


def star_of(spark, **changes):
    sources = {**frames.consistent(spark)}
    fact = star.fact_sales_order(sources["sales_order"])
    return {
        "dim_date": star.dim_date(sources["sales_order"]),
        "dim_design": star.dim_design(sources["design"]),
        "dim_location": star.dim_location(sources["address"]),
        "dim_counterparty": star.dim_counterparty(sources["counterparty"], sources["address"]),
        "dim_staff": star.dim_staff(sources["staff"], sources["department"]),
        "dim_currency": star.dim_currency(sources["currency"]),
        "fact_sales_order": fact,
        **changes,
    }


def found(tables, name):
    rows = quality.violations(tables, [name]).collect()
    return sorted((r.rule, r.column_name, r.n) for r in rows)


def test_consistent_star_has_no_violations(spark):
    tables = star_of(spark)
    for spec in SALES_TABLES:
        assert found(tables, spec.name) == []


def test_every_rule_of_the_fact(spark):
    tables = star_of(spark)
    number = F.col("sales_record_id")
    tables["fact_sales_order"] = tables["fact_sales_order"].withColumns(
        {
            "sales_record_id": F.when(number == 2, 1).otherwise(number),
            "created_time": F.when(number == 3, "24:30:00").otherwise(F.col("created_time")),
            "unit_price": F.when(number <= 2, 1e8).otherwise(F.col("unit_price")),
            "agreed_payment_date": F.when(number == 4, "2024-02-30").otherwise(F.col("agreed_payment_date")),
            "currency_id": F.when(number <= 5, 77).otherwise(F.col("currency_id")),
            "design_id": F.when(number > 8, None).otherwise(F.col("design_id")),
            "created_date": F.when(number == 6, "1999-01-01").otherwise(F.col("created_date")),
        }
    )
    assert found(tables, "fact_sales_order") == [
        ("foreign_key", "created_date", 1),
        ("foreign_key", "currency_id", 5),
        ("not_null", "design_id", 2),
        ("primary_key", "sales_record_id", 1),
        ("type", "agreed_payment_date", 1),
        ("type", "created_time", 1),
        ("type", "unit_price", 2),
    ]


def test_unknown_currency_and_lost_staff_are_reported(spark):
    tables = star_of(spark)
    tables["dim_currency"] = star.dim_currency(frames.currency(spark, (4, "JPY")))
    assert found(tables, "dim_currency") == [("not_null", "currency_name", 1)]
    tables["dim_staff"] = tables["dim_staff"].where("staff_id <> 10")
    assert found(tables, "fact_sales_order") == [("foreign_key", "sales_staff_id", 2)]


def test_nullable_columns_may_be_null(spark):
    tables = star_of(spark, dim_location=star.dim_location(frames.address(spark)))
    assert found(tables, "dim_location") == []


def test_keys(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 5)], "a INT, b INT")
    assert [tuple(r) for r in quality.duplicate_keys(df, ["a", "b"]).collect()] == [(1, None, 2)]
    assert quality.null_counts(df, ["a", "b"]).first().asDict() == {"a_nulls": 0, "b_nulls": 2}


def test_orphans(spark):
    fact = spark.createDataFrame([(1, 10), (2, 11), (3, 11), (4, None)], "id INT, ref INT")
    dim = spark.createDataFrame([(10,), (12,), (None,)], "key INT")
    assert sorted(r.id for r in quality.orphan_rows(fact, "ref", dim, "key").collect()) == [2, 3]
    counts = quality.orphan_counts(
        fact, [ForeignKey("ref", "d", "key"), ForeignKey("id", "d", "key")], {"d": dim}
    )
    assert sorted(map(tuple, counts.where("column_name = 'ref'").collect())) == [("ref", "11", 2)]
    assert counts.where("column_name = 'id'").count() == 4


def test_references_meet_the_keys_in_their_own_type(spark):
    fact = spark.createDataFrame(
        [(1, 2, "2024-01-01"), (1, 9, "2024-01-02"), (None, 2, "2024-01-01T00:00:00"), (7, 2, "2024-02-30"), (7, 2, None)],
        "a INT, b INT, day STRING",
    )
    columns = tuple(Column(n, t) for n, t in (("a", "INT"), ("b", "INT"), ("day", "DATE")))
    references = tuple(ForeignKey(*r) for r in (("a", "d", "id"), ("b", "e", "id"), ("day", "days", "at")))
    # A key that is there twice, and one that is null, are nothing to the rows that refer to others.
    d, e = spark.createDataFrame([(1,), (1,), (None,)], "id INT"), spark.createDataFrame([(2,)], "id INT")
    days = spark.sql("SELECT DATE '2024-01-01' AS at")
    expected = [
        ("foreign_key", "a", 2), ("foreign_key", "b", 1), ("foreign_key", "day", 1),
        ("not_null", "a", 1), ("not_null", "day", 1), ("type", "day", 1),
    ]

    def judged(dimensions):
        return quality.judged_references(fact, Table("f", columns, references), dimensions).where("rule IS NOT NULL")

    found = judged({"d": d, "e": e, "days": days})
    assert sorted(map(tuple, found.collect())) == expected
    assert "as string" not in found._jdf.queryExecution().optimizedPlan().toString()
    # Keys of another type are compared as text.
    found = judged({"d": d, "e": e.withColumn("id", F.col("id").cast("string")), "days": days})
    assert sorted(map(tuple, found.collect())) == expected


def fits(value, precision, scale):
    with localcontext(prec=400):
        number = Decimal(repr(value)).quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP)
    return abs(number) < Decimal(10) ** (precision - scale)


EDGES = [99999999.99, 99999999.995, 99999999.99499999, 99999999.994, -99999999.995, -99999999.994, 1e300, -1e9, 0.0]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(-2e8, 2e8) | st.floats(99999999.9, 100000000.1), min_size=1, max_size=50))
def test_numeric_fit_is_exact(spark, values):
    values = values + EDGES
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v DOUBLE")
    misfits = {r.i for r in quality.numeric_misfits(df, F.col("v")).collect()}
    assert misfits == {i for i, v in enumerate(values) if not fits(v, 10, 2)}
    by_cast = {r.i for r in df.where(F.col("v").try_cast("decimal(10,2)").isNull()).collect()}
    assert misfits == by_cast


def test_numeric_fit_of_other_types(spark):
    df = spark.sql("SELECT * FROM VALUES (double('NaN')), (double('Infinity')), (CAST(NULL AS DOUBLE)) AS t(v)")
    assert quality.numeric_misfits(df, F.col("v")).count() == 2
    texts = spark.createDataFrame([("99999999.994",), ("99999999.995",), ("x",), (None,)], "v STRING")
    assert sorted(r.v for r in quality.numeric_misfits(texts, F.col("v")).collect()) == ["99999999.995", "x"]


@pytest.mark.parametrize(
    "text, good",
    [
        ("2024-02-29", True),
        ("2024-02-29T10:00:00.000", True),
        ("2023-02-29", False),
        ("2024-13-01", False),
        ("2024-1-1", False),
        ("2024", False),
        ("", False),
        ("soon", False),
    ],
)
def test_date_parse(spark, text, good):
    df = spark.createDataFrame([(text,)], "d STRING")
    assert quality.date_misfits(df, "d").count() == (0 if good else 1)


@pytest.mark.parametrize(
    "text, good", [("23:59:59.999", True), ("00:00:00", True), ("24:00:00", False), ("10:61:00", False), ("10:00", False)]
)
def test_time_parse(spark, text, good):
    df = spark.createDataFrame([(text,)], "t STRING")
    assert quality.time_misfits(df, "t").count() == (0 if good else 1)


def test_conform_types(spark):
    fact = quality.conform(star_of(spark)["fact_sales_order"], WAREHOUSE["fact_sales_order"])
    kinds = dict(fact.dtypes)
    assert list(kinds) == WAREHOUSE["fact_sales_order"].names
    assert kinds["unit_price"] == "decimal(10,2)" and kinds["created_date"] == "date"
    assert kinds["sales_record_id"] == "bigint" and kinds["created_time"] == "string"
    assert fact.where("sales_order_id = 2").first().unit_price == Decimal("3.94")


def test_conform_rounds_half_up(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,)], "v DOUBLE")
    got = [r[0] for r in df.select(quality.converted(df, "v", "DECIMAL(10,2)")).collect()]
    assert got == [Decimal("1.01"), Decimal("2.68"), Decimal("-1.01")]


def test_opt_in_time_type(spark):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    try:
        fact = quality.conform(star_of(spark)["fact_sales_order"], WAREHOUSE["fact_sales_order"], time_type=True)
        assert dict(fact.dtypes)["created_time"] == "time(3)"
        assert fact.select(F.col("created_time").cast("string")).where("created_time LIKE '11:37:10.341%'").count() == 1
    finally:
        spark.conf.unset("spark.sql.timeType.enabled")
