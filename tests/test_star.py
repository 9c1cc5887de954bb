import datetime

import frames
import golden
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starloom.operators import star
from starloom.specs import WAREHOUSE


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_dim_date_golden(spark):
    got = star.dim_date(frames.sales_order(spark)).orderBy("date_id").collect()
    assert [(r.date_id, r.day_of_week, r.day_name) for r in got] == golden.DATES
    for r in got:
        assert r.date_id == f"{r.year:04d}-{r.month:02d}-{r.day:02d}"
        assert (r.year, r.month, r.month_name, r.quarter) == (2022, 11, "november", 4)


@pytest.mark.parametrize("rule", ["thirds", "calendar"])
def test_quarter_by_month(spark, rule):
    months = spark.range(1, 13).select(F.format_string("2024-%02d-15", "id").alias("date_id"))
    got = star.calendar(months, rule).orderBy("date_id")
    assert [r.quarter for r in got.collect()] == golden.QUARTERS[rule]
    with pytest.raises(ValueError):
        star.calendar(months, "fiscal")


def test_month_and_weekday_names(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2023-12-25', DATE'2025-01-07')) AS date_id")
    for r in star.calendar(days).collect():
        day = datetime.date.fromisoformat(r.date_id)
        assert (r.year, r.month, r.day, r.day_of_week) == (day.year, day.month, day.day, day.isoweekday())
        assert (r.day_name, r.month_name) == (f"{day:%A}".lower(), f"{day:%B}".lower())


def test_dim_date_takes_full_timestamps_dates_and_text(spark):
    typed = spark.sql(
        "SELECT TIMESTAMP_NTZ'2024-02-29 23:59:59.999999' AS a, DATE'2024-03-01' AS b, '2024-03-02T00:00:00.000' AS c"
    )
    assert [r.date_id for r in star.dim_date(typed, ["a"]).collect()] == ["2024-02-29"]
    assert [r.date_id for r in star.dim_date(typed, ["b"]).collect()] == ["2024-03-01"]
    assert [r.date_id for r in star.dim_date(typed, ["c"]).collect()] == ["2024-03-02"]


def test_dim_date_missing_and_malformed_days(spark):
    missing = frames.sales_order(spark, agreed_payment_date=None)
    assert star.dim_date(missing).count() < len(golden.DATES)
    with pytest.raises(PySparkException):
        star.dim_date(missing, nulls="raise").collect()
    with pytest.raises(PySparkException):
        star.dim_date(frames.sales_order(spark, created_at="2024-13-01T00:00:00.000")).collect()


def test_dim_design_golden(spark):
    assert rows(star.dim_design(frames.design(spark))) == sorted(golden.DESIGNS, key=str)


def test_missing_column_raises(spark):
    with pytest.raises(PySparkException):
        star.dim_design(frames.design(spark).drop("file_name"))


def test_dim_location_golden(spark):
    dim = star.dim_location(frames.address(spark))
    assert dim.columns == WAREHOUSE["dim_location"].names
    assert rows(dim) == sorted(golden.ADDRESSES, key=str)


def test_dim_counterparty_golden(spark):
    dim = star.dim_counterparty(frames.counterparty(spark), frames.address(spark))
    assert dim.columns == WAREHOUSE["dim_counterparty"].names
    places = {a[0]: a[1:] for a in golden.ADDRESSES}
    assert rows(dim) == sorted(((i, n, *places[a]) for i, a, n in golden.COUNTERPARTIES), key=str)


def test_counterparty_join_is_inner_and_multiplies(spark):
    party = frames.frame(
        spark,
        "counterparty",
        [{"counterparty_id": i, "legal_address_id": a, "counterparty_legal_name": "N"} for i, a in ((1, 1), (2, 99), (3, None))],
    )
    place = frames.frame(
        spark, "address", [{"address_id": 1, "city": "A"}, {"address_id": 1, "city": "B"}, {"address_id": None, "city": "C"}]
    )
    found = [(r.counterparty_id, r.counterparty_legal_city) for r in star.dim_counterparty(party, place).collect()]
    assert sorted(found) == [(1, "A"), (1, "B")]
    safe = star.dim_counterparty(party, place, null_safe=True).collect()
    assert sorted((r.counterparty_id, r.counterparty_legal_city) for r in safe) == [(1, "A"), (1, "B"), (3, "C")]


def test_dim_staff_golden(spark):
    dim = star.dim_staff(frames.staff(spark), frames.department(spark))
    assert dim.columns == WAREHOUSE["dim_staff"].names
    expected = [(i, f, n, d, p, f"{f}.{n}@example.com".lower()) for i, f, n, d, p in golden.STAFF]
    assert rows(dim) == sorted(expected, key=str)


def test_staff_null_departments(spark):
    staff = frames.frame(spark, "staff", [{"staff_id": 1, "department_id": None}])
    department = frames.frame(spark, "department", [{"department_id": None, "department_name": "X", "location": "Y"}])
    assert star.dim_staff(staff, department).count() == 0
    assert [r.department_name for r in star.dim_staff(staff, department, null_safe=True).collect()] == ["X"]


def test_dim_currency_golden_and_unknown_code(spark):
    dim = star.dim_currency(frames.currency(spark, (4, "JPY"), (5, None)))
    assert rows(dim) == sorted([*golden.CURRENCIES, (4, "JPY", None), (5, None, None)], key=str)


def test_fact_sales_order_golden(spark):
    fact = star.fact_sales_order(frames.sales_order(spark).repartition(4))
    assert fact.columns == WAREHOUSE["fact_sales_order"].names
    got = fact.orderBy("sales_record_id").collect()
    orders = list(frames.sales_order_records())
    assert [r.sales_record_id for r in got] == list(range(1, 11))
    for r, order in zip(got, orders):
        day, time = order["created_at"].split("T")
        assert (r.created_date, r.created_time) == (day, time)
        assert (r.last_updated_date, r.last_updated_time) == (day, time)
        assert r.sales_staff_id == order["staff_id"]
        for name in set(order) - {"created_at", "last_updated", "staff_id"}:
            assert r[name] == order[name]


@pytest.mark.parametrize(
    "text, day, time",
    [
        ("2024-02-29T23:59:59.999999", "2024-02-29", "23:59:59.999"),
        ("2024-02-29 00:00:00", "2024-02-29", "00:00:00.000"),
        ("2024-02-29", "2024-02-29", "00:00:00.000"),
        (None, None, None),
    ],
)
def test_moments_are_cut_to_milliseconds(spark, text, day, time):
    r = star.fact_sales_order(frames.sales_order(spark, created_at=text).limit(1)).first()
    assert (r.created_date, r.created_time) == (day, time)


def test_malformed_moment_raises(spark):
    with pytest.raises(PySparkException):
        star.fact_sales_order(frames.sales_order(spark, created_at="yesterday")).collect()


def test_extension_facts(spark):
    paid = frames.frame(
        spark,
        "payment",
        [
            dict(
                payment_id=7 - i, created_at="2024-01-01T10:00:00.5", last_updated="2024-01-02T10:00:00",
                transaction_id=1, counterparty_id=1, payment_amount=1.5, currency_id=1, payment_type_id=1, paid=True,
                payment_date="2024-01-03",
            )
            for i in range(3)
        ],
    )
    fact = star.fact_payment(paid)
    assert fact.columns == WAREHOUSE["fact_payment"].names
    assert sorted((r.payment_record_id, r.payment_id, r.created_time) for r in fact.collect()) == [
        (1, 5, "10:00:00.500"), (2, 6, "10:00:00.500"), (3, 7, "10:00:00.500")
    ]
    kinds = frames.frame(spark, "payment_type", [{"payment_type_id": 1, "payment_type_name": "SALES_RECEIPT"}])
    assert rows(star.dim_payment_type(kinds)) == [(1, "SALES_RECEIPT")]
    moves = frames.frame(spark, "transaction", [{"transaction_id": 1, "transaction_type": "SALE", "sales_order_id": 9}])
    assert rows(star.dim_transaction(moves)) == [(1, "SALE", 9, None)]
