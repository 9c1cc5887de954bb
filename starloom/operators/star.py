"""The star-schema transforms: operational tables in, dimensions and facts out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import dates
from starloom.functions.text import CURRENCY_NAMES, lookup
from starloom.operators.numbering import with_dense_key
from starloom.specs import WAREHOUSE

# The order columns whose days make up the date dimension, and the address columns that
# dimensions carry.
ORDER_DAYS = ("created_at", "last_updated", "agreed_delivery_date", "agreed_payment_date")
FACT_DAYS = {
    "sales_order": ORDER_DAYS,
    "purchase_order": ORDER_DAYS,
    "payment": ("created_at", "last_updated", "payment_date"),
}
ADDRESS_COLUMNS = ("address_line_1", "address_line_2", "district", "city", "postal_code", "country", "phone")


def equal_keys(left: Column, right: Column, null_safe: bool) -> Column:
    """SQL equality, or equality that also pairs null with null; both stay hashable join keys."""
    return left.eqNullSafe(right) if null_safe else left == right


def days(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every day mentioned in `columns`, with repeats, from one scan of `df`."""
    mentioned = F.array(*[dates.day_of(df, c) for c in columns])
    return df.select(F.explode(mentioned).alias("date_id"))


def calendar(mentioned: DataFrame, quarter: str = "thirds", nulls: str = "drop") -> DataFrame:
    """One row per distinct day of the column `date_id`, with its attributes.

    Repeats collapse before the shuffle, so what moves is days, not rows. `nulls="raise"` fails on a
    missing day instead of leaving it to the checks before loading.
    """
    day = F.col("date_id")
    if nulls == "raise":
        day = F.coalesce(day, F.raise_error(F.lit("missing date")).cast(mentioned.schema["date_id"].dataType))
    distinct = mentioned.select(day.alias("date_id")).where(F.col("date_id").isNotNull()).distinct()
    day = F.to_date("date_id", dates.DATE_FORMAT)
    return distinct.select(
        dates.date_text(day).alias("date_id"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        dates.iso_weekday(day).alias("day_of_week"),
        dates.day_name(day).alias("day_name"),
        dates.month_name(day).alias("month_name"),
        dates.quarter(day, quarter).alias("quarter"),
    )


def dim_date(
    orders: DataFrame, columns: Sequence[str] = ORDER_DAYS, quarter: str = "thirds", nulls: str = "drop"
) -> DataFrame:
    return calendar(days(orders, columns), quarter, nulls)


def dim_design(design: DataFrame) -> DataFrame:
    return design.select(*WAREHOUSE["dim_design"].names)


def dim_location(address: DataFrame) -> DataFrame:
    return address.select(F.col("address_id").alias("location_id"), *ADDRESS_COLUMNS)


def dim_counterparty(counterparty: DataFrame, address: DataFrame, null_safe: bool = False) -> DataFrame:
    """Counterparties with their legal address; those without a matching address are left out."""
    legal = {c: f"counterparty_legal_{c}" for c in ADDRESS_COLUMNS} | {"phone": "counterparty_legal_phone_number"}
    address = address.select("address_id", *[F.col(c).alias(name) for c, name in legal.items()])
    return counterparty.join(
        address, equal_keys(counterparty["legal_address_id"], address["address_id"], null_safe)
    ).select("counterparty_id", "counterparty_legal_name", *legal.values())


def dim_staff(staff: DataFrame, department: DataFrame, null_safe: bool = False) -> DataFrame:
    """Staff with their department; those without a matching department are left out."""
    department = department.select(F.col("department_id").alias("_department"), "department_name", "location")
    return staff.join(
        department, equal_keys(staff["department_id"], department["_department"], null_safe)
    ).select(*WAREHOUSE["dim_staff"].names)


def dim_currency(currency: DataFrame, names: dict[str, str] = CURRENCY_NAMES) -> DataFrame:
    return currency.select(
        "currency_id", "currency_code", lookup(names, F.col("currency_code")).alias("currency_name")
    )


def split_moments(df: DataFrame, moments: dict[str, str]) -> DataFrame:
    """For each timestamp column -> prefix, add <prefix>_date and <prefix>_time text columns."""
    parts = {}
    for column, prefix in moments.items():
        parts |= {f"{prefix}_date": dates.date_text(F.col(column)), f"{prefix}_time": dates.time_text(F.col(column))}
    return df.withColumns(parts)


def fact(
    df: DataFrame, name: str, order_by: str, number: Callable[..., DataFrame] = with_dense_key, **numbering
) -> DataFrame:
    """A fact table: number the rows, split creation and update times, project the declared columns.

    `number` takes the rows, the key and the order column; a lasting key is given by passing one that knows earlier ones.

    The rows are numbered while their times are still eight bytes each, and turned into text after.
    """
    spec = WAREHOUSE[name]
    moments = {"created_at": "created", "last_updated": "last_updated"}
    carried = [c for c in spec.names if c in df.columns]
    narrow = df.select(*carried, *[dates.moment(c).alias(c) for c in moments])
    return split_moments(number(narrow, spec.key, order_by, **numbering), moments).select(*spec.names)


def fact_sales_order(sales_order: DataFrame, **numbering) -> DataFrame:
    return fact(
        sales_order.withColumn("sales_staff_id", F.col("staff_id")), "fact_sales_order", "sales_order_id", **numbering
    )


# Extension: the declared targets that the sales pipeline does not fill.


def dim_payment_type(payment_type: DataFrame) -> DataFrame:
    return payment_type.select(*WAREHOUSE["dim_payment_type"].names)


def dim_transaction(transaction: DataFrame) -> DataFrame:
    return transaction.select(*WAREHOUSE["dim_transaction"].names)


def fact_purchase_order(purchase_order: DataFrame, **numbering) -> DataFrame:
    return fact(purchase_order, "fact_purchase_order", "purchase_order_id", **numbering)


def fact_payment(payment: DataFrame, **numbering) -> DataFrame:
    return fact(payment, "fact_payment", "payment_id", **numbering)
