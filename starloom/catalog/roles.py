"""The sample tables in the role of the operational tables.

Orders play the sales orders, customers the counterparties and the addresses, parts the designs, suppliers
the staff, regions the departments and the currencies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A currency per region.
CURRENCIES = {
    "GBP": "Great British Pounds", "USD": "United States Dollars", "EUR": "Euro", "CHF": "Swiss Franc", "JPY": "Yen",
}


def sample(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_int(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("int")


def stamped(df: DataFrame, *columns: Column) -> DataFrame:
    at = F.lit("2024-01-01T00:00:00.000")
    return df.select(*columns, at.alias("created_at"), at.alias("last_updated"))


def operational(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    customer, region = sample(spark, sf_dir, "customer"), sample(spark, sf_dir, "region")
    code = F.element_at(F.array(*[F.lit(c) for c in CURRENCIES]), F.col("r_regionkey") + 1)
    return {
        "sales_order": sales_order(sample(spark, sf_dir, "orders")),
        "design": stamped(
            sample(spark, sf_dir, "part"),
            as_int("p_partkey").alias("design_id"),
            F.col("p_name").alias("design_name"),
            F.concat(F.lit("/usr/"), "p_type").alias("file_location"),
            F.concat("p_brand", F.lit(".json")).alias("file_name"),
        ),
        "address": stamped(
            customer,
            as_int("c_custkey").alias("address_id"),
            F.concat(F.lit("1 "), "c_name").alias("address_line_1"),
            F.lit(None).cast("string").alias("address_line_2"),
            F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("district"),
            F.format_string("City %d", "c_nationkey").alias("city"),
            F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("postal_code"),
            F.format_string("Country %d", "c_nationkey").alias("country"),
            F.lit("0000 000000").alias("phone"),
        ),
        "counterparty": stamped(
            customer,
            as_int("c_custkey").alias("counterparty_id"),
            F.col("c_name").alias("counterparty_legal_name"),
            as_int(F.floor(F.col("c_custkey") / 2)).alias("legal_address_id"),
            F.col("c_mktsegment").alias("commercial_contact"),
            F.col("c_mktsegment").alias("delivery_contact"),
        ),
        "staff": stamped(
            sample(spark, sf_dir, "supplier"),
            as_int("s_suppkey").alias("staff_id"),
            F.col("s_name").alias("first_name"),
            F.lit("Smith").alias("last_name"),
            (F.col("s_nationkey") % 5).alias("department_id"),
            F.concat(F.lower("s_name"), F.lit("@example.com")).alias("email_address"),
        ),
        "department": stamped(
            region,
            F.col("r_regionkey").alias("department_id"),
            F.col("r_name").alias("department_name"),
            F.concat(F.lit("House "), "r_name").alias("location"),
            F.lit("Jones").alias("manager"),
        ),
        "currency": stamped(
            region,
            F.col("r_regionkey").alias("currency_id"),
            code.alias("currency_code"),
        ),
    }


def sales_order(orders: DataFrame) -> DataFrame:
    key, customer, at = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    return orders.select(
        as_int(key).alias("sales_order_id"),
        (at + F.expr("INTERVAL '09:30:15.123456' HOUR TO SECOND")).alias("created_at"),
        (at + F.expr("INTERVAL '1 10:00:00.5' DAY TO SECOND")).alias("last_updated"),
        as_int(key % 100).alias("design_id"),
        as_int(customer % 10).alias("staff_id"),
        as_int(customer).alias("counterparty_id"),
        as_int(key % 1000).alias("units_sold"),
        F.col("o_totalprice").alias("unit_price"),
        as_int(customer % 3).alias("currency_id"),
        F.date_format(at + F.expr("INTERVAL '7' DAY"), "yyyy-MM-dd").alias("agreed_delivery_date"),
        F.date_format(at + F.expr("INTERVAL '30' DAY"), "yyyy-MM-dd").alias("agreed_payment_date"),
        as_int(customer).alias("agreed_delivery_location_id"),
    )


def event_orders(events: DataFrame) -> DataFrame:
    """Events in the role of sales orders, with their 64-bit ids."""
    none = F.lit(None)
    return events.select(
        F.col("event_id").alias("sales_order_id"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("last_updated"),
        none.cast("int").alias("design_id"),
        none.cast("int").alias("staff_id"),
        F.col("user_id").alias("counterparty_id"),
        none.cast("int").alias("units_sold"),
        F.col("value").alias("unit_price"),
        none.cast("int").alias("currency_id"),
        none.cast("string").alias("agreed_delivery_date"),
        none.cast("string").alias("agreed_payment_date"),
        none.cast("int").alias("agreed_delivery_location_id"),
    )


def purchasing(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Orders as purchases, transactions and payments, too; regions as payment types."""
    orders = sample(spark, sf_dir, "orders")
    key, customer, sold = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus") == "F"
    at = [
        (F.col("o_orderdate") + F.expr("INTERVAL '09:30:15.123456' HOUR TO SECOND")).alias("created_at"),
        (F.col("o_orderdate") + F.expr("INTERVAL '1 10:00:00.5' DAY TO SECOND")).alias("last_updated"),
    ]
    return {
        "purchase_order": sales_order(orders).select(
            F.col("sales_order_id").alias("purchase_order_id"),
            "created_at",
            "last_updated",
            "staff_id",
            "counterparty_id",
            F.format_string("item-%d", "design_id").alias("item_code"),
            F.col("units_sold").alias("item_quantity"),
            F.col("unit_price").alias("item_unit_price"),
            "currency_id",
            "agreed_delivery_date",
            "agreed_payment_date",
            "agreed_delivery_location_id",
        ),
        "transaction": orders.select(
            as_int(key).alias("transaction_id"),
            F.when(sold, "SALE").otherwise("PURCHASE").alias("transaction_type"),
            as_int(F.when(sold, key)).alias("sales_order_id"),
            as_int(F.when(~sold, key)).alias("purchase_order_id"),
            *at,
        ),
        "payment_type": stamped(
            sample(spark, sf_dir, "region"),
            F.col("r_regionkey").alias("payment_type_id"),
            F.col("r_name").alias("payment_type_name"),
        ),
        "payment": orders.select(
            as_int(key).alias("payment_id"),
            *at,
            as_int(key).alias("transaction_id"),
            as_int(customer).alias("counterparty_id"),
            F.col("o_totalprice").alias("payment_amount"),
            as_int(customer % 3).alias("currency_id"),
            as_int(key % 5).alias("payment_type_id"),
            sold.alias("paid"),
            F.date_format(F.col("o_orderdate") + F.expr("INTERVAL '30' DAY"), "yyyy-MM-dd").alias("payment_date"),
        ),
    }
