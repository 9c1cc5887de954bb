"""Business questions on the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
TOTAL = "decimal(28,2)"


def by_day(fact: DataFrame, date: str, amount: str) -> DataFrame:
    """Revenue and order count per day: what a scan of the fact leaves to shuffle is days."""
    return fact.groupBy(F.col(date).cast("date").alias("date_id")).agg(
        F.sum(F.col(amount).cast(MONEY)).cast(TOTAL).alias("revenue"), F.count(F.lit(1)).alias("n")
    )


def heatmap(daily: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue and orders by year and weekday; orders without a day in the dimension come under nulls."""
    dates = dim_date.select(F.col("date_id").cast("date"), "year", "day_of_week")
    return (
        daily.join(dates, "date_id", "left")
        .groupBy("year", "day_of_week")
        .agg(F.sum("revenue").cast(TOTAL).alias("revenue"), F.sum("n").alias("n"))
    )


def by_counterparty_day(fact: DataFrame, date: str, amount: str) -> DataFrame:
    """Revenue per counterparty and day: what any question about counterparties in time is answered from."""
    return fact.groupBy("counterparty_id", F.col(date).cast("date").alias("date_id")).agg(
        F.sum(F.col(amount).cast(MONEY)).cast(TOTAL).alias("revenue")
    )


def country_years(daily: DataFrame, dim_date: DataFrame, dim_counterparty: DataFrame) -> DataFrame:
    """Revenue by counterparty country and year, from sums per counterparty and day.

    The sums are summed again per counterparty and year before they meet the counterparties, so a counterparty with a
    large share of all orders is one row per year by then. Days and counterparties that the dimensions lack
    come under nulls.
    """
    dates = dim_date.select(F.col("date_id").cast("date"), "year")
    places = dim_counterparty.select("counterparty_id", F.col("counterparty_legal_country").alias("country"))
    yearly = daily.join(dates, "date_id", "left").groupBy("counterparty_id", "year").agg(F.sum("revenue").alias("revenue"))
    return (
        yearly.join(places, "counterparty_id", "left")
        .groupBy("country", "year")
        .agg(F.sum("revenue").cast(TOTAL).alias("revenue"))
    )
