"""Facts in folders by month, of which a refresh rewrites the changed ones only.

Every version of a fact has a list of its months: for each the version that wrote its files, its rows, and a
fingerprint of them. A refresh takes the fingerprints of the new rows in one pass, writes the months that differ, and
lists the others where they are. Readers open exactly the listed folders, so a version is whole whatever is
written beside it, and Spark prunes them by month.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.storage import discard

#: The folders' name, and a column that readers get besides the fact's own. The date dimension has a `month` of its own.
MONTH = "in_month"
LISTED = f"{MONTH} INT, version STRING, n BIGINT, sum DECIMAL(38,0), mix BIGINT"
#: A month of no day. Its rows have a null date.
NO_MONTH = 0


def month_of(day: Column | str) -> Column:
    """The month as a whole number, such as 202403."""
    day = F.col(day) if isinstance(day, str) else day
    return F.coalesce(F.year(day) * 100 + F.month(day), F.lit(NO_MONTH)).alias(MONTH)


def fingerprints(df: DataFrame, day: str) -> DataFrame:
    """(in_month, n, sum, mix) of the rows of every month, whatever their order: 128 bits of two hashes, in one hash
    aggregate. Nulls count by their place."""
    places = [F.col(c) for c in df.columns] + [F.col(c).isNull() for c in df.columns]
    return df.groupBy(month_of(day)).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64(*places).cast("decimal(20,0)")).cast("decimal(38,0)").alias("sum"),
        F.bit_xor(F.xxhash64(F.lit(1), *places)).alias("mix"),
    )


@dataclass
class MonthFolders:
    """One fact under `root`: files at version=.../in_month=..., lists of months at listed/<version>."""

    spark: SparkSession
    root: str
    day: str

    def _files(self, version: str) -> str:
        return f"{self.root}/files/version={version}"

    def listed(self, version: str) -> DataFrame:
        """The months of a version, and which version wrote each."""
        return self.spark.read.schema(LISTED).parquet(f"{self.root}/listed/{version}")

    def write(self, version: str, df: DataFrame, before: str | None) -> None:
        """Write the months of `df` that differ from those of the version before, and list all of them.

        Rows of a month are spread over as many tasks as their size asks for. A month that has no row any more is
        not listed.
        """
        clash = [c for c in df.columns if c.lower() in (MONTH, "version")]
        if clash:
            raise ValueError(f"columns named as the folders are: {', '.join(clash)}")
        new = fingerprints(df, self.day).withColumn("version", F.lit(version))
        if before is not None:
            old = self.listed(before).withColumnRenamed("version", "written")
            same = [MONTH, "n", "sum", "mix"]
            new = new.join(old, same, "left").withColumn("version", F.coalesce("written", "version"))
        listed = new.select(*T.StructType.fromDDL(LISTED).names)
        listed.coalesce(1).write.parquet(f"{self.root}/listed/{version}")
        # One number a month, of at most some hundreds in a century's facts.
        changed = [r[MONTH] for r in self.listed(version).where(F.col("version") == version).select(MONTH).collect()]
        if changed:
            rows = df.withColumn(MONTH, month_of(self.day)).where(F.col(MONTH).isin(changed))
            rows.hint("rebalance", MONTH).write.partitionBy(MONTH).parquet(self._files(version))
        self.spark.createDataFrame([(df.schema.json(),)], "schema STRING").coalesce(1).write.parquet(
            f"{self.root}/schemas/{version}"
        )

    def table(self, version: str) -> DataFrame:
        """The rows of a version, with their month."""
        schema = T.StructType.fromJson(json.loads(self.spark.read.parquet(f"{self.root}/schemas/{version}").first().schema))
        whole = T.StructType([*schema.fields, T.StructField(MONTH, T.IntegerType())])
        paths = [f"{self._files(r.version)}/{MONTH}={r[MONTH]}" for r in self.listed(version).collect()]
        if not paths:
            return self.spark.createDataFrame([], whole)
        # The folders' names are columns too.
        known = T.StructType([*whole.fields, T.StructField("version", T.StringType())])
        return self.spark.read.schema(known).option("basePath", f"{self.root}/files").parquet(*paths).drop("version")

    def drop(self, version: str, keep: list[str]) -> None:
        """Remove a version, but for the folders that versions to keep list too."""
        mine = {(r[MONTH], r.version) for r in self.listed(version).collect()}
        for other in keep:
            mine -= {(r[MONTH], r.version) for r in self.listed(other).collect()}
        for month, written in mine:
            discard(self.spark, f"{self._files(written)}/{MONTH}={month}")
        for kind in ("listed", "schemas"):
            discard(self.spark, f"{self.root}/{kind}/{version}")


def of_days(fact: DataFrame, day: str, dates: DataFrame) -> DataFrame:
    """The rows of a month-foldered fact on some days of the date dimension, with the columns of both.

    The join is by month too, so that Spark reads the folders of these days' months only.
    """
    days = dates.withColumn("_in_month", month_of("date_id")).withColumnRenamed("date_id", "_day")
    return fact.join(days, (fact[MONTH] == days["_in_month"]) & (fact[day] == days["_day"])).drop("_in_month", "_day")
