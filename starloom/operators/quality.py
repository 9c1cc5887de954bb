"""Warehouse constraints as queries: each check returns what breaks the constraint."""

from __future__ import annotations

import re
from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.dates import try_date, try_time
from starloom.specs import WAREHOUSE, ForeignKey, Table
# Spark's names of the declared types that need no conversion when a column has them already.
TYPE_NAMES = {"INT": "integer", "BIGINT": "long", "STRING": "string", "BOOLEAN": "boolean", "DATE": "date"}


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once. Counts are combined before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with <column>_nulls for every column, from one scan."""
    return df.agg(*[F.expr(f"count_if(`{c}` IS NULL)").alias(f"{c}_nulls") for c in columns])


def overflows(df: DataFrame, value: Column, kind: str) -> Column:
    """True where a number, rounded half up, does not fit a type such as decimal(10,2).

    For doubles this is a comparison with the first value that rounds up to too many digits. It is exact,
    far cheaper than a cast that fails, and can be pushed to the scan.
    """
    if not isinstance(df.select(value).schema[0].dataType, T.DoubleType):
        return value.isNotNull() & value.try_cast(kind).isNull()
    precision, scale = (int(n) for n in re.findall(r"\d+", kind))
    limit = float(Decimal(10) ** (precision - scale) - Decimal(5) * Decimal(10) ** (-scale - 1))
    return (value >= limit) | (value <= -limit)


def numeric_misfits(df: DataFrame, value: Column, kind: str = "decimal(10,2)") -> DataFrame:
    """Rows whose number overflows the declared type."""
    return df.where(overflows(df, value, kind))


def date_misfits(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull() & try_date(column).isNull())


def time_misfits(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull() & try_time(column).isNull())


def orphan_rows(df: DataFrame, column: str, dimension: DataFrame, key: str) -> DataFrame:
    """Rows whose reference is missing from the dimension; a null reference is no violation.

    The distinct references are checked first. They collapse before the shuffle, so a hot reference costs
    nothing, and the wide rows meet only the references that failed, as a rule few enough to broadcast.
    """
    missing = (
        df.select(F.col(column).alias("_missing"))
        .where(F.col("_missing").isNotNull())
        .distinct()
        .join(dimension.select(F.col(key).alias("_key")), F.col("_missing") == F.col("_key"), "left_anti")
    )
    return df.join(missing, df[column] == missing["_missing"], "left_semi")


def _alike_counts(df: DataFrame, kinds: dict[str, str | None]) -> list[tuple[list[str], DataFrame]]:
    """For the columns that are alike in type and declared type: their names, and (_column, missing, value, n) by the
    position of the name, in the declared type. One scan of just these columns each; values are combined before the
    shuffle, so what moves is distinct values in their own type.
    """
    types = dict(df.dtypes)
    alike: dict[tuple[str, str | None], list[str]] = {}
    for column, kind in kinds.items():
        alike.setdefault((types[column], kind), []).append(column)
    counted = []
    for (_, kind), columns in alike.items():
        each = df.select(F.posexplode(F.array(*columns)).alias("_column", "_value"))
        grouped = each.groupBy("_column", "_value").agg(F.count(F.lit(1)).alias("n"))
        value = converted(grouped, "_value", kind) if kind else F.col("_value")
        missing = F.col("_value").isNull().alias("missing")
        counted.append((columns, grouped.select("_column", missing, value.alias("value"), "n")))
    return counted


def _name(columns: Sequence[str]) -> Column:
    """The name at the position `_column`."""
    return F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("_column") + 1).alias("column_name")


def value_counts(df: DataFrame, kinds: dict[str, str | None]) -> DataFrame:
    """(column_name, missing, value, n): how often every value of every column occurs, as text.

    A value that does not fit its declared type is NULL without being `missing`.
    """
    return reduce(
        DataFrame.unionByName,
        [
            each.select(_name(columns), "missing", F.col("value").cast("string"), "n")
            for columns, each in _alike_counts(df, kinds)
        ],
    )


def judged_references(df: DataFrame, spec: Table, dimensions: dict[str, DataFrame]) -> DataFrame:
    """(rule, column_name, n) for every value of a reference, where the rule is NULL for those that are sound.

    Values meet the keys of the dimensions in the type that both have, so they stay where they were counted; only
    where the types differ are they compared as text.
    """
    references = {r.column: r for r in spec.foreign_keys}
    found = []
    for columns, used in _alike_counts(df, {c.name: c.type for c in spec.columns if c.name in references}):
        positions: dict[tuple[str, str], list[int]] = {}
        for i, column in enumerate(columns):
            positions.setdefault((references[column].table, references[column].key), []).append(i)
        keys = [dimensions[table].select(F.col(key).alias("value")) for table, key in positions]
        if {k.schema["value"].dataType for k in keys} != {used.schema["value"].dataType}:
            keys = [k.select(F.col("value").cast("string")) for k in keys]
            used = used.withColumn("value", F.col("value").cast("string"))
        known = reduce(
            DataFrame.unionByName,
            [
                k.select(F.explode(F.array(*[F.lit(i) for i in at])).alias("_column"), "value")
                for k, at in zip(keys, positions.values(), strict=True)
            ],
        ).withColumn("known", F.lit(True))
        # A key that a broken dimension repeats only multiplies rows that are no violations.
        judged = used.join(known, ["_column", "value"], "left")
        rule = F.expr(
            "CASE WHEN missing THEN 'not_null' WHEN value IS NULL THEN 'type' WHEN known IS NULL THEN 'foreign_key' END"
        )
        found.append(judged.select(rule.alias("rule"), _name(columns), "n"))
    return reduce(DataFrame.unionByName, found)


def known_references(references: Sequence[ForeignKey], dimensions: dict[str, DataFrame]) -> DataFrame:
    """(column_name, value) for every value that a reference may take."""
    columns = {}
    for r in references:
        columns.setdefault((r.table, r.key), []).append(f"'{r.column}'")
    known = [
        dimensions[table].selectExpr(f"explode(array({', '.join(names)})) AS column_name", f"string(`{key}`) AS value")
        for (table, key), names in columns.items()
    ]
    return reduce(DataFrame.unionByName, known)


def orphan_counts(df: DataFrame, references: Sequence[ForeignKey], dimensions: dict[str, DataFrame]) -> DataFrame:
    """(column_name, value, n) for every missing reference of every column."""
    used = value_counts(df, {r.column: None for r in references}).where("value IS NOT NULL").drop("missing")
    return used.join(known_references(references, dimensions), ["column_name", "value"], "left_anti")


def same_type(df: DataFrame, column: str, kind: str) -> bool:
    return df.schema[column].dataType.typeName() == TYPE_NAMES.get(kind)


def converted(df: DataFrame, column: str, kind: str, checked: bool = False) -> Column:
    """A column as its warehouse type. A value that does not fit becomes NULL, or raises if `checked`."""
    value = F.col(column)
    if same_type(df, column, kind):
        return value
    if kind == "TIME":
        return value if checked else try_time(column).alias(column)
    if kind == "DATE":
        return (F.substring(column, 1, 10).cast("date") if checked else try_date(column)).alias(column)
    if checked:
        return value.cast(kind).alias(column)
    if kind.startswith("DECIMAL"):
        return F.when(~overflows(df, value, kind), value.cast(kind)).alias(column)
    return value.try_cast(kind).alias(column)


def misfits(df: DataFrame, column: str, kind: str) -> Column:
    """True where a value does not fit its warehouse type."""
    if kind.startswith("DECIMAL"):
        return overflows(df, F.col(column), kind)
    return F.col(column).isNotNull() & converted(df, column, kind).isNull()


def conform(
    df: DataFrame,
    spec: Table,
    columns: Sequence[str] | None = None,
    checked: bool = False,
    time_type: bool = False,
) -> DataFrame:
    """The declared columns in declared types and order.

    A value that does not fit becomes NULL; for tables that passed their checks, `checked` converts at
    less cost and raises instead. `time_type` turns times from text into TIME(3), for sessions with
    spark.sql.timeType.enabled.
    """
    kinds = {c.name: c.type for c in spec.columns if columns is None or c.name in columns}
    ready = df.select(*[converted(df, name, kind, checked) for name, kind in kinds.items()])
    if time_type:
        ready = ready.withColumns({n: F.col(n).cast("time(3)") for n, kind in kinds.items() if kind == "TIME"})
    return ready


def findings(df: DataFrame, spec: Table, tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rule, column_name, n), to be summed, for the broken constraints of one table.

    References are judged by their distinct values, which answers not_null, type and foreign_key for them
    at once. All other columns share one scan, and the primary key has one grouping. `tables` holds the
    referenced dimensions, before conversion too.
    """
    references = {r.column: r for r in spec.foreign_keys}
    plain = [c for c in spec.columns if c.name not in references]
    rules = [("not_null", c.name, F.expr(f"count_if(`{c.name}` IS NULL)")) for c in plain if not c.nullable]
    rules += [
        ("type", c.name, F.count_if(misfits(df, c.name, c.type))) for c in plain if not same_type(df, c.name, c.type)
    ]
    labelled = ", ".join(f"'{rule}', '{name}', m{i}" for i, (rule, name, _) in enumerate(rules))
    found = df.agg(*[count.alias(f"m{i}") for i, (_, _, count) in enumerate(rules)]).selectExpr(
        f"stack({len(rules)}, {labelled}) AS (rule, column_name, n)"
    )

    keys = conform(df, spec, [spec.key]).where(f"`{spec.key}` IS NOT NULL")
    repeated = duplicate_keys(keys, [spec.key])
    found = found.unionByName(repeated.selectExpr("'primary_key' AS rule", f"'{spec.key}' AS column_name", "1L AS n"))

    if references:
        dimensions = {r.table: conform(tables[r.table], WAREHOUSE[r.table], [r.key]) for r in spec.foreign_keys}
        judged = judged_references(df, spec, dimensions)
        found = found.unionByName(judged.where("rule IS NOT NULL"))
    return found.selectExpr(f"'{spec.name}' AS table_name", "rule", "column_name", "n")


def violations(tables: dict[str, DataFrame], names: Sequence[str] | None = None) -> DataFrame:
    """(table_name, rule, column_name, n) for every broken constraint of the named warehouse tables.

    `tables` holds them and the dimensions they refer to, all before conversion.
    """
    found = reduce(DataFrame.unionByName, [findings(tables[n], WAREHOUSE[n], tables) for n in names or tables])
    return found.groupBy("table_name", "rule", "column_name").agg(F.sum("n").alias("n")).where("n > 0")
