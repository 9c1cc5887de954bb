"""Lookups, name filters, record text and manifest text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.dates import STAMP_FORMAT

# Names of the currency codes in use.
CURRENCY_NAMES = {
    "GBP": "Great British Pounds",
    "USD": "United States Dollars",
    "EUR": "Euro",
}

# How records are written as JSON. A bare date is written as its midnight.
JSON_FORMAT = {
    "timestampNTZFormat": STAMP_FORMAT,
    "timestampFormat": STAMP_FORMAT,
    "dateFormat": "yyyy-MM-dd'T00:00:00.000'",
    "ignoreNullFields": "false",
}


def lookup(names: dict[str, str], code: Column) -> Column:
    """The name of a code; NULL for a code without one."""
    return F.element_at(F.create_map(*[F.lit(v) for pair in names.items() for v in pair]), code)


def is_public(name: str) -> Column:
    """True for names that do not start with an underscore."""
    return F.expr(f"`{name}` NOT LIKE '!_%' ESCAPE '!'")


def record_json(df: DataFrame, *columns: str) -> Column:
    """One record as JSON text, nulls kept, timestamps cut to milliseconds."""
    return F.to_json(F.struct(*(columns or df.columns)), JSON_FORMAT)


def doubled_backslashes(value: Column) -> Column:
    return F.replace(value, F.lit("\\"), F.lit("\\\\"))


def upload_line(key: Column, at: Column) -> Column:
    return F.format_string("Uploaded: %s at %s", key, at)


def flat(df: DataFrame) -> DataFrame:
    """Every field of every (nested) struct as a column of its own, named outer.inner."""

    def leaves(fields: list[T.StructField], prefix: tuple[str, ...] = ()):
        for f in fields:
            path = (*prefix, f.name)
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType.fields, path)
            else:
                yield F.col(".".join(f"`{part}`" for part in path)).alias(".".join(path))

    return df.select(*leaves(df.schema.fields))
