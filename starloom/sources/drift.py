"""What a source, or a landed snapshot, holds against what is declared.

Columns are discovered, not only tables. A source tells its columns before anything is landed. A landed snapshot of JSON
lines is asked field by field, as fields that are not declared would vanish without a word when it is read, and fields
that changed their kind would fail.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sources.tables import Source
from starloom.specs import SOURCES

ADDED, MISSING, RETYPED = "added", "missing", "retyped"
DRIFT = "table_name STRING, column_name STRING, change STRING, declared STRING, found STRING"

#: Kinds of JSON values that a declared type takes. A null fits every type.
JSON_KINDS = {
    "int": ("BIGINT",),
    "bigint": ("BIGINT",),
    "double": ("BIGINT", "DECIMAL", "DOUBLE"),
    "string": ("STRING",),
    "boolean": ("BOOLEAN",),
}

#: Types of a source's columns that are landed as a declared type. Moments and days become text.
SOURCE_KINDS = {
    "int": ("tinyint", "smallint", "int"),
    "bigint": ("tinyint", "smallint", "int", "bigint"),
    "double": ("float", "double", "decimal"),
    "string": ("string", "char", "varchar", "date", "timestamp", "timestamp_ntz", "time"),
    "boolean": ("boolean",),
}


class SchemaDrift(ValueError):
    """A source that is not as declared; carries the differences."""

    def __init__(self, found: list):
        super().__init__("; ".join(f"{r.table_name}.{r.column_name or '*'} {r.change}" for r in found))
        self.found = found


def declared_columns(ddl: str) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(ddl).fields}


def _family(kind: str) -> str:
    return kind.split("(")[0].split("<")[0]


def source_drift(
    spark: SparkSession, source: Source, names: Iterable[str] | None = None, declared: Mapping[str, str] = SOURCES
) -> DataFrame:
    """table_name, column_name, change, declared, found: of tables and columns that differ. Reads no rows.

    A whole table that is added or missing has one row without a column. Tables not in `names` are not looked at, if
    `names` is given. Names are compared without regard to case.
    """
    present, rows = source.tables(), []
    wanted = list(declared) if names is None else list(names)
    for table in sorted({*wanted, *(present if names is None else ())}):
        if table not in present:
            rows.append((table, None, MISSING, None, None))
        elif table not in declared:
            rows.append((table, None, ADDED, None, None))
        else:
            own = {name.lower(): kind for name, kind in declared_columns(declared[table]).items()}
            found = {name.lower(): kind for name, kind in source.columns(table).items()}
            for name in sorted({*own, *found}):
                if name not in found:
                    rows.append((table, name, MISSING, own[name], None))
                elif name not in own:
                    rows.append((table, name, ADDED, None, found[name]))
                elif _family(found[name]) not in SOURCE_KINDS.get(own[name], (own[name],)):
                    rows.append((table, name, RETYPED, own[name], found[name]))
    return spark.createDataFrame(rows, DRIFT)


def fields(spark: SparkSession, path: str) -> DataFrame:
    """column_name, kind, n: top-level fields of records in JSON lines, by kind of value, with their numbers of records.

    One scan; fields collapse before they are exchanged. Lines that are not JSON fail it; records that are not objects
    have no fields.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    each = spark.sql(
        "SELECT f.key AS column_name, schema_of_variant(f.value) AS kind FROM {lines}, "
        "LATERAL variant_explode(parse_json(value)) AS f",
        lines=lines,
    )
    kind = F.regexp_extract("kind", "^[A-Z]+", 0).alias("kind")
    return each.where("column_name IS NOT NULL").groupBy("column_name", kind).agg(F.count(F.lit(1)).alias("n"))


def landed_drift(spark: SparkSession, path: str, declared: str) -> DataFrame:
    """column_name, change, declared, found, n: fields of a landed snapshot that are not as declared.

    n: records that have a field which is added or of another kind; records without a field that is missing in some or all.
    """
    own = spark.createDataFrame(list(declared_columns(declared).items()), "column_name string, declared string")
    takes = F.create_map(
        *[x for kind, taken in JSON_KINDS.items() for x in (F.lit(kind), F.array(*map(F.lit, ("VOID", *taken))))]
    )
    found = fields(spark, path)
    joined = found.join(F.broadcast(own), "column_name", "left")
    # Types without a fixed list of kinds, such as arrays, take any value.
    fits = F.coalesce(F.array_contains(F.try_element_at(takes, F.col("declared")), F.col("kind")), F.lit(True))
    wrong = joined.where(F.col("declared").isNull() | ~fits).select(
        "column_name",
        F.when(F.col("declared").isNull(), ADDED).otherwise(RETYPED).alias("change"),
        "declared",
        F.col("kind").alias("found"),
        "n",
    )
    records = spark.read.text(path).where(F.trim("value") != "").agg(F.count(F.lit(1)).alias("records"))
    held = found.groupBy("column_name").agg(F.sum("n").alias("held"))
    absent = own.join(held, "column_name", "left").join(F.broadcast(records))
    absent = absent.withColumn("n", F.col("records") - F.coalesce("held", F.lit(0))).where("n > 0")
    missing = absent.select("column_name", F.lit(MISSING).alias("change"), "declared", F.lit(None).cast("string").alias("found"), "n")
    return wrong.unionByName(missing)
