"""Operational sources to extract from: the session catalog, or a database over JDBC."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import and_
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.text import is_public
from starloom.specs import SOURCES
from starloom.storage import children


class Source(Protocol):
    def tables(self) -> list[str]: ...

    def columns(self, table: str) -> dict[str, str]:
        """Types by column name, without reading rows."""
        ...

    def read(self, table: str) -> DataFrame: ...


def types_of(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


@dataclass
class FrameSource:
    """Tables given as DataFrames; names that start with an underscore are internal."""

    frames: dict[str, DataFrame]

    def tables(self) -> list[str]:
        return [name for name in self.frames if not name.startswith("_")]

    def columns(self, table: str) -> dict[str, str]:
        return types_of(self.frames[table])

    def read(self, table: str) -> DataFrame:
        return self.frames[table]


@dataclass
class CatalogSource:
    """Tables and views of one catalog schema."""

    spark: SparkSession
    database: str | None = None

    def tables(self) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(self.database) if not t.name.startswith("_"))

    def columns(self, table: str) -> dict[str, str]:
        return types_of(self.read(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{table}" if self.database else table)


@dataclass
class FolderSource:
    """Tables that lie in one folder, each in a file or folder of its own: JSON lines, CSV with a header, or Parquet.

    A table's name is that of its file without the ending. Schemas are declared; a table without one is named, but cannot be
    read. Parquet tells its own.
    """

    spark: SparkSession
    root: str
    format: str = "json"
    schemas: Mapping[str, str] = field(default_factory=lambda: SOURCES)

    ENDINGS = {"json": (".jsonl", ".json", ""), "csv": (".csv", ""), "parquet": (".parquet", "")}

    def _files(self) -> dict[str, str]:
        found = {}
        for name in sorted(children(self.spark, self.root)):
            ending = next(e for e in self.ENDINGS[self.format] if name.endswith(e))
            if not name.startswith(("_", ".")) and (ending or "." not in name):
                found[name.removesuffix(ending)] = f"{self.root.rstrip('/')}/{name}"
        return found

    def tables(self) -> list[str]:
        return list(self._files())

    def columns(self, table: str) -> dict[str, str]:
        return types_of(self.read(table))

    def read(self, table: str) -> DataFrame:
        path = self._files()[table]
        if self.format == "parquet":
            return self.spark.read.parquet(path)
        reader = self.spark.read.schema(self.schemas[table])
        options = {"mode": "FAILFAST", **({"header": True} if self.format == "csv" else {})}
        return reader.options(**options).format(self.format).load(path)


class UnknownKey(ValueError):
    """A table whose scan cannot be divided, as no key of it is known."""


@dataclass
class JdbcSource:
    """Tables of one database schema, each read by `partitions` parallel scans.

    A scan is divided by the table's key: the one given in `keys`, or the first declared column of an operational
    table. Whole-number keys are cut where the database counts equal shares of the rows, so that clustered keys make
    no hot partition; other keys by a hash that the database computes. A table without a known key is refused
    unless `whole` names it, which reads it in one task. Filters and column selections on the result are
    pushed to the database. A failing table raises.
    """

    spark: SparkSession
    url: str
    options: dict[str, str] = field(default_factory=dict)
    database_schema: str = "public"
    keys: dict[str, str] = field(default_factory=dict)
    whole: frozenset[str] = frozenset()
    partitions: int = 32
    fetch_rows: int = 10_000
    #: A non-negative whole number from the key, in the database's own dialect.
    hash_expression: str = "abs(hashtext(CAST({key} AS TEXT)) % {n})"

    def _load(self, **options) -> DataFrame:
        settings = {"url": self.url, "fetchsize": self.fetch_rows, **self.options, **options}
        return self.spark.read.format("jdbc").options(**settings).load()

    def _divided(self, table: str, predicates: list[str]) -> DataFrame:
        settings = {"fetchsize": str(self.fetch_rows), **self.options}
        return self.spark.read.jdbc(self.url, table, predicates=predicates, properties=settings)

    def tables(self) -> list[str]:
        names = self._load(dbtable="information_schema.tables")
        mine = (F.col("table_schema") == self.database_schema) & is_public("table_name")
        return [r.table_name for r in names.where(mine).select("table_name").orderBy("table_name").collect()]

    def columns(self, table: str) -> dict[str, str]:
        return types_of(self._load(query=f"SELECT * FROM {self.database_schema}.{table} WHERE 1 = 0"))

    def key(self, table: str) -> str:
        known = self.keys.get(table) or (SOURCES[table].split()[0] if table in SOURCES else None)
        if known is None:
            raise UnknownKey(f"no key of {table} is known to divide its scan by; name one, or read it whole")
        return known

    def predicates(self, table: str) -> list[str]:
        """Conditions that together hold for every row once."""
        key, name = self.key(table), f"{self.database_schema}.{table}"
        kind = self._load(query=f"SELECT {key} FROM {name} WHERE 1 = 0").schema[0].dataType
        if not isinstance(kind, T.IntegralType):
            part = self.hash_expression.format(key=key, n=self.partitions)
            return [f"{key} IS NULL", *[f"{part} = {i}" for i in range(self.partitions)]]
        shares = f"SELECT {key}, ntile({self.partitions}) OVER (ORDER BY {key}) AS part FROM {name} WHERE {key} IS NOT NULL"
        query = f"SELECT max({key}) AS upper FROM ({shares}) shares GROUP BY part"
        # One row per share comes back.
        uppers = sorted({r.upper for r in self._load(query=query).collect()})[:-1]
        if not uppers:
            return ["1 = 1"]
        between = [f"{key} > {low} AND {key} <= {high}" for low, high in zip(uppers, uppers[1:])]
        return [f"{key} <= {uppers[0]} OR {key} IS NULL", *between, f"{key} > {uppers[-1]}"]

    def read(self, table: str) -> DataFrame:
        name = f"{self.database_schema}.{table}"
        if table in self.whole:
            return self._load(dbtable=name)
        return self._divided(name, self.predicates(table))


def changed_since(df: DataFrame, watermark: Column | str, column: str = "last_updated") -> DataFrame:
    """Rows updated after the watermark. The comparison reaches the scan."""
    return df.where(F.col(column) > watermark)


def latest_per_key(df: DataFrame, keys: list[str], *order_by: str) -> DataFrame:
    """The newest version of every key: the one with the greatest `order_by`, column by column, nulls least.

    Of versions that are equal in these, the one with the greatest hash of all columns; copies of it are one. A hash
    aggregate of keys and the first order column finds the greatest values, so versions collapse before the shuffle.
    Only rows that have their key's greatest value go on; ties among them are settled by a second aggregate, which
    collapses them before its shuffle too. So `df` is scanned twice, and a key with very many versions never meets
    in one task.
    """
    first, rest = order_by[0], order_by[1:]
    newest = df.groupBy(*keys).agg(F.max(first).alias(first))
    kept = _same(df, newest, [*keys, first])
    rank = F.struct(*[F.col(c) for c in rest], F.xxhash64(*df.columns).alias("_hash"))
    best = kept.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), rank).alias("_best"))
    return best.select("_best.*")


def _same(rows: DataFrame, wanted: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose values in the columns, nulls included, are among the wanted ones."""
    renamed = wanted.select(*[F.col(c).alias(f"_wanted_{c}") for c in columns])
    return rows.join(renamed, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_wanted_{c}")) for c in columns]), "left_semi")
