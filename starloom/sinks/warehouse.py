"""Full-refresh sinks for the warehouse: Parquet folders, catalog tables, or a database over JDBC.

A refresh is written beside what is there and takes its place by one switch at the end. Until then, and if it
breaks off, readers see the old star whole. The warehouse knows which batch it holds.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from starloom.sinks.months import MonthFolders
from starloom.sinks.snapshots import each_at_once
from starloom.specs import SALES_NAMES, WAREHOUSE, load_order
from starloom.storage import children, create, discard

# Types that databases name otherwise.
SQL_TYPES = {"STRING": "TEXT"}
POINTER = "batch_id STRING, version STRING, switched BIGINT"


class Warehouse(Protocol):
    time_type: bool

    def loaded(self) -> str | None:
        """The batch that readers see."""
        ...

    def refresh(self, batch: str, tables: dict[str, DataFrame]) -> None: ...

    def table(self, name: str) -> DataFrame: ...


class LostRace(RuntimeError):
    """Another refresh switched the warehouse while this one was being written; nothing of this one is seen."""


class Versioned:
    """Keeps a version of all tables per refresh, and a numbered pointer per switch. Readers follow the last one.

    A refresh notes the last number when it begins, and ends by creating the next one, which must not be there: of two
    refreshes at the same time one wins and the other raises LostRace. So a batch only ever follows one that it
    has seen, and an older one is refused. The version before is kept for those who still read it.
    """

    spark: SparkSession

    def _numbers(self) -> list[int]:
        """Numbers of all pointers that are kept, in order."""
        ...

    def _pointer(self, number: int) -> Row | None: ...

    def _switch(self, number: int, batch: str, version: str) -> bool:
        """Create the pointer of a number; whether it was not there before."""
        ...

    def _write(self, version: str, name: str, df: DataFrame) -> None: ...

    def _drop(self, version: str, names: list[str]) -> None: ...

    def _newest(self, n: int) -> list[Row]:
        """The last pointers, newest first. One that a writer has only just created may still be empty."""
        found: list[Row] = []
        for number in reversed(self._numbers()):
            pointer = self._pointer(number)
            if pointer is not None:
                found.append(pointer)
            if len(found) == n:
                break
        return found

    def loaded(self) -> str | None:
        newest = self._newest(1)
        return newest[0].batch_id if newest else None

    def version(self) -> str:
        newest = self._newest(1)
        if not newest:
            raise LookupError("no batch has been loaded yet")
        return newest[0].version

    def refresh(self, batch: str, tables: dict[str, DataFrame]) -> None:
        number = max(self._numbers(), default=0) + 1
        before = self._newest(2)
        if before and batch < before[0].batch_id:
            raise LostRace(f"batch {before[0].batch_id} is loaded, which is newer than {batch}")
        version = f"{batch}_{uuid.uuid4().hex[:8]}"
        each_at_once(self.spark, [lambda n=n, df=df: self._write(version, n, df) for n, df in tables.items()])
        if not self._switch(number, batch, version):
            self._drop(version, list(tables))
            raise LostRace(f"another refresh made switch {number} before batch {batch}")
        for old in before[1:]:
            self._drop(old.version, list(tables))


@dataclass
class FolderWarehouse(Versioned):
    """Pointers are small files, each created by an exclusive call of the file system.

    `by_month` names facts and the day that they are kept in folders by: a refresh writes their changed months only, and
    `table` gives them with a month, for pruning. Keys that are numbered anew by every batch change all months; take
    lasting ones.
    """

    spark: SparkSession
    root: str
    time_type: bool = False
    by_month: Mapping[str, str] = field(default_factory=dict)

    def months(self, name: str) -> MonthFolders:
        return MonthFolders(self.spark, f"{self.root}/months/{name}", self.by_month[name])

    def _numbers(self) -> list[int]:
        names = children(self.spark, f"{self.root}/switches")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _pointer(self, number: int) -> Row | None:
        return self.spark.read.schema(POINTER).json(f"{self.root}/switches/{number:012d}.json").first()

    def _switch(self, number: int, batch: str, version: str) -> bool:
        line = json.dumps({"batch_id": batch, "version": version, "switched": number})
        return create(self.spark, f"{self.root}/switches/{number:012d}.json", line + "\n")

    def _write(self, version: str, name: str, df: DataFrame) -> None:
        if name in self.by_month:
            # If another refresh has switched since this one began, this one loses anyway.
            shared = [p.version for p in self._newest(1) if p.version in self._listed(name)]
            self.months(name).write(version, df, shared[0] if shared else None)
        else:
            df.write.parquet(f"{self.root}/versions/{version}/{name}")

    def _listed(self, name: str) -> set[str]:
        return set(children(self.spark, f"{self.root}/months/{name}/listed"))

    def _drop(self, version: str, names: list[str]) -> None:
        """Remove a version, but for months that the last two list too."""
        kept = {p.version for p in self._newest(2)} - {version}
        for name in self.by_month:
            listed = self._listed(name)
            if version in listed:
                self.months(name).drop(version, sorted(kept & listed))
        discard(self.spark, f"{self.root}/versions/{version}")

    def table(self, name: str) -> DataFrame:
        if name in self.by_month:
            return self.months(name).table(self.version())
        return self.spark.read.parquet(f"{self.root}/versions/{self.version()}/{name}")


@dataclass
class CatalogWarehouse(Versioned):
    """A table per version, and one per pointer, whose name the catalog gives once. The view of a table's name follows
    after the switch, for readers by SQL."""

    spark: SparkSession
    database: str
    time_type: bool = False

    def _name(self, name: str, version: str) -> str:
        return f"{self.database}.{name}__{version}"

    def _numbers(self) -> list[int]:
        names = [t.name for t in self.spark.catalog.listTables(self.database, "switch__*")]
        return sorted(int(n.removeprefix("switch__")) for n in names)

    def _pointer(self, number: int) -> Row | None:
        return self.spark.table(self._name("switch", f"{number:012d}")).first()

    def _switch(self, number: int, batch: str, version: str) -> bool:
        pointer = self.spark.createDataFrame([(batch, version, number)], POINTER)
        try:
            pointer.coalesce(1).write.mode("errorifexists").saveAsTable(self._name("switch", f"{number:012d}"))
        except AnalysisException as refused:
            if "ALREADY_EXISTS" in (refused.getCondition() or ""):
                return False
            raise
        return True

    def _write(self, version: str, name: str, df: DataFrame) -> None:
        df.write.saveAsTable(self._name(name, version))

    def _drop(self, version: str, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(name, version)}")

    def refresh(self, batch: str, tables: dict[str, DataFrame]) -> None:
        super().refresh(batch, tables)
        for name in tables:
            version = self._name(name, self.version())
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.database}.{name} AS SELECT * FROM {version}")

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self._name(name, self.version()))


@dataclass
class JdbcWarehouse:
    """Bulk inserts into staging tables, then one statement that the database runs as a transaction.

    That statement empties the facts of the batch, brings the dimensions up to date by key and fills the facts again,
    with each column cast to its declared type. Nothing cascades: facts outside the batch keep their rows, and if one
    of them refers to a row that is gone, the database refuses the whole refresh.
    """

    spark: SparkSession
    url: str
    options: dict[str, str] = field(default_factory=dict)
    batch_rows: int = 10_000
    connections: int = 16
    time_type: bool = False

    STAGING = "__new"
    LOADED = "loaded_batch"

    def _options(self, name: str) -> dict[str, object]:
        return {"url": self.url, "dbtable": name, **self.options}

    def _write(self, name: str, df: DataFrame) -> None:
        settings = {"batchsize": self.batch_rows, "numPartitions": self.connections}
        df.write.format("jdbc").mode("overwrite").options(**self._options(name), **settings).save()

    def _execute(self, statement: str) -> None:
        """Run a statement through the hook that the reader offers for each session; the query itself is a formality."""
        settings = {"url": self.url, "query": "SELECT 1 AS done", "sessionInitStatement": statement, **self.options}
        self.spark.read.format("jdbc").options(**settings).load().collect()

    def loaded(self) -> str | None:
        self._execute(f"CREATE TABLE IF NOT EXISTS {self.LOADED} (batch_id TEXT)")
        return self.table(self.LOADED).agg(F.max("batch_id")).first()[0]

    def statement(self, batch: str, names: list[str]) -> str:
        facts = [n for n in names if WAREHOUSE[n].foreign_keys]
        dimensions = [n for n in names if n not in facts]
        steps = ["BEGIN", *[f"DELETE FROM {n}" for n in facts]]
        for name in load_order(names):
            spec, staged = WAREHOUSE[name], name + self.STAGING
            insert = (
                f"INSERT INTO {name} ({', '.join(spec.names)}) "
                f"SELECT {', '.join(f'CAST({c.name} AS {SQL_TYPES.get(c.type, c.type)})' for c in spec.columns)} FROM {staged}"
            )
            if name in dimensions:
                gone = f"NOT EXISTS (SELECT 1 FROM {staged} s WHERE s.{spec.key} = {name}.{spec.key})"
                steps.append(f"DELETE FROM {name} WHERE {gone}")
                changed = ", ".join(f"{c} = EXCLUDED.{c}" for c in spec.names[1:])
                insert += f" ON CONFLICT ({spec.key}) DO UPDATE SET {changed}"
            steps.append(insert)
        steps += [f"DELETE FROM {self.LOADED}", f"INSERT INTO {self.LOADED} VALUES ('{batch}')"]
        return "; ".join([*steps, "COMMIT"])

    def refresh(self, batch: str, tables: dict[str, DataFrame]) -> None:
        each_at_once(self.spark, [lambda n=n, df=df: self._write(n + self.STAGING, df) for n, df in tables.items()])
        self._execute(self.statement(batch, list(tables)))

    def table(self, name: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self._options(name)).load()


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n) per table."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
            for name, df in tables.items()
        ],
    )


def dump(warehouse: Warehouse, names: list[str] = SALES_NAMES) -> dict[str, DataFrame]:
    """Every warehouse table by name."""
    return {name: warehouse.table(name) for name in names}


def preview(df: DataFrame, key: str, rows: int = 10) -> DataFrame:
    """The first rows by key: a distributed top-k, not a sort."""
    return df.orderBy(key).limit(rows)
