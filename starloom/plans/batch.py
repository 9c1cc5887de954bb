"""The three stages of a batch, and the batch as a whole."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import Future
from dataclasses import dataclass
from datetime import datetime
from functools import partial, reduce
from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import storage
from starloom.functions.text import CURRENCY_NAMES
from starloom.operators import quality, star
from starloom.operators.numbering import with_dense_key, with_lasting_key
from starloom.session import scratch_path, stage
from starloom.sinks.snapshots import (
    complete_batches,
    each_at_once,
    read_manifest,
    require_incomplete,
    under_way,
    write_batch,
    write_landed,
    write_log,
    write_parquet,
)
from starloom.sinks.warehouse import Warehouse
from starloom.sources.drift import SchemaDrift, source_drift
from starloom.sources.snapshots import read_landed, read_processed
from starloom.sources.tables import Source
from starloom.specs import FACT_KEYS, SALES_NAMES, TARGET_SOURCES, WAREHOUSE, load_order
from starloom.storage import key_path


@dataclass(frozen=True)
class Zones:
    """Where the landed and the processed snapshots live."""

    landed: str
    processed: str


@dataclass(frozen=True)
class Options:
    """How the transforms treat what the two readings of the rules disagree on, and whether keys outlast a batch.

    `lasting_keys`: an order keeps the record key of the batch that first had it. Otherwise keys are dense in every
    batch. `targets`: the warehouse tables of a batch, the sales star or up to all eleven.
    """

    layout: str = "lines"
    raw_escapes: bool = False
    null_safe: bool = False
    quarter: str = "thirds"
    nulls: str = "drop"
    lasting_keys: bool = False
    targets: tuple[str, ...] = tuple(SALES_NAMES)
    currency_names: Mapping[str, str] = MappingProxyType(CURRENCY_NAMES)


class BrokenConstraints(ValueError):
    """A batch that the warehouse would have to refuse; carries the violations."""

    def __init__(self, found: list):
        super().__init__("; ".join(f"{r.table_name}.{r.column_name}: {r.rule} x {r.n}" for r in found))
        self.found = found


def extract_batch(
    spark: SparkSession,
    source: Source,
    zones: Zones,
    batch: str,
    at: datetime,
    tables: Iterable[str] | None = None,
    declared: Mapping[str, str] | None = None,
) -> DataFrame:
    """Land every table of the source as compressed JSON, then its manifest and log. Returns the manifest.

    With `declared` schemas, columns are compared with them first, and SchemaDrift is raised before anything is landed.
    """
    names = list(tables or source.tables())
    if declared is not None:
        # A row for each difference of declared columns comes back.
        found = source_drift(spark, source, names, declared).collect()
        if found:
            raise SchemaDrift(found)
    manifest = write_batch(
        spark, zones.landed, batch, {n: lambda n=n: source.read(n) for n in names}, write_landed, at
    )
    write_log(manifest, zones.landed, at)
    return manifest


def lasting(spark: SparkSession, zone: str, table: str, natural: str, batch: str) -> Callable[..., DataFrame]:
    """Numbers a fact by the keys that complete batches of a zone have given, and stores those that this one adds.

    Every batch stores only its own pairs of keys, beside its tables; an attempt that failed counts for nothing. One
    batch is transformed at a time.
    """
    key = WAREHOUSE[table].key
    paths = [key_path(zone, table, b) for b in complete_batches(spark, zone) if b != batch]
    paths = [path for path in paths if storage.exists(spark, path)]
    known = spark.read.schema(f"{key} BIGINT, {natural} BIGINT").parquet(*paths) if paths else None

    def keep(added: DataFrame) -> DataFrame:
        return stage(added.select(key, F.col(natural).cast("bigint")), key_path(zone, table, batch))

    return partial(with_lasting_key, known=known, keep=keep)


def star_tables(
    sources: Mapping[str, DataFrame],
    options: Options = Options(),
    scratch: str | None = None,
    number: Callable[[str], Callable[..., DataFrame]] = lambda fact: with_dense_key,
) -> dict[str, Callable[[], DataFrame]]:
    """How to build each target of the options. Numbering a fact runs jobs, hence the callables. `number` gives the
    numbering of a fact."""

    def dim_date() -> DataFrame:
        mentioned = [star.days(sources[n], columns) for n, columns in star.FACT_DAYS.items() if n in sources]
        return star.calendar(reduce(DataFrame.union, mentioned), options.quarter, options.nulls)

    def fact(build: Callable[..., DataFrame], source: str, name: str) -> Callable[[], DataFrame]:
        return lambda: build(sources[source], number=number(name), scratch=scratch)

    builders = {
        "dim_date": dim_date,
        "dim_design": lambda: star.dim_design(sources["design"]),
        "dim_location": lambda: star.dim_location(sources["address"]),
        "dim_counterparty": lambda: star.dim_counterparty(
            sources["counterparty"], sources["address"], options.null_safe
        ),
        "dim_staff": lambda: star.dim_staff(sources["staff"], sources["department"], options.null_safe),
        "dim_currency": lambda: star.dim_currency(sources["currency"], dict(options.currency_names)),
        "dim_payment_type": lambda: star.dim_payment_type(sources["payment_type"]),
        "dim_transaction": lambda: star.dim_transaction(sources["transaction"]),
        "fact_sales_order": fact(star.fact_sales_order, "sales_order", "fact_sales_order"),
        "fact_purchase_order": fact(star.fact_purchase_order, "purchase_order", "fact_purchase_order"),
        "fact_payment": fact(star.fact_payment, "payment", "fact_payment"),
    }
    return {name: builders[name] for name in options.targets}


class Awaited(Mapping[str, DataFrame]):
    """Tables by name, some of which are still being made; asking for one of these waits until it is there."""

    def __init__(self, ready: Mapping[str, DataFrame], coming: Mapping[str, Future[DataFrame]]):
        self._ready, self._coming = ready, coming

    def __getitem__(self, name: str) -> DataFrame:
        return self._coming[name].result() if name in self._coming else self._ready[name]

    def __contains__(self, name: object) -> bool:
        return name in self._ready

    def __iter__(self) -> Iterator[str]:
        return iter(self._ready)

    def __len__(self) -> int:
        return len(self._ready)


def transform_batch(
    spark: SparkSession, zones: Zones, batch: str, at: datetime, options: Options = Options()
) -> DataFrame:
    """Build the targets of one landed batch as Parquet. Returns the manifest.

    Sources of facts feed the dates, the counts behind the surrogate key and the fact. They are parsed from JSON
    once, into a Parquet copy whose columns are then read one by one as needed. The copies are made side by side, and each
    target is built as soon as those it reads are there, so no step waits for the last tasks of another that it does not
    need. A set of targets in which one refers to another that is not there is refused.
    """
    require_incomplete(spark, zones.processed, batch)
    load_order(options.targets)
    landed = {
        n: read_landed(spark, zones.landed, batch, n, layout=options.layout, raw_escapes=options.raw_escapes)
        for n in sorted({source for target in options.targets for source in TARGET_SOURCES[target]})
    }
    scratch = scratch_path(spark, f"batch-{batch}")
    try:
        copies = {n: partial(stage, landed[n], f"{scratch}/{n}") for n in star.FACT_DAYS if n in landed}

        def number(fact: str) -> Callable[..., DataFrame]:
            known = options.lasting_keys
            return lasting(spark, zones.processed, fact, FACT_KEYS[fact], batch) if known else with_dense_key

        with under_way(spark, copies) as staged:
            tables = star_tables(Awaited(landed, staged), options, scratch, number)
            return write_batch(spark, zones.processed, batch, tables, write_parquet, at)
    finally:
        storage.discard(spark, scratch)


def targets_of(spark: SparkSession, zones: Zones, batch: str) -> list[str]:
    """The tables of a processed batch, each after those that it refers to."""
    return load_order(sorted(r.table_name for r in read_manifest(spark, zones.processed, batch).collect()))


def check_batch(spark: SparkSession, zones: Zones, batch: str, names: Iterable[str] | None = None) -> DataFrame:
    """Every broken constraint of a processed batch: (table_name, rule, column_name, n)."""
    names = targets_of(spark, zones, batch) if names is None else names
    return quality.violations({n: read_processed(spark, zones.processed, batch, n) for n in names})


def broken_constraints(spark: SparkSession, zones: Zones, batch: str, names: Iterable[str]) -> list:
    """What `check_batch` finds, at most a row per constraint. Tables are checked side by side, each as a job of its own:
    in one job for all, few tasks would be left to the last steps of each."""
    tables = {n: read_processed(spark, zones.processed, batch, n) for n in names}
    checks = [lambda n=n: quality.violations(tables, [n]).collect() for n in tables]
    return [row for rows in each_at_once(spark, checks) for row in rows]


def load_batch(spark: SparkSession, zones: Zones, batch: str, warehouse: Warehouse) -> bool:
    """Replace the warehouse by all tables of a processed batch, unless it holds a newer one already; whether it did.

    All constraints are checked first; a batch that breaks one leaves the warehouse as it was. Loading the batch that
    is there once more is harmless.
    """
    loaded = warehouse.loaded()
    if loaded is not None and batch < loaded:
        return False
    names = targets_of(spark, zones, batch)
    found = broken_constraints(spark, zones, batch, names)
    if found:
        raise BrokenConstraints(found)
    processed = {n: read_processed(spark, zones.processed, batch, n) for n in names}
    tables = {
        n: quality.conform(df, WAREHOUSE[n], checked=True, time_type=warehouse.time_type)
        for n, df in processed.items()
    }
    warehouse.refresh(batch, tables)
    return True


def record_refusal(spark: SparkSession, zones: Zones, batch: str, found: list) -> None:
    """Note why a batch was refused, beside the processed batches."""
    rows = [(batch, r.table_name, r.rule, r.column_name, r.n) for r in found]
    schema = "batch_id STRING, table_name STRING, rule STRING, column_name STRING, n BIGINT"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").json(storage.refusal_path(zones.processed, batch))


def run_batch(
    spark: SparkSession,
    source: Source,
    zones: Zones,
    warehouse: Warehouse,
    at: datetime,
    options: Options = Options(),
) -> str:
    """Extract, transform and load; any failure raises. Returns the batch id."""
    batch = storage.batch_id(at)
    extract_batch(spark, source, zones, batch, at)
    transform_batch(spark, zones, batch, at, options)
    load_batch(spark, zones, batch, warehouse)
    return batch
