"""Command line: one stage, a whole batch, or the streams.

    spark-submit ... -m starloom run --landed URI --processed URI --warehouse URI --jdbc-url URL
"""

from __future__ import annotations

import argparse
import os
from datetime import datetime

from pyspark.sql import SparkSession

from starloom import storage
from starloom.functions.dates import QUARTERS
from starloom.plans.batch import Options, Zones, extract_batch, load_batch, run_batch, transform_batch
from starloom.session import session
from starloom.sinks.warehouse import CatalogWarehouse, FolderWarehouse, JdbcWarehouse, Warehouse
from starloom.sources.snapshots import LAYOUTS
from starloom.sources.tables import CatalogSource, JdbcSource
from starloom.streaming.arrivals import load_arrivals, transform_arrivals

STAGES = ("extract", "transform", "load", "run", "stream")


def login(prefix: str) -> dict[str, str]:
    found = {name: os.environ.get(f"{prefix}_{name.upper()}") for name in ("user", "password")}
    return {name: value for name, value in found.items() if value}


def warehouse_of(spark: SparkSession, where: str) -> Warehouse:
    if where.startswith("catalog:"):
        return CatalogWarehouse(spark, where.removeprefix("catalog:"))
    if where.startswith("jdbc:"):
        return JdbcWarehouse(spark, where, login("WAREHOUSE"))
    return FolderWarehouse(spark, where)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="starloom", description=__doc__)
    p.add_argument("stage", choices=STAGES)
    p.add_argument("--landed", required=True, help="ingestion zone")
    p.add_argument("--processed", required=True, help="processed zone")
    p.add_argument(
        "--warehouse",
        help="folder of the warehouse, catalog:<database>, or jdbc:<url>; its user and password from"
        " WAREHOUSE_USER, WAREHOUSE_PASSWORD",
    )
    p.add_argument("--batch", help="batch id, for transform and load")
    p.add_argument("--source-database", help="catalog database to extract from")
    p.add_argument("--jdbc-url", help="database to extract from; user and password from JDBC_USER, JDBC_PASSWORD")
    p.add_argument("--key", action="append", default=[], metavar="TABLE=COLUMN", help="key to divide a JDBC scan by")
    p.add_argument("--whole", action="append", default=[], metavar="TABLE", help="table without a key, read by one task")
    p.add_argument("--layout", choices=LAYOUTS, default="lines")
    p.add_argument("--quarter", choices=QUARTERS, default="thirds")
    p.add_argument("--raw-escapes", action="store_true")
    p.add_argument("--null-safe", action="store_true")
    p.add_argument("--checkpoint", help="folder for the progress of the streams")
    return p


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    needed = {
        "transform": ["batch"],
        "load": ["batch", "warehouse"],
        "run": ["warehouse"],
        "stream": ["checkpoint", "warehouse"],
    }
    for name in needed.get(args.stage, []):
        if not getattr(args, name):
            raise SystemExit(f"{args.stage} needs --{name}")

    spark = session()
    zones = Zones(args.landed, args.processed)
    options = Options(layout=args.layout, raw_escapes=args.raw_escapes, null_safe=args.null_safe, quarter=args.quarter)
    at = datetime.now()

    def source():
        if not args.jdbc_url:
            return CatalogSource(spark, args.source_database)
        keys = dict(item.split("=", 1) for item in args.key)
        return JdbcSource(spark, args.jdbc_url, login("JDBC"), keys=keys, whole=frozenset(args.whole))

    if args.stage == "extract":
        batch = storage.batch_id(at)
        extract_batch(spark, source(), zones, batch, at)
        print(batch)
    elif args.stage == "transform":
        transform_batch(spark, zones, args.batch, at, options)
    elif args.stage == "load":
        load_batch(spark, zones, args.batch, warehouse_of(spark, args.warehouse))
    elif args.stage == "run":
        print(run_batch(spark, source(), zones, warehouse_of(spark, args.warehouse), at, options))
    else:
        transform_arrivals(spark, zones, f"{args.checkpoint}/transform", options).awaitTermination()
        load_arrivals(spark, zones, warehouse_of(spark, args.warehouse), f"{args.checkpoint}/load").awaitTermination()


if __name__ == "__main__":
    main()
