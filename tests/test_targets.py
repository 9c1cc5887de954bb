"""All declared targets in one batch, and the order in which tables are loaded."""

from dataclasses import replace
from datetime import datetime
from graphlib import CycleError
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from starloom.catalog.queries import OPTIONS
from starloom.catalog.roles import operational, purchasing
from starloom.plans import batch as plan
from starloom.sinks.warehouse import FolderWarehouse
from starloom.sources.tables import FrameSource
from starloom.specs import WAREHOUSE, Column, ForeignKey, MissingReference, Table, load_order

SF = "/root/testdata/sf0.001"


def test_all_eleven_targets_in_one_batch(spark, tmp_path):
    zones, target = plan.Zones(f"{tmp_path}/landed", f"{tmp_path}/processed"), FolderWarehouse(spark, f"{tmp_path}/wh")
    tables = {**operational(spark, SF), **purchasing(spark, SF)}
    options = replace(OPTIONS, targets=tuple(reversed(WAREHOUSE)))
    plan.run_batch(spark, FrameSource(tables), zones, target, datetime(2024, 1, 1), options)
    assert target.table("fact_payment").count() == tables["payment"].count()
    types = {c.name: c.type for c in WAREHOUSE["fact_purchase_order"].columns if c.type != "TIME"}
    found = {n: t.upper() for n, t in target.table("fact_purchase_order").dtypes if n in types}
    assert found == {n: t for n, t in types.items()}
    # A payment of no transaction keeps the whole batch out.
    lost = tables["payment"].withColumn("transaction_id", F.when(F.col("payment_id") % 2 == 0, F.col("transaction_id")).otherwise(-1))
    with pytest.raises(plan.BrokenConstraints, match="fact_payment.transaction_id"):
        plan.run_batch(spark, FrameSource({**tables, "payment": lost}), zones, target, datetime(2024, 1, 2), options)
    assert target.loaded() == "20240101_000000"


def test_copies_and_checks_are_made_side_by_side(spark, tmp_path, monkeypatch):
    zones, target = plan.Zones(f"{tmp_path}/landed", f"{tmp_path}/processed"), FolderWarehouse(spark, f"{tmp_path}/wh")
    tables = {**operational(spark, SF), **purchasing(spark, SF)}
    copies, checks = Barrier(3), Barrier(2)
    stage, violations = plan.stage, plan.quality.violations

    def staged(df, path):
        copies.wait(60)
        return stage(df, path)

    def checked(known, names=None):
        if set(names) & {"fact_sales_order", "fact_payment"}:
            checks.wait(60)
        return violations(known, names)

    monkeypatch.setattr(plan, "stage", staged)
    monkeypatch.setattr(plan.quality, "violations", checked)
    # Rows that break constraints of two tables are all reported.
    lost = {n: tables[n].withColumn("counterparty_id", F.lit(-1)) for n in ("sales_order", "payment")}
    options = replace(OPTIONS, targets=tuple(WAREHOUSE))
    with pytest.raises(plan.BrokenConstraints) as broken:
        plan.run_batch(spark, FrameSource({**tables, **lost}), zones, target, datetime(2024, 1, 1), options)
    n = tables["payment"].count()
    assert sorted(map(tuple, broken.value.found)) == [
        ("fact_payment", "foreign_key", "counterparty_id", n), ("fact_sales_order", "foreign_key", "counterparty_id", n),
    ]
    assert target.loaded() is None


def test_order_of_loading():
    order = load_order(reversed(WAREHOUSE))
    assert sorted(order) == sorted(WAREHOUSE)
    for name in order:
        assert all(order.index(k.table) < order.index(name) for k in WAREHOUSE[name].foreign_keys)
    with pytest.raises(MissingReference, match="fact_payment refers to dim_transaction"):
        load_order(n for n in WAREHOUSE if n != "dim_transaction")
    one = Table("one", (Column("id", "INT"), Column("two", "INT")), (ForeignKey("two", "two", "id"),))
    two = Table("two", (Column("id", "INT"), Column("one", "INT")), (ForeignKey("one", "one", "id"),))
    with pytest.raises(CycleError):
        load_order(["one", "two"], {"one": one, "two": two})
