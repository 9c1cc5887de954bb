import frames
import pytest

from starloom.__main__ import main
from starloom.sinks import snapshots as sink
from starloom.sinks.warehouse import FolderWarehouse
from starloom.specs import SALES_NAMES


@pytest.fixture
def operational(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    for name, df in frames.consistent(spark).items():
        df.write.mode("overwrite").saveAsTable(f"shop.{name}")
    yield "shop"
    spark.sql("DROP DATABASE shop CASCADE")


def test_stages_one_by_one(spark, operational, tmp_path, capsys):
    where = ["--landed", f"{tmp_path}/l", "--processed", f"{tmp_path}/p", "--warehouse", f"{tmp_path}/w"]
    main(["extract", "--source-database", operational, *where])
    batch = capsys.readouterr().out.split()[-1]
    main(["transform", "--batch", batch, "--quarter", "calendar", *where])
    main(["load", "--batch", batch, *where])
    target = FolderWarehouse(spark, f"{tmp_path}/w")
    assert target.table("fact_sales_order").count() == 10
    assert {r.quarter for r in target.table("dim_date").collect()} == {4}


def test_streams(spark, operational, tmp_path):
    where = ["--landed", f"{tmp_path}/l", "--processed", f"{tmp_path}/p", "--warehouse", f"{tmp_path}/w"]
    main(["extract", "--source-database", operational, *where])
    main(["stream", "--checkpoint", f"{tmp_path}/c", *where])
    assert sink.read_manifest(spark, f"{tmp_path}/p").count() == len(SALES_NAMES)
    assert FolderWarehouse(spark, f"{tmp_path}/w").table("fact_sales_order").count() == 10


@pytest.mark.parametrize("stage, missing", [("load", "batch"), ("run", "warehouse"), ("stream", "checkpoint")])
def test_missing_arguments(stage, missing):
    with pytest.raises(SystemExit, match=missing):
        main([stage, "--landed", "l", "--processed", "p"])
