"""Columns that are discovered, against those declared."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starloom.plans.batch import Zones, extract_batch
from starloom.sources.drift import SchemaDrift, fields, landed_drift, source_drift
from starloom.sources.tables import FolderSource, FrameSource
from starloom.storage import exists

DECLARED = {"thing": "id INT, name STRING, price DOUBLE, at STRING", "gone": "id INT"}


def thing(spark):
    return spark.range(3).select(
        F.col("id").cast("int"), F.lit("a").alias("name"), F.lit(1).cast("decimal(9,2)").alias("price"),
        F.current_timestamp().alias("at"),
    )


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_tables_and_columns_of_a_source(spark):
    odd = thing(spark).withColumn("extra", F.lit(True)).drop("price").withColumn("name", F.lit(5))
    source = FrameSource({"thing": odd, "new": spark.range(1), "_internal": spark.range(1)})
    assert found(source_drift(spark, source, declared=DECLARED).fillna("-")) == [
        ("gone", "-", "missing", "-", "-"),
        ("new", "-", "added", "-", "-"),
        ("thing", "extra", "added", "-", "boolean"),
        ("thing", "name", "retyped", "string", "int"),
        ("thing", "price", "missing", "double", "-"),
    ]
    assert found(source_drift(spark, FrameSource({"thing": thing(spark)}), ["thing"], DECLARED)) == []


def test_drift_is_reported_before_anything_is_landed(spark, tmp_path):
    zones, at = Zones(f"{tmp_path}/landed", f"{tmp_path}/processed"), datetime(2024, 1, 1)
    odd = FrameSource({"thing": thing(spark).drop("at")})
    with pytest.raises(SchemaDrift, match="thing.at missing"):
        extract_batch(spark, odd, zones, "20240101_000000", at, declared=DECLARED)
    assert not exists(spark, zones.landed)
    sound = FrameSource({"thing": thing(spark)})
    assert extract_batch(spark, sound, zones, "20240101_000000", at, declared=DECLARED).count() == 1


def test_fields_of_landed_records(spark, tmp_path):
    lines = [
        {"id": 1, "name": "a", "price": 1.5, "at": None},
        {"id": "2", "name": None, "price": 2, "at": "x", "new": {"id": 1}},
        {"id": 3, "price": "3", "new": [1], "": 0},
        {},
    ]
    path = tmp_path / "thing.json"
    path.write_text("\n".join(map(json.dumps, lines)) + "\n\n[1, 2]\n")
    assert ("id", "BIGINT", 2) in found(fields(spark, str(path)))
    assert sorted(map(str, found(landed_drift(spark, str(path), DECLARED["thing"]).fillna("-")))) == sorted(
        map(
            str,
            [
                ("", "added", "-", "BIGINT", 1),
                ("id", "retyped", "int", "STRING", 1),
                ("new", "added", "-", "ARRAY", 1),
                ("new", "added", "-", "OBJECT", 1),
                ("price", "retyped", "double", "STRING", 1),
                ("at", "missing", "string", "-", 3),
                ("id", "missing", "int", "-", 2),
                ("name", "missing", "string", "-", 3),
                ("price", "missing", "double", "-", 2),
            ],
        )
    )


@pytest.mark.parametrize("kind", ["json", "csv", "parquet"])
def test_a_folder_of_files_is_a_source(spark, tmp_path, kind):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id INT, name STRING")
    for name in ("one", "two"):
        rows.write.format(kind).options(**({"header": True} if kind == "csv" else {})).save(f"{tmp_path}/{name}")
    rows.write.format(kind).save(f"{tmp_path}/_hidden")
    source = FolderSource(spark, str(tmp_path), kind, {"one": "id INT, name STRING", "two": "id INT, name STRING"})
    assert source.tables() == ["one", "two"]
    assert source.columns("two") == {"id": "int", "name": "string"}
    assert sorted(map(tuple, source.read("one").collect())) == [(1, "a"), (2, None)]
