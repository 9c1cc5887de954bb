from datetime import datetime
from pathlib import Path

import frames
import golden
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starloom import storage
from starloom.plans import batch as plan
from starloom.session import scratch_root
from starloom.sinks import snapshots as sink
from starloom.sinks.warehouse import CatalogWarehouse, FolderWarehouse, JdbcWarehouse, dump, preview, table_counts
from starloom.sources.snapshots import read_landed, read_processed
from starloom.sources.tables import FrameSource
from starloom.specs import SALES_NAMES, SALES_SOURCES, SALES_TABLES, SOURCES, WAREHOUSE
from starloom.streaming.arrivals import load_arrivals, transform_arrivals

AT = datetime(2025, 3, 2, 4, 5, 6)
BATCH = "20250302_040506"


@pytest.fixture
def zones(tmp_path):
    return plan.Zones(str(tmp_path / "landed"), str(tmp_path / "processed"))


@pytest.fixture
def target(spark, tmp_path):
    return FolderWarehouse(spark, str(tmp_path / "warehouse"))


def land(spark, zones, at=AT, **changes):
    source = FrameSource({**frames.consistent(spark), **changes})
    plan.extract_batch(spark, source, zones, storage.batch_id(at), at)
    return storage.batch_id(at)


def counts(target):
    return {r.table_name: r.n for r in table_counts(dump(target)).collect()}


def test_declared_tables():
    assert len(SOURCES) == 11 and len(WAREHOUSE) == 11
    assert SALES_NAMES == [t.name for t in SALES_TABLES] and SALES_NAMES[-1] == "fact_sales_order"
    for spec in WAREHOUSE.values():
        for reference in spec.foreign_keys:
            assert reference.column in spec.names and WAREHOUSE[reference.table].key == reference.key
    assert [len(WAREHOUSE[f].foreign_keys) for f in ("fact_sales_order", "fact_purchase_order", "fact_payment")] == [9, 8, 7]


def test_whole_batch(spark, zones, target):
    before = set(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(scratch_root(spark)).inputFiles())
    assert plan.run_batch(spark, FrameSource(frames.consistent(spark)), zones, target, AT) == BATCH
    manifest = sink.read_manifest(spark, zones.processed, BATCH).collect()
    assert sorted(r.table_name for r in manifest) == sorted(SALES_NAMES)
    assert {r.status for r in manifest} == {sink.UPLOADED}
    assert {r.table_name: r.row_count for r in manifest} == counts(target)
    fact = target.table("fact_sales_order").orderBy("sales_record_id").collect()
    assert [r.sales_order_id for r in fact] == [r["sales_order_id"] for r in frames.sales_order_records()]
    assert str(fact[0].created_date) == "2022-11-03" and fact[0].created_time == "14:20:52.186"
    assert [str(r.date_id) for r in target.table("dim_date").orderBy("date_id").collect()] == [d for d, *_ in golden.DATES]
    after = set(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(scratch_root(spark)).inputFiles())
    assert not [f for f in after - before if "batch-" in f]


def test_processed_schema_is_the_declared_one(spark, zones):
    batch = land(spark, zones)
    plan.transform_batch(spark, zones, batch, AT)
    for name in SALES_NAMES:
        stored = spark.read.parquet(storage.snapshot_path(zones.processed, batch, name))
        assert stored.dtypes == read_processed(spark, zones.processed, batch, name).dtypes


def test_refresh_replaces_and_may_be_repeated(spark, zones, target):
    batch = land(spark, zones)
    plan.transform_batch(spark, zones, batch, AT)
    plan.load_batch(spark, zones, batch, target)
    first = counts(target)
    plan.load_batch(spark, zones, batch, target)
    assert counts(target) == first
    fewer = frames.consistent(spark)["sales_order"].where("sales_order_id < 6")
    later = land(spark, zones, datetime(2025, 3, 3), sales_order=fewer)
    plan.transform_batch(spark, zones, later, AT)
    plan.load_batch(spark, zones, later, target)
    assert counts(target)["fact_sales_order"] == 4


def test_broken_batch_leaves_the_warehouse_alone(spark, zones, target):
    plan.run_batch(spark, FrameSource(frames.consistent(spark)), zones, target, AT)
    before = counts(target)
    orders = frames.sales_order(spark, staff_id=99)
    bad = land(spark, zones, datetime(2025, 3, 3), sales_order=orders, currency=frames.currency(spark, (4, "JPY")))
    plan.transform_batch(spark, zones, bad, AT)
    with pytest.raises(plan.BrokenConstraints) as refused:
        plan.load_batch(spark, zones, bad, target)
    assert sorted((r.table_name, r.rule, r.column_name, r.n) for r in refused.value.found) == [
        ("dim_currency", "not_null", "currency_name", 1),
        ("fact_sales_order", "foreign_key", "sales_staff_id", 10),
    ]
    assert counts(target) == before


def test_processed_batches_are_immutable_but_unfinished_ones_are_redone(spark, zones):
    batch = land(spark, zones)
    leftover = storage.snapshot_path(zones.processed, batch, "dim_design")
    spark.range(3).write.parquet(leftover)
    plan.transform_batch(spark, zones, batch, AT)
    assert read_processed(spark, zones.processed, batch, "dim_design").columns == WAREHOUSE["dim_design"].names
    with pytest.raises(FileExistsError):
        plan.transform_batch(spark, zones, batch, AT)


def test_empty_orders_make_an_empty_star(spark, zones, target):
    batch = land(spark, zones, sales_order=frames.sales_order(spark).limit(0))
    manifest = plan.transform_batch(spark, zones, batch, AT)
    states = {r.table_name: (r.status, r.row_count) for r in manifest.collect()}
    assert states["fact_sales_order"] == states["dim_date"] == (sink.SKIPPED_EMPTY, 0)
    plan.load_batch(spark, zones, batch, target)
    assert counts(target)["fact_sales_order"] == 0


def test_missing_source_raises(spark, zones):
    sources = frames.consistent(spark)
    del sources["design"]
    plan.extract_batch(spark, FrameSource(sources), zones, BATCH, AT)
    with pytest.raises(PySparkException):
        plan.transform_batch(spark, zones, BATCH, AT)
    assert not sink.is_complete(spark, zones.processed, BATCH)


def test_options_reach_the_transforms(spark, zones):
    batch = land(spark, zones)
    plan.transform_batch(spark, zones, batch, AT, plan.Options(quarter="calendar", raw_escapes=True, null_safe=True))
    locations = read_processed(spark, zones.processed, batch, "dim_design").select("file_location").distinct()
    assert [r[0] for r in locations.collect()] == ["/usr"]


def test_catalog_warehouse(spark, zones, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS stars LOCATION '{tmp_path}/stars'")
    target = CatalogWarehouse(spark, "stars")
    try:
        assert target.loaded() is None
        for n, batch in ((2, "b1"), (3, "b2"), (1, "b3")):
            rows = golden.CURRENCIES[:n]
            target.refresh(batch, {"dim_currency": spark.createDataFrame(rows, "currency_id INT, a STRING, b STRING")})
            assert target.loaded() == batch
            assert target.table("dim_currency").count() == spark.table("stars.dim_currency").count() == n
        kept = [t.name for t in spark.catalog.listTables("stars") if t.name.startswith("dim_currency__")]
        assert len(kept) == 2
    finally:
        spark.sql("DROP DATABASE stars CASCADE")


def test_a_refresh_that_breaks_off_leaves_the_old_star(spark, zones, target):
    plan.run_batch(spark, FrameSource(frames.consistent(spark)), zones, target, AT)
    before = counts(target)
    broken = spark.range(3).withColumn("x", F.raise_error(F.lit("gone")).cast("string"))
    with pytest.raises(PySparkException):
        target.refresh("20990101_000000", {"dim_design": spark.range(1), "fact_sales_order": broken})
    assert target.loaded() == BATCH and counts(target) == before


def test_an_older_batch_does_not_replace_a_newer_one(spark, zones, target):
    newer = land(spark, zones, datetime(2025, 3, 4))
    older = land(spark, zones, datetime(2025, 3, 3), sales_order=frames.sales_order(spark).where("sales_order_id < 4"))
    for batch in (newer, older):
        plan.transform_batch(spark, zones, batch, AT)
    assert plan.load_batch(spark, zones, newer, target)
    assert not plan.load_batch(spark, zones, older, target)
    assert target.loaded() == newer and counts(target)["fact_sales_order"] == 10


class FakeJdbcWarehouse(JdbcWarehouse):
    """Records what would be sent to a database; none is available here."""

    def _write(self, name, df):
        self.sent = [*getattr(self, "sent", []), name]

    def _execute(self, statement):
        self.sent = [*getattr(self, "sent", []), statement]


def test_jdbc_warehouse_switches_in_one_statement(spark):
    target = FakeJdbcWarehouse(spark, "jdbc:x", {"user": "u"})
    assert target._options("dim_date") == {"url": "jdbc:x", "dbtable": "dim_date", "user": "u"}
    target.refresh("b7", {n: spark.range(1) for n in SALES_NAMES})
    assert sorted(target.sent[:-1]) == sorted(f"{n}__new" for n in SALES_NAMES)
    steps = target.sent[-1].split("; ")
    assert steps[:2] == ["BEGIN", "DELETE FROM fact_sales_order"] and steps[-1] == "COMMIT"
    assert steps[-3:-1] == ["DELETE FROM loaded_batch", "INSERT INTO loaded_batch VALUES ('b7')"]
    assert "INSERT INTO fact_sales_order " in steps[-4] and "CAST(created_time AS TIME)" in steps[-4]
    for word in ("TRUNCATE", "CASCADE", "fact_purchase_order", "fact_payment"):
        assert word not in target.sent[-1]
    (currency,) = [s for s in steps if s.startswith("INSERT INTO dim_currency")]
    assert currency.endswith(
        "ON CONFLICT (currency_id) DO UPDATE SET currency_code = EXCLUDED.currency_code, currency_name = EXCLUDED.currency_name"
    )


def test_preview(spark):
    df = spark.range(100).repartition(5)
    assert [r.id for r in preview(df, "id", 3).collect()] == [0, 1, 2]


def finished(stream):
    stream.awaitTermination()
    assert stream.exception() is None


def test_stream_transforms_and_loads_batches_as_they_land(spark, zones, target, tmp_path):
    transform = lambda: finished(transform_arrivals(spark, zones, str(tmp_path / "t"), clock=lambda: AT))
    load = lambda: finished(load_arrivals(spark, zones, target, str(tmp_path / "l")))
    transform()
    first = land(spark, zones, datetime(2025, 1, 1), sales_order=frames.sales_order(spark).where("sales_order_id < 4"))
    transform()
    load()
    assert counts(target)["fact_sales_order"] == 2
    second = land(spark, zones, datetime(2025, 1, 2))
    transform()
    load()
    assert counts(target)["fact_sales_order"] == 10
    done = sink.read_manifest(spark, zones.processed).select("batch_id").distinct().collect()
    assert sorted(r.batch_id for r in done) == [first, second]


def test_stream_keeps_the_newest_sound_batch(spark, zones, target, tmp_path):
    some = frames.sales_order(spark)
    newer = land(spark, zones, datetime(2025, 1, 2))
    older = land(spark, zones, datetime(2025, 1, 1), sales_order=some.where("sales_order_id < 4"))
    broken = land(spark, zones, datetime(2025, 1, 3), sales_order=frames.sales_order(spark, staff_id=99))
    for batch in (newer, older, broken):
        plan.transform_batch(spark, zones, batch, AT)
        finished(load_arrivals(spark, zones, target, str(tmp_path / "l")))
        assert target.loaded() == newer and counts(target)["fact_sales_order"] == 10
    refused = spark.read.json(storage.refusal_path(zones.processed)).collect()
    assert [(r.batch_id, r.column_name, r.n) for r in refused] == [(broken, "sales_staff_id", 10)]


def test_stream_repeats_a_trigger_without_harm(spark, zones, tmp_path):
    land(spark, zones)
    finished(transform_arrivals(spark, zones, str(tmp_path / "t"), clock=lambda: AT))
    # A second stream without the first one's checkpoint sees the same batch again.
    finished(transform_arrivals(spark, zones, str(tmp_path / "other"), clock=lambda: AT))
    assert sink.read_manifest(spark, zones.processed).count() == len(SALES_NAMES)


def test_stream_stops_on_a_failing_batch(spark, zones, tmp_path):
    land(spark, zones, sales_order=frames.sales_order(spark).withColumn("created_at", F.lit("never")))
    stream = transform_arrivals(spark, zones, str(tmp_path / "t"), clock=lambda: AT)
    with pytest.raises(PySparkException):
        stream.awaitTermination()


def test_extracts_only_what_is_asked_for(spark, zones):
    source = FrameSource({**frames.consistent(spark), "payment_type": spark.range(1)})
    manifest = plan.extract_batch(spark, source, zones, BATCH, AT, SALES_SOURCES)
    assert sorted(r.table_name for r in manifest.collect()) == sorted(SALES_SOURCES)


def test_landed_text_is_compressed_in_files_of_bounded_length(spark, zones, tmp_path, monkeypatch):
    monkeypatch.setattr(sink, "LANDED_RECORDS", 300)
    numbers = F.col("id").cast("int")
    orders = frames.sales_order(spark).limit(1).drop("sales_order_id").crossJoin(
        spark.range(0, 1000, numPartitions=1).select(numbers.alias("sales_order_id"))
    ).coalesce(1)
    plan.extract_batch(spark, FrameSource({"sales_order": orders}), zones, BATCH, AT)
    sink.write_json(orders, str(tmp_path / "plain"))
    landed = list(Path(storage.snapshot_path(zones.landed, BATCH, "sales_order")).glob("part-*"))
    plain = sum(f.stat().st_size for f in (tmp_path / "plain").glob("part-*"))
    assert len(landed) == 4 and sum(f.stat().st_size for f in landed) < plain / 3
    names = orders.columns
    read = read_landed(spark, zones.landed, BATCH, "sales_order").select(*names)
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, orders.collect()))
