from datetime import datetime

import frames
import golden
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starloom import storage
from starloom.functions import text
from starloom.plans.batch import Zones, extract_batch
from starloom.sinks import snapshots as sink
from starloom.sources import snapshots as source
from starloom.sources.tables import CatalogSource, FrameSource, JdbcSource, UnknownKey, changed_since, latest_per_key
from starloom.specs import SOURCES

AT = datetime(2024, 3, 3, 12, 0, 0)


def lines(path):
    return sorted(line for file in path.glob("part-*") for line in file.read_text().splitlines())


def test_records_are_written_as_iso_text_with_nulls(spark, tmp_path):
    df = spark.sql(
        "SELECT 1 AS id, TIMESTAMP_NTZ'2022-11-03 14:20:52.186999' AS ntz, TIMESTAMP'2022-11-03 14:20:52.186999' AS ts,"
        " DATE'2022-11-07' AS day, CAST(NULL AS STRING) AS gone, 'a/b\"\\\\é' AS t, CAST(3.9 AS DECIMAL(38,18)) AS price"
    )
    sink.write_json(df, str(tmp_path / "t"))
    expected = (
        '{"id":1,"ntz":"2022-11-03T14:20:52.186","ts":"2022-11-03T14:20:52.186","day":"2022-11-07T00:00:00.000",'
        '"gone":null,"t":"a/b\\"\\\\é","price":3.900000000000000000}'
    )
    assert lines(tmp_path / "t") == [expected]
    back = source.read_json(spark, str(tmp_path / "t"), "id INT, gone STRING, t STRING, price DOUBLE, day STRING")
    assert tuple(back.first()) == (1, None, 'a/b"\\é', 3.9, "2022-11-07T00:00:00.000")


LAYOUTS = {
    "lines": '{"design_id":1,"file_location":"\\/usr"}\n{"design_id":2}\n',
    "array_line": '[{"design_id":1,"file_location":"\\/usr"},{"design_id":2,"file_location":null}]',
    "pretty": '[\n {"design_id": 1,\n  "file_location": "\\/usr"},\n {"design_id": 2}\n]\n',
}


@pytest.mark.parametrize("kind", LAYOUTS)
@pytest.mark.parametrize("raw", [False, True])
def test_layouts_and_escapes(spark, tmp_path, kind, raw):
    (tmp_path / "t.json").write_text(LAYOUTS[kind])
    layout = "array" if kind == "pretty" else "lines"
    df = source.read_json(spark, str(tmp_path), "design_id INT, file_location STRING, absent STRING", layout, raw)
    location = "\\/usr" if raw else "/usr"
    assert sorted(map(tuple, df.collect())) == [(1, location, None), (2, None, None)]


def test_raw_escapes_keep_golden_locations_and_unicode(spark, tmp_path):
    records = ",".join(
        '{"design_id":%d,"file_location":"%s","file_name":"caf\\u00e9"}' % (i, where.replace("/", "\\/"))
        for i, _, where, _ in golden.DESIGNS
    )
    (tmp_path / "t.json").write_text(f"[{records}]")
    schema = "design_id INT, file_location STRING, file_name STRING"
    raw = {r.design_id: r for r in source.read_json(spark, str(tmp_path), schema, raw_escapes=True).collect()}
    proper = {r.design_id: r for r in source.read_json(spark, str(tmp_path), schema).collect()}
    for i, _, where, _ in golden.DESIGNS:
        assert (raw[i].file_location, raw[i].file_name) == (where.replace("/", "\\/"), "caf\\u00e9")
        assert (proper[i].file_location, proper[i].file_name) == (where, "café")


@pytest.mark.parametrize("raw", [False, True])
def test_malformed_record_fails(spark, tmp_path, raw):
    (tmp_path / "t.json").write_text('{"design_id":1}\n{"design_id":\n')
    with pytest.raises((PySparkException, Py4JJavaError)):
        source.read_json(spark, str(tmp_path), "design_id INT", raw_escapes=raw).collect()


def test_raw_escapes_break_on_an_escaped_quote(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"design_name":"a \\" b"}\n')
    assert source.read_json(spark, str(tmp_path), "design_name STRING").first()[0] == 'a " b'
    with pytest.raises((PySparkException, Py4JJavaError)):
        source.read_json(spark, str(tmp_path), "design_name STRING", raw_escapes=True).collect()


def test_unknown_layout(spark):
    with pytest.raises(ValueError):
        source.read_json(spark, "x", "a INT", "columns")


def test_csv_with_unnamed_row_number(spark, tmp_path):
    names = frames.columns("sales_order")
    body = [",".join(["", *names])]
    for k, r in enumerate(frames.sales_order_records()):
        body.append(",".join([str(k), *["" if r[c] is None else str(r[c]) for c in names]]))
    (tmp_path / "t.csv").write_text("\n".join(body))
    df = source.read_csv(spark, str(tmp_path / "t.csv"), SOURCES["sales_order"], index="row")
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, frames.sales_order(spark).collect()))


def test_parquet_key_first(spark, tmp_path):
    df = spark.createDataFrame([("x", 1)], "name STRING, id INT")
    sink.write_parquet(df, str(tmp_path / "t"))
    assert source.read_parquet(spark, str(tmp_path / "t"), ["id", "name"]).columns == ["id", "name"]
    with pytest.raises(PySparkException):
        sink.write_parquet(df, str(tmp_path / "t"))


def test_flat_records(spark):
    nested = spark.sql("SELECT 1 AS a, named_struct('b', 2, 'c', named_struct('d e', 3)) AS s")
    assert text.flat(nested).columns == ["a", "s.b", "s.c.d e"]
    assert tuple(text.flat(nested).first()) == (1, 2, 3)


def test_paths():
    assert storage.batch_id(datetime(2025, 3, 2, 4, 5, 6)) == "20250302_040506"
    assert storage.snapshot_key("staff", "b", ".json") == "data/b/staff.json"
    assert storage.snapshot_path("/zone/", "b", "staff") == "/zone/data/b/staff"
    assert storage.log_path("/zone", AT) == "/zone/logs/2024-03-03_12-00-00.log"


def written(spark, *names, status=sink.UPLOADED):
    return sink.manifest_of(spark, [sink.Written("b", n, n, status, 1, AT) for n in names])


def test_log_text(spark, tmp_path):
    manifest = written(spark, "design", "staff").union(written(spark, "currency", status=sink.SKIPPED_EMPTY))
    path = sink.write_log(manifest, str(tmp_path), AT)
    assert path.endswith(f"logs/{AT:%Y-%m-%d_%H-%M-%S}.log")
    assert [r.value for r in spark.read.text(path).orderBy("value").collect()] == [
        f"Uploaded: data/b/{name}.json at {AT:%Y-%m-%d %H:%M:%S}" for name in ("design", "staff")
    ]
    assert sink.write_log(written(spark), str(tmp_path), datetime(2024, 1, 1)) is None
    assert not storage.exists(spark, storage.log_path(str(tmp_path), datetime(2024, 1, 1)))


def test_batch_status(spark):
    both = written(spark, "a").union(written(spark, "b", status=sink.SKIPPED_EMPTY)).union(
        written(spark, "c").withColumn("batch_id", F.lit("ok"))
    )
    status = sink.batch_status(both, "batch_id", F.col("status") == sink.UPLOADED, F.col("status"))
    assert sorted(map(tuple, status.collect())) == [("b", False, [sink.SKIPPED_EMPTY]), ("ok", True, [])]


def test_extract_records_empty_tables_and_is_immutable(spark, tmp_path):
    zones = Zones(str(tmp_path), str(tmp_path / "p"))
    tables = FrameSource({"staff": frames.staff(spark), "design": frames.design(spark).limit(0), "_meta": spark.range(1)})
    manifest = extract_batch(spark, tables, zones, "b", AT)
    assert sorted((r.table_name, r.status, r.row_count) for r in manifest.collect()) == [
        ("design", "skipped_empty", 0),
        ("staff", "uploaded", 5),
    ]
    assert sorted(map(str, manifest.collect())) == sorted(map(str, sink.read_manifest(spark, zones.landed, "b").collect()))
    assert source.read_landed(spark, zones.landed, "b", "staff").count() == 5
    empty = source.read_landed(spark, zones.landed, "b", "design")
    assert empty.columns == frames.columns("design") and empty.count() == 0
    with pytest.raises(FileExistsError):
        extract_batch(spark, tables, zones, "b", AT)


def test_extract_replaces_an_unfinished_batch_and_raises_on_errors(spark, tmp_path):
    zones = Zones(str(tmp_path), str(tmp_path / "p"))
    broken = frames.staff(spark).withColumn("first_name", F.raise_error(F.lit("gone")).cast("string"))
    with pytest.raises(PySparkException):
        extract_batch(spark, FrameSource({"design": frames.design(spark), "staff": broken}), zones, "b", AT)
    assert not sink.is_complete(spark, zones.landed, "b")
    extract_batch(spark, FrameSource({"design": frames.design(spark), "staff": frames.staff(spark)}), zones, "b", AT)
    assert source.read_landed(spark, zones.landed, "b", "design").count() == len(golden.DESIGNS)


def test_catalog_source_hides_underscored_tables(spark):
    frames.staff(spark).createOrReplaceTempView("staff")
    frames.staff(spark).createOrReplaceTempView("_hidden")
    try:
        tables = CatalogSource(spark).tables()
        assert "staff" in tables and "_hidden" not in tables
        assert CatalogSource(spark).read("staff").count() == 5
    finally:
        spark.catalog.dropTempView("staff")
        spark.catalog.dropTempView("_hidden")


class FakeJdbc(JdbcSource):
    """Records what would be sent to a database; none is available here."""

    kind = "BIGINT"
    uppers = ()

    def _load(self, **options):
        if options.get("query", "").endswith("1 = 0"):
            return self.spark.createDataFrame([], f"key {self.kind}")
        if "query" in options:
            self.query = options["query"]
            return self.spark.createDataFrame([(u,) for u in self.uppers], "upper BIGINT")
        if options["dbtable"] == "information_schema.tables":
            return self.spark.createDataFrame(
                [("public", "staff"), ("public", "_prisma"), ("other", "x"), ("public", "design")],
                "table_schema STRING, table_name STRING",
            )
        self.whole_read = options["dbtable"]
        return self.spark.range(1)

    def _divided(self, table, predicates):
        self.sent = (table, predicates)
        return self.spark.range(1)


def test_jdbc_tables(spark):
    assert FakeJdbc(spark, "jdbc:x").tables() == ["design", "staff"]


def test_jdbc_scan_of_a_whole_number_key_is_cut_into_counted_shares(spark):
    tables = FakeJdbc(spark, "jdbc:x", partitions=4)
    tables.uppers = (10, 1000, 20, 15)
    tables.read("staff")
    assert tables.sent == (
        "public.staff",
        ["staff_id <= 10 OR staff_id IS NULL", "staff_id > 10 AND staff_id <= 15", "staff_id > 15 AND staff_id <= 20", "staff_id > 20"],
    )
    assert "ntile(4) OVER (ORDER BY staff_id)" in tables.query
    tables.uppers = ()
    tables.read("design")
    assert tables.sent == ("public.design", ["1 = 1"])


@pytest.mark.parametrize("kind", ["STRING", "TIMESTAMP"])
def test_jdbc_scan_of_another_key_is_cut_by_a_hash(spark, kind):
    tables = FakeJdbc(spark, "jdbc:x", keys={"log": "code"}, partitions=2)
    tables.kind = kind
    tables.read("log")
    hashed = "abs(hashtext(CAST(code AS TEXT)) % 2)"
    assert tables.sent == ("public.log", ["code IS NULL", f"{hashed} = 0", f"{hashed} = 1"])


def test_jdbc_scan_without_a_key_is_refused_unless_it_is_asked_for(spark):
    with pytest.raises(UnknownKey):
        FakeJdbc(spark, "jdbc:x").read("log")
    tables = FakeJdbc(spark, "jdbc:x", whole=frozenset({"log"}))
    tables.read("log")
    assert tables.whole_read == "public.log"


def test_changed_since_and_latest(spark):
    versions = spark.createDataFrame(
        [(1, "2024-01-01T00:00:00.000", "a"), (1, "2024-01-02T00:00:00.000", "b"), (2, "2024-01-01T00:00:00.000", None)],
        "id INT, last_updated STRING, v STRING",
    )
    assert [r.v for r in changed_since(versions, "2024-01-01T12").collect()] == ["b"]
    assert [r.v for r in changed_since(versions, F.lit("2024-01-01T12")).collect()] == ["b"]
    latest = latest_per_key(versions, ["id"], "last_updated")
    assert latest.columns == versions.columns
    assert sorted((r.id, r.v) for r in latest.collect()) == [(1, "b"), (2, None)]


def test_latest_breaks_ties_column_by_column(spark):
    rows = [(1, 5, None, "a"), (1, 5, 2, "b"), (1, 4, 9, "c"), (2, None, 1, "d"), (2, None, 1, "d"), (None, 1, 1, "e")]
    versions = spark.createDataFrame(rows, "id INT, at BIGINT, nr BIGINT, v STRING")
    latest = latest_per_key(versions, ["id"], "at", "nr")
    assert sorted((r.v for r in latest.collect())) == ["b", "d", "e"]


def test_status_counts(spark):
    rows = [("a", 1, "x"), ("a", 0, "y"), ("a", 0, "y"), ("a", 0, "z"), ("b", 1, "x"), ("c", 0, None)]
    results = spark.createDataFrame(rows, "batch STRING, ok INT, code STRING")
    status = sink.status_counts(results, "batch", F.col("ok") == 1, F.col("code"))
    assert sorted(map(tuple, status.collect())) == [("a", False, 2), ("b", True, 0), ("c", False, 0)]
