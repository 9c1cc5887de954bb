"""The registered queries. Each takes (spark, sf_dir) and returns a DataFrame over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.catalog.roles import CURRENCIES, as_int, event_orders, operational, purchasing, sales_order, sample
from starloom.functions import dates, text
from starloom.operators import bitmaps, quality, star
from starloom.operators.numbering import with_dense_key
from starloom.plans import insight
from starloom.plans.batch import Options, Zones, extract_batch, run_batch, transform_batch
from starloom.plans.increments import extract_changes, merge_changes
from starloom.session import scratch_path, settle
from starloom.sinks import buckets
from starloom.sinks import snapshots as sink
from starloom.sinks import warehouse as wh
from starloom.sinks.months import of_days
from starloom.sources import snapshots as source
from starloom.sources.drift import landed_drift
from starloom.sources.tables import FrameSource, changed_since, latest_per_key
from starloom.specs import SALES_SOURCES, WAREHOUSE, ForeignKey
from starloom.storage import batch_id, discard
from starloom.streaming.arrivals import load_arrivals, transform_arrivals
from starloom.streaming.completeness import complete_batches

Query = Callable[[SparkSession, str], DataFrame]

AT = datetime(2024, 1, 1)
BUCKETS = 16
# Kinds of events.
EVENT_KINDS = ("click", "error", "purchase", "signup", "view")
OPTIONS = Options(currency_names=CURRENCIES)


def tidy(query: Callable[[SparkSession, str, str], DataFrame]) -> Query:
    """Gives a query a folder of its own in the shared area, keeps its result, and discards the folder."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch_path(spark, query.__name__.replace("_", "-"))
        try:
            return settle(query(spark, sf_dir, folder))
        finally:
            discard(spark, folder)

    return run


# Star-schema transforms


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, events = sample(spark, sf_dir, "orders"), sample(spark, sf_dir, "events")
    day = F.col("o_orderdate").cast("date")
    mentioned = orders.select(day.alias("ordered"), F.date_add(day, 7).alias("due"), F.date_add(day, 30).alias("paid"))
    return star.calendar(star.days(mentioned, ["ordered", "due", "paid"]).union(star.days(events, ["ts"])))


def dim_date_calendar_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = star.dim_date(sample(spark, sf_dir, "orders"), ["o_orderdate"], quarter="calendar")
    return dim.select("date_id", "quarter")


def date_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = star.days(sample(spark, sf_dir, "orders"), ["o_orderdate"])
    shipped = star.days(sample(spark, sf_dir, "lineitem"), ["l_shipdate"])
    return ordered.union(shipped).distinct().withColumnRenamed("date_id", "dt")


def dim_design(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = {"p_partkey": "design_id", "p_name": "design_name", "p_type": "file_location", "p_brand": "file_name"}
    return star.dim_design(sample(spark, sf_dir, "part").withColumnsRenamed(renamed))


def dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    address = sample(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("address_id"),
        F.col("s_name").alias("address_line_1"),
        as_int("s_nationkey").alias("district"),
        *[F.lit(None).cast("string").alias(c) for c in star.ADDRESS_COLUMNS if c not in ("address_line_1", "district")],
    )
    return star.dim_location(address).select("location_id", "address_line_1", "district")


def dim_counterparty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_counterparty(customers(spark, sf_dir), nation_addresses(spark, sf_dir)).select(
        "counterparty_id", "counterparty_legal_name", "counterparty_legal_country"
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("counterparty_id"),
        F.col("c_name").alias("counterparty_legal_name"),
        F.col("c_nationkey").alias("legal_address_id"),
    )


def nation_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("address_id"),
        *[(F.col("n_name") if c == "country" else F.lit("")).alias(c) for c in star.ADDRESS_COLUMNS],
    )


def dim_staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    staff = sample(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("staff_id"),
        F.col("s_name").alias("first_name"),
        F.lit("").alias("last_name"),
        F.col("s_nationkey").alias("department_id"),
        F.lit("").alias("email_address"),
    )
    department = sample(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("department_id"),
        F.col("n_name").alias("department_name"),
        F.lit("").alias("location"),
    )
    return star.dim_staff(staff, department).select("staff_id", "first_name", "department_name")


def dim_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = sample(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("currency_code")).distinct()
    names = {"MACHINERY": "Machinery", "BUILDING": "Building works"}
    return star.dim_currency(segments.withColumn("currency_id", F.lit(None).cast("int")), names).drop("currency_id")


def fact_sales_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_sales_order(event_orders(sample(spark, sf_dir, "events"))).select(
        "sales_record_id",
        "sales_order_id",
        "created_date",
        "created_time",
        "counterparty_id",
        F.col("unit_price").cast("decimal(10,2)").alias("unit_price"),
    )


def fact_sales_order_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = star.fact_sales_order(sales_order(sample(spark, sf_dir, "orders")))
    return quality.conform(fact, WAREHOUSE["fact_sales_order"])


def fact_by_text_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense numbers in the order of a text column of which few values make up the whole table."""
    orders = sample(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey")
    numbered = with_dense_key(orders, "record_id", "o_orderpriority")
    return numbered.groupBy("o_orderpriority").agg(
        F.min("record_id").alias("first_id"),
        F.max("record_id").alias("last_id"),
        F.count_distinct("record_id").alias("n_ids"),
    )


def fact_tied_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense numbers by a whole number of which few values are shared by all rows; the other columns break ties."""
    events = sample(spark, sf_dir, "events").select((F.col("event_id") % 20).alias("k"), "user_id", "event_id", "event_type")
    return with_dense_key(events, "record_id", "k")


def star_dim_counterparty(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = operational(spark, sf_dir)
    return star.dim_counterparty(tables["counterparty"], tables["address"])


def star_dim_staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = operational(spark, sf_dir)
    return star.dim_staff(tables["staff"], tables["department"])


def star_dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_location(operational(spark, sf_dir)["address"])


# Declared targets beyond the sales star


def dim_payment_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = sample(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("payment_type_name")).distinct()
    return star.dim_payment_type(with_dense_key(kinds, "payment_type_id", "payment_type_name"))


def dim_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold = F.col("o_orderstatus") == "F"
    return star.dim_transaction(
        sample(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("transaction_id"),
            F.when(sold, "SALE").otherwise("PURCHASE").alias("transaction_type"),
            F.when(sold, F.col("o_orderkey")).alias("sales_order_id"),
            F.when(~sold, F.col("o_orderkey")).alias("purchase_order_id"),
        )
    )


def fact_purchase_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    purchases = sales_order(sample(spark, sf_dir, "orders")).select(
        "*",
        F.col("sales_order_id").alias("purchase_order_id"),
        F.format_string("item-%d", "design_id").alias("item_code"),
        F.col("units_sold").alias("item_quantity"),
        F.col("unit_price").cast("decimal(10,2)").alias("item_unit_price"),
    )
    return star.fact_purchase_order(purchases)


def fact_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments = sample(spark, sf_dir, "events").select(
        F.col("event_id").alias("payment_id"),
        F.col("ts").alias("created_at"),
        (F.col("ts") + F.expr("INTERVAL '1' DAY")).alias("last_updated"),
        (F.col("event_id") % 1000).alias("transaction_id"),
        F.col("user_id").alias("counterparty_id"),
        F.col("value").cast("decimal(10,2)").alias("payment_amount"),
        (F.col("event_id") % 3).alias("currency_id"),
        (F.col("event_id") % 5).alias("payment_type_id"),
        (F.col("event_type") == "purchase").alias("paid"),
        dates.date_text(F.col("ts")).alias("payment_date"),
    )
    return star.fact_payment(payments)


# Joins, filters, records


def nullsafe_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = sample(spark, sf_dir, "events").select("event_id", F.nullif("event_type", F.lit("error")).alias("k"))
    # Two rows whatever the data: safe to broadcast.
    right = F.broadcast(spark.createDataFrame([(None, "none"), ("click", "C")], "rk STRING, v STRING"))
    return left.join(right, star.equal_keys(left["k"], right["rk"], null_safe=True)).select("event_id", "v")


def like_escape_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    named = sample(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("_"), kind)).otherwise(kind).alias("nm")
    )
    return named.where(text.is_public("nm"))


def json_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.from_json("props", "k BIGINT")
    return sample(spark, sf_dir, "events").select("event_id", props["k"].alias("k"))


def flatten_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = sample(spark, sf_dir, "events").select(
        "event_id",
        F.struct("event_type", F.from_json("props", "k BIGINT").alias("props")).alias("detail"),
    )
    return text.flat(nested)


def record_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = sample(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("status"),
        (F.col("o_orderdate") + F.expr("INTERVAL '0.123999' SECOND")).alias("at"),
    )
    return orders.select("o_orderkey", text.record_json(orders).alias("record"))


# Snapshots


@tidy
def json_snapshot_roundtrip(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    path = f"{folder}/events-json"
    events = sample(spark, sf_dir, "events").select("event_id", F.col("ts").alias("created_at"), "event_type", "value")
    sink.write_json(events, path)
    return source.read_json(spark, path, "event_id BIGINT, created_at STRING, event_type STRING, value DOUBLE")


@tidy
def json_array_scan(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """A snapshot whose lines are arrays of two records."""
    path = f"{folder}/orders-arrays"
    pair = F.array(
        F.struct(F.lit("order").alias("kind"), F.col("o_orderkey").alias("id")),
        F.struct(F.lit("customer").alias("kind"), F.col("o_custkey").alias("id")),
    )
    sample(spark, sf_dir, "orders").select(F.to_json(pair).alias("value")).write.text(path)
    return source.read_json(spark, path, "kind STRING, id BIGINT")


@tidy
def json_array_split(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """One file with one array, whose strings hold what stands between records, read by many tasks."""
    path = f"{folder}/lines-array"
    key = F.col("l_orderkey")
    note = F.when(key % 5 == 0, F.concat("l_returnflag", F.lit('}, {"a": "]}'))).when(key % 7 == 0, "}\\").otherwise(
        F.col("l_returnflag")
    )
    lines = sample(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", note.alias("note"))
    sink.write_json_array(lines, path)
    return source.read_json(
        spark, path, "l_orderkey BIGINT, l_linenumber INT, l_quantity DOUBLE, note STRING", layout="array"
    )


@tidy
def json_drift(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """Fields of a landed snapshot that are not as declared: some added, some missing, some of another kind."""
    key = F.col("event_id")
    record = F.to_json(
        F.struct(
            key,
            "event_type",
            F.when(key % 5 != 0, F.col("value")).alias("value"),
            F.when(key % 3 == 0, F.col("user_id").cast("string")).alias("user_note"),
            F.when(key % 7 == 0, F.array("user_id")).alias("users"),
        )
    )
    odd = F.format_string('{"event_id":"%d","event_type":null,"value":"high"}', key)
    text = F.when(key % 11 == 0, odd).otherwise(record)
    sample(spark, sf_dir, "events").select(text.alias("value")).write.text(f"{folder}/events")
    return landed_drift(
        spark, f"{folder}/events", "event_id BIGINT, event_type STRING, value DOUBLE, created_at STRING"
    )


@tidy
def json_escapes(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """The same escaped snapshot read properly, and with every backslash kept."""
    path = f"{folder}/design-escaped"
    record = F.format_string('{"design_id":%d,"file_location":"\\/usr\\/%s"}', "p_partkey", "p_type")
    sample(spark, sf_dir, "part").select(record.alias("value")).write.text(path)
    schema = "design_id BIGINT, file_location STRING"
    proper = source.read_json(spark, path, schema)
    raw = source.read_json(spark, path, schema, raw_escapes=True)
    return proper.withColumn("reading", F.lit("proper")).unionByName(raw.withColumn("reading", F.lit("raw")))


@tidy
def csv_snapshot_roundtrip(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """CSV whose first column is an unnamed row number."""
    path = f"{folder}/customer-csv"
    customer = sample(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    customer.select(F.monotonically_increasing_id().alias(""), "*").write.csv(path, header=True)
    return source.read_csv(
        spark, path, "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE", index="row"
    )


@tidy
def parquet_snapshot_roundtrip(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    path = f"{folder}/orders-parquet"
    columns = ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"]
    sink.write_parquet(sample(spark, sf_dir, "orders").select(*reversed(columns)), path)
    return source.read_parquet(spark, path, columns)


@tidy
def full_refresh_idempotent(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    target = wh.FolderWarehouse(spark, f"{folder}/warehouse")
    orders = sample(spark, sf_dir, "orders")
    for _ in range(2):
        target.refresh(batch_id(AT), {"orders": orders})
    return target.table("orders").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderkey").alias("n_keys")
    )


def warehouse_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wh.table_counts({n: sample(spark, sf_dir, n) for n in ("customer", "part", "orders", "events")})


def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wh.preview(sample(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey")


@tidy
def manifest_lines(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    region = sample(spark, sf_dir, "region")
    tables = {"region": region, "empty": region.where("false"), "orders": sample(spark, sf_dir, "orders")}
    batch, zone = batch_id(AT), f"{folder}/landed"
    return sink.manifest_lines(extract_batch(spark, FrameSource(tables), Zones(zone, zone), batch, AT))


@tidy
def manifest_states(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    region = sample(spark, sf_dir, "region")
    tables = {"region": region, "empty": region.where("false"), "orders": sample(spark, sf_dir, "orders")}
    zone = f"{folder}/landed"
    manifest = extract_batch(spark, FrameSource(tables), Zones(zone, zone), batch_id(AT), AT)
    return manifest.select("table_name", "status", "row_count")


def batch_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = sample(spark, sf_dir, "events")
    return sink.status_counts(events, "event_type", F.col("value") > 1, F.col("event_id") % 5)


# Incremental reading


def incremental_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    since = F.lit(datetime(2024, 1, 15)).cast("timestamp_ntz")
    return changed_since(sample(spark, sf_dir, "events"), since, "ts").select("event_id", "user_id")


def _later(orders: DataFrame) -> DataFrame:
    """Orders a while on: some changed, some changed in the very moment of the watermark, and a third that are new."""
    key, moved = F.col("sales_order_id"), F.lit(datetime(2030, 1, 1)).cast("timestamp_ntz")
    raised = F.when(key % 50 == 7, 1.0).when(key % 10 == 1, 2.0).otherwise(0.0)
    at = F.when((key % 3 == 0) | ((key % 10 == 1) & (key % 50 != 7)), moved).otherwise(F.col("last_updated"))
    return orders.withColumns({"unit_price": F.col("unit_price") + raised, "last_updated": at})


@tidy
def incremental_merge(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """Two extracts, the second of changes only; the merged snapshot, and how many rows the second landed."""
    landed, whole = f"{folder}/landed", f"{folder}/merged"
    orders = operational(spark, sf_dir)["sales_order"]
    # Many orders share the newest moment of the first extract; some of these change in that moment.
    moment = F.lit(datetime(2029, 1, 1)).cast("timestamp_ntz")
    tied = orders.withColumn(
        "last_updated", F.when(F.col("sales_order_id") % 25 == 7, moment).otherwise(F.col("last_updated"))
    )
    states = (tied.where("sales_order_id % 3 <> 0"), _later(tied))
    for day, state in enumerate(states, 1):
        at = datetime(2024, 1, day)
        manifest = extract_changes(spark, FrameSource({"sales_order": state}), landed, batch_id(at), at)
        merge_changes(spark, landed, whole, batch_id(at), at)
    # One row a table.
    rows = manifest.first().row_count
    return source.read_landed(spark, whole, batch_id(at), "sales_order").select(
        "sales_order_id", "unit_price", "last_updated", F.lit(rows).cast("bigint").alias("n_landed")
    )


@tidy
def stable_keys(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """The fact of a second batch with late orders: known orders keep the key that the first batch gave them."""
    zones = Zones(f"{folder}/landed", f"{folder}/processed")
    tables = operational(spark, sf_dir)
    orders = tables["sales_order"]
    options = replace(OPTIONS, lasting_keys=True)
    for day, version in ((1, orders.where("sales_order_id % 3 <> 0")), (2, orders)):
        at = datetime(2024, 1, day)
        extract_batch(spark, FrameSource({**tables, "sales_order": version}), zones, batch_id(at), at, SALES_SOURCES)
        transform_batch(spark, zones, batch_id(at), at, options)
    fact = source.read_processed(spark, zones.processed, batch_id(at), "fact_sales_order")
    return fact.select("sales_record_id", "sales_order_id", "unit_price")


def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = sample(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return latest_per_key(events, ["user_id"], "ts", "event_id")


# Constraints


def dq_pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(sample(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = sample(spark, sf_dir, "events").withColumn("event_type", F.nullif("event_type", F.lit("error")))
    return quality.null_counts(events, ["event_type", "user_id"])


def dq_fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = sample(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return quality.orphan_rows(lines, "l_partkey", sample(spark, sf_dir, "part").where("p_size < 40"), "p_partkey")


def _references(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[ForeignKey], dict[str, DataFrame]]:
    """Lines, and some of the parts and suppliers that they refer to."""
    return (
        sample(spark, sf_dir, "lineitem"),
        [ForeignKey("l_partkey", "part", "p_partkey"), ForeignKey("l_suppkey", "supplier", "s_suppkey")],
        {
            "part": sample(spark, sf_dir, "part").where("p_size < 40"),
            "supplier": sample(spark, sf_dir, "supplier").where("s_nationkey < 20"),
        },
    )


def dq_fk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.orphan_counts(*_references(spark, sf_dir))


def dq_fk_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the difference of two bitmaps of keys."""
    return bitmaps.orphan_counts(*_references(spark, sf_dir))


@tidy
def bucketed_lines(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """Lines, repeated line numbers and amount of every order, from snapshots in buckets of the order key: each is
    shuffled when it is written, and never again."""
    label = folder.rsplit("-", 1)[-1]
    paths = {f"{name}_{label}": f"{folder}/{name}" for name in ("orders", "lineitem")}
    for (name, path), key in zip(paths.items(), ("o_orderkey", "l_orderkey"), strict=True):
        buckets.write_buckets(sample(spark, sf_dir, path.rsplit("/", 1)[1]), path, key, BUCKETS, name)
    with buckets.attached(spark, paths) as tables:
        return settle(order_lines(*tables.values()))


def order_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    amount = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("amount")
    places = lines.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"), amount)
    each = places.groupBy("l_orderkey").agg(
        F.sum("n").alias("n_lines"), F.sum(F.col("n") - 1).alias("n_repeated"), F.sum("amount").cast("decimal(28,2)").alias("amount")
    )
    return orders.join(each, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", "o_orderstatus", *[F.coalesce(n, F.lit(0)).alias(n) for n in ("n_lines", "n_repeated")], "amount"
    )


def dq_numeric_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = sample(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return quality.numeric_misfits(orders, F.col("o_totalprice") * 1000)


def dq_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = sample(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_id") % 7 == 0, "2024-13-01").otherwise(dates.date_text(F.col("ts"))).alias("d"),
    )
    return quality.date_misfits(texts, "d")


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every constraint of the fact at once, with faults planted in most of them."""
    tables = operational(spark, sf_dir)
    key = F.col("o_orderkey")
    orders = sample(spark, sf_dir, "orders")
    day = dates.date_text(F.col("o_orderdate"))
    fact = orders.select(
        F.when(key % 10 == 1, key - 1).otherwise(key).alias("sales_record_id"),
        as_int(key).alias("sales_order_id"),
        day.alias("created_date"),
        F.when(key % 11 == 0, "25:00:00.000").otherwise("09:30:00.000").alias("created_time"),
        F.when(key % 13 != 0, day).alias("last_updated_date"),
        F.lit("10:00:00.000").alias("last_updated_time"),
        as_int(F.when(key % 30 >= 25, -1).otherwise(key % 10)).alias("sales_staff_id"),
        as_int("o_custkey").alias("counterparty_id"),
        as_int(key % 1000).alias("units_sold"),
        (F.col("o_totalprice") * 1000).alias("unit_price"),
        as_int(key % 6).alias("currency_id"),
        as_int(key % 100).alias("design_id"),
        F.when(key % 7 == 0, "2024-13-01").otherwise(day).alias("agreed_payment_date"),
        day.alias("agreed_delivery_date"),
        as_int("o_custkey").alias("agreed_delivery_location_id"),
    )
    star_tables = {
        "fact_sales_order": fact,
        "dim_date": star.dim_date(orders, ["o_orderdate"]),
        "dim_design": star.dim_design(tables["design"].where("design_id < 90")),
        "dim_location": star.dim_location(tables["address"]),
        "dim_counterparty": star.dim_counterparty(tables["counterparty"], tables["address"]),
        "dim_staff": star.dim_staff(tables["staff"], tables["department"]),
        "dim_currency": star.dim_currency(tables["currency"], CURRENCIES),
    }
    return quality.violations(star_tables, ["fact_sales_order"])


def dq_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every constraint of every dimension at once, with faults planted in each."""
    tables = operational(spark, sf_dir)
    days = star.dim_date(sample(spark, sf_dir, "orders"), ["o_orderdate"])
    locations, staff = star.dim_location(tables["address"]), star.dim_staff(tables["staff"], tables["department"])
    faulty = {
        "dim_date": days.withColumn("day_name", F.when(F.col("day") != 13, F.col("day_name"))),
        "dim_design": star.dim_design(tables["design"]).withColumn("design_id", as_int(F.floor(F.col("design_id") / 2))),
        "dim_location": locations.withColumn("city", F.when(F.col("location_id") % 17 != 0, F.col("city"))),
        "dim_counterparty": star.dim_counterparty(tables["counterparty"], tables["address"]).withColumn(
            "counterparty_id", as_int(F.floor(F.col("counterparty_id") / 3))
        ),
        "dim_staff": staff.withColumn("email_address", F.when(F.col("staff_id") % 4 != 0, F.col("email_address"))),
        # Names for three of the five codes only.
        "dim_currency": star.dim_currency(tables["currency"]),
    }
    return quality.violations(faulty, list(faulty))


# Whole batches


@tidy
def star_batch_refresh(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """Extract, transform, check and load one batch; rows per warehouse table."""
    zones = Zones(f"{folder}/landed", f"{folder}/processed")
    target = wh.FolderWarehouse(spark, f"{folder}/warehouse")
    run_batch(spark, FrameSource(operational(spark, sf_dir)), zones, target, AT, OPTIONS)
    return wh.table_counts(wh.dump(target))


@tidy
def loaded_all_targets(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """One batch of all eleven targets, loaded in the order of their references: rows per table, and paid amounts."""
    zones = Zones(f"{folder}/landed", f"{folder}/processed")
    target = wh.FolderWarehouse(spark, f"{folder}/warehouse")
    tables = {**operational(spark, sf_dir), **purchasing(spark, sf_dir)}
    run_batch(spark, FrameSource(tables), zones, target, AT, replace(OPTIONS, targets=tuple(WAREHOUSE)))
    counts = wh.table_counts(wh.dump(target, list(WAREHOUSE))).withColumn("amount", F.lit(None).cast("decimal(38,2)"))
    paid = target.table("fact_payment").where("paid").join(target.table("dim_payment_type"), "payment_type_id")
    by_type = paid.groupBy(F.col("payment_type_name").alias("table_name")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("payment_amount").cast("decimal(38,2)").alias("amount")
    )
    return counts.unionByName(by_type)


def loaded(spark: SparkSession, sf_dir: str, folder: str, name: str) -> DataFrame:
    zones = Zones(f"{folder}/landed", f"{folder}/processed")
    target = wh.FolderWarehouse(spark, f"{folder}/warehouse")
    run_batch(spark, FrameSource(operational(spark, sf_dir)), zones, target, AT, OPTIONS)
    return target.table(name)


@tidy
def loaded_fact_sales_order(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """The fact as the warehouse holds it after a whole batch."""
    return loaded(spark, sf_dir, folder, "fact_sales_order")


@tidy
def loaded_dim_counterparty(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    return loaded(spark, sf_dir, folder, "dim_counterparty")


@tidy
def loaded_dim_currency(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    return loaded(spark, sf_dir, folder, "dim_currency")


@tidy
def stream_load_order(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """A newer, an older and a newest but broken batch land; what the warehouse then holds, and its revenue."""
    zones = Zones(f"{folder}/landed", f"{folder}/processed")
    target = wh.FolderWarehouse(spark, f"{folder}/warehouse")
    progress = f"{folder}/stream"
    tables = operational(spark, sf_dir)
    orders = tables["sales_order"]
    dearer = orders.withColumn("unit_price", F.col("unit_price") + 1)
    broken = orders.withColumn("staff_id", F.lit(-1))
    for day, version in ((2, dearer), (1, orders), (3, broken)):
        at = datetime(2024, 1, day)
        extract_batch(spark, FrameSource({**tables, "sales_order": version}), zones, batch_id(at), at, SALES_SOURCES)
        transform_batch(spark, zones, batch_id(at), at, OPTIONS)
        stream = load_arrivals(spark, zones, target, progress)
        stream.awaitTermination()
        if stream.exception():
            raise stream.exception()
    fact = target.table("fact_sales_order")
    revenue = F.sum("unit_price").cast("decimal(28,2)").alias("revenue")
    return fact.agg(F.lit(target.loaded()).alias("batch_id"), F.count(F.lit(1)).alias("n"), revenue)


@tidy
def stream_completeness(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """Events as reports: a batch is a user's week, its tables the kinds of events. Reports arrive in files of any order,
    a third of them twice; the batches that are released."""
    events = sample(spark, sf_dir, "events")
    week = F.floor((F.dayofmonth("ts") - 1) / 7)
    reports = events.select(
        F.concat_ws("-", F.col("user_id").cast("string"), week.cast("string")).alias("batch_id"),
        F.col("event_type").alias("table_name"),
        F.col("ts").alias("written_at"),
    )
    reports.repartition(4, "written_at").write.parquet(f"{folder}/reports")
    again = reports.where(events["event_id"] % 3 == 0)
    again.repartition(2, "written_at").write.mode("append").parquet(f"{folder}/reports")
    schema = "batch_id STRING, table_name STRING, written_at TIMESTAMP_NTZ"
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/reports")
    # The files divide time at random, so no report is late.
    released = complete_batches(arriving, EVENT_KINDS, "3660 DAYS")
    stream = (
        released.writeStream.option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start(f"{folder}/released", format="parquet")
    )
    stream.awaitTermination()
    if stream.exception():
        raise stream.exception()
    return spark.read.schema("batch_id STRING").parquet(f"{folder}/released")


@tidy
def snapshot_stream(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """Two landed batches, of the orders twice and once, transformed as they arrive; rows per processed table."""
    zones = Zones(f"{folder}/landed", f"{folder}/processed")
    tables = operational(spark, sf_dir)
    # The earlier state of every order, a year before and under an id of its own, besides the order itself.
    before = tables["sales_order"].withColumns(
        {
            "sales_order_id": -F.col("sales_order_id"),
            "created_at": F.col("created_at") - F.expr("INTERVAL '1' YEAR"),
        }
    )
    early = tables["sales_order"].unionByName(before)
    for at, orders in ((datetime(2024, 1, 1), early), (datetime(2024, 1, 2), tables["sales_order"])):
        landed = FrameSource({**tables, "sales_order": orders})
        extract_batch(spark, landed, zones, batch_id(at), at, SALES_SOURCES)
    stream = transform_arrivals(spark, zones, f"{folder}/stream", OPTIONS, clock=lambda: AT)
    stream.awaitTermination()
    if stream.exception():
        raise stream.exception()
    return sink.read_manifest(spark, zones.processed).select("batch_id", "table_name", "status", "row_count")


# Insight


def bi_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily sums are stored and also name the days, so the orders are scanned once."""
    daily = insight.by_day(sample(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice")
    daily = settle(daily)
    return insight.heatmap(daily, star.calendar(daily.select("date_id")))


def bi_star_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sums per counterparty and day are stored and also name the days, so the orders are scanned once."""
    orders = sample(spark, sf_dir, "orders").withColumn("counterparty_id", F.col("o_custkey"))
    daily = settle(insight.by_counterparty_day(orders, "o_orderdate", "o_totalprice"))
    days = star.calendar(daily.where("date_id IS NOT NULL").select("date_id").distinct())
    return insight.country_years(daily, days, dim_counterparty(spark, sf_dir))


def _monthly(spark: SparkSession, sf_dir: str, folder: str) -> wh.FolderWarehouse:
    """Two batches of sales in a warehouse by month; in the second, orders of some months of 1997 are dearer."""
    zones = Zones(f"{folder}/landed", f"{folder}/processed")
    target = wh.FolderWarehouse(spark, f"{folder}/warehouse", by_month={"fact_sales_order": "created_date"})
    tables = operational(spark, sf_dir)
    orders, at = tables["sales_order"], F.col("created_at")
    raised = F.when((F.year(at) == 1997) & (F.month(at) < 4), 1.0).otherwise(0.0)
    dearer = orders.withColumn("unit_price", F.col("unit_price") + raised)
    options = replace(OPTIONS, lasting_keys=True)
    for day, version in ((1, orders), (2, dearer)):
        run_batch(spark, FrameSource({**tables, "sales_order": version}), zones, target, datetime(2024, 1, day), options)
    return target


@tidy
def bi_months(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """Revenue and orders by month of 1997, from the folders of that year; and whether the second batch wrote the month."""
    target = _monthly(spark, sf_dir, folder)
    dates = target.table("dim_date").where("year = 1997")
    sold = of_days(target.table("fact_sales_order"), "created_date", dates).groupBy("in_month").agg(
        F.sum("unit_price").cast("decimal(28,2)").alias("revenue"), F.count(F.lit(1)).alias("n")
    )
    listed = target.months("fact_sales_order").listed(target.version())
    written = listed.select("in_month", (F.col("version") == target.version()).alias("rewritten"))
    return sold.join(written, "in_month").withColumnRenamed("in_month", "month")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        dim_date,
        dim_date_calendar_quarter,
        date_union,
        dim_design,
        dim_location,
        dim_counterparty,
        dim_staff,
        dim_currency,
        fact_sales_order,
        fact_sales_order_full,
        fact_by_text_key,
        fact_tied_keys,
        star_dim_counterparty,
        star_dim_staff,
        star_dim_location,
        dim_payment_type,
        dim_transaction,
        fact_purchase_order,
        fact_payment,
        nullsafe_join,
        like_escape_filter,
        json_scalar,
        flatten_records,
        record_text,
        json_snapshot_roundtrip,
        json_array_scan,
        json_array_split,
        json_drift,
        json_escapes,
        csv_snapshot_roundtrip,
        parquet_snapshot_roundtrip,
        full_refresh_idempotent,
        warehouse_table_counts,
        preview_limit,
        manifest_lines,
        manifest_states,
        batch_status,
        incremental_filter,
        incremental_merge,
        stable_keys,
        latest_version,
        dq_pk_duplicates,
        dq_not_null,
        dq_fk_orphans,
        dq_fk_counts,
        dq_fk_bitmaps,
        bucketed_lines,
        dq_numeric_fit,
        dq_date_parse,
        dq_report,
        dq_dimensions,
        star_batch_refresh,
        loaded_all_targets,
        loaded_fact_sales_order,
        loaded_dim_counterparty,
        loaded_dim_currency,
        snapshot_stream,
        stream_completeness,
        stream_load_order,
        bi_heatmap,
        bi_star_rollup,
        bi_months,
    )
}
