"""Transform (and load) batches as their manifests arrive."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from starloom import storage
from starloom.plans.batch import BrokenConstraints, Options, Zones, load_batch, record_refusal, transform_batch
from starloom.sinks.snapshots import MANIFEST, is_complete
from starloom.sinks.warehouse import Warehouse

#: How many batches a trigger takes up. It has no bearing on which batch ends up in the warehouse.
BATCHES_PER_TRIGGER = 16


def arrivals(spark: SparkSession, zone: str) -> DataFrame:
    """The manifests of a zone as a stream. A manifest is written last, so its batch is all there."""
    return (
        spark.readStream.schema(MANIFEST)
        .option("maxFilesPerTrigger", BATCHES_PER_TRIGGER)
        .json(storage.manifest_path(zone))
    )


def on_arrival(
    spark: SparkSession,
    zone: str,
    handle: Callable[[list[str]], None],
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Call `handle` with the ids of the batches that landed in `zone` since the last trigger, oldest first.

    `handle` must accept batches it has seen before: after a failure the last trigger is repeated.
    """

    def each(manifests: DataFrame, _epoch: int) -> None:
        # One manifest file is one batch, so this is at most BATCHES_PER_TRIGGER ids.
        handle(sorted(r.batch_id for r in manifests.select("batch_id").distinct().collect()))

    return (
        arrivals(spark, zone)
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def transform_arrivals(
    spark: SparkSession,
    zones: Zones,
    checkpoint: str,
    options: Options = Options(),
    clock: Callable[[], datetime] = datetime.now,
    trigger: dict | None = None,
) -> StreamingQuery:
    def handle(batches: list[str]) -> None:
        for batch in batches:
            if not is_complete(spark, zones.processed, batch):
                transform_batch(spark, zones, batch, clock(), options)

    storage.make_dir(spark, storage.manifest_path(zones.landed, ""))
    return on_arrival(spark, zones.landed, handle, checkpoint, trigger)


def load_arrivals(
    spark: SparkSession, zones: Zones, warehouse: Warehouse, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the warehouse at the newest processed batch that breaks no constraint.

    However batches arrive and triggers are cut, a batch is loaded only if it is newer than what is there. One that
    breaks a constraint is recorded as refused, and the next older one of the trigger is tried in its place.
    """

    def handle(batches: list[str]) -> None:
        for batch in reversed(batches):
            try:
                load_batch(spark, zones, batch, warehouse)
                return
            except BrokenConstraints as refused:
                record_refusal(spark, zones, batch, refused.found)

    storage.make_dir(spark, storage.manifest_path(zones.processed, ""))
    return on_arrival(spark, zones.processed, handle, checkpoint, trigger)
