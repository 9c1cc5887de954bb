"""Extracts of changes, the merge by key, lasting keys, and two refreshes at once."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starloom.operators.numbering import NotAKey, with_lasting_key
from starloom.plans.increments import changes, extract_changes, merge_changes, merged, watermarks
from starloom.session import settle
from starloom.sinks.warehouse import CatalogWarehouse, FolderWarehouse, LostRace
from starloom.sources.snapshots import read_json
from starloom.sources.tables import FrameSource
from starloom.storage import batch_id, children, create, snapshot_path

THING = "thing_id INT, name STRING, last_updated TIMESTAMP_NTZ"
LANDED = {"thing": "thing_id INT, name STRING, last_updated STRING", "place": "place_id INT, city STRING"}


def day(n, hour=0):
    return datetime(2024, 5, n, hour)


def things(spark, rows):
    return spark.createDataFrame(rows, THING)


class Run:
    """A source that changes, its landed zone and its merged one."""

    def __init__(self, spark, root):
        self.spark, self.landed, self.whole = spark, f"{root}/landed", f"{root}/merged"

    def step(self, n, **tables):
        manifest = extract_changes(self.spark, FrameSource(tables), self.landed, batch_id(day(n)), day(n))
        merge_changes(self.spark, self.landed, self.whole, batch_id(day(n)), day(n), schemas=LANDED)
        return {r.table_name: r.row_count for r in manifest.collect()}

    def state(self, n, table="thing"):
        path = snapshot_path(self.whole, batch_id(day(n)), table)
        return sorted(tuple(r)[:2] for r in read_json(self.spark, path, LANDED[table]).collect())


def test_only_changes_are_landed_and_the_merge_is_whole(spark, tmp_path):
    run = Run(spark, tmp_path)
    first = [(1, "a", day(1)), (2, "b", day(2)), (3, "c", day(2))]
    assert run.step(3, thing=things(spark, first)) == {"thing": 3}
    # 3 changes in the very moment of the watermark, 4 is new in it, 1 changes later, 2 does not.
    second = [(1, "A", day(4)), (2, "b", day(2)), (3, "C", day(2)), (4, "d", day(2))]
    assert run.step(5, thing=things(spark, second)) == {"thing": 4}
    assert run.state(5) == [(1, "A"), (2, "b"), (3, "C"), (4, "d")]
    third = [*second[1:], (1, "A", day(4)), (5, "e", day(6))]
    assert run.step(7, thing=things(spark, third)) == {"thing": 2}
    assert run.state(7) == [(1, "A"), (2, "b"), (3, "C"), (4, "d"), (5, "e")]
    assert watermarks(spark, run.landed) == {"thing": "2024-05-06 00:00:00"}
    assert watermarks(spark, run.landed, before=batch_id(day(5))) == {"thing": "2024-05-02 00:00:00"}


def test_nothing_changed_keeps_the_watermark(spark, tmp_path):
    run = Run(spark, tmp_path)
    run.step(1, thing=things(spark, [(1, "a", day(1))]))
    empty = things(spark, [])
    assert run.step(2, thing=empty) == {"thing": 0}
    assert watermarks(spark, run.landed) == {"thing": "2024-05-01 00:00:00"}
    assert run.state(2) == [(1, "a")]


def test_tables_without_a_moment_are_replaced_and_absent_ones_carried_over(spark, tmp_path):
    run = Run(spark, tmp_path)
    places = spark.createDataFrame([(1, "x"), (2, "y")], LANDED["place"])
    run.step(1, thing=things(spark, [(1, "a", day(1))]), place=places)
    run.step(2, place=places.where("place_id = 2"))
    assert run.state(2) == [(1, "a")]
    assert run.state(2, "place") == [(2, "y")]


def test_a_batch_that_was_not_merged_is_not_passed_over(spark, tmp_path):
    run = Run(spark, tmp_path)
    run.step(1, thing=things(spark, [(1, "a", day(1))]))
    extract_changes(spark, FrameSource({"thing": things(spark, [(2, "b", day(2))])}), run.landed, batch_id(day(2)), day(2))
    with pytest.raises(ValueError, match="not merged"):
        run.step(3, thing=things(spark, [(3, "c", day(3))]))


def test_an_extract_that_failed_has_no_watermark(spark, tmp_path):
    run = Run(spark, tmp_path)
    run.step(1, thing=things(spark, [(1, "a", day(1))]))
    broken = things(spark, [(2, "b", day(4))]).withColumn("name", F.raise_error("no").cast("string"))
    with pytest.raises(Exception, match="no"):
        extract_changes(spark, FrameSource({"thing": broken}), run.landed, batch_id(day(2)), day(2))
    assert watermarks(spark, run.landed) == {"thing": "2024-05-01 00:00:00"}


def test_rows_without_a_moment_are_always_landed(spark):
    df = things(spark, [(1, "a", None), (2, "b", day(1)), (3, "c", day(3))])
    assert sorted(r.thing_id for r in changes(df, "2024-05-02 00:00:00").collect()) == [1, 3]
    assert changes(df, None).count() == 3


def test_merge_of_ties_nulls_and_late_versions(spark):
    before = things(spark, [(1, "old", day(2)), (2, "newer", day(5)), (3, "x", None), (None, "lone", day(1)), (9, "far", day(1))])
    landed = things(spark, [(1, "same moment", day(2)), (2, "older", day(1)), (3, "y", None), (None, "lone", day(1)), (4, "in", day(1))])
    found = merged(before, landed, "thing_id").collect()
    assert sorted([(r[0] or 0, r[1]) for r in found]) == [
        (0, "lone"), (1, "same moment"), (2, "newer"), (3, "y"), (4, "in"), (9, "far"),
    ]
    assert merged(before, landed.limit(0), "thing_id").count() == before.count()
    assert merged(before.limit(0), landed, "thing_id").count() == landed.count()


def keyed(spark, ids, known=None):
    """Keys of the ids and all pairs that are then known."""
    kept = []

    def keep(added):
        kept.append(settle(added))
        return kept[0]

    df = spark.createDataFrame([(i, f"row {i}") for i in ids], "id BIGINT, name STRING").repartition(3)
    out = with_lasting_key(df, "k", "id", known, keep, range_rows=2)
    rows = {r.id: (r.k, r.name) for r in out.collect()}
    return rows, kept[0] if known is None else known.unionByName(kept[0])


def test_known_rows_keep_their_keys(spark):
    first, known = keyed(spark, [30, 10, 20])
    assert {i: k for i, (k, _) in first.items()} == {10: 1, 20: 2, 30: 3}
    second, known = keyed(spark, [5, 10, 30, 25, 99], known)
    assert {i: k for i, (k, _) in second.items()} == {10: 1, 30: 3, 5: 4, 25: 5, 99: 6}
    # 20 was gone for a batch and has its key still.
    third, known = keyed(spark, [20, 7], known)
    assert third == {20: (2, "row 20"), 7: (7, "row 7")}
    assert keyed(spark, [], known)[0] == {}


@pytest.mark.parametrize("ids", [[1, 1, 2], [1, None]])
def test_rows_that_are_not_identified_are_refused(spark, ids):
    with pytest.raises(NotAKey):
        keyed(spark, ids)


def test_a_file_is_created_once(spark, tmp_path):
    path = f"{tmp_path}/deep/marker"
    assert create(spark, path, "first\n") and not create(spark, path, "second\n")
    assert (tmp_path / "deep" / "marker").read_text() == "first\n"
    assert children(spark, f"{tmp_path}/deep") == ["marker"]
    assert children(spark, f"{tmp_path}/nowhere") == []


def warehouses(spark, tmp_path, kind):
    if kind == "folder":
        return FolderWarehouse(spark, f"{tmp_path}/wh"), FolderWarehouse(spark, f"{tmp_path}/wh")
    name = f"race_{tmp_path.name}".replace("-", "_")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    return CatalogWarehouse(spark, name), CatalogWarehouse(spark, name)


@pytest.mark.parametrize("kind", ["folder", "catalog"])
@pytest.mark.parametrize("batch", ["20240101_000000", "20240102_000000"])
def test_of_two_refreshes_at_once_one_wins(spark, tmp_path, monkeypatch, kind, batch):
    one, two = warehouses(spark, tmp_path, kind)
    one.refresh("20240101_000000", {"t": spark.range(1)})
    write, dropped = one._write, []

    def interrupted(version, name, df):
        """The other refresh begins after this one has, and ends before it does."""
        monkeypatch.setattr(one, "_write", write)
        two.refresh("20240102_000000", {"t": spark.range(2)})
        write(version, name, df)

    drop = one._drop
    monkeypatch.setattr(one, "_write", interrupted)
    monkeypatch.setattr(one, "_drop", lambda version, names: (dropped.append(version), drop(version, names)))
    with pytest.raises(LostRace):
        one.refresh(batch, {"t": spark.range(3)})
    assert one.table("t").count() == two.table("t").count() == 2
    assert one.loaded() == "20240102_000000"
    assert len(dropped) == 1 and dropped[0].startswith(batch)
    one.refresh("20240103_000000", {"t": spark.range(4)})
    assert two.table("t").count() == 4
    with pytest.raises(LostRace):
        two.refresh("20240102_000000", {"t": spark.range(5)})
