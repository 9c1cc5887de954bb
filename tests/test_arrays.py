"""Arrays read by many tasks, against whole-file parsing."""

import json
import random

import pytest

from starloom.session import settle
from starloom.sinks.snapshots import write_json_array
from starloom.sources import arrays
from starloom.sources.arrays import NotOneArray, is_flat, read_array
from starloom.sources.snapshots import read_json

SCHEMA = "a BIGINT, b STRING, c ARRAY<INT>"


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "500", "spark.sql.files.openCostInBytes": "1"}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key in keys:
        spark.conf.unset(key)


def records(seed, n, faults):
    rnd = random.Random(seed)
    parts = ["}", "{", "}, {", '"', "\\", "]", "[", ",", "\n", '"}', "x" * 30, "é漢", "]}", '\\"', "}\\"]
    made = []
    for k in range(n):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 9))) if rnd.random() < faults else f"plain {k}"
        made.append({"a": k, "b": rnd.choice([text, text, None]), "c": [k, 2] if k % 3 else []})
    return made


def landed(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def found(df):
    return sorted(((r["a"], r["b"], r["c"]) for r in df.collect()), key=repr)


def expected(rows):
    return sorted(((r["a"], r["b"], r["c"]) for r in rows), key=repr)


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("faults", [0, 0.02, 0.9])
@pytest.mark.parametrize("seed", [1, 2])
def test_rows_of_a_split_array(spark, tmp_path, small_splits, indent, faults, seed):
    rows = records(seed, 300, faults)
    path = landed(tmp_path, "rows.json", json.dumps(rows, indent=indent, ensure_ascii=seed == 1))
    read = read_array(spark, path, SCHEMA)
    assert found(read) == expected(rows)
    assert read.rdd.getNumPartitions() > 1 or faults


def test_a_string_longer_than_splits(spark, tmp_path, small_splits):
    rows = [{"a": 1, "b": "}" * 3000, "c": []}, {"a": 2, "b": '},{"' * 900, "c": [1]}, {"a": 3, "b": "end", "c": [2]}]
    assert found(read_array(spark, landed(tmp_path, "long.json", json.dumps(rows)), SCHEMA)) == expected(rows)


def test_several_files_and_empty_ones(spark, tmp_path, small_splits):
    rows = [records(seed, 60, seed / 3) for seed in range(3)]
    paths = [landed(tmp_path, f"{k}.json", json.dumps(r, separators=(",", ":"))) for k, r in enumerate(rows)]
    paths += [landed(tmp_path, "none.json", " [ ]\n"), landed(tmp_path, "empty.json", "")]
    assert found(read_array(spark, paths, SCHEMA)) == expected([r for part in rows for r in part])


@pytest.mark.parametrize("cut", [1, 2, 9])
@pytest.mark.parametrize("faults", [0, 1])
def test_a_cut_file_is_refused(spark, tmp_path, small_splits, cut, faults):
    text = json.dumps(records(5, 80, faults))
    with pytest.raises(NotOneArray):
        read_array(spark, landed(tmp_path, "cut.json", text[:-cut]), SCHEMA)


def test_malformed_records_fail(spark, tmp_path):
    path = landed(tmp_path, "bad.json", '[{"a": 1, "b": "x"}, {"a": oops}]')
    with pytest.raises(Exception, match="MALFORMED"):
        read_array(spark, path, SCHEMA).collect()


def test_records_inside_records_are_read_whole(spark, tmp_path):
    schema = "a INT, b STRUCT<c: INT>"
    assert not is_flat(schema) and is_flat(SCHEMA)
    with pytest.raises(ValueError):
        read_array(spark, "nowhere", schema)
    path = landed(tmp_path, "nested.json", '[{"a": 1, "b": {"c": 2}},\n {"a": 3}]')
    assert [tuple(r) for r in read_json(spark, path, schema, layout="array").collect()] == [(1, (2,)), (3, None)]


@pytest.mark.parametrize("n", [0, 1, 500])
def test_written_arrays_are_json(spark, tmp_path, small_splits, n):
    rows = records(6, n, 0.3)
    write_json_array(spark.createDataFrame([(r["a"], r["b"], r["c"]) for r in rows], SCHEMA), str(tmp_path / "out"))
    (file,) = (tmp_path / "out").glob("*.txt")
    assert json.loads(file.read_text(encoding="utf-8")) == rows
    assert found(read_json(spark, str(tmp_path / "out"), SCHEMA, layout="array")) == expected(rows)


def test_plain_splits_are_not_exchanged(spark, tmp_path, small_splits):
    path = landed(tmp_path, "plain.json", json.dumps(records(7, 300, 0)))
    plan = read_array(spark, path, SCHEMA)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("rows_a_batch", [1, 3])
@pytest.mark.parametrize("split_bytes", [60, 500, 10**7])
def test_records_over_batches_and_splits(spark, tmp_path, small_splits, rows_a_batch, split_bytes):
    rows = [*records(8, 120, 0.6), {"a": -1, "b": '}"' * 200 + "}\\", "c": []}, *records(9, 40, 1)]
    path = landed(tmp_path, "rows.json", json.dumps(rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows_a_batch))
    try:
        assert found(read_array(spark, path, SCHEMA)) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_only_ends_of_splits_are_kept_and_exchanged(spark, tmp_path, monkeypatch):
    """One split of many records, all of them cut: its pieces are joined where they are read."""
    rows, kept = records(10, 2000, 1), []
    monkeypatch.setattr(arrays, "settle", lambda df: kept.append(settle(df)) or kept[-1])
    read = arrays.read_array(spark, landed(tmp_path, "cut.json", json.dumps(rows)), SCHEMA)
    assert found(read) == expected(rows)
    assert kept[0].count() < 20 and kept[1].count() <= 3 * kept[0].count()
