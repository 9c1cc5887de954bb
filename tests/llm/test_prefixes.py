"""The trie against a plain one, over one block and over many that prefixes cross."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.llm import prefixes

SCHEMA = "conv_id bigint, turn int, role string, text string"


def plain_trie(rows):
    """The contract by its words: `rows` are (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - int(np.fmod(c, 100)), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def below(node):
        leaves, saved = int(not children[node]), (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        for child in children[node]:
            a, b = below(child)
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    out = set()
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.add((min(convs), len(node), parent, len(convs), len(children[node]), *below(node), sha))
    return out


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def generated(seed, convs, longest, kinds, copies=0):
    """Conversations with shared beginnings; the last `copies` ids hold one and the same."""
    rnd = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rnd.randint(1, longest)):
            rows.append((c * 3 - 60, t, rnd.choice(["user", None, "tool"]), rnd.choice(["", "a", "é😀", None, "xyz"][:kinds])))
    for c in range(copies):
        rows += [(10_000 + c, t, "user", f"turn {t}") for t in range(7)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("blocks", [1, 2, 7, 64])
@pytest.mark.parametrize("shape", [(1, 150, 3, 2, 0), (2, 80, 9, 5, 300), (3, 5, 2, 1, 900)])
def test_trie_equals_the_plain_one(spark, blocks, shape):
    rows = generated(*shape)
    conversations = spark.createDataFrame(rows, SCHEMA)
    assert found(prefixes.trie(prefixes.rebuilt(conversations), blocks)) == plain_trie(rows)


def test_ids_of_a_hot_run_in_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "CHUNK", 7)
    rows = generated(4, 10, 3, 3, 500)
    conversations = spark.createDataFrame(rows, SCHEMA)
    assert found(prefixes.trie(prefixes.rebuilt(conversations), 9)) == plain_trie(rows)


def test_edge_rows(spark):
    rows = [
        (None, 1, "user", "nobody's"),
        (None, None, None, None),
        (5, None, None, None),
        (5, 2, "user", "long " * 100_000),
        (5, 2, "user", "long " * 100_000),
        (5, 2, "user", "b"),
        (105, 0, "", ""),
        (100, 0, "user", "a"),
        (-7, 1, "r", "t"),
        (-107, 1, "r", "t"),
        (2**40, 1, "r", "t"),
    ]
    plain = spark.createDataFrame(rows, SCHEMA)
    clashing = plain.withColumns({c: F.lit("x") for c in ("key", "base", "sizes", "depth", "edge", "block", "at", "h", "head")})
    assert found(prefixes.prefix_trie(clashing)) == plain_trie(rows)


def test_conversation_left_without_turns(spark):
    lone = next(c for c in range(201, 299) if zlib.crc32(str(c).encode()) % 6 >= 1)
    rows = [(lone, 0, "user", "gone")]
    expected = {(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())}
    assert found(prefixes.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == expected == plain_trie(rows)


def test_empty_table(spark):
    empty = prefixes.prefix_trie(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == []
    assert empty.columns == prefixes.prefix_trie(spark.createDataFrame([(1, 1, "a", "b")], SCHEMA)).columns


@given(st.lists(st.integers(-1, 4), min_size=1, max_size=40), st.data())
@settings(max_examples=200, deadline=None)
def test_extents_equal_scans(values, data):
    minima = prefixes.Minima(np.array(values))
    at, depth = data.draw(st.integers(0, len(values) - 1)), data.draw(st.integers(-1, 5))
    right = next((i for i in range(at, len(values)) if values[i] < depth), len(values))
    left = next((i for i in range(at, -1, -1) if values[i] < depth), -1)
    assert minima.right(np.array([at]), np.array([depth]))[0] == right
    assert minima.left(np.array([at]), np.array([depth]))[0] == left
    stop = data.draw(st.integers(at + 1, len(values)))
    assert minima.least(np.array([at]), np.array([stop]))[0] == min(values[at:stop])
