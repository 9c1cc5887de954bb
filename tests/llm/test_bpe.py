"""Encoding by ranks against the public library, and exact round trips."""

import base64
import hashlib
from array import array

import duckdb
import public_tokenizers
import pytest
import tiktoken
from compare import TESTDATA
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.llm import bpe, catalog

ROWS = [
    (1, None),
    (2, ""),
    (3, "It's 12 o'clock,\n\n  they'll   say \t"),
    (4, "naïve 漢字 😀 é ​　\x1c\x85"),
    (5, "<|endoftext|> is ordinary text"),
    (6, "a" * 40_000 + " " * 40_000 + "1234567890" * 4_000),
    (7, "word " * 50_000),
    (7, "word " * 50_000),
    (None, "no id"),
]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    lines = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb")
    given = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    assert given == ranks
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=given, special_tokens={})


def slow_merge(piece, ranks):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        _, i = min(pairs)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@given(st.text("abc", max_size=40), st.lists(st.text("abc", min_size=2, max_size=5), max_size=30))
@settings(max_examples=300, deadline=None)
def test_merges_equal_the_plain_loop(piece, tokens):
    ranks = {t.encode(): n for n, t in enumerate(dict.fromkeys(["a", "b", "c", *tokens]))}
    raw, longest = piece.encode(), max(map(len, ranks))
    expected = [ranks[raw]] if raw in ranks else slow_merge(raw, ranks)
    assert raw == b"" or bpe.merge(raw, ranks, longest) == expected


@given(st.lists(st.text("abc", min_size=3, max_size=4), min_size=1), st.lists(st.text("abc", min_size=2, max_size=5), max_size=30))
@settings(max_examples=300, deadline=None)
def test_merges_side_by_side_equal_single_ones(pieces, tokens):
    ranks = {bytes([b]): b for b in range(256)}
    ranks |= {t.encode(): 256 + n for n, t in enumerate(dict.fromkeys(tokens))}
    raw = [p.encode() for p in pieces if p.encode() not in ranks]
    found = bpe.merge_alike(raw, bpe.Pairs(ranks)) if raw else []
    assert [list(array("i", ids)) for ids in found] == [slow_merge(p, ranks) for p in raw]


def test_forgetting_pieces_changes_nothing(ranks, monkeypatch):
    words = [f"w{n % 11}x{n % 7}" for n in range(200)]
    many = bpe.Pieces(ranks)
    expected = [many[w] for w in words]
    monkeypatch.setattr(bpe, "HELD", 3)
    few = bpe.Pieces(ranks)
    assert [few[w] for w in words] == expected
    assert len(few) <= 3 and len(few.older) <= 3


def test_edge_texts_equal_the_library(spark, ranks, library):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string").withColumns(
        {name: F.lit("x") for name in ("ids", "raw", "n_tokens", "pieces")}
    )
    found = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks).collect()
    expected = [(d, library.encode_ordinary(t or ""), (t or "").encode()) for d, t in ROWS]
    assert sorted(map(repr, ((r["doc_id"], r["ids"], bytes(r["raw"])) for r in found))) == sorted(map(repr, expected))


def test_decoding_ids_without_tokens(spark, ranks):
    encoded = spark.createDataFrame([("a", [39, None, 10**9]), ("b", None), ("c", [])], "doc_id string, ids array<int>")
    found = {r["doc_id"]: bytes(r["raw"]) for r in bpe.decode(encoded, ranks).collect()}
    assert found == {"a": library_token(ranks, 39), "b": b"", "c": b""}


def library_token(ranks, rank):
    return next(token for token, n in ranks.items() if n == rank)


def test_empty_table(spark, ranks):
    nothing = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.decode(bpe.encode(nothing, ranks, public_tokenizers.PATTERN), ranks).collect() == []


def test_query_equals_the_library(spark, library):
    path = TESTDATA / "sf0.001" / "documents.parquet"
    expected = set()
    for doc, text in duckdb.sql(f"SELECT doc_id, text FROM '{path}'").fetchall():
        ids = library.encode_ordinary(text or "")
        listed = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        expected.add((doc, len(ids), listed, hashlib.sha256((text or "").encode()).hexdigest()))
    found = catalog.QUERIES["op12_byte_bpe"](spark, str(TESTDATA / "sf0.001")).collect()
    assert {tuple(r) for r in found} == expected
