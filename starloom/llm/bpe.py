"""Byte-level BPE: encoding and decoding of whole texts by a file of ranks.

A text is cut into pieces by the tokenizer's pattern. Within a piece, a segment tree over byte positions holds for every
range the least rank of a pair of neighbours, and its leftmost place; a merge changes three leaves and the way to the
root. A piece of n bytes thus takes n log n steps, however it merges.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starloom.llm.common import give_back, modest_batches

Ranks = dict[bytes, int]

#: Pieces of up to so many bytes are remembered, and so many of them twice over. What is not remembered is merged again.
SHORT, HELD = 64, 600_000
#: Rows that are taken and sent back at once, and pieces that are merged together.
SENT, TOGETHER = 100, 20_000


def read_ranks(path: str) -> Ranks:
    """Ranks by token from a file of lines "base64 rank" on the driver's machine. Tasks get them by broadcast."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


#: Beyond any rank.
UNRANKED = 1 << 31


def merge(piece: bytes, ranks: Ranks, longest: int) -> list[int]:
    """Ids of one piece. While any two neighbours have a rank, the least, and of equal ones the leftmost, become one.

    No token has more than `longest` bytes.
    """
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    # Leaf n + i is the pair that begins at i, as rank * n + i, so that the least one of a range is also the leftmost.
    # The parent of node k is k // 2, so node 1 is the least of all.
    none = UNRANKED * n
    pairs = [ranks.get(piece[i : i + 2], UNRANKED) * n + i for i in range(n - 1)]
    tree = [none] * n + pairs + [none]
    for k in range(n - 1, 0, -1):
        left, right = tree[2 * k], tree[2 * k + 1]
        tree[k] = left if left < right else right
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while tree[1] < none:
        at = tree[1] % n
        gone = after[at]
        end = after[at] = after[gone]
        # The pair that began at the byte that is gone has no leaf any more; the pairs on both sides are new.
        right, left = none, none
        if end < n:
            before[end] = at
            stop = after[end]
            if stop - at <= longest:
                right = ranks.get(piece[at:stop], UNRANKED) * n + at
        start = before[at]
        if 0 <= start and end - start <= longest:
            left = ranks.get(piece[start:end], UNRANKED) * n + start
        for k, value in ((n + gone, none), (n + at, right), (n + start, left)):
            # Where nothing stands to the left, `start` is -1, which has no leaf.
            if k < n or tree[k] == value:
                continue
            tree[k] = value
            while k > 1:
                other = tree[k ^ 1]
                k >>= 1
                if other < value:
                    value = other
                if tree[k] == value:
                    break
                tree[k] = value
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : after[at]]])
        at = after[at]
    return ids


class Pairs:
    """Rank of two neighbouring tokens, by their ids, for many pairs at once."""

    def __init__(self, ranks: Ranks) -> None:
        found = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                first, second = ranks.get(token[:cut]), ranks.get(token[cut:])
                if first is not None and second is not None:
                    found[first << 32 | second] = rank
        self.keys = np.array(sorted(found), np.int64)
        self.ranks = np.array([found[k] for k in sorted(found)], np.int64)
        self.bytes = np.array([ranks.get(bytes([b]), 0) for b in range(256)], np.int64)

    def leaves(self, first: np.ndarray, second: np.ndarray, at: np.ndarray, bits: int) -> np.ndarray:
        """Leaves of pairs that begin at `at`: rank and place in one number."""
        key = first << 32 | second
        place = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        known = self.keys[place] == key if len(self.keys) else np.zeros(len(key), bool)
        return np.where(known, self.ranks[place] if len(self.keys) else 0, UNRANKED) << bits | at


def merge_alike(pieces: list[bytes], pairs: Pairs) -> list[bytes]:
    """`merge` for pieces that need trees of one size, a step of each at a time, as bytes of 32-bit ids.

    Every row of the arrays is a piece with a tree of its own; all trees take their least pair and their three new
    leaves in the same array operations. All bytes must have an id.
    """
    m, lengths = len(pieces), np.array([len(p) for p in pieces])
    bits = max(int(lengths.max()) - 1, 1).bit_length()
    size = 1 << bits
    none = UNRANKED << bits
    places = np.arange(size)
    raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8)
    ids = pairs.bytes[raw].reshape(m, size)
    tree = np.full((m, 2 * size), none)
    leaves = pairs.leaves(ids[:, :-1].ravel(), ids[:, 1:].ravel(), np.tile(places[:-1], m), bits).reshape(m, size - 1)
    tree[:, size:-1] = np.where(places[1:] < lengths[:, None], leaves, none)
    for k in (1 << level for level in range(bits - 1, -1, -1)):
        tree[:, k : 2 * k] = np.minimum(tree[:, 2 * k : 4 * k : 2], tree[:, 2 * k + 1 : 4 * k : 2])
    after, before = np.tile(places + 1, m), np.tile(places - 1, m)
    live = (places < lengths[:, None]).ravel()
    ids, tree = ids.ravel(), tree.ravel()

    def climb(node: np.ndarray, tree_at: np.ndarray) -> None:
        for _ in range(bits):
            node = node >> 1
            under = tree_at + 2 * node
            tree[tree_at + node] = np.minimum(tree[under], tree[under + 1])

    rows = np.arange(m)
    while len(rows):
        root = tree[rows * 2 * size + 1]
        rows, root = rows[root < none], root[root < none]
        at, rank = root & (size - 1), root >> bits
        own, top = rows * size, rows * 2 * size
        gone = after[own + at]
        end = after[own + gone]
        ids[own + at], after[own + at], live[own + gone] = rank, end, False
        more = end < lengths[rows]
        before[(own + end)[more]] = at[more]
        start = before[own + at]
        led = start >= 0
        right = np.full(len(rows), none)
        right[more] = pairs.leaves(rank[more], ids[(own + end)[more]], at[more], bits)
        tree[top + size + gone], tree[top + size + at] = none, right
        tree[(top + size + start)[led]] = pairs.leaves(ids[(own + start)[led]], rank[led], start[led], bits)
        climb(size + gone, top)
        climb(size + at, top)
        climb((size + start)[led], top[led])
    flat = ids[live].astype(np.int32).tobytes()
    ends = 4 * np.cumsum(live.reshape(m, size).sum(axis=1))
    return [flat[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist(), strict=False)]


class Pieces(dict):
    """Ids by piece, as the bytes of 32-bit numbers, filled as pieces are met.

    Of bounded size: a full one becomes the older one, and the older one goes. That changes how often a piece is merged,
    not how. A broadcast one is made once in a worker process and goes on from task to task, as each learns the same.
    """

    def __init__(self, ranks: Ranks) -> None:
        super().__init__()
        self.ranks, self.longest, self.pairs = ranks, max(map(len, ranks), default=0), Pairs(ranks)
        self.older: dict[str, bytes] = {}

    def __reduce__(self) -> tuple:
        return Pieces, (self.ranks,)

    def learn(self, texts: list[list[str]]) -> None:
        """Merge all short pieces of some texts that are not held, those of one size together."""
        new: dict[int, list[tuple[str, bytes]]] = {}
        for piece in set().union(*texts).difference(self, self.older):
            raw = piece.encode("utf-8", "replace")
            if raw in self.ranks:
                self._hold(piece, array("i", [self.ranks[raw]]).tobytes())
            elif len(raw) <= SHORT:
                new.setdefault((len(raw) - 1).bit_length(), []).append((piece, raw))
        for alike in new.values():
            for first in range(0, len(alike), TOGETHER):
                part = alike[first : first + TOGETHER]
                for (piece, _), ids in zip(part, merge_alike([raw for _, raw in part], self.pairs), strict=True):
                    self._hold(piece, ids)

    def _hold(self, piece: str, ids: bytes) -> None:
        if len(self) >= HELD:
            self.older = dict(self)
            self.clear()
        self[piece] = ids

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = array("i", merge(piece.encode("utf-8", "replace"), self.ranks, self.longest)).tobytes()
        if len(piece) <= SHORT:
            self._hold(piece, ids)
        return ids


class Tokens(dict):
    """Bytes by id; no bytes for an id without a token."""

    def __missing__(self, _: int) -> bytes:
        return b""


def _type(docs: DataFrame) -> T.DataType:
    return docs.schema["doc_id"].dataType


def encode(docs: DataFrame, ranks: Ranks, pattern: str) -> DataFrame:
    """One row per row of `docs`: doc_id and ids, the token ids of the whole text in order.

    A null text counts as empty; an empty text has no ids. Very long texts and pieces are encoded whole. Rows that repeat,
    or lack an id, are encoded one by one; equal texts have equal ids, and equal ranks do not occur in a file of ranks.
    Other columns are ignored, whatever their names. An empty table gives an empty result.
    """
    modest_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, cut = shared.value, regex.compile(pattern)
        for batch in batches:
            for first in range(0, batch.num_rows, SENT):
                part = batch.slice(first, SENT)
                texts = [cut.findall(text or "") for text in part.column(1).to_pylist()]
                pieces.learn(texts)
                ids, ends = [], [0]
                for found in texts:
                    ids.append(b"".join(map(pieces.__getitem__, found)))
                    ends.append(ends[-1] + len(ids[-1]) // 4)
                joined = pa.array(np.frombuffer(b"".join(ids), np.int32))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), joined)
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["doc_id", "ids"])
            give_back()

    schema = T.StructType([T.StructField("doc_id", _type(docs)), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks: Ranks) -> DataFrame:
    """One row per row of `encoded`: doc_id, ids and raw, the bytes that the ids stand for, joined.

    The bytes of a text that was encoded are its UTF-8. Null ids, and ids without a token, stand for no bytes; no ids
    give empty bytes. Other columns are ignored. An empty table gives an empty result.
    """
    modest_batches(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(Tokens({rank: token for token, rank in ranks.items()}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value
        for batch in batches:
            for first in range(0, batch.num_rows, SENT):
                part = batch.slice(first, SENT)
                flat = part.column(1).flatten()
                ids = flat.fill_null(-1).to_numpy() if flat.null_count else flat.to_numpy()
                lengths = part.column(1).value_lengths().fill_null(0).to_numpy()
                raw, at = [], 0
                for length in lengths.tolist():
                    raw.append(b"".join(map(tokens.__getitem__, ids[at : at + length].tolist())))
                    at += length
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(raw, pa.binary())], ["doc_id", "ids", "raw"])
            give_back()

    fields = [("doc_id", _type(encoded)), ("ids", T.ArrayType(T.IntegerType())), ("raw", T.BinaryType())]
    schema = T.StructType([T.StructField(*field) for field in fields])
    return encoded.select("doc_id", "ids").mapInArrow(run, schema)
