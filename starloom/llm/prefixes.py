"""The trie of conversation prefixes, by range minima over a sorted order.

Conversations become sequences of fixed-width turn marks and are sorted across the cluster, so that every prefix has its
members side by side. Between neighbours stands the number of first turns that they share. A prefix of d turns that is
new at a place covers the rows around it as long as that number is at least d: its left and its right end are each
found by binary search in a sparse table of range minima, on its own and without any stack.

The sorted order is cut into blocks, one a task. An interval inside a block is settled there. For one that crosses an edge
between blocks, a sparse table over whole blocks gives the blocks where it begins and ends, and the parts in these two
come from their tasks, by joins. Rows at an edge are as many as the turns that two neighbours share there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import bounded, give_back, modest_batches, settle

#: Bytes of a turn's mark: of its SHA-256, so that different turns differ at any size of corpus.
MARK = 16
#: Conversations of a family of so many ids begin with the turns of its first one; at most HEADS - 1 of them.
FAMILY, HEADS = 100, 6
#: Turns of a block, on average.
BLOCK_TURNS = 200_000
#: Ids that one row carries to where the ids of a hot conversation are hashed in order.
CHUNK = 2_000
NOTHING = hashlib.sha256(b"").hexdigest()
LARGEST = np.iinfo(np.int64).max


def mark(role: Column, text: Column) -> Column:
    """Fixed-width mark of a turn; a null role or text counts as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * MARK))


def sequences(conversations: DataFrame) -> DataFrame:
    """base, conv_id and turns: an array of (turn, mark, size) by turn, nulls first, ties by content. Rows without a
    conv_id belong to no conversation. Texts stay behind: what is exchanged is a mark and a length a turn."""
    conv = F.col("conv_id").cast("bigint")
    turns = conversations.where(conv.isNotNull()).select(
        conv.alias("conv_id"),
        (conv - conv % FAMILY).alias("base"),
        F.struct(
            F.col("turn"),
            mark(F.col("role"), F.col("text")).alias("mark"),
            F.length(F.coalesce(F.col("text"), F.lit(""))).cast("bigint").alias("size"),
        ).alias("turn"),
    )
    # Dealt by base once, for the groups and for the join of a family's first conversation.
    return turns.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, key (marks in order, joined) and sizes of every conversation, rebuilt: the first h turns of its family's
    first conversation, then its own after its first h."""
    own = sequences(conversations)
    heads = own.where("conv_id = base").select("base", F.slice("turns", 1, HEADS - 1).alias("head"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    joined = own.join(heads, "base", "left").withColumn("h", h.cast("int"))
    empty = F.slice("turns", 1, 0)
    grafted = joined.select(
        "conv_id",
        F.concat(
            F.coalesce(F.slice("head", F.lit(1), F.col("h")), empty),
            F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1))),
        ).alias("turns"),
    )
    return grafted.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t.mark)), "")).alias("key"),
        F.transform("turns", lambda t: t.size).alias("sizes"),
    )


class Minima:
    """Sparse table of range minima: level k holds the least of every 2^k values in a row."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            half, last = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.minimum(last[: len(last) - half], last[half:]))
        self.n = len(values)

    def least(self, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Least value of [first, stop), which must not be empty."""
        out = np.empty(len(first), self.levels[0].dtype)
        level = np.log2(stop - first).astype(int)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][first[at]], self.levels[k][stop[at] - (1 << k)])
        return out

    def right(self, first: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first place from `first` on with a value below `depth`, or n: binary search by halving steps."""
        at = first.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            values = self.levels[k]
            inside = at + (1 << k) <= self.n
            step = inside.copy()
            step[inside] = values[at[inside]] >= depth[inside]
            at[step] += 1 << k
        return at

    def left(self, last: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last place up to `last` with a value below `depth`, or -1."""
        at = last.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            values = self.levels[k]
            inside = at + 1 >= 1 << k
            step = inside.copy()
            step[inside] = values[at[inside] + 1 - (1 << k)] >= depth[inside]
            at[step] -= 1 << k
        return at


def _sums(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(values)])


def shared_turns(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Turns that each row shares with the row before; -1 for the first row, which has none."""
    n = len(lengths)
    both = np.minimum(lengths[1:], lengths[:-1])
    row = np.repeat(np.arange(n - 1), both)
    turn = np.arange(len(row)) - np.repeat(np.cumsum(both) - both, both)
    same = (flat[starts[row] + turn] == flat[starts[row + 1] + turn]).all(axis=1)
    out = both.copy()
    np.minimum.at(out, row[~same], turn[~same])
    return np.concatenate([[-1], out])


@dataclass(frozen=True)
class Edge:
    """Of one block: its place among all that have rows, the turns shared over its left and right edges (-1 at the ends of
    the order), and whether the rows on both sides of these edges are equal."""

    at: int
    left: int
    right: int
    left_equal: bool
    right_equal: bool


class Block:
    """Sorted rows of one task with all that is asked of them. Places are in the block; n stands for its right edge."""

    def __init__(self, convs: list[int], keys: list[bytes], sizes: list[list[int]], edge: Edge) -> None:
        self.edge, self.n = edge, len(convs)
        self.convs = np.array(convs, np.int64)
        self.lengths = np.array([len(k) // MARK for k in keys], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        flat = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, MARK // 8)
        self.shared = shared_turns(flat, self.starts, self.lengths)
        self.shared[0] = edge.left
        self.spent = _sums(np.array([s for row in sizes for s in row], np.int64))
        self.minima, self.least_conv = Minima(self.shared), Minima(self.convs)
        following = np.append(self.shared[1:], edge.right)
        self.totals = self.before(np.arange(self.n), self.lengths + 1)
        known = np.maximum(self.shared, 0)
        self.sum_total = _sums(self.totals)
        self.sum_new = _sums(self.totals - self.before(np.arange(self.n), known + 1))
        self.sum_leaf = _sums(following < self.lengths)
        # Rows that begin a prefix, by what they share with the row before: children of prefixes of that depth.
        begins = np.flatnonzero((self.lengths > self.shared) & (self.shared >= 0))
        self.begun = np.sort(self.shared[begins] * (self.n + 1) + begins)
        # Rows equal to the row before go on a run; a run's first row stands for it.
        goes_on = (self.shared == self.lengths) & (np.append(-1, self.lengths[:-1]) == self.lengths)
        goes_on[0] = False
        self.run_starts = np.flatnonzero(~goes_on)

    def before(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Code points of a row's turns before its turn of that depth."""
        taken = np.clip(depth - 1, 0, self.lengths[row])
        return self.spent[self.starts[row] + taken] - self.spent[self.starts[row]]

    def children(self, depth: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        key = depth * (self.n + 1)
        return np.searchsorted(self.begun, key + stop) - np.searchsorted(self.begun, key + first)

    def runs(self) -> Iterator[tuple[int, int]]:
        return zip(self.run_starts.tolist(), np.append(self.run_starts[1:], self.n).tolist(), strict=True)

    def hashes(self) -> dict[int, str | None]:
        """SHA-256 over the ids of every run, by its first row."""
        return {first: hashlib.sha256(self.listed(first, stop).encode()).hexdigest() for first, stop in self.runs()}

    def listed(self, first: int, stop: int) -> str:
        return ",".join(map(str, self.convs[first:stop].tolist()))

    def summary(self) -> dict:
        """What other blocks need of the whole block. `floor`: the least of what is shared."""
        floor = np.array([self.shared.min()])
        return {
            "floor": int(floor[0]),
            "rows": self.n,
            "children": int(self.children(floor, np.array([0]), np.array([self.n]))[0]),
            "total": int(self.sum_total[-1]),
            "new": int(self.sum_new[-1]),
            "leaves": int(self.sum_leaf[-1]),
            "conv": int(self.convs.min()),
            "single": len(self.run_starts) == 1,
        }

    def left_part(self) -> dict[str, np.ndarray]:
        """The part in this block of every prefix that comes over its left edge."""
        depth = np.arange(self.edge.left + 1)
        zero = np.zeros_like(depth)
        stop = self.minima.right(zero, depth)
        return self._part(depth, zero, stop) | {"new": self.sum_new[stop]}

    def right_part(self) -> dict[str, np.ndarray]:
        """The part in this block of every prefix that begins here and goes over its right edge. ids: the digest of those that
        end with it, null where their run goes over the edge too."""
        depth = np.arange(self.edge.right + 1)
        first = self.minima.left(np.full_like(depth, self.n - 1), depth)
        depth, first = depth[first >= 0], first[first >= 0]
        stop = np.full_like(first, self.n)
        part = self._part(depth, first, stop)
        before = self.before(first, depth)
        part["children"] = self.children(depth, first + 1, stop) + (self.lengths[first] > depth)
        part["new"] = self.sum_new[stop] - self.sum_new[first + 1] + self.totals[first] - before
        hashes = self.hashes()
        if self.edge.right_equal:
            hashes[int(self.run_starts[-1])] = None
        ends = self.lengths[first] == depth
        ids = [hashes[f] if e else NOTHING for f, e in zip(first.tolist(), ends.tolist(), strict=True)]
        return part | {"before": before, "ends": ends, "ids": ids}

    def _part(self, depth: np.ndarray, first: np.ndarray, stop: np.ndarray) -> dict[str, np.ndarray]:
        return {
            "depth": depth,
            "rows": stop - first,
            "children": self.children(depth, first, stop),
            "total": self.sum_total[stop] - self.sum_total[first],
            "leaves": self.sum_leaf[stop] - self.sum_leaf[first],
            "conv": self.least_conv.least(first, stop) if len(depth) else depth,
        }

    def hot_ids(self) -> Iterator[tuple[bool, int, str]]:
        """Ids of runs that cross an edge, in pieces: whether it comes over the left edge, number, ids."""
        runs = list(self.runs())
        chosen = [(True, *runs[0])] if self.edge.left_equal else []
        if self.edge.right_equal and not (chosen and len(runs) == 1):
            chosen.append((False, *runs[-1]))
        for over, first, stop in chosen:
            for k, at in enumerate(range(first, stop, CHUNK)):
                yield over, k, self.listed(at, min(at + CHUNK, stop))

    def nodes(self) -> dict[str, np.ndarray | list]:
        """Every prefix that begins in this block and ends before its right edge.

        A parent that crosses an edge is named by that edge and its depth; other rows have a negative edge of their own,
        which meets nothing.
        """
        begins = np.flatnonzero(self.lengths > self.shared)
        count = (self.lengths - self.shared)[begins]
        row = np.repeat(begins, count)
        depth = self.shared[row] + 1 + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        stop = self.minima.right(row + 1, depth)
        inside = (stop < self.n) | (self.edge.right < depth)
        row, depth, stop = row[inside], depth[inside], stop[inside]
        up = depth - 1
        first = self.minima.left(row, up)
        end = self.minima.right(row + 1, up)
        over_left = (first < 0) & (up >= 0)
        over_right = ~over_left & (end == self.n) & (self.edge.right >= up) & (up >= 0)
        known = ~over_left & ~over_right & (up >= 0)
        parent = np.zeros(len(row), np.int64)
        parent[known] = self.least_conv.least(first[known], end[known])
        edge = np.where(over_left, self.edge.at, np.where(over_right, self.edge.at + 1, -1 - np.arange(len(row))))
        before = self.before(row, depth)
        rows = stop - row
        new = self.sum_new[stop] - self.sum_new[row + 1] + self.totals[row] - before
        hashes = self.hashes()
        ends = (self.lengths[row] == depth).tolist()
        return {
            "conv_id": self.least_conv.least(row, stop) if len(row) else row,
            "depth": depth,
            "parent": pa.array(parent, mask=~known),
            "edge": edge,
            "up": up,
            "n_convs": rows,
            "n_children": self.children(depth, row + 1, stop) + (self.lengths[row] > depth),
            "n_leaves": self.sum_leaf[stop] - self.sum_leaf[row],
            "saved_tokens": self.sum_total[stop] - self.sum_total[row] - rows * before - new,
            "ends_sha256": [hashes[r] if e else NOTHING for r, e in zip(row.tolist(), ends, strict=True)],
        }


def _read(batches: Iterator[pa.RecordBatch]) -> tuple[int, list, list, list]:
    block, convs, keys, sizes = -1, [], [], []
    for batch in batches:
        if batch.num_rows:
            block = batch.column(0)[0].as_py()
        convs += batch.column(1).to_pylist()
        keys += batch.column(2).to_pylist()
        sizes += batch.column(3).to_pylist()
    return block, convs, keys, sizes


def _batches(columns: dict, rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    table = pa.table({name: pa.array(v) if not isinstance(v, pa.Array) else v for name, v in columns.items()})
    yield from table.to_batches(max_chunksize=rows)


def _edges(placed: DataFrame) -> dict[int, Edge]:
    """What neighbouring blocks share over their edges: two numbers a block for the driver; keys are compared in tasks."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, first, last = -1, None, None
        for batch in batches:
            if batch.num_rows:
                block = batch.column(0)[0].as_py()
                first = batch.column(2)[0].as_py() if first is None else first
                last = batch.column(2)[-1].as_py()
        if first is not None:
            yield from _batches({"block": [block], "first": [first], "last": [last]})

    found = settle(placed.mapInArrow(ends, "block bigint, first binary, last binary"))
    blocks = sorted(r["block"] for r in found.select("block").collect())
    if len(blocks) < 2:
        return {b: Edge(k, -1, -1, False, False) for k, b in enumerate(blocks)}
    following = found.sparkSession.createDataFrame(list(zip(blocks[1:], blocks, strict=False)), "block bigint, previous bigint")
    pairs = (
        found.select("block", "first")
        .join(F.broadcast(following), "block")
        .join(found.select(F.col("block").alias("previous"), "last"), "previous")
        .select("block", "first", "last")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, equal = [], []
            for first, last in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                lengths = np.array([len(last), len(first)]) // MARK
                flat = np.frombuffer(last + first, np.uint64).reshape(-1, MARK // 8)
                shared.append(int(shared_turns(flat, np.array([0, lengths[0]]), lengths)[1]))
                equal.append(first == last)
            yield from _batches({"block": batch.column(0), "shared": shared, "equal": equal})

    over = {r["block"]: r for r in pairs.mapInArrow(compare, "block bigint, shared bigint, equal boolean").collect()}
    edges = {}
    for k, b in enumerate(blocks):
        left = over.get(b)
        right = over.get(blocks[k + 1]) if k + 1 < len(blocks) else None
        edges[b] = Edge(
            k,
            left["shared"] if left else -1,
            right["shared"] if right else -1,
            bool(left and left["equal"]),
            bool(right and right["equal"]),
        )
    return edges


PART = "kind string, at bigint, depth bigint, rows bigint, children bigint, total bigint, new bigint, leaves bigint, \
conv bigint, before bigint, ends boolean, single boolean, ids string"


def _parts(placed: DataFrame, edges: dict[int, Edge]) -> DataFrame:
    """Of every block its summary, its parts of prefixes that cross its edges, and ids of runs that do."""
    names = [field.split()[0] for field in PART.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, convs, keys, sizes = _read(batches)
        if not convs:
            return
        block = Block(convs, keys, sizes, edges[index])
        whole = block.summary()
        whole["depth"] = whole.pop("floor")
        ids = list(block.hot_ids())
        parts = [
            ("block", {k: np.array([v]) for k, v in whole.items()}),
            ("left", block.left_part()),
            ("right", block.right_part()),
            ("ids", {"ends": [i[0] for i in ids], "depth": [i[1] for i in ids], "ids": [i[2] for i in ids]}),
        ]
        schema = pa.schema(
            [
                (n, pa.string() if n in ("kind", "ids") else pa.bool_() if n in ("ends", "single") else pa.int64())
                for n in names
            ]
        )
        for kind, part in parts:
            size = len(part["depth"])
            given = {"kind": [kind] * size, "at": [block.edge.at] * size} | part
            arrays = [pa.array(given.get(n, [None] * size), schema.field(n).type) for n in names]
            yield from pa.Table.from_arrays(arrays, schema=schema).to_batches(max_chunksize=1_000)

    return settle(placed.mapInArrow(run, PART))


def _hashed(chunks: DataFrame, runs: DataFrame) -> DataFrame:
    """SHA-256 over the ids of every run that crosses an edge: `at`, the block where it begins, and `ends_sha256`.

    A digest is taken byte after byte, so a run's ids pass through one task, as a stream of joined pieces in bounded
    memory; runs are dealt to tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None
        for batch in batches:
            done = []
            for at, ids in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if at != current:
                    if current is not None:
                        done.append((current, digest.hexdigest()))
                    current, digest = at, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            if done:
                at, hashes = zip(*done, strict=True)
                yield from _batches({"at": list(at), "ends_sha256": list(hashes)})
        if current is not None:
            yield from _batches({"at": [current], "ends_sha256": [digest.hexdigest()]})

    ordered = (
        chunks.join(F.broadcast(runs), ["block", "ends"])
        .select("at", "block", "number", "ids")
        .repartition("at")
        .sortWithinPartitions("at", "block", "number")
    )
    return ordered.mapInArrow(run, "at bigint, ends_sha256 string")


def _crossing(parts: DataFrame, edges: dict[int, Edge]) -> tuple[DataFrame, DataFrame]:
    """Prefixes that cross edges: their nodes, and the conv_id of the one of every edge and depth."""
    spark = parts.sparkSession
    rows = parts.where("kind = 'block'").drop("kind", "ids").orderBy("at").collect()
    floor, children, conv = (np.array([r[c] for r in rows], np.int64) for c in ("depth", "children", "conv"))
    sums = {c: _sums(np.array([r[c] for r in rows], np.int64)) for c in ("rows", "total", "new", "leaves")}
    blocks = len(rows)
    order = np.lexsort((np.arange(blocks), floor))
    place, counted = (floor * (blocks + 1) + np.arange(blocks))[order], _sums(children[order])

    def span(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minima, least = Minima(floor), Minima(conv)
        for batch in batches:
            at, depth = (batch.column(k).to_numpy() for k in range(2))
            begin, end = minima.left(at - 1, depth), minima.right(at, depth)
            inner = end > begin + 1
            found = np.full(len(at), LARGEST)
            found[inner] = least.least(begin[inner] + 1, end[inner])
            key = depth * (blocks + 1)
            low, high = np.searchsorted(place, key + begin + 1), np.searchsorted(place, key + end)
            between = {f"mid_{c}": s[end] - s[begin + 1] for c, s in sums.items()}
            between |= {"mid_children": counted[np.maximum(high, low)] - counted[low], "mid_conv": found}
            yield from _batches({"at": at, "depth": depth, "begin": begin, "end": end} | between)

    left = parts.where("kind = 'left'").select("at", "depth", "rows", "children", "total", "new", "leaves", "conv")
    wide = "at bigint, depth bigint, begin bigint, end bigint, mid_rows bigint, mid_total bigint, mid_new bigint, \
mid_leaves bigint, mid_children bigint, mid_conv bigint"
    spans = settle(left.select("at", "depth").mapInArrow(span, wide))
    first = parts.where("kind = 'right'").select(
        F.col("at").alias("begin"), "depth", "before", F.col("ids").alias("digest"),
        *[F.col(c).alias(f"first_{c}") for c in ("rows", "children", "total", "new", "leaves", "conv")],
    )
    last = left.select(
        F.col("at").alias("end"), "depth",
        *[F.col(c).alias(f"last_{c}") for c in ("rows", "children", "total", "new", "leaves", "conv")],
    )
    joined = spans.where("at = begin + 1").join(first, ["begin", "depth"]).join(last, ["end", "depth"], "left")

    def added(name: str) -> Column:
        return F.col(f"first_{name}") + F.col(f"mid_{name}") + F.coalesce(F.col(f"last_{name}"), F.lit(0))

    nodes = settle(
        joined.select(
            "begin",
            F.least("first_conv", "mid_conv", "last_conv").alias("conv_id"),
            "depth",
            "digest",
            added("rows").alias("n_convs"),
            added("children").alias("n_children"),
            added("leaves").alias("n_leaves"),
            (added("total") - added("rows") * F.col("before") - added("new")).alias("saved_tokens"),
        )
    )
    named = spans.join(nodes.select("begin", "depth", "conv_id"), ["begin", "depth"]).select(
        F.col("at").alias("edge"), F.col("depth").alias("up"), F.col("conv_id").alias("over")
    )

    # The block where the run over a block's left edge begins, and the one over its right edge.
    start, runs = 0, []
    for edge in sorted(edges.values(), key=lambda e: e.at):
        runs.append((edge.at, True, start))
        if not (edge.left_equal and rows[edge.at]["single"]):
            start = edge.at
        runs.append((edge.at, False, start))
    runs = spark.createDataFrame(runs, "block bigint, ends boolean, at bigint")
    chunks = parts.where("kind = 'ids'").select(F.col("at").alias("block"), "ends", F.col("depth").alias("number"), "ids")
    hashes = _hashed(chunks, runs).select(F.col("at").alias("begin"), "ends_sha256")
    nodes = nodes.join(hashes, "begin", "left").select(
        "conv_id", "depth", F.lit(None).cast("bigint").alias("parent"), (F.col("begin") + 1).alias("edge"),
        (F.col("depth") - 1).alias("up"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("digest", "ends_sha256").alias("ends_sha256"),
    )
    return nodes, settle(named)


NODE = "conv_id bigint, depth bigint, parent bigint, edge bigint, up bigint, n_convs bigint, n_children bigint, \
n_leaves bigint, saved_tokens bigint, ends_sha256 string"


def trie(rows: DataFrame, blocks: int) -> DataFrame:
    """One row per node of the trie of `rows` (conv_id, key, sizes): conv_id (smallest member), depth, parent_conv_id
    (null for the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    modest_batches(rows.sparkSession)
    order = ["key", "conv_id"]
    sorted_rows = rows.repartitionByRange(blocks, *order).sortWithinPartitions(*order)
    placed = settle(sorted_rows.select(F.spark_partition_id().cast("bigint").alias("block"), "conv_id", "key", "sizes"))
    edges = _edges(placed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, convs, keys, sizes = _read(batches)
        if convs:
            yield from _batches(Block(convs, keys, sizes, edges[index]).nodes())
            give_back()

    nodes = placed.mapInArrow(run, NODE)
    if len(edges) > 1:
        crossing, named = _crossing(_parts(placed, edges), edges)
        nodes = nodes.unionByName(crossing).join(bounded(named), ["edge", "up"], "left")
    else:
        nodes = nodes.withColumn("over", F.lit(None).cast("bigint"))
    return nodes.select(
        "conv_id", "depth", F.coalesce("parent", "over").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all rebuilt `conversations` (conv_id, turn, role, text): one row per distinct sequence of first turns,
    and one for the root of depth 0, which all belong to.

    Turns are ordered by turn, nulls first, ties by their marks; rows that repeat are turns of their own. A null role or text
    counts as empty; an empty text costs nothing. Rows without a conv_id belong to no conversation. Very long texts are only
    hashed and measured. A conversation left without turns ends at the root. Other columns are ignored, whatever their
    names. An empty table gives an empty result, without a root. A single conversation's marks must fit in a task.
    """
    turns = conversations.count()
    blocks = max(conversations.sparkSession.sparkContext.defaultParallelism, -(-turns // BLOCK_TURNS))
    return trie(rebuilt(conversations), blocks)
