"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to three bytes. A byte is coded in the longest context known,
and at the price of an escape in a shorter one, down to all 256 bytes alike (method C, no exclusion). Under
frozen counts that is an exact code length, and the language that codes the whole text shortest is predicted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import bounded, from_tasks, held_out, in_tasks, modest_batches, portions, settle

ORDER = 3
FOLDS, FOLD = 5, 0
UNKNOWN = "und"
#: A four-byte node is kept from a count of the root of this share of its language's bytes on: all of them up to a megabyte,
#: those seen 32 times in a gigabyte. So trees grow with the corpus, but slower, and a byte whose node is not kept is
#: coded at the price of an escape. Shorter nodes, and all totals, are of every gram.
KEPT = 1e-6
#: Bytes that one pass of array code takes; longer texts are taken in pieces, each with the bytes before it.
PIECE = 1 << 21
LETTER = re.compile(r"[^\W\d_]")

#: Bytes as they are counted: ASCII other than letters becomes a space.
_TABLE = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def _pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, list[int], np.ndarray]]:
    """Coded bytes of some texts, each after ORDER bytes of context: bytes, the texts' places, where they start."""
    pad = b" " * ORDER
    parts: list[bytes] = []
    owners: list[int] = []
    starts: list[int] = []
    size = 0

    def taken() -> tuple[np.ndarray, list[int], np.ndarray]:
        return np.frombuffer(b"".join(parts), np.uint8), list(owners), np.array(starts, np.int64)

    for i, text in enumerate(texts):
        raw = pad + text.lower().encode("utf-8", "replace").translate(_TABLE)
        for at in range(0, max(len(raw) - ORDER, 1), PIECE):
            part = raw[at : at + PIECE + ORDER]
            if size and size + len(part) > PIECE:
                yield taken()
                parts, owners, starts, size = [], [], [], 0
            parts.append(part)
            owners.append(i)
            starts.append(size)
            size += len(part)
    if parts:
        yield taken()


def _keys(raw: np.ndarray) -> np.ndarray:
    """Each byte with the ORDER bytes before it, as one number. The first ORDER bytes have none."""
    wide = raw.astype(np.uint32)
    return (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    unique, place = np.unique(np.concatenate(keys), return_inverse=True)
    return unique, np.bincount(place, np.concatenate(counts)).astype(np.int64)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of a task's texts, by language, summed before they are sent."""
    held: dict[str, tuple[list[np.ndarray], list[np.ndarray]]] = {}
    for batch in portions(batches):
        for lang, texts in batch.groupby("lang")["text"]:
            keys, counts = held.setdefault(lang, ([], []))
            for raw, _, starts in _pieces(texts.tolist()):
                if len(raw) <= ORDER:
                    continue
                inside = np.ones(len(raw), bool)
                for k in range(ORDER):
                    inside[starts + k] = False
                unique, n = np.unique(_keys(raw)[inside[ORDER:]], return_counts=True)
                keys.append(unique)
                counts.append(n)
                if len(keys) > 16:
                    keys[:], counts[:] = ([x] for x in _merge(keys, counts))
    for lang, (keys, counts) in held.items():
        if keys:
            unique, n = _merge(keys, counts)
            yield pd.DataFrame({"lang": lang, "gram": unique.astype(np.int64), "n": n})


#: Frozen counts of one language, longest contexts first: for every order the nodes and their counts, and the contexts
#: with their totals and numbers of children. Plain arrays, as they are broadcast.
Tree = list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def nodes_of(counts: DataFrame) -> DataFrame:
    """lang, size, node, n: the nodes of every order, a node of `size` + 1 bytes. `counts`: lang, gram, n of whole grams."""
    shorter = [
        F.struct(F.lit(size).alias("size"), F.col("gram").bitwiseAND(F.lit((1 << 8 * (size + 1)) - 1)).alias("node"))
        for size in range(ORDER + 1)
    ]
    nodes = counts.select("lang", "n", F.explode(F.array(*shorter)).alias("at"))
    return nodes.groupBy("lang", "at.size", "at.node").agg(F.sum("n").alias("n"))


def contexts_of(nodes: DataFrame) -> DataFrame:
    """lang, size, node, n, children: the contexts of nodes, with the sum and the number of all their nodes."""
    context = F.shiftright("node", 8).alias("node")
    return nodes.groupBy("lang", "size", context).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("children"))


def tree_of(nodes: pd.DataFrame, contexts: pd.DataFrame) -> Tree:
    """The tree of one language from its nodes and contexts."""
    tree = []
    for size in range(ORDER, -1, -1):
        of, over = (t[t["size"] == size].sort_values("node") for t in (nodes, contexts))
        tree.append(
            (
                of["node"].to_numpy().astype(np.uint32),
                of["n"].to_numpy().astype(np.float64),
                over["node"].to_numpy().astype(np.uint32),
                over["n"].to_numpy().astype(np.float64),
                over["children"].to_numpy().astype(np.int64),
            )
        )
    return tree


def key_bits(tree: Tree, keys: np.ndarray) -> np.ndarray:
    """Code length of the last byte of every key in the context of those before."""
    total = np.zeros(len(keys))
    todo = np.arange(len(keys))
    for size, (nodes, sums, contexts, totals, children) in zip(range(ORDER, -1, -1), tree, strict=True):
        gram = keys[todo] & np.uint32((1 << (8 * (size + 1))) - 1)
        at = np.minimum(np.searchsorted(contexts, gram >> np.uint32(8)), len(contexts) - 1)
        known = contexts[at] == gram >> np.uint32(8)
        mass = np.where(known, totals[at] + children[at], 1.0)
        node = np.minimum(np.searchsorted(nodes, gram), max(len(nodes) - 1, 0))
        hit = known & (nodes[node] == gram) if len(nodes) else np.zeros(len(gram), bool)
        total[todo[hit]] -= np.log2(sums[node[hit]] / mass[hit])
        miss = ~hit
        total[todo[miss]] -= np.log2(np.where(known, children[at] / mass, 1.0)[miss])
        todo = todo[miss]
    total[todo] += 8.0
    return total


def train(docs: DataFrame, kept: float = KEPT) -> dict[str, Tree]:
    """A tree for every language of the rows of `docs` that have a text and a language; counts cover all of them.

    All orders are summed in Spark before anything is left out. The driver gets the nodes to be broadcast: of up to three
    bytes all that occur, and the longest by the rule of `KEPT`.
    """
    modest_batches(docs.sparkSession)
    rows = docs.where("text is not null and lang is not null").select("text", "lang")
    counts = rows.mapInPandas(_count, "lang string, gram bigint, n bigint")
    nodes = settle(nodes_of(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))))
    contexts = contexts_of(nodes).toPandas()
    totals = contexts[contexts["size"] == 0][["lang", "n"]].itertuples(index=False)
    least = F.lit(None).cast("double")
    for lang, n in totals:
        least = F.when(F.col("lang") == lang, F.lit(float(np.sqrt(kept * n)))).otherwise(least)
    chosen = nodes.where((F.col("size") < ORDER) | (F.col("n") >= least)).toPandas()
    over = dict(tuple(contexts.groupby("lang")))
    return {lang: tree_of(own, over[lang]) for lang, own in chosen.groupby("lang")}


def code_lengths(texts: list[str], trees: list[Tree]) -> np.ndarray:
    """Bits of every whole text under every tree."""
    bits = np.zeros((len(texts), len(trees)))
    for raw, owners, starts in _pieces(texts):
        if len(raw) <= ORDER:
            continue
        keys = _keys(raw)
        unique = np.unique(keys)
        place = np.searchsorted(unique, keys)
        pads = (starts[:, None] + np.arange(ORDER) - ORDER).ravel()
        pads = pads[(pads >= 0) & (pads < len(keys))]
        at = np.minimum(starts, len(keys) - 1)
        empty = np.diff(np.append(starts, len(raw))) <= ORDER
        for k, tree in enumerate(trees):
            each = key_bits(tree, unique)[place]
            each[pads] = 0.0
            sums = np.add.reduceat(each, at)
            sums[empty] = 0.0
            np.add.at(bits[:, k], owners, sums)
    return bits


def predict(docs: DataFrame, trees: dict[str, Tree]) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, lang_pred, score, bits_per_byte.

    `und` with a score of 0 for null texts, texts without a letter, and where nothing was learned. score: share of
    the predicted language in 2^-bits over all languages; ties go to the first by name. Rows that repeat are
    scored one by one. Other columns are ignored, whatever their names. An empty table gives an empty result.
    """
    names = sorted(trees)
    shared = docs.sparkSession.sparkContext.broadcast([trees[n] for n in names])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in portions(batches):
            texts = ["" if t is None else t for t in batch["text"]]
            spoken = np.array([bool(names) and LETTER.search(t) is not None for t in texts], bool)
            best, share, rate = np.zeros(len(texts), int), np.zeros(len(texts)), np.full(len(texts), np.nan)
            if spoken.any():
                chosen = [t for t, s in zip(texts, spoken, strict=True) if s]
                bits = code_lengths(chosen, shared.value)
                best[spoken] = bits.argmin(axis=1)
                least = bits.min(axis=1)
                share[spoken] = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
                rate[spoken] = least / np.array([len(t.encode("utf-8", "replace")) for t in chosen])
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "held_out": batch["held_out"],
                    "lang_pred": [names[b] if s else UNKNOWN for b, s in zip(best, spoken, strict=True)],
                    "score": share,
                    "bits_per_byte": rate,
                }
            )

    rows = in_tasks(docs, "text", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"))
    schema = "doc_id string, held_out boolean, lang_pred string, score double, bits_per_byte double"
    return from_tasks(rows.mapInPandas(score, schema), docs)


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the texts and languages of the rows that are not held out, and predict all."""
    return predict(docs, train(docs.where(~held_out(F.col("doc_id"), FOLDS, FOLD))))
