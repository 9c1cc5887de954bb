"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a run of a few words (a seed) are tiled: again and again the longest
run that both still have unmarked is marked in both, so that passages in another order are covered too.
An item of which enough words are covered has leaked into the document.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import bounded, from_tasks, in_tasks, portions, settle, unused
from starloom.llm.tokens import mixed, passes, shingle_hashes, word_hashes

#: Words that a tile has at least; shared runs of so many words are the seeds.
TILE = 5
#: Share of an item's words, in hundredths, from which on it counts as leaked.
COVERED = 60
#: Benchmark words that are held in a task at once (about 8 bytes each, and as much for the seeds). A larger
#: benchmark is taken in blocks of so many words, one scan of the documents each.
BLOCK_WORDS = 500_000


#: Benchmark items as plain arrays, as they are broadcast: ids, words of each, and all seeds in order of their hashes
#: with the item and the place in it.
Block = tuple[list, list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]


def block_of(ids: list, texts: list[str]) -> Block:
    hashes, limits = word_hashes(texts)
    words = [hashes[a:b] for a, b in zip(limits[:-1], limits[1:], strict=True)]
    seeds = [shingle_hashes(w, TILE) if len(w) >= TILE else np.zeros(0, np.uint64) for w in words]
    hashes = np.concatenate([np.zeros(0, np.uint64), *seeds])
    order = np.argsort(hashes, kind="stable")
    item = np.repeat(np.arange(len(words)), [len(s) for s in seeds])[order]
    place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(s)) for s in seeds]])[order]
    return ids, words, hashes[order], item, place


def _runs(words: np.ndarray, length: int, marked: np.ndarray) -> np.ndarray:
    """Places at which a run of `length` words starts that has no marked word."""
    used = np.concatenate([[0], np.cumsum(marked)])
    return np.flatnonzero(used[length:] == used[:-length]) if len(words) >= length else np.zeros(0, int)


def _rolling(words: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin: hashes of all runs of `length` words, by differences of prefix sums of a polynomial mod 2^64."""
    base, inverse = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
    n = len(words)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]))
        down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, inverse, np.uint64)]))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[:n])])
        return mixed((sums[length:] - sums[:-length]) * down[: n - length + 1])


def tiled(item: np.ndarray, text: np.ndarray, least: int = TILE) -> int:
    """Words of `item` covered by greedy tiles of at least `least` words that it shares with `text`.

    From the longest possible length down, runs of unmarked words are matched by their rolling hashes and
    compared word by word before both are marked. Each length is tried by halving the range in which the longest
    match must lie, so a pass over the item is made a few times per tile.
    """
    item_marked, text_marked = np.zeros(len(item), bool), np.zeros(len(text), bool)

    def matches(length: int) -> list[tuple[int, int]]:
        own, other = _runs(item, length, item_marked), _runs(text, length, text_marked)
        if not len(own) or not len(other):
            return []
        wanted = _rolling(item, length)[own]
        there = _rolling(text, length)[other]
        found = np.isin(there, wanted)
        if not found.any():
            return []
        by_hash = defaultdict(list)
        for h, place in zip(there[found].tolist(), other[found].tolist(), strict=True):
            by_hash[h].append(place)
        pairs = ((a, b) for h, a in zip(wanted.tolist(), own.tolist(), strict=True) for b in by_hash.get(h, ()))
        return [(a, b) for a, b in pairs if (item[a : a + length] == text[b : b + length]).all()]

    longest = min(len(item), len(text))
    while longest >= least:
        low, high, best = least, longest, []
        while low <= high:
            middle = (low + high) // 2
            if found := matches(middle):
                best, low = found, middle + 1
            else:
                high = middle - 1
        if not best:
            break
        longest = high
        for a, b in best:
            if not item_marked[a : a + longest].any() and not text_marked[b : b + longest].any():
                item_marked[a : a + longest] = True
                text_marked[b : b + longest] = True
    return int(item_marked.sum())


def _near(places: np.ndarray, reach: int, length: int) -> np.ndarray:
    """Words within `reach` words after the places of shared seeds, as a mask: no tile lies outside."""
    ends = np.zeros(length + 1, np.int64)
    np.add.at(ends, places, 1)
    np.add.at(ends, np.minimum(places + reach, length), -1)
    return np.cumsum(ends)[:length] > 0


def _leaks(block: Block, covered: int, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Items that leaked into a text: place in the block, words covered, words of the item."""
    _, items, own_seeds, item_of, place_of = block
    if len(words) < TILE or not len(own_seeds):
        return
    seeds = shingle_hashes(words, TILE)
    left = np.searchsorted(own_seeds, seeds, "left")
    hit = own_seeds[np.minimum(left, len(own_seeds) - 1)] == seeds
    if not hit.any():
        return
    places, left = np.flatnonzero(hit), left[hit]
    right = np.searchsorted(own_seeds, seeds[hit], "right")
    shared: dict[int, list[int]] = defaultdict(list)
    of_item: dict[int, set[int]] = defaultdict(set)
    for at, a, b in zip(places.tolist(), left.tolist(), right.tolist(), strict=True):
        for k in range(a, b):
            item = int(item_of[k])
            shared[item].append(at)
            of_item[item].add(int(place_of[k]))
    for item, at in shared.items():
        own = items[item]
        # Tiles consist of shared seeds: what seeds do not reach cannot be covered.
        reached = _near(np.array(sorted(of_item[item])), TILE, len(own)).sum()
        if reached * 100 < covered * len(own):
            continue
        mask = _near(np.array(at), TILE, len(words))
        # Stretches without a shared seed are cut to one word that matches nothing, so tiles stay whole.
        keep = mask | np.concatenate([[False], mask[:-1]])
        text = np.where(mask, words, np.uint64(0))[keep]
        n = tiled(own, text)
        if n * 100 >= covered * len(own):
            yield item, n, len(own)


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list]:
    """Items in blocks of a bounded number of words each, dealt by a hash."""
    spark = benchmark.sparkSession
    sized = settle(
        benchmark.select("item_id", "text", F.size(F.split(F.coalesce("text", F.lit("")), r"\s+")).alias("n"))
        .where("text is not null")
        .withColumn("part", F.xxhash64("item_id", "text"))
    )
    total = sized.agg(F.sum("n")).first()[0] or 0
    n = -(-total // block_words)
    for k in range(n):
        rows = sized.where(F.pmod("part", F.lit(n)) == k) if n > 1 else sized
        yield [spark, rows.select("item_id", "text").collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, covered: int = COVERED, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Pairs of a document and a benchmark item that leaked into it: doc_id, item_id, covered_words, item_words.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Null and empty texts leak nothing, and items of
    fewer than TILE words cannot be tiled and never leak. Rows that repeat yield their pairs once each; repeated
    items likewise. Other columns are ignored, whatever their names. Empty tables give an empty result.
    """
    kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id string, item_id {kind}, covered_words int, item_words int"
    result = docs.sparkSession.createDataFrame([], schema)
    for spark, items in _blocks(benchmark, block_words):
        shared = spark.sparkContext.broadcast(block_of([i["item_id"] for i in items], [i["text"] for i in items]))

        def search(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            block = shared.value
            for batch in portions(batches):
                texts, ids, rows = batch["text"].tolist(), batch["doc_id"].tolist(), []
                for first, last in passes(texts):
                    words, limits = word_hashes(texts[first:last])
                    for i, a, b in zip(range(first, last), limits[:-1], limits[1:], strict=True):
                        rows += [(ids[i], block[0][k], n, of) for k, n, of in _leaks(block, covered, words[a:b])]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "covered_words", "item_words"])

        result = result.unionByName(in_tasks(docs.where("text is not null"), "text").mapInPandas(search, schema))
    return from_tasks(result, docs)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of `docs` into which no benchmark item leaked, with all their columns, whatever their names.

    A null doc_id with a leak goes, and so do all rows of an id of which one leaked; rows that repeat go or stay
    together. Null and empty texts stay; very long ones are searched whole. An empty benchmark takes nothing, and an
    empty table gives an empty result.
    """
    name = unused(docs, "_leaked")
    leaked = settle(find_leaks(docs, benchmark).select(F.col("doc_id").alias(name)).distinct())
    return docs.join(bounded(leaked), F.col("doc_id").eqNullSafe(F.col(name)), "left_anti")
