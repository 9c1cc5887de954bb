"""Exact similarity join of documents by the Jaccard coefficient of their word shingles, in a metric space of sets.

The Jaccard distance is a metric, so pivots can divide it. Sets that may be linked share one of their rarest
shingles, and the least set that has a shingle there is the pivot of its region: a set is replicated into the
region of each pivot that it may be linked beside. Within a region, sets are ordered by their distance from the
pivot, and by the triangle inequality a set's links lie in a window of the radius to either side. Sets
outside the largest component become pivots in turn and are compared with their window, until all others are in
one component. A region that is too large for a task is first cut into rings around its pivot, each with the ring
before it as its window, again and again; what no pivot divides is cut into blocks that meet two by two.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import bounded, from_tasks, in_tasks, portions, settle
from starloom.llm.tokens import mixed, shingle_sets
from starloom.session import scratch_path, stage
from starloom.storage import discard

WIDTH = 5
#: Hundredths.
SIMILAR = 75
#: Hundredths of a set that the search for shared shingles looks at beyond what one shared shingle takes.
EXTRA = 15
#: Shingles are counted in so many buckets. One with this share of the documents is common, and its shingles count as
#: shared. Tasks report what has half the share among their documents, which leaves out less than half of a common one.
BUCKETS, COMMON = 1 << 18, 0.01
#: A class of copies with this share of the documents is searched by one of them; there are at most 1 / HOT such classes.
HOT = 0.001
#: Sets that a task holds at once. A larger region is cut into rings, so many times, and then into blocks.
LARGE, CUTS = 4_000, 3


def least_common(n: int) -> int:
    """Shingles that a set of n shares with any set it is linked to, at least."""
    return -(-n * SIMILAR // 100)


def _extra(n: int) -> int:
    return max(n * EXTRA // 100, 1)


def _sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    return shingle_sets(texts, WIDTH)


def _prefix(shingles: np.ndarray) -> np.ndarray:
    """The least hashes of a set: so many that linked sets share `_extra` of them, or what the smaller one has."""
    n = len(shingles)
    return shingles[: max(0, n - least_common(n) + _extra(n))]


def _identity(shingles: np.ndarray) -> bytes:
    """128 bits that tell sets apart."""
    with np.errstate(over="ignore"):
        a = np.bitwise_xor.reduce(mixed(shingles + np.uint64(len(shingles))), initial=np.uint64(0))
        b = mixed(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(a).to_bytes(8, "big") + int(b).to_bytes(8, "big")


def _describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row per document, and at the end of a task its fullest buckets."""
    counts, documents = np.zeros(BUCKETS, np.int64), 0
    for batch in portions(batches):
        sizes, ids, prefixes = [], [], []
        for shingles in _sets(batch["text"].tolist()):
            sizes.append(len(shingles))
            ids.append(_identity(shingles))
            prefixes.append(_prefix(shingles))
        buckets = np.concatenate([np.zeros(0, np.uint64), *prefixes]) & np.uint64(BUCKETS - 1)
        counts += np.bincount(buckets.astype(np.int64), minlength=BUCKETS)
        documents += len(batch)
        yield pd.DataFrame({"doc_id": batch["doc_id"], "n": sizes, "id": ids, "bucket": -1, "count": 0})
    seen = np.flatnonzero(counts > max(documents * COMMON / 2, 1))
    yield pd.DataFrame({"doc_id": None, "n": 0, "id": None, "bucket": seen, "count": counts[seen]})


def describe(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """doc_id, n and id (equal for equal sets) of every document, and a mask of the common buckets."""
    schema = "doc_id string, n int, id binary, bucket int, count bigint"
    rows = settle(in_tasks(docs, "text").mapInPandas(_describe, schema))
    documents = from_tasks(rows.where("bucket = -1").select("doc_id", "n", "id"), docs)
    least = max(documents.count() * COMMON / 2, 1)
    counts = rows.where("bucket >= 0").groupBy("bucket").agg(F.sum("count").alias("n"))
    common = np.zeros(BUCKETS, bool)
    common[[r["bucket"] for r in counts.where(F.col("n") > least).collect()]] = True
    return documents, common


def candidates(docs: DataFrame, classes: DataFrame, n_documents: int, common: np.ndarray) -> DataFrame:
    """Ids of the sets that share enough shingles with other sets to be linked to one of them, and may yet not be.

    Shingles in common buckets count as shared. The others are shared if they occur in two different sets.
    """
    hot = classes.where(F.col("copies") > max(n_documents * HOT, 1)).select("id", F.col("doc_id").cast("string")).collect()
    shared = docs.sparkSession.sparkContext.broadcast((common, {bytes(r["id"]): r["doc_id"] for r in hot}))

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        common, hot = shared.value
        for batch in portions(batches):
            rows, owners, lengths, needs = [], [], [], []
            for doc_id, shingles in zip(batch["doc_id"].tolist(), _sets(batch["text"].tolist()), strict=True):
                if not len(shingles):
                    continue
                identity = _identity(shingles)
                if hot.get(identity, doc_id) != doc_id:
                    continue
                prefix = _prefix(shingles)
                known = common[(prefix & np.uint64(BUCKETS - 1)).astype(np.int64)]
                own = np.frombuffer(identity[:8], ">i8").astype(np.int64)
                rows += [own, prefix[~known].astype(np.int64)]
                owners.append(own[0])
                lengths.append(1 + int((~known).sum()))
                needs.append(_extra(least_common(len(shingles))) - int(known.sum()))
            if not owners:
                continue
            need = np.full(sum(lengths), -(1 << 30), np.int32)
            need[np.cumsum([0, *lengths[:-1]])] = needs
            hashes = np.concatenate(rows)
            yield pd.DataFrame({"hash": hashes, "own": np.repeat(np.array(owners, np.int64), lengths), "need": need})

    schema = "hash bigint, own bigint, need int"
    tokens = in_tasks(docs.where("text is not null"), "text").mapInPandas(spread, schema)
    same = Window.partitionBy("hash")
    met = tokens.select("own", "need", (F.min("own").over(same) != F.max("own").over(same)).alias("met"))
    marks = F.col("need") > -(1 << 30)
    counted = met.where(F.col("met") | marks).groupBy("own").agg(
        F.count_if(F.col("met") & ~marks).alias("shared"), F.count_if(marks).alias("rows"), F.max("need").alias("need")
    )
    found = counted.where(F.col("shared") >= F.col("need") * F.col("rows")).select("own")
    own = F.conv(F.hex(F.substring("id", 1, 8)), 16, -10).cast("bigint")
    return classes.withColumn("own", own).join(found, "own", "left_semi").select("id", "doc_id")


def _shingle_rows(docs: DataFrame, chosen: DataFrame, common: np.ndarray) -> DataFrame:
    """id, size and shingles of the chosen sets, in common buckets and in others, from one document of each."""
    ids = bounded(settle(chosen.select(F.col("doc_id").alias("chosen")).distinct()))
    texts = docs.where("text is not null").select("doc_id", "text")
    # A class of rows without an id is found by the null.
    wanted = texts.join(ids, F.col("doc_id").eqNullSafe(F.col("chosen")), "left_semi")
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        common = shared.value
        for batch in portions(batches):
            found = [s for s in _sets(batch["text"].tolist()) if len(s)]
            known = [common[(s & np.uint64(BUCKETS - 1)).astype(np.int64)] for s in found]
            yield pd.DataFrame(
                {
                    "id": [_identity(s) for s in found],
                    "n": [len(s) for s in found],
                    "rare": [s[~k].astype(np.int64) for s, k in zip(found, known, strict=True)],
                    "common": [s[k].astype(np.int64) for s, k in zip(found, known, strict=True)],
                }
            )

    rows = wanted.mapInPandas(sets, "id binary, n int, rare array<bigint>, common array<bigint>")
    # A doc_id may have other texts too.
    return rows.join(bounded(chosen.select("id")), "id", "left_semi")


def nodes_of(docs: DataFrame, chosen: DataFrame, common: np.ndarray) -> DataFrame:
    """id, n, shingles (that other chosen sets may have too, rarest first), and cells: the rarest shingles of the set, one
    of which it shares with every set that it is linked to.

    Any one order of all shingles will do for the cells. Those in common buckets come last, uncounted, so that no
    counted one is in a large share of the sets.
    """
    sets = settle(_shingle_rows(docs, settle(chosen), common))
    counted = sets.select("id", "n", F.explode("rare").alias("shingle"))
    counted = counted.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("shingle"))).where("df > 1")
    known = sets.select("id", "n", F.explode("common").alias("shingle"), F.lit((1 << 63) - 1).alias("df"))
    # Repeated rows of a set make its shingles look shared, and are one here.
    ranked = counted.unionByName(known).groupBy("id", "n").agg(
        F.array_sort(F.collect_set(F.struct("df", "shingle"))).alias("ranked")
    )
    least = F.ceil(F.col("n") * SIMILAR / 100).cast("int")
    ranked = ranked.withColumn("shingles", F.col("ranked.shingle")).where(F.size("shingles") >= least)
    # Shingles of no other set come first in the order, so the shared ones fill what is left of the prefix.
    length = F.greatest(F.size("shingles") - least + 1, F.lit(0))
    return settle(ranked.select("id", "n", "shingles", F.slice("shingles", F.lit(1), length).alias("cells")))


def linked(common, total):
    """Whether sets with so many common shingles, and so many together, are linked."""
    return common * 100 >= total * SIMILAR


def region_links(sizes: np.ndarray, sets: list[np.ndarray], pivot: int) -> list[tuple[int, int]]:
    """Links that connect what links connect among some sets, given by their sizes and the shingles that may be shared.

    First the pivot is compared with all. The sets are put in order of their distance from it; from then on each pivot
    is compared with those only whose distance from the first differs by the radius at most. A pivot is always taken
    from outside the largest component of those that have not been one. When that is all of them, each pair of
    different components has been compared or lies too far apart.
    """
    m = len(sets)
    parent = list(range(m))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def commons(mine: np.ndarray, tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
        mark[mine] = True
        sums = np.concatenate([[0], np.cumsum(mark[tokens])])
        mark[mine] = False
        return sums[starts[1:]] - sums[starts[:-1]]

    _, local = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(int(local.max()) + 1, bool)
    ends = np.cumsum([0, *map(len, sets)])
    common = commons(local[ends[pivot] : ends[pivot + 1]], local, ends)
    distance = 1 - common / (sizes + sizes[pivot] - common)
    order = np.argsort(distance, kind="stable")
    pieces = [local[ends[i] : ends[i + 1]] for i in order]
    tokens, starts = np.concatenate(pieces), np.cumsum([0, *map(len, pieces)])
    size, near = sizes[order], distance[order]
    links: list[tuple[int, int]] = []
    done = np.zeros(m, bool)
    labels = np.arange(m)
    radius = (100 - SIMILAR) / 100 + 1e-9
    at = int(np.flatnonzero(order == pivot)[0])
    while True:
        low, high = np.searchsorted(near, [near[at] - radius, near[at] + radius])
        found = commons(pieces[at], tokens[starts[low] : starts[high]], starts[low : high + 1] - starts[low])
        for k in np.flatnonzero(linked(found, size[low:high] + size[at] - found)) + low:
            a, b = root(at), root(int(k))
            if a != b:
                parent[b] = a
                links.append((int(order[at]), int(order[k])))
        done[at] = True
        labels = np.array([root(i) for i in range(m)]) if links else labels
        rest = np.flatnonzero(~done)
        if not len(rest):
            return links
        of, counts = np.unique(labels[rest], return_counts=True)
        outside = rest[labels[rest] != of[counts.argmax()]]
        if not len(outside):
            return links
        at = int(outside[0])


def _join_region(batch: pd.DataFrame) -> pd.DataFrame:
    ids = batch["id"].tolist()
    pivot = ids.index(batch["pivot"].iloc[0]) if batch["pivot"].iloc[0] in ids else 0
    found = region_links(batch["n"].to_numpy(np.int64), list(batch["shingles"]), pivot)
    return pd.DataFrame([(ids[a], ids[b]) for a, b in found], columns=["a", "b"])


def _regions(nodes: DataFrame) -> DataFrame:
    """Members of regions of several sets: region, pivot, id, windows (see `_rings`). The least set that has one of its
    rarest shingles there is the pivot for all that do; the shingles of a pivot are one region."""
    cells = nodes.select(F.explode("cells").alias("cell"), "id")
    pivots = cells.groupBy("cell").agg(F.min("id").alias("pivot"), F.count(F.lit(1)).alias("size")).where("size > 1")
    members = cells.join(pivots, "cell").select("pivot", "id").distinct()
    return members.select(F.xxhash64("pivot").alias("region"), "pivot", "id", F.lit(0).alias("windows"))


def _rings(members: DataFrame, nodes: DataFrame, cut: int) -> tuple[DataFrame, DataFrame]:
    """Links with the pivots of large regions, and their rings as regions: a set is its ring's own, and in the window of
    the next one. The innermost ring is linked to the pivot and so done.

    Bit `cut` of `windows` tells where a set is in the window only; earlier cuts' bits stay. Two sets with a bit in
    common met in the ring before at that cut, so a pair is left to a region if their bits are apart, whichever of the
    two comes from a window of an earlier cut."""
    one = nodes.select("id", "n", "shingles")
    other = nodes.select(F.col("id").alias("pivot"), F.col("n").alias("n_p"), F.col("shingles").alias("s_p"))
    met = members.join(one, "id").join(other, "pivot").withColumn("common", F.size(F.array_intersect("shingles", "s_p")))
    total = F.col("n") + F.col("n_p") - F.col("common")
    met = met.where("id != pivot").select("region", "pivot", "id", "windows", "common", total.alias("total"))
    links = met.where(linked(F.col("common"), F.col("total"))).select(F.col("id").alias("a"), F.col("pivot").alias("b"))
    # Sets within the radius are in ring 0, if by a hair.
    step = (F.col("total") - F.col("common")) * 100 / (F.col("total") * (100 - SIMILAR))
    ring = F.when(linked(F.col("common"), F.col("total")), 0).otherwise(F.greatest(F.ceil(step) - 1, F.lit(1)).cast("int"))
    placed = met.withColumn("ring", ring).withColumn("window", F.explode(F.array(F.lit(0), F.lit(1))))
    at = F.col("ring") + F.col("window")
    rings = placed.where("ring + window > 0").select(
        F.xxhash64("region", "pivot", at).alias("region"), "id", (F.col("windows") + F.col("window") * (1 << cut)).alias("windows")
    )
    return links, rings


def _blocks(members: DataFrame, sized: DataFrame) -> DataFrame:
    """Large regions cut into blocks of half a task's sets; each two blocks are a region."""
    n = F.ceil(F.col("size") * 2 / LARGE).cast("int")
    cut = members.join(sized, "region").withColumn("n", n).withColumn("block", F.pmod(F.xxhash64("id"), F.col("n")))
    each = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    pair = F.xxhash64("region", F.least("block", "other"), F.greatest("block", "other"))
    return each.select(pair.alias("region"), "pivot", "id", "windows").distinct()


def _sized(members: DataFrame) -> DataFrame:
    """Regions of several sets that no window holds all of: size, and the least of the sets in no window, or else of all, as
    the pivot."""
    own = F.when(F.col("windows") == 0, F.col("id"))
    pivot = F.coalesce(F.min(own), F.min("id")).alias("pivot")
    sizes = members.groupBy("region").agg(F.count(F.lit(1)).alias("size"), F.bit_and("windows").alias("held"), pivot)
    return sizes.where("size > 1 and held = 0").drop("held")


def join_regions(nodes: DataFrame) -> DataFrame:
    """id and label of each set that is linked: sets with links between them, however many, have one label."""
    spark = nodes.sparkSession
    folder = scratch_path(spark, "regions")

    def keep(df: DataFrame, name: str) -> DataFrame:
        return stage(df, f"{folder}/{name}")

    try:
        members, links = keep(_regions(nodes), "members-0"), []
        small = []
        for cut in range(CUTS + 1):
            sized = keep(_sized(members), f"sizes-{cut}")
            held = members.drop("pivot").join(sized, "region")
            small.append(held.where(F.col("size") <= LARGE))
            large = held.where(F.col("size") > LARGE)
            if sized.where(F.col("size") > LARGE).isEmpty():
                break
            if cut == CUTS:
                small.append(_blocks(large.drop("size"), sized.select("region", "size")))
                break
            found, rings = _rings(large.drop("size"), nodes, cut)
            links.append(keep(found, f"found-{cut}"))
            members = keep(rings, f"members-{cut + 1}")
        for k, regions in enumerate(small):
            whole = regions.select("region", "pivot", "id").join(nodes.select("id", "n", "shingles"), "id")
            found = whole.groupBy("region").applyInPandas(_join_region, "a binary, b binary")
            links.append(keep(found, f"links-{k}"))
        both = reduce(DataFrame.union, [x.select("a", "b").union(x.select("b", "a")) for x in links])
        return settle(components(keep(both.distinct(), "both"), keep))
    finally:
        discard(spark, folder)


def components(both: DataFrame, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """id and label (the least id that links reach) of all ends of links, given in both directions as a and b.

    Labels go along links and then along themselves, so that chains shorten by half or more each time. Tables between
    are written by `keep`.
    """
    labels = both.groupBy("a").agg(F.min("b").alias("b"))
    labels = keep(labels.select(F.col("a").alias("id"), F.least("a", "b").alias("label")), "labels-0")
    for k in count(1):
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id"))
        lower = labels.join(near.agg(F.min("label").alias("near")), "id")
        lower = lower.select("id", "label", F.least("label", "near").alias("low"))
        roots = labels.select(F.col("id").alias("low"), F.col("label").alias("root"))
        # A label that is lowered is also followed once: its own label is at least as low.
        followed = lower.join(roots, "low").select("id", F.least("low", "root").alias("new"), "label")
        followed = keep(followed, f"labels-{k}")
        labels = followed.select("id", F.col("new").alias("label"))
        if followed.where("new != label").isEmpty():
            return labels


def join(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id (the least doc_id that links reach, itself included).

    A set has the distinct runs of five words, A-Z lower-cased; of fewer words, the whole. Null texts and texts without
    words have none and are linked with nothing, not even each other: they reach themselves only. Equal sets are
    linked. Rows that repeat an id are documents of their own; a null id is reached by none, and such a row
    shows the least id that it reaches, or null. Other columns are ignored, whatever their names. An empty table gives
    an empty result. Shingles are compared by 64-bit hashes, equal sets found by 128 bits.
    """
    documents, common = describe(docs)
    worded = documents.where("n > 0")
    classes = settle(worded.groupBy("id").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")))
    chosen = candidates(docs, classes, documents.count(), common)
    labels = join_regions(nodes_of(docs, chosen, common))
    # Classes without links are components of their own.
    named = classes.join(labels, "id", "left").select("id", "doc_id", F.coalesce("label", "id").alias("label"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    reached = named.join(least, "label").select("id", "component_id")
    joined = worded.join(reached, "id").select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), "component_id")
    alone = documents.where("n = 0").select(
        "doc_id", F.lit(0).cast("bigint").alias("n_shingles"), F.col("doc_id").alias("component_id")
    )
    return joined.unionByName(alone)


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` of one document of each group of linked ones, that with the least id, with all their columns.

    Rows that repeat an id are one document here, which stays if it is the least of any group. Rows without an id stay.
    Null and empty texts are linked with nothing and stay; very long ones are compared whole. All columns keep their
    values, whatever their names. An empty table gives an empty result.
    """
    ids = join(docs).where("doc_id is not null").groupBy("doc_id")
    gone = ids.agg(F.max(F.col("doc_id") == F.col("component_id")).alias("least")).where(~F.col("least"))
    return docs.join(bounded(settle(gone.select("doc_id"))), "doc_id", "left_anti").select(*docs.columns)
