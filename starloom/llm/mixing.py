"""Mixing sources to target weights: a token budget goes down a tree of domains, languages and sources.

A node's share that its documents cannot fill goes to its siblings first, and only what the whole family cannot
take goes to the families beside it. Each leaf then gives the first tokens of its seeded order.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import bounded, settle, words_of

LEVELS = ("domain", "lang", "source")
LEAF = [f"_{level}" for level in LEVELS]
ADDED = ("_tokens", "_whole", "_part")
BUCKETS = 1 << 16
HASH_BITS = 48


def weight_of(node: Column, weights: Mapping[str, int]) -> Column:
    """Relative weight of a node among its siblings; those not named weigh 1."""
    named = [F.when(node == name, F.lit(weight)) for name, weight in weights.items()]
    return F.coalesce(*named, F.lit(1)).cast("bigint")


def seeded(doc_id: Column, epoch: Column, seed: str) -> Column:
    """Place of a document in an epoch's order: 48 bits of a digest; a null id counts as empty text."""
    key = F.concat_ws(":", F.lit(seed), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def _share(children: DataFrame, parent: list[str]) -> DataFrame:
    """Split each family's `budget` over its children by `weight`, none above its `capacity`; integers throughout.

    Taken by rising capacity per weight, a child is full if its share of what is left reaches its capacity. The
    others share what the full ones leave, rounded down, so a family may stay under its budget by a token a child.
    """
    family = Window.partitionBy(*parent, "budget") if parent else Window.partitionBy(F.lit(0), "budget")
    rising = family.orderBy(F.col("capacity") / F.col("weight"), "capacity", *children.columns[: len(parent) + 1])
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.sum("capacity").over(before), F.lit(0))
    left = F.sum("weight").over(family) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    full = F.expr("capacity * _left <= weight * greatest(budget - _taken, 0)")
    ordered = children.withColumns({"_taken": taken, "_left": left}).withColumn("_full", full)
    open_ = ~F.col("_full")
    shared = ordered.withColumns(
        {
            "_rest": F.col("budget") - F.sum(F.when(F.col("_full"), F.col("capacity")).otherwise(0)).over(family),
            "_weights": F.sum(F.when(open_, F.col("weight")).otherwise(0)).over(family),
        }
    )
    share = F.when(F.col("_full"), F.col("capacity")).otherwise(F.expr("_rest * weight div greatest(_weights, 1)"))
    return shared.withColumn("share", share).drop("_taken", "_left", "_full", "_rest", "_weights")


def budgets(leaves: DataFrame, percent: int, max_epochs: int, weights: tuple[Mapping[str, int], ...]) -> DataFrame:
    """Token budget per leaf. `leaves`: the levels' columns and `tokens`.

    The budget is `percent` of all tokens, at most what `max_epochs` passes over every leaf hold.
    """
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("_total"))
    nodes = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    given = total.select(
        F.least(F.expr(f"_total * {percent} div 100"), F.col("_total") * max_epochs).alias("budget"),
        F.lit(0).alias("_root"),
    )
    for depth in range(1, len(LEAF) + 1):
        names, parent = LEAF[:depth], LEAF[: depth - 1]
        level = nodes.groupBy(*names).agg(F.sum("capacity").alias("capacity"))
        level = level.withColumn("weight", weight_of(F.col(names[-1]), weights[depth - 1]))
        on = parent or ["_root"]
        level = (level if parent else level.withColumn("_root", F.lit(0))).join(given, on).drop("_root")
        level = level.select(*names, "capacity", "weight", "budget")
        given = _share(level, parent).select(*names, F.col("share").alias("budget"))
    return nodes.join(given, LEAF).select(*LEAF, "tokens", "budget")


def _placed(rows: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """`rows` with their leaf's plan, their place in its partial epoch, and the bucket of the place."""
    placed = rows.join(bounded(plan), LEAF).withColumn("_place", seeded(F.col("doc_id"), F.col("_whole"), seed))
    return placed.withColumn("_bucket", F.expr(f"_place div {(1 << HASH_BITS) // BUCKETS}"))


def _mixed(
    docs: DataFrame,
    percent: int,
    max_epochs: int,
    seed: str,
    domains: Mapping[str, str] | None,
    weights: tuple[Mapping[str, int], ...],
) -> DataFrame:
    """The columns of `docs` by number, as c0, c1 and so on, which meet no helper's name, with LEAF and ADDED."""
    names = {name.lower(): f"c{k}" for k, name in enumerate(docs.columns)}
    own = list(names.values())
    doc_id, text, lang, source = (F.col(names[c]) for c in ("doc_id", "text", "lang", "source"))
    mapped = F.lit(None).cast("string")
    for name, domain in (domains or {}).items():
        mapped = F.when(source == name, F.lit(domain)).otherwise(mapped)
    rows = docs.toDF(*own).select(
        *own,
        doc_id.alias("doc_id"),
        F.coalesce(mapped, F.lit("other")).alias("_domain"),
        F.coalesce(lang, F.lit("und")).alias("_lang"),
        F.coalesce(source, F.lit("unknown")).alias("_source"),
    )
    tokens = F.size(words_of(text)).cast("bigint")
    # One narrow row per document: the texts are read again at the end, and never shuffled but for the edges.
    narrow = settle(rows.select("doc_id", tokens.alias("_tokens"), *LEAF))
    leaves = settle(narrow.groupBy(*LEAF).agg(F.sum("_tokens").alias("tokens")))
    share = budgets(leaves, percent, max_epochs, weights)
    whole, rest = F.expr("budget div greatest(tokens, 1)"), F.expr("budget % greatest(tokens, 1)")
    plan = settle(share.select(*LEAF, whole.cast("int").alias("_whole"), rest.alias("_rest")))
    # The bucket of a leaf's order in which its prefix ends, and the tokens before it; none if no epoch is partial.
    sums = _placed(narrow, plan, seed).groupBy(*LEAF, "_rest", "_bucket").agg(F.sum("_tokens").alias("_sum"))
    running = Window.partitionBy(*LEAF).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(running), F.lit(0)))
    edges = sums.where("_before < _rest and _before + _sum >= _rest").select(
        *LEAF, F.col("_bucket").alias("_edge"), "_before"
    )
    edges = bounded(settle(edges))
    # In that bucket, rows that are alike in place, id and tokens are one group. Of these narrow groups, one ends the
    # prefix: those before it are taken whole, those after it not at all.
    alike = [*LEAF, "_place", "doc_id", "_tokens"]
    inside = Window.partitionBy(*LEAF).orderBy("_place", "doc_id", "_tokens").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_before") + F.coalesce(F.sum(F.col("_tokens") * F.col("_rows")).over(inside), F.lit(0))
    groups = _placed(narrow, plan, seed).join(edges, LEAF).where("_bucket = _edge")
    groups = groups.groupBy(*alike, "_rest", "_before").agg(F.count(F.lit(1)).alias("_rows")).withColumn("_start", start)
    last = groups.where("_start < _rest and _start + _tokens * _rows >= _rest").select(
        *LEAF, F.struct("_place", "doc_id", "_tokens").alias("_last"), "_start"
    )
    every = _placed(rows, plan, seed).withColumn("_tokens", tokens)
    every = every.join(edges, LEAF, "left").join(bounded(settle(last)), LEAF, "left")
    group, in_edge = F.struct("_place", "doc_id", "_tokens"), F.col("_bucket") == F.col("_edge")
    every = every.withColumn("_ends", F.coalesce(in_edge & (group == F.col("_last")), F.lit(False)))
    # Rows of the group that ends the prefix are interchangeable: one a leaf, but where rows repeat.
    nth = F.row_number().over(Window.partitionBy(*LEAF).orderBy(F.lit(0))) - 1
    ends = every.where("_ends").withColumn("_nth", nth)
    ends = ends.withColumn("_part", F.expr("greatest(0, least(_tokens, _rest - _start - _nth * _tokens))"))
    earlier = (F.col("_bucket") < F.col("_edge")) | (in_edge & (group < F.col("_last")))
    clear = every.where("not _ends").withColumn("_part", F.when(earlier, F.col("_tokens")).otherwise(0))
    columns = [*own, *LEAF, *ADDED]
    return clear.select(*columns).unionByName(ends.select(*columns))


def mix(
    docs: DataFrame,
    percent: int = 50,
    max_epochs: int = 2,
    seed: str = "mix-1",
    domains: Mapping[str, str] | None = None,
    weights: tuple[Mapping[str, int], ...] = ({}, {}, {}),
) -> DataFrame:
    """Rows of `docs` with `_domain`, `_lang`, `_source`, `_tokens`, `_whole` and `_part`.

    `_whole`: epochs that take the row whole. `_part`: tokens taken in the last, partial epoch: those of the
    leaf's prefix in seeded order, so at most one document of a leaf is cut. Rows that give nothing stay, with 0 and 0.

    domains: source to domain, `other` for those not named. A null language counts as `und`, a null source as
    `unknown`, a null id as empty text. Null and empty texts have no tokens and give nothing; long ones are counted whole.
    Rows that repeat, even by id, are told apart by tokens and then arbitrarily, which yields the same rows. An empty
    table gives an empty result. Columns of `docs` keep their values, whatever their names; those named as the six
    results are replaced.
    """
    mixed = _mixed(docs, percent, max_epochs, seed, domains, weights)
    own = [F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns) if c.lower() not in {*LEAF, *ADDED}]
    return mixed.select(*own, *LEAF, *ADDED)


def chosen(
    docs: DataFrame,
    percent: int,
    seed: str = "mix-1",
    domains: Mapping[str, str] | None = None,
    weights: tuple[Mapping[str, int], ...] = ({}, {}, {}),
) -> DataFrame:
    """The rows of `docs` that one epoch takes, with all their columns; those that the end of a prefix cuts stay whole.

    Nulls, repeated rows and empty tables as in `mix`: null and empty texts have no tokens and are not taken. All columns
    keep their values, whatever their names.
    """
    mixed = _mixed(docs, percent, 1, seed, domains, weights)
    own = [F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)]
    return mixed.where("_whole > 0 and _tokens > 0 or _part > 0").select(*own)
