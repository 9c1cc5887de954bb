"""Licence scan: runs of words compared with licence templates by the Dice coefficient over bags of word bigrams.

Texts are normalised to lower-case words of letters and digits, however they are broken into lines. A template is compared
with runs of as many words as it has, or to the end of the text, that start at a bigram which both have: any other run
shares no more with it than the one that starts at its first shared bigram. The coefficient of bags of a and b
bigrams is at most 2 min(a, b) / (a + b), so a run must hold a least number of the template's bigrams; runs that
do not are ruled out by the places of shared bigrams alone, before their own are made.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import once

WORDS = r"[\p{L}\p{N}]+"
#: Hundredths.
LEAST = 80

#: Wordings of notices, by SPDX id.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.",),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "proprietary": ("All rights reserved.",),
}


def normal_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORDS), F.lit(0))


def bigrams(words: Column) -> Column:
    last = F.size(words) - 2
    pairs = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)))
    return F.when(last >= 0, pairs).otherwise(F.array().cast("array<string>"))


def fewest(own: int, least: int) -> int:
    """Bigrams that a run shares at least with a template of `own` bigrams if their coefficient reaches `least` hundredths.

    It shares no more than its own size m, and 2 m / (m + own) must reach it.
    """
    return max(1, -(-own * least // (200 - least)))


def template_table(docs: DataFrame, templates: Mapping[str, tuple[str, ...]]) -> DataFrame:
    """Each template: its number, licence, own size, and its bigrams with their counts. As long as the templates are,
    whatever the corpus."""
    rows = [(n, name, text) for n, (name, text) in enumerate(_listed(templates))]
    table = docs.sparkSession.createDataFrame(rows, "template int, licence string, text string")
    table = table.select("template", "licence", bigrams(normal_words(F.col("text"))).alias("own"))
    counted = F.transform(
        F.array_distinct("own"),
        lambda b: F.struct(b.alias("bigram"), F.size(F.filter("own", lambda x: x == b)).alias("n")),
    )
    return table.select("template", "licence", F.size("own").alias("own_size"), counted.alias("counted"))


def words_by_line(text: Column) -> Column:
    """Words of a text in order, each with the number of its line."""
    return F.flatten(
        F.transform(
            F.split(text, "\n", -1),
            lambda line, at: F.transform(normal_words(line), lambda w: F.struct(w.alias("word"), at.alias("line"))),
        )
    )


def runs_of(words: Column, templates: list[list[str]], least: int) -> Column:
    """Runs that may match a template: its number, where they start, and how many words they have."""
    grams = [list(map(" ".join, zip(own, own[1:], strict=False))) for own in templates]
    firsts = sorted({own[k] for own in templates for k in range(len(own) - 1)})
    every = sorted({gram for own in grams for gram in own})

    def gram(at: Column) -> Column:
        return F.concat_ws(" ", F.get(words, at).word, F.get(words, at + 1).word)

    places = F.sequence(F.lit(0), F.greatest(F.size(words) - 2, F.lit(0)))
    shared = F.filter(places, lambda at: F.get(words, at).word.isin(firsts) & gram(at).isin(every))
    hits = F.transform(shared, lambda at: F.struct(at.alias("at"), gram(at).alias("gram")))

    def of_template(k: int, hits: Column) -> Column:
        size, few = len(templates[k]), fewest(len(grams[k]), least)
        mine = F.transform(F.filter(hits, lambda h: h.gram.isin(grams[k])), lambda h: h.at)

        def dense(mine: Column) -> Column:
            """Starts from which on the template's span holds so many shared bigrams."""
            starts = F.filter(mine, lambda at, n: F.get(mine, n + few - 1) <= at + size - 2)
            return F.transform(
                starts,
                lambda at: F.struct(
                    F.lit(k).alias("template"), at.alias("start"), F.least(F.lit(size), F.size(words) - at).alias("length")
                ),
            )

        return once(mine, dense)

    chosen = [k for k, own in enumerate(grams) if own]
    return once(hits, lambda hits: F.flatten(F.array(*[of_template(k, hits) for k in chosen])))


def scan(docs: DataFrame, templates: Mapping[str, tuple[str, ...]] = TEMPLATES, least: int = LEAST) -> DataFrame:
    """One row per document and licence found: doc_id, licence, dice (the best), line (where the first best run starts,
    from 0), lines (that this run touches).

    Null and empty texts have no licence; very long ones are scanned whole. Rows that repeat an id are taken as one
    document. Among equally good runs the first by word and then the shortest is named. Templates of fewer than two words
    match nothing. Other columns are ignored, whatever their names. An empty table gives an empty result.
    """
    plain = [_plain_words(text) for _, text in _listed(templates)]
    worded = docs.where("text is not null").select("doc_id", words_by_line(F.col("text")).alias("words"))
    runs = worded.select("doc_id", "words", F.explode(once(F.col("words"), lambda w: runs_of(w, plain, least))).alias("run"))
    first, last = F.get("words", F.col("run.start")).line, F.get("words", F.col("run.start") + F.col("run.length") - 1).line
    parts = runs.select(
        "doc_id",
        "run.template",
        "run.start",
        "run.length",
        first.alias("line"),
        (last - first + 1).alias("lines"),
        F.transform(F.slice("words", F.col("run.start") + 1, F.col("run.length")), lambda w: w.word).alias("own_words"),
    ).select("*", bigrams(F.col("own_words")).alias("bigrams"))
    common = F.aggregate(
        "counted",
        F.lit(0),
        lambda a, t: a + F.least(t.n, F.size(F.filter("bigrams", lambda x: x == t.bigram))),
    )
    size = F.col("length") - 1
    met = parts.join(F.broadcast(template_table(docs, templates)), "template").withColumn("common", common)
    met = met.where(F.col("common") * 200 >= (size + F.col("own_size")) * least)
    dice = (F.col("common") * 2) / (size + F.col("own_size"))
    best = F.max(F.struct(dice.alias("dice"), (-F.col("start")).alias("start"), (-F.col("length")).alias("length"), "line", "lines"))
    found = met.groupBy("doc_id", "licence").agg(best.alias("best"))
    return found.select("doc_id", "licence", "best.dice", "best.line", "best.lines")


def _listed(templates: Mapping[str, tuple[str, ...]]) -> list[tuple[str, str]]:
    return [(name, text) for name, texts in templates.items() for text in texts]


def _plain_words(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()
