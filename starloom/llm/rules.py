"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import WORD, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
REPEATED_PERCENT = 30

#: Frequent function words of the languages that the rules are meant for, in natural order. A parameter.
STOP_WORDS = tuple(
    dict.fromkeys(
        "the be to of and a in that it is was are for with as on at by this from an or not which "
        "der die das und in den von zu mit sich auf für ist im dem nicht ein eine des als auch es an werden aus "
        "le la les de des et un une du en est que qui dans pour par sur pas au avec ce il se ne plus "
        "el los las del y por para con una su al lo como más no se un que la de en es".split()
    )
)


@dataclass(frozen=True)
class Rule:
    """Fails a text unless low <= 1000 * part / whole <= high, both integer columns. A whole of 0 passes."""

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None

    def fails(self) -> Column:
        part, whole = F.col(self.part) * 1000, F.col(self.whole)
        bounds = []
        if self.low is not None:
            bounds.append(part < whole * self.low)
        if self.high is not None:
            bounds.append(part > whole * self.high)
        return reduce(lambda a, b: a | b, bounds)


#: In thousandths.
RULES = (
    Rule("word_length", "word_chars", "n_words", low=1500, high=20000),
    Rule("symbols", "n_symbols", "n_words", high=100),
    Rule("stop_words", "n_stop_words", "n_words", low=30),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=500),
    Rule("echoed_words", "n_echoed_words", "n_words", high=300),
)


def _repeated_words(hashes: Column, width: int = WINDOW) -> Column:
    """Words that lie in a window of `width` words found twice or more, by an array of the windows' hashes.

    Equal hashes meet when sorted with their places; the places of those that do, sorted again, are merged.
    """
    paired = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def merged(places: Column) -> Column:
        nothing = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            F.array_sort(places),
            nothing,
            lambda a, i: F.struct(
                (a.n + (i + width - F.greatest(a.end, i))).alias("n"), (i + width).cast("int").alias("end")
            ),
            lambda a: a.n,
        )

    def twice(pairs: Column) -> Column:
        def same(k: Column, by: int) -> Column:
            return F.coalesce(F.get(pairs, k + by).h == F.get(pairs, k).h, F.lit(False))

        places = F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), lambda k: same(k, -1) | same(k, 1))
        return F.transform(places, lambda k: F.get(pairs, k).i)

    # transform over a one-element array: the sorted pairs are computed once and named by the lambda.
    found = F.transform(F.array(paired), lambda p: merged(twice(p)))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.get(found, F.lit(0))).otherwise(
        F.lit(0).cast("bigint")
    )


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that rules may use, for every row of `docs`. A null text counts as an empty one."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    stop = [F.lit(w) for w in STOP_WORDS]
    first = docs.select(
        "doc_id",
        words_of(F.col("text")).alias("words"),
        lines.alias("lines"),
        F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("bigint").alias("n_symbols"),
    )
    second = first.select(
        "doc_id",
        "n_symbols",
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashed"),
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(stop))).cast("bigint").alias("n_stop_words"),
    )
    window = F.when(
        F.col("n_words") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), (F.col("n_words") - WINDOW).cast("int")),
            lambda i: F.xxhash64(*[F.get(F.col("hashed"), i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    # Words equal to the one before.
    echoed = F.filter("hashed", lambda h, i: (i > 0) & (F.get(F.col("hashed"), i - 1) == h))
    third = second.withColumn("n_echoed_words", F.size(echoed).cast("bigint")).withColumn("windows", window).drop("hashed")
    return third.withColumn("n_repeat_words", _repeated_words(F.col("windows"))).drop("windows")


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of `docs`: doc_id, the counts, base_failed, failed (names of rules that failed), kept.

    Null and empty texts have no words, fail the base and are not kept. Rows that repeat are judged one by one.
    Other columns are ignored, whatever their names. An empty table gives an empty result. Windows are compared
    by 64-bit hashes of 64-bit word hashes, within one text only.
    """
    failed = F.array_compact(F.array(*[F.when(r.fails(), F.lit(r.name)) for r in rules]))
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEATED_PERCENT)
    judged = measure(docs).withColumns({"base_failed": base, "failed": failed})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
