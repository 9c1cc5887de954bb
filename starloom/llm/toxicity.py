"""Toxicity by a noisy channel: disguised words are decoded before they are scored.

Leetspeak, spaced-out letters and stretched letters span a lattice of the characters that may be meant. Viterbi
decoding under a character trigram model of the whole corpus restores the likeliest reading, and the restored
words are scored by word parts learned from labelled documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import (
    bounded,
    from_tasks,
    give_back,
    held_out,
    in_tasks,
    modest_batches,
    portions,
    settle,
    words_of,
)

FOLDS, FOLD = 4, 2
THRESHOLD = 0.3
#: Labelled documents that word parts are learned from at most, those with the smallest hashes of their ids.
TRAIN_ROWS = 20_000
#: Distinct tokens that a task remembers at once.
KNOWN = 1 << 18
#: Toxic documents of a half of the sample that a part must occur in, whatever the size of the sample.
MIN_DOCS = 4
#: Log-odds that the other half must give it.
MIN_WEIGHT = 1.5
#: Hash functions under which copies are sought in the sample.
SKETCHES = 4
#: Of the labelled documents that a part occurs in, the share that must be toxic.
PRECISION = 0.9
#: Words of toxic documents that a part must explain more for every clean document that it occurs in.
CLEAN_COST = 5
PART_SIZES = (4, 5, 6)

# Characters of the model: 0 stands for a word's edge, 1 to 26 for a to z, 27 for any other letter.
LETTERS = 28
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
FILLERS = ".-_~^'"
DOUBLED = re.compile(r"(.)\1+", re.DOTALL)
EDGES = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + "«»„“”‘’…¿¡"
# Costs in nats of the channel: a letter as itself, a look-alike, a filler skipped, a starred letter, a longer run
# shortened to one or two letters, and a pair to one.
SAME, ALIKE, SKIPPED, STARRED, SHORTENED, UNDOUBLED = 0.0, 1.0, 0.5, 1.5, 0.7, 3.0


def _codes() -> np.ndarray:
    """Code of every Latin-1 byte, which other characters are first replaced by `?` for."""
    codes = np.zeros(256, np.int64)
    codes[ord("a") : ord("z") + 1] = np.arange(1, 27)
    codes[0xC0:0x100] = 27
    codes[[0xD7, 0xF7]] = 0
    codes[ord("?")] = 27
    return codes


def _count_trigrams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    codes, total = _codes(), np.zeros(LETTERS**3, np.int64)
    for batch in portions(batches):
        for text in batch["text"]:
            c = codes[np.frombuffer((" " + text.lower().replace("?", " ") + " ").encode("latin-1", "replace"), np.uint8)]
            c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]
            if len(c) > 2:
                total += np.bincount((c[:-2] * LETTERS + c[1:-1]) * LETTERS + c[2:], minlength=LETTERS**3)
    seen = np.flatnonzero(total)
    yield pd.DataFrame({"gram": seen, "n": total[seen]})


def language_model(docs: DataFrame) -> np.ndarray:
    """Log-probabilities of a character after two others, over all texts; 28 x 28 x 28, whatever the corpus."""
    modest_batches(docs.sparkSession)
    counts = docs.where("text is not null").select("text").mapInPandas(_count_trigrams, "gram bigint, n bigint")
    counts = counts.groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(LETTERS**3)
    n[counts["gram"].to_numpy(np.int64)] = counts["n"].to_numpy()
    n = n.reshape(LETTERS, LETTERS, LETTERS)
    letters = n.sum(axis=(0, 1)) + 1
    pairs = n.sum(axis=0) + 5 * letters / letters.sum()
    pairs /= pairs.sum(axis=1, keepdims=True)
    triples = n + 5 * pairs[None]
    return np.log(triples / triples.sum(axis=2, keepdims=True))


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For every run of a character, what it may stand for with what it costs: letters, or nothing."""
    steps = []
    for run in re.finditer(r"(.)\1*", token, re.DOTALL):
        c, n = run[1], len(run[0])
        if c in FILLERS:
            steps.append([("", SKIPPED)])
        elif c == "*":
            steps.extend([[(chr(a), STARRED) for a in range(97, 123)] + [("", SKIPPED)]] * min(n, 3))
        elif c in LEET or c.isalpha():
            once = [(a, ALIKE) for a in LEET[c]] if c in LEET else [(c, SAME)]
            step = [(a, cost + (0 if n == 1 else UNDOUBLED if n == 2 else SHORTENED)) for a, cost in once]
            steps.append(step + [(a + a, cost + (0 if n == 2 else SHORTENED)) for a, cost in once if n > 1])
        else:
            steps.append([("", SKIPPED)])
    return steps


def decode(token: str, model: np.ndarray) -> str:
    """The likeliest word behind a token: Viterbi over the lattice, the last two characters being the state."""

    def code(c: str) -> int:
        return ord(c) - 96 if "a" <= c <= "z" else 27

    states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for step in lattice(token):
        reached: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, word) in states.items():
            for letters, extra in step:
                x, y, total = a, b, cost + extra
                for c in letters:
                    z = code(c)
                    total -= model[x, y, z]
                    x, y = y, z
                known = reached.get((x, y))
                if known is None or total < known[0]:
                    reached[x, y] = (total, word + letters)
        states = reached
    return min((cost - model[a, b, 0], word) for (a, b), (cost, word) in states.items())[1]


def disguised(word: str) -> bool:
    """Whether a stripped, lower-cased token may hide a word: it mixes letters with look-alikes, fillers or stars, or
    stretches a letter."""
    letters = sum(map(str.isalpha, word))
    alike = sum(c in LEET for c in word)
    if not letters and alike < 3 or letters + alike < 3:
        return False
    return letters < len(word) or stretched(word)


def stretched(word: str) -> bool:
    """Whether a letter is written three times in a row, or letters are doubled three times."""
    return re.search(r"(.)\1\1|(.)\2.*(.)\3.*(.)\4", word) is not None


def restored(token: str, model: np.ndarray) -> str:
    """The word behind a lower-cased token, without punctuation around it. One or two signs that look like letters are
    no punctuation right at the word, but at its end `!` is."""
    word = token.strip(EDGES)
    head, tail = token[: len(token) - len(token.lstrip("$@!|"))], token[len(token.rstrip("$@|")) :]
    if word and 0 < len(tail) < 3 and token.endswith(word + tail):
        word += tail
    if word and 0 < len(head) < 3 and token.startswith(head + word):
        word = head + word
    if word.isalpha() and not stretched(word):
        return word
    return decode(word, model) if disguised(word) else word


def tokens_of(text: str) -> set[str]:
    """Lower-cased tokens of a text, and what three or more single characters in a row spell together."""
    tokens = text.lower().split()
    found = set(tokens)
    singles = [i for i, token in enumerate(tokens) if len(token) < 3 and (len(token) == 1 or token[1] in ".,;:!?")]
    if len(singles) > 2:
        run: list[int] = []
        for i in [*singles, -2]:
            if run and i != run[-1] + 1:
                letters = "".join(tokens[k][0] for k in run)
                if len(run) > 2 and len(set(letters)) > 1:
                    # A word of one letter may stand before or after.
                    found.update((letters, letters[1:], letters[:-1]))
                run = []
            run.append(i)
    return found


def parts_of(word: str) -> set[str]:
    """Parts of a word between ^ and $: runs of some characters, and the whole. Doubled letters count as one, as decoding
    cannot always tell them from stretched ones."""
    marked = f"^{DOUBLED.sub(r'\1', word)}$"
    parts = {marked[i : i + n] for n in PART_SIZES for i in range(len(marked) - n + 1)}
    parts.add(marked)
    return parts


def _telling(make: Callable[[str], frozenset[str]]) -> Callable[[set[str]], Iterator[frozenset[str]]]:
    """A function that yields what `make` gives for each of some tokens, unless that is empty. Tokens known to give
    nothing, most of all, are dropped at once; what is known is bounded in number."""
    nothing: set[str] = set()
    known: dict[str, frozenset[str]] = {}

    def get(tokens: set[str]) -> Iterator[frozenset[str]]:
        if len(nothing) > KNOWN:
            nothing.clear()
        if len(known) > KNOWN:
            known.clear()
        for token in tokens - nothing:
            value = known.get(token)
            if value is None:
                value = make(token)
                if not value:
                    nothing.add(token)
                    continue
                known[token] = value
            yield value

    return get


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, rows: int) -> DataFrame:
    """One text each, with a label, of at most `rows` documents that are not held out. Of labels that disagree the highest
    counts, and of several texts of an id the one with the least hash; ids, texts and labels that are null are left
    out. The bound holds for rows, however often an id repeats: its texts collapse before they are exchanged."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known.where(~held_out(F.col("doc_id"), folds, fold)).groupBy("doc_id").agg(F.max(label).alias("_label"))
    chosen = settle(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    texts = docs.where("text is not null").select("doc_id", "text").join(bounded(chosen, rows), "doc_id")
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    return texts.groupBy("doc_id", "_label").agg(least).select("doc_id", F.col("least.text").alias("text"), "_label")


def _hash_function(k: int) -> Callable[[Column], Column]:
    return lambda run: F.xxhash64(run, F.lit(k))


def families(texts: DataFrame) -> DataFrame:
    """One text of each family of copies: those that share the least hash of their runs of five words under one of
    some hash functions, as copies do, and near copies almost surely. Toxic and clean ones are families apart."""
    hashed = texts.withColumn("words", F.transform(words_of(F.lower("text")), lambda w: F.xxhash64(w)))
    last = F.greatest(F.size("words") - 5, F.lit(0))
    runs = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(F.col("words"), i + k) for k in range(5)])
    )
    keyed = hashed.select("doc_id", "_label", runs.alias("runs"))
    keys = [f"key{k}" for k in range(SKETCHES)]
    least = [F.array_min(F.transform("runs", _hash_function(k))) for k in range(SKETCHES)]
    kept = settle(keyed.select("doc_id", "_label", *[m.alias(key) for m, key in zip(least, keys, strict=True)]))
    for key in keys:
        row = F.struct(F.xxhash64("doc_id"), "doc_id", "_label", *keys)
        kept = kept.groupBy(key, "_label").agg(F.min(row).alias("r")).select("r.doc_id", "r._label", *[f"r.{k}" for k in keys])
    ids = settle(kept.select("doc_id").distinct())
    rows = texts.join(bounded(ids, TRAIN_ROWS), "doc_id")
    return rows.select("text", F.col("_label").alias("toxic"))


def _cover(listed: list[list[str]], cost: Mapping[str, float], least: int) -> set[str]:
    """Parts chosen greedily: each time the one that most words hold which hold no chosen part yet, less its cost.
    Among equals the longer part, then the first by name."""
    chosen = set()
    while listed:
        gain = Counter(p for parts in listed for p in parts)
        for part in gain:
            gain[part] -= cost[part]
        part = min(gain, key=lambda p: (-gain[p], -len(p), p))
        if gain[part] < least:
            break
        chosen.add(part)
        listed = [parts for parts in listed if part not in parts]
    return chosen


def learn(docs: DataFrame, labels: DataFrame, model: np.ndarray) -> tuple[float, float, dict[str, float]]:
    """Log-odds of toxicity before a text is seen, those of texts without a telling part, and those that the word parts
    give that tell it.

    Parts are counted once a document, and a family of copies as one document. The sample is halved by the hash of
    its texts. In each half the parts that are precise enough and explain most words of toxic documents are chosen,
    and the other half weighs them, so that what only seemed to tell there weighs nothing.
    """
    spark = docs.sparkSession
    texts = families(sample(docs, labels, "toxic", FOLDS, FOLD, TRAIN_ROWS))
    texts = settle(texts.withColumn("half", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int")))
    totals = Counter({(r["half"], r["toxic"]): r["n"] for r in texts.groupBy("half", "toxic").agg(F.count("*").alias("n")).collect()})
    n_toxic, n_clean = totals[0, 1] + totals[1, 1], totals[0, 0] + totals[1, 0]
    prior = math.log((n_toxic + 0.5) / (n_clean + 0.5))
    if n_toxic < MIN_DOCS:
        return prior, prior, {}
    shared = spark.sparkContext.broadcast(model)

    def parts_among(wanted: frozenset[str] | None) -> Callable[[set[str]], Iterator[frozenset[str]]]:
        def parts(token: str) -> frozenset[str]:
            word = restored(token, shared.value)
            found = parts_of(word) if word else set()
            return frozenset(found if wanted is None else found & wanted)

        return _telling(parts)

    def counter(wanted) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        def rows(counts: Counter) -> pd.DataFrame:
            listed = [(half, part, n) for (half, part), n in counts.items()]
            return pd.DataFrame(listed, columns=["half", "part", "n"])

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            telling, counts = parts_among(wanted.value if wanted else None), Counter()
            for batch in portions(batches):
                for half, text in zip(batch["half"].tolist(), batch["text"], strict=True):
                    counts.update((half, p) for p in set().union(*telling(tokens_of(text))))
                if len(counts) > 1 << 20:
                    yield rows(counts)
                    counts.clear()
            yield rows(counts)

        return count

    def counts_of(label: int, wanted=None, tenth: bool = False) -> DataFrame:
        rows = texts.where(F.col("toxic") == label).select("half", "text")
        rows = rows.where(F.pmod(F.xxhash64("text", F.lit(1)), F.lit(10)) == 0) if tenth else rows
        counted = rows.mapInPandas(counter(wanted), "half int, part string, n bigint")
        return counted.groupBy("half", "part").agg(F.sum("n").alias("n"))

    frequent = settle(counts_of(1))
    often = frequent.where(F.col("n") >= MIN_DOCS)
    wanted = spark.sparkContext.broadcast(frozenset(often.select("part").distinct().toPandas()["part"]))
    # Parts that a tenth of the clean documents shows not to be precise need not be counted in the rest.
    some = counts_of(0, wanted, tenth=True).withColumnRenamed("n", "some")
    precise = F.col("n") >= PRECISION * (F.col("n") + F.coalesce("some", F.lit(0)))
    kept = settle(often.join(some, ["half", "part"], "left").where(precise).select("part").distinct())
    in_toxic = Counter({(r["half"], r["part"]): r["n"] for r in frequent.join(kept, "part").collect()})
    open_ = {part for _, part in in_toxic}
    wanted = spark.sparkContext.broadcast(frozenset(open_))
    in_clean = Counter({(r["half"], r["part"]): r["n"] for r in counts_of(0, wanted).collect()})
    sharp = spark.sparkContext.broadcast(
        [
            frozenset(
                p
                for (h, p), n in in_toxic.items()
                if h == half and p in open_ and n >= max(MIN_DOCS, PRECISION * (n + in_clean[h, p]))
            )
            for half in (0, 1)
        ]
    )

    def list_precise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        telling = [parts_among(sharp.value[half]) for half in (0, 1)]
        for batch in batches:
            rows = []
            for half, text in zip(batch["half"].tolist(), batch["text"], strict=True):
                rows += [(half, sorted(parts)) for parts in telling[half](tokens_of(text))]
            if rows:
                yield pd.DataFrame(rows, columns=["half", "parts"])

    toxic = texts.where("toxic = 1").select("half", "text")
    listed = toxic.mapInPandas(list_precise, "half int, parts array<string>").collect()
    weights: dict[str, list[float]] = {}
    for half in (0, 1):
        cost = {part: CLEAN_COST * in_clean[half, part] for part in sharp.value[half]}
        for part in _cover([r["parts"] for r in listed if r["half"] == half], cost, MIN_DOCS):
            other = 1 - half
            if in_toxic[other, part] == 0:
                continue
            ratio = (in_toxic[other, part] + 0.5) / (totals[other, 1] + 1)
            ratio /= (in_clean[other, part] + 0.5) / (totals[other, 0] + 1)
            if math.log(ratio) >= MIN_WEIGHT:
                weights.setdefault(part, []).append(math.log(ratio))
    held = spark.sparkContext.broadcast(frozenset(weights))

    def count_bare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        telling, counts = parts_among(held.value), Counter()
        for batch in portions(batches):
            for toxic, text in zip(batch["toxic"].tolist(), batch["text"], strict=True):
                counts[toxic] += next(telling(tokens_of(text)), None) is None
        yield pd.DataFrame(list(counts.items()), columns=["toxic", "n"])

    bare = texts.select(F.col("toxic").cast("int"), "text").mapInPandas(count_bare, "toxic int, n bigint")
    n_bare = Counter({r["toxic"]: r["n"] for r in bare.groupBy("toxic").agg(F.sum("n").alias("n")).collect()})
    without = math.log((n_bare[1] + 0.5) / (n_bare[0] + 0.5))
    return prior, without, {part: sum(w) / len(w) for part, w in sorted(weights.items())}


def _judge(
    model: np.ndarray, prior: float, without: float, weights: dict[str, float]
) -> Callable[[str | None], tuple[float, list[str]]]:
    """A function that scores a text: the score, and the restored words that told."""

    def told(token: str) -> frozenset[tuple[str, str]]:
        word = restored(token, model)
        return frozenset((p, word) for p in parts_of(word) if p in weights) if word else frozenset()

    telling = _telling(told)

    def judge(text: str | None) -> tuple[float, list[str]]:
        found = set().union(*telling(tokens_of(text or "")))
        odds = prior + sum(weights[p] for p in sorted({part for part, _ in found})) if found else without
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds)))), sorted({word for _, word in found})

    return judge


def score(docs: DataFrame, model: np.ndarray, prior: float, without: float, weights: dict[str, float]) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted, evidence (restored words that told).

    Texts without a telling part, such as null and empty ones, have the score of the sampled texts without one. Rows that repeat are scored one by one. Other columns are ignored,
    whatever their names. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model, prior, without, weights))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = _judge(*shared.value)
        for batch in portions(batches):
            judged = [judge(text) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "held_out": batch["held_out"],
                    "score": [s for s, _ in judged],
                    "predicted": [int(s >= THRESHOLD) for s, _ in judged],
                    "evidence": [words for _, words in judged],
                }
            )

    scored = in_tasks(docs, "text", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"))
    schema = "doc_id string, held_out boolean, score double, predicted int, evidence array<string>"
    return from_tasks(scored.mapInPandas(rows, schema), docs)


def without_toxic(
    docs: DataFrame, model: np.ndarray, prior: float, without: float, weights: dict[str, float]
) -> DataFrame:
    """The rows of `docs` that are not predicted toxic, with all their columns as they are, whatever their names.

    Every row is judged by its own whole text, so rows that repeat go or stay together; null and empty texts are judged as
    texts without a telling part, and a null id does not matter. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model, prior, without, weights))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _judge(*shared.value)
        for batch in batches:
            texts = batch.column("text")
            yield batch.filter(pa.array([judge(text.as_py())[0] < THRESHOLD for text in texts], pa.bool_()))
            del batch, texts
            give_back()

    return docs.mapInArrow(kept, docs.schema)


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float, float, dict[str, float]]:
    """The character model of all of `docs`, and what the labels that are not held out tell."""
    model = language_model(docs)
    return model, *learn(docs, labels, model)


def detect(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on `docs` and the labels that are not held out, and score all of `docs`."""
    return score(docs, *train(docs, labels))
