"""Quality of documents by a linear-chain conditional random field over their lines.

Each line is good or bad. It is described by what it and its neighbours look like, and the chain couples it with
the lines before and after. Forward and backward sums give each line's probability, and their mean weighted by
the lines' lengths is the document's quality.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import from_tasks, held_out, in_tasks, portions
from starloom.llm.toxicity import sample

FOLDS, FOLD = 5, 0
THRESHOLD = 0.3
#: Labelled documents that the field is fitted on at most, those with the smallest hashes of their ids.
TRAIN_ROWS = 8_000
STEPS, RATE, PENALTY = 150, 0.1, 1e-3

MARKS = "#$%&*|<>!?"
#: Upper edges of the classes that each measure of a line falls into. Words, characters per word, marks per word,
#: share of upper case among letters, share of distinct words, share of words equal to the one before, share of digits.
EDGES = (
    (2, 5, 10, 30, 100),
    (2, 3.5, 5, 7, 10),
    (0, 0.05, 0.3, 0.8),
    (0.02, 0.1, 0.5),
    (0.3, 0.6, 0.8, 0.95),
    (0, 0.05, 0.3),
    (0, 0.02, 0.1),
)
CLASSES = [len(edges) + 1 for edges in EDGES]
#: A line's own features: a class of each measure, whether the line was there before, and a constant.
OWN = sum(CLASSES) + 2
#: With those of the line before and the line after.
FEATURES = 3 * OWN

_OFFSETS = np.cumsum([0, *CLASSES[:-1]])
_FLAGS = {ord(c): None for c in MARKS}


def lines_of(text: str) -> list[str]:
    return [line for line in text.split("\n") if line and not line.isspace()]


def measures(line: str) -> tuple[float, ...]:
    words = line.split()
    n, size = len(words), len(line)
    letters = line.translate(_FLAGS)
    lower = letters.lower()
    upper = sum(1 for a, b in zip(letters, lower, strict=False) if a != b) if letters != lower else 0
    digits = sum(map(line.count, "0123456789"))
    return (
        n,
        (size - n + 1) / n,
        (size - len(letters)) / n,
        upper / size,
        len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        digits / size,
    )


def describe(lines: list[str]) -> np.ndarray:
    """Features of a document's lines, one row of zeros and ones each."""
    own = np.zeros((len(lines), OWN), np.uint8)
    values = np.array([measures(line) for line in lines])
    rows = np.arange(len(lines))
    for k, edges in enumerate(EDGES):
        own[rows, _OFFSETS[k] + np.searchsorted(edges, values[:, k])] = 1
    seen: set[str] = set()
    for i, line in enumerate(lines):
        own[i, -2] = line in seen
        seen.add(line)
    own[:, -1] = 1
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    return np.hstack([own, before, after])


def _log_add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    high = np.maximum(a, b)
    return high + np.log1p(np.exp(np.minimum(a, b) - high))


def marginals(emit: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For chains of equal length, emissions being documents x lines: log-odds that a line is good, log-probabilities of
    neighbouring states (documents x lines - 1 x 2 x 2), and the logarithm of each chain's sum."""
    docs, n = emit.shape
    score = np.stack([np.zeros_like(emit), emit], axis=2)
    forward, backward = np.zeros((docs, n, 2)), np.zeros((docs, n, 2))
    forward[:, 0] = score[:, 0]
    for t in range(1, n):
        for s in (0, 1):
            into = _log_add(forward[:, t - 1, 0] + change[0, s], forward[:, t - 1, 1] + change[1, s])
            forward[:, t, s] = into + score[:, t, s]
    for t in range(n - 2, -1, -1):
        ahead = backward[:, t + 1] + score[:, t + 1]
        for s in (0, 1):
            backward[:, t, s] = _log_add(change[s, 0] + ahead[:, 0], change[s, 1] + ahead[:, 1])
    total = _log_add(forward[:, -1, 0], forward[:, -1, 1])
    both = forward + backward
    pairs = forward[:, :-1, :, None] + change + (score + backward)[:, 1:, None, :] - total[:, None, None, None]
    return both[:, :, 1] - both[:, :, 0], pairs, total


def fit(documents: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the features for the state `good`, and of the changes between states. The lines of a document all
    bear its label; chains of equal length are fitted together, by gradient steps with moments (Adam)."""
    groups: dict[int, list[tuple[np.ndarray, int]]] = {}
    for features, label in documents:
        groups.setdefault(len(features), []).append((features, label))
    packed = [
        (np.stack([f for f, _ in g]).astype(np.float32), np.array([y for _, y in g], float)) for g in groups.values()
    ]
    lines = sum(x.shape[0] * x.shape[1] for x, _ in packed)
    theta = np.zeros(FEATURES + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        gradient = np.zeros_like(theta)
        weights, change = theta[:FEATURES], theta[FEATURES:].reshape(2, 2)
        for x, y in packed:
            odds, pairs, _ = marginals(x @ weights, change)
            good = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
            gradient[:FEATURES] += np.einsum("dl,dlf->f", y[:, None] - good, x)
            n = x.shape[1] - 1
            seen = np.array([[n * (1 - y).sum(), 0.0], [0.0, n * y.sum()]])
            gradient[FEATURES:] += (seen - np.exp(pairs).sum(axis=(0, 1))).ravel()
        gradient = gradient / lines - PENALTY * theta
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta = theta + RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:FEATURES], theta[FEATURES:].reshape(2, 2)


def mean_log_odds(described: np.ndarray, sizes: np.ndarray, weights: np.ndarray, change: np.ndarray) -> float:
    """Log-odds of the mean probability of the lines to be good, weighted by their lengths."""
    odds, _, _ = marginals((described @ weights)[None], change)
    good = 1 / (1 + np.exp(-np.clip(odds[0], -50, 50)))
    mean = np.clip((good * sizes).sum() / sizes.sum(), 1e-6, 1 - 1e-6)
    return float(np.log(mean / (1 - mean)))


def calibrate(log_odds: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Offset and slope by which a document's log-odds become those of its label: logistic regression by Newton steps
    with a slight pull to 0 and 1."""
    x = np.stack([np.ones_like(log_odds), log_odds], axis=1)
    rest, pull = np.array([0.0, 1.0]), 0.1 * np.eye(2)
    beta = rest.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -50, 50)))
        gradient = x.T @ (labels - p) - pull @ (beta - rest)
        beta = beta + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull, gradient)
    return float(beta[0]), float(beta[1])


#: Weights of the features, of the changes, offset and slope of the calibration, and the share of good documents in the
#: sample, which texts without lines get.
Field = tuple[np.ndarray, np.ndarray, tuple[float, float], float]


def train(docs: DataFrame, labels: DataFrame) -> Field:
    """The field, fitted on the sample's lines and calibrated on its documents."""
    texts = sample(docs, labels, "quality", FOLDS, FOLD, TRAIN_ROWS).select("text", F.col("_label").alias("label"))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, label in zip(batch["text"], batch["label"].tolist(), strict=True):
                if lines := lines_of(text):
                    described = np.packbits(describe(lines), axis=1)
                    sizes = np.array([len(line) for line in lines], np.int32)
                    rows.append((label, len(lines), described.tobytes(), sizes.tobytes()))
            if rows:
                yield pd.DataFrame(rows, columns=["label", "n", "bits", "sizes"])

    sampled = texts.mapInPandas(features, "label int, n int, bits binary, sizes binary").collect()
    if len({r["label"] for r in sampled}) < 2:
        share = float(sampled[0]["label"]) if sampled else 0.5
        return np.zeros(FEATURES), np.zeros((2, 2)), (0.0 if not sampled else 4 * share - 2, 0.0), share
    documents = []
    for r in sampled:
        bits = np.frombuffer(r["bits"], np.uint8).reshape(r["n"], -1)
        documents.append((np.unpackbits(bits, axis=1)[:, :FEATURES], int(r["label"] > 0)))
    weights, change = fit(documents)
    sizes = [np.frombuffer(r["sizes"], np.int32) for r in sampled]
    odds = [mean_log_odds(x, size, weights, change) for (x, _), size in zip(documents, sizes, strict=True)]
    good = np.array([y for _, y in documents], float)
    return weights, change, calibrate(np.array(odds), good), float(good.mean())


def quality(text: str | None, field: Field) -> tuple[float, int]:
    """Calibrated probability that a text is good, and the number of its lines."""
    weights, change, (offset, slope), share = field
    lines = lines_of(text or "")
    if not lines:
        return share, 0
    odds = mean_log_odds(describe(lines), np.array([len(line) for line in lines], float), weights, change)
    return float(1 / (1 + np.exp(-np.clip(offset + slope * odds, -50, 50)))), len(lines)


def score(docs: DataFrame, field: Field) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted, n_lines.

    Null texts and texts without a line get the share of good documents in the sample. Rows that repeat are scored
    one by one. Other columns are ignored, whatever their names. An empty table gives an empty result.
    """

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in portions(batches):
            found = [quality(text, field) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "held_out": batch["held_out"],
                    "score": [s for s, _ in found],
                    "predicted": [int(s >= THRESHOLD) for s, _ in found],
                    "n_lines": [n for _, n in found],
                }
            )

    rows = in_tasks(docs, "text", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"))
    schema = "doc_id string, held_out boolean, score double, predicted int, n_lines int"
    return from_tasks(rows.mapInPandas(judge, schema), docs)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on `docs` and the labels that are not held out, and score all of `docs`."""
    return score(docs, train(docs, labels))
