"""What has no SQL, against its definition: inverse permutations, all paths of a lattice, all labellings of a chain."""

import hashlib
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.llm import crf, pseudonyms, toxicity


def pad(round_, half, tweak, key):
    return hashlib.sha256(":".join([key, tweak, str(round_), ",".join(map(str, half))]).encode()).hexdigest()


def shifted(half, digest, radix, sign):
    return [(s + sign * int(digest[i % 16 * 4 : i % 16 * 4 + 4], 16)) % radix for i, s in enumerate(half)]


def undone(symbols, tweak, key, radix, other):
    """The rounds of the network backwards."""
    middle = len(symbols) // 2
    a, b = list(symbols[:middle]), list(symbols[middle:])
    for k in reversed(range(pseudonyms.ROUNDS)):
        if k % 2 == 0:
            a = shifted(a, pad(k, b, tweak, key), radix, -1)
        else:
            b = shifted(b, pad(k, a, tweak, key), other, -1)
    return a + b


@pytest.mark.parametrize(("radix", "other"), [(10, None), (26, None), (256, None), (189, 773)])
def test_the_inverse_network_gives_every_value_back(spark, radix, other):
    rng = np.random.default_rng(radix)
    sizes = [2] if other else [1, 2, 3, 9, 16, 40]
    values = [[int(x) for x in rng.integers(0, radix, n)] for n in sizes for _ in range(30)]
    df = spark.createDataFrame([(v,) for v in values], "v array<int>")
    made = df.select("v", pseudonyms.feistel(F.col("v"), "t", "secret", radix, other).alias("p")).collect()
    assert all(undone(r["p"], "t", "secret", radix, other or radix) == r["v"] for r in made)
    assert sum(r["p"] != r["v"] for r in made) > len(made) * 0.8
    assert all(0 <= s < radix for r in made for s in r["p"][: len(r["p"]) // 2])


def test_dates_come_back_by_the_inverse(spark):
    days = spark.range(0, 146_097, 997).select(F.date_add(F.lit("1800-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    texts = days.select(F.monotonically_increasing_id().alias("doc_id"), F.date_format("d", "yyyy-MM-dd").alias("text"))
    made = {r["doc_id"]: r["text"] for r in pseudonyms.pseudonymise(texts, "secret").collect()}
    epoch = np.datetime64("1800-01-01")
    for r in texts.collect():
        n = int((np.datetime64(made[r["doc_id"]]) - epoch).astype(int))
        big, small = undone([n // 773, n % 773], "date", "secret", 189, 773)
        assert str(epoch + np.timedelta64(big * 773 + small, "D")) == r["text"]


MODEL = np.log(np.random.default_rng(5).dirichlet(np.ones(toxicity.LETTERS) * 0.3, (toxicity.LETTERS, toxicity.LETTERS)) + 1e-9)


def cost_of(letters, extra, model):
    """Cost of one path: of the channel, and of the word in the character model."""
    x = y = 0
    for c in letters:
        z = ord(c) - 96 if "a" <= c <= "z" else 27
        extra -= model[x, y, z]
        x, y = y, z
    return extra - model[x, y, 0]


@given(st.text("ab1!3$00..é-8aa", min_size=1, max_size=7))
@settings(max_examples=300, deadline=None)
def test_the_best_path_of_all(token):
    paths = list(product(*toxicity.lattice(token)))
    costs = {}
    for path in paths:
        word = "".join(letters for letters, _ in path)
        cost = cost_of(word, sum(extra for _, extra in path), MODEL)
        costs[word] = min(cost, costs.get(word, np.inf))
    assert costs[toxicity.decode(token, MODEL)] == pytest.approx(min(costs.values()), abs=1e-9)


@given(st.integers(1, 7), st.integers(0, 10**6))
@settings(max_examples=100, deadline=None)
def test_marginals_equal_sums_over_all_labellings(n, seed):
    rng = np.random.default_rng(seed)
    emit, change = rng.normal(0, 3, (2, n)), rng.normal(0, 2, (2, 2))
    odds, pairs, total = crf.marginals(emit, change)
    for d in range(2):
        mass, good, both = 0.0, np.zeros(n), np.zeros((max(n - 1, 0), 2, 2))
        for states in product((0, 1), repeat=n):
            score = sum(emit[d, t] for t in range(n) if states[t])
            score += sum(change[states[t], states[t + 1]] for t in range(n - 1))
            weight = np.exp(score)
            mass += weight
            good += weight * np.array(states)
            for t in range(n - 1):
                both[t, states[t], states[t + 1]] += weight
        assert total[d] == pytest.approx(np.log(mass))
        assert np.allclose(1 / (1 + np.exp(-odds[d])), good / mass)
        assert np.allclose(np.exp(pairs[d]), both / mass)
