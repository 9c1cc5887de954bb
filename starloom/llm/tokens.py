"""Words of many texts at once, as arrays: used where texts are compared by runs of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes that one pass of array code takes. A longer text is taken alone and whole.
PASS = 1 << 19

_SPACES = [32, *range(9, 14)]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[_SPACES] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Odd 64-bit constants; a word's hash is a polynomial of its bytes at BASE, mixed.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """Powers of the base modulo 2^64. Not kept: what this module holds is sent along with each function to the tasks."""
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]))


def passes(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about PASS bytes together; a text is never cut."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        n = 4 * len(text or "") + 1
        if size and size + n > 2 * PASS:
            yield first, i
            first, size = i, 0
        size += n
    if size:
        yield first, len(texts)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, A-Z lower-cased, in order, and the place of each text's first word (one more at
    the end). Null texts have no words."""
    raws = [(t or "").encode("utf-8", "surrogatepass").translate(_LOWER) for t in texts]
    lengths = np.array([len(r) + 1 for r in raws], np.int64)
    raw = np.frombuffer(b" ".join(raws) + b" ", np.uint8)
    inside = ~_IS_SPACE[raw]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(BASE, len(raw)), _powers(INVERSE, len(raw))
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)])])
        hashes = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    limits = np.concatenate([[0], np.cumsum(lengths)])
    return hashes, np.searchsorted(starts, limits)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of `width` words; of the whole run if there are fewer; none without words."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    width = min(width, n)
    with np.errstate(over="ignore"):
        out = np.full(n - width + 1, width, np.uint64)
        for k in range(width):
            out = out * MIX_A + words[k : n - width + 1 + k]
            out ^= out >> np.uint64(29)
        return mixed(out)


def shingle_sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text, hashed for all texts of a pass at once."""
    for first, last in passes(texts):
        words, limits = word_hashes(texts[first:last])
        runs = shingle_hashes(words, width) if len(words) >= width else np.zeros(0, np.uint64)
        for a, b in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True):
            if b - a >= width:
                found = np.sort(runs[a : b - width + 1])
                yield found[np.concatenate([[True], found[1:] != found[:-1]])]
            else:
                yield shingle_hashes(words[a:b], width)
