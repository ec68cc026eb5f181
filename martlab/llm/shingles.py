"""Hashes of words and of runs of five words, for whole Arrow columns at once.

A word is what stands between white space, in lower case. Hashes have 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORDS = 5
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
_rng = np.random.default_rng(20)
BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """BASE ** i and BASE ** -i modulo 2 ** 64 for i up to n; kept between calls while short."""
    if n < len(_powers[0]):
        return _powers
    out = []
    for base in (BASE, BASE_INVERSE):
        row = np.full(n + 1, base, np.uint64)
        row[0] = 1
        out.append(np.multiply.accumulate(row))
    if n <= 16 << 20:
        _powers[:] = out
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers over all of the word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums P with P[j] - P[i] == BASE ** i * hash(data[i:j])."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODE[data] * powers(len(data))[0][:len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of data[start:stop], the same wherever the same bytes stand."""
    inverse = powers(len(prefix))[1]
    return mix((prefix[stop] - prefix[start]) * inverse[start] + (stop - start).astype(np.uint64))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string array without nulls."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def split_words(texts: pa.Array) -> pa.ListArray:
    return pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts.cast(pa.string()), "")))


def flat_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and, for each text, where its words begin and end (length + 1 offsets)."""
    lists = split_words(texts)
    words = lists.flatten()
    bounds = lists.offsets.to_numpy().astype(np.int64)
    bounds = bounds - bounds[0]
    data, at = buffers(words)
    hashes = span_hash(prefix_hash(data), at[:-1], at[1:])
    # splitting leaves empty words at the ends of a text
    full = at[1:] > at[:-1]
    if not full.all():
        seen = np.concatenate([[0], np.cumsum(full)])
        hashes, bounds = hashes[full], seen[bounds]
    return hashes, bounds


def runs(hashes: np.ndarray, bounds: np.ndarray, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of five words and their bounds by text.

    With `short`, a text of one to four words has one run, all its words; otherwise it has none.
    """
    counts = np.diff(bounds)
    n = np.where(counts >= WORDS, counts - WORDS + 1, (counts > 0) & short).astype(np.int64)
    out_bounds = np.concatenate([[0], np.cumsum(n)])
    owner = np.repeat(np.arange(len(counts)), n)
    first = bounds[:-1][owner] + np.arange(out_bounds[-1]) - out_bounds[:-1][owner]
    last = bounds[1:][owner]
    total = np.zeros(out_bounds[-1], np.uint64)
    for i in range(WORDS):
        at = first + i
        inside = at < last
        if inside.all():
            total += hashes[at] * PLACE[i]
        else:
            total[inside] += hashes[at[inside]] * PLACE[i]
    return mix(total), out_bounds


def word_runs(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `n` < 5 words and the text of each; a text of n words has the same hash in `runs`."""
    first = np.arange(max(len(hashes) - n + 1, 0))
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    first = first[owner[first] == owner[first + n - 1]]
    total = np.zeros(len(first), np.uint64)
    for i in range(n):
        total += hashes[first + i] * PLACE[i]
    return mix(total), owner[first]


def weighted_sets(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, hash) pairs in order: owner, hash, count, and bounds by text."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(hashes)))
    owner = owner[at]
    return owner, hashes[at], counts, np.searchsorted(owner, np.arange(len(bounds)))
