"""Hashes of word shingles, over whole batches of texts at once.

Words are runs of other bytes than ASCII white space, with A-Z lower-cased. A
word's hash is a polynomial over its bytes taken from prefix sums; a shingle's is a
mixed linear form of its words' hashes, 64 bits each. Distinct shingles are taken
to have distinct hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tessera.shared import process_cache

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_FACTOR = _RNG.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least n of each."""
    powers = process_cache("shingles").setdefault("powers", [])
    if not powers or len(powers[0]) < n:
        size = max(n, 1 << 16)
        both = []
        for base in (_BASE, _INVERSE):
            out, have = np.ones(size, np.uint64), 1
            while have < size:
                take = min(have, size - have)
                out[have : have + take] = out[:take] * np.uint64(pow(base, have, 1 << 64))
                have += take
            both.append(out)
        powers[:] = both
    return powers[0], powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashed(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[: len(data)], out=sums[1:])
    edge = np.diff(np.concatenate(([1], _SPACE[data].astype(np.int8))))
    starts, stops = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    word = mix((sums[stops] - sums[starts]) * inverse[starts] + (stops - starts).astype(np.uint64))
    n = max(0, len(word) - width + 1)
    full = np.zeros(n, np.uint64)
    for j in range(width):
        full += word[j : j + n] * _FACTOR[j]
    full = mix(full)
    at = np.searchsorted(starts, ends)
    low = 0
    for high in at.tolist():
        if high - low >= width:
            yield np.unique(full[low : high - width + 1])
        elif high > low:
            with np.errstate(over="ignore"):
                yield mix(np.array([(word[low:high] * _FACTOR[: high - low]).sum(dtype=np.uint64) + np.uint64(high - low)]))
        else:
            yield full[:0]
        low = high


def shingle_sets(texts: list[str | None], width: int = 5, most: int = 1 << 18) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of width words; with
    fewer words that of the whole sequence; none without words."""
    held, size = [], 0
    for text in texts:
        raw = (text or "").encode("utf-8", "surrogatepass")
        if held and size + len(raw) > most:
            yield from _hashed(held, width)
            held, size = [], 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield from _hashed(held, width)
