"""Words of many texts as 64-bit hashes, by whole-array numpy steps and no per-word Python call."""

from __future__ import annotations

from functools import cache

import numpy as np

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_U = np.uint64


@cache
def _classes() -> np.ndarray:
    """By code point: 0 space or control, 1 letter or digit, 2 other."""
    out = np.empty(0x110000, np.uint8)
    for i in range(0x110000):
        c = chr(i)
        out[i] = 1 if c.isalnum() else 0 if c.isspace() or i < 32 else 2
    return out


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate([[_U(1)], np.full(n, _P, _U)]))
        down = np.cumprod(np.concatenate([[_U(1)], np.full(n, _P_INV, _U)]))
    return up, down


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@cache
def _char_hashes(digits_alike: bool) -> np.ndarray:
    cp = np.arange(0x110000, dtype=np.uint64)
    if digits_alike:
        cp[48:58] = 48
    with np.errstate(over="ignore"):
        return mix(cp + _U(0x51ED))


#: Characters handled at a time, so that the arrays stay in the processor's cache.
_CHUNK = 1 << 18


def distinct(x: np.ndarray) -> np.ndarray:
    """The different values in order, by sorting: several times faster here than a hash table."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def word_hashes(texts: list[str], symbols: bool = False, digits_alike: bool = False, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and the text each belongs to.

    Words are the maximal runs of letters or digits; with symbols, every other visible character is a word too.
    """
    hashes, owners, i = [], [], 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) < _CHUNK):
            size += len(texts[j]) + 1
            j += 1
        h, at = _hash_chunk(texts[i:j], symbols, digits_alike, lower)
        hashes.append(h)
        owners.append(at + i)
        i = j
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owners)


def _hash_chunk(texts: list[str], symbols: bool, digits_alike: bool, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    joined = "\0".join(t.replace("\0", " ") if "\0" in t else t for t in texts)
    if lower:
        joined = joined.lower()
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _classes()[cp]
    flags = np.zeros(len(cp) + 2, np.int8)
    flags[1:-1] = kind == 1
    edge = np.flatnonzero(np.diff(flags))
    starts, ends = edge[0::2], edge[1::2]
    if symbols:
        single = np.flatnonzero(kind == 2)
        starts = np.concatenate([starts, single])
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], np.concatenate([ends, single + 1])[order]
    up, down = _powers(1 << max(19, int(len(cp) + 1).bit_length()))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(cp) + 1, np.uint64)
        np.cumsum(_char_hashes(digits_alike)[cp] * up[: len(cp)], out=sums[1:])
        h = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    breaks = np.flatnonzero(cp == 0)
    return h, np.searchsorted(breaks, starts).astype(np.int64)


def grams(h: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words that stay in one text, and the text of each."""
    if len(h) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    m = len(h) - n + 1
    with np.errstate(over="ignore"):
        out = h[:m].copy()
        for k in range(1, n):
            out = mix(out * _U(0xC2B2AE3D27D4EB4F) + h[k : m + k])
    inside = text[:m] == text[n - 1 :]
    return out[inside], text[:m][inside]
