"""Word and rolling hashes in numpy (unsigned 64-bit, wrapping).

``rolling`` is fast, and only fit for filters: sequences with equal hashes can be made. ``doubled`` decides: its
multipliers come from ``content_seed``, a digest of all rows, so that no input can be made to fit them.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that a worker remembers: about 40 MB.
WORD_CACHE = 250_000
_U = np.uint64
#: Odd, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Words(dict):
    """Word to hash, remembered up to a bound."""

    def __init__(self, seed: int) -> None:
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return h


@lru_cache(maxsize=4)
def words_table(seed: int) -> Words:
    return Words(seed)


def words_of(text: str | None) -> list[bytes]:
    """Words between runs of ASCII white space, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    return np.fromiter(map(words_table(seed).__getitem__, words), np.uint64, len(words))


@lru_cache(maxsize=8)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, BASE, np.uint64), np.full(n, INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def rolling(h: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` units: a polynomial by prefix sums, then mixed."""
    n = len(h)
    if n < length:
        return np.empty(0, np.uint64)
    up, down = _powers(1 << max(10, n.bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h) * up[:n], dtype=np.uint64)])
    return mix((sums[length:] - sums[:-length]) * down[: n - length + 1] + _U(length))


def content_seed(rows: DataFrame, *columns: str) -> int:
    """64 bits that depend on all rows, in any order."""
    h = F.xxhash64(*columns)
    found = rows.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(F.xxhash64(h, F.lit(7)))).first()
    return int.from_bytes(hashlib.sha256(repr(tuple(map(str, found))).encode()).digest()[:8], "little")


@lru_cache(maxsize=512)
def _multipliers(seed: int, level: int) -> tuple[np.uint64, np.uint64]:
    d = hashlib.sha256(f"{seed}:{level}".encode()).digest()
    return tuple(_U(int.from_bytes(d[k : k + 8], "little") | 1) for k in (0, 8))


def _joined(x: np.ndarray, y: np.ndarray, seed: int, level: int) -> np.ndarray:
    a, b = _multipliers(seed, level)
    z = x * a + (y ^ (y >> _U(32))) * b
    return z ^ (z >> _U(29))


def doubled(units: np.ndarray, length: int, seed: int, width: int = 1) -> np.ndarray:
    """Names of every run of ``length``: two names of half a run, one behind the other, make one, from ``units`` that stand for ``width`` places."""
    n, k, names, level = len(units) + width - length, width, units, 0
    if n <= 0:
        return np.empty(0, np.uint64)
    while 2 * k <= length:
        names, k, level = _joined(names[:-k], names[k:], seed, level), 2 * k, level + 1
    return _joined(names[:n], names[length - k : length - k + n], seed, level) if k < length else names


def byte_names(raw: bytes, length: int, seed: int) -> np.ndarray:
    """``doubled`` names of every string of ``length`` (eight or more) bytes: eight bytes are their own name."""
    if len(raw) < length:
        return np.empty(0, np.uint64)
    eight = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,)).astype(np.uint64)
    return doubled(eight, length, seed, 8)


def among_pairs(pairs: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which rows of ``pairs`` (two columns) are rows of ``wanted``."""
    out = np.zeros(len(pairs), bool)
    if not len(wanted) or not len(pairs):
        return out
    wanted = wanted[np.argsort(wanted[:, 0], kind="stable")]
    at = np.searchsorted(wanted[:, 0], pairs[:, 0])
    while True:  # once, but for rows of ``wanted`` that share a first name
        here = at < len(wanted)
        here[here] = wanted[at[here], 0] == pairs[here, 0]
        if not here.any():
            return out
        out[here] |= wanted[at[here], 1] == pairs[here, 1]
        at[here] += 1


def lists_of(column) -> list[np.ndarray]:
    """The rows of an Arrow list column of longs as numpy views (no Python numbers)."""
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
