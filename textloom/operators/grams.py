"""Windows of tokens as packed columns: what counts n-grams and their neighbours without a row for each of them.

A text is an array of codes: the number of a frequent token (from 1), a negative name of any other, 0 at the edges of runs. A window of m codes tells of the
n-grams of m - 1 tokens at its front and its back that it is one more neighbour of theirs, and of itself that it occurs. Equal windows are put together in each task, travel as
compressed columns to the task of their hash, and are counted there, so distinct ones are met once and their numbers add up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tokens that a task holds at once, windows that a group has about, and bits that a filter of frequent n-grams may have (2 to the power).
AT_ONCE, GROUP_WINDOWS, FILTER_BITS = 1 << 21, 1 << 22, 29
#: Bits of a filter that one task sets (2 to the power).
BLOCK_BITS = 20


def packed(values: np.ndarray) -> bytes:
    """Bytes by their place in the numbers, compressed."""
    raw = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, "zstd", asbytes=True) if raw else b"")


def unpacked(data: bytes, kind: type) -> np.ndarray:
    size, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    if not size:
        return np.empty(0, kind)
    raw = np.frombuffer(pa.decompress(data[8:], size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


def named(codes: list[np.ndarray]) -> np.ndarray:
    """Hashes of rows of codes. They only choose tasks and places in filters; codes decide what is equal."""
    h = np.zeros(len(codes[0]), np.uint64)
    for c in codes:
        h = (h ^ c.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def frequent(codes: list[np.ndarray], bits: np.ndarray | None) -> np.ndarray:
    """Whether rows of codes are n-grams that may be frequent: all that are, and few others."""
    ok = np.logical_and.reduce([c > 0 for c in codes])
    if bits is not None:
        at = named([c[ok] for c in codes]) >> np.uint64(64 - int(len(bits) * 8).bit_length() + 1)
        ok[ok] = (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return ok


def together(codes: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Equal rows of codes once, by hash, with their summed counts (or numbers) and hashes."""
    if not len(codes[0]):
        return codes, np.empty(0, np.int64), np.empty(0, np.uint64)
    h = named(codes)
    order = np.argsort(h)
    for again in (False, True):
        if again:  # different rows of one hash, which may lie between each other
            order = np.lexsort((*codes, h))
        same, cols = h[order], [c[order] for c in codes]
        other = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
        if not (other & (same[1:] == same[:-1])).any():
            break
    first = np.flatnonzero(np.append(True, other))
    n = np.diff(np.append(first, len(h))) if counts is None else np.add.reduceat(counts[order], first)
    return [c[first] for c in cols], n, same[first]


def coded(vocabulary: Broadcast):
    """Names of tokens, 0 before each run, as packed codes: ``ids`` (-1 for a rare token) and the ``rare`` names."""

    def flush(parts: list[np.ndarray]) -> pa.RecordBatch:
        known, numbers = vocabulary.value
        names = np.concatenate([*parts, np.zeros(1, np.int64)])
        at = np.minimum(np.searchsorted(known, names), len(known) - 1)
        ids = np.where(names == 0, 0, np.where(known[at] == names, numbers[at], -1)).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array([packed(ids)]), pa.array([packed(names[ids < 0])])], names=["ids", "rare"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            parts.append(batch.column(0).flatten().to_numpy())
            n += len(parts[-1])
            if n >= AT_ONCE:
                yield flush(parts)
                parts, n = [], 0
        if n:
            yield flush(parts)

    return run


def _rare(names: np.ndarray) -> np.ndarray:
    return names | np.int64(-(1 << 63))


def windows(m: int, bits: Broadcast | None, sides: bool, groups: int):
    """The different windows of ``m`` codes of each stretch, for the group of their hash. With ``sides``, one part of a window must be frequent, else both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids = unpacked(batch.column(0)[k].as_py(), np.int32)
                codes = ids.astype(np.int64)
                codes[ids < 0] = _rare(unpacked(batch.column(1)[k].as_py(), np.int64))
                n = len(codes) - m + 2
                if n < 2:
                    continue
                ok = frequent([codes[j : j + n] for j in range(m - 1)], bits and bits.value)
                at = np.flatnonzero(ok[:-1] | ok[1:] if sides else ok[:-1] & ok[1:])
                cols, counts, h = together([codes[at + j] for j in range(m)])
                part = ((h >> np.uint64(32)) * np.uint64(groups)) >> np.uint64(32)
                edges = np.searchsorted(part, np.arange(groups + 1, dtype=np.uint64))
                rows = []
                for p in np.flatnonzero(np.diff(edges)):
                    a, b = edges[p], edges[p + 1]
                    order = a + np.argsort(cols[0][a:b])
                    mine = np.concatenate([c[order] for c in cols])
                    rows.append((int(p), packed(np.where(mine < 0, -1, mine).astype(np.int32)), packed(mine[mine < 0]), packed(counts[order].astype(np.int32))))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 4, (pa.int32(), *[pa.binary()] * 3), strict=True)], names=["part", "ids", "rare", "counts"])

    return run


def keys_of(codes: list[np.ndarray], width: int) -> list[np.ndarray]:
    """Numbers two in a long, 0 where none is left."""
    some = [*codes, *[np.zeros(len(codes[0]), np.int64)] * (2 * width - len(codes))]
    return [(some[2 * k] << 32) | some[2 * k + 1] for k in range(width)]


def codes_of(keys: list[np.ndarray], n: int) -> list[np.ndarray]:
    return [(keys[k // 2] >> 32) if k % 2 == 0 else keys[k // 2] & 0xFFFFFFFF for k in range(n)]


def columns(width: int) -> list[str]:
    return [f"k{k}" for k in range(width)]


def tallied(m: int, bits: Broadcast | None, sides: bool, least: int, counted: bool, width: int):
    """What the windows of one group add: ``n``, keys of an n-gram, and its ``count``, ``n_left`` and ``n_right``."""
    kinds = [pa.int32(), *[pa.int64()] * (width + 3)]

    def run(table: pa.Table) -> pa.Table:
        read = [(unpacked(i, np.int32), unpacked(r, np.int64), unpacked(c, np.int32)) for i, r, c in zip(*(table[c].to_pylist() for c in ("ids", "rare", "counts")), strict=True)]
        cols: list[list[np.ndarray]] = [[] for _ in range(m)]
        for ids, rare, _ in read:
            codes = ids.astype(np.int64)
            codes[ids < 0] = rare
            for c, x in zip(cols, codes.reshape(m, -1), strict=True):
                c.append(x)
        codes, counts, _ = together([np.concatenate(c) for c in cols], np.concatenate([c for _, _, c in read]).astype(np.int64))
        out = []

        def add(n: int, grams: list[np.ndarray], values: np.ndarray, place: int) -> None:
            none = np.zeros(len(values), np.int64)
            out.append([np.full(len(values), n, np.int32), *keys_of(grams, width), *[values if k == place else none for k in range(3)]])

        if counted:
            often = np.logical_and.reduce([c > 0 for c in codes]) & (counts >= least)
            add(m, [c[often] for c in codes], counts[often], 0)
        if sides:
            for place, part in ((2, codes[:-1]), (1, codes[1:])):
                ok = frequent(part, bits and bits.value)
                grams, n, _ = together([c[ok] for c in part])
                add(m - 1, grams, n, place)
        return pa.table([pa.array(np.concatenate(c), t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["n", *columns(width), "count", "n_left", "n_right"])

    return run


def summed(rows: DataFrame, width: int) -> DataFrame:
    return rows.groupBy("n", *columns(width)).agg(*[F.sum(c).alias(c) for c in ("count", "n_left", "n_right")])


def filter_of(grams: DataFrame, n: int, rows: int) -> np.ndarray:
    """A filter of n-grams by their keys: bits at their hashes, some 16 for each up to 2 to the power ``FILTER_BITS``, which the driver and each task can hold."""
    power = min(FILTER_BITS, max(BLOCK_BITS, int(16 * rows).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = named(codes_of([c.to_numpy() for c in batch.columns], n)) >> np.uint64(64 - power)
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(BLOCK_BITS)).astype(np.int32)), pa.array((at & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int32))], names=["block", "bit"])

    def block(table: pa.Table) -> pa.Table:
        found = np.zeros(1 << BLOCK_BITS, bool)
        found[table["bit"].to_numpy()] = True
        return pa.table([table["block"].slice(0, 1), pa.array([np.packbits(found, bitorder="little").tobytes()])], names=["block", "bits"])

    blocks = grams.mapInArrow(places, "block int, bit int").groupBy("block").applyInArrow(block, "block int, bits binary").toArrow()
    out = np.zeros((1 << power) // 8, np.uint8)
    for b, data in zip(blocks["block"].to_pylist(), blocks["bits"].to_pylist(), strict=True):
        out[b << (BLOCK_BITS - 3) : (b + 1) << (BLOCK_BITS - 3)] = np.frombuffer(data, np.uint8)
    return out


def numbered(vocabulary: Broadcast, width: int):
    """Names and counts of tokens as keys of 1-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, numbers = vocabulary.value
            ids = numbers[np.searchsorted(known, batch.column(0).to_numpy())].astype(np.int64)
            none = np.zeros(len(ids), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), 1, np.int32)), *map(pa.array, keys_of([ids], width)), batch.column(1), pa.array(none), pa.array(none)], names=["n", *columns(width), "count", "n_left", "n_right"])

    return run


def spelled(tokens: Broadcast, width: int):
    """Keys as words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = codes_of([batch.column(1 + k).to_numpy() for k in range(width)], 2 * width)
            words = [tokens.value.take(pa.array(c - 1, mask=c == 0)) for c in codes]
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(*words, " ", null_handling="skip"), batch.column(0), *batch.columns[1 + width :]], names=["gram", "n_tokens", "count", "n_left", "n_right"])

    return run
