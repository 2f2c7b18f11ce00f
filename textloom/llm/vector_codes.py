"""Vector codes: a product quantiser fitted by exact Lloyd rounds with heaps (Heap Lloyd).

Vectors become integers, ``floor(scale * x)``, cut into equal parts; each part position has its own
codebook. All sums and squared distances are exact integers.

Rows are packed into blocks. A block keeps, for each part position and entry, a heap of the parts
assigned to it, keyed by slack: lower bound of the distance to any other entry minus upper bound of the
distance to the own one, plus the entry's drift so far. When entries move, a part's slack shrinks by at
most the own entry's drift and the largest drift of the others; their running sum is the same for the
whole heap, so a part can have changed its entry only if its key is not above that sum. Those parts are
popped, compared with all entries exactly, and pushed to the heap of the nearest; the others are not
looked at. Keys are rounded down by more than any rounding error, so the assignment is the exact one.

A round writes the blocks anew and sends only what parts that moved change: counts and sums, added up by
Spark per (part position, entry, component). Totals, entries and drifts are ``parts * entries`` rows, which the
driver keeps. A round's table is deleted when the next one is written, so two exist at a time; a lost executor
costs a share of one round.

Edge cases: vectors that are null or hold null or non-finite components are dropped; shorter vectors, and
lengths that the parts don't divide, count as filled up with zeros; empty vectors are zeros; with fewer kept
rows than entries there are as many entries as rows; ties of the ids that start the codebooks are ordered by
vector, null ids come last; repeated rows are rows of their own; null labels are one label; errors beyond 64
bits are null; an empty table gives an empty result; other columns are ignored. Components beyond 24 bits
are computed with Python's integers, without a bound.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import join_groups, materialize, remove, scratch_path

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Vectors of a block at most. (A heap's places fit 16 bits.)
BLOCK_ROWS = 2048
#: Components below it are computed in 64 bits: their squared differences add up exactly.
NARROW = 1 << 24
#: Sums travel as signed digits of so many bits, so that sums of them fit 64 bits.
DIGIT_BITS = 30


def kept(vector: Column) -> Column:
    """Whether a vector is coded."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def integers(column: pa.Array, width: int, parts: int, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as (row, part, component); Python's integers if one is too wide."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    out = np.zeros((len(column), width))
    if len(column):
        sizes = column.value_lengths().to_numpy(zero_copy_only=False)
        values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
        out[np.repeat(np.arange(len(column)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    if not (np.abs(out) < NARROW / scale / 2).all():
        exact = np.array([_floor(x, scale) for x in out.ravel().tolist()], object)
        return exact.reshape(len(out), parts, -1)
    return np.floor(out * scale).astype(np.int64).reshape(len(out), parts, -1)


def _floor(x: float, scale: int) -> int:
    above, below = x.as_integer_ratio()
    return above * scale // below


def pack(x: np.ndarray) -> bytes:
    """Integers as the narrowest of 16, 32 bits or decimal text."""
    if x.dtype != object:
        return (b"h" if not x.size or np.abs(x).max() < 1 << 15 else b"i") + x.astype(np.int16 if not x.size or np.abs(x).max() < 1 << 15 else np.int32).tobytes()
    return b"t" + ",".join(map(str, x.ravel())).encode()


def unpack(raw: bytes, parts: int, width: int) -> np.ndarray:
    if raw[:1] == b"t":
        return np.array([int(v) for v in raw[1:].split(b",")], object).reshape(-1, parts, width // parts)
    return np.frombuffer(raw, np.int16 if raw[:1] == b"h" else np.int32, offset=1).astype(np.int64).reshape(-1, parts, width // parts)


def squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of parts (n, d) to entries (k, d)."""
    return np.stack([((x - e) ** 2).sum(axis=1) for e in entries], axis=1)


def _roots(x: np.ndarray) -> np.ndarray:
    """Square roots as doubles; infinite beyond them."""
    return np.sqrt(x.astype(float)) if x.dtype != object else np.vectorize(_root, otypes=[float])(x)


def _root(v: int) -> float:
    try:
        return math.sqrt(v) if v < 1 << 1000 else float(math.isqrt(v))
    except OverflowError:
        return math.inf


def slack(near: np.ndarray, distances: np.ndarray) -> np.ndarray:
    """Distance to the second nearest entry minus that to the nearest, rounded down."""
    if distances.shape[1] == 1:
        return np.full(len(near), np.inf)
    others = distances.copy()
    others[np.arange(len(near)), near] = np.inf
    lower, upper = others.min(axis=1), distances[np.arange(len(near)), near]
    with np.errstate(invalid="ignore"):
        return lower - upper - 1e-9 * (lower + upper + 1.0)


class Changes:
    """What moved parts change: counts and sums by (part position, entry)."""

    def __init__(self, shape: tuple[int, int, int]) -> None:
        self.n, self.sums = np.zeros(shape[:2], np.int64), np.zeros(shape, object)

    def move(self, part: int, x: np.ndarray, old: np.ndarray | None, new: np.ndarray) -> None:
        for to, sign in ((new, 1), (old, -1)):
            if to is not None:
                for e in np.unique(to).tolist():
                    own = x[to == e]
                    self.n[part, e] += sign * len(own)
                    self.sums[part, e] += sign * own.sum(axis=0).astype(object)

    def rows(self) -> Iterator[dict]:
        """Digits of the sums (component -1: the counts)."""
        touched = (self.n != 0) | (self.sums != 0).astype(bool).any(axis=2)
        for p, e in np.argwhere(touched).tolist():
            for c, value in enumerate([int(self.n[p, e]), *map(int, self.sums[p, e])], -1):
                sign, value, digit = (-1 if value < 0 else 1), abs(value), 0
                while value:
                    yield {"part": p, "entry": e, "component": c, "digit": digit, "value": sign * (value & (1 << DIGIT_BITS) - 1)}
                    value, digit = value >> DIGIT_BITS, digit + 1


class Heaps:
    """For each (part position, entry) a heap of (key, place) of a block's parts."""

    def __init__(self, parts: int, entries: int) -> None:
        self.of: list[list[list[tuple[float, int]]]] = [[[] for _ in range(entries)] for _ in range(parts)]

    def push(self, part: int, keys: np.ndarray, places: np.ndarray, entries: np.ndarray) -> None:
        for key, place, e in zip(keys.astype(np.float32).tolist(), places.tolist(), entries.tolist(), strict=True):
            heapq.heappush(self.of[part][e], (key, place))

    def violated(self, part: int, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Takes out the parts whose key isn't above their entry's drift: places and entries."""
        places, entries = [], []
        for e, heap in enumerate(self.of[part]):
            while heap and heap[0][0] <= drift[e]:
                places.append(heapq.heappop(heap)[1])
                entries.append(e)
        return np.array(places, np.int64), np.array(entries, np.int64)

    def assigned(self, n: int) -> np.ndarray:
        out = np.zeros((n, len(self.of)), np.int64)
        for p, heaps in enumerate(self.of):
            for e, heap in enumerate(heaps):
                out[[place for _, place in heap], p] = e
        return out

    def tobytes(self) -> tuple[bytes, bytes, bytes]:
        flat = [heap for heaps in self.of for heap in heaps]
        keys, places = ([x[k] for heap in flat for x in heap] for k in (0, 1))
        return np.array([len(h) for h in flat], np.int32).tobytes(), np.array(keys, np.float32).tobytes(), np.array(places, np.uint16).tobytes()

    @classmethod
    def frombytes(cls, parts: int, entries: int, sizes: bytes, keys: bytes, places: bytes) -> Heaps:
        out = cls(parts, entries)
        both = list(zip(np.frombuffer(keys, np.float32).tolist(), np.frombuffer(places, np.uint16).tolist(), strict=True))
        ends = np.cumsum(np.frombuffer(sizes, np.int32)).tolist()
        for k, (a, b) in enumerate(zip([0, *ends], ends, strict=False)):
            out.of[k // entries][k % entries] = both[a:b]
        return out


# --- rounds over blocks -----------------------------------------------------------------------

_HEAP = [("sizes", pa.binary()), ("keys", pa.binary()), ("places", pa.binary())]
_DELTA = [("part", pa.int32()), ("entry", pa.int32()), ("component", pa.int32()), ("digit", pa.int32()), ("value", pa.int64())]
_BLOCK = pa.schema([("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.string())), ("vectors", pa.binary()), *_HEAP, *_DELTA])
_BLOCK_DDL = "ids array<long>, labels array<string>, vectors binary, sizes binary, keys binary, places binary, part int, entry int, component int, digit int, value long"


def _first(entries: np.ndarray, width: int, scale: int, block_rows: int):
    """Packs rows to blocks and compares every part with all entries."""
    parts, k, _ = entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        changes = Changes(entries.shape)
        for batch in batches:
            for at in range(0, len(batch), block_rows):
                cut = batch.slice(at, block_rows)
                x, heaps = integers(cut.column("vector"), width, parts, scale), Heaps(parts, k)
                for p in range(parts):
                    distances = squares(x[:, p], entries[p])
                    near = distances.argmin(axis=1)
                    changes.move(p, x[:, p], None, near)
                    heaps.push(p, _down(slack(near, _roots(distances)), np.zeros(len(near))), np.arange(len(near)), near)
                yield _block(cut.column("id").to_pylist(), cut.column("label").to_pylist(), pack(x), heaps)
        yield from _sent(changes)

    return run


def _down(slacks: np.ndarray, drift: np.ndarray) -> np.ndarray:
    """Keys as 32-bit floats that are not above the exact ones; of what can't be computed, below all."""
    with np.errstate(over="ignore", invalid="ignore"):
        keys = np.nextafter((slacks + drift - 1e-9 * np.abs(drift)).astype(np.float32), np.float32(-np.inf))
    return np.where(np.isnan(keys), np.float32(-np.inf), keys)


def _next(entries: np.ndarray, drift: np.ndarray, width: int):
    """A round over blocks: pop what the drift has violated, compare exactly, push."""
    parts, k, _ = entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        changes = Changes(entries.shape)
        for batch in batches:
            for row in _each(batch):
                x, heaps = unpack(row["vectors"], parts, width), Heaps.frombytes(parts, k, row["sizes"], row["keys"], row["places"])
                for p in range(parts):
                    places, old = heaps.violated(p, drift[p])
                    if len(places):
                        distances = squares(x[places, p], entries[p])
                        near = distances.argmin(axis=1)
                        moved = near != old
                        if moved.any():
                            changes.move(p, x[places[moved], p], old[moved], near[moved])
                        heaps.push(p, _down(slack(near, _roots(distances)), drift[p][near]), places, near)
                yield _block(row["ids"], row["labels"], row["vectors"], heaps)
        yield from _sent(changes)

    return run


def _each(batch: pa.RecordBatch) -> Iterator[dict]:
    """A block at a time, not the whole batch."""
    for k in range(len(batch)):
        yield batch.slice(k, 1).to_pylist()[0]


def _block(ids: list, labels: list, vectors: bytes, heaps: Heaps) -> pa.RecordBatch:
    sizes, keys, places = heaps.tobytes()
    return pa.RecordBatch.from_pylist([{"ids": ids, "labels": labels, "vectors": vectors, "sizes": sizes, "keys": keys, "places": places}], schema=_BLOCK)


def _sent(changes: Changes) -> Iterator[pa.RecordBatch]:
    if rows := list(changes.rows()):
        yield pa.RecordBatch.from_pylist(rows, schema=_BLOCK)


class Codebooks:
    """Entries, totals and drifts, kept by the driver: ``parts * entries`` of them."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        self.n, self.sums = np.zeros(entries.shape[:2], object), np.zeros(entries.shape, object)
        self.drift = np.zeros(entries.shape[:2])

    def update(self, sent: DataFrame) -> None:
        """Adds the changes of a round; entries become the floors of their means."""
        for r in sent.groupBy("part", "entry", "component", "digit").agg(F.sum("value").alias("value")).collect():
            value = r["value"] << DIGIT_BITS * r["digit"]
            if r["component"] < 0:
                self.n[r["part"], r["entry"]] += value
            else:
                self.sums[r["part"], r["entry"], r["component"]] += value
        new, used = self.entries.astype(object), self.n > 0
        new[used] = self.sums[used] // self.n[used][:, None]
        moved = _roots(((new - self.entries) ** 2).sum(axis=2))
        for e in range(moved.shape[1]):
            others = np.delete(moved, e, axis=1)
            self.drift[:, e] += (moved[:, e] + (others.max(axis=1) if others.size else 0.0)) * (1 + 1e-9)
        narrow = all(abs(v) < NARROW for v in new.ravel())
        self.entries = new.astype(np.int64) if narrow else new

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(v) for v in self.entries.ravel()).encode()).hexdigest()


def _codes(entries: np.ndarray, width: int):
    parts, k, _ = entries.shape
    longest = (1 << 63) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _each(batch):
                x, n = unpack(row["vectors"], parts, width), len(row["ids"])
                code = Heaps.frombytes(parts, k, row["sizes"], row["keys"], row["places"]).assigned(n)
                error = sum(((x[:, p] - entries[p][code[:, p]]) ** 2).sum(axis=1) for p in range(parts))
                text = ["".join(f"{e:02x}" for e in c) for c in code.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), pa.array(row["labels"], pa.string()), pa.array(text, pa.string()), pa.array([int(e) if e <= longest else None for e in error], pa.int64())], names=["id", "label", "code", "error"])

    return run


def encode_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for every kept row."""
    rows = vectors.where(kept(F.col(vector_col))).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("vector"))
    longest = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    width = max(1, -(-longest // parts)) * parts
    start = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow()
    if not len(start):
        return rows.selectExpr("id AS vec_id", "'' AS code", "0L AS error", "0L AS label_error", "'' AS codebooks_sha256")
    spark, books = vectors.sparkSession, Codebooks(integers(start["vector"], width, parts, scale).transpose(1, 0, 2).copy())
    path = scratch_path(spark, "codes")
    state = materialize(rows.mapInArrow(_first(books.entries, width, scale, block_rows), _BLOCK_DDL), path=path)
    for _ in range(rounds):
        books.update(state.where("part IS NOT NULL"))
        blocks = state.where("vectors IS NOT NULL").select("ids", "labels", "vectors", "sizes", "keys", "places")
        last, path = path, scratch_path(spark, "codes")
        state = materialize(blocks.mapInArrow(_next(books.entries, books.drift.copy(), width), _BLOCK_DDL), path=path)
        remove(spark, last)
    blocks = state.where("vectors IS NOT NULL").select("ids", "labels", "vectors", "sizes", "keys", "places")
    coded = materialize(blocks.mapInArrow(_codes(books.entries, width), "id long, label string, code string, error long"), "coded")
    remove(spark, path)
    coded = coded.withColumn("_label", F.coalesce(F.concat(F.lit("="), "label"), F.lit("")))
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    fits = (total <= (1 << 63) - 1) & (F.count("error") == F.count(F.lit(1)))
    labels = materialize(coded.groupBy("_label").agg(F.count(F.lit(1)).alias("_rows"), F.when(fits, total.cast("long")).alias("label_error")), "code-labels")
    out = join_groups(coded, labels, "_label", "_rows", coded.count())
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
