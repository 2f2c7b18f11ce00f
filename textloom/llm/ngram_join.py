"""N-gram Jaccard join by universe partitioning and pigeonhole.

A document is the set of its distinct word shingles. Sets are grouped into size bands; inside a
band the universe of shingles is hashed into segments. Two sets with the wanted similarity
differ in at most H shingles, so with segment allowances ``v`` that sum to more than H they
differ by less than ``v`` in some segment: not at all where v = 1 (one signature, the segment's
subset), by at most one shingle where v = 2 (the subset and its one-deletion neighbourhood).
How many segments a band gets of either kind is chosen by cost: signature rows against expected
chance matches among the rows of the table.

A segment that is empty would match in every second document, so empty subsets are no
signatures. The allocation has spare segments for that; the few sets that still lack enough
filled segments also emit their empty ones, which meet only each other.

Signatures travel in packed rows, one for each bucket and some two million signatures of a task: sorted and cut to 46 bits, each is the
step from the one before. Signatures that agree in 46 bits only add candidates.

Copies collapse first: equal sets are one node. Candidates of one signature are checked against
its least node (a star, not all pairs); links found there make components. Nodes that a signature
holds together but links don't are then compared by parity sketches, which bound the difference
of two sets from below, block by block of bounded size, and only pairs that the bound leaves
are emitted. Each surviving pair's intersection is counted over the whole texts, by 64-bit hashes that a digest of all
texts seeds (no text can be made to fit them); where the count is within ``NEAR`` shingles of the verdict's edge, by the words themselves.
Two hashes of one pair of texts agree by chance with a probability of about 10^-12 for sets of 3,000; to move a verdict
from beyond ``NEAR``, four must.

Edge cases: null or empty texts have no shingles and link with nothing; texts with fewer words
than a shingle are one sequence; repeated rows are equal sets; a null id may be a
member, but never gives a class its id unless it is alone; an empty table gives an empty result;
other columns are ignored by ``jaccard_components`` and kept by ``drop_near_copies``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.components import components
from textloom.llm.hashing import content_seed, mix, words_table
from textloom.session import Scope, keep_ids, materialize, remove, row_hash, scratch_path

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Cost model: a candidate check in signature rows, and the chance that two documents of one
#: band share a given shingle.
CHECK_COST = 8.0
SHARED_SHINGLE = 0.00002
#: Shingles on either side of the similarity's edge where words decide.
NEAR = 3
#: Bits of a parity sketch, and rows of a block when one signature's nodes are compared by sketch.
SKETCH_BITS = 2048
#: Bits of a signature that are sent (equal ones only make candidates, so that fewer lose none); signatures that a task packs
#: at once; shingles for each bucket of signatures (which are somewhat fewer), and buckets at most.
SIG_BITS, PACKED_SIGS, BUCKET_SHINGLES, MOST_BUCKETS = 46, 1 << 21, 1 << 21, 1 << 16
BLOCK_ROWS = 2048
#: The row that stands for others: the least id (null last), then the least text hash.
LEAST_ROW = "min(struct(id IS NULL AS none, id, row))"
IS_REP = "id <=> rep AND row = rep_row"
_U = np.uint64


def shingle_set(text: str | None, width: int, seed: int) -> np.ndarray:
    """Ascending distinct shingle hashes of one text."""
    words = (text or "").encode().translate(LOWER).split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words_table(seed).__getitem__, words), np.uint64, n)
    k = min(width, n)
    total = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        total = mix(total * _U(0x9E3779B97F4A7C15) + h[i : n - k + 1 + i])
    return np.unique(total)


def word_shingles(text: str | None, width: int) -> set[tuple[bytes, ...]]:
    """The shingles of one text themselves."""
    words = (text or "").encode().translate(LOWER).split()
    k = min(width, len(words))
    return set(zip(*[words[i : len(words) - k + 1 + i] for i in range(k)], strict=True)) if k else set()


def similar(both: int, p: int, q: int, percent: int, words: Callable[[], tuple[set, set]]) -> bool:
    """Whether sets of ``p`` and ``q`` that share ``both`` by their hashes are similar; near the edge their words are compared."""
    if abs(100 * both - percent * (p + q - both)) <= (100 + percent) * NEAR:
        x, y = words()
        both, p, q = len(x & y), len(x), len(y)
    return 100 * both >= percent * (p + q - both)


def set_name(tokens: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit names of a set (signed)."""
    with np.errstate(over="ignore"):
        a = mix(tokens ^ _U(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) + _U(len(tokens))
        b = mix(tokens + _U(0x1234567898765432)).sum(dtype=np.uint64)
    pair = mix(np.array([a, b], np.uint64)).view(np.int64)
    return int(pair[0]), int(pair[1])


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Parities of the set's counts in ``SKETCH_BITS`` cells, as longs.

    Each shingle of a symmetric difference flips one cell, so the sketches of two sets differ in
    at most as many bits as the sets differ in shingles.
    """
    cells = (mix(tokens ^ _U(0x0F0F0F0F0F0F0F0F)) % _U(SKETCH_BITS)).astype(np.int64)
    return np.packbits((np.bincount(cells, minlength=SKETCH_BITS) & 1).astype(np.uint8)).view(np.int64)


@dataclass(frozen=True)
class Band:
    """Sets of ``low`` to ``high`` shingles, and larger ones that may still match them."""

    number: int
    low: int
    high: int
    reach: int
    differ: int
    single: int
    double: int

    @property
    def segments(self) -> int:
        return self.single + self.double


def _slack(single: int, double: int, size: float) -> int:
    """Allowance that empty or one-element segments are likely to cost a set of this size."""
    q = size / (single + double)
    lost = (single + 2 * double * (1 + q)) * math.exp(-q)
    return math.ceil(lost + 3 * math.sqrt(lost)) if lost > 0.01 else 0


def allocate(low: int, high: int, differ: int, rows_in_band: float) -> tuple[int, int]:
    """(segments with v = 1, segments with v = 2) of least cost for a band."""
    best = None
    steps = sorted({round((differ + 2) // 2 * i / 12) for i in range(13)})
    for double in steps:
        single = max(0, differ + 1 - 2 * double)
        for _ in range(12):
            if single + double == 0:
                single = 1
            need = differ + 1 + _slack(single, double, low)
            if single + 2 * double >= need:
                break
            single = need - 2 * double
        else:
            continue
        q = (low + high) / 2 / (single + double)
        chance = math.exp(-q * (1 - SHARED_SHINGLE)) - math.exp(-q)
        rows = single + double * (1 + q)
        # A neighbourhood signature has one shingle less, which multiplies its chance by about e.
        cost = rows + CHECK_COST * rows_in_band * (single + double * (1 + math.e * q)) * chance
        if best is None or cost < best[0]:
            best = (cost, single, double)
    return (best[1], best[2]) if best else (0, differ // 2 + 1)


@lru_cache(maxsize=8)
def bands(percent: int, rows: int) -> tuple[Band, ...]:
    """Size bands of ratio 1 / similarity squared, up to 2**31 shingles."""
    out, low = [], 1
    while low < 1 << 31:
        high = max(low, low * 10_000 // (percent * percent))
        # The smaller set of a pair has at most high shingles, and the union at most high / s.
        differ = (100 - percent) * high // percent
        single, double = allocate(low, high, differ, max(1.0, rows / 40)) if differ else (0, 0)
        out.append(Band(len(out), low, high, high * 100 // percent, differ, single, double))
        low = high + 1
    return tuple(out)


def signatures(tokens: np.ndarray, all_bands: tuple[Band, ...]) -> np.ndarray:
    """Signatures of one set, in its own band and in those below that it may match."""
    n, parts = len(tokens), []
    if not n:
        return np.empty(0, np.uint64)
    top, weights = tokens >> _U(32), mix(tokens ^ _U(0x5DEECE66D1CE4E5B))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(weights, dtype=np.uint64)])
    for band in all_bands:
        if band.low > n:
            break
        if band.reach < n or not band.segments:
            continue
        m = band.segments
        where = ((top * _U(m)) >> _U(32)).astype(np.int64)
        counts = np.bincount(where, minlength=m)
        ends = np.cumsum(counts)
        subset = sums[ends] - sums[ends - counts]
        salt = mix(np.arange(m, dtype=np.uint64) + _U((band.number + 1) << 32))
        d = band.double
        lost = int((counts[d:] == 0).sum()) + 2 * int((counts[:d] <= 1).sum())
        lacking = band.single + 2 * d - lost <= band.differ
        parts.append(mix(subset + salt) if lacking else mix(subset + salt)[counts > 0])
        if d:
            inside = where[: ends[d - 1]]
            left = mix(subset[inside] - weights[: len(inside)] + salt[inside])
            parts.append(left if lacking else left[counts[inside] > 1])
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.uint64)


def _name_rows(width: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sketches = [], []
            for text in batch.column(1).to_pylist():
                tokens = shingle_set(text, width, seed)
                rows.append((len(tokens), *set_name(tokens)))
                sketches.append(sketch(tokens))
            size, node, check = zip(*rows, strict=True) if rows else ((), (), ())
            flat = np.concatenate(sketches) if sketches else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * (SKETCH_BITS // 64)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(size, pa.int64()), pa.array(node, pa.int64()), pa.array(check, pa.int64()), lists], names=["id", "row", "size", "node", "check", "sketch"])

    return run


def _cross_rows(percent: int, best: bool):
    def run(table: pa.Table) -> pa.Table:
        """Pairs of one block pair that have different roots and may still be similar by size and sketch.

        With ``best``, only the pair of least difference for each two roots.
        """
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        node, root, size, side = (table[c].to_numpy() for c in ("node", "root", "size", "side"))
        bits = np.array(table["sketch"].combine_chunks().flatten()).view(np.uint64).reshape(len(node), -1)
        found = [np.empty((5, 0), np.int64)]
        right = np.flatnonzero(side == j)
        for k in np.flatnonzero(side == i):
            # Inside one block a pair is met once; between two blocks each side stands once.
            r = right[(root[right] != root[k]) & ((node[right] > node[k]) if i == j else True)]
            r = r[(np.minimum(size[r], size[k]) * 100 >= percent * np.maximum(size[r], size[k]))]
            differ = np.bitwise_count(bits[r] ^ bits[k]).sum(1, dtype=np.int64)
            near = differ * (100 + percent) <= (100 - percent) * (size[r] + size[k])
            r, differ = r[near], differ[near]
            rows = np.stack([np.minimum(root[r], root[k]), np.maximum(root[r], root[k]), differ, np.minimum(node[r], node[k]), np.maximum(node[r], node[k])])
            if best and len(r):
                order = np.lexsort(rows[::-1])
                rows = rows[:, order[np.append(True, (np.diff(rows[:2, order]) != 0).any(0))]]
            found.append(rows)
        rows = np.concatenate(found, axis=1)
        if best and rows.shape[1]:
            order = np.lexsort(rows[::-1])
            rows = rows[:, order[np.append(True, (np.diff(rows[:2, order]) != 0).any(0))]]
        return pa.table({"a": rows[3], "b": rows[4]})

    return run


def pack(sigs: np.ndarray, nodes: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """``bucket, steps, places, names``: signatures of ``SIG_BITS`` bits in order, as steps from one to the next, and the places of their nodes in a list of names.

    A step has 4 bytes, or 8 if one of its row needs them; a place has 2, or 4.
    """
    names, place = np.unique(nodes, return_inverse=True)
    sigs = sigs >> _U(64 - SIG_BITS)
    order = np.argsort(sigs, kind="stable")
    sigs, place = sigs[order], place[order]
    cuts = np.searchsorted(sigs, bucket_bounds(buckets)).tolist()
    for k, (i, j) in enumerate(zip([0, *cuts], [*cuts, len(sigs)], strict=True)):
        if j > i:
            steps, (used, own) = np.diff(sigs[i:j], prepend=_U(0)), np.unique(place[i:j], return_inverse=True)
            first = steps[:1].copy()
            steps[0] = 0
            wide = np.uint64 if steps.max() >> _U(32) else np.uint32
            yield k, first.tobytes() + steps.astype(wide).tobytes(), own.astype(np.uint16 if len(used) <= 1 << 16 else np.uint32).tobytes(), names[used].tobytes()


def unpack(steps: bytes, places: bytes, names: bytes) -> tuple[np.ndarray, np.ndarray]:
    known = np.frombuffer(names, np.int64)
    place = np.frombuffer(places, np.uint16 if len(known) <= 1 << 16 else np.uint32)
    wide = np.uint64 if len(steps) - 8 == 8 * len(place) else np.uint32
    return np.cumsum(np.frombuffer(steps, wide, offset=8), dtype=np.uint64) + np.frombuffer(steps, _U, 1), known[place]


def bucket_bounds(buckets: int) -> np.ndarray:
    """Where all buckets but the first begin."""
    return np.array([(k << SIG_BITS) // buckets for k in range(1, buckets)], np.uint64)


def _signature_rows(width: int, seed: int, percent: int, rows: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bands(percent, rows)
        sigs, nodes, held = [], [], 0

        def packed() -> Iterator[pa.RecordBatch]:
            for row in pack(np.concatenate(sigs), np.concatenate(nodes), buckets):
                yield pa.RecordBatch.from_arrays([pa.array([row[0]], pa.int32()), *[pa.array([x], pa.binary()) for x in row[1:]]], names=["bucket", "steps", "places", "names"])

        for batch in batches:
            for text in batch.column(1):
                tokens = shingle_set(text.as_py(), width, seed)
                found = signatures(tokens, table)
                if len(found):
                    sigs.append(found)
                    nodes.append(np.full(len(found), set_name(tokens)[0], np.int64))
                    held += len(found)
                if held >= PACKED_SIGS:
                    yield from packed()
                    sigs, nodes, held = [], [], 0
        if held:
            yield from packed()

    return run


def _candidate_rows(table: pa.Table) -> pa.Table:
    """``sig, pivot, node`` of a bucket: each signature's nodes but the least, sig only where three or more nodes share it."""
    found = [unpack(*(x.as_py() for x in row)) for row in zip(table["steps"], table["places"], table["names"], strict=True)]
    sigs, nodes = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(sigs, kind="stable")
    sigs = sigs[order]
    new = np.append(True, sigs[1:] != sigs[:-1])
    shared = ~new | np.append(~new[1:], False)
    sigs, nodes = sigs[shared], nodes[order][shared]
    order = np.lexsort([nodes, sigs])
    sigs, nodes = sigs[order], nodes[order]
    other = np.append(True, (sigs[1:] != sigs[:-1]) | (nodes[1:] != nodes[:-1]))[: len(sigs)]
    sigs, nodes = sigs[other], nodes[other]
    starts = np.flatnonzero(np.append(True, sigs[1:] != sigs[:-1])[: len(sigs)])
    size = np.diff(np.append(starts, len(sigs)))
    rest, n, pivot = np.ones(len(sigs), bool), np.repeat(size, size), np.repeat(nodes[starts], size)
    rest[starts] = False
    return pa.table({"sig": pa.array(sigs[rest].view(np.int64), pa.int64(), mask=n[rest] <= 2), "pivot": pivot[rest], "node": nodes[rest]})


def _check_rows(width: int, seed: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of one pivot come together, so its set is at hand.
        known = lru_cache(maxsize=64)(lambda text: shingle_set(text, width, seed))
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                p, q = known(x), known(y)
                if min(len(p), len(q)) * 100 < percent * max(len(p), len(q)):
                    ok.append(False)
                    continue
                ok.append(similar(len(np.intersect1d(p, q, assume_unique=True)), len(p), len(q), percent, lambda x=x, y=y: (word_shingles(x, width), word_shingles(y, width))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


class _Join:
    """The tables of one run."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> None:
        self.source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), row_hash(text_col).alias("row"))
        self.width, self.percent = width, percent
        first = content_seed(self.source, "id", "row")
        for k in range(100):
            self.seed = (first + k) % 2**64
            named = self.source.mapInArrow(_name_rows(width, self.seed), "id long, row long, size long, node long, check long, sketch array<long>")
            path = scratch_path(docs.sparkSession, "jaccard-sketched")
            sketched = materialize(named, path=path)
            nodes = sketched.where("size > 0").groupBy("node").agg(F.expr(LEAST_ROW).alias("least"), F.first("size").alias("size"), F.first("sketch").alias("sketch"), F.min("check").alias("low"), F.max("check").alias("high"), F.count(F.lit(1)).alias("rows"))
            nodes = nodes.select("*", F.col("least.id").alias("rep"), F.col("least.row").alias("rep_row")).drop("least")
            self.nodes = materialize(nodes, "jaccard-nodes")
            # The sketches are with the nodes now; rows keep their names only.
            self.named = materialize(sketched.select("id", "row", "size", "node"), "jaccard-named")
            remove(docs.sparkSession, path)
            # Two different sets under one name: all names are made anew.
            if self.nodes.where("low <> high").isEmpty():
                return
        raise RuntimeError("no seed without a collision")

    def candidates(self) -> DataFrame:
        """``sig, pivot, node``: every signature that several nodes share; sig only where three or more do."""
        with Scope(self.source.sparkSession) as scope:
            return self._candidates(scope)

    def _candidates(self, scope: Scope) -> DataFrame:
        rows, shingles = self.named.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
        singles = self.source
        copies = self.nodes.where("rows > 1").select("node", "rep", "rep_row")
        if not copies.isEmpty():
            spare = self.named.where("size > 0").select("id", "row", "node").join(copies, "node").where(f"NOT ({IS_REP})").select("id", "row").distinct()
            singles = keep_ids(self.source, scope.keep(spare, "jaccard-spare"), "id", anti=True, row=F.col("row"))
        buckets = int(min(MOST_BUCKETS, max(self.source.sparkSession.sparkContext.defaultParallelism, shingles // BUCKET_SHINGLES)))
        made = singles.mapInArrow(_signature_rows(self.width, self.seed, self.percent, rows, buckets), "bucket int, steps binary, places binary, names binary")
        return materialize(made.groupBy("bucket").applyInArrow(_candidate_rows, "sig long, pivot long, node long"), "jaccard-candidates")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``(a, b)`` of nodes that are as similar as wanted."""
        with Scope(self.source.sparkSession) as scope:
            return self._verified(pairs, scope)

    def _verified(self, pairs: DataFrame, scope: Scope) -> DataFrame:
        sized = self.nodes.select("node", "size", "sketch")
        a, b = (sized.select(F.col("node").alias(k), F.col("size").alias(f"n{k}"), F.col("sketch").alias(f"s{k}")) for k in "ab")
        near = pairs.join(a, "a").join(b, "b").where(f"least(na, nb) * 100 >= {self.percent} * greatest(na, nb)")
        differ = "aggregate(zip_with(sa, sb, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)"
        near = near.where(f"{differ} * {100 + self.percent} <= {100 - self.percent} * (na + nb)").select("a", "b")
        pairs = scope.keep(near, "jaccard-pairs")
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
        reps = self.nodes.join(wanted, "node", "left_semi").select(F.col("rep").alias("id"), F.col("rep_row").alias("row"))
        rows = keep_ids(self.source, scope.keep(reps, "jaccard-reps"), "id", row=F.col("row"))

        def named(batches: Iterator[pa.RecordBatch], width=self.width, seed=self.seed) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                node = [set_name(shingle_set(t, width, seed))[0] for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), batch.column(1)], names=["node", "text"])

        texts = rows.mapInArrow(named, "node long, text string")
        if not self.nodes.where("rep IS NULL").isEmpty():  # rows without an id share it
            texts = texts.dropDuplicates(["node"])
        texts = scope.keep(texts, "jaccard-texts")
        second = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
        both = second.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a").select("a", "b", "x", "y")
        return materialize(both.mapInArrow(_check_rows(self.width, self.seed, self.percent), "a long, b long"), "jaccard-links")

    def roots(self) -> tuple[DataFrame, DataFrame]:
        """Links found and ``node, root`` of all nodes that aren't roots."""
        found = self.candidates()
        links = self.verified(found.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct())
        roots = components(links)
        # First one pair for any two classes, as one link joins them; then whatever may still link.
        for best in (True, False):
            at = found.where("sig IS NOT NULL").select("sig", "node").join(roots, "node", "left").select("sig", "node", F.coalesce("root", "node").alias("root"))
            apart = at.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n")).where("low <> high")
            rest = at.join(apart.select("sig", F.expr(f"int(ceil(n / {BLOCK_ROWS}))").alias("blocks")), "sig").join(self.nodes.select("node", "size", "sketch"), "node")
            rest = rest.withColumn("side", F.expr("int(pmod(xxhash64(node), blocks))")).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
            rest = rest.select("sig", "node", "root", "size", "sketch", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
            pairs = rest.groupBy("sig", "i", "j").applyInArrow(_cross_rows(self.percent, best), "a long, b long").distinct()
            more = self.verified(pairs)
            if not more.isEmpty():
                roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
            links = links.unionByName(more)
        return links, roots


def _classes(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """``id, row, size, component, rep, rep_row`` for every row: its class's least id, and the row that stands for the class."""
    run = _Join(docs, id_col, text_col, width, percent)
    _, roots = run.roots()
    placed = run.nodes.join(roots, "node", "left").select("node", F.col("rep").alias("id"), F.col("rep_row").alias("row"), F.coalesce("root", "node").alias("root"))
    least = placed.groupBy("root").agg(F.min("id").alias("component"), F.expr(LEAST_ROW).alias("least"))
    by_node = placed.select("node", "root").join(least, "root").select("node", "component", F.col("least.id").alias("rep"), F.col("least.row").alias("rep_row"))
    return run.named.join(by_node, "node", "left").select("id", "row", "size", "component", "rep", "rep_row")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``id_col, n_shingles, component_id`` for every row; linked texts share the least id reachable."""
    out = _classes(docs, id_col, text_col, width, percent)
    return out.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), F.when(F.col("size") == 0, F.col("id")).otherwise(F.coalesce("component", "id")).alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with one document (the least id) of each linked class; own columns only."""
    gone = _classes(docs, id_col, text_col, width, percent).where(f"size > 0 AND NOT ({IS_REP})").select(F.col("id").alias("_gone"), "row").distinct()
    return keep_ids(docs, materialize(gone, "jaccard-gone"), id_col, anti=True, ids_col="_gone", row=row_hash(text_col))
