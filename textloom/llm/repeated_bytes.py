"""Removal of every byte inside a long string that occurs anywhere else, by a difference cover.

A suffix is *sampled* if its place in its document, modulo ``v``, lies in a difference cover: for
any two places there is a step below ``v`` after which both are sampled. So if two strings of
``4 v - 1`` bytes are equal, then somewhere in their first ``v`` places two sampled suffixes start
with the same three tuples of ``v`` bytes.

0. Regions. Most text has no repeat, and sorting its sampled suffixes would move several bytes for
   each byte of input (the README has figures). A string of ``4 v - 1`` bytes holds an anchor, the
   gram of least hash; equal strings have equal anchors. Anchors of all documents are compared, and
   the steps below see only the strings around anchors that occur twice.
1. Sample. The tuple triples of the sampled suffixes get names, which are sorted among owners; each
   owner compares neighbours and answers which names occur twice.
2. Recursion. A string of ``LENGTH`` bytes that repeats has a repeated triple in each ``v`` places
   of its start and further on, as far as triples fit into it: names of names. Strings that lack one
   are dropped.
3. Merge. The suffixes left, sampled or not, are sorted by the name of their first ``LENGTH``
   bytes, neighbours are compared, and the bytes of equal ones marked, merged to runs and dropped.

Names are hashes, whose order stands for that of the strings: any order will do for finding equal
neighbours. Those of steps 0 to 2 have 64 bits and only choose what goes on: strings that share one by accident go on
for nothing. Those of step 3 decide. They have 96 bits, a name and a check, built from the bytes by doubling, with multipliers that a digest of
the whole table seeds: no text can be made to collide with another, and among 10^13 strings a chance collision has a
probability of less than 10^-3. A list of names is sent sorted, split by owner and byte plane by byte plane; what comes
back is a bitmap.

Texts that are whole copies are answered at once; one of each stays as a reference. A passage in
very many documents is one name for each bucket of documents. Buckets hold a bounded number of
bytes (or one document), owners a bounded number of names.

Edge cases: null is empty; texts shorter than ``LENGTH`` keep everything; overlapping
occurrences inside one document count; texts of one repeated byte have one anchor; repeated
rows are copies of each other; a null id is carried along; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.hashing import byte_names, content_seed, rolling
from textloom.session import join_groups, keep_ids, materialize

LENGTH = 400
#: The cover's modulus is ``ORDER ** 2 + ORDER + 1``; ``ORDER`` is a prime.
ORDER = 7
GRAM = 64
#: What a bucket of documents holds, what a task gathers before it sends, and what an owner gets.
BUCKET_BYTES = 2 << 20
CHUNK_ANCHORS = 400_000
OWNER_NAMES = 1 << 21
_U = np.uint64


@lru_cache(maxsize=8)
def difference_cover(order: int) -> tuple[int, np.ndarray]:
    """``(v, members)``: a perfect difference set of ``order + 1`` members modulo ``v``.

    The zeros of a linear recurrence of degree 3 and greatest period over the field of ``order``
    elements, taken modulo ``v``.
    """
    v, period = order * order + order + 1, order**3 - 1
    for a, b, c in product(range(order), range(order), range(1, order)):
        state, zeros = (0, 0, 1), []
        for n in range(period):
            if n < v and not state[0]:
                zeros.append(n)
            state = (state[1], state[2], (a * state[2] + b * state[1] + c * state[0]) % order)
            if state == (0, 0, 1):
                break
        if n == period - 1:
            return v, np.array(zeros)
    raise ValueError("the order is no prime")


def sampled_mask(n: int, order: int) -> np.ndarray:
    """Which of the places ``0 .. n - 1`` are sampled."""
    v, members = difference_cover(order)
    out = np.zeros(v, bool)
    out[members] = True
    return np.resize(out, n) if n > 0 else np.zeros(0, bool)


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _hashes(raw: bytes, length: int) -> np.ndarray:
    return rolling(np.frombuffer(raw, np.uint8).astype(np.uint64), length)


def sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """Least (or greatest) of every ``width`` neighbours, by prefixes and suffixes of blocks."""
    n = len(values)
    fill = np.iinfo(np.uint64).max if best is np.minimum else 0
    padded = np.full(-(-n // width) * width, fill, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).ravel()
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[: n - width + 1], ahead[width - 1 : n])


def anchor_flags(grams: np.ndarray, width: int) -> np.ndarray:
    """Which grams are least among some ``width`` neighbours."""
    if len(grams) < width:
        return np.zeros(len(grams), bool)
    least = sliding(grams, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    return sliding(np.concatenate([edge, least, edge]), width, np.maximum) == grams


# --- the exchange of names ------------------------------------------------------------------


def planes(values: np.ndarray) -> bytes:
    """Ascending names, byte plane by byte plane, so that the leading ones compress."""
    return values.astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view(">u8").ravel().astype(np.uint64)


def _split(values: np.ndarray, twice: np.ndarray, owner_bits: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Ascending distinct names by owner (their leading bits): ``(owner, names, bits of those that occur twice here)``."""
    owner = (values >> _U(64 - owner_bits)).astype(np.int64)
    edges = np.flatnonzero(np.diff(owner, prepend=-1, append=1 << owner_bits))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield int(owner[a]), planes(values[a:b]), np.packbits(twice[a:b]).tobytes()


def _answer(table: pa.Table) -> pa.Table:
    """One owner: which names occur twice, in one bucket or in two. Names are sorted and neighbours compared."""
    lists = [from_planes(b) for b in table["names"].to_pylist()]
    twice = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(x)).astype(bool) for b, x in zip(table["twice"].to_pylist(), lists, strict=True)]
    values = np.sort(np.concatenate(lists))
    shared = values[1:][values[1:] == values[:-1]]
    bits = [np.packbits(_among(x, shared) | t).tobytes() for x, t in zip(lists, twice, strict=True)]
    return pa.table({"bucket": table["bucket"], "owner": table["owner"], "n": pa.array([len(x) for x in lists], pa.int64()), "bits": pa.array(bits, pa.binary())})


def _among(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    if not len(ascending):
        return np.zeros(len(values), bool)
    return ascending[np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)] == values


def _distinct(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct names, ascending, and which of them occur twice."""
    values, counts = np.unique(np.concatenate(parts) if parts else np.empty(0, np.uint64), return_counts=True)
    return values, counts > 1


def _repeated(parts: list[np.ndarray], answers: pa.Table) -> np.ndarray:
    """The names of a bucket that its owners found twice, ascending."""
    values, _ = _distinct(parts)
    answers = answers.sort_by("owner")
    bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(answers["bits"].to_pylist(), answers["n"].to_pylist(), strict=True)]
    return values[np.concatenate(bits).astype(bool)] if bits else values[:0]


def _answers(sent: DataFrame) -> DataFrame:
    return sent.groupBy("owner").applyInArrow(_answer, "bucket long, owner int, n long, bits binary")


# --- step 0: regions ------------------------------------------------------------------------

_SCAN = pa.schema([("kind", pa.string()), ("bucket", pa.int64()), ("key", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("sha", pa.string()), ("sampled", pa.int64()), ("anchors", pa.binary()), ("owner", pa.int32()), ("names", pa.binary()), ("twice", pa.binary())])


def _scan(order: int, gram: int, owner_bits: int):
    """A row for each document, and the anchors' lists of each chunk of documents."""
    v, _ = difference_cover(order)
    width = 4 * v - 1 - gram + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts, held = TaskContext.get().partitionId() << 32, [], 0

        def send() -> pa.RecordBatch:
            rows = [{"kind": "sent", "bucket": bucket, "owner": o, "names": names, "twice": twice} for o, names, twice in _split(*_distinct(parts), owner_bits)]
            return pa.RecordBatch.from_pylist(rows, schema=_SCAN)

        for batch in batches:
            rows = []
            for key, i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                raw = _raw(text.as_py())
                grams = _hashes(raw, gram)
                found = np.sort(grams[anchor_flags(grams, width)])
                parts.append(found)
                held += len(found)
                rows.append({"kind": "doc", "bucket": bucket, "key": key, "id": i, "n": len(raw), "sha": hashlib.sha256(raw).hexdigest(), "sampled": int(sampled_mask(len(raw) - 3 * v + 1, order).sum()), "anchors": found.tobytes()})
                if held >= CHUNK_ANCHORS:
                    yield pa.RecordBatch.from_pylist(rows, schema=_SCAN)
                    yield send()
                    bucket, parts, held, rows = bucket + 1, [], 0, []
            yield pa.RecordBatch.from_pylist(rows, schema=_SCAN)
        if held:
            yield send()

    return run


def _keep_anchors(left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents of one chunk that hold a repeated anchor, with those anchors."""
    lists = [np.frombuffer(b, np.uint64) for b in left["anchors"].to_pylist()]
    shared = _repeated(lists, right)
    kept = [np.unique(x[_among(x, shared)]) for x in lists]
    some = pa.array([len(x) > 0 for x in kept], pa.bool_())
    return pa.table({"key": left["key"], "n": left["n"], "anchors": pa.array([x.tobytes() for x in kept], pa.binary())}).filter(some)


# --- steps 1 to 3 ---------------------------------------------------------------------------


def region_samples(raw: bytes, anchors: np.ndarray, order: int, gram: int) -> np.ndarray:
    """Sampled places whose triple lies in a string of ``4 v - 1`` bytes around one of ``anchors``."""
    v, _ = difference_cover(order)
    length = 4 * v - 1
    grams = _hashes(raw, gram)
    at = np.flatnonzero(anchor_flags(grams, length - gram + 1) & _among(grams, anchors))
    change = np.zeros(len(raw) + 1, np.int64)
    np.add.at(change, np.maximum(at - (length - gram), 0), 1)
    np.add.at(change, np.minimum(at + v, len(raw)), -1)
    places = np.cumsum(change)[: len(raw) - 3 * v + 1] > 0
    return np.flatnonzero(places & sampled_mask(len(places), order))


def candidates(n: int, samples: np.ndarray, length: int, order: int) -> np.ndarray:
    """Places of strings of ``length`` bytes with a repeated triple (``samples``) in each ``v`` places where one fits."""
    v, _ = difference_cover(order)
    if n < length:
        return np.empty(0, np.int64)
    seen = np.zeros(n + 1, np.int64)
    seen[samples + 1] = 1
    seen = np.cumsum(seen)
    ok = np.ones(n - length + 1, bool)
    for start in range(0, length - 4 * v + 2, v):
        ok &= seen[start + v : start + v + len(ok)] > seen[start : start + len(ok)]
    return np.flatnonzero(ok)


class _Bucket:
    """The documents of one bucket; each text's hashes are made when asked for."""

    def __init__(self, table: pa.Table) -> None:
        self.keys, self.raws = table["key"].to_pylist(), [_raw(t.as_py()) for t in table["text"]]

    def names(self, places: list[np.ndarray], length: int) -> list[np.ndarray]:
        return [_hashes(raw, length)[at] if len(at) else np.empty(0, np.uint64) for raw, at in zip(self.raws, places, strict=True)]


_SENT = pa.schema([("bucket", pa.int64()), ("owner", pa.int32()), ("names", pa.binary()), ("twice", pa.binary())])
_SENT_TYPE = "bucket long, owner int, names binary, twice binary"


def _sent(table: pa.Table, names: list[np.ndarray], owner_bits: int) -> pa.Table:
    bucket = table["bucket"][0].as_py()
    return pa.Table.from_pylist([{"bucket": bucket, "owner": o, "names": x, "twice": t} for o, x, t in _split(*_distinct(names), owner_bits)], schema=_SENT)


def _sample(order: int, gram: int, owner_bits: int):
    """Step 1: a bucket's names of sampled triples."""
    v, _ = difference_cover(order)

    def run(table: pa.Table) -> pa.Table:
        docs = _Bucket(table)
        places = [region_samples(raw, np.frombuffer(a, np.uint64), order, gram) for raw, a in zip(docs.raws, table["anchors"].to_pylist(), strict=True)]
        return _sent(table, docs.names(places, 3 * v), owner_bits)

    return run


def _recurse(length: int, order: int, gram: int):
    """Step 2: each document's repeated triples; its text goes on only if they leave strings."""
    v, _ = difference_cover(order)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        docs = _Bucket(left)
        places = [region_samples(raw, np.frombuffer(a, np.uint64), order, gram) for raw, a in zip(docs.raws, left["anchors"].to_pylist(), strict=True)]
        names = docs.names(places, 3 * v)
        shared = _repeated(names, right)
        samples = [at[_among(x, shared)] for at, x in zip(places, names, strict=True)]
        some = pa.array([len(candidates(len(raw), at, length, order)) > 0 for raw, at in zip(docs.raws, samples, strict=True)], pa.bool_())
        text = pc.if_else(some, left["text"].combine_chunks(), pa.scalar(None, pa.string()))
        return pa.table({"bucket": left["bucket"], "key": left["key"], "text": text, "repeats": pa.array([len(at) for at in samples], pa.int64()), "samples": pa.array([at.astype(np.uint32).tobytes() for at in samples], pa.binary())})

    return run


# --- step 3: names with checks ----------------------------------------------------------------


def pair_order(names: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal pairs together, names ascending, and where in it a new pair begins."""
    order = np.argsort(names, kind="stable")
    n, c = names[order], checks[order]
    if ((n[1:] == n[:-1]) & (c[1:] != c[:-1])).any():
        order = np.lexsort((checks, names))
        n, c = names[order], checks[order]
    new = np.ones(len(n), bool)
    new[1:] = (n[1:] != n[:-1]) | (c[1:] != c[:-1])
    return order, new


def _pairs_left(docs: _Bucket, table: pa.Table, length: int, order: int, seed: int, mask: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Places of the strings that are left in each document, and the names and checks of all of them."""
    starts = [candidates(len(raw), np.frombuffer(s, np.uint32).astype(np.int64), length, order) for raw, s in zip(docs.raws, table["samples"].to_pylist(), strict=True)]
    none = [np.empty(0, np.uint64)]
    names = [byte_names(raw, length, seed)[at] & _U(mask) for raw, at in zip(docs.raws, starts, strict=True) if len(at)]
    checks = [(byte_names(raw, length, seed + 1)[at] >> _U(32)).astype(np.uint32) for raw, at in zip(docs.raws, starts, strict=True) if len(at)]
    return starts, np.concatenate(none + names), np.concatenate([np.empty(0, np.uint32), *checks])


def _merge(length: int, order: int, owner_bits: int, seed: int, mask: int):
    """Step 3: a bucket's distinct names of the strings that are left, by owner."""

    def run(table: pa.Table) -> pa.Table:
        _, names, checks = _pairs_left(_Bucket(table), table, length, order, seed, mask)
        by, new = pair_order(names, checks)
        first = np.flatnonzero(new)
        twice = np.diff(np.append(first, len(by))) > 1
        names, checks, bucket, rows = names[by[first]], checks[by[first]], table["bucket"][0].as_py(), []
        at = 0
        for owner, blob, bits in _split(names, twice, owner_bits):
            n = len(blob) // 8
            rows.append({"bucket": bucket, "owner": owner, "names": blob, "checks": checks[at : at + n].tobytes(), "twice": bits})
            at += n
        return pa.Table.from_pylist(rows, schema=_PAIRS)

    return run


_PAIRS = pa.schema([("bucket", pa.int64()), ("owner", pa.int32()), ("names", pa.binary()), ("checks", pa.binary()), ("twice", pa.binary())])
_PAIRS_TYPE = "bucket long, owner int, names binary, checks binary, twice binary"


def _answer_pairs(table: pa.Table) -> pa.Table:
    """One owner: which pairs occur twice, in one bucket or in two."""
    names = [from_planes(b) for b in table["names"].to_pylist()]
    sizes = [len(x) for x in names]
    checks = np.concatenate([np.frombuffer(b, np.uint32) for b in table["checks"].to_pylist()])
    twice = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(table["twice"].to_pylist(), sizes, strict=True)]).astype(bool)
    by, new = pair_order(np.concatenate(names), checks)
    first = np.flatnonzero(new)
    shared = (np.diff(np.append(first, len(by))) > 1) | np.logical_or.reduceat(twice[by], first)
    flags = np.empty(len(by), bool)
    flags[by] = shared[np.cumsum(new) - 1]
    bits = [np.packbits(x).tobytes() for x in np.split(flags, np.cumsum(sizes)[:-1])]
    return pa.table({"bucket": table["bucket"], "owner": table["owner"], "n": pa.array(sizes, pa.int64()), "bits": pa.array(bits, pa.binary())})


def cut_runs(raw: bytes, starts: np.ndarray, length: int) -> tuple[bytes, int, int]:
    """What is left without the strings at ``starts``, bytes removed, and maximal removed runs."""
    change = np.zeros(len(raw) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + length, -1)
    gone = np.cumsum(change)[:-1] > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
    return np.frombuffer(raw, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def _mark(length: int, order: int, seed: int, mask: int):
    """Step 3: what is cut of each document."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        docs = _Bucket(left)
        starts, names, checks = _pairs_left(docs, left, length, order, seed, mask)
        by, new = pair_order(names, checks)
        right = right.sort_by("owner")
        bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(right["bits"].to_pylist(), right["n"].to_pylist(), strict=True)]
        flags = np.empty(len(by), bool)
        flags[by] = np.concatenate([np.empty(0, np.uint8), *bits]).astype(bool)[np.cumsum(new) - 1] if len(by) else []
        shared = np.split(flags, np.cumsum([len(at) for at in starts])[:-1])
        out: dict[str, list] = {"cut_key": [], "gone": [], "spans": [], "kept_sha": []}
        for key, raw, at, again in zip(docs.keys, docs.raws, starts, shared, strict=True):
            kept, gone, spans = cut_runs(raw, at[again], length)
            for name, value in zip(out, (key, gone, spans, hashlib.sha256(kept).hexdigest()), strict=True):
                out[name].append(value)
        return pa.table({"cut_key": pa.array(out["cut_key"], pa.int64()), "gone": pa.array(out["gone"], pa.int64()), "spans": pa.array(out["spans"], pa.int64()), "kept_sha": pa.array(out["kept_sha"], pa.string())})

    return run


def _bits(names: int) -> int:
    return max(6, (names // OWNER_NAMES).bit_length())


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, order: int = ORDER, gram: int = GRAM, name_bits: int = 64) -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept_sha256, n_repeats`` for every row.

    ``n_repeats`` counts the sampled suffixes found whose first ``3 v`` bytes occur elsewhere too: at
    least one if a string of ``4 v - 1`` bytes does, none if no string of ``3 v`` does. ``length`` must
    be ``4 v - 1`` at least. With fewer ``name_bits`` more is left to the checks.
    """
    v, members = difference_cover(order)
    if length < 4 * v - 1 or gram > 4 * v - 1:
        raise ValueError("the strings are too short for this cover")
    text = F.col(text_col).cast("string")
    source = docs.select(F.xxhash64(F.col(id_col), text).alias("key"), F.col(id_col).cast("long").alias("id"), text.alias("text"))
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text)).alias("bytes")).first()
    total = size.bytes or 0
    schema = "kind string, bucket long, key long, id long, n long, sha string, sampled long, anchors binary, owner int, names binary, twice binary"
    scan = materialize(source.mapInArrow(_scan(order, gram, _bits(total * 2 // (4 * v - gram))), schema), "repeats-scan")
    doc = scan.where("kind = 'doc'").select("bucket", "key", "id", "n", "sha", "sampled", "anchors")

    # Whole copies: all go; the one of least key stays a reference for other texts.
    same = doc.where(f"n >= {4 * v - 1}").groupBy("sha").agg(F.count(F.lit(1)).alias("copies"), F.min("key").alias("reference")).where("copies > 1")
    same = materialize(same, "repeats-same")
    named = materialize(join_groups(doc.select("key", "id", "n", "sha", "sampled"), same, "sha", "copies", size.n), "repeats-named")
    spare = named.where("copies IS NOT NULL AND key <> reference").select("key").distinct()

    sent = scan.where("kind = 'sent'").select("bucket", "owner", "names", "twice")
    near = doc.where("length(anchors) > 0").select("bucket", "key", "n", "anchors").groupBy("bucket").cogroup(_answers(sent).groupBy("bucket")).applyInArrow(_keep_anchors, "key long, n long, anchors binary")
    near = materialize(near.dropDuplicates(["key"]).join(spare, "key", "left_anti"), "repeats-anchors")
    held = near.agg(F.sum("n")).first()[0] or 0
    buckets = 1 + held // BUCKET_BYTES

    texts = keep_ids(source, near, "key").select("key", "text")
    if not named.where("copies IS NOT NULL").groupBy("key").count().where("count > 1").isEmpty():  # equal rows under one id
        texts = texts.dropDuplicates(["key"])
    texts = texts.join(near.select(F.col("key").alias("near_key"), "anchors").hint("shuffle_hash"), F.col("key") == F.col("near_key"))
    texts = materialize(texts.select("key", "text", "anchors", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(buckets)).alias("bucket")), "repeats-near")

    triples = _answers(texts.groupBy("bucket").applyInArrow(_sample(order, gram, _bits(held * len(members) // v)), _SENT_TYPE))
    left = texts.groupBy("bucket").cogroup(triples.groupBy("bucket")).applyInArrow(_recurse(length, order, gram), "bucket long, key long, text string, repeats long, samples binary")
    left = materialize(left, "repeats-left")
    rest = left.where("text IS NOT NULL").select("bucket", "key", "text", "samples")
    seed, mask = content_seed(doc, "sha", "id"), (1 << 64) - (1 << (64 - name_bits))
    pairs = rest.groupBy("bucket").applyInArrow(_merge(length, order, _bits(held), seed, mask), _PAIRS_TYPE)
    answers = pairs.groupBy("owner").applyInArrow(_answer_pairs, "bucket long, owner int, n long, bits binary")
    cut = rest.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(_mark(length, order, seed, mask), "cut_key long, gone long, spans long, kept_sha string")
    found = left.select("key", "repeats").join(cut, F.col("key") == F.col("cut_key"), "left").drop("cut_key")
    out = named.join(found, "key", "left")
    copied, whole, nothing = F.col("copies").isNotNull(), F.col("copies").isNotNull() & (F.col("n") >= length), hashlib.sha256(b"").hexdigest()
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_bytes"),
        F.when(whole, F.col("n")).otherwise(F.coalesce("gone", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(nothing)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
        F.when(copied, F.col("sampled")).otherwise(F.coalesce("repeats", F.lit(0))).cast("long").alias("n_repeats"),
    )
