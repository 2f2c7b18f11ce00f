"""Exact dedup by Golomb-coded fingerprint exchange.

1. Texts are normalised (white space deleted) and hashed in the JVM; a partition sees one narrow
   signature row per document. The distinct fingerprints of each ``CHUNK_ROWS`` rows, split by owner
   (top bits) and sorted, are Golomb-Rice coded: a few bytes per document leave the partition.
2. An owner decodes what all partitions sent it, finds values that more than one partition
   holds and answers each partition with a bitmap over that partition's sorted list.
3. Only documents whose bit is set (or whose fingerprint repeats inside the partition) are
   suspects. Their texts are shuffled and grouped by the normalised bytes themselves, so a
   fingerprint collision never merges different texts.

A fingerprint has ``20 + log2(rows)`` bits, so about one clean document in a million is a false
suspect at every size; verification clears it. Hot texts are aggregated inside the map tasks
before the shuffle (one row per task and text), owners get one entry per partition and value.

Edge cases: null text counts as empty; empty texts are equal to each other; ties keep the
smallest id; a null id counts as larger than any other; repeated rows are members of their
group like any other rows (the result has one row for each, all with the same answer); an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import join_groups, keep_ids, materialize

SPACE_CLASS = r"[\x20\x09-\x0D]+"
FALSE_SUSPECT_BITS = 20
ENTRIES_PER_OWNER = 1 << 20
#: Rows whose fingerprints make one list: what a task holds at a time.
CHUNK_ROWS = 200_000

_SIG = "kind string, pid long, id long, n_chars long, sha binary, owner int, rank int, local_dup boolean, n int, rice int, blob binary"


def rice_encode(values: np.ndarray, rice: int) -> bytes:
    """Golomb-Rice code of ascending uint64 values: gap quotient in unary, remainder in ``rice`` bits."""
    if not len(values):
        return b""
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    quotient = (gaps >> np.uint64(rice)).astype(np.int64)
    ends = np.cumsum(quotient + 1 + rice)
    bits = np.ones(int(ends[-1]), np.uint8)
    stop = ends - rice - 1
    bits[stop] = 0
    for j in range(rice):
        bits[stop + 1 + j] = (gaps >> np.uint64(rice - 1 - j)) & np.uint64(1)
    return np.packbits(bits).tobytes()


def rice_decode(blob: bytes, n: int, rice: int) -> np.ndarray:
    """Inverse of :func:`rice_encode`."""
    bits = np.unpackbits(np.frombuffer(blob, np.uint8))
    zeros = np.flatnonzero(bits == 0).tolist()
    stops, quotients, at, k = np.empty(n, np.int64), np.empty(n, np.uint64), 0, 0
    for i in range(n):
        k = bisect_left(zeros, at, k)
        stop = zeros[k]
        stops[i], quotients[i] = stop, stop - at
        at = stop + 1 + rice
    gaps = quotients << np.uint64(rice)
    for j in range(rice):
        gaps |= bits[stops + 1 + j].astype(np.uint64) << np.uint64(rice - 1 - j)
    return np.cumsum(gaps, dtype=np.uint64)


def best_rice(n: int, span_bits: int) -> int:
    """Remainder bits for ``n`` values spread evenly over ``2**span_bits``."""
    return max(0, span_bits - max(n, 1).bit_length())


def _signer(fp_bits: int, owner_bits: int):
    """Rows ``(id, n_chars, sha, fingerprint)`` to signature rows, and coded lists of each ``CHUNK_ROWS`` of them."""
    span = fp_bits - owner_bits
    schema = pa.schema([("kind", pa.string()), ("pid", pa.int64()), ("id", pa.int64()), ("n_chars", pa.int64()), ("sha", pa.binary()), ("owner", pa.int32()), ("rank", pa.int32()), ("local_dup", pa.bool_()), ("n", pa.int32()), ("rice", pa.int32()), ("blob", pa.binary())])

    def encode(held: list[pa.RecordBatch], pid: int) -> Iterator[pa.RecordBatch]:
        heads = np.concatenate([b.column(3).to_numpy() for b in held]).view(np.uint64) >> np.uint64(64 - fp_bits)
        distinct, where, copies = np.unique(heads, return_inverse=True, return_counts=True)
        owner = (distinct >> np.uint64(span)).astype(np.int64)
        rank = np.arange(len(distinct)) - np.searchsorted(owner, owner)
        at = 0
        for b in held:
            k, w = b.num_rows, where[at : at + b.num_rows]
            at += k
            yield pa.RecordBatch.from_arrays([pa.array(["doc"] * k), pa.array(np.full(k, pid)), b.column(0), b.column(1), b.column(2), pa.array(owner[w].astype(np.int32)), pa.array(rank[w].astype(np.int32)), pa.array(copies[w] > 1), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], schema=schema)
        edges = np.searchsorted(owner, np.arange((1 << owner_bits) + 1))
        rows = []
        for o in np.flatnonzero(edges[1:] > edges[:-1]).tolist():
            mine = distinct[edges[o] : edges[o + 1]] & np.uint64((1 << span) - 1)
            rice = best_rice(len(mine), span)
            rows.append({"kind": "blob", "pid": pid, "owner": o, "n": len(mine), "rice": rice, "blob": rice_encode(mine, rice)})
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, held, rows = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= CHUNK_ROWS:
                yield from encode(held, pid)
                pid, held, rows = pid + 1, [], 0
        if held:
            yield from encode(held, pid)

    return sign


def _answer(table: pa.Table) -> pa.Table:
    """One owner: which of the values sent by each partition does another partition hold too?"""
    lists = [rice_decode(b, n, r) for b, n, r in zip(table["blob"].to_pylist(), table["n"].to_pylist(), table["rice"].to_pylist(), strict=True)]
    values, counts = np.unique(np.concatenate(lists), return_counts=True)
    shared = values[counts > 1]
    words = []
    for mine in lists:
        bits = np.isin(mine, shared)
        words.append(np.packbits(np.pad(bits, (0, -len(bits) % 64)), bitorder="little").view(np.int64).tolist())
    return pa.table({"pid": table["pid"], "owner": table["owner"], "bits": pa.array(words, pa.list_(pa.int64()))})


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int | None = None) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256, n_chars``."""
    blank = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    norm = F.regexp_replace(blank, SPACE_CLASS, "")
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.length(blank).cast("long").alias("n_chars"), norm.alias("norm"))
    rows = docs.count() if rows is None else rows
    owner_bits = max(4, (rows // ENTRIES_PER_OWNER).bit_length())
    fp_bits = min(62, FALSE_SUSPECT_BITS + max(rows, 1).bit_length() + 1)
    signed = source.select("id", "n_chars", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"), F.xxhash64("norm").alias("fingerprint"))
    sent = materialize(signed.mapInArrow(_signer(fp_bits, owner_bits), _SIG), "exact-sig")
    answers = sent.where("kind = 'blob'").select("pid", "owner", "n", "rice", "blob").groupBy("owner").applyInArrow(_answer, "pid long, owner int, bits array<long>")
    doc = sent.where("kind = 'doc'").select("pid", "owner", "rank", "id", "n_chars", "sha", "local_dup")
    bit = F.expr("getbit(element_at(bits, int(rank div 64) + 1), int(rank % 64))") == 1
    flagged = materialize(doc.join(answers, ["pid", "owner"]).withColumn("suspect", F.col("local_dup") | bit).select("id", "n_chars", "sha", "suspect"), "exact-flag")
    suspects = flagged.where("suspect").select("id").distinct()

    # Grouping by the bytes is the verification. Long buffers keep this a hash aggregate.
    texts = keep_ids(source, suspects, "id")
    equal = texts.groupBy("norm", "n_chars").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    equal = equal.select(F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"), "n_chars", "least", "copies")
    groups = equal.groupBy("sha").agg(F.max_by("least", "n_chars").alias("keep"), F.sum("copies").alias("size"))
    groups = materialize(groups.where("size > 1"), "exact-groups")
    out = join_groups(flagged.where("suspect"), groups, "sha", "size", rows)
    out = out.unionByName(flagged.where("NOT suspect"), allowMissingColumns=True)
    keep_id = F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("keep"))
    return out.select(
        F.col("id").alias(id_col),
        keep_id.alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        keep_id.eqNullSafe(F.col("id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "n_chars",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns; rows repeated under one id stay together."""
    # The verdict hangs on the id and the text without white space.
    gone = exact_dedup(docs, id_col, text_col).where("NOT kept").select(F.col(id_col).alias("_gone"), F.col("text_sha256").alias("row")).distinct()
    sha = F.sha2(F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), SPACE_CLASS, "").cast("binary"), 256)
    return keep_ids(docs, materialize(gone, "exact-gone"), id_col, anti=True, ids_col="_gone", row=sha)
