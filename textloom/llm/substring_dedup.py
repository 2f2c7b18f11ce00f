"""Substring dedup with fixed-block anchors.

A window of ``2 * block`` words that repeats contains, wherever it stands, one whole block of its
own document's grid. So the grid blocks are the index, and every rolling window of ``block``
words of every document is a probe:

1. Each input partition hashes all rolling windows and grid blocks. Probes leave as sorted,
   distinct 32-bit remainders per owner (the owner is the hash's other part, so about one chance
   hit per ``2 ** SPARE_BITS`` blocks at every size), with a bit for those that several
   documents of the partition hold; blocks leave as they are.
2. An owner answers with the blocks that another document's windows hit.
3. Around hits only, windows of the full length get names; a window's least document decides,
   and the hits become maximal repeats as neighbouring windows merge.

The hashes of steps 1 and 2 only choose where to look. A name in step 3 has 128 bits: two lanes of word hashes and
of multipliers, all seeded by a digest of the whole table, so that no text can be made to collide with another,
and among 10^13 windows a chance collision has a probability of about 10^-13.

Documents with the same word sequence collapse first: all but the first are removed whole. A
passage that very many documents share is one entry per partition in step 1 and one partial
minimum per task in step 3.

Edge cases: null text has no words; documents shorter than a window keep everything; a repeat
inside one document only stays; a null id counts as larger than any other; rows that repeat
under one id are one document to each other (nothing is removed between them); an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.hashing import among_pairs, content_seed, doubled, lists_of, rolling, word_hashes, words_of
from textloom.session import join_groups, keep_ids, materialize

LENGTH = 50
SPARE_BITS = 12
FLUSH = 500_000
_U = np.uint64
LAST = 2**63 - 1


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _scan(block: int, owner_bits: int):
    """Per document: length, digest, name of the sequence and its grid blocks; per partition: probes by owner."""
    schema = pa.schema([("kind", pa.string()), ("key", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("sha", pa.string()), ("blocks", pa.list_(pa.int64())), ("owner", pa.int32()), ("probes", pa.binary()), ("several", pa.binary()), ("index", pa.binary())])
    shift = _U(64 - owner_bits)

    def split(parts: list[np.ndarray], grids: list[np.ndarray]) -> pa.RecordBatch:
        """``parts`` has the distinct windows of one document each."""
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        grid = np.unique(np.concatenate(grids))
        edges = np.arange(1 << owner_bits, dtype=np.uint64) << shift
        a, b = np.append(np.searchsorted(values, edges), len(values)), np.append(np.searchsorted(grid, edges), len(grid))
        low = lambda x: ((x << _U(owner_bits)) >> _U(32)).astype(np.uint32)
        values32, grid32, several = low(values), low(grid), counts > 1
        rows = [{"kind": "sent", "owner": o, "probes": values32[a[o] : a[o + 1]].tobytes(), "several": np.packbits(several[a[o] : a[o + 1]]).tobytes(), "index": grid32[b[o] : b[o + 1]].tobytes()} for o in range(1 << owner_bits) if a[o] < a[o + 1]]
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, grids, held = [], [], 0
        for batch in batches:
            rows = []
            for key, i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                words = words_of(text.as_py())
                h = word_hashes(words)
                r = rolling(h, block)
                grid = np.unique(r[::block])
                rows.append({"kind": "doc", "key": key, "id": i, "n": len(words), "sha": _digest(words), "blocks": cut(grid, owner_bits) if len(words) >= 2 * block else []})
                if len(words) >= 2 * block:
                    parts.append(np.unique(r))
                    grids.append(grid)
                    held += len(r)
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
            if held > FLUSH:
                yield split(parts, grids)
                parts, grids, held = [], [], 0
        if held:
            yield split(parts, grids)

    return run


def cut(values: np.ndarray, owner_bits: int) -> list[int]:
    """Owner and remainder of hashes in one number."""
    return (values >> _U(32 - owner_bits)).view(np.int64).tolist()


def _answer(owner_bits: int):
    def run(table: pa.Table) -> pa.Table:
        """Blocks of one owner that the windows of at least two documents hold."""
        probes = [np.frombuffer(b, np.uint32) for b in table["probes"].to_pylist()]
        several = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(p)).astype(bool) for b, p in zip(table["several"].to_pylist(), probes, strict=True)]
        index = np.unique(np.concatenate([np.frombuffer(b, np.uint32) for b in table["index"].to_pylist()]))
        seen = np.zeros(len(index), np.int64)
        for p, s in zip(probes, several, strict=True):
            seen += np.isin(index, p)
            seen += np.isin(index, p[s])
        hit = index[seen > 1].astype(np.int64) | (int(table["owner"][0].as_py()) << 32)
        return pa.table({"block": pa.array(hit, pa.int64())})

    return run


def window_names(words: list[bytes], length: int, seed: int) -> np.ndarray:
    """128-bit names of every window, as rows of two lanes."""
    return np.stack([doubled(word_hashes(words, (seed + lane) % 2**64), length, seed + lane) for lane in (0, 1)], axis=1)


def _near_hits(length: int, block: int, owner_bits: int, seed: int):
    """Names of the windows that hold a hit grid block, as ``(window, id)``; each once a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text, hits in zip(batch.column(0).to_pylist(), batch.column(1), lists_of(batch.column(2)), strict=True):
                words = words_of(text.as_py())
                grid = rolling(word_hashes(words), block)[::block] >> _U(32 - owner_bits)
                at = np.flatnonzero(np.isin(grid.view(np.int64), hits)) * block
                if not len(at):
                    continue
                starts = np.unique((at[:, None] - np.arange(length - block + 1)[None, :]).ravel())
                starts = starts[(starts >= 0) & (starts <= len(words) - length)]
                window = np.unique(np.ascontiguousarray(window_names(words, length, seed)[starts]).view("V16").ravel())
                for k in range(0, len(window), 50_000):
                    w = window[k : k + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(16), len(w), [None, pa.py_buffer(w.tobytes())]).cast(pa.binary()), pa.array(np.full(len(w), i if i is not None else LAST, np.int64))], names=["window", "id"])

    return run


def _remove(length: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, shas = [], []
            for text, windows in zip(batch.column(1), batch.column(2), strict=True):
                words = words_of(text.as_py())
                keep = ~covered(window_names(words, length, seed), b"".join(windows.as_py()), length, len(words))
                kept = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
                removed.append(len(words) - len(kept))
                shas.append(_digest(kept))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, pa.int64()), pa.array(shas, pa.string())], names=["cut_key", "gone", "kept_sha"])

    return run


def covered(names: np.ndarray, windows: bytes, length: int, n: int) -> np.ndarray:
    """Which of ``n`` units lie in a window whose name (128 bits) is among ``windows``; overlapping ones make one run."""
    starts = np.flatnonzero(among_pairs(names, np.frombuffer(windows, np.uint64).reshape(-1, 2)))
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + length, -1)
    return np.cumsum(change)[:-1] > 0


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``id_col, n_words, n_removed, kept_sha256`` for every row."""
    block = length // 2
    text = F.col(text_col).cast("string")
    source = docs.select(F.xxhash64(F.col(id_col), text).alias("key"), F.col(id_col).cast("long").alias("id"), text.alias("text"))
    # A block's chance to be hit by accident is the number of probes over 2 ** (32 + owner bits).
    rows = docs.count()
    owner_bits = min(20, max(6, (rows * 512).bit_length() + SPARE_BITS - 32))
    schema = "kind string, key long, id long, n long, sha string, blocks array<long>, owner int, probes binary, several binary, index binary"
    scan = materialize(source.mapInArrow(_scan(block, owner_bits), schema), "substring-scan")
    doc = scan.where("kind = 'doc'").select("key", "id", "n", "sha", "blocks")
    shared = scan.where("kind = 'sent'").select("owner", "probes", "several", "index").groupBy("owner").applyInArrow(_answer(owner_bits), "block long")

    # The first document of each word sequence; the others go whole. The digest decides equality.
    firsts = materialize(doc.groupBy("sha").agg(F.min(F.coalesce("id", F.lit(LAST))).alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1"), "substring-firsts")
    named = join_groups(doc.select("key", "id", "n", "sha"), firsts, "sha", "copies", rows).withColumn("whole", F.expr(f"n >= {length} AND first IS NOT NULL AND coalesce(id, {LAST}) > first"))
    named = materialize(named.select("key", "id", "n", "sha", "whole"), "substring-named")
    hits = doc.select("key", F.explode("blocks").alias("block")).join(shared, "block").groupBy("key").agg(F.collect_set("block").alias("hits"))
    alone = named.where("NOT whole").select("key").distinct()
    hits = materialize(hits.join(alone, "key", "left_semi"), "substring-hits")

    seed = content_seed(doc, "sha", "id")
    near = keep_ids(source, hits, "key").join(hits.withColumnRenamed("key", "hit_key").hint("shuffle_hash"), F.col("key") == F.col("hit_key"))
    windows = materialize(near.select("id", "text", "hits").mapInArrow(_near_hits(length, block, owner_bits, seed), "window binary, id long"), "substring-windows")
    least = windows.groupBy("window").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("times")).where("first <> last").select("window", "first", "times")
    least = materialize(least, "substring-least")
    later = join_groups(windows, least, "window", "times", windows.count(), "inner").where("id > first").groupBy("id").agg(F.collect_set("window").alias("windows"))
    later = later.join(named.select("key", F.coalesce("id", F.lit(LAST)).alias("id")).distinct(), "id").select("key", "windows")
    later = materialize(later, "substring-later")
    again = keep_ids(source, later, "key").join(later.withColumnRenamed("key", "late_key").hint("shuffle_hash"), F.col("key") == F.col("late_key"))
    cut_rows = again.select("key", "text", "windows").mapInArrow(_remove(length, seed), "cut_key long, gone long, kept_sha string").dropDuplicates(["cut_key"])
    out = named.join(cut_rows, F.col("key") == F.col("cut_key"), "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_words"),
        F.when(F.col("whole"), F.col("n")).otherwise(F.coalesce("gone", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("whole"), F.lit(nothing)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
    )
