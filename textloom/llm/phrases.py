"""Phrase collocations: contiguous phrases whose words meet more often than their parts suggest.

1. Words are counted per language, inside the tasks first. Those with at least ``least`` occurrences form the
   dictionary; a phrase that frequent has no other words.
2. Texts are written once as ids of frequent words. Pieces end at punctuation and at every other word.
3. Each place of a piece gives one fixed-width binary key: the ids of the up to ``longest`` words from there on,
   filled up with zeros. As an id belongs to one language, so does a key. A task sorts its keys digit by digit
   (16 bits at a time, least significant first: a radix sort), counts runs, and sends sorted runs to ranges.
   Bounds of the ranges are quantiles of a bounded sample of keys; they decide where a key is counted, not what.
4. A range sorts what it got in the same way. Phrases of every length are runs of equal prefixes in one sorted order,
   so one pass gives all counts. Only a range's first and last run of a length can go on in another range; those
   are sent whatever their count, and added up.
5. Frequent phrases, a small table, are joined to the counts of their parts, scored by their lowest cut in decimals, and
   freed of those inside a longer phrase that occurs (almost) as often: any such longer phrase has one among them that
   is longer by one word.

A word, pair or passage that a third of all places hold is one row for each task and flush, and a prefix that
very many keys share may be cut anywhere. A dictionary beyond ``DICTIONARY`` words or ``DICTIONARY_BYTES`` isn't broadcast: tokens
are joined to it instead (``_encode_joined``), with the same result.

Edge cases: null texts are empty; a null language is ``und``, and the same as a language of that name; words shared
by languages are counted in each; ties of scores and counts are ordered by the phrase's bytes; repeated rows count
again; an empty table, or one without frequent phrases, gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import materialize

LONGEST, LEAST, TOP, PERCENT = 5, 100, 2000, 100
#: Words that a broadcast dictionary may have, and their bytes.
DICTIONARY, DICTIONARY_BYTES = 1 << 20, 32 << 20
#: Distinct words that a task counts, tokens of a written row, keys that a task sorts, keys of a range; all about.
HELD_WORDS, ROW_TOKENS, FLUSH_KEYS, RANGE_KEYS = 400_000, 1 << 16, 1 << 20, 1 << 20
#: Keys that the ranges' bounds are taken from, and the ranges at most (some 60 keys for each).
SAMPLE_KEYS, RANGES = 1 << 21, 1 << 15

#: Fixed values of the definition: what ends a piece. The byte 0x2E stands for all of them.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_CLEAN = bytes.maketrans(_ENDS + b"\t", b"." * len(_ENDS) + b" ")


def tokens(raw: bytes) -> list[bytes]:
    """Words of a text, and ``b"."`` where a piece ends. (Only A-Z have another case among bytes.)"""
    return raw.lower().translate(_CLEAN).replace(b".", b" . ").split()


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[bytes, bytes]]:
    for lang, text in zip(batch.column(0).cast(pa.binary()), batch.column(1).cast(pa.binary()), strict=True):
        yield b"und" if lang.as_py() is None else lang.as_py(), text.as_py() or b""


# --- words and dictionary ---------------------------------------------------------------------

_WORDS = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words, and of all words as the empty one."""
    held: dict[bytes, Counter] = defaultdict(Counter)

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            del counts[b"."]
            counts[b""] = counts.total()
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.binary()).cast(pa.string()), pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], schema=_WORDS)
        held.clear()

    for batch in batches:
        for lang, text in _texts(batch):
            held[lang].update(tokens(text))
            if len(held[lang]) > HELD_WORDS or len(held) > 1000:
                yield from flush()
    yield from flush()


class Dictionary:
    """Frequent words with ids: ``table (lang, word, n, id)``; ``words`` if few enough to broadcast; 16-bit digits of an id."""

    def __init__(self, frequent: DataFrame, most: int = DICTIONARY) -> None:
        count, size = frequent.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("word")), F.lit(0))).first()
        self.words = None
        if count <= most and size <= DICTIONARY_BYTES:
            rows = frequent.select(F.col("lang").cast("binary"), F.col("word").cast("binary")).toArrow().sort_by([("lang", "ascending"), ("word", "ascending")]).to_pydict()
            self.words: dict[bytes, dict[bytes, int]] | None = defaultdict(dict)
            for k, (lang, word) in enumerate(zip(rows["lang"], rows["word"], strict=True), 1):
                self.words[lang][word] = k
            self.digits = 1 if count < 1 << 16 else 2
            ids = pa.table({"lang": pa.array(rows["lang"], pa.binary()).cast(pa.string()), "word": pa.array(rows["word"], pa.binary()).cast(pa.string()), "id": pa.array(range(1, count + 1), pa.int64())})
            self.table = materialize(frequent.join(frequent.sparkSession.createDataFrame(ids), ["lang", "word"]), "phrase-words") if count else frequent.withColumn("id", F.lit(0).cast("long"))
        else:
            self.digits = 4
            self.table = materialize(frequent.withColumn("id", F.monotonically_increasing_id() + 1), "phrase-words")

    def key(self, ids: Column) -> Column:
        """An id as the bytes of its digits."""
        return F.unhex(F.lpad(F.hex(ids), 4 * self.digits, "0"))


# --- encoding ---------------------------------------------------------------------------------


def _kept(ids: np.ndarray) -> np.ndarray:
    """Without what can't be in a phrase: words alone between breaks, and all but one of a run of breaks."""
    word = ids != 0
    padded = np.concatenate([[False], word, [False]])
    out = ids[(word & (padded[:-2] | padded[2:])) | (~word & padded[:-2])]
    word = out != 0
    return out[word | np.concatenate([[False], word[:-1]])]


def _rows_of_ids(found: Iterator[np.ndarray], kind: type) -> Iterator[pa.RecordBatch]:
    """Texts' ids, a break after each text, as rows of about ``ROW_TOKENS``."""
    parts, held = [], 0
    for ids in found:
        parts += [ids.astype(kind), np.zeros(1, kind)]
        held += len(ids) + 1
        if held >= ROW_TOKENS:
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(parts).tobytes()], pa.binary())], names=["ids"])
            parts, held = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(parts).tobytes()], pa.binary())], names=["ids"])


def _kind(digits: int) -> type:
    return {1: np.uint16, 2: np.uint32, 4: np.uint64}[digits]


def _encode(texts: DataFrame, dictionary: Dictionary) -> DataFrame:
    words, kind = texts.sparkSession.sparkContext.broadcast(dictionary.words), _kind(dictionary.digits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none: dict[bytes, int] = {}

        def found() -> Iterator[np.ndarray]:
            for batch in batches:
                for lang, text in _texts(batch):
                    own = tokens(text)
                    yield _kept(np.fromiter(map(words.value.get(lang, none).get, own, repeat(0)), kind, len(own)))

        yield from _rows_of_ids(found(), kind)

    return texts.mapInArrow(run, "ids binary")


def _encode_joined(texts: DataFrame, dictionary: Dictionary) -> DataFrame:
    """The same for a dictionary of any size: tokens with their places are joined to it. Missing places are breaks."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, lang, text in zip(batch.column(2).to_pylist(), *zip(*_texts(batch), strict=True), strict=True) if len(batch) else ():
                own = [(k, w) for k, w in enumerate(tokens(text)) if w != b"."]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(own), pa.int64()), pa.array([k for k, _ in own], pa.int64()), pa.array([lang] * len(own), pa.binary()).cast(pa.string()), pa.array([w for _, w in own], pa.binary()).cast(pa.string())],
                    names=["row", "place", "lang", "word"],
                )

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[np.ndarray]:
            for batch in batches:
                for own in batch.column(0).to_pylist():
                    place, known = (np.array([x[name] for x in own], np.int64) for name in ("place", "id"))
                    out = np.zeros(place[-1] + 1, np.uint64)
                    out[place] = known
                    yield _kept(out)

        yield from _rows_of_ids(found(), np.uint64)

    rows = texts.withColumn("row", F.monotonically_increasing_id()).mapInArrow(places, "row long, place long, lang string, word string")
    known = rows.join(dictionary.table.select("lang", "word", "id"), ["lang", "word"])
    return known.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "id"))).alias("own")).select("own").mapInArrow(ids, "ids binary")


# --- keys, runs and ranges --------------------------------------------------------------------


def keys_of(ids: np.ndarray, longest: int, digits: int) -> list[np.ndarray]:
    """Columns of 16-bit digits of the keys of all places where at least two words follow each other."""
    padded, alive, words = np.concatenate([ids, np.zeros(longest, ids.dtype)]), np.ones(len(ids), bool), []
    for k in range(longest):
        word = padded[k : k + len(ids)]
        alive = alive & (word != 0)
        words.append(np.where(alive, word, 0))
    some = words[1] != 0 if longest > 1 else alive[:0]
    return [((word[some] >> ids.dtype.type(16 * (digits - 1 - d))) & ids.dtype.type(0xFFFF)).astype(np.uint16) for word in words for d in range(digits)]


def radix_order(columns: list[np.ndarray]) -> np.ndarray:
    """The order of rows by all columns: a stable sort of each 16-bit digit, the last one first."""
    order = np.arange(len(columns[0]), dtype=np.int64)
    for column in reversed(columns):
        order = order[np.argsort(column[order], kind="stable")]
    return order


def run_starts(columns: list[np.ndarray]) -> np.ndarray:
    """Where rows of sorted columns differ from the row before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def counted(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    if not len(counts):
        return columns, counts
    order = radix_order(columns)
    columns = [c[order] for c in columns]
    starts = run_starts(columns)
    return [c[starts] for c in columns], np.add.reduceat(counts[order], starts)


def as_bytes(columns: list[np.ndarray]) -> np.ndarray:
    """Keys as fixed-width byte strings in the same order."""
    return np.stack(columns, axis=1).astype(">u2").view(f"S{2 * len(columns)}").ravel() if len(columns[0]) else np.empty(0, f"S{2 * len(columns)}")


_RUNS = pa.schema([("range", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _flushes(batches: Iterator[pa.RecordBatch], longest: int, digits: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    parts, held = [], 0

    def sort() -> tuple[list[np.ndarray], np.ndarray]:
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        parts.clear()
        return counted(columns, np.ones(len(columns[0]), np.int64))

    for batch in batches:
        for raw in batch.column(0):
            parts.append(keys_of(np.frombuffer(raw.as_buffer(), _kind(digits)), longest, digits))
            held += len(parts[-1][0])
            if held >= FLUSH_KEYS:
                yield sort()
                parts, held = [], 0
    if held:
        yield sort()


def _send(longest: int, digits: int, bounds: np.ndarray):
    """Sorted runs, cut at the bounds: a row for each range that a flush has keys of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, counts in _flushes(batches, longest, digits):
            cuts = [0, *np.searchsorted(as_bytes(columns), bounds).tolist(), len(counts)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                if b > a:
                    keys = b"".join(c[a:b].tobytes() for c in columns)
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([keys], pa.binary()), pa.array([counts[a:b].astype(np.uint32).tobytes()], pa.binary())], schema=_RUNS)

    return run


def _receive(longest: int, digits: int, least: int):
    """A range's phrases: those frequent in it, and those that may go on in its neighbours."""
    width = longest * digits

    def run(table: pa.Table) -> pa.Table:
        blocks = [np.frombuffer(x.as_buffer(), np.uint16).reshape(width, -1) for x in table["keys"]]
        sums = [np.frombuffer(x.as_buffer(), np.uint32).astype(np.int64) for x in table["counts"]]
        columns, counts = counted([np.concatenate([b[c] for b in blocks]) for c in range(width)], np.concatenate(sums))
        keys, found = [], []
        for length in range(2, longest + 1):
            starts = run_starts(columns[: length * digits])
            n = np.add.reduceat(counts, starts)
            some = n >= least
            some[[0, -1]] = True
            some &= np.any([columns[c][starts] != 0 for c in range((length - 1) * digits, length * digits)], axis=0)
            own = np.stack([c[starts[some]] for c in columns[: length * digits]], axis=1).astype(">u2")
            keys += [row.tobytes() for row in own]
            found.append(n[some])
        return pa.table([pa.array(keys, pa.binary()), pa.array(np.concatenate(found), pa.int64())], names=["key", "n"])

    return run


def count_phrases(encoded: DataFrame, longest: int, digits: int, least: int, range_keys: int = RANGE_KEYS) -> DataFrame:
    """``key, n`` of the phrases of two to ``longest`` words with at least ``least`` occurrences."""
    total = (encoded.agg(F.sum(F.octet_length("ids"))).first()[0] or 0) // (2 * digits)
    ranges = min(RANGES, max(1, total // range_keys))
    bounds = np.empty(0, f"S{2 * longest * digits}")
    if ranges > 1:
        some = encoded.sample(min(1.0, SAMPLE_KEYS / total), seed=1).limit(2 * SAMPLE_KEYS // ROW_TOKENS).toArrow()
        found = [as_bytes(keys_of(np.frombuffer(x.as_buffer(), _kind(digits)), longest, digits)) for x in some["ids"]]
        sample = np.unique(np.concatenate(found)) if found else bounds
        if len(sample):
            bounds = np.unique(sample[np.linspace(0, len(sample) - 1, ranges + 1).astype(int)[1:-1]])
    runs = encoded.mapInArrow(_send(longest, digits, bounds), "range int, keys binary, counts binary")
    pieces = runs.groupBy("range").applyInArrow(_receive(longest, digits, least), "key binary, n long")
    return pieces.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# --- scores -----------------------------------------------------------------------------------


def mine_phrases(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST, least: int = LEAST, top: int = TOP, percent: int = PERCENT, most_words: int = DICTIONARY, range_keys: int = RANGE_KEYS
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases."""
    texts = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    words = texts.mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = materialize(words.where((F.col("word") == "") | (F.col("n") >= least)), "phrase-counts")
    dictionary = Dictionary(words.where("word <> ''"), most_words)
    encoded = materialize((_encode if dictionary.words is not None else _encode_joined)(texts, dictionary), "phrase-ids")
    phrases = materialize(count_phrases(encoded, longest, dictionary.digits, least, range_keys), "phrases")

    wide = 2 * dictionary.digits
    known = dictionary.table.select(dictionary.key(F.col("id")).alias("key"), "lang", "word", "n")
    totals = words.where("word = ''").select("lang", F.col("n").alias("all"))
    counts = materialize(phrases.union(known.select("key", "n")), "phrase-parts")
    size = (F.octet_length("key") / wide).cast("int")
    own = phrases.withColumnRenamed("n", "a").withColumn("size", size).withColumn("head", F.expr(f"substring(key, 1, {wide})"))
    own = own.join(known.select(F.col("key").alias("head"), "lang"), "head").join(totals, "lang").drop("head")
    cuts = own.select("key", "lang", "a", "all", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"))
    cuts = cuts.withColumn("first", F.expr(f"substring(key, 1, cut * {wide})")).withColumn("rest", F.expr(f"substring(key, cut * {wide} + 1)"))
    cuts = cuts.join(counts.select(F.col("key").alias("first"), F.col("n").alias("l")), "first").join(counts.select(F.col("key").alias("rest"), F.col("n").alias("r")), "rest")
    exact = "(1000 * CAST(a AS decimal(19,0)) * CAST(all AS decimal(19,0))) div (CAST(l AS decimal(19,0)) * CAST(r AS decimal(19,0)))"
    lowest = F.min(F.struct(F.expr(exact).alias("score"), "cut", "l", "r")).alias("low")
    scored = cuts.groupBy("key", "lang", "a", "all").agg(lowest).select("key", "lang", "a", "all", "low.score", "low.l", "low.r")

    inside = phrases.withColumn("size", size).where("size > 2").select("n", F.explode(F.array(F.expr(f"substring(key, 1, (size - 1) * {wide})"), F.expr(f"substring(key, {wide} + 1)"))).alias("key"))
    inside = inside.groupBy("key").agg(F.max("n").alias("longer"))
    scored = scored.join(inside, "key", "left").where(~F.coalesce(100 * F.col("longer") >= percent * F.col("a"), F.lit(False)))
    by_score = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    best = materialize(scored.withColumn("_rank", F.rank().over(by_score)).where(F.col("_rank") <= top), "phrase-best")

    spelled = best.select("key", F.explode(F.sequence(F.lit(0), size - 1)).alias("place")).withColumn("one", F.expr(f"substring(key, place * {wide} + 1, {wide})"))
    spelled = spelled.join(known.select(F.col("key").alias("one"), "word"), "one").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("words"))
    out = best.join(spelled.select("key", F.array_join("words.word", " ").alias("phrase")), "key")
    last = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    out = out.withColumn("rank", F.row_number().over(last).cast("long")).where(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "l", "r", F.col("all").alias("n"), "score")
