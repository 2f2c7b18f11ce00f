"""Toxicity behind a noisy channel: deobfuscate, then score.

A writer's word passes a channel that swaps letters for digits and signs, puts separators between
them and repeats them. Each odd-looking token becomes a lattice of readings, and Viterbi decoding
under a character trigram model picks the likeliest word. The model's counts come from all words
of all documents. A lexicon of restored words that mark toxic documents, and a small logistic
model over its hits, are then fitted on the labelled rows that are not held out
(``crc32(id as text) % 3 <> 1``) and score every restored text.

Bounds, all parameters: the trigram model knows the ``ALPHABET`` commonest letters, others share a
class, and letters become classes before trigrams are collected, so no count is lost; the logistic
fit sees the numbers (no texts) of at most ``FIT_ROWS`` labelled rows, smallest hash first. Counts
cover all rows. The lexicon holds every word that passes its test: up to ``LEXICON_SENT`` words it is
sent to the workers, beyond that the restored words are joined with it.

Edge cases: null and empty texts score as texts without hits; tokens of any length are read in
linear time (those over ``KEEP_TOKEN`` characters are not remembered); equal texts score alike; without
labels (or with one class only) every score is the prior; an empty table gives an empty result; a
null id counts as not held out; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import materialize

ALPHABET = 64
LEXICON_SENT = 200_000
FIT_ROWS = 50_000
KEEP_TOKEN = 64
CACHE = 400_000
#: Trigrams whose probability a worker remembers.
MEMO = 1_000_000
FLUSH_WORDS = 500_000
PREDICT = 0.7
#: Channel cost of a word boundary between spaced letters.
BOUNDARY = -1.0
EDGE = "^"
OTHER = "?"

#: What a sign may stand for (fixed values).
READINGS = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou", "#": "aeiou", "%": "aeiou",
}
SEPARATORS = frozenset(".-_*~'`,:;/\\|·+=^")
ODD = re.compile(r"[\W\d_]|(.)\1")
SPACED = re.compile(r"(?<!\S)\S(?: \S){2,}(?!\S)")
#: Every such run has this in it; it starts with a blank, which is found fast.
MAYBE_SPACED = re.compile(r" \S \S\s")
TRIM = ".,;:?\"()[]{}«»“”"


def _fold(word: str) -> str:
    return word.lower().strip(TRIM)


class CharModel:
    """Interpolated character trigrams over a bounded alphabet; ``letters`` are those of their own class."""

    def __init__(self, counts: dict[tuple[str, str, str], int], letters: set[str] | None = None) -> None:
        if letters is None:
            seen = Counter()
            for (_, _, c), n in counts.items():
                seen[c] += n
            letters = {c for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:ALPHABET]}
        self.letters = letters
        tri, bi, two, one, uni = Counter(), Counter(), Counter(), Counter(), Counter()
        for (a, b, c), n in counts.items():
            a, b, c = self.cls(a), self.cls(b), self.cls(c)
            tri[a, b, c] += n
            bi[a, b] += n
            two[b, c] += n
            one[b] += n
            uni[c] += n
        self.tri, self.bi, self.two, self.one, self.uni, self.total = tri, bi, two, one, uni, sum(uni.values())
        self.logs = _Logs(self)
        #: Names the model, for what a worker remembers between tasks.
        self.name = xxhash.xxh3_128_hexdigest(repr((sorted(self.letters), sorted(tri.items()))))

    def cls(self, c: str) -> str:
        return c if c in self.letters or c == EDGE else OTHER

    def log(self, a: str, b: str, c: str) -> float:
        return self.logs[a + b + c]


class _Logs(dict):
    """Log probability of a trigram's last letter, by the three letters; made when first asked for."""

    def __init__(self, model: CharModel) -> None:
        super().__init__()
        self.model = model

    def __missing__(self, gram: str) -> float:
        m = self.model
        a, b, c = map(m.cls, gram)
        p1 = (m.uni[c] + 1) / (m.total + ALPHABET + 2)
        p2 = (m.two[b, c] + 4 * p1) / (m.one[b] + 4)
        got = math.log((m.tri[a, b, c] + 4 * p2) / (m.bi[a, b] + 4))
        if len(self) < MEMO:
            self[gram] = got
        return got

    def __reduce__(self):
        return _Logs, (self.model,)


RUNS = re.compile(r"(.)\1*", re.S)


def lattice(token: str, spaced: bool = False) -> list[list[tuple[str, float]]]:
    """Readings of each run of equal characters: letters (possibly none) and their channel cost.

    With ``spaced``, a blank (the end of a word) may stand before any of them but the first, and
    between equal letters.
    """
    out: list[list[tuple[str, float]]] = []
    plain = False
    for m in RUNS.finditer(token):
        c, n = m[1], len(m[0])
        reads: list[tuple[str, float]] = []
        if n == 1 and not spaced and c.isalpha():
            # Neighbouring letters with one reading are one step.
            if plain:
                out[-1] = [(out[-1][0][0] + c, 0.0)]
            else:
                out.append([(c, 0.0)])
            plain = True
            continue
        plain = False
        if c.isalpha():
            reads.append((c, 0.0 if n == 1 else -1.0))
            if n >= 2:
                reads.append((c + c, 0.0 if n == 2 else -1.5))
                if spaced:
                    reads.append((c + " " + c, BOUNDARY))
        else:
            reads += [(x, -1.0) for x in READINGS.get(c, "")]
            if c in READINGS and n == 2:
                reads += [(x + x, -1.5) for x in READINGS[c]]
            if c in SEPARATORS or not reads:
                reads.append(("", -0.5))
            if c.isdigit():
                reads.append((c * min(n, 2), -3.0))
        if spaced and out:
            reads += [(" " + x, cost + BOUNDARY) for x, cost in reads if x]
        out.append(reads)
    return out


def restore(token: str, model: CharModel, spaced: bool = False) -> str:
    """The likeliest word behind one lower-case token, or words (blanks between them) behind ``spaced`` letters."""
    if not spaced and not ODD.search(token) or not any(c.isalpha() or c in READINGS for c in token):
        return token
    # States: the last two letters; per state the best score and its readings, last first.
    logs = model.logs
    states: dict[str, tuple[float, tuple]] = {EDGE * 2: (0.0, ())}
    for reads in lattice(token, spaced):
        now: dict[str, tuple[float, tuple]] = {}
        for last, (score, path) in states.items():
            for letters, cost in reads:
                s, at = score + cost, last
                for c in letters:
                    if c == " ":
                        s, at = s + logs[at + EDGE], EDGE * 2
                    else:
                        s += logs[at + c]
                        at = at[1] + c
                if at not in now or s > now[at][0]:
                    now[at] = (s, (letters, path))
        states = now
    path = max((s + model.log(at[0], at[1], EDGE), at, path) for at, (s, path) in states.items())[2]
    out = []
    while path:
        letters, path = path
        out.append(letters)
    return "".join(reversed(out))


#: Per model, its instance and the odd words restored so far: a worker's tasks share them. Only the last model is kept.
_SHARED: dict[str, tuple[CharModel, dict[str, str]]] = {}


def shared(model: CharModel) -> tuple[CharModel, dict[str, str]]:
    if model.name not in _SHARED:
        _SHARED.clear()
        _SHARED[model.name] = model, {}
    return _SHARED[model.name]


class Restorer(dict):
    """Token to restored word, with a bounded memory; ``of`` maps restored words further."""

    def __init__(self, model: CharModel, of: Callable[[str], object] = str) -> None:
        super().__init__()
        (self.model, self.known), self.of = shared(model), of

    def __missing__(self, token: str) -> object:
        word = _fold(token)
        if ODD.search(word):
            found = self.known.get(word)
            if found is None:
                found = restore(word, self.model)
                if len(word) <= KEEP_TOKEN:
                    if len(self.known) >= CACHE:
                        self.known.clear()
                    self.known[word] = found
            word = found
        got = self.of(word)
        if len(token) <= KEEP_TOKEN:
            if len(self) >= CACHE:
                self.clear()
            self[token] = got
        return got

    def words(self, text: str) -> list:
        out = list(map(self.__getitem__, text.split()))
        if MAYBE_SPACED.search(text + " "):
            for m in SPACED.finditer(text):
                letters = _fold(m[0].replace(" ", ""))
                whole, split = restore(letters, self.model), restore(letters, self.model, True).split()
                out += map(self.of, split if [whole] == split else [whole, *split])
        return out


def _trigram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush(words: Counter) -> pa.RecordBatch:
        tri: Counter = Counter()
        for w, n in words.items():
            w = _fold(w)
            if w.isalpha():
                w = EDGE * 2 + w + EDGE
                for k in range(len(w) - 2):
                    tri[w[k : k + 3]] += n
        return pa.RecordBatch.from_arrays([pa.array(list(tri), pa.string()), pa.array(list(tri.values()), pa.int64())], names=["gram", "n"])

    words: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            words.update((text or "").split())
            if len(words) > FLUSH_WORDS:
                yield flush(words)
                words = Counter()
    yield flush(words)


def learn_characters(docs: DataFrame, text_col: str = "text") -> CharModel:
    """Trigram counts over the words of all documents; letters become classes before anything is collected."""
    grams = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_trigram_rows, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    grams = materialize(grams, "toxic-grams")
    letters = grams.groupBy(F.right("gram", F.lit(1)).alias("letter")).agg(F.sum("n").alias("n")).where(F.col("letter") != EDGE)
    common = {r.letter for r in letters.orderBy(F.desc("n"), "letter").limit(ALPHABET).collect()}
    others = "[^" + EDGE.replace("^", r"\^") + "".join(f"\\x{{{ord(c):x}}}" for c in sorted(common)) + "]"
    # At most (ALPHABET + 2) ** 3 rows.
    folded = grams.groupBy(F.regexp_replace("gram", others, OTHER).alias("gram")).agg(F.sum("n").alias("n"))
    return CharModel({tuple(r.gram): r.n for r in folded.collect()}, common)


def _word_rows(chars: CharModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Restorer(chars)
        seen = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            words = list(seen[0].keys() | seen[1].keys())
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([seen[1][w] for w in words], pa.int64()), pa.array([seen[0][w] for w in words], pa.int64())], names=["word", "bad", "good"])

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[1 if toxic else 0].update(set(own.words(text or "")))
            if len(seen[0]) + len(seen[1]) > FLUSH_WORDS:
                yield flush()
                seen = (Counter(), Counter())
        yield flush()

    return run


def features(odds: list[float]) -> list[float]:
    """Numbers of one restored text from its words' odds (0 for words outside the lexicon)."""
    hits = [x for x in odds if x]
    return numbers(len(odds), len(hits), max(hits, default=0.0))


def numbers(words: int, hits: int, top: float) -> list[float]:
    return [1.0, float(hits > 0), math.log1p(hits), math.log1p(1000 * hits / (words + 20)), top, math.log1p(words) / 5]


def _feature_rows(chars: CharModel, lexicon: dict[str, float]):
    """``(text, *others)`` to ``(x, *others)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Restorer(chars, lambda w: lexicon.get(w, 0.0))
        for batch in batches:
            rows = [features(own.words(t.as_py() or "")) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), *batch.columns[1:]], names=["x", *batch.schema.names[1:]])

    return run


def _count_rows(chars: CharModel):
    """``(key, text)`` to ``(key, word, n)`` of restored words, and a row with the number of all words (null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Restorer(chars)
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = own.words(text.as_py() or "")
                seen = Counter(words)
                yield pa.RecordBatch.from_arrays([pa.array([key] * (len(seen) + 1), pa.int64()), pa.array([None, *seen], pa.string()), pa.array([len(words), *seen.values()], pa.int64())], names=["key", "word", "n"])

    return run


def featured(rows: DataFrame, chars: CharModel, lexicon: DataFrame, sent: int = LEXICON_SENT) -> DataFrame:
    """``rows`` (``text`` and others) with ``x``, the numbers of the text, in place of ``text``.

    ``lexicon`` (``word, odds``) is a written table. Beyond ``sent`` words it is not sent: each
    distinct text's words are joined with it.
    """
    others = [c for c in rows.columns if c != "text"]
    kinds = dict(rows.dtypes)
    if lexicon.count() <= sent:
        found = {r.word: r.odds for r in lexicon.collect()}
        return rows.select("text", *others).mapInArrow(_feature_rows(chars, found), ", ".join(["x array<double>", *[f"`{c}` {kinds[c]}" for c in others]]))
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    counted = rows.select(key.alias("key"), "text").dropDuplicates(["key"]).mapInArrow(_count_rows(chars), "key long, word string, n long")
    hits = counted.join(lexicon, "word", "left").groupBy("key").agg(
        F.sum(F.when(F.col("word").isNull(), F.col("n"))).cast("double").alias("w"), F.coalesce(F.sum(F.when(F.col("odds").isNotNull(), F.col("n"))), F.lit(0)).cast("double").alias("h"), F.coalesce(F.max("odds"), F.lit(0.0)).alias("top")
    )
    x = F.array(F.lit(1.0), (F.col("h") > 0).cast("double"), F.log1p("h"), F.log1p(F.col("h") * 1000 / (F.col("w") + 20)), F.col("top"), F.log1p("w") / 5)
    return rows.withColumn("key", key).drop("text").join(hits.select("key", x.alias("x")), "key").select("x", *others)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Newton steps of a ridge logistic regression; the first column is the constant."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _held_out(id_col: str):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``id_col, held_out, score, predicted`` for every row of ``docs``."""
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    known = labels.select(F.col(id_col).cast("long").alias("label_id"), F.col(label_col).cast("int").alias("toxic")).where(F.col("toxic").isNotNull())
    known = known.where(~_held_out("label_id")).groupBy("label_id").agg(F.max("toxic").alias("toxic"))
    known = F.broadcast(known) if labels.count() <= 500_000 else known.hint("shuffle_hash")
    taught = source.join(known, F.col("id") == F.col("label_id")).select("text", "toxic", F.xxhash64("id").alias("h"))

    chars = learn_characters(docs, text_col)
    counts = taught.select("text", "toxic").mapInArrow(_word_rows(chars), "word string, bad long, good long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    sizes = taught.agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")).first()
    bad, good = float(sizes.bad or 0), float(sizes.good or 0)
    odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    expected = (F.col("bad") + F.col("good")) * (bad / max(bad + good, 1.0))
    strong = (F.col("bad") - expected) / F.sqrt(expected + 1) > 4
    lexicon = materialize(counts.where((F.col("bad") >= 3) & strong & F.lit(bool(bad and good))).select("word", F.round(odds, 9).alias("odds")).where("odds > 1"), "toxic-lexicon")
    weights = np.zeros(6)
    if bad and good:
        rows = featured(taught, chars, lexicon).orderBy("h", "x", "toxic").limit(FIT_ROWS).collect()
        weights = fit_logistic(np.array([r.x for r in rows]), np.array([r.toxic for r in rows], float))
    elif bad or good:
        weights[0] = 6.0 if bad else -6.0

    linear = F.aggregate(F.zip_with("x", F.array(*[F.lit(float(w)) for w in weights]), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    scored = featured(source, chars, lexicon).select("id", F.round(1 / (1 + F.exp(-F.least(F.lit(30.0), F.greatest(F.lit(-30.0), linear)))), 12).alias("score"))
    return scored.select(F.col("id").alias(id_col), _held_out("id").alias("held_out"), "score", (F.col("score") >= PREDICT).cast("int").alias("predicted"))
