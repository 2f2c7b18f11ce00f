"""Range and nearest joins, dictionary hits, verse and paragraph units, diffs and gates."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.operators import corpus as C
from textloom.operators import folds
from textloom.session import materialize

#: Phrases of one automaton.
MAX_PHRASES = 100_000


#: Values of one block, and blocks of one block of blocks, when running sums are made.
BLOCK = 1024


def running_below(values: DataFrame, n: str = "n") -> DataFrame:
    """``v, below``: for each value (``v``, once) the sum of ``n`` over smaller values.

    Sums are made in blocks of blocks of values, so that no window sees all rows: only the outermost, one row a
    ``BLOCK ** 2`` values of the range, is whole.
    """
    t = values.withColumn("b", F.expr(f"v div {BLOCK}")).withColumn("c", F.expr(f"v div {BLOCK * BLOCK}"))
    before = lambda part, order, x: F.coalesce(F.sum(x).over(Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = t.groupBy("c", "b").agg(F.sum(n).alias("m"))
    outer = blocks.groupBy("c").agg(F.sum("m").alias("m")).select("c", before([F.lit(0)], "c", "m").alias("base_c"))
    inner = blocks.select("c", "b", before(["c"], "b", "m").alias("base_b")).join(outer, "c").select("b", (F.col("base_b") + F.col("base_c")).alias("base"))
    return t.select("v", "b", before(["b"], "v", n).alias("own")).join(inner, "b").select("v", (F.col("base") + F.col("own")).alias("below"))


def count_in_ranges(ranges: DataFrame, points: DataFrame, key: str, low: str, high: str, point: str, out: str) -> DataFrame:
    """``key, out``: how many points lie in each closed range.

    Points are counted per value; running sums over values turn each range into the difference of two lookups.
    """
    counts = points.groupBy(F.col(point).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    ends = ranges.select(F.col(low).alias("v"), F.lit(0).cast("long").alias("n")).union(ranges.select((F.col(high) + 1).alias("v"), F.lit(0).cast("long").alias("n")))
    below = running_below(counts.unionByName(ends).groupBy("v").agg(F.sum("n").alias("n")))
    a = ranges.join(below.select(F.col("v").alias(low), F.col("below").alias("b0")), low)
    b = a.withColumn("_end", F.col(high) + 1).join(below.select(F.col("v").alias("_end"), F.col("below").alias("b1")), "_end")
    return b.select(key, (F.col("b1") - F.col("b0")).alias(out))


def nearest(left: DataFrame, right: DataFrame, group: str, value: str, key: str) -> DataFrame:
    """``key, match, gap``: for each left row the other right row of its group with the nearest value; ties by smaller key.

    A row of the same value is found by that value's two least keys; else the nearest smaller or greater value
    decides, by windows over the distinct values of a group, not all pairs.
    """
    best = right.groupBy(group, value).agg(F.min(key).alias("m"))
    second = right.join(best, [group, value]).where(F.col(key) > F.col("m")).groupBy(group, value).agg(F.min(key).alias("m2"))
    values = best.withColumn("at", F.col(value).cast("long")).unionByName(left.select(group, value).distinct().join(best, [group, value], "left_anti"), allowMissingColumns=True)
    w = Window.partitionBy(group).orderBy(value)
    below, above = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    near = values.select(
        group, value, "m", F.last("at", ignorenulls=True).over(below).alias("b_at"), F.last("m", ignorenulls=True).over(below).alias("b"),
        F.first("at", ignorenulls=True).over(above).alias("a_at"), F.first("m", ignorenulls=True).over(above).alias("a"),
    )
    j = left.select(group, value, key).join(near, [group, value]).join(second, [group, value], "left")
    own = F.when(F.col("m") != F.col(key), F.col("m")).otherwise(F.col("m2"))
    bg, ag = F.col(value) - F.col("b_at"), F.col("a_at") - F.col(value)
    back = F.col("a").isNull() | (bg < ag) | ((bg == ag) & (F.col("b") <= F.col("a")))
    out = j.select(key, F.when(own.isNotNull(), own).when(back, F.col("b")).otherwise(F.col("a")).alias("match"), F.when(own.isNotNull(), F.lit(0)).when(back, bg).otherwise(ag).alias("gap"))
    return out.where("match IS NOT NULL")


def _slices(phrases: DataFrame, column: str) -> Iterator[list[str]]:
    """The distinct phrases in slices of about ``MAX_PHRASES``, each small enough for one automaton."""
    distinct = phrases.select(F.col(column).alias("p")).where("p <> ''").distinct()
    parts = -(-distinct.count() // MAX_PHRASES)
    for k in range(parts):
        yield sorted(r.p for r in distinct.where(F.pmod(F.xxhash64("p"), F.lit(parts)) == k).collect())


def _automaton(phrases: list[str]):
    import ahocorasick

    out = ahocorasick.Automaton()
    for p in phrases:
        out.add_word(p, p)
    out.make_automaton()
    return out


def phrase_hits(docs: DataFrame, phrases: DataFrame, key: str) -> DataFrame:
    """``key, phrase, docs, hits`` of literal phrases in texts, hits not overlapping themselves.

    One automaton over a slice of ``MAX_PHRASES`` phrases reads each text once; larger dictionaries take a pass for each
    slice. Empty phrases never match.
    """

    def counter(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            auto = _automaton(sent.value)
            total: dict[str, list[int]] = {}
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    last: dict[str, int] = {}
                    here: dict[str, int] = {}
                    for end, p in auto.iter(text or ""):
                        if end - len(p) >= last.get(p, -1):
                            last[p] = end
                            here[p] = here.get(p, 0) + 1
                    for p, n in here.items():
                        t = total.setdefault(p, [0, 0])
                        t[0] += 1
                        t[1] += n
            yield pa.RecordBatch.from_pydict({"phrase": pa.array(list(total), pa.string()), "d": pa.array([t[0] for t in total.values()], pa.int64()), "h": pa.array([t[1] for t in total.values()], pa.int64())})

        return run

    context = docs.sparkSession.sparkContext
    counted = docs.sparkSession.createDataFrame([], "phrase string, d long, h long")
    for part in _slices(phrases, "phrase"):
        counted = counted.unionByName(docs.select("text").mapInArrow(counter(context.broadcast(part)), "phrase string, d long, h long"))
    counted = counted.groupBy("phrase").agg(F.sum("d").alias("docs"), F.sum("h").alias("hits"))
    return phrases.join(counted, "phrase").select(key, "phrase", "docs", "hits")


def phrase_pairs(docs: DataFrame, phrases: DataFrame, key: str) -> DataFrame:
    """``key, phrase``: which phrases occur in which texts, each once (``docs`` has ``key, text``)."""
    kind = dict(docs.dtypes)[key]

    def finder(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            auto = _automaton(sent.value)
            for batch in batches:
                found = [sorted({p for _, p in auto.iter(t or "")}) for t in batch.column(1).to_pylist()]
                at = [k for k, f in enumerate(found) for _ in f]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array([p for f in found for p in f], pa.string())], names=[key, "phrase"])

        return run

    out = docs.sparkSession.createDataFrame([], f"{key} {kind}, phrase string")
    for part in _slices(phrases, "phrase"):
        out = out.unionByName(docs.select(key, "text").mapInArrow(finder(docs.sparkSession.sparkContext.broadcast(part)), f"{key} {kind}, phrase string"))
    return out


#: Bytes of the part of a dictionary that binds everywhere, which every view repeats.
BINDING_BYTES = 1 << 20


def term_lines(terms: DataFrame, constraint: str = X.CONSTRAINT) -> DataFrame:
    """``ord, phrase, binding, line`` of dictionary terms (``ord, headword, rendering, status, note``): what a view shows of each.

    Notes that match ``constraint`` are shown whole.
    """
    t = terms.withColumn("phrase", X.headword(F.col("headword"))).withColumn("binding", F.col("status").isin("fixed", "fixed-set"))
    tag = F.when(F.col("status") == "fixed", "FIXED").when(F.col("status") == "fixed-set", "SET  ").otherwise("prov ")
    note = X.first_sentence(F.coalesce("note", F.lit("")), 140, F.col("binding"), constraint)
    line = F.concat(tag, F.lit(" "), "headword", F.lit(" -> "), "rendering", F.when(note != "", F.concat(F.lit("\n      "), note)).otherwise(F.lit("")))
    return t.select("ord", "phrase", "binding", line.alias("line"))


def own_terms(docs: DataFrame, lines: DataFrame, key: str) -> DataFrame:
    """``key, ord, line``: the terms (of :func:`term_lines`) that don't bind everywhere, for each text they occur in."""
    free = lines.where("NOT binding")
    return phrase_pairs(docs, free, key).join(free.select("ord", "phrase", "line"), "phrase").select(key, "ord", "line")


def dictionary_views(docs: DataFrame, terms: DataFrame, key: str, constraint: str = X.CONSTRAINT) -> DataFrame:
    """``key, n_terms, view``: for each text the terms that bind everywhere and those that occur in it, as compact text.

    Fixed terms and sets of variants bind everywhere; entries without a headword occur nowhere. A term is looked up by what
    stands before its parenthesis. What binds everywhere stands in every view, so it may have ``BINDING_BYTES``
    bytes; beyond that keep it once, and take :func:`own_terms` for each text.
    """
    lines = materialize(term_lines(terms, constraint), "term-lines")
    bound = lines.where("binding").select("ord", "line").orderBy("ord", "line")
    if (bound.agg(F.sum(F.octet_length("line"))).first()[0] or 0) > BINDING_BYTES:
        raise ValueError("too much binds everywhere to be repeated in every view")
    rows = [(r["ord"], r["line"]) for r in bound.collect()]
    always = F.from_json(F.lit(json.dumps([{"ord": o, "line": x} for o, x in rows])), "array<struct<ord: bigint, line: string>>")
    own = docs.select(key).join(own_terms(docs, lines, key).groupBy(key).agg(F.collect_list(F.struct(F.col("ord").cast("long").alias("ord"), "line")).alias("own")), key, "left")
    every = F.array_sort(F.concat(always, F.coalesce("own", F.expr("CAST(array() AS ARRAY<STRUCT<ord: BIGINT, line: STRING>>)"))))
    return own.select(key, F.size(every).alias("n_terms"), F.array_join(F.transform(every, lambda r: r["line"]), "\n").alias("view"))


def next_greater(df: DataFrame, doc: str, order: str, value: str, out: str) -> DataFrame:
    """``doc, order, value, out``: the first later value that is greater than the row's own, in its document."""
    rows = df.select(doc, F.col(order).cast("long").alias(order), F.col(value).cast("long").alias(value))
    return folds.folded(rows, doc, [order, value], folds.next_greater, f"{order} long, {value} long, {out} long")


def verse_units(docs: DataFrame, key: str, limit: int = 76, least: int = 2) -> DataFrame:
    """Runs of at least ``least`` lines, all shorter than ``limit`` when trimmed: ``key, start_line, n_lines, text_hash``."""
    t = C.lines(docs, key).withColumn("line", F.trim("line")).withColumn("short", F.length("line") < limit)
    w = Window.partitionBy(key).orderBy("line_no")
    t = t.withColumn("new", F.coalesce((F.lag("short").over(w) != F.col("short")).cast("int"), F.lit(1))).withColumn("run", F.sum("new").over(w)).where("short")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n")
    return t.groupBy(key, "run").agg(F.min("line_no").alias("start_line"), F.count(F.lit(1)).alias("n_lines"), X.content_hash(joined).alias("text_hash")).where(F.col("n_lines") >= least).drop("run")


def paragraphs(docs: DataFrame, key: str, q: float = 0.5) -> DataFrame:
    """A line after a short one opens a paragraph; short is below the document's own length quantile."""
    w = Window.partitionBy(key)
    sizes = F.transform(F.split("text", "\n"), lambda x: F.length(x))
    t = docs.select(key, X.index_quantile(sizes, q, "floor_n1").alias("m"), F.posexplode(F.split("text", "\n")).alias("line_no", "line")).withColumn("n", F.length("line"))
    prev = F.lag("n").over(w.orderBy("line_no"))
    t = t.withColumn("open", (prev.isNull() | (prev < F.col("m"))).cast("int")).withColumn("para", F.sum("open").over(w.orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)))
    return t.groupBy(key, "para").agg(F.count(F.lit(1)).alias("n_lines"))


def gate(counters: DataFrame, baseline: DataFrame) -> DataFrame:
    """``name, value, most, ok``; a counter that is missing fails."""
    j = baseline.join(counters, "name", "left")
    return j.select("name", "value", "most", F.coalesce(F.col("value") <= F.col("most"), F.lit(False)).alias("ok"))


#: Edits up to which a diff costs their number times the words; beyond it, all pairs of words are compared, a row at once.
FEW_EDITS = 256


def worthwhile_edits(n: int, m: int) -> int:
    """Up to how many edits frontiers (some of their square steps) are cheaper than the table (``n`` rows of ``m`` cells, at once)."""
    return min(FEW_EDITS, int((n * (25 + m / 80)) ** 0.5))


def edit_frontiers(x: list[int], y: list[int], most: int) -> list[dict[int, int]] | None:
    """For 0, 1, 2, … edits and each diagonal (place in ``x`` minus place in ``y``) the first place in ``x`` from which the ends are that near.

    The last one reaches the beginnings. None if they are more than ``most`` edits apart.
    """
    n, m = len(x), len(y)
    found: list[dict[int, int]] = []
    for d in range(most + 1):
        now: dict[int, int] = {}
        before, earlier = (found[d - 1] if d else {}), (found[d - 2] if d > 1 else {})
        for k in range(n - m - d, n - m + d + 1, 2):
            ways = [earlier[k]] if k in earlier else [] if d else [n]
            if before.get(k + 1, 0) > 0:
                ways.append(before[k + 1] - 1)
            if k - 1 in before and before[k - 1] - k + 1 > 0:
                ways.append(before[k - 1])
            if ways:
                i = min(ways)
                while i > 0 and i > k and x[i - 1] == y[i - k - 1]:
                    i -= 1
                now[k] = i
        found.append(now)
        if now.get(0) == 0:
            return found
    return None


def places_within(a: list, b: list) -> list[int] | None:
    """The first places in ``b`` where all of ``a`` stands in order; None if it doesn't. Then ``a`` is the longest common subsequence, and the edits are these."""
    out, at = [], -1
    try:
        for w in a:
            at = b.index(w, at + 1)
            out.append(at)
    except ValueError:
        return None
    return out


def word_edits(a: list[str], b: list[str]) -> Iterator[tuple[str, str]]:
    """``(=, word)``, ``(-, word)`` and ``(+, word)`` by longest common subsequence; where both will do, words go before words come.

    From a pair of places on, the fewest edits never grow along a diagonal, so the places from which ``d`` edits are enough
    are all behind a frontier, and the walk asks only which of two steps leads behind the next one. Where words only came, or only went, however
    many, one pass finds them.
    """
    for kind, small, large in (("+", a, b), ("-", b, a)):
        if len(small) <= len(large) and (places := places_within(small, large)) is not None:
            kept = set(places)
            yield from (("=" if k in kept else kind, w) for k, w in enumerate(large))
            return
    numbers: dict[str, int] = {}
    x, y = ([numbers.setdefault(w, len(numbers)) for w in words] for words in (a, b))
    most = worthwhile_edits(len(x), len(y))
    # What the texts share, in any order, says how many edits there must be.
    frontiers = edit_frontiers(x, y, most) if len(x) + len(y) - 2 * (Counter(x) & Counter(y)).total() <= most else None
    if frontiers is None:
        yield from _word_edits_by_table(a, b)
        return
    i = j = 0
    d = len(frontiers) - 1
    while i < len(x) and j < len(y):
        if x[i] == y[j]:
            yield "=", a[i]
            i, j = i + 1, j + 1
            continue
        d -= 1
        if frontiers[d].get(i - j + 1, len(x) + 1) <= i + 1:
            yield "-", a[i]
            i += 1
        else:
            yield "+", b[j]
            j += 1
    yield from (("-", w) for w in a[i:])
    yield from (("+", w) for w in b[j:])


def _word_edits_by_table(a: list[str], b: list[str]) -> Iterator[tuple[str, str]]:
    """The same for texts with many edits.

    Rows of the table are made from the end, each at once; every so many are kept, and the ones between are made again when
    the walk comes there, so space is the square root of the table's rows.
    """
    numbers: dict[str, int] = {}
    x, y = (np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64) for words in (a, b))
    n, m = len(x), len(y)
    step = max(1, int(n**0.5))

    def up(row: np.ndarray, i: int) -> np.ndarray:
        best = row.copy()
        best[:-1] = np.where(y == x[i], row[1:] + 1, row[:-1])
        return np.maximum.accumulate(best[::-1])[::-1]

    kept, row = {n: np.zeros(m + 1, np.int32)}, np.zeros(m + 1, np.int32)
    for i in range(n - 1, -1, -1):
        row = up(row, i)
        if i % step == 0:
            kept[i] = row
    i = j = 0
    rows: dict[int, np.ndarray] = {}
    while i < n and j < m:
        if i not in rows or i + 1 not in rows:
            end = min(n, (i // step + 1) * step)
            rows = {end: kept[end]}
            for k in range(end - 1, i - 1, -1):
                rows[k] = up(rows[k + 1], k)
        if x[i] == y[j]:
            yield "=", a[i]
            i, j = i + 1, j + 1
        elif rows[i + 1][j] >= rows[i][j + 1]:
            yield "-", a[i]
            i += 1
        else:
            yield "+", b[j]
            j += 1
    yield from (("-", w) for w in a[i:])
    yield from (("+", w) for w in b[j:])


def lcs_marks(before: str, after: str) -> tuple[int, int, int, str]:
    """Words kept, removed and added, and the inline markup: removed words between ``~~``, added ones between ``**``."""
    mark, counts, out, last = {"-": "~~", "+": "**", "=": ""}, {"=": 0, "-": 0, "+": 0}, [], "="
    for kind, word in word_edits((before or "").split(), (after or "").split()):
        if kind != last:
            out += [mark[last], mark[kind]]
            last = kind
        out.append(word + " ")
        counts[kind] += 1
    return counts["="], counts["-"], counts["+"], "".join([*out, mark[last]]).strip()


def word_diff(df: DataFrame, keys: list[str]) -> DataFrame:
    """``*keys, kept, removed, added, markup`` of columns before and after (Arrow batches)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            marks = [lcs_marks(a, b) for a, b in zip(t["before"], t["after"], strict=True)]
            out = t[keys].copy()
            for k, name in enumerate(("kept", "removed", "added", "markup")):
                out[name] = [m[k] for m in marks]
            yield out

    kinds = dict(df.dtypes)
    schema = ", ".join([*[f"{k} {kinds[k]}" for k in keys], "kept long, removed long, added long, markup string"])
    return df.select(*keys, "before", "after").mapInPandas(run, schema)
