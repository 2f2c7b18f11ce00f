"""Outlines from two sources: contents entries against printed headings, nesting, paths and spans."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.operators import folds
from textloom.operators.corpus import cluster_means
from textloom.session import materialize


def match_headings(entries: DataFrame, headings: DataFrame, reach: int | None = None) -> DataFrame:
    """``book, ord, page, heading``: for each entry the nearest heading of its key, each used once; nulls if none is left.

    ``entries`` has ``book, ord, key, want`` (a page or null), ``headings`` has ``book, ord, key, page``. Entries
    choose in order, among the headings of one book and key; with ``reach`` only among those that many pages from the wanted one.
    """
    book = dict(entries.dtypes)["book"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        free = folds.Free(list(zip(right["ord"].to_pylist(), right["page"].to_pylist(), strict=True)))
        left = left.sort_by("ord")
        found = [free.take(w, reach) for w in left["want"].to_pylist()]
        return pa.table({"book": left["book"], "ord": left["ord"], "page": pa.array([f and f[0] for f in found], pa.int64()), "heading": pa.array([f and f[1] for f in found], pa.int64())})

    # New names on either side, as both may come from one table.
    a = entries.select(F.col("book").alias("book"), F.col("ord").cast("long").alias("ord"), F.col("key").alias("key"), F.col("want").cast("long").alias("want"))
    b = headings.select(F.col("book").alias("book"), F.col("ord").cast("long").alias("ord"), F.col("key").alias("key"), F.col("page").cast("long").alias("page"))
    return a.groupBy("book", "key").cogroup(b.groupBy("book", "key")).applyInArrow(run, f"book {book}, ord long, page long, heading long")


def _segment(length: str, i: str, most: int) -> tuple[str, str]:
    """SQL of the start (from 0) and the length of segment ``i`` of ``most + 1`` nearly equal ones of a text of some length."""
    base, wide = f"({length} div {most + 1})", f"({length} % {most + 1})"
    first = f"({most + 1} - {wide})"
    return f"({i} * {base} + greatest(0, {i} - {first}))", f"({base} + CASE WHEN {i} >= {first} THEN 1 ELSE 0 END)"


def titles_within(asked: DataFrame, titles: DataFrame, most: int) -> DataFrame:
    """``book, ord, h, other, d``: titles (``book, h, other, size``) at most ``most`` edits from a key (``book, ord, key``).

    A title is cut to ``most + 1`` segments; one of them stands unchanged in any key that near, at a place that the
    lengths and the edits to its left and right allow. So segments are joined with the parts of the keys that may be them.
    """
    start, length = _segment("size", "i", most)
    index = titles.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(most)))).withColumn("part", F.expr(f"substring(other, int({start}) + 1, int({length}))")).select("book", "size", "i", "part", "h", "other")
    probes = asked.withColumn("n", F.length("key")).withColumn("size", F.explode(F.expr(f"sequence(greatest(0, n - {most}), n + {most})"))).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(most))))
    probes = probes.withColumn("p", F.expr(start)).withColumn("l", F.expr(length)).withColumn("low", F.expr(f"greatest(0, p - i, p + n - size - ({most} - i))")).withColumn("high", F.expr(f"least(n - l, p + i, p + n - size + ({most} - i))"))
    probes = probes.where("low <= high").withColumn("at", F.explode(F.sequence("low", "high"))).select("book", "ord", "key", "size", "i", F.expr("substring(key, int(at) + 1, int(l))").alias("part")).distinct()
    near = probes.join(index, ["book", "size", "i", "part"]).select("book", "ord", "key", "h", "other").distinct()
    return near.withColumn("d", F.levenshtein("key", "other", most)).where("d >= 0").select("book", "ord", "h", "other", "d")


def nearest_titles(unmatched: DataFrame, headings: DataFrame) -> DataFrame:
    """``book, ord, nearest, distance``: for entries without a heading the closest title of the book by edit distance; ties by order.

    The threshold rises from 0 by doubling, and an entry leaves when it has a title within it: titles that are as near are
    then all found. So an entry meets titles about as far as its best, not all of its book.
    """
    titles = materialize(headings.select("book", F.col("ord").alias("h"), F.col("key").alias("other"), F.length("key").alias("size")), "titles")
    asked = materialize(unmatched.select("book", "ord", "key").join(titles.select("book").distinct(), "book", "left_semi"), "asked")
    longest = max(asked.agg(F.max(F.length("key"))).first()[0] or 0, titles.agg(F.max("size")).first()[0] or 0)
    out, most = None, 0
    while True:
        near = titles_within(asked, titles, most).groupBy("book", "ord").agg(F.min(F.struct("d", "h", "other")).alias("b"))
        near = materialize(near.select("book", "ord", F.col("b.other").alias("nearest"), F.col("b.d").alias("distance")), "nearest")
        out = near if out is None else out.unionByName(near)
        asked = materialize(asked.join(near, ["book", "ord"], "left_anti"), "asked")
        if most >= longest or asked.isEmpty():
            return out
        most = max(1, 2 * most)


def levels_by_indent(entries: DataFrame, tolerance: float = 1.2) -> DataFrame:
    """Adds ``level`` (from 0): the rank of an entry's indent (``x0``) among its book's clusters of indents."""
    columns = cluster_means(entries, "book", "x0", tolerance).groupBy("book").agg(F.array_sort(F.collect_list("mean")).alias("_means"))
    gaps = F.transform("_means", lambda m: F.abs(m - F.col("x0")))
    return entries.join(columns, "book").withColumn("level", F.array_position(gaps, F.array_min(gaps)).cast("int") - 1).drop("_means")


def _tree(last_page: int):
    def fold(rows: list[tuple]) -> Iterator[tuple]:
        ends = {o: n for o, _, n in folds.next_greater([(o, page if page is not None else 0) for o, _, page in rows])}
        up = dict(folds.parents([(o, level) for o, level, _ in rows]))
        paths, seen = {}, {}
        for o, level, _ in rows:
            n = seen[up[o], level] = seen.get((up[o], level), 0) + 1
            paths[o] = f"{paths[up[o]]}.{n}" if up[o] is not None else str(n)
            yield o, up[o], n, paths[o], (ends[o] - 1 if ends[o] is not None else last_page)

    return fold


def build_outline(entries: DataFrame, headings: DataFrame, offset: int, last_page: int, reach: int | None = None) -> DataFrame:
    """``book, ord, level, title, page, matched, parent, sibling, path, end_page`` of a contents list.

    ``entries`` has ``book, ord, title, x0, printed``; ``headings`` has ``book, ord, title, page``. Depth is the rank
    of the indent; a page is that of the matched heading, else the printed one by ``offset``; a section ends before the
    next one that starts on a later page. With ``reach``, a heading of the same title counts only that many pages from the
    printed one, so that an entry without a heading of its own doesn't take another entry's.
    """
    e = levels_by_indent(entries.withColumn("title", X.tidy_title(F.col("title")))).withColumn("key", X.title_key(F.col("title"))).withColumn("want", F.col("printed") + offset)
    found = match_headings(e, headings.withColumn("key", X.title_key(F.col("title"))), reach)
    placed = e.join(found.select("book", "ord", F.col("page").alias("_page")), ["book", "ord"])
    placed = placed.select("book", F.col("ord").cast("long").alias("ord"), "level", "title", F.coalesce("_page", "want").cast("long").alias("page"), F.col("_page").isNotNull().alias("matched"))
    tree = folds.folded(placed, "book", ["ord", "level", "page"], _tree(last_page), "ord long, parent long, sibling int, path string, end_page long")
    return placed.join(tree, ["book", "ord"])
