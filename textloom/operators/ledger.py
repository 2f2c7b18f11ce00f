"""Ledgers, batches, chunking, page anchors and merges."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions import text as X
from textloom.operators import corpus as C

RULE_VERSION = 1


def section_chunks(sections: DataFrame, pages: DataFrame, target: int = 4, most: int = 5) -> DataFrame:
    """Sections to chunks: short neighbours are merged to ``most`` pages, long ones split near ``target``.

    ``sections`` has ``book, start_page`` (null pages drop out), ``pages`` has ``book, last_page``.
    Returns ``book, chunk, first, last``.
    """
    w = Window.partitionBy("book").orderBy("start_page")
    s = sections.where("start_page IS NOT NULL").select("book", "start_page").distinct().join(pages, "book")
    s = s.withColumn("size", F.coalesce(F.lead("start_page").over(w), F.col("last_page") + 1) - F.col("start_page"))
    merged = C.greedy_spans(s, "book", "start_page", "size", most)
    parts = F.greatest(F.lit(1), F.ceil(F.col("total") / most)).cast("int")
    parts = F.when(F.col("total") <= most, 1).otherwise(F.greatest(parts, F.round(F.col("total") / target).cast("int")))
    split = merged.select("book", "first", "total", parts.alias("k")).withColumn("part", F.explode(F.sequence(F.lit(1), F.col("k"))))
    a = F.floor((F.col("part") - 1) * F.col("total") / F.col("k")) + F.col("first")
    b = F.floor(F.col("part") * F.col("total") / F.col("k")) + F.col("first") - 1
    out = split.select("book", a.cast("long").alias("first"), b.cast("long").alias("last"))
    return out.withColumn("chunk", F.row_number().over(Window.partitionBy("book").orderBy("first"))).select("book", "chunk", "first", "last")


def coverage_problems(chunks: DataFrame, first: int, last: int) -> DataFrame:
    """Pages of ``first..last`` in no chunk or in several: ``book, page, n``; empty is the proof."""
    spans = chunks.select("book", F.explode(F.sequence("first", "last")).alias("page"))
    wanted = chunks.select("book").distinct().withColumn("page", F.explode(F.sequence(F.lit(first).cast("long"), F.lit(last).cast("long"))))
    n = wanted.join(spans.groupBy("book", "page").agg(F.count(F.lit(1)).alias("n")), ["book", "page"], "full")
    return n.withColumn("n", F.coalesce("n", F.lit(0))).where("n <> 1")


def refresh(current: DataFrame, ledger: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Incremental refresh: ``key, hash, status`` new, stale, fresh or gone, by content hash and rule version."""
    now = current.select(key, X.content_hash(F.col(text)).alias("hash"))
    old = ledger.select(key, F.col("hash").alias("old_hash"), F.col("rule_version").alias("v"))
    j = now.join(old, key, "full")
    status = F.when(F.col("hash").isNull(), "gone").when(F.col("old_hash").isNull(), "new").when((F.col("hash") == F.col("old_hash")) & (F.col("v") == RULE_VERSION), "fresh").otherwise("stale")
    return j.select(key, F.coalesce("hash", "old_hash").alias("hash"), status.alias("status"))


def merge_results(results: DataFrame, settled: DataFrame, key: str = "term", value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Verified results into a settled table: new keys are added, settled ones never overwritten.

    ``results`` has ``key, value, ord, verdict``; the last passing result of a key counts. Returns
    the merged table and the conflicts ``key, value, settled``.
    """
    w = Window.partitionBy(key).orderBy(F.desc("ord"))
    last = results.where("verdict = 'pass'").withColumn("_k", F.row_number().over(w)).where("_k = 1").select(key, F.col(value).alias("_new"))
    j = settled.select(key, F.col(value).alias("_old")).join(last, key, "full")
    merged = j.select(key, F.coalesce("_old", "_new").alias(value))
    conflicts = j.where("_old IS NOT NULL AND _new IS NOT NULL AND _old <> _new").select(key, F.col("_new").alias(value), F.col("_old").alias("settled"))
    return merged, conflicts


def merge_by_kind(rows: DataFrame, key: str, kind: str, order: str, value: str, kinds: tuple[str, ...]) -> DataFrame:
    """``key`` and a column for each of ``kinds``: the last value of each, null where there is none (a full outer merge in one pass)."""
    last = lambda k: F.max_by(F.when(F.col(kind) == k, F.col(value)), F.when(F.col(kind) == k, F.col(order)))
    return rows.groupBy(key).agg(*[last(k).alias(k) for k in kinds])


def select_rows(df: DataFrame, key: str, ids: list | None = None, batch: DataFrame | None = None, ledger: DataFrame | None = None, todo: str | None = None) -> DataFrame:
    """Rows by one selector: explicit ids, the keys of a batch, those of a ledger, or a status predicate."""
    if ids is not None:
        return df.where(F.col(key).isin(ids))
    chosen = batch if batch is not None else ledger
    return df.join(chosen.select(key).distinct(), key, "left_semi") if chosen is not None else df.where(todo)


def require_none(problems: DataFrame, what: str) -> None:
    """Raises if there are problems upstream."""
    if not problems.isEmpty():
        raise ValueError(f"unresolved: {what}")


def place_anchors(anchors: DataFrame, chunks: DataFrame) -> DataFrame:
    """Page anchors: placed only where the locator occurs exactly once in its chunk; ``page, chunk, status, at``."""
    j = anchors.join(chunks.select("chunk", "text"), "chunk", "left")
    at = X.locator_at(F.col("text"), F.col("locator"))
    return j.select("page", "chunk", F.when(at.isNotNull(), "placed").otherwise("open").alias("status"), at.alias("at"))


def accept_placements(proposals: DataFrame, chunks: DataFrame, pages: DataFrame, quoted: int = 24) -> DataFrame:
    """``page, chunk, at, verdict`` of proposed anchors (``page, chunk, locator, quote``); two signals must agree.

    The quote must be how the page opens (its first ``quoted`` characters, white space as single blanks), and the
    locator must occur exactly once in the chunk. The verdict is ``placed`` or the reason against it.
    """
    flat = lambda c: F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
    j = proposals.join(chunks.select("chunk", "text"), "chunk", "left").join(pages.select("page", F.col("text").alias("_page")), "page", "left")
    quote, at = flat(F.coalesce("quote", F.lit(""))), X.locator_at(F.col("text"), F.col("locator"))
    opens = (quote != "") & F.startswith(flat(F.col("_page")), F.left(quote, F.lit(quoted)))
    verdict = F.when(~F.coalesce(opens, F.lit(False)), "quote").when(at.isNull(), "locator").otherwise("placed")
    return j.select("page", "chunk", F.when(verdict == "placed", at).alias("at"), verdict.alias("verdict"))


def revalidate_anchors(anchors: DataFrame, chunks: DataFrame) -> DataFrame:
    """``page, chunk, kind, status, locator``: recorded anchors carried over, those whose locator no longer holds demoted to pending."""
    j = anchors.join(chunks.select("chunk", "text"), "chunk", "left")
    holds = (F.col("kind") == "chunk-start") | F.coalesce(X.locator_at(F.col("text"), F.col("locator")).isNotNull(), F.lit(False))
    return j.select("page", "chunk", "kind", F.when(holds, F.col("status")).otherwise("pending").alias("status"), F.when(holds, F.col("locator")).alias("locator"))


def verse_ledger(units: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """Verse units (``key, start_line, n_lines, text_hash, risk``) with the status their text had in the old ledger, else pending."""
    before = old.groupBy(key, "text_hash").agg(F.max("status").alias("_status"))
    return units.join(before, [key, "text_hash"], "left").withColumn("status", F.coalesce("_status", F.lit("pending"))).drop("_status")


def verse_batch(ledger: DataFrame, key: str, n: int = 40) -> DataFrame:
    """``key, units``: the ``n`` riskiest pending units, by text, in line order."""
    chosen = ledger.where("status = 'pending'").orderBy(F.desc("risk"), key, "start_line").limit(n)
    return chosen.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start_line", "n_lines"))).alias("units"))


#: Marks of a text cut at its end and of one that continues (fixed values).
CLOSE = r"\n*\*\([^)]*(?:tiếp sang|tiếp tục sang)[^)]*\)\*\s*\z"
OPEN = r"\A(\s*>\s?)?\*\(\s*[….]*\s*tiếp theo[^)]*\)\*\s*[….]*\s*"


_QUOTE_MARK = re.compile(r"\s*>\s?")


def _seam(last: str, first: str) -> str:
    """The line that a cut line and its continuation make: one quote mark, one ellipsis, one blank."""
    left, right = last.rstrip(), _QUOTE_MARK.sub("", first, count=1).lstrip() if _QUOTE_MARK.match(first) else first.lstrip()
    return f"{left} {right.removeprefix('…').lstrip() if left.endswith('…') else right}"


def _weld(parts: list[str]) -> str:
    """Fragments as one text: a list of lines, where a fragment's first line goes on the last line so far if both are quoted or neither is."""
    lines: list[str] = []
    for part in parts:
        own = part.split("\n")
        if lines:
            same = bool(_QUOTE_MARK.match(lines[-1])) == bool(_QUOTE_MARK.match(own[0]))
            own[:1] = [_seam(lines.pop(), own[0])] if same else ["", own[0]]
        lines += own
    return "\n".join(lines)


@F.pandas_udf(T.StringType())
def welded(parts: pd.Series) -> pd.Series:
    """Each list of fragments as one text."""
    return parts.map(lambda p: _weld(list(p)))


def assemble(chunks: DataFrame, book: str = "book", order: str = "chunk", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Chunks to a book's parts ``book, part, n, text``; anomalies ``book, chunk, what``; stutters ``book, chunk, overlap``.

    A chunk with a mark that it continues joins one with a mark that it was cut. A mark on one side only is an
    anomaly; a joined chunk that repeats the end of the one before stutters, which is reported and left.
    """
    w = Window.partitionBy(book).orderBy(order)
    bare = F.trim(X.strip_front_matter(F.col(text)))
    t = chunks.select(book, order, bare.rlike(OPEN).alias("open"), bare.rlike(CLOSE).alias("close"), F.trim(F.regexp_replace(F.regexp_replace(bare, OPEN, "$1"), CLOSE, "")).alias("t"))
    t = t.withColumn("before", F.coalesce(F.lag("close").over(w), F.lit(False))).withColumn("prev", F.lag("t").over(w)).withColumn("last", F.lead(order).over(w).isNull())
    what = F.when(F.col("open") & ~F.col("before"), "opens alone").when(~F.col("open") & F.col("before"), "closed before").when(F.col("last") & F.col("close"), "closes last")
    anomalies = t.select(book, order, what.alias("what")).where("what IS NOT NULL")
    overlap = X.suffix_prefix_overlap(X.seam_text(F.col("prev")), X.seam_text(F.col("t")))
    stutters = t.where("open AND before").select(book, order, overlap.alias("overlap")).where("overlap > 0")
    parts = t.withColumn("part", F.sum(F.when(F.col("open") & F.col("before"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = F.transform(F.array_sort(F.collect_list(F.struct(order, "t"))), lambda p: p["t"])
    joined = parts.groupBy(book, "part").agg(F.count(F.lit(1)).alias("n"), pieces.alias("ps")).select(book, "part", "n", welded("ps").alias("text"))
    return joined, anomalies, stutters


def weld(chunks: DataFrame, book: str = "book", order: str = "chunk") -> DataFrame:
    """Chunks folded into paragraphs at seams: one that ends open joins the next that continues.

    Open: no closing mark at the end. Continues: a small letter at the start. ``book, para, n, text``.
    """
    w = Window.partitionBy(book).orderBy(order)
    prev = F.lag("text").over(w)
    joins = prev.isNotNull() & ~F.rtrim(prev).rlike(r"[.!?:][\"”’»)]?$") & F.ltrim("text").rlike(r"^\p{Ll}")
    t = chunks.withColumn("_new", F.when(joins, 0).otherwise(1)).withColumn("para", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct(order, F.trim("text").alias("t"))))
    return t.groupBy(book, "para").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.transform(parts, lambda p: p["t"]), " ").alias("text"))


def same_content(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Texts whose normalised content differs, with the offset of the first difference: ``key, at``."""
    norm = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "")
    j = before.select(key, norm("text").alias("a")).join(after.select(key, norm("text").alias("b")), key)
    return j.where("a <> b").select(key, X.first_difference(F.col("a"), F.col("b")).alias("at"))


def audit_by_group(tokens: DataFrame, group: str, probes: list[str], token: str = "token") -> DataFrame:
    """``group, n_tokens, n_forms, n_collisions, probes``: tokens, distinct ones, case-folded forms with several, and hits of each probe."""
    forms = tokens.groupBy(group, token).agg(F.count(F.lit(1)).alias("n"))
    folded = forms.groupBy(group, F.lower(token).alias("_form")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
    hits = [F.sum(F.when(F.col("_form").contains(p), F.col("n")).otherwise(0)) for p in probes]
    return folded.groupBy(group).agg(F.sum("n").alias("n_tokens"), F.sum("k").alias("n_forms"), F.count_if(F.col("k") > 1).alias("n_collisions"), F.array(*hits).alias("probes"))


def appendix(title: str, counts: dict[str, DataFrame]) -> DataFrame:
    """``ord, line``: a generated appendix, a heading and a line for each measured count (a frame of one number)."""
    spark = next(iter(counts.values())).sparkSession
    out = spark.createDataFrame([(0, f"# {title}")], "ord int, line string")
    for k, (name, df) in enumerate(counts.items(), 1):
        out = out.unionByName(df.select(F.lit(k).alias("ord"), F.concat(F.lit(f"- {name}: "), F.format_number(F.col(df.columns[0]).cast("long"), 0)).alias("line")))
    return out
