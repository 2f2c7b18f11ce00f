"""Queries in which one document holds half of all lines: scans, stacks, spans; and range joins with their pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators import corpus as C
from textloom.operators import scans as S
from textloom.plans.made import Plans
from textloom.session import materialize, table

query = Plans()
QUERIES, ORACLES = query.queries, query.oracles

#: Every second document is a part of one: its lines in the order of the documents.
HOT = "lines AS (SELECT CASE WHEN doc_id % 2 = 0 THEN -1 ELSE doc_id END AS book, doc_id * 1000000 + k AS ord, line FROM (SELECT doc_id, unnest(range(len(ls))) AS k, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)))"


def lines(spark, d):
    t = C.lines(table(spark, d, "documents"), "doc_id")
    return t.select(F.when(F.col("doc_id") % 2 == 0, F.lit(-1)).otherwise(F.col("doc_id")).cast("long").alias("book"), (F.col("doc_id") * 1000000 + F.col("line_no")).alias("ord"), "line")


@query(f"""WITH {HOT}, k AS (SELECT book, ord, length(line) < 76 AS short FROM lines), g AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY ord) - row_number() OVER (PARTITION BY book, short ORDER BY ord) AS grp FROM k)
  SELECT book, short, min(ord) AS first, max(ord) AS last, count(*) AS n FROM g GROUP BY book, short, grp""")
def hot_islands(spark, d):
    return S.islands(lines(spark, d).withColumn("short", F.length("line") < 76), "book", "ord", "short")


@query(f"WITH {HOT}, s AS (SELECT book, length(line) < 40 AS stop, sum(CASE WHEN length(line) < 40 THEN 1 ELSE 0 END) OVER (PARTITION BY book ORDER BY ord) AS seg FROM lines) SELECT book, seg, count(*) AS n FROM s WHERE NOT stop GROUP BY book, seg")
def hot_segments(spark, d):
    return S.segments(lines(spark, d), "book", "ord", F.length("line") < 40)


@query(f"WITH {HOT}, c AS (SELECT book, ord, len(regexp_extract_all(line, ',')) - len(regexp_extract_all(line, '\\.')) AS x FROM lines), r AS (SELECT book, x, sum(x) OVER (PARTITION BY book ORDER BY ord) AS b FROM c) SELECT book, sum(x) AS balance, min(b) AS least FROM r GROUP BY book")
def hot_balance(spark, d):
    return S.balance(lines(spark, d), "book", "ord", F.regexp_count("line", F.lit(",")) - F.regexp_count("line", F.lit(r"\.")))


@query(f"WITH {HOT}, l AS (SELECT book, ord, length(line) // 50 AS page FROM lines) SELECT book, ord, page, (SELECT min(n.ord) FROM l n WHERE n.book = l.book AND n.ord > l.ord AND n.page > l.page) AS end_ord FROM l")
def hot_section_ends(spark, d):
    t = lines(spark, d).select("book", "ord", F.floor(F.length("line") / 50).alias("page"))
    return S.next_greater(t, "book", "ord", "page", "end_ord")


@query(f"WITH {HOT}, l AS (SELECT book, ord, least(4, length(line) // 100) AS level FROM lines) SELECT book, ord, level, (SELECT max(p.ord) FROM l p WHERE p.book = l.book AND p.ord < l.ord AND p.level < l.level) AS parent FROM l")
def hot_parents(spark, d):
    t = lines(spark, d).select("book", "ord", F.least(F.lit(4), F.floor(F.length("line") / 100)).cast("long").alias("level"))
    return S.parent_of(t, "book", "ord", "level")


@query(f"""WITH RECURSIVE {HOT}, v AS (SELECT book, ord, length(line) AS v, row_number() OVER (PARTITION BY book ORDER BY ord) AS j FROM lines),
  f AS (SELECT book, j, ord, 1 AS span, v AS total FROM v WHERE j = 1 UNION ALL
    SELECT f.book, v.j, v.ord, CASE WHEN total + v.v <= 1200 THEN span ELSE span + 1 END, CASE WHEN total + v.v <= 1200 THEN total + v.v ELSE v.v END FROM f JOIN v ON v.book = f.book AND v.j = f.j + 1)
  SELECT book, min(ord) AS first, max(ord) AS last, count(*) AS n, arg_max(total, j) AS total FROM f GROUP BY book, span""")
def hot_spans(spark, d):
    t = lines(spark, d).select("book", "ord", F.length("line").alias("size"))
    return S.greedy_spans(t, "book", "ord", "size", 1200)


@query("""WITH RECURSIVE p AS (SELECT page_id // 25 AS book, page_id % 25 + 1 AS page, page_id % 3 AS level, sha1(url) AS title FROM pages), b AS (SELECT book, min(page) AS first, max(page) AS last FROM p GROUP BY book),
  s AS (SELECT * FROM p WHERE page * (book % 5 + 2) % 7 < 2 AND page <> 1), st AS (SELECT DISTINCT book, page FROM (SELECT book, page FROM s UNION ALL SELECT book, first FROM b)),
  z AS (SELECT st.book, st.page, coalesce(lead(st.page) OVER w, b.last + 1) - st.page AS size, row_number() OVER w AS j FROM st JOIN b USING (book) WINDOW w AS (PARTITION BY st.book ORDER BY st.page)),
  f AS (SELECT book, j, page, 1 AS span, size AS total FROM z WHERE j = 1 UNION ALL
    SELECT f.book, z.j, z.page, CASE WHEN total + size <= 5 THEN span ELSE span + 1 END, CASE WHEN total + size <= 5 THEN total + size ELSE size END FROM f JOIN z ON z.book = f.book AND z.j = f.j + 1),
  m AS (SELECT book, min(page) AS a, arg_max(total, j) AS n FROM f GROUP BY book, span), k AS (SELECT *, CAST(ceil(n / 4.0) AS INT) AS parts FROM m), q AS (SELECT *, unnest(range(1, parts + 1)) AS part, CAST(ceil(n / CAST(parts AS DOUBLE)) AS INT) AS wide FROM k),
  c AS (SELECT book, a + (part - 1) * wide AS first, least(a + part * wide, a + n) - 1 AS last, part, parts FROM q WHERE a + (part - 1) * wide <= least(a + part * wide, a + n) - 1)
  SELECT c.book, c.first, c.last, part, parts, (SELECT count(*) FROM s WHERE s.book = c.book AND s.page BETWEEN c.first AND c.last) AS n_sections,
    coalesce((SELECT arg_min(title, (level, page)) FROM s WHERE s.book = c.book AND s.page BETWEEN c.first AND c.last), (SELECT arg_max(title, page) FROM s WHERE s.book = c.book AND s.page <= c.first)) AS owner, true AS proved FROM c""")
def section_chunking(spark, d):
    """Pages of each book cut to chunks at its sections, with owners, and the proof that they tile the book."""
    p = table(spark, d, "pages").select(F.expr("page_id div 25").alias("book"), (F.col("page_id") % 25 + 1).alias("page"), (F.col("page_id") % 3).alias("level"), F.sha1("url").alias("title"))
    books = p.groupBy("book").agg(F.min("page").alias("first"), F.max("page").alias("last"))
    chunks = materialize(S.section_chunks(p.where("page * (book % 5 + 2) % 7 < 2 AND page <> 1"), books), "section-chunks")
    return chunks.join(S.tiled(chunks, books), "book")


@query("""WITH r AS (SELECT source, lang, min(n_chars) AS low, approx AS high FROM (SELECT source, lang, n_chars, max(n_chars) OVER (PARTITION BY source) AS approx FROM documents) GROUP BY ALL)
  SELECT source, lang, low, high, page_id, n FROM r JOIN (SELECT page_id, length(html) AS n FROM pages) ON n BETWEEN low AND high""")
def range_pairs(spark, d):
    """Each range of sizes with each page whose size it holds; most ranges are wide."""
    t = table(spark, d, "documents").groupBy("source", "lang").agg(F.min("n_chars").alias("low"), F.max("n_chars").alias("_most"))
    top = t.groupBy("source").agg(F.max("_most").alias("high"))
    ranges = t.join(top, "source").select("source", "lang", "low", "high")
    pages = table(spark, d, "pages").select("page_id", F.length("html").cast("long").alias("n"))
    return S.range_pairs(ranges, pages, "low", "high", "n")


@query("""WITH r AS (SELECT doc_id, lang, n_chars AS low, n_chars + doc_id % 7 * 3 AS high FROM documents) SELECT r.doc_id, low, high, t.doc_id AS near, n FROM r JOIN (SELECT doc_id, lang, n_chars AS n FROM documents) t ON t.lang = r.lang AND n BETWEEN low AND high""")
def range_pairs_by_lang(spark, d):
    """Documents whose sizes lie in a narrow range above each document's, in its language."""
    t = table(spark, d, "documents")
    ranges = t.select("doc_id", "lang", F.col("n_chars").alias("low"), (F.col("n_chars") + F.col("doc_id") % 7 * 3).alias("high"))
    return S.range_pairs(ranges, t.select(F.col("doc_id").alias("near"), "lang", F.col("n_chars").alias("n")), "low", "high", "n", group="lang").drop("lang")
