"""Queries for joins, windows, ordered folds, limits, set operations, ledgers and gates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.operators import corpus as C
from textloom.operators import review as R
from textloom.plans.corpus_queries import LINES, STOP, TOKENS, docs
from textloom.session import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


SPLIT = r"[\s.,;:!?]+"


# --- joins ----------------------------------------------------------------------------------


@query("SELECT doc_id, lang, CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' WHEN 'de' THEN 'German' ELSE upper(lang) END AS value, lang IN ('en', 'fr', 'de') AS known FROM documents")
def decode_default(spark, d):
    dim = spark.createDataFrame([("en", "English"), ("fr", "French"), ("de", "German")], "lang string, value string")
    return C.decode(docs(spark, d).select("doc_id", "lang"), "lang", dim, F.upper("lang"))


@query("SELECT range AS doc_id FROM range((SELECT max(doc_id) + 5 FROM documents)) WHERE range NOT IN (SELECT doc_id FROM labels)")
def coverage_gaps(spark, d):
    top = docs(spark, d).agg(F.max("doc_id")).first()[0]
    return spark.range(top + 5).select(F.col("id").alias("doc_id")).join(table(spark, d, "labels"), "doc_id", "left_anti")


@query("""WITH a AS (SELECT doc_id, substr(sha1(text), 1, 12) AS h FROM documents WHERE doc_id % 7 <> 0), b AS (SELECT doc_id, substr(sha1(CASE WHEN doc_id % 5 = 0 THEN text || '!' ELSE text END), 1, 12) AS h FROM documents WHERE doc_id % 11 <> 0)
  SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN b.doc_id IS NULL THEN 'missing' WHEN a.doc_id IS NULL THEN 'orphan' WHEN a.h = b.h THEN 'same' ELSE 'edited' END AS status FROM a FULL JOIN b ON a.doc_id = b.doc_id""")
def reconcile_ledger(spark, d):
    # The two versions are made from one table by a rule, so that every status occurs.
    a = docs(spark, d).where("doc_id % 7 <> 0").select("doc_id", X.content_hash(F.col("text")).alias("h"))
    b = docs(spark, d).where("doc_id % 11 <> 0").select("doc_id", X.content_hash(F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))).alias("h"))
    return C.reconcile(a, b, "doc_id", "h", "h")


@query("SELECT l.doc_id FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id AND d.n_chars > 1000)")
def ghost_keys(spark, d):
    return table(spark, d, "labels").select("doc_id").join(docs(spark, d).where("n_chars > 1000"), "doc_id", "left_anti")


@query("""WITH u AS (SELECT conv_id, turn FROM conversations WHERE role = 'user'), e AS (SELECT conv_id, turn FROM conversations WHERE role = 'assistant')
  SELECT e.conv_id, e.turn, u.turn AS asked FROM e ASOF LEFT JOIN u ON e.conv_id = u.conv_id AND e.turn >= u.turn""")
def as_of_turn(spark, d):
    c = table(spark, d, "conversations")
    asked = c.where("role = 'user'").select("conv_id", "turn", F.col("turn").alias("asked"))
    return C.as_of(c.where("role = 'assistant'"), asked, "conv_id", "turn", "asked")


@query("""WITH b AS (SELECT doc_id // 100 AS chunk, min(n_chars) AS lo, max(n_chars) AS hi FROM documents GROUP BY 1), p AS (SELECT page_id, length(html) AS n FROM pages)
  SELECT chunk, count(page_id) AS pages FROM b LEFT JOIN p ON n BETWEEN lo AND hi GROUP BY chunk""")
def range_sections(spark, d):
    # A range join as two sorted counts: pages up to hi minus pages below lo, by one window over the union.
    b = docs(spark, d).groupBy(F.expr("doc_id div 100").alias("chunk")).agg(F.min("n_chars").alias("lo"), F.max("n_chars").alias("hi"))
    return R.count_in_ranges(b, table(spark, d, "pages").select(F.length("html").cast("long").alias("n")), "chunk", "lo", "hi", "n", "pages")


@query("""WITH a AS (SELECT doc_id, lang, n_chars FROM documents WHERE doc_id % 50 = 0), c AS (SELECT a.doc_id, b.doc_id AS match, abs(a.n_chars - b.n_chars) AS gap, row_number() OVER (PARTITION BY a.doc_id ORDER BY abs(a.n_chars - b.n_chars), b.doc_id) AS k FROM a JOIN documents b ON a.lang = b.lang AND a.doc_id <> b.doc_id)
  SELECT doc_id, match, gap FROM c WHERE k = 1""")
def nearest_match(spark, d):
    # Nearest other row by size inside a language: every 50th row is a query, against all rows.
    t = docs(spark, d).select("doc_id", "lang", "n_chars")
    return R.nearest(t.where("doc_id % 50 = 0"), t, "lang", "n_chars", "doc_id")


@query(f"WITH {TOKENS}, b AS (SELECT item_id, string_split(text, ' ')[1:3] AS h FROM benchmark), k AS (SELECT item_id, lower(array_to_string(h, ' ')) AS phrase FROM b) SELECT item_id, phrase, count(*) AS docs, sum((length(lower(text)) - length(replace(lower(text), phrase, ''))) // length(phrase)) AS hits FROM k JOIN documents ON contains(lower(text), phrase) GROUP BY ALL")
def dictionary_hits(spark, d):
    phrases = table(spark, d, "benchmark").select("item_id", F.lower(F.array_join(F.slice(F.split("text", " "), 1, 3), " ")).alias("phrase"))
    return R.phrase_hits(docs(spark, d).select("doc_id", F.lower("text").alias("text")), phrases, "item_id")


@query("""WITH t AS (SELECT DISTINCT sha1(text) AS h, source FROM documents) SELECT a.source AS a, b.source AS b, count(*) AS shared FROM t a JOIN t b ON a.h = b.h AND a.source < b.source GROUP BY ALL""")
def pairs_in_groups(spark, d):
    # A group's members are distinct sources, so a hot text has as many as there are sources.
    t = docs(spark, d).select(F.sha1("text").alias("h"), "source").distinct().groupBy("h").agg(F.array_sort(F.collect_list("source")).alias("s")).where(F.size("s") > 1)
    pairs = F.flatten(F.transform("s", lambda a: F.transform(F.filter("s", lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return t.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("shared"))


@query(f"""WITH {TOKENS}, {"lex AS (SELECT DISTINCT unnest(list_filter(string_split_regex(lower(text), '[' || chr(92) || 's.,;:!?]+'), lambda x: x <> '')) AS token FROM benchmark)"}, o AS (SELECT token, count(*) AS n FROM toks GROUP BY token)
  SELECT s AS suffix, count(*) AS forms, sum(o.n) AS weight, sum(CASE WHEN lex.token IS NOT NULL THEN o.n ELSE 0 END) AS known FROM o, (SELECT unnest(['', 's', 'ed', 'ing']) AS s) LEFT JOIN lex ON lex.token = o.token || s GROUP BY s""")
def candidate_suffixes(spark, d):
    # Every form with every candidate suffix: a generator over a fixed list, then an equi-join.
    o = C.census(C.tokens(docs(spark, d).select(F.lower("text").alias("text")), [], separators=SPLIT), ["token"])
    lex = C.tokens(table(spark, d, "benchmark").select(F.lower("text").alias("text")), [], separators=SPLIT).select("token").distinct().withColumn("k", F.lit(1))
    c = o.withColumn("suffix", F.explode(F.array(*[F.lit(s) for s in ("", "s", "ed", "ing")]))).withColumn("token", F.concat("token", "suffix"))
    return c.join(lex, "token", "left").groupBy("suffix").agg(F.count(F.lit(1)).alias("forms"), F.sum("n").alias("weight"), F.sum(F.expr("n * coalesce(k, 0)")).alias("known"))


@query("""WITH o AS (SELECT doc_id, substr(sha1(text), 1, 12) AS h, 'ok' AS verdict FROM documents WHERE doc_id % 3 = 0), n AS (SELECT doc_id, substr(sha1(CASE WHEN doc_id % 4 = 0 THEN text || ' x' ELSE text END), 1, 12) AS h FROM documents)
  SELECT n.doc_id, n.h, coalesce(o.verdict, 'todo') AS verdict FROM n LEFT JOIN o ON n.doc_id = o.doc_id AND n.h = o.h""")
def carry_over(spark, d):
    old = docs(spark, d).where("doc_id % 3 = 0").select("doc_id", X.content_hash(F.col("text")).alias("h"), F.lit("ok").alias("verdict"))
    new = docs(spark, d).select("doc_id", X.content_hash(F.when(F.col("doc_id") % 4 == 0, F.concat("text", F.lit(" x"))).otherwise(F.col("text"))).alias("h"))
    return new.join(old, ["doc_id", "h"], "left").select("doc_id", "h", F.coalesce("verdict", F.lit("todo")).alias("verdict"))


@query(f"WITH {LINES}, l AS (SELECT doc_id, line_no AS ord, least(4, length(line) // 100) AS level FROM lines) SELECT doc_id, ord, (SELECT max(p.ord) FROM l p WHERE p.doc_id = l.doc_id AND p.ord < l.ord AND p.level < l.level) AS parent FROM l")
def parent_lookup(spark, d):
    t = C.lines(docs(spark, d), "doc_id").select("doc_id", F.col("line_no").alias("ord"), F.least(F.lit(4), F.floor(F.length("line") / 100)).cast("int").alias("level"))
    return C.parent_of(t, "doc_id", "ord", "level")


@query("SELECT lang, count(*) AS shared, count(*) FILTER (quality = 1) AS agree, count(*) FILTER (quality <> 1) AS disagree FROM documents JOIN labels USING (doc_id) GROUP BY lang")
def mapping_agreement(spark, d):
    j = docs(spark, d).select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id")
    return j.groupBy("lang").agg(F.count(F.lit(1)).alias("shared"), F.count_if(F.col("quality") == 1).alias("agree"), F.count_if(F.col("quality") != 1).alias("disagree"))


@query("""WITH w AS (SELECT conv_id, turn, list_distinct(list_filter(string_split_regex(lower(text), '[\\s.,;:!?]+'), lambda x: length(x) > 2)) AS ws FROM conversations)
  SELECT a.conv_id, a.turn, round(len(list_intersect(a.ws, b.ws)) / greatest(len(a.ws), len(b.ws), 1), 9) AS similarity FROM w a JOIN w b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""".replace("\\\\", "\\"))
def adjacent_turn_similarity(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", X.words(F.lower("text"), SPLIT).alias("w"))
    n = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("w").alias("v"))
    return c.join(n, ["conv_id", "turn"]).select("conv_id", "turn", F.round(X.token_overlap(F.col("w"), F.col("v")), 9).alias("similarity"))


# --- windows --------------------------------------------------------------------------------


_HEADINGS = "h AS (SELECT page_id, unnest(range(len(m))) AS pos, CAST(substr(unnest(m), 3, 1) AS INT) AS level FROM (SELECT page_id, regexp_extract_all(lower(html), '<h[1-6][ >]') AS m FROM pages))"


def headings(spark, d):
    m = F.regexp_extract_all(F.lower("html"), F.lit("<h([1-6])[ >]"), F.lit(1))
    return table(spark, d, "pages").select("page_id", F.posexplode(m).alias("pos", "level")).withColumn("level", F.col("level").cast("int"))


@query(f"WITH {_HEADINGS} SELECT page_id, pos, level, row_number() OVER (PARTITION BY page_id, level ORDER BY pos) AS sibling FROM h")
def heading_outline(spark, d):
    return headings(spark, d).withColumn("sibling", F.row_number().over(Window.partitionBy("page_id", "level").orderBy("pos")))


@query(f"WITH {LINES}, l AS (SELECT doc_id, line_no, length(line) // 100 AS level, line = lag(line) OVER w AS repeated, length(line) // 100 - lag(length(line) // 100) OVER w AS jump FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)) SELECT doc_id, line_no, jump, coalesce(repeated, false) AS repeated FROM l WHERE jump > 1 OR repeated")
def level_jumps(spark, d):
    w = Window.partitionBy("doc_id").orderBy("line_no")
    t = C.lines(docs(spark, d), "doc_id").withColumn("level", F.floor(F.length("line") / 100))
    t = t.withColumn("jump", F.col("level") - F.lag("level").over(w)).withColumn("repeated", F.coalesce(F.col("line") == F.lag("line").over(w), F.lit(False)))
    return t.where("jump > 1 OR repeated").select("doc_id", "line_no", "jump", "repeated")


@query("WITH l AS (SELECT conv_id, turn, turn - lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS step, role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS again FROM conversations) SELECT conv_id, count(*) AS turns, count(*) FILTER (step <> 1) AS breaks, count(*) FILTER (again) AS same_role FROM l GROUP BY conv_id")
def turn_sequence_check(spark, d):
    w = Window.partitionBy("conv_id").orderBy("turn")
    t = table(spark, d, "conversations").select("conv_id", (F.col("turn") - F.lag("turn").over(w)).alias("step"), (F.col("role") == F.lag("role").over(w)).alias("again"))
    return t.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), F.count_if(F.col("step") != 1).alias("breaks"), F.count_if("again").alias("same_role"))


@query(f"WITH {LINES}, l AS (SELECT doc_id, line_no, length(line) // 50 AS page FROM lines), n AS (SELECT l.doc_id, l.line_no, arg_min(n.page, n.line_no) AS end_page FROM l JOIN l n ON n.doc_id = l.doc_id AND n.line_no > l.line_no AND n.page > l.page GROUP BY ALL) SELECT doc_id, line_no, page, end_page FROM l LEFT JOIN n USING (doc_id, line_no)")
def section_end(spark, d):
    t = C.lines(docs(spark, d), "doc_id").select("doc_id", "line_no", F.floor(F.length("line") / 50).alias("page"))
    return R.next_greater(t, "doc_id", "line_no", "page", "end_page")


@query(f"""WITH {LINES}, k AS (SELECT doc_id, line_no, CASE WHEN length(line) < 76 THEN 'short' ELSE 'long' END AS kind FROM lines), g AS (SELECT *, line_no - row_number() OVER (PARTITION BY doc_id, kind ORDER BY line_no) AS grp FROM k)
  SELECT doc_id, kind, min(line_no) AS first, max(line_no) AS last, count(*) AS n FROM g GROUP BY doc_id, kind, grp""")
def line_islands(spark, d):
    k = C.lines(docs(spark, d), "doc_id").withColumn("kind", F.when(F.length("line") < 76, "short").otherwise("long"))
    return C.islands(k, "doc_id", "line_no", "kind").drop("island")


@query(f"""WITH {LINES}, k AS (SELECT doc_id, line_no, trim(line) AS line, length(trim(line)) < 76 AS short FROM lines), g AS (SELECT *, line_no - row_number() OVER (PARTITION BY doc_id, short ORDER BY line_no) AS grp FROM k)
  SELECT doc_id, min(line_no) AS start_line, count(*) AS n_lines, substr(sha1(string_agg(line, chr(10) ORDER BY line_no)), 1, 12) AS text_hash FROM g WHERE short GROUP BY doc_id, grp HAVING count(*) >= 2""")
def verse_units(spark, d):
    return R.verse_units(docs(spark, d), "doc_id", limit=76)


@query(f"WITH {TOKENS}, s AS (SELECT doc_id, token, sum(CASE WHEN token IN ({', '.join(repr(s) for s in STOP)}) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS seg, token IN ({', '.join(repr(s) for s in STOP)}) AS stop FROM toks) SELECT doc_id, seg, count(*) AS n FROM s WHERE NOT stop GROUP BY doc_id, seg HAVING count(*) >= 8")
def delimiter_segments(spark, d):
    t = C.tokens(docs(spark, d).select("doc_id", F.lower("text").alias("text")), ["doc_id"], separators=SPLIT).withColumn("stop", F.col("token").isin(STOP))
    w = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return t.withColumn("seg", F.sum(F.col("stop").cast("int")).over(w)).where("NOT stop").groupBy("doc_id", "seg").agg(F.count(F.lit(1)).alias("n")).where("n >= 8")


@query(f"WITH {LINES}, o AS (SELECT doc_id, line_no, length(line) AS n, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM lines) SELECT doc_id, hit, line_no, hit - start AS at FROM o JOIN (SELECT unnest([0, 100, 500, 2000, 10000]) AS hit) ON hit >= start AND hit < start + n + 1")
def producer_index(spark, d):
    # Offsets into a text, mapped to the line that made the character there.
    w = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    t = C.lines(docs(spark, d), "doc_id").select("doc_id", "line_no", F.length("line").alias("n"), F.coalesce(F.sum(F.length("line") + 1).over(w), F.lit(0)).alias("start"))
    hits = t.withColumn("hit", F.explode(F.array(*[F.lit(x) for x in (0, 100, 500, 2000, 10000)])))
    return hits.where("hit >= start AND hit < start + n + 1").select("doc_id", "hit", "line_no", (F.col("hit") - F.col("start")).alias("at"))


@query(f"""WITH {LINES}, m AS (SELECT doc_id, list_sort(list(length(line))) AS v FROM lines GROUP BY doc_id), f AS (SELECT doc_id, line_no, length(line) AS n, lag(length(line)) OVER (PARTITION BY doc_id ORDER BY line_no) AS prev FROM lines),
  b AS (SELECT f.doc_id, line_no, sum(CASE WHEN prev IS NULL OR prev < v[CAST(floor((len(v) - 1) * 0.5) AS INT) + 1] THEN 1 ELSE 0 END) OVER (PARTITION BY f.doc_id ORDER BY line_no) AS para FROM f JOIN m USING (doc_id)) SELECT doc_id, para, count(*) AS n_lines FROM b GROUP BY doc_id, para""")
def paragraph_breaks(spark, d):
    return R.paragraphs(docs(spark, d), "doc_id", q=0.5)


@query("SELECT conv_id, turn, left(text, 90) AS head, right(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), 90) AS tail FROM conversations")
def boundary_context(spark, d):
    c = table(spark, d, "conversations")
    return c.select("conv_id", "turn", F.left("text", F.lit(90)).alias("head"), F.right(F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn")), F.lit(90)).alias("tail"))


@query(f"WITH {LINES}, c AS (SELECT doc_id, line_no, len(regexp_extract_all(line, ',')) - len(regexp_extract_all(line, '\\.')) AS x FROM lines), r AS (SELECT doc_id, x, sum(x) OVER (PARTITION BY doc_id ORDER BY line_no) AS b FROM c) SELECT doc_id, sum(x) AS balance, min(b) AS least FROM r GROUP BY doc_id")
def running_balance(spark, d):
    t = C.lines(docs(spark, d), "doc_id")
    return C.running_balance(t, "doc_id", "line_no", F.regexp_count("line", F.lit(",")) - F.regexp_count("line", F.lit(r"\.")))


@query("WITH l AS (SELECT conv_id, turn, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM conversations) SELECT conv_id, turn, right(prev, 1) <> '.' AS open, regexp_matches(text, '^[a-zéèàçê]') AS continues FROM l WHERE prev IS NOT NULL")
def continuation_pairs(spark, d):
    w = Window.partitionBy("conv_id").orderBy("turn")
    t = table(spark, d, "conversations").withColumn("prev", F.lag("text").over(w)).where("prev IS NOT NULL")
    return t.select("conv_id", "turn", (F.right("prev", F.lit(1)) != ".").alias("open"), F.col("text").rlike("^[a-zéèàçê]").alias("continues"))


# --- folds, limits, sets --------------------------------------------------------------------


_ORDERED = f"{LINES}, v AS (SELECT doc_id, line_no, length(line) AS v, row_number() OVER (PARTITION BY doc_id ORDER BY length(line)) AS i, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS j FROM lines)"


@query(f"""WITH RECURSIVE {_ORDERED}, f AS (SELECT doc_id, i, 1 AS cluster, CAST(v AS DOUBLE) AS s, 1 AS n FROM v WHERE i = 1 UNION ALL
    SELECT f.doc_id, v.i, CASE WHEN abs(s / n - v.v) < 12 THEN cluster ELSE cluster + 1 END, CASE WHEN abs(s / n - v.v) < 12 THEN s + v.v ELSE v.v END, CASE WHEN abs(s / n - v.v) < 12 THEN n + 1 ELSE 1 END FROM f JOIN v ON v.doc_id = f.doc_id AND v.i = f.i + 1)
  SELECT doc_id, cluster, round(arg_max(s / n, i), 6) AS mean, max(n) AS n FROM f GROUP BY doc_id, cluster""")
def cluster_rank(spark, d):
    """Line lengths of each document, clustered by running mean; clusters are ranked by mean."""
    t = C.lines(docs(spark, d), "doc_id").select("doc_id", F.length("line").alias("v"))
    return C.cluster_means(t, "doc_id", "v", 12.0)


@query(f"""WITH RECURSIVE {_ORDERED}, f AS (SELECT doc_id, j, 1 AS span, v AS total FROM v WHERE j = 1 UNION ALL
    SELECT f.doc_id, v.j, CASE WHEN total + v.v <= 1200 THEN span ELSE span + 1 END, CASE WHEN total + v.v <= 1200 THEN total + v.v ELSE v.v END FROM f JOIN v ON v.doc_id = f.doc_id AND v.j = f.j + 1)
  SELECT doc_id, span, min(j) - 1 AS first, max(j) - 1 AS last, arg_max(total, j) AS total FROM f GROUP BY doc_id, span""")
def greedy_merge(spark, d):
    """Neighbouring lines merged while a chunk stays within 1200 characters."""
    t = C.lines(docs(spark, d), "doc_id").select("doc_id", "line_no", F.length("line").alias("size"))
    return C.greedy_spans(t, "doc_id", "line_no", "size", 1200)


@query("""WITH s AS (SELECT doc_id, n_chars, greatest(1, CAST(round(n_chars / 800) AS INT)) AS k FROM documents WHERE n_chars > 0), p AS (SELECT doc_id, n_chars, k, unnest(range(1, k + 1)) AS part FROM s)
  SELECT doc_id, part, CAST(floor((part - 1) * n_chars / k) AS BIGINT) AS start, CAST(floor(part * n_chars / k) - floor((part - 1) * n_chars / k) AS BIGINT) AS length FROM p""")
def equal_split(spark, d):
    return C.equal_parts(docs(spark, d), "doc_id", "n_chars", 800)


@query("SELECT doc_id FROM documents WHERE n_chars > 0 AND (doc_id % 9 = 0 AND round(n_chars / 800) >= 2 OR doc_id % 10 = 0)")
def chunk_coverage(spark, d):
    """Coverage proof: documents whose parts don't tile them. Some lost a part here, and some have one twice."""
    p = C.equal_parts(docs(spark, d), "doc_id", "n_chars", 800).where("NOT (doc_id % 9 = 0 AND part = 2)")
    p = p.unionByName(p.where("doc_id % 10 = 0 AND part = 1"))
    w = Window.partitionBy("doc_id").orderBy("start")
    p = p.withColumn("gap", F.coalesce(F.lag(F.col("start") + F.col("length")).over(w), F.lit(0)) != F.col("start"))
    g = p.groupBy("doc_id").agg(F.bool_or("gap").alias("torn"), F.max(F.col("start") + F.col("length")).alias("high"))
    j = docs(spark, d).where("n_chars > 0").select("doc_id", "n_chars").join(g, "doc_id", "left")
    return j.where("torn IS NULL OR torn OR high <> n_chars").select("doc_id")


@query("WITH q AS (SELECT doc_id, lang, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 100) SELECT lang, list(doc_id ORDER BY doc_id) AS ids, count(*) AS n FROM q GROUP BY lang")
def priority_batch(spark, d):
    q = docs(spark, d).select("doc_id", "lang", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(100)
    return q.groupBy("lang").agg(F.array_sort(F.collect_list("doc_id")).alias("ids"), F.count(F.lit(1)).alias("n"))


@query("SELECT conv_id, turn, role FROM conversations WHERE conv_id IN (SELECT DISTINCT conv_id FROM conversations ORDER BY conv_id LIMIT 5)")
def first_groups(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", "role")
    return c.join(F.broadcast(c.select("conv_id").distinct().orderBy("conv_id").limit(5)), "conv_id", "left_semi")


@query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) ORDER BY doc_id LIMIT 1")
def first_todo(spark, d):
    return docs(spark, d).select("doc_id").join(table(spark, d, "labels"), "doc_id", "left_anti").orderBy("doc_id").limit(1)


@query("SELECT 'union' AS op, count(*) AS n FROM (SELECT doc_id FROM labels WHERE toxic = 1 UNION SELECT doc_id FROM labels WHERE quality = 0) UNION ALL SELECT 'intersect', count(*) FROM (SELECT doc_id FROM labels WHERE toxic = 1 INTERSECT SELECT doc_id FROM labels WHERE quality = 0) UNION ALL SELECT 'except', count(*) FROM (SELECT doc_id FROM labels WHERE toxic = 1 EXCEPT SELECT doc_id FROM labels WHERE quality = 0)")
def set_operations(spark, d):
    a, b = (table(spark, d, "labels").where(x).select("doc_id") for x in ("toxic = 1", "quality = 0"))
    one = lambda name, df: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("op"), "n")
    return one("union", a.union(b).distinct()).unionByName(one("intersect", a.intersect(b))).unionByName(one("except", a.exceptAll(b).distinct()))


@query("SELECT source, sha1(text) AS hash, min(doc_id) AS doc_id FROM documents GROUP BY source, text")
def keep_first(spark, d):
    return docs(spark, d).groupBy("source", F.sha1("text").alias("hash")).agg(F.min("doc_id").alias("doc_id"))


# --- ledgers, gates, typography -------------------------------------------------------------


@query("SELECT doc_id, substr(sha1(text), 1, 12) AS content_hash, lpad(CAST(doc_id AS VARCHAR), 8, '0') AS code, octet_length(encode(text)) AS bytes FROM documents")
def content_hash_ledger(spark, d):
    return docs(spark, d).select("doc_id", X.content_hash(F.col("text")).alias("content_hash"), F.lpad(F.col("doc_id").cast("string"), 8, "0").alias("code"), F.octet_length("text").cast("long").alias("bytes"))


#: Hard checks (none allowed) and counters (at most so many), as SQL for either engine.
_CHECKS = {
    "id_twice": ("documents", "count(*) - count(DISTINCT doc_id)", 0), "no_text": ("documents", "count(CASE WHEN text IS NULL THEN 1 END)", 0), "size_wrong": ("documents", "count(CASE WHEN n_chars <> length(text) THEN 1 END)", 0),
    "no_source": ("documents", "count(CASE WHEN source IS NULL THEN 1 END)", 0), "label_twice": ("labels", "count(*) - count(DISTINCT doc_id)", 0), "label_wrong": ("labels", "count(CASE WHEN NOT quality IN (0, 1) OR NOT toxic IN (0, 1) THEN 1 END)", 0),
    "turn_negative": ("conversations", "count(CASE WHEN turn < 0 THEN 1 END)", 0), "no_heading": ("pages", "count(CASE WHEN NOT lower(html) LIKE '%<h1%' THEN 1 END)", 0), "item_blank": ("benchmark", "count(CASE WHEN trim(text) = '' THEN 1 END)", 0),
    "docs": ("documents", "count(*)", 1000000), "blank": ("documents", "count(CASE WHEN trim(text) = '' THEN 1 END)", 0), "short": ("documents", "count(CASE WHEN n_chars < 100 THEN 1 END)", 100),
    "long": ("documents", "count(CASE WHEN n_chars > 10000 THEN 1 END)", 30), "toxic": ("labels", "count(CASE WHEN toxic = 1 THEN 1 END)", 20), "long_turns": ("conversations", "count(CASE WHEN length(text) > 2000 THEN 1 END)", 5),
}


@query("WITH c AS (" + " UNION ALL ".join(f"SELECT '{n}' AS name, {e} AS value FROM {t}" for n, (t, e, _) in _CHECKS.items()) + "), b AS (SELECT * FROM (VALUES ('gone', 0), " + ", ".join(f"('{n}', {m})" for n, (_, _, m) in _CHECKS.items()) + ") t(name, most)) SELECT b.name, value, most, coalesce(value <= most, false) AS ok FROM b LEFT JOIN c USING (name)")
def invariant_gate(spark, d):
    """Nine hard checks and six counters against a baseline; a counter that is missing fails. One pass a table."""
    found = None
    for name in dict.fromkeys(t for t, _, _ in _CHECKS.values()):
        own = {n: e for n, (t, e, _) in _CHECKS.items() if t == name}
        part = table(spark, d, name).agg(*[F.expr(e).alias(n) for n, e in own.items()]).selectExpr(f"stack({len(own)}, {', '.join(f'{chr(39)}{n}{chr(39)}, {n}' for n in own)}) AS (name, value)")
        found = part if found is None else found.unionByName(part)
    return R.gate(found, spark.createDataFrame([("gone", 0), *[(n, m) for n, (_, _, m) in _CHECKS.items()]], "name string, most long"))


@query(r"SELECT conv_id, turn, levenshtein(text, prev) AS distance FROM (SELECT conv_id, turn, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM (SELECT conv_id, turn, regexp_replace(text, '[^\x00-\x7F]', '?', 'g') AS text FROM conversations)) WHERE prev IS NOT NULL")
def edit_distance(spark, d):
    """Whole texts of neighbouring turns; letters beyond ASCII count as one, as engines differ in counting them."""
    t = table(spark, d, "conversations").select("conv_id", "turn", F.regexp_replace("text", r"[^\x00-\x7F]", "?").alias("text"))
    t = t.withColumn("prev", F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))).where("prev IS NOT NULL")
    return t.select("conv_id", "turn", F.levenshtein("text", "prev").alias("distance"))


@query(r"""WITH l AS (SELECT conv_id, turn, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM conversations),
  s AS (SELECT conv_id, turn, trim(regexp_replace(prev, '\s+', ' ', 'g')) AS a, trim(regexp_replace('> ' || right(prev, CAST(10 + (conv_id * 7 + turn * 31) % 320 AS INT)) || ' ' || text, '^[ \t]*>[ \t]?', '')) AS b0 FROM l WHERE prev IS NOT NULL), n AS (SELECT conv_id, turn, a, trim(regexp_replace(b0, '\s+', ' ', 'g')) AS b FROM s)
  SELECT conv_id, turn, coalesce(list_max(list_filter(range(25, least(300, length(a), length(b)) + 1), lambda k: right(a, CAST(k AS INT)) = left(b, CAST(k AS INT)))), 0) AS overlap FROM n""")
def seam_overlap(spark, d):
    """Turns that restate the end of the one before, in part and in quote marks."""
    t = table(spark, d, "conversations").withColumn("prev", F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))).where("prev IS NOT NULL")
    said = F.concat(F.lit("> "), F.right("prev", (10 + (F.col("conv_id") * 7 + F.col("turn") * 31) % 320).cast("int")), F.lit(" "), "text")
    return t.select("conv_id", "turn", X.suffix_prefix_overlap(X.seam_text(F.col("prev")), X.seam_text(said)).alias("overlap"))


@query("SELECT page_id, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title, regexp_extract(url, '^https?://([^/]+)', 1) AS host, length(regexp_replace(html, '<[^>]*>', '', 'g')) AS text_chars FROM pages")
def page_text(spark, d):
    p = table(spark, d, "pages")
    return p.select("page_id", F.trim(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"), F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), F.length(F.regexp_replace("html", "<[^>]*>", "")).alias("text_chars"))


@query()
def before_after_review(spark, d):
    """Each turn beside the turn before it, of every role: word diff by longest common subsequence (tested against brute force)."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    t = table(spark, d, "conversations").withColumn("before", F.lag("text").over(w)).where("before IS NOT NULL")
    return R.word_diff(t.select("conv_id", "turn", "before", F.col("text").alias("after")), ["conv_id", "turn"])


@query("SELECT lang, source, sum(n_chars) AS chars, count(*) AS n FROM documents GROUP BY ROLLUP (lang, source)")
def ext_rollup(spark, d):
    """Extension: grouping sets."""
    return docs(spark, d).rollup("lang", "source").agg(F.sum("n_chars").alias("chars"), F.count(F.lit(1)).alias("n"))


@query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, sum(l_extendedprice * (1 - l_discount)) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL")
def ext_pricing_summary(spark, d):
    """Extension: a star-schema summary."""
    t = table(spark, d, "lineitem").where("l_shipdate <= TIMESTAMP '1998-09-02'")
    return t.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.sum(F.expr("l_extendedprice * (1 - l_discount)")).alias("revenue"), F.count(F.lit(1)).alias("n"))


@query("SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS n, sum(value) AS total FROM events GROUP BY ALL")
def ext_hourly_events(spark, d):
    """Extension: tumbling windows in batch."""
    t = table(spark, d, "events")
    return t.groupBy("event_type", F.date_trunc("hour", "ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
