"""Queries over documents, pages, conversations, labels and benchmark, each with a DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.operators import corpus as C
from textloom.session import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
STOP = ["the", "of", "and", "to", "in", "is", "a", "de", "la", "le", "und", "die", "der"]
FEATURES = [("commas", ","), ("periods", r"\."), ("capitals", "[A-Z]"), ("digits", "[0-9]"), ("pipes", r"\|"), ("percents", "%"), ("ats", "@"), ("short_words", " [a-z]{1,2} "), ("exclamations", "!"), ("questions", r"\?")]
PROBES = ["th", "tion", "aa", "the", "and", "ing"]


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


#: Shared pieces of the oracles.
LINES = "lines AS (SELECT doc_id, source, lang, unnest(range(len(string_split(text, chr(10))))) AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents)"
WORDS = r"w AS (SELECT doc_id, source, lang, list_filter(string_split_regex(lower(text), '[\s.,;:!?]+'), lambda x: x <> '') AS ws FROM documents)"
TOKENS = rf"{WORDS}, toks AS (SELECT doc_id, source, lang, unnest(ws) AS token, unnest(range(len(ws))) AS pos FROM w)"
#: Tokens of runs between line ends and marks.
RUNS = r"""rs AS (SELECT doc_id, unnest(range(len(x))) AS run, unnest(x) AS r FROM (SELECT doc_id, string_split_regex(lower(text), '[\n.,;:!?]+') AS x FROM documents)), rw AS (SELECT doc_id, run, list_filter(string_split_regex(r, '\s+'), lambda x: x <> '') AS ws FROM rs),
  rt AS (SELECT doc_id, run, unnest(ws) AS token, unnest(range(len(ws))) AS pos FROM rw)"""


@query("SELECT source, sum(n_chars) AS chars, " + ", ".join(f"sum(len(regexp_extract_all(text, '{p}'))) * 1000.0 / sum(n_chars) AS {n}" for n, p in FEATURES) + " FROM documents GROUP BY source")
def style_features(spark, d):
    return docs(spark, d).groupBy("source").agg(F.sum("n_chars").alias("chars"), *[(F.sum(F.regexp_count("text", F.lit(p))) * 1000.0 / F.sum("n_chars")).alias(n) for n, p in FEATURES])


@query(f"WITH {TOKENS} SELECT lang, token, count(*) AS n FROM toks GROUP BY lang, token")
def token_census(spark, d):
    return C.census(C.tokens(docs(spark, d).select("lang", F.lower("text").alias("text")), ["lang"], separators=r"[\s.,;:!?]+"), ["lang", "token"])


@query(r"""WITH w AS (SELECT DISTINCT token, lower(token) AS form FROM (SELECT unnest(string_split_regex(text, '\s+')) AS token FROM documents) WHERE token <> '')
  SELECT form, count(*) AS n_sources, list_sort(list(token)) AS sources FROM w GROUP BY form HAVING count(*) > 1""")
def collision_groups(spark, d):
    t = C.tokens(docs(spark, d), [], separators=r"\s+").select("token", F.lower("token").alias("form"))
    return C.collisions(t, "form", "token")


@query(f"WITH {TOKENS}, c AS (SELECT source, left(token, 1) AS first, count(*) AS n FROM toks GROUP BY ALL) SELECT source, sum(n) AS n_all, sum(n) - max(n) AS n_other FROM c GROUP BY source")
def non_majority(spark, d):
    t = C.tokens(docs(spark, d).select("source", F.lower("text").alias("text")), ["source"], separators=r"[\s.,;:!?]+").withColumn("first", F.left("token", F.lit(1)))
    return C.non_majority(C.census(t, ["source", "first"]), "source")


@query("""WITH c AS (SELECT lang, unnest(string_split(text, '')) AS c FROM documents), k AS (SELECT lang, CASE WHEN unicode(c) < 128 THEN 'ascii' WHEN unicode(c) < 256 THEN 'latin1' ELSE 'other' END AS block FROM c WHERE c <> '')
  SELECT lang, block, count(*) AS n FROM k GROUP BY lang, block""")
def codepoint_census(spark, d):
    # Counted inside each row by class lengths: no row per character.
    t = docs(spark, d).select("lang", F.length("text").alias("all_"), F.length(F.regexp_replace("text", r"[^\x{0}-\x{7f}]", "")).alias("ascii"), F.length(F.regexp_replace("text", r"[^\x{0}-\x{ff}]", "")).alias("low"))
    long = t.groupBy("lang").agg(F.sum("ascii").alias("a"), F.sum("low").alias("l"), F.sum("all_").alias("t"))
    return long.selectExpr("lang", "stack(3, 'ascii', a, 'latin1', l - a, 'other', t - l) AS (block, n)").where("n > 0")


@query("SELECT sha1(text) AS hash, count(*) AS n, list_sort(list(doc_id))[1:6] AS examples FROM documents GROUP BY text HAVING count(*) > 1")
def duplicate_text_groups(spark, d):
    # Six least ids without gathering a group: ranks inside hashed text.
    h = docs(spark, d).select(F.sha1("text").alias("hash"), "doc_id")
    n = h.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    w = Window.partitionBy("hash").orderBy("doc_id")
    first = h.withColumn("k", F.row_number().over(w)).where("k <= 6").groupBy("hash").agg(F.array_sort(F.collect_list("doc_id")).alias("examples"))
    return n.join(first, "hash").select("hash", "n", "examples")


def _gram_oracle(n: int, least: int) -> str:
    gram = " || ' ' || ".join(["token", *[f"lead(token, {k}) OVER p" for k in range(1, n)]])
    return f"SELECT gram, {n} AS n_tokens, count(*) AS count, count(DISTINCT coalesce(l, '^')) AS n_left, count(DISTINCT coalesce(r, '$')) AS n_right FROM (SELECT {gram} AS gram, lag(token) OVER p AS l, lead(token, {n}) OVER p AS r FROM rt WINDOW p AS (PARTITION BY doc_id, run ORDER BY pos)) WHERE gram IS NOT NULL GROUP BY gram HAVING count(*) >= {least}"


def _grams(sizes: tuple[int, ...], least: int) -> str:
    return " UNION ALL ".join(_gram_oracle(n, least) for n in sizes)


@query(f"WITH {RUNS} {_grams((1, 2, 3, 4, 5), 3)}")
def ngram_branching(spark, d):
    return C.branching(docs(spark, d), "doc_id", least=3)


HEAD_STOP, TAIL_STOP = STOP, [*STOP, "an", "on", "für", "et"]


def _in(words: list[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


@query(f"""WITH {RUNS}, b AS ({_grams((2, 3, 4, 5), 5)}), f AS (SELECT *, string_split(gram, ' ') AS w FROM b WHERE least(n_left, n_right) >= 3 AND string_split(gram, ' ')[1] NOT IN {_in(HEAD_STOP)} AND string_split(gram, ' ')[-1] NOT IN {_in(TAIL_STOP)}),
  subs AS (SELECT count, array_to_string(w[i + 1:i + m], ' ') AS gram FROM (SELECT *, unnest(range(0, n_tokens - m + 1)) AS i FROM (SELECT *, unnest(range(1, n_tokens)) AS m FROM f))), top AS (SELECT gram, max(count) AS longer FROM subs GROUP BY gram)
  SELECT f.gram, n_tokens, count, n_left, n_right, round(ln(count) * ln(greatest(least(n_left, n_right), 1)) * (1 + 0.35 * n_tokens), 2) AS score FROM f LEFT JOIN top ON f.gram = top.gram WHERE longer IS NULL OR longer < 0.85 * count""")
def term_candidates(spark, d):
    return C.term_candidates(docs(spark, d), "doc_id", HEAD_STOP, TAIL_STOP, least=5)


@query(f"WITH {RUNS}, b AS ({_grams((2,), 5)}) SELECT gram, round(ln(count) * ln(greatest(least(n_left, n_right), 1)) * 1.7, 2) AS score FROM b ORDER BY score DESC, gram LIMIT 40")
def top_terms(spark, d):
    b = C.branching(docs(spark, d), "doc_id", (2,), 5)
    return b.select("gram", C.branching_score(F.col("count"), F.col("n_left"), F.col("n_right"), F.lit(2)).alias("score")).orderBy(F.desc("score"), "gram").limit(40)


@query("SELECT source, probe, sum(len(list_filter(range(1, length(text) + 1), lambda i: substr(text, i, length(probe)) = probe))) AS overlapping, sum((length(text) - length(replace(text, probe, ''))) // length(probe)) AS plain FROM documents, (SELECT unnest([" + ", ".join(f"'{p}'" for p in PROBES) + "]) AS probe) GROUP BY source, probe")
def word_probe(spark, d):
    # One pass: all probes are columns of one scan, then unpivoted after aggregation.
    sums = docs(spark, d).groupBy("source").agg(*[F.sum(X.count_overlapping(F.col("text"), p)).alias(f"o{k}") for k, p in enumerate(PROBES)], *[F.sum(X.count_literal(F.col("text"), p)).alias(f"p{k}") for k, p in enumerate(PROBES)])
    stack = ", ".join(f"'{p}', o{k}, p{k}" for k, p in enumerate(PROBES))
    return sums.selectExpr("source", f"stack({len(PROBES)}, {stack}) AS (probe, overlapping, plain)")


@query("WITH t AS (SELECT source, list_sort(list(n_chars)) AS v, count(*) AS n FROM documents GROUP BY source) SELECT source, v[CAST(floor(n * 0.9) AS INT) + 1] AS floor_n, v[CAST(floor((n - 1) * 0.9) AS INT) + 1] AS floor_n1, v[CAST(least(floor(n * 1.0), n - 1) AS INT) + 1] AS clamped FROM t")
def quantile_forms(spark, d):
    return C.index_quantiles(docs(spark, d), "source", "n_chars", {"floor_n": "floor(n * 0.9D)", "floor_n1": "floor((n - 1) * 0.9D)", "clamped": "least(floor(n * 1.0D), n - 1)"})


@query(f"WITH {TOKENS}, c AS (SELECT source, token, count(*) AS n FROM toks GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, token) AS rank, n / sum(n) OVER (PARTITION BY source) AS s FROM c) SELECT source, token, rank, n, round(s, 6) AS share FROM r WHERE rank <= 3")
def top3_tokens(spark, d):
    t = C.tokens(docs(spark, d).select("source", F.lower("text").alias("text")), ["source"], separators=r"[\s.,;:!?]+")
    return C.top_shares(C.census(t, ["source", "token"]), "source", "token")


@query("WITH s AS (SELECT source, lang, sum(n_chars) AS w FROM documents GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY w DESC, lang) AS k FROM s) SELECT source, lang AS mode, w AS weight FROM r WHERE k = 1")
def weighted_mode(spark, d):
    return C.weighted_mode(docs(spark, d), "source", "lang", "n_chars")


@query("SELECT CAST(floor(log2(n_chars + 1)) AS BIGINT) AS bin, count(*) AS n FROM documents GROUP BY bin")
def size_histogram(spark, d):
    return docs(spark, d).groupBy(F.floor(F.log2(F.col("n_chars") + 1)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT sha1(text) AS hash, count(DISTINCT source) AS n_sources, list_sort(list(DISTINCT source)) AS sources, count(*) - count(DISTINCT source) AS redundant FROM documents GROUP BY text HAVING count(DISTINCT source) > 1")
def conflict_report(spark, d):
    g = docs(spark, d).groupBy(F.sha1("text").alias("hash"), "source").agg(F.count(F.lit(1)).alias("k"))
    out = g.groupBy("hash").agg(F.count(F.lit(1)).alias("n_sources"), F.array_sort(F.collect_list("source")).alias("sources"), (F.sum("k") - F.count(F.lit(1))).alias("redundant"))
    return out.where("n_sources > 1")


@query("SELECT lang, count(*) AS docs, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic, count(*) FILTER (quality IS NULL) AS todo FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang")
def status_rollup(spark, d):
    j = docs(spark, d).select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id", "left")
    return j.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("quality").isNull()).alias("todo"))


@query("SELECT source, count(DISTINCT n_chars - length(text)) = 1 AS constant, min(n_chars - length(text)) AS offset_ FROM documents GROUP BY source")
def constancy_check(spark, d):
    off = F.col("n_chars") - F.length("text")
    return docs(spark, d).groupBy("source").agg((F.min(off) == F.max(off)).alias("constant"), F.min(off).alias("offset_"))


@query(f"WITH {TOKENS}, f AS (SELECT DISTINCT left(token, 1) AS first, token FROM toks), r AS (SELECT *, row_number() OVER (PARTITION BY first ORDER BY token) AS k FROM f) SELECT first, list(token ORDER BY token) AS examples FROM r WHERE k <= 6 GROUP BY first")
def examples_per_key(spark, d):
    t = C.tokens(docs(spark, d).select(F.lower("text").alias("text")), [], separators=r"[\s.,;:!?]+").select(F.left("token", F.lit(1)).alias("first"), "token").distinct()
    w = Window.partitionBy("first").orderBy("token")
    return t.withColumn("k", F.row_number().over(w)).where("k <= 6").groupBy("first").agg(F.array_sort(F.collect_list("token")).alias("examples"))


_LEX = r"lex AS (SELECT DISTINCT unnest(list_filter(string_split_regex(lower(text), '[\s.,;:!?]+'), lambda x: x <> '')) AS token FROM benchmark)"


def lexicon(spark, d) -> DataFrame:
    return C.tokens(table(spark, d, "benchmark").select(F.lower("text").alias("text")), [], separators=r"[\s.,;:!?]+").select("token").distinct()


@query(f"WITH {TOKENS}, {_LEX} SELECT source, count(*) AS tokens, count(lex.token) AS known, count(lex.token) / count(*) AS rate FROM toks LEFT JOIN lex USING (token) GROUP BY source")
def lexicon_known_rate(spark, d):
    # Distinct tokens with counts first, then the lexicon: the reduction comes before the join.
    t = C.census(C.tokens(docs(spark, d).select("source", F.lower("text").alias("text")), ["source"], separators=r"[\s.,;:!?]+"), ["source", "token"])
    j = t.join(lexicon(spark, d).withColumn("k", F.lit(1)), "token", "left")
    return j.groupBy("source").agg(F.sum("n").alias("tokens"), F.sum(F.expr("n * coalesce(k, 0)")).alias("known"), (F.sum(F.expr("n * coalesce(k, 0)")) / F.sum("n")).alias("rate"))


@query(f"""WITH {TOKENS}, {_LEX}, r AS (SELECT lang, source, count(lex.token) / count(*) AS rate FROM toks LEFT JOIN lex USING (token) GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY rate DESC, source) AS i FROM r)
  SELECT a.lang, a.source AS best, round(a.rate - b.rate, 9) AS margin, CASE WHEN a.rate - b.rate >= 0.15 THEN 'clear' ELSE 'close' END AS verdict FROM k a JOIN k b ON a.lang = b.lang AND a.i = 1 AND b.i = 2""")
def best_candidate(spark, d):
    t = C.census(C.tokens(docs(spark, d).select("lang", "source", F.lower("text").alias("text")), ["lang", "source"], separators=r"[\s.,;:!?]+"), ["lang", "source", "token"])
    r = t.join(lexicon(spark, d).withColumn("k", F.lit(1)), "token", "left").groupBy("lang", "source").agg((F.sum(F.expr("n * coalesce(k, 0)")) / F.sum("n")).alias("rate"))
    w = Window.partitionBy("lang").orderBy(F.desc("rate"), "source")
    p = r.withColumn("i", F.row_number().over(w)).withColumn("margin", F.col("rate") - F.lead("rate").over(w)).where("i = 1 AND margin IS NOT NULL")
    return p.select("lang", F.col("source").alias("best"), F.round("margin", 9).alias("margin"), F.when(F.col("margin") >= 0.15, "clear").otherwise("close").alias("verdict"))


@query(f"""WITH {TOKENS}, p AS (SELECT lang, right(lag(token) OVER (PARTITION BY doc_id ORDER BY pos), 1) AS prev, token FROM toks)
  SELECT lang, count(*) AS n, count(*) FILTER (prev = 'e') AS agree, count(*) FILTER (prev = 'e') / count(*) AS rate FROM p WHERE token = 'the' AND prev IS NOT NULL GROUP BY lang""")
def rule_agreement(spark, d):
    t = C.tokens(docs(spark, d).select("doc_id", "lang", F.lower("text").alias("text")), ["doc_id", "lang"], separators=r"[\s.,;:!?]+")
    p = t.withColumn("prev", F.right(F.lag("token").over(Window.partitionBy("doc_id").orderBy("pos")), F.lit(1))).where("token = 'the' AND prev IS NOT NULL")
    return p.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("prev") == "e").alias("agree"), (F.count_if(F.col("prev") == "e") / F.count(F.lit(1))).alias("rate"))


@query(f"""WITH {TOKENS}, p AS (SELECT token, lag(token, 2, '^') OVER q || ' ' || lag(token, 1, '^') OVER q || ' _ ' || lead(token, 1, '$') OVER q || ' ' || lead(token, 2, '$') OVER q AS signature FROM toks WINDOW q AS (PARTITION BY doc_id ORDER BY pos))
  SELECT signature, count(*) AS n FROM p WHERE token = 'the' GROUP BY signature""")
def signature_census(spark, d):
    t = C.tokens(docs(spark, d).select("doc_id", F.lower("text").alias("text")), ["doc_id"], separators=r"[\s.,;:!?]+")
    return C.census(C.contexts(t, "doc_id", "the"), ["signature"])


@query(f"""WITH {TOKENS}, s AS (SELECT DISTINCT lang, token FROM toks), p AS (SELECT a.lang AS a, b.lang AS b, count(*) AS shared FROM s a JOIN s b ON a.token = b.token AND a.lang < b.lang GROUP BY ALL), n AS (SELECT lang, count(*) AS n FROM s GROUP BY lang)
  SELECT a, b, shared, x.n - shared AS a_only, y.n - shared AS b_only, shared / (x.n + y.n - shared) AS jaccard FROM p JOIN n x ON a = x.lang JOIN n y ON b = y.lang""")
def jaccard_contexts(spark, d):
    t = C.tokens(docs(spark, d).select("lang", F.lower("text").alias("text")), ["lang"], separators=r"[\s.,;:!?]+").select("lang", "token").distinct()
    n = t.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # Sets per token are tiny (languages), so pairs come from each token's own set.
    langs = t.groupBy("token").agg(F.array_sort(F.collect_set("lang")).alias("ls")).where(F.size("ls") > 1)
    pairs = langs.select(F.explode(F.flatten(F.transform("ls", lambda a: F.transform(F.filter("ls", lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))).alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("shared"))
    j = pairs.join(n.select(F.col("lang").alias("a"), F.col("n").alias("na")), "a").join(n.select(F.col("lang").alias("b"), F.col("n").alias("nb")), "b")
    return j.select("a", "b", "shared", F.expr("na - shared").alias("a_only"), F.expr("nb - shared").alias("b_only"), F.expr("shared / (na + nb - shared)").alias("jaccard"))


@query("SELECT conv_id, sha1(string_agg(role || ': ' || text, chr(10) ORDER BY turn)) AS hash, count(*) AS turns FROM conversations GROUP BY conv_id")
def ordered_concat(spark, d):
    c = table(spark, d, "conversations")
    parts = F.array_sort(F.collect_list(F.struct("turn", F.concat("role", F.lit(": "), "text").alias("t"))))
    return c.groupBy("conv_id").agg(F.sha1(F.array_join(F.transform(parts, lambda p: p["t"]), "\n")).alias("hash"), F.count(F.lit(1)).alias("turns"))


_THE = "count(*) FILTER (prev = 'e') / count(*) AS rate FROM (SELECT right(lag(token) OVER (PARTITION BY doc_id ORDER BY pos), 1) AS prev, token FROM {0}) WHERE token = 'the' AND prev IS NOT NULL"


@query(f"WITH {TOKENS}, raw AS (SELECT doc_id, unnest(ws) AS token, unnest(range(len(ws))) AS pos FROM (SELECT doc_id, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS ws FROM documents)) SELECT 'clean' AS label, {_THE.format('toks')} UNION ALL SELECT 'raw' AS label, {_THE.format('raw')}")
def agreement_by_label(spark, d):
    out = None
    for label, text, sep in (("clean", F.lower("text"), r"[\s.,;:!?]+"), ("raw", F.col("text"), r"\s+")):
        t = C.tokens(docs(spark, d).select("doc_id", text.alias("text")), ["doc_id"], separators=sep)
        p = t.withColumn("prev", F.right(F.lag("token").over(Window.partitionBy("doc_id").orderBy("pos")), F.lit(1))).where("token = 'the' AND prev IS NOT NULL")
        r = p.agg((F.count_if(F.col("prev") == "e") / F.count(F.lit(1))).alias("rate")).select(F.lit(label).alias("label"), "rate")
        out = r if out is None else out.unionByName(r)
    return out


@query("""WITH t AS (SELECT len(regexp_extract_all(text, '[#*$%&|<>]')) AS b, len(regexp_extract_all(regexp_replace(text, '[#*$%&]{3}', '', 'g'), '[#*$%&|<>]')) AS a FROM documents)
  SELECT sum(b) AS before, sum(a) AS after, count(*) FILTER (b > 0) AS docs_before, count(*) FILTER (a > 0) AS docs_after, 100.0 * (sum(b) - sum(a)) / sum(b) AS reduction FROM t""")
def defect_counts(spark, d):
    t = docs(spark, d).select(F.regexp_count("text", F.lit(r"[#*$%&|<>]")).alias("b"), F.regexp_count(F.regexp_replace("text", r"[#*$%&]{3}", ""), F.lit(r"[#*$%&|<>]")).alias("a"))
    return t.agg(F.sum("b").alias("before"), F.sum("a").alias("after"), F.count_if(F.col("b") > 0).alias("docs_before"), F.count_if(F.col("a") > 0).alias("docs_after"), (100.0 * (F.sum("b") - F.sum("a")) / F.sum("b")).alias("reduction"))


@query(f"""WITH {TOKENS}, {_LEX}, r AS (SELECT doc_id, count(*) AS n FROM toks SEMI JOIN lex USING (token) GROUP BY doc_id) SELECT doc_id, n FROM r""")
def lexicon_hits(spark, d):
    t = C.tokens(docs(spark, d).select("doc_id", F.lower("text").alias("text")), ["doc_id"], separators=r"[\s.,;:!?]+")
    return t.join(lexicon(spark, d), "token", "left_semi").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
