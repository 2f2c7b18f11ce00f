"""Queries for prose metrics, the sweep, reflow, verification and review, over documents made into Markdown."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.functions import markup as M
from textloom.functions import text as X
from textloom.operators import offsets as O
from textloom.operators import prose as P
from textloom.plans.made import MARKED, MARKED_LINES, Plans, marked
from textloom.session import materialize, table

query = Plans()
QUERIES, ORACLES = query.queries, query.oracles

_BODY = r"regexp_replace(raw, '^\s*>\s?', '')"
_QUOTED = rf"(regexp_matches(raw, '^\s*>') AND NOT regexp_full_match({_BODY}, '\s*'))"
_WORDS = r"len(list_filter(string_split_regex({0}, '\s+'), lambda x: x <> ''))"
#: Prose lines, sentence sizes and missing breaks, then the metrics.
METRICS = rf"""{MARKED_LINES},
  t AS (SELECT *, {_BODY} AS t FROM l),
  kinds AS (SELECT *, CASE WHEN regexp_matches(t, '^\s*(#|-\s|\*\s|\d+\.\s|---\s*$|\|)') OR regexp_full_match(t, '\s*') THEN 0 WHEN length(regexp_replace(t, '\s+$', '')) < 76 THEN 1 ELSE 2 END AS kind FROM t),
  kept AS (SELECT doc_id, k, t FROM (SELECT *, coalesce(lag(kind) OVER w, 0) AS a, coalesce(lead(kind) OVER w, 0) AS b FROM kinds WINDOW w AS (PARTITION BY doc_id ORDER BY k)) WHERE kind = 2 OR kind = 1 AND a <> 1 AND b <> 1),
  joined AS (SELECT doc_id, string_agg(t, chr(10) ORDER BY k) AS p FROM kept GROUP BY doc_id),
  sents AS (SELECT doc_id, unnest(string_split_regex(t, '[.!?]+[”’"'']?\s+')) AS s FROM kept),
  sized AS (SELECT doc_id, {_WORDS.format("s")} AS n FROM sents WHERE length(regexp_replace(s, '^\s+|\s+$', '', 'g')) > 1),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS i, count(*) OVER (PARTITION BY doc_id) AS c FROM sized),
  agg AS (SELECT doc_id, count(*) AS sents, max(CASE WHEN i = floor(c * 0.5) THEN n END) AS med, max(CASE WHEN i = floor(c * 0.9) THEN n END) AS p90, max(n) AS max, count(*) FILTER (n > 80) AS long, count(*) FILTER (n > 120) AS vlong FROM ranked GROUP BY doc_id),
  q AS (SELECT *, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS g FROM l WHERE {_QUOTED}),
  runs AS (SELECT doc_id, g, sum(bare) - arg_max(bare, k) AS n FROM (SELECT *, CASE WHEN regexp_matches(raw, ' {{2}}$') THEN 0 ELSE 1 END AS bare FROM q) GROUP BY doc_id, g HAVING count(*) > 1 AND bool_and(length(regexp_replace({_BODY}, '\s+$', '')) < 76)),
  verse AS (SELECT doc_id, sum(n) AS n FROM runs GROUP BY doc_id),
  metrics AS (SELECT doc_id, source, {_WORDS.format("coalesce(p, '')")} AS words, coalesce(sents, 0) AS sents, coalesce(med, 0) AS med, coalesce(p90, 0) AS p90, coalesce(max, 0) AS max, coalesce(long, 0) AS long, coalesce(vlong, 0) AS vlong,
    len(list_filter(string_split_regex(coalesce(p, ''), '[^\p{{L}}]+'), lambda x: x = 'ấy')) AS ay, len(regexp_extract_all(coalesce(p, ''), ';')) AS semis, len(regexp_extract_all(coalesce(p, ''), '"')) AS straight_quotes, coalesce(verse.n, 0) AS verse_no_break
    FROM documents LEFT JOIN joined USING (doc_id) LEFT JOIN agg USING (doc_id) LEFT JOIN verse USING (doc_id)),
  rated AS (SELECT *, CASE WHEN words > 0 THEN ay * 1000.0 / words ELSE 0 END AS ay_per_1k, CASE WHEN words > 0 THEN semis * 1000.0 / words ELSE 0 END AS semi_per_1k, long * 10 + vlong * 20 + ay + verse_no_break AS burden FROM metrics)"""


@query(f"WITH {METRICS} SELECT doc_id, words, sents, med, p90, max, long, vlong, ay, ay_per_1k, semi_per_1k, straight_quotes, verse_no_break FROM rated")
def prose_metrics(spark, d):
    return P.prose_metrics(marked(spark, d), "doc_id")


@query(f"WITH {METRICS} SELECT count(*) AS docs, sum(words) AS words, sum(sents) AS sents, sum(long) AS long, sum(vlong) AS vlong, sum(ay) AS ay, sum(straight_quotes) AS straight_quotes, sum(verse_no_break) AS verse_no_break FROM rated")
def corpus_style_totals(spark, d):
    m = P.prose_metrics(marked(spark, d), "doc_id")
    return m.agg(F.count(F.lit(1)).alias("docs"), *[F.sum(c).alias(c) for c in ("words", "sents", "long", "vlong", "ay", "straight_quotes", "verse_no_break")])


_LEDGER = "ledger AS (SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN 'x' ELSE substr(sha1(text), 1, 12) END AS output_hash FROM marked WHERE doc_id % 3 = 0 UNION ALL SELECT -1, 'x')"
_STATUS = f"{METRICS}, {_LEDGER}, lint AS (SELECT rated.*, CASE WHEN output_hash IS NULL THEN 'pending' WHEN output_hash = substr(sha1(text), 1, 12) THEN 'done' ELSE 'stale' END AS status FROM rated JOIN marked USING (doc_id) LEFT JOIN ledger USING (doc_id))"


def _lint(spark, d):
    t = marked(spark, d)
    h = F.when(F.col("doc_id") % 6 == 0, F.lit("x")).otherwise(X.content_hash(F.col("text")))
    old = t.where("doc_id % 3 = 0").select("doc_id", h.alias("output_hash")).unionByName(spark.createDataFrame([(-1, "x")], "doc_id long, output_hash string"))
    return P.lint_ledger(t, old, "doc_id"), old, t


@query(f"WITH {_STATUS} SELECT doc_id, status, burden, ay_per_1k FROM lint ORDER BY burden DESC, ay_per_1k DESC, doc_id LIMIT 50")
def lint_worklist(spark, d):
    return _lint(spark, d)[0].select("doc_id", "status", "burden", "ay_per_1k").orderBy(F.desc("burden"), F.desc("ay_per_1k"), "doc_id").limit(50)


@query(f"WITH {_STATUS} SELECT status, count(*) AS n, sum(burden) AS burden FROM lint GROUP BY status UNION ALL SELECT 'ghost', count(*), 0 FROM ledger ANTI JOIN marked USING (doc_id)")
def lint_status(spark, d):
    rows, old, t = _lint(spark, d)
    ghost = P.ghosts(old, t, "doc_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit("ghost").alias("status"), "n", F.lit(0).cast("long").alias("burden"))
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("burden").alias("burden")).unionByName(ghost)


@query(f"""WITH {_STATUS}, open AS (SELECT * FROM lint WHERE status <> 'done'),
  a AS (SELECT 'ids' AS how, doc_id, CASE doc_id WHEN 8 THEN 1 WHEN 2 THEN 2 ELSE 3 END AS place FROM open WHERE doc_id IN (8, 2, 3)),
  b AS (SELECT 'first' AS how, doc_id, row_number() OVER (ORDER BY doc_id) AS place FROM open WHERE burden > 0 QUALIFY place <= 10),
  c AS (SELECT 'worst' AS how, doc_id, row_number() OVER (ORDER BY burden DESC, ay_per_1k DESC, doc_id) AS place FROM open QUALIFY place <= 10)
  SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c""")
def lint_batches(spark, d):
    rows = materialize(_lint(spark, d)[0].select("doc_id", "status", "burden", "ay_per_1k"), "lint")
    picks = {"ids": P.pick_batch(rows, "doc_id", ids=[8, 2, 3]), "first": P.pick_batch(rows, "doc_id", first=True), "worst": P.pick_batch(rows, "doc_id")}
    out = None
    for how, df in picks.items():
        part = df.select(F.lit(how).alias("how"), "doc_id", "place")
        out = part if out is None else out.unionByName(part)
    return out


def _word(alts: str) -> str:
    return rf"len(regexp_extract_all(z, '(?i)(?:^|[^\p{{L}}])(?:{alts})(?:$|[^\p{{L}}])'))"


_S2 = r"\s+"
#: The features again, written for an engine without lookaround: in z every non-letter stands twice.
_FEATURES = {
    "bracket_insert": r"len(regexp_extract_all(b, '\[[^\]\n]{1,60}\]'))", "v_v": r"len(regexp_extract_all(b, 'v\.v\.'))", "tuc_la": _word(rf"tức{_S2}là|tức"), "ay": _word("ấy"), "kia": _word("kia"), "do": _word("đó"), "nay": _word("này"),
    "chung_ta": _word(rf"chúng{_S2}ta"), "chung_toi": _word(rf"chúng{_S2}tôi"), "ta_bare": _word("ta") + r" - len(regexp_extract_all(z, '(?i)chúng\s\sta(?:$|[^\p{L}])'))", "quy_vi": _word(rf"quý{_S2}vị|các{_S2}bạn"), "toi": _word("tôi"),
    "ngai": _word("Ngài|Thầy|Rinpoche"), "question": r"len(regexp_extract_all(b, '\?'))", "em_dash": "len(regexp_extract_all(b, '—'))", "colon": "len(regexp_extract_all(b, ':'))", "semicolon": "len(regexp_extract_all(b, ';'))", "curly_quotes": "len(regexp_extract_all(b, '[“”]'))",
    "italic": r"len(regexp_extract_all(regexp_replace(b, '\*{2,}', chr(10), 'g'), '\*[^*\n]+\*'))", "co_day": _word(rf"có{_S2}dạy|dạy{_S2}rằng|nói{_S2}rằng|có{_S2}nói"), "hay": r"len(regexp_extract_all(b, '(?:^|[.;:!?]\s+|\n)Hãy(?:$|[^\p{L}])'))",
    "vi_vay": _word(rf"Vì{_S2}vậy|Do{_S2}đó|Cho{_S2}nên|Bởi{_S2}vậy|Chính{_S2}vì{_S2}thế"),
}


@query(rf"""WITH {MARKED}, body AS (SELECT doc_id, regexp_replace(array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT regexp_matches(x, '^\s*(#|>|-\s|\*\s|\d+\.\s|---)')), chr(10)), '【\*?\d+】', '', 'g') AS b FROM marked),
  z AS (SELECT *, regexp_replace(b, '([^\p{{L}}])', '\1\1', 'g') AS z, {_WORDS.format("b")} AS words, list_sort(list_transform(list_filter(string_split_regex(b, '[.!?]+[”’"'']?[\s\n]+'), lambda x: length(regexp_replace(x, '^\s+|\s+$', '', 'g')) > 1), lambda s: {_WORDS.format("s")})) AS v,
    len(list_filter(string_split_regex(b, '\n{{2,}}'), lambda x: length(regexp_replace(x, '^\s+|\s+$', '', 'g')) > 40)) AS paras FROM body)
  SELECT doc_id, words, paras, coalesce(words / nullif(paras, 0), 0) AS para_words, len(v) AS sents, coalesce(list_sum(v) / nullif(len(v), 0), 0) AS sent_mean,
    coalesce(v[CAST(least(len(v) - 1, floor(len(v) * 0.5)) AS INT) + 1], 0) AS sent_med, coalesce(v[CAST(least(len(v) - 1, floor(len(v) * 0.9)) AS INT) + 1], 0) AS sent_p90,
    coalesce(len(list_filter(v, lambda n: n > 40)) * 100.0 / nullif(len(v), 0), 0) AS long40, coalesce(len(regexp_extract_all(b, ',')) / nullif(len(v), 0), 0) AS comma_per_sent,
    {", ".join(f"coalesce(({e}) * 1000.0 / nullif(words, 0), 0) AS {n}" for n, e in _FEATURES.items())} FROM z""")
def style_table(spark, d):
    return P.style_table(marked(spark, d), "doc_id")


_OPENS = r"\s(\[{<«‘“–—:;,\-"


def _curled(text: str) -> str:
    doubles = rf"""regexp_replace(regexp_replace({text}, '(^|[{_OPENS}])"', '\1“', 'g'), '"', '”', 'g')"""
    return rf"regexp_replace(regexp_replace(replace({doubles}, '”.', '.”'), '(^|[{_OPENS}”])''', '\1‘', 'g'), '''', '’', 'g')"


@query(f"WITH {MARKED} SELECT doc_id, sha1({_curled('text')}) AS curled, length(text) - length(replace(text, '\"', '')) AS doubles FROM marked")
def curly_quotes(spark, d):
    return marked(spark, d).select("doc_id", F.sha1(X.curly_quotes(F.col("text"))).alias("curled"), F.regexp_count("text", F.lit('"')).alias("doubles"))


#: Lines with the breaks that short quoted runs lack.
_BROKEN = rf"""q AS (SELECT *, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS g FROM l WHERE {_QUOTED}),
  v AS (SELECT doc_id, k, lead(k) OVER (PARTITION BY doc_id, g ORDER BY k) IS NOT NULL AND count(*) OVER r > 1 AND bool_and(length(regexp_replace({_BODY}, '\s+$', '')) < 76) OVER r AND NOT regexp_matches(raw, ' {{2}}$') AS give FROM q WINDOW r AS (PARTITION BY doc_id, g)),
  broken AS (SELECT doc_id, string_agg(CASE WHEN give THEN regexp_replace(raw, '\s+$', '') || '  ' ELSE raw END, chr(10) ORDER BY l.k) AS text, count(*) FILTER (give) AS verse FROM l LEFT JOIN v USING (doc_id, k) GROUP BY doc_id)"""


@query(f"WITH {MARKED_LINES}, {_BROKEN} SELECT doc_id, sha1(text) AS broken, verse FROM broken")
def verse_breaks(spark, d):
    out = P.sweep(marked(spark, d), "doc_id", P.Sweep([], {}, {}, ("verse",)))
    return out.select("doc_id", F.sha1("text").alias("broken"), "verse")


_SWEPT = f"WITH {MARKED}, curled AS (SELECT doc_id, {_curled('text')} AS text FROM (SELECT doc_id, replace(replace(text, ' chúng ta ', ' an-so '), ' an ', ' An-So-ly ') AS text FROM marked)), l AS (SELECT doc_id, unnest(range(len(ls))) AS k, unnest(ls) AS raw FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM curled)), {_BROKEN}"


@query(rf"""{_SWEPT}, h AS (SELECT doc_id, verse, text AS t0, replace(replace(text, ' an-so ', ' an so '), ' An-So-ly ', ' An So ly ') AS t1 FROM broken),
  r AS (SELECT *, replace(replace(replace(t1, 'tion', 'sion'), 'Tion', 'Sion'), 'TION', 'SION') AS t2 FROM h)
  SELECT doc_id, verse, (length(t0) - length(replace(t0, ' an-so ', ''))) // 7 + (length(t0) - length(replace(t0, ' An-So-ly ', ''))) // 10 AS hyphen, sha1(replace(t2, 'Vì vậy', 'Vì Vậy')) AS swept FROM r""")
def sweep_texts(spark, d):
    t = marked(spark, d).withColumn("text", F.replace(F.replace("text", F.lit(" chúng ta "), F.lit(" an-so ")), F.lit(" an "), F.lit(" An-So-ly ")))
    out = P.sweep(t, "doc_id", P.Sweep(["an-so", "an-so-ly"], {"tion": "sion"}, {"Vì vậy": "Vì Vậy"}))
    return out.select("doc_id", "verse", "hyphen", F.sha1("text").alias("swept"))


def _unhyphened(text: str) -> str:
    """Each rule twice, as neighbours share the character between them, which this engine's match takes up."""
    for words, spaced in (("(an)-(so)-(ly)", r"\1\2 \3 \4\5"), ("(an)-(so)", r"\1\2 \3\4")) * 2:
        text = rf"regexp_replace({text}, '(?i)(^|[^\p{{L}}]){words}($|[^\p{{L}}])', '{spaced}', 'g')"
    return text


_LOCATOR = "substr(replace(replace(text, ' chúng ta ', ' an-so '), ' an ', ' An-So-ly '), 9, 60)"


@query(rf"""WITH {MARKED}, l AS (SELECT doc_id, {_curled(_LOCATOR)} AS t0 FROM marked),
  h AS (SELECT doc_id, replace(replace(replace({_unhyphened("t0")}, 'tion', 'sion'), 'Tion', 'Sion'), 'TION', 'SION') AS t FROM l)
  SELECT doc_id, sha1(replace(t, 'Vì vậy', 'Vì Vậy')) AS locator FROM h""")
def sweep_locators(spark, d):
    """Locators, pieces of the texts, swept like the texts they are to be found in."""
    t = marked(spark, d).withColumn("text", F.replace(F.replace("text", F.lit(" chúng ta "), F.lit(" an-so ")), F.lit(" an "), F.lit(" An-So-ly ")))
    out = P.sweep_locators(t.select("doc_id", F.substring("text", 9, 60).alias("locator")), "doc_id", P.Sweep(["an-so", "an-so-ly"], {"tion": "sion"}, {"Vì vậy": "Vì Vậy"}))
    return out.select("doc_id", F.sha1("locator").alias("locator"))


@query(r"""WITH p AS (SELECT doc_id, text, string_split(text, ' ') AS w FROM documents), s AS (SELECT doc_id, text, w, unnest(range(0, len(w), 50)) AS k FROM p),
  a AS (SELECT doc_id, text, CAST(coalesce(list_sum(list_transform(w[1 : k], lambda x: length(x))), 0) + k AS BIGINT) AS spot FROM s WHERE regexp_matches(w[k + 1], '^[a-zA-Z]+$'))
  SELECT doc_id, spot AS "at", spot + 3 * ((length(left(text, spot)) - length(replace(left(text, spot), ' the ', ''))) // 5) AS "to", true AS exact FROM a""")
def carried_words(spark, d):
    """Places of words, carried through a rewrite that puts words in."""
    t = table(spark, d, "documents").select("doc_id", "text", F.replace("text", F.lit(" the "), F.lit(" the ấy ")).alias("after"))
    # Lengths are summed for each fifty words where they are read; only the sums meet in a window.
    words = t.select("doc_id", F.posexplode(F.split("text", " ")).alias("k", "w")).groupBy("doc_id", F.expr("k div 50").alias("c"))
    parts = words.agg(F.sum(F.length("w") + 1).alias("n"), F.bool_or(F.expr("k % 50 = 0 AND w RLIKE '^[a-zA-Z]+$'")).alias("word"))
    w = Window.partitionBy("doc_id").orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
    spots = parts.withColumn("at", F.coalesce(F.sum("n").over(w), F.lit(0)))
    return O.carried(t, spots.where("word"), "doc_id", ["text", "after"])


@query(r"SELECT doc_id, sha1(array_to_string(list_transform(string_split(replace(replace(text, '`', ''), ' is ', ' `is he` '), '`'), lambda x, i: CASE WHEN i % 2 = 0 THEN x ELSE replace(x, 'e', 'E') END), '`')) AS swept FROM (SELECT doc_id, replace(replace(text, '*', ''), '''', '') AS text FROM documents)")
def protected_spans(spark, d):
    clean = F.regexp_replace("text", "[*'`]", "")
    t = table(spark, d, "documents").select("doc_id", F.replace(clean, F.lit(" is "), F.lit(" `is he` ")).alias("text"))
    return t.select("doc_id", F.sha1(M.protected_udf(lambda s: s.replace("e", "E"))("text")).alias("swept"))


@query(rf"""WITH {MARKED} SELECT doc_id, sha1(regexp_replace(regexp_replace(regexp_replace(text, '(^|[^\p{{L}}])(chúng)( )(ta)($|[^\p{{L}}])', '\1\2-\4\5', 'g'), 'x', 'x', 'g'), '(^|[^\p{{L}}])chúng-ta($|[^\p{{L}}])', '\1chúng ta\2', 'g')) AS plain, sha1(replace(replace(replace(text, 'tion', 'sion'), 'Tion', 'Sion'), 'TION', 'SION')) AS respelt FROM marked""")
def respell_sweep(spark, d):
    """Hyphens put in and taken out again, and a respelling in three cases."""
    t = marked(spark, d).withColumn("hyphened", F.regexp_replace("text", r"(?<!\p{L})chúng ta(?!\p{L})", "chúng-ta"))
    return t.select("doc_id", F.sha1(X.dehyphenate(F.col("hyphened"), ["chúng-ta"])).alias("plain"), F.sha1(X.respell(F.col("text"), {"tion": "sion"}, whole_words=False)).alias("respelt"))


# --- reflow ---------------------------------------------------------------------------------

#: Documents wrapped line by line: at 82, at 60, at 78, or at 84 and 50 in turn, a blank line between.
_WRAPPED = r"""src AS (SELECT doc_id, unnest(range(len(ls))) AS k, unnest(ls) AS line FROM (SELECT doc_id, string_split(regexp_replace(text, '[^\p{L}\s.,!?]', 'x', 'g'), chr(10)) AS ls FROM documents)),
  cut AS (SELECT doc_id, k, i, CASE k % 4 WHEN 0 THEN substr(line, i * 82 + 1, 82) WHEN 1 THEN substr(line, i * 60 + 1, 60) WHEN 2 THEN substr(line, i * 78 + 1, 78) ELSE CASE WHEN i % 2 = 0 THEN substr(line, (i // 2) * 134 + 1, 84) ELSE substr(line, (i // 2) * 134 + 85, 50) END END AS piece
    FROM (SELECT *, unnest(range(greatest(1, length(line) // 50 + 2))) AS i FROM src)),
  runs AS (SELECT doc_id, k, list(piece ORDER BY i) AS ps FROM cut WHERE regexp_matches(piece, '\S') GROUP BY doc_id, k),
  judged AS (SELECT *, list_transform(ps[1:len(ps) - 1], lambda x: length(x)) AS w, len(list_filter(ps[1:len(ps) - 1], lambda x: NOT regexp_matches(trim(x), '[,.;:!?…—–"''»)\]]\s*$'))) / greatest(1, len(ps) - 1) AS bare FROM runs),
  decided AS (SELECT *, CASE WHEN len(ps) = 1 THEN 'one' WHEN list_min(w) >= 76 OR list_max(w) >= 80 AND bare >= 0.4 THEN 'join' WHEN list_max(w) >= 80 THEN 'ambiguous' ELSE 'keep' END AS what FROM judged)"""


def _wrapped(spark, d):
    line = F.regexp_replace("text", r"[^\p{L}\s.,!?]", "x")
    t = table(spark, d, "documents").select("doc_id", F.posexplode(F.split(line, "\n")).alias("k", "line"))
    n = F.floor(F.length("line") / 50).cast("int") + 1
    at = lambda i, w: F.col("line").substr(i * w + 1, F.lit(w))
    half = lambda i: F.floor(i / 2).cast("int") * 134
    mixed = lambda i: F.when(i % 2 == 0, F.col("line").substr(half(i) + 1, F.lit(84))).otherwise(F.col("line").substr(half(i) + 85, F.lit(50)))
    pieces = F.transform(F.sequence(F.lit(0), n), lambda i: F.when(F.col("k") % 4 == 0, at(i, 82)).when(F.col("k") % 4 == 1, at(i, 60)).when(F.col("k") % 4 == 2, at(i, 78)).otherwise(mixed(i)))
    t = t.select("doc_id", "k", F.array_join(F.filter(pieces, lambda p: p.rlike(r"\S")), "\n").alias("p")).where("p <> ''")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("k", "p"))), lambda x: x["p"])
    return t.groupBy("doc_id").agg(F.array_join(parts, "\n\n").alias("text"))


@query(rf"WITH {_WRAPPED} SELECT doc_id, sum(CASE WHEN what = 'join' THEN len(ps) - 1 ELSE 0 END) AS joined, sum(CASE WHEN what IN ('keep', 'ambiguous') THEN len(ps) ELSE 0 END) AS kept, count(*) FILTER (what = 'ambiguous') AS ambiguous, sha1(string_agg(CASE WHEN what = 'join' THEN array_to_string(list_transform(ps, lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), ' ') ELSE array_to_string(ps, chr(10)) END, chr(10) || chr(10) ORDER BY k)) AS flowed FROM decided GROUP BY doc_id")
def reflow_texts(spark, d):
    return P.reflowed(_wrapped(spark, d), "doc_id").select("doc_id", "joined", "kept", "ambiguous", F.sha1("text").alias("flowed"))


# --- verification and review ----------------------------------------------------------------


@query(rf"""WITH {MARKED_LINES}, f AS (SELECT *, length(regexp_extract(raw, '^(#{{1,6}})\s', 1)) AS level, sum(CASE WHEN regexp_full_match(raw, '\s*') THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY k) AS filled FROM l),
  h AS (SELECT doc_id, coalesce(level > lag(level) OVER w + 1, false) AS jump, coalesce(title = lag(title) OVER w, false) AS again, coalesce(lead(filled) OVER w = filled + 1, false) AS empty FROM (SELECT *, trim(regexp_extract(raw, '^#{{1,6}}\s+(.*)$', 1)) AS title FROM f WHERE level > 0) WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
  c AS (SELECT doc_id, count(*) AS headings, count(*) FILTER (jump) AS jumps, count(*) FILTER (again) AS repeated, count(*) FILTER (empty) AS empty FROM h GROUP BY doc_id),
  p AS (SELECT doc_id, count(*) AS hanging FROM (SELECT doc_id, regexp_replace(unnest(string_split_regex(text, '\n\s*\n')), '^\s+|\s+$', '', 'g') AS t FROM marked) WHERE t <> '' AND NOT regexp_matches(t, '^(#{{1,6}}\s|>|[-*+\d])') AND NOT regexp_matches(t, '[.!?:;"''’”»)\]…*]$') GROUP BY doc_id)
  SELECT doc_id, coalesce(headings, 0) AS headings, coalesce(jumps, 0) AS jumps, coalesce(repeated, 0) AS repeated, coalesce(empty, 0) AS empty, coalesce(hanging, 0) AS hanging, 0 AS leftovers, len(list_filter(string_split_regex(lower(text), '[^\p{{L}}]+'), lambda x: x IN ('ấy', 'ing'))) AS forbidden FROM marked LEFT JOIN c USING (doc_id) LEFT JOIN p USING (doc_id)""")
def verification_report(spark, d):
    return P.verification(marked(spark, d), "doc_id", forbidden=("ấy", "ing"))


@query(r"""WITH t AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN text || chr(10) || '*(tiếp sang c044.)*' WHEN doc_id % 5 = 1 THEN 'xem c005 ' || text ELSE text END AS text FROM documents), l AS (SELECT doc_id, unnest(range(len(ls))) AS line_no, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM t))
  SELECT doc_id, line_no, length(line) AS n FROM l WHERE contains(line, 'tiếp sang') OR contains(line, 'chunk sau') OR regexp_matches(line, 'tiếp theo c[0-9]') OR regexp_matches(line, 'xem c[0-9][0-9][0-9]')""")
def residue_check(spark, d):
    text = F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("\n*(tiếp sang c044.)*"))).when(F.col("doc_id") % 5 == 1, F.concat(F.lit("xem c005 "), "text")).otherwise(F.col("text"))
    return P.residue(table(spark, d, "documents").select("doc_id", text.alias("text")), "doc_id").select("doc_id", "line_no", F.length("line").alias("n"))


def _versions(spark, d):
    """Documents beside a version with lines moved, edited and lost."""
    line = lambda x, i: F.when(i % 7 == 2, F.replace(x, F.lit(" "), F.lit(" so "))).when(i % 7 == 4, F.concat(F.lit("Also "), x)).otherwise(x)
    edited = F.filter(F.transform(F.split("text", "\n"), line), lambda x, i: i % 9 != 5)
    return table(spark, d, "documents").select("doc_id", F.col("text").alias("before"), F.array_join(edited, "\n").alias("after"))


@query()
def paragraph_review(spark, d):
    """Paragraphs of two versions paired within three places, with word diffs of those that changed (tested against brute force)."""
    return P.review(_versions(spark, d), "doc_id").select("doc_id", "para", "status", F.sha1("markup").alias("markup"))
