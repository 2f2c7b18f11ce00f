"""Faults found on larger tables, each on rows small enough to read."""

import re

from pyspark.sql import functions as F

from textloom.functions import soup
from textloom.functions import text as X


def test_an_entry_without_heading_takes_no_other_entrys(spark):
    from textloom.operators import outline as O

    entries = spark.createDataFrame([(1, 0, "A", 0.0, 2), (1, 1, "B", 0.0, 4), (1, 2, "A", 0.0, 6), (1, 3, "B", 0.0, 8)], "book int, ord int, title string, x0 double, printed int")
    heads = spark.createDataFrame([(1, 0, "A", 22), (1, 2, "A", 26), (1, 3, "B", 28)], "book int, ord int, title string, page int")
    near = {r.ord: (r.page, r.matched, r.end_page) for r in O.build_outline(entries, heads, 20, 99, reach=0).collect()}
    assert near == {0: (22, True, 23), 1: (24, False, 25), 2: (26, True, 27), 3: (28, True, 99)}
    far = {r.ord: (r.page, r.matched) for r in O.build_outline(entries, heads, 20, 99).collect()}
    assert far[1] == (28, True) and far[3] == (28, False)


def test_notes_are_whole_by_the_pattern_that_is_given(spark):
    from pyspark.sql import functions as F
    from textloom.operators import review as R

    t = spark.createDataFrame([(1, "One of only two. Two.", False), (2, "This is never cut. Two.", False), (3, "One. Two.", True)], "ord long, note string, binding boolean")
    note = lambda *c: [r.n for r in t.select("ord", X.first_sentence(F.col("note"), 140, F.col("binding"), *c).alias("n")).orderBy("ord").collect()]
    assert note() == ["One of only two. Two.", "This is never cut. Two.", "One. Two."]
    assert note("^This is never") == ["One of only two.", "This is never cut. Two.", "One. Two."]
    terms = spark.createDataFrame([(1, "aa (x)", "b", "provisional", "One of only two. Two.")], "ord long, headword string, rendering string, status string, note string")
    docs = spark.createDataFrame([(7, "x aa y")], "doc_id long, text string")
    assert R.dictionary_views(docs, terms, "doc_id", "^This is never").first()["view"] == "prov  aa (x) -> b\n      One of only two."


def test_references_cut_off_at_a_title_stay_where_asked(spark):
    page = '<h1>a &amp; b&amp</h1><p>&copy; &xamp; <a href="?a&amp;b&amp">&lt;c</a>'
    assert "".join(r[8] for r in soup.blocks(page)) == "a & b&© &xamp; <c"
    assert "".join(r[8] for r in soup.blocks(page, lenient=False)) == "a & b&amp© &xamp; <c"
    assert [r[12] for r in soup.blocks(page, lenient=False) if r[12]] == ["?a&b&amp"]
    rows = soup.page_blocks(spark.createDataFrame([(1, page)], "page_id long, html string"), "page_id", lenient=False)
    assert "b&amp" in {r.text.split()[-1] for r in rows.where("kind = 'heading'").collect()}


def shuffled(df):
    """The columns of each shuffle of a plan, as text."""
    return [line for line in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in line]


def test_glyphs_stay_where_their_page_is_read(spark):
    from textloom.plans import glyph_queries as Q

    d = "/root/testdata/sf0.001"
    for name in ("clean_pages", "glyph_lines", "order_proof", "heading_lines", "region_filter"):
        assert all("RoundRobin" in x for x in shuffled(Q.QUERIES[name](spark, d))), name  # but for dealing out a small file
    # What goes on is counted or cut to lines before.
    for name in ("wrapped_headings", "forms_by_value", "glyph_usage"):
        plan = Q.QUERIES[name](spark, d)._jdf.queryExecution().executedPlan().toString()
        assert plan.index("MapInArrow") > plan.rindex("Exchange hashpartitioning"), name


def test_glyph_lines_are_those_of_the_plain_fold(spark):
    import random

    from pyspark.sql import functions as F
    from textloom.operators import glyphs as G

    chance = random.Random(3)
    rows = [(page, o, chance.choice(["F1", "F2"]), chance.randrange(97, 103), chance.choice(["a", "é", "ffi", None, "", " "]), chance.uniform(0, 300), chance.choice([90.0, 92.5, 94.0, 97.1, 100.0, 60.0]), 9.0, 5.0) for page in (5, 3, 8) for o in range(300)]
    g = spark.createDataFrame(rows, "page int, ord int, font string, code int, u string, x double, y double, size double, w double")
    repairs = spark.createDataFrame([(98, "B")], "code int, to string")
    maps = spark.createDataFrame([("F1", 99, "ccc"), ("F2", 98, "no")], "font string, code int, unicode string")
    plain = G.page_lines(G.decode_chain(g, repairs, maps))
    got = G.page_lines(g, G.Decoder(repairs, maps))
    key = lambda df: sorted((r.page, r.line, r.y, r.x0, r.x1, r.text) for r in df.collect())
    assert key(plain) == key(got) and len(key(got)) > 9
    rows_of = G.lined_pages(g, G.Decoder(repairs, maps)).select("page", F.length("raw").alias("n")).collect()
    assert {r.page: r.n for r in rows_of} == {r.page: r.n for r in G.decode_chain(g, repairs, maps).groupBy("page").agg(F.sum(F.length("text")).alias("n")).collect()}


def test_overlaps_are_those_of_plain_search(spark):
    import random

    from pyspark.sql import functions as F

    chance = random.Random(5)
    rows = [(k, "".join(chance.choice("ab") for _ in range(chance.randrange(0, 80))), "") for k in range(60)]
    rows = [(k, a, a[chance.randrange(0, len(a) + 1) :] + "ba" * 9) for k, a, _ in rows] + [(60, "a" * 400, "a" * 400), (61, None, "a"), (62, "", ""), (63, "x" * 30, "x" * 29), (64, "ab" * 90, "ab" * 90)]
    t = spark.createDataFrame(rows, "k int, a string, b string")
    got = {r.k: r.n for r in t.select("k", X.suffix_prefix_overlap(F.col("a"), F.col("b"), 5, 70).alias("n")).collect()}
    for k, a, b in rows:
        a, b = a or "", b or ""
        assert got[k] == max((n for n in range(5, min(70, len(a), len(b)) + 1) if a[-n:] == b[:n]), default=0), k
    assert "python" in t.select(X.suffix_prefix_overlap(F.col("a"), F.col("b")))._jdf.queryExecution().toString().lower()  # and no list of all lengths


def test_unlike_texts_try_few_edits():
    from textloom.operators import review as R

    assert R.worthwhile_edits(100, 100) < 60 < R.worthwhile_edits(2000, 2000) <= R.FEW_EDITS
    asked = []
    plain = R.edit_frontiers
    R.edit_frontiers = lambda x, y, most: asked.append(most) or plain(x, y, most)
    try:
        a, b = [f"a{k}" for k in range(300)], [f"b{k}" for k in range(300)]
        assert list(R.word_edits(a, b)) == list(R._word_edits_by_table(a, b)) and not asked
        assert list(R.word_edits(a, a[:50] + b[:9] + a[55:])) == list(R._word_edits_by_table(a, a[:50] + b[:9] + a[55:])) and asked
    finally:
        R.edit_frontiers = plain


def test_few_texts_are_held_at_once():
    import pyarrow as pa
    from textloom.operators import prose as P

    batch = pa.RecordBatch.from_pydict({"t": pa.array([str(k) for k in range(200)])})
    parts = list(P.pieces(iter([batch, batch])))
    assert max(p.num_rows for p in parts) <= P.AT_ONCE < 200 and pa.Table.from_batches(parts).num_rows == 400


def test_blocks_grow_in_number_not_in_size(spark):
    from textloom.operators import scans as S

    before, S.BLOCK_ROWS = S.BLOCK_ROWS, 50
    try:
        t = spark.range(3000).selectExpr("7L AS book", "id AS ord", "id % 5 AS level")
        rows = S.blocked(t, "book", "ord")
        assert rows.select("_block").distinct().count() > 40 and rows.groupBy("_block").count().agg({"count": "max"}).first()[0] < 200
        got = {r.ord: r.parent for r in S.parent_of(t, "book", "ord", "level").collect()}
        assert got == {k: None if k % 5 == 0 else k - 1 for k in range(3000)}
    finally:
        S.BLOCK_ROWS = before


def test_frequent_grams_aren_t_broadcast_beyond_a_count(spark):
    from textloom.operators import corpus as C

    t = spark.createDataFrame([(k, "a b c a b d. a b c") for k in range(5)], "doc_id long, text string")
    key = lambda df: sorted(tuple(r) for r in df.collect())
    want, most = key(C.branching(t, "doc_id", least=3)), C.BROADCAST_IDS
    C.BROADCAST_IDS = 1
    try:
        beyond = C.branching(t, "doc_id", least=3)
        assert "BroadcastHashJoin" not in beyond._jdf.queryExecution().executedPlan().toString()
        assert key(beyond) == want and ("a b c", 3, 10, 1, 2) in want
    finally:
        C.BROADCAST_IDS = most


def test_views_are_moved_by_their_tasks(spark, tmp_path):
    from pyspark.sql import functions as F
    from textloom.sources import files

    plan = files.view_per_key(spark.range(5).select(F.col("id").alias("page")), str(tmp_path / "v"), "page", F.concat(F.lit("[{\"a\":"), "page", F.lit("}]")))
    assert plan.options["mapreduce.fileoutputcommitter.algorithm.version"] == "2"
    plan.write()
    rows = files.json_arrays(spark, str(tmp_path / "v"), "a int", number=r"page=(\d+)/[^/]*$", below=True).collect()
    assert sorted((r.page, r.a) for r in rows) == [(k, k) for k in range(5)]


def test_stacks_of_whole_texts_and_quotes_by_what_precedes(spark):
    """A text's illegal stacks are those of its syllables, looked up in a list or an array; quotes are found before what precedes them is looked at."""
    from textloom.functions import markup

    texts = ["བསྒྲུབས་ཀྱི། ྱཀཱྵ་ཊ ྐ་ཀྐ\nཀྱ", "", "།་ ", "ཀྲྲ"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    legal = ["ཀྱ", "བ", "ས", "ཀ"]
    whole = [r[0] for r in df.select(markup.illegal_stacks(F.col("t"), legal)).collect()]
    parts = [r[0] for r in df.select(F.flatten(F.transform(markup.syllables(F.col("t")), lambda s: markup.illegal_stacks(s, F.array(*map(F.lit, legal)))))).collect()]
    assert whole == parts and whole[0] and "array_contains" not in df.select(markup.illegal_stacks(F.col("t"), legal))._jdf.queryExecution().toString()
    odd = "'\"a\"' \"\"b\"\". 😀\"c\" '\"d\".' \u2013'e'\n\"f\" x'y'"
    curled = re.sub(f"(?<![^{X.OPENS_AFTER}])\"", "“", odd).replace('"', "”").replace("”.", ".”")
    curled = re.sub(f"(?<![^{X.OPENS_AFTER}”])'", "‘", curled).replace("'", "’")
    assert spark.createDataFrame([(odd,)], "t string").select(X.curly_quotes(F.col("t"))).first()[0] == curled


def test_particles_of_whole_texts_are_those_of_their_syllables(spark):
    """Read backwards, a text gives the particles behind final letters that its syllables give one by one; no window, no row a syllable."""
    import random

    from textloom.functions import markup
    from textloom.plans import glyph_queries as G

    rng = random.Random(28)
    texts = ["".join(rng.choices("ཀགངདསརའཏ་་།\n x\u00a0ྱི😀༌", k=rng.randrange(60))) for _ in range(400)] + ["", "་", "བད་ག", "ད་ག་ག", "བད", "གད།་ \tགས་ཀ་", "བདx😀ི་གབ་ང", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    finals, known = "".join(G.EXPECT), "ཀགང"
    got = sorted((r.id, r.prev, r.got) for r in df.select("id", F.inline(markup.particles(F.col("t"), finals, known))).collect())
    rows = df.select("id", F.posexplode(markup.syllables(F.col("t"))).alias("pos", "s")).select("id", "pos", "s", markup.final_letter(F.col("s")).alias("fin")).orderBy("id", "pos").collect()
    want = sorted((b.id, a.fin, b.s[0]) for a, b in zip(rows, rows[1:]) if a.id == b.id and a.fin and a.fin in finals and b.s[0] in known)
    assert got == want and len(want) > 100
    plan = G.particle_agreement(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "posexplode" not in plan


def test_style_features_in_few_passes_are_those_of_one_pattern_each(spark):
    """Words found together, and characters counted by bytes, are what a pattern for each feature finds; sentences and paragraphs are kept by their trimmed lengths."""
    import random

    from textloom.operators import prose as P

    word = "(?iu)(?<!\\p{L})(?:%s)(?!\\p{L})"
    alone = {name: word % form for name, form in (P.WORDS | P.PHRASES).items()} | {name: f"[{c}]" for name, c in P.CHARACTERS.items()}
    alone |= {"ta_bare": "(?iu)(?<!chúng\\s)(?<!\\p{L})(?:ta)(?!\\p{L})", "italic": r"(?<!\*)\*(?!\*)[^*\n]+\*(?!\*)", "hay": r"(?:^|[.;:!?]\s+|\n)Hãy(?!\p{L})", "bracket_insert": P.PATTERNS["bracket_insert"], "v_v": P.PATTERNS["v_v"]}
    assert list(P.FEATURES) == [n for n in P.FEATURES if n in alone] and len(alone) == len(P.FEATURES)
    rng = random.Random(30)
    pool = "tức là ấy ẤY kia \u212aia đó Đó này chúng ta CHÚNG tôi Ta quý vị các bạn ngài Thầy rinpoche có dạy rằng nói Vì vậy do Cho nên bởi chính vì thế Hãy hãy v.v. ? — : ; “ ” * ** [a] x 1 ́ 😀 . !".split(" ")
    texts = ["".join(rng.choice(pool) + rng.choice([" ", " ", " ", "\n", "", "  ", "\u00a0", ".\n "]) for _ in range(rng.randrange(80))) for _ in range(600)] + ["", "Hãy", "\n Hãy", ".Hãy", "; \n\nHãy Hãy", "*a*b*", "ta", "có nói rằng", "chúng  ta"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = P.feature_counts(df, "t").collect()
    want = {r.id: r for r in df.select("id", *[F.regexp_count("t", F.lit(p)).alias(n) for n, p in alone.items()]).collect()}
    for r in got:
        assert {n: r[n] for n in P.FEATURES} == {n: want[r.id][n] for n in P.FEATURES}, r.t
    assert all(sum(r[n] for r in got) for n in P.FEATURES)
    # a letter beyond the first plane is a letter
    assert P.feature_counts(spark.createDataFrame([("\U0001d400ta ta",)], "t string"), "t").first()["ta_bare"] == 1
    # a pass for all words, one for all phrases, one for each pattern, and none for each word
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    plan = P.style_table(df, "id", "t")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == len(P.PATTERNS) + 2  # Spark counts by extracting

    odd = ["a", " a ", "ab", "a b", "😀", " 😀\t", "😀😀", "", " ", "\u00a0a", "x" * 40, "x" * 41, " x" + " " * 39 + "x ", "x" + " " * 60, "😀" * 40, "😀" * 41]
    t = spark.createDataFrame([(x,) for x in odd], "t string")
    kept = t.select("t", F.size(X.split_sentences(F.col("t"))).alias("s"), F.col("t").rlike(P.OVER_40).alias("p")).collect()
    assert [(r.s, r.p) for r in kept] == [(int(len(r.t.strip(" \t")) > 1), len(r.t.strip(" \t")) > 40) for r in kept]
