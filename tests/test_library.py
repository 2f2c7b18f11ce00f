"""Operators that TESTDATA exercises little, on inline fixtures."""

import random

import pytest
from pyspark.sql import functions as F

from textloom.functions import markup, text as X
from textloom.operators import corpus as C, ledger as L, outline as O, prose as P, review as R
from textloom.sources import files
from textloom.streaming import incremental


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("x")).first().x


def test_counts(spark):
    assert one(spark, X.count_overlapping(F.col("t"), "aa"), t="aaaa") == 3
    assert one(spark, X.count_literal(F.col("t"), "aa"), t="aaaa") == 2
    assert one(spark, X.count_literal(F.col("t"), ""), t="aaaa") == 0
    assert one(spark, X.count_word(F.col("t"), "an"), t="an ant an. án") == 2
    assert one(spark, X.count_literal(F.col("t"), "a.b"), t="a.b axb") == 1


def test_sentences(spark):
    col = X.sentences(F.col("t"), ("v.v.",))
    assert one(spark, col, t="One. Two!” Three v.v. more. v.v. End? no stop") == ["One.", "Two!”", "Three v.v. more.", "v.v.", "End?", "no stop"]
    assert one(spark, X.words(F.col("t")), t="a b  c ") == ["a", "b", "c"]


def test_quantiles(spark):
    df = spark.createDataFrame([(list(range(1, 11)),), ([],)], "v array<int>")
    got = df.select(X.index_quantile(F.col("v"), 0.9), X.index_quantile(F.col("v"), 0.9, "floor_n1"), X.index_quantile(F.col("v"), 1.0, "clamped")).collect()
    assert [tuple(r) for r in got] == [(10, 9, 10), (None, None, None)]


def test_quotes(spark):
    assert one(spark, X.curly_quotes(F.col("t")), t="\"He said 'no' to \"it\".\" don't") == "“He said ‘no’ to “it.”” don’t"
    assert one(spark, X.curly_quotes(F.col("t")), t='x ""') == "x “”"
    assert one(spark, X.curly_quotes(F.col("t")), t="a:\"b\";'c'") == "a:“b”;‘c’"
    assert one(spark, X.period_inside_quote(F.col("t")), t="“so”. ‘a’.") == "“so.” ‘a’."


def test_respell_and_hyphens(spark):
    assert one(spark, X.respell(F.col("t"), {"colour": "color"}), t="Colour COLOUR colours colour") == "Color COLOR colours color"
    assert one(spark, X.respell(F.col("t"), {"tion": "sion"}, whole_words=False), t="Nation TION") == "Nasion SION"
    assert one(spark, X.dehyphenate(F.col("t"), ["to-day", "day-by-day", "day-by"]), t="To-Day, day-by-day xto-day DAY-By") == "To Day, day by day xto-day DAY By"


def test_heads(spark):
    assert one(spark, X.headword(F.col("t")), t="word (noun)") == "word"
    assert one(spark, X.first_sentence(F.col("t"), 10), t="Short. More") == "Short."
    assert one(spark, X.first_sentence(F.col("t"), 10), t="This is a longer one. More") == "This is a "
    assert one(spark, X.first_sentence(F.col("t"), 10), t="This is never to be cut. More") == "This is never to be cut. More"
    assert one(spark, X.first_sentence(F.col("t"), 10, F.lit(True)), t="A note that binds") == "A note that binds"
    assert one(spark, X.locator_at(F.col("t"), F.col("n")), t="abcabd", n="abd") == 4
    assert one(spark, X.locator_at(F.col("t"), F.col("n")), t="abcabd", n="bc⟪⟫ab") == 4
    assert one(spark, X.locator_at(F.col("t"), F.col("n")), t="abcabd", n="ab") is None
    assert one(spark, X.locator_at(F.col("t"), F.col("n")), t="abcabd", n="zz") is None
    assert one(spark, X.suffix_prefix_overlap(F.col("a"), F.col("b"), 2, 5), a="xxabcab", b="abcabzz") == 5
    assert one(spark, X.strip_front_matter(F.col("t")), t="---\r\na: b\r\n---\r\nBody\r\n") == "Body\n"
    assert one(spark, X.entity_decode(X.html_escape(F.col("t"))), t="a<b & c>") == "a<b & c>"
    assert [one(spark, X.first_difference(F.col("a"), F.col("b")), a=a, b=b) for a, b in (("abc", "abd"), ("abc", "ab"), ("", "x"), ("same", "same"))] == [3, 3, 1, None]
    assert [one(spark, X.hanging(F.col("t")), t=t) for t in ("He went", "He went.", "# He went", "said “so”", "- item", "a*", "")] == [True, False, False, False, False, False, False]
    assert one(spark, X.title_key(X.tidy_title(F.col("t"))), t=" A  title ..... ") == "Atitle"
    assert one(spark, X.progress_bar(F.lit(1), F.lit(4), 8), t="") == "██░░░░░░"


def test_line_kinds(spark):
    kinds = [one(spark, X.line_kind(F.col("t")), t=t) for t in ("", "```x", "## h", "> q", "- l", "1. l", "text", "---", "| a |", "    code", "**")]
    assert kinds == ["blank", "fence", "other", "quote", "other", "other", "text", "other", "other", "other", "text"]
    assert kinds == [P._line_kind(t) for t in ("", "```x", "## h", "> q", "- l", "1. l", "text", "---", "| a |", "    code", "**")]


def test_markup(spark):
    assert markup.outside_protected("a `a` *it's* a <a>", str.upper) == "A `a` *it's* A <A>"
    assert markup.outside_protected("---\na: b\n---\nx *Mẹ's* y", str.upper) == "---\na: b\n---\nX *MẸ'S* Y"
    df = spark.createDataFrame([("a `a`",), (None,)], "t string")
    assert [r.x for r in df.select(markup.protected_udf(str.upper)("t").alias("x")).collect()] == ["A `a`", None]
    page = markup.markdown_html("# T\n\na *b* <c> `*d*`\n\n> q\n\n- x\n- y\n\n---\n\n|a|b|\n|-|-|\n|1|2|\n\n```\ncode\n\nmore\n```\nend")
    assert page == "<h1>T</h1>\n<p>a <em>b</em> &lt;c&gt; <code>*d*</code></p>\n<blockquote>q</blockquote>\n<ul><li>x</li><li>y</li></ul>\n<hr>\n<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>\n<pre>code\n\nmore</pre>\n<p>end</p>"
    assert markup.insert_marker("# Head\ntext", 0, "[1]") == "[1]\n\n# Head\ntext"
    assert markup.insert_marker("a\n> q", 2, "[1]") == "a\n> [1]q" and markup.insert_marker("- q", 0, "[1]") == "- [1]q"
    assert markup.insert_marker("a b", 2, "[1]") == "a [1]b"
    assert markup.enumerations("has three: kinds of rope", "has", {"kinds": "sorts", "rope": "lines"}, "things") == "has three sorts: kinds of rope"
    cmap = "1 beginbfchar <01> <0F40> endbfchar 1 beginbfrange <02> <03> <0041> <05> <06> [<0061> <0062>] endbfrange"
    assert markup.code_map(cmap) == [(1, "ཀ"), (2, "A"), (3, "B"), (5, "a"), (6, "b")]


def test_stacks(spark):
    df = spark.createDataFrame([("བསྒྲུབས་ཀྱི། ྱཀཱྵ་ཊ",)], "t string").select(F.explode(markup.syllables(F.col("t"))).alias("s"))
    legal = F.array(F.lit("ཀྱ"), F.lit("བ"), F.lit("ས"), F.lit("ཀ"))
    rows = df.select("s", markup.stacks(F.col("s")).alias("k"), markup.illegal_stacks(F.col("s"), legal).alias("bad"), markup.final_letter(F.col("s")).alias("last")).collect()
    assert [(r.s, r.k, r.bad, r["last"]) for r in rows] == [
        ("བསྒྲུབས", ["བ", "སྒྲ", "བ", "ས"], [], "ས"), ("ཀྱི", ["ཀྱ"], [], None), ("ྱཀཱྵ", ["ྱ", "ཀ", "ྵ"], ["ྱ"], None), ("ཊ", ["ཊ"], [], None),
    ]
    assert markup.legal_stacks("ཀར", {"ར": "ཀ"}, {"ྱ": "ཀ"}, ("x",)) == sorted(["ཀ", "ར", "རྐ", "ཀྱ", "x"])


def test_folds(spark):
    rng = random.Random(1)
    data = [("g", k, rng.choice([1, 2, 3, 9, 10, 11, 30])) for k in range(40)]
    df = spark.createDataFrame(data, "g string, k int, v int")
    want = []
    for v in sorted(x[2] for x in data):
        if want and abs(sum(want[-1]) / len(want[-1]) - v) < 1.2:
            want[-1].append(v)
        else:
            want.append([v])
    got = [(r.cluster, r["mean"], r.n) for r in C.cluster_means(df, "g", "v", 1.2).orderBy("cluster").collect()]
    assert got == [(k + 1, pytest.approx(sum(c) / len(c), abs=1e-6), len(c)) for k, c in enumerate(want)]
    spans, total = [], 0
    for _, k, v in data:
        if spans and total + v <= 20:
            spans[-1][1], total = k, total + v
        else:
            spans.append([k, k])
            total = v
    assert [[r["first"], r["last"]] for r in C.greedy_spans(df, "g", "k", "v", 20).orderBy("span").collect()] == spans


def test_chunks_cover(spark):
    sections = spark.createDataFrame([("b", p) for p in (1, 2, 3, 9, 10, 30)] + [("b", None)], "book string, start_page int")
    pages = spark.createDataFrame([("b", 40)], "book string, last_page int")
    chunks = L.section_chunks(sections, pages)
    rows = [(r["first"], r["last"]) for r in chunks.orderBy("chunk").collect()]
    assert rows[0][0] == 1 and rows[-1][1] == 40 and all(b - a + 1 <= 5 for a, b in rows)
    assert L.coverage_problems(chunks, 1, 40).isEmpty() and L.coverage_problems(chunks, 1, 41).count() == 1


def test_refresh_and_merge(spark):
    cur = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, text string")
    h = {r.k: r.h for r in cur.select("k", X.content_hash(F.col("text")).alias("h")).collect()}
    old = spark.createDataFrame([(1, h[1], 1), (2, h[1], 1), (3, h[3], 0), (4, "x", 1)], "k int, hash string, rule_version int")
    assert {r.k: r.status for r in L.refresh(cur, old, "k").collect()} == {1: "fresh", 2: "stale", 3: "stale", 4: "gone"}
    results = spark.createDataFrame([("t", "v1", 1, "pass"), ("t", "v2", 2, "fail"), ("u", "w", 1, "pass"), ("u", "w2", 2, "pass")], "term string, value string, ord int, verdict string")
    settled = spark.createDataFrame([("t", "v0"), ("z", "q")], "term string, value string")
    merged, conflicts = L.merge_results(results, settled)
    assert {r.term: r.value for r in merged.collect()} == {"t": "v0", "u": "w2", "z": "q"}
    assert [(r.term, r.value, r.settled) for r in conflicts.collect()] == [("t", "v1", "v0")]


def test_anchors_and_content(spark):
    chunks = spark.createDataFrame([("c1", "one two one"), ("c2", "three")], "chunk string, text string")
    anchors = spark.createDataFrame([(1, "c1", "two"), (2, "c1", "one"), (3, "c2", "zzz"), (4, "c9", "x")], "page int, chunk string, locator string")
    assert {r.page: (r.status, r["at"]) for r in L.place_anchors(anchors, chunks).collect()} == {1: ("placed", 5), 2: ("open", None), 3: ("open", None), 4: ("open", None)}
    a = spark.createDataFrame([(1, "Ab, c"), (2, "abc"), (3, "abc")], "k int, text string")
    b = spark.createDataFrame([(1, "abC!"), (2, "abd"), (3, "abcd")], "k int, text string")
    assert sorted((r.k, r["at"]) for r in L.same_content(a, b, "k").collect()) == [(2, 3), (3, 4)]


def test_assembly(spark):
    cut, on = "\n\n*(tiếp sang chunk sau.)*", "*(…tiếp theo:)* "
    rows = [("b", 1, "---\na: b\n---\nFirst part runs…" + cut), ("b", 2, on + "… on to\nthe end."), ("b", 3, "> quoted" + cut), ("b", 4, "> " + on + "> more"), ("b", 5, "> said" + cut), ("b", 6, on + "plain"), ("b", 7, on + "alone"), ("b", 8, "last" + cut)]
    parts, anomalies, stutters = L.assemble(spark.createDataFrame(rows, "book string, chunk int, text string"))
    got = [r.text for r in parts.orderBy("part").collect()]
    assert got[0] == "First part runs… on to\nthe end." and got[2:] == ["> said\n\nplain", "alone", "last"]
    assert [(r.chunk, r.what) for r in anomalies.orderBy("chunk").collect()] == [(7, "opens alone"), (8, "closes last")] and stutters.isEmpty()
    with pytest.raises(ValueError, match="unresolved"):
        L.require_none(anomalies, "anomalies")


def lcs_table(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    return best


def test_diff(spark):
    """Word edits against the whole table; the marks they are shown by."""
    assert R.lcs_marks("a b c d", "a x c") == (2, 2, 1, "a ~~b ~~**x **c ~~d ~~")
    assert R.lcs_marks(None, "a") == (0, 0, 1, "**a **")
    rng = random.Random(4)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 30))] for _ in range(2))
        best, i, j = lcs_table(a, b), 0, 0
        for kind, word in R.word_edits(a, b):
            if i < len(a) and j < len(b):
                assert kind == ("=" if a[i] == b[j] else "-" if best[i + 1][j] >= best[i][j + 1] else "+")
            assert word == (b[j] if kind == "+" else a[i])
            i, j = i + (kind != "+"), j + (kind != "-")
        assert (i, j) == (len(a), len(b))
    long = [rng.choice(["x", "y", str(k % 50)]) for k in range(3000)]
    assert sum(k == "=" for k, _ in R.word_edits(long, long[:1500] + ["new"] + long[1400:])) == 3000
    df = spark.createDataFrame([(1, "a b", "a c"), (2, "", "z")], "k int, before string, after string")
    assert {r.k: (r.kept, r.removed, r.added) for r in R.word_diff(df, ["k"]).collect()} == {1: (1, 1, 1), 2: (0, 0, 1)}


def test_review_pairs():
    """Pairs within three places, best first come, each once; against a search over all choices."""
    rng = random.Random(9)
    for _ in range(60):
        lines = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "zeta"]) for _ in range(4)) for _ in range(9)]
        after = [x for x in lines if rng.random() < 0.8]
        rng.shuffle(after)
        used = set()
        for i, (p, q) in enumerate(P.pair_paragraphs(lines, after)):
            near = [(len(set(p.split()) & set(after[j].split())) / max(len(set(p.split())), len(set(after[j].split()))), -j) for j in range(max(0, i - 3), min(len(after), i + 4)) if j not in used]
            best = max(near, default=(0, 0))
            assert q == (after[-best[1]] if best[0] >= 0.5 else None)
            if q is not None:
                used.add(-best[1])


def test_review_of_versions(spark):
    before = "---\na: b\n---\nThe same line here stays\nThis line loses some words now\nThis one goes away entirely"
    df = spark.createDataFrame([(1, before, "The same line here stays\nThis line loses words now")], "k int, before string, after string")
    assert [(r.para, r.status, r.markup) for r in P.review(df, "k").collect()] == [(1, "changed", "This line loses ~~some ~~words now"), (2, "lost", None)]


def test_sweep():
    rules = P.Sweep(["to-day", "to-day-so"], {"tánh": "tính"}, {"Đại thừa": "Đại Thừa"})
    text, stats = rules.text("---\nt: \"x\"\n---\nHe \"said\" 'so'\". `\"c\"` *sme'u zan* To-Day-So, Tánh Đại thừa\n> short one\n> and two\n> end\nplain")
    assert text == "---\nt: \"x\"\n---\nHe “said” ‘so’.” `\"c\"` *sme'u zan* To Day So, Tính Đại Thừa\n> short one  \n> and two  \n> end\nplain"
    assert stats == {"quotes": 3, "periods": 1, "singles": 2, "verse": 2, "hyphen": 1, "register": 1, "names": 1}
    assert rules.text(text)[0] == text
    assert rules.locator('và "tánh" to-day') == "và “tính” to day"
    long = "> " + "x" * 80
    assert P.verse_breaks([long, "> b"]) == 0 and P.verse_breaks(["> a", "> b", ">", "> c"]) == 1


def test_reflow():
    full, short = "word " * 16 + "end", "a verse line,"
    text = f"---\nk: v\n---\n# head\n{full}\n{full}\ntail\n\n{short}\n{short}\nlast\n\n> {full}\n> {full}\n>\n> {short}\n> x\n\n```\n{full}\n{full}\n```\n"
    out, joined, kept, ambiguous = P.reflow(text)
    assert out == f"---\nk: v\n---\n# head\n{full} {full} tail\n\n{short}\n{short}\nlast\n\n> {full} {full}\n>\n> {short}\n> x\n\n```\n{full}\n{full}\n```\n"
    assert (joined, kept, ambiguous) == (3, 5, 0) and P.reflow(out)[0] == out
    mixed = "x" * 84 + ",\n" + "short one,\n" + "another,\nend"
    assert P.reflow(mixed) == (mixed, 0, 4, 1)


def test_prose_and_metrics(spark):
    text = "---\na: \"b\"\n---\n# Head\n" + "Lone short line.\n\nverse one\nverse two\n\n> " + "One two v.v. three. Four v.v. Five six” done; " * 3 + "\n- item\n1. item\n> a\n> b\n"
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "k int, text string")
    assert [len(r.prose or []) for r in P.prose(df, ["k"]).orderBy("k").collect()] == [2, 0, 0]
    m = {r.k: r for r in P.prose_metrics(df, "k").collect()}
    assert (m[1].words, m[1].sents, m[1]["max"], m[1].straight_quotes, m[1].verse_no_break) == (3 + 27, 8, 7, 0, 1)
    assert (m[2].words, m[3].words, m[3].sents) == (0, 0, 0)


def test_outline_against_brute_force(spark):
    rng = random.Random(11)
    entries = [("b", k, rng.choice("xyz"), rng.choice([None, rng.randint(0, 40)])) for k in range(40)]
    heads = [("b", k, rng.choice("xyz"), p) for k, p in enumerate(sorted(rng.randint(0, 40) for _ in range(30)))]
    got = {r.ord: (r.page, r.heading) for r in O.match_headings(spark.createDataFrame(entries, "book string, ord int, key string, want int"), spark.createDataFrame(heads, "book string, ord int, key string, page int")).collect()}
    used = set()
    for _, o, key, want in entries:
        free = [(h, p) for _, h, k, p in heads if k == key and h not in used]
        best = min(free, key=lambda x: (abs(x[1] - want) if want is not None else 0, x[0]), default=None)
        assert got[o] == ((best[1], best[0]) if best else (None, None))
        if best:
            used.add(best[0])


def test_doctor_and_selectors(spark):
    rec = spark.createDataFrame([(1, "pending", None, None), (2, "done", "s", "o"), (3, "done", "s", None), (4, "done", "x", "y")], "k int, status string, source_hash string, output_hash string")
    now = spark.createDataFrame([(1, "s", "o"), (2, "s", None), (3, "s", "o"), (4, "s", "o")], "k int, source_now string, output_now string")
    flags = {r.k: [c for c in ("missing", "orphan", "edited", "stale", "unstamped") if r[c]] for r in C.reconcile_records(rec, now, "k").collect()}
    assert flags == {1: ["orphan"], 2: ["missing"], 3: ["unstamped"], 4: ["edited", "stale"]}
    assert sorted(r.k for r in L.select_rows(rec, "k", ids=[1, 9]).collect()) == [1]
    merged = L.merge_by_kind(spark.createDataFrame([(1, "a", 1, "x"), (1, "a", 2, "y"), (2, "b", 1, "z")], "k int, kind string, o int, v string"), "k", "kind", "o", "v", ("a", "b"))
    assert {r.k: (r.a, r.b) for r in merged.collect()} == {1: ("y", None), 2: (None, "z")}


def test_dictionary_slices(spark, monkeypatch):
    """A dictionary beyond one automaton gives the same hits in slices."""
    docs = spark.createDataFrame([(k, f"w{k} w{k + 1} w{k}{k}") for k in range(60)], "k int, text string")
    phrases = spark.createDataFrame([(k, f"w{k}") for k in range(60)] + [(99, "")], "p int, phrase string")
    rows = lambda: (sorted(map(tuple, R.phrase_hits(docs, phrases, "p").collect())), sorted(map(tuple, R.phrase_pairs(docs, phrases, "k").collect())))
    whole = rows()
    monkeypatch.setattr(R, "MAX_PHRASES", 7)
    assert rows() == whole and len(whole[0]) == 60


def test_nearest_and_ranges(spark):
    rng = random.Random(2)
    left = [(k, "g", rng.randint(0, 50)) for k in range(20)]
    right = [(100 + k, "g", rng.randint(0, 50)) for k in range(15)]
    schema = "k long, g string, v long"
    got = {r.k: (r.match, r.gap) for r in R.nearest(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), "g", "v", "k").collect()}
    assert got == {k: min((abs(v - w), j) for j, _, w in right)[::-1] for k, _, v in left}
    both = spark.createDataFrame(left, schema)
    assert {r.k: (r.match, r.gap) for r in R.nearest(both, both, "g", "v", "k").collect()} == {k: min((abs(v - w), j) for j, _, w in left if j != k)[::-1] for k, _, v in left}
    ranges = [(k, *sorted((rng.randint(-5, 3000), rng.randint(-5, 3000)))) for k in range(20)]
    pts = [(rng.randint(0, 3000),) for _ in range(200)]
    counted = R.count_in_ranges(spark.createDataFrame(ranges, "k int, lo long, hi long"), spark.createDataFrame(pts, "n long"), "k", "lo", "hi", "n", "c").collect()
    assert {r.k: r.c for r in counted} == {k: sum(a <= p <= b for (p,) in pts) for k, a, b in ranges}


def test_parents_and_gate(spark):
    levels = [0, 2, 3, 1, 1, 3, 0, 4]
    df = spark.createDataFrame([("d", k, v) for k, v in enumerate(levels)], "d string, o int, l int")
    got = {r.o: r.parent for r in C.parent_of(df, "d", "o", "l").collect()}
    assert got == {k: max((j for j in range(k) if levels[j] < v), default=None) for k, v in enumerate(levels)}
    g = R.gate(spark.createDataFrame([("a", 3)], "name string, value long"), spark.createDataFrame([("a", 3), ("b", 0)], "name string, most long"))
    assert {r.name: r.ok for r in g.collect()} == {"a": True, "b": False}


def test_files(spark, tmp_path):
    (tmp_path / "p").mkdir()
    for n in (1, 2, 5):
        (tmp_path / "p" / f"p{n:04}.txt").write_text(f"para one {n}\n\npara two\n")
    pages = files.page_texts(spark, str(tmp_path / "p"), 1, 4)
    assert sorted(r.page for r in pages.collect()) == [1, 2] and files.paragraphs(pages).count() == 4
    (tmp_path / "g0007.json").write_text('[{"code": 1, "x": 2.5}, {"code": 2}]')
    assert [(r.page, r.ord, r.code, r.x) for r in files.json_arrays(spark, str(tmp_path / "g0007.json"), "code int, x double").orderBy("ord").collect()] == [(7, 0, 1, 2.5), (7, 1, 2, None)]
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.jsonl").write_text('{"type":"result","result":{"k":"a"}}\n\nnot json\n{"type":"start"}\n')
    assert [r.k for r in files.journal(spark, str(tmp_path / "j"), "k string").collect()] == ["a"]
    (tmp_path / "c001.md").write_bytes(b"---\r\nchunk: c001\r\nkind: body\r\n---\r\nText: here\r\n")
    r = files.markdown_chunks(spark, str(tmp_path / "c001.md")).first()
    assert r.chunk == "c001" and r.front == {"chunk": "c001", "kind": "body"} and r.body == "Text: here\n"
    assert "<!-- page 1 -->" in files.whole_book(pages).first().text


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    plan = files.ledger(df, str(tmp_path / "l"))
    assert not (tmp_path / "l").exists()
    plan.write()
    assert spark.read.json(str(tmp_path / "l")).count() == 2
    with pytest.raises(ValueError, match="recorded"):
        files.ledger(df.limit(1), str(tmp_path / "m"), recorded=df, key="k")
    files.view_per_key(df, str(tmp_path / "v"), "k", F.concat("k", F.lit("!"))).write()
    assert (tmp_path / "v" / "k=a").is_dir()
    assert [r.line for r in files.fixed_width(df.orderBy("k"), {"k": 3, "v": 4}).collect()] == ["a      1", "b      2"]
    assert files.status_document({"T": df}, "S").splitlines()[:5] == ["# S", "", "## T", "", "| k | v |"]
    files.swap(files.ledger(df.limit(1), str(tmp_path / "l"), force=True), spark)
    assert spark.read.json(str(tmp_path / "l")).count() == 1 and not (tmp_path / "l.new").exists()
    units = files.lexicon_units(spark.createDataFrame([("a-b",), ("b-c",)], "w string"), "w", "-")
    assert sorted(r.unit for r in units.collect()) == ["a", "b", "c"]


def test_streams(spark, tmp_path):
    rows = [(k, f"t{k % 3}", f"2024-01-01 00:{k:02}:00") for k in range(50)]
    df = spark.createDataFrame(rows, "id int, text string, ts string").withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(str(tmp_path / "in"))
    stream = incremental.text_stream(spark, str(tmp_path / "in"), "id int, text string, ts timestamp")

    def drain(out, name, mode):
        q = out.writeStream.format("memory").queryName(name).outputMode(mode).start()
        q.processAllAvailable()
        q.stop()
        return spark.table(name).collect()

    assert len(drain(incremental.first_seen(stream, "id", "text", "ts"), "seen", "append")) == 3
    assert sum(r.n for r in drain(incremental.windowed_counts(stream, "ts", "text", "30 minutes"), "counts", "complete")) == 50
    assert sum(r.n for r in drain(incremental.sessions(stream, "ts", "text", "5 minutes"), "sess", "complete")) == 50


def test_glyph_pages(spark):
    from textloom.operators import glyphs as G

    rows, order = [], 0
    for page in (1, 2):
        for k, (text, x0) in enumerate([("abcdefgh", 70.0), ("ijklmnop", 50.0), ("qrs", 50.0), ("tuvwxyza", 50.0)]):
            for j, c in enumerate(text):
                rows.append((page, order, "F1", ord(c), c, x0 + 10 * j, 400.0 - 20 * k + 0.5 * (j % 2), 12.0, 10.0))
                order += 1
        rows.append((page, order, "Folio", 49, "1", 100.0, 300.0, 9.0, 5.0))
        rows.append((page, order + 1, "F1", 50, "2", 100.0, 700.0, 9.0, 5.0))
        order += 2
    g = spark.createDataFrame(rows, "page int, ord int, font string, code int, u string, x double, y double, size double, w double")
    repairs = spark.createDataFrame([(ord("q"), "Q")], "code int, to string")
    maps = spark.createDataFrame([("F1", ord("t"), "T")], "font string, code int, unicode string")
    pages = {r.page: r.text for r in G.clean_pages(g, repairs, maps, ["Folio"]).collect()}
    assert pages == {p: "abcdefghijklmnopQrs\n\nTuvwxyza" for p in (1, 2)}
    assert G.order_proof(g, repairs, maps, ["Folio"]).isEmpty()
    assert {(r.font, r.code): (r.n, r.pages) for r in G.usage(g).collect()}[("F1", ord("a"))] == (4, 2)
    assert G.heading_lines(g, 12.0, ["F1"], 500.0).count() > 0
    lines = spark.createDataFrame([(1, 0, 100.0, "A"), (1, 1, 90.0, "b"), (1, 2, 60.0, "C")], "page int, line int, y double, text string")
    assert [r.text for r in G.wrapped_runs(lines).orderBy("run").collect()] == ["A b", "C"]
