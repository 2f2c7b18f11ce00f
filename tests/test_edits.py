"""Diffs by frontiers against the table of all pairs; nearest titles against all pairs."""

import random
import time

import pytest
from pyspark.sql import functions as F

from textloom.operators import offsets, outline, prose, review


def test_frontiers_walk_as_the_table_does(monkeypatch):
    rng = random.Random(1)
    for k in range(3000):
        letters = "abcd"[: rng.randint(1, 4)]
        a, b = ([rng.choice(letters) for _ in range(rng.randint(0, 14))] for _ in range(2))
        monkeypatch.setattr(review, "FEW_EDITS", [256, 3, 0][k % 3])
        assert list(review.word_edits(a, b)) == list(review._word_edits_by_table(a, b))


def test_few_edits_of_long_texts_are_cheap():
    rng = random.Random(2)
    a = [f"w{rng.randint(0, 5000)}" for _ in range(100_000)]
    b = list(a)
    for _ in range(10):
        at = rng.randrange(len(b))
        b[at : at + rng.randint(0, 2)] = ["new"]
    began = time.time()
    edits = list(review.word_edits(a, b))
    assert time.time() - began < 2 and sum(k == "+" for k, _ in edits) == 10
    assert [w for k, w in edits if k != "+"] == a and [w for k, w in edits if k != "-"] == b


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_nearest_titles_of_whole_keys(spark):
    rng = random.Random(3)
    word = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    titles = [("a" if k % 3 else "b", k, word(rng.randint(0, 14), "abé😀")) for k in range(60)] + [("a", 90, None), (None, 91, "x")]
    asked = [("a" if k % 2 else "b", k, word(rng.randint(0, 16), "abéz")) for k in range(30)] + [("a", 50, "q" * 40), ("c", 51, "ab"), ("b", 52, "")]
    got = {(r.book, r.ord): (r.nearest, r.distance) for r in outline.nearest_titles(spark.createDataFrame(asked, "book string, ord int, key string"), spark.createDataFrame(titles, "book string, ord int, key string")).collect()}
    want = {}
    for book, o, key in asked:
        found = sorted((edit_distance(key, t), h, t) for b, h, t in titles if b == book and t is not None)
        if found:
            want[book, o] = (found[0][2], found[0][0])
    assert got == want


@pytest.mark.parametrize("most", [0, 1, 2, 3, 5])
def test_every_title_within_the_threshold_is_found(spark, most):
    rng = random.Random(most)
    titles = [("a", k, "".join(rng.choice("ab") for _ in range(rng.randint(0, 9)))) for k in range(60)]
    asked = [("a", k, "".join(rng.choice("ab") for _ in range(rng.randint(0, 9)))) for k in range(25)]
    t = spark.createDataFrame(titles, "book string, h int, other string").withColumn("size", F.length("other"))
    got = sorted((r.ord, r.h, r.d) for r in outline.titles_within(spark.createDataFrame(asked, "book string, ord int, key string"), t, most).collect())
    assert got == sorted((o, h, edit_distance(key, other)) for _, o, key in asked for _, h, other in titles if edit_distance(key, other) <= most)


def test_views_whose_common_part_is_large_are_refused(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "the cat sat"), (2, None)], "k int, text string")
    terms = spark.createDataFrame([(1, "cat (n)", "gato", "provisional", None), (2, "dog", "perro", "fixed", "a note. more")], "ord int, headword string, rendering string, status string, note string")
    views = {r.k: (r.n_terms, r.view) for r in review.dictionary_views(docs, terms, "k").collect()}
    assert views[1] == (2, "prov  cat (n) -> gato\nFIXED dog -> perro\n      a note. more") and views[2][0] == 1
    monkeypatch.setattr(review, "BINDING_BYTES", 3)
    with pytest.raises(ValueError, match="binds everywhere"):
        review.dictionary_views(docs, terms, "k")
    assert [(r.k, r.ord) for r in review.own_terms(docs, review.term_lines(terms), "k").collect()] == [(1, 1)]


def test_positions_keep_their_words():
    rng = random.Random(5)
    for _ in range(300):
        texts = [" ".join(rng.choice(["ab", "c", "dé", "f,", "g."]) for _ in range(rng.randint(0, 30)))]
        for _ in range(2):
            words = texts[-1].split(" ")
            for _ in range(rng.randint(0, 4)):
                at = rng.randrange(len(words) + 1)
                words[at : at + rng.randint(0, 2)] = rng.choices(["new", "x", "c"], k=rng.randint(0, 2))
            texts.append(" ".join(words))
        first, second = offsets.position_map(texts[0], texts[1]), offsets.position_map(texts[1], texts[2])
        both = offsets.composed(first, second)
        for old, new, n in both:
            assert texts[0][old : old + n] == texts[2][new : new + n]
        assert all(a[0] + a[2] <= b[0] and a[1] + a[2] <= b[1] for a, b in zip(both, both[1:], strict=False))
        for at in range(len(texts[0])):
            one, kept = offsets.carry(at, first, len(texts[1]))
            two, again = offsets.carry(one, second, len(texts[2]))
            to, exact = offsets.carry(at, both, len(texts[2]))
            assert exact == (kept and again) and (not exact or to == two and texts[0][at] == texts[2][to])


def test_marks_are_carried_through_sweep_and_reflow(spark):
    before = "> one “two” three\n\nfour an-so five six, " + "long words " * 20 + "\nand on it goes, seven."
    rules = prose.Sweep(["an-so"], {"three": "drei"}, {}, ("hyphen", "register"))
    swept = rules.text(before)[0]
    flowed = prose.reflow(swept)[0]
    rows = spark.createDataFrame([(1, before, swept, flowed), (2, None, None, None)], "k int, a string, b string, c string")
    marks = spark.createDataFrame([(1, before.index(w)) for w in ("one", "four", "five", "seven", "three")] + [(1, None), (2, 0), (9, 3)], "k int, at int")
    got = {r["at"]: (r.to, r.exact) for r in offsets.carried(rows, marks, "k", ["a", "b", "c"]).where("k = 1").collect()}
    for word in ("one", "four", "five", "seven"):
        to, exact = got[before.index(word)]
        assert exact and flowed[to:].startswith(word)
    assert not got[before.index("three")][1]
