"""Nearest neighbours, phrases and vector codes against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import phrases, vector_codes, vp_trees

KIND = "vec_id long, embedding array<double>, label int, row long, shard int, block int, query_id long, score double, part int"


def vector_rows():
    """Ties, repeated rows and ids, zeros, nulls, infinite, tiny, huge and short vectors; a third of all rows hold one vector."""
    rng = random.Random(2)
    own = lambda n: [rng.gauss(0, 1) for _ in range(n)]
    hot = own(8)
    out = [(i, hot if i % 3 == 0 else own(8), None if i % 5 == 0 else i % 4) for i in range(400)]
    out += [(450, None, 1), (451, [], 1), (452, [0.0] * 8, 1), (453, [None, *own(7)], 1), (454, [float("nan"), *own(7)], 2), (455, [float("inf"), *own(7)], 2), (500, own(5), 2), (500, own(8), 2), (550, [1e-200, *[0.0] * 7], 3), (551, [3e200, *[0.0] * 7], 3), (None, own(8), 3)]
    out += [out[7], out[50], out[50], (600, [-x for x in hot], None)]
    return [(*r, 1, 2, 3, 4, 5.0, 6) for r in out]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(vector_rows(), KIND)


@pytest.fixture(scope="module")
def no_vectors(spark):
    return spark.createDataFrame([], KIND)


def usable(v, zero_too=False):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and (zero_too or any(v))


def cosine(a, b):
    a, b = ([math.ldexp(x, -math.frexp(max(map(abs, v)))[1]) for x in v] for v in (a, b))
    n = max(len(a), len(b))
    a, b = a + [0.0] * (n - len(a)), b + [0.0] * (n - len(b))
    return math.fsum(x * y for x, y in zip(a, b, strict=True)) / math.sqrt(math.fsum(x * x for x in a) * math.fsum(x * x for x in b))


@pytest.mark.parametrize(("shard", "block", "seeds"), [(4096, 1024, 1024), (40, 3, 10), (50, 4, 0)])
def test_factor_one_is_exact(vectors, shard, block, seeds):
    rows = [(i, v) for i, v, *_ in vector_rows() if i is not None and usable(v)]
    got = {}
    for r in vp_trees.nearest_neighbours(vectors, factor=1.0, shard_rows=shard, block_rows=block, seed_rows=seeds).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    queries = [k for k, (i, _) in enumerate(rows) if i % 50 == 0]
    assert sum(map(len, got.values())) == 5 * len(queries)
    for i in {rows[k][0] for k in queries}:
        mine = [k for k in queries if rows[k][0] == i]
        want = []
        for k in mine:
            scored = sorted((-round(cosine(rows[k][1], v), 11), j) for n, (j, v) in enumerate(rows) if n != k)[:5]
            want += [(n, j, -s) for n, (s, j) in enumerate(scored, 1)]
        assert sorted((n, s) for n, _, s in got[i]) == [(n, pytest.approx(s, abs=1e-10)) for n, s in sorted((n, s) for n, _, s in want)]
        assert sorted((n, j) for n, j, _ in got[i]) == sorted((n, j) for n, j, _ in want)


def test_recall_and_whole_answers(spark):
    t = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    x = {r.vec_id: np.array(r.embedding, float) for r in t.collect()}
    ids = np.array(sorted(x))
    units = np.stack([x[i] / np.linalg.norm(x[i]) for i in ids])
    got = {}
    for r in vp_trees.nearest_neighbours(t).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
        assert r.score == pytest.approx(float(units[np.searchsorted(ids, r.query_id)] @ units[np.searchsorted(ids, r.vec_id)]), abs=1e-12)
    hits = 0
    for q in ids[ids % 50 == 0]:
        s = units @ units[np.searchsorted(ids, q)]
        s[ids == q] = -2
        hits += len(got[q] & set(ids[np.lexsort((ids, -s))[:5]].tolist()))
        assert len(got[q]) == 5
    assert hits >= 0.95 * 5 * len(got)


def test_any_factor_returns_enough(vectors):
    n = vp_trees.nearest_neighbours(vectors, factor=1e9, shard_rows=40, seed_rows=0).groupBy("query_id").count().agg(F.min("count")).first()[0]
    assert n >= 5


def test_few_candidates_and_no_rows(spark, no_vectors):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (50, [0.0, 1.0]), (7, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in vp_trees.nearest_neighbours(few).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 50, 0.0), (0, 2, 7, -1.0), (50, 1, 0, 0.0), (50, 2, 7, 0.0)]
    assert vp_trees.nearest_neighbours(no_vectors).isEmpty()


def test_tree_bounds_hold():
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.normal(size=(300, 4)), np.tile(rng.normal(size=4), (200, 1))])
    tree = vp_trees.Tree.build(np.arange(500), np.arange(500), points, 16)
    assert sorted(tree.ids.tolist()) == list(range(500))
    for a, b, vantage, left, right in tree.nodes.tolist():
        assert left >= 0 or b - a <= 16
        if left >= 0:
            d = vp_trees.distance(tree.units[a:b] @ tree.units[vantage])
            half = tree.nodes[left][1] - a
            low_in, high_in, low_out, high_out = tree.bounds[tree.nodes[:, 3].tolist().index(left)]
            assert (d[:half] >= low_in - 1e-7).all() and (d[:half] <= high_in + 1e-7).all() and (d[half:] >= low_out - 1e-7).all() and (d[half:] <= high_out + 1e-7).all()


# --- phrases --------------------------------------------------------------------------------


def phrases_brute(rows, longest, least, top, percent):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            w = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for n in range(1, longest + 1):
                for k in range(len(w) - n + 1):
                    counts[lang, tuple(w[k : k + n])] += 1
    found = {k: a for k, a in counts.items() if a >= least}
    inside = Counter()
    for (lang, g), a in found.items():
        for n in range(2, len(g)):
            for k in range(len(g) - n + 1):
                inside[lang, g[k : k + n]] = max(inside[lang, g[k : k + n]], a)
    out = []
    for (lang, g), a in found.items():
        if len(g) > 1 and 100 * inside[lang, g] < percent * a:
            score, cut, left, right = min((1000 * a * totals[lang] // (found[lang, g[:k]] * found[lang, g[k:]]), k, found[lang, g[:k]], found[lang, g[k:]]) for k in range(1, len(g)))
            out.append((lang, -score, -a, " ".join(g).encode(), left, right, totals[lang]))
    ranked, seen = [], Counter()
    for lang, score, a, phrase, left, right, n in sorted(out):
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], phrase.decode(), -a, left, right, n, -score))
    return ranked


def phrase_rows():
    rng = random.Random(4)
    words = ["the", "of", "Ünïcode", "café", "a\x01b", "naïve", "end", "x", "\x7f", "ab", "ＡＢ", "new", "york", "city"]
    out = []
    for i in range(300):
        text = " ".join(rng.choice(words) + rng.choice(["", "", "", ",", ".", "\n", "\t", "!?", "\x0b"]) for _ in range(rng.randint(0, 60)))
        out.append((i, text + " New YORK city hall", rng.choice(["en", "de", None, "und"])))
    return [*out, (900, None, "en"), (901, "", None), (902, "x " * 5000, "en"), (903, "rare words here only", "fr"), *out[:20]]


@pytest.mark.parametrize(("longest", "least", "top", "percent", "most", "ranges"), [(5, 5, 2000, 100, 1 << 20, 1 << 20), (5, 9, 2000, 60, 1 << 20, 300), (3, 5, 4, 100, 1 << 20, 50), (5, 5, 2000, 100, 3, 400), (2, 1, 2000, 100, 1 << 20, 1 << 20)])
def test_phrases(spark, longest, least, top, percent, most, ranges):
    rows = phrase_rows()
    df = spark.createDataFrame([(*r, 1, 2, "w") for r in rows], "doc_id long, text string, lang string, n long, key int, word string").repartition(4)
    got = [tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in phrases.mine_phrases(df, longest=longest, least=least, top=top, percent=percent, most_words=most, range_keys=ranges).collect()]
    want = phrases_brute([(lang, text) for _, text, lang in rows], longest, least, top, percent)
    assert sorted(got) == sorted(want) and len(want) > 3


def test_phrases_of_nothing(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert phrases.mine_phrases(empty).isEmpty()
    assert phrases.mine_phrases(spark.createDataFrame([("a b", "en"), (None, None)], "text string, lang string")).isEmpty()


def test_scores_beyond_64_bits(spark):
    big = 4 * 10**12
    row = spark.sql(f"SELECT (1000 * CAST({big}L AS decimal(19,0)) * CAST({7 * big}L AS decimal(19,0))) div (CAST({big}L AS decimal(19,0)) * CAST({big}L AS decimal(19,0))) AS s").first()
    assert row.s == 7000


def test_radix_order_and_keys():
    rng = np.random.default_rng(3)
    columns = [rng.integers(0, 5, 1000).astype(np.uint16) for _ in range(4)]
    order = phrases.radix_order(columns)
    rows = list(zip(*[c[order].tolist() for c in columns], strict=True))
    assert rows == sorted(rows)
    ids = np.array([5, 6, 0, 7, 8, 9, 0, 4, 0], np.uint32) + np.array([1 << 20, 0, 0, 0, 0, 0, 0, 0, 0], np.uint32)
    keys = list(zip(*[c.tolist() for c in phrases.keys_of(ids, 3, 2)], strict=True))
    assert keys == [(16, 5, 0, 6, 0, 0), (0, 7, 0, 8, 0, 9), (0, 8, 0, 9, 0, 0)]
    assert phrases._kept(np.array([0, 0, 1, 0, 2, 3, 0, 0, 4, 5, 0, 6])).tolist() == [2, 3, 0, 4, 5, 0]


# --- vector codes -----------------------------------------------------------------------------


def codes_brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, v, lab) for i, v, lab in rows if usable(v, True)]
    width = max(1, -(-max(len(v) for _, v, _ in kept) // parts)) * parts

    def floor(x):
        a, b = x.as_integer_ratio()
        return a * scale // b

    x = [[floor(c) for c in v] + [0] * (width - len(v)) for _, v, _ in kept]
    d = width // parts
    x = [[tuple(v[p * d : p * d + d]) for p in range(parts)] for v in x]
    start = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[x[k][p] for k in start] for p in range(parts)]
    dist = lambda a, b: sum((s - t) ** 2 for s, t in zip(a, b, strict=True))
    assign = lambda: [[min(range(len(books[p])), key=lambda e: (dist(v[p], books[p][e]), e)) for p in range(parts)] for v in x]
    for _ in range(rounds):
        code = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [v[p] for v, c in zip(x, code, strict=True) if c[p] == e]
                if own:
                    books[p][e] = tuple(sum(c) // len(own) for c in zip(*own, strict=True))
    code = assign()
    sha = hashlib.sha256(",".join(str(c) for p in books for e in p for c in e).encode()).hexdigest()
    errors = [sum(dist(v[p], books[p][c[p]]) for p in range(parts)) for v, c in zip(x, code, strict=True)]
    total = Counter()
    for (_, _, lab), e in zip(kept, errors, strict=True):
        total[lab] += e
    small = lambda e: e if e < 1 << 63 else None
    return sorted(((i, "".join(f"{e:02x}" for e in c), small(e), small(total[lab]), sha) for (i, _, lab), c, e in zip(kept, code, errors, strict=True)), key=str)


def coded(df, **options):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in vector_codes.encode_vectors(df, **options).collect()), key=str)


def test_codes(vectors, spark):
    # One vector of 3e200 makes integers of more than 600 bits.
    assert coded(vectors, block_rows=64) == codes_brute([r[:3] for r in vector_rows()])


@pytest.mark.parametrize(("parts", "entries", "rounds", "rows"), [(8, 16, 6, 37), (2, 3, 9, 500), (1, 1, 2, 64), (4, 30, 0, 64)])
def test_codes_of_plain_vectors(spark, parts, entries, rounds, rows):
    rng = random.Random(parts)
    own = [(i, [round(rng.gauss(i % 5, 0.7), rng.choice([1, 6])) for _ in range(16)], i % 3) for i in range(300)]
    df = spark.createDataFrame(own, "vec_id long, embedding array<float>, label int").repartition(3)
    exact = [(i, [float(np.float32(x)) for x in v], lab) for i, v, lab in own]
    assert coded(df, parts=parts, entries=entries, rounds=rounds, block_rows=rows) == codes_brute(exact, parts, entries, rounds)


def test_codes_of_few_rows(spark, no_vectors):
    assert vector_codes.encode_vectors(no_vectors).isEmpty()
    few = [(3, [], None), (None, [0.5], 1), (1, [float("nan")], 1)]
    df = spark.createDataFrame(few, "vec_id long, embedding array<double>, label int")
    assert coded(df) == codes_brute(few)
    assert coded(spark.createDataFrame([(1, [], 2)], "vec_id long, embedding array<double>, label int")) == codes_brute([(1, [], 2)])


def test_only_violated_parts_are_popped():
    heaps = vector_codes.Heaps(1, 2)
    heaps.push(0, np.array([5.0, 1.0, 3.0]), np.array([10, 11, 12]), np.array([0, 0, 1]))
    again = vector_codes.Heaps.frombytes(1, 2, *heaps.tobytes())
    places, entries = again.violated(0, np.array([1.0, 2.9]))
    assert places.tolist() == [11] and entries.tolist() == [0]
    assert again.assigned(13)[[10, 12], 0].tolist() == [0, 1]
