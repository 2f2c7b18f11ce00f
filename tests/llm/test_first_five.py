"""Quality rules, exact dedup, n-gram join, mixing and BPE against plain Python."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import bpe, exact_dedup, mixing, ngram_join, quality_rules
from textloom.session import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", ["odd", "real", "empty"])
def test_exact_dedup(request, name):
    df = request.getfixturevalue(name)
    groups = defaultdict(list)
    for i, t in rows_of(df):
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i))
    want = {i: (min(g)[1], len(g), min(g)[1] == i, hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for _, i in g}
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_dedup(df).collect()}
    assert got == want


def test_exact_dedup_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "ab"), (2, "c")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(df).collect())
    assert got == [("1", 1, 3, True), ("1", 1, 3, True), ("2", 2, 1, True), ("None", 1, 3, False)]


def test_rice_round_trip():
    rng = np.random.default_rng(1)
    for n, span in ((0, 10), (1, 30), (500, 12), (1000, 40)):
        values = np.unique(rng.integers(0, 1 << span, n).astype(np.uint64))
        rice = exact_dedup.best_rice(len(values), span)
        assert (exact_dedup.rice_decode(exact_dedup.rice_encode(values, rice), len(values), rice) == values).all()


@pytest.mark.parametrize("name", ["odd", "real", "empty"])
def test_quality_counts(request, name):
    df = request.getfixturevalue(name)
    got = {r.doc_id: r for r in quality_rules.score_quality(df).collect()}
    assert len(got) == df.count()
    for i, t in rows_of(df):
        w = WORD.findall(t or "")
        seen, where = defaultdict(list), set()
        for k in range(len(w) - 2):
            seen[tuple(w[k : k + 3])].append(k)
        for ks in seen.values():
            if len(ks) > 1:
                where.update(k + j for k in ks for j in range(3))
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(where)), i
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in t or "")
        assert r.base_failed == (len(w) < 50 or 100 * len(where) > 50 * len(w))
        assert not (r.base_failed and r.kept) and 0 <= r.p_good <= 1


def test_quality_em_recovers_accuracies(spark):
    """Rules simulated with known voting rates in either class: the estimate finds them."""
    rng = np.random.default_rng(3)
    rules = [("", -1, "")] * 5 + [("", 1, "")] * 3
    good, bad = np.array([0.002, 0.004, 0.001, 0.003, 0.002, 0.9, 0.8, 0.7]), np.array([0.5, 0.4, 0.3, 0.6, 0.35, 0.3, 0.4, 0.2])
    is_good = rng.random(40_000) < 0.7
    fires = rng.random((len(is_good), 8)) < np.where(is_good[:, None], good, bad)
    votes = fires * np.array([v for _, v, _ in rules])
    df = spark.createDataFrame([(v.tolist(),) for v in votes], "votes array<tinyint>")
    p = quality_rules.estimate(df, rules).first().params
    assert abs(p.prior - 0.7) < 0.02 and np.abs(np.array(p.good) - good).max() < 0.02 and np.abs(np.array(p.bad) - bad).max() < 0.03


def test_quality_keeps_labelled_good(spark):
    d = "/root/testdata/sf0.01"
    scored = quality_rules.score_quality(table(spark, d, "documents")).join(table(spark, d, "labels"), "doc_id")
    rows = [(r.quality, r.base_failed, r.kept) for r in scored.select("quality", "base_failed", "kept").collect()]
    good = [k for q, b, k in rows if q == 1 and not b]
    bad = [k for q, b, k in rows if q == 0]
    assert sum(good) >= 0.97 * len(good), (sum(good), len(good))
    assert sum(bad) <= 0.3 * len(bad), (sum(bad), len(bad))


def jaccard_brute(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        k = min(width, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    p, q = sorted((find(i), find(j)))
                    root[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("name", "width", "percent"), [("odd", 4, 85), ("odd", 5, 80), ("real", 4, 85), ("empty", 4, 85), ("odd", 1, 60)])
def test_jaccard(request, name, width, percent):
    df = request.getfixturevalue(name)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df, width=width, percent=percent).collect()}
    assert got == jaccard_brute(rows_of(df), width, percent)


def test_jaccard_signatures_never_miss():
    """Any two sets within the threshold share a signature, at every size and threshold."""
    rng = np.random.default_rng(7)
    for percent in (60, 80, 85):
        table_ = ngram_join.bands(percent, 10_000)
        for n in [*range(1, 60), 100, 250, 700, 3000]:
            for _ in range(3):
                a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
                drop = int(rng.integers(0, max(1, n * (100 - percent) // 100) + 1))
                add = int(rng.integers(0, max(1, n * (100 - percent) // 100) + 1))
                b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 1 << 63, add).astype(np.uint64)]))
                both = len(np.intersect1d(a, b))
                if len(a) and len(b) and 100 * both >= percent * (len(a) + len(b) - both) and both < max(len(a), len(b)):
                    assert len(np.intersect1d(ngram_join.signatures(a, table_), ngram_join.signatures(b, table_))), (percent, n)


def test_near_copies_chain(spark):
    """A chain of links is one class though its ends differ; many variants of one text collapse."""
    w = [f"w{i}" for i in range(100)]
    chain = [" ".join(w[k : k + 60]) for k in range(0, 40, 2)]
    many = [" ".join([*w[:50], f"v{i}", *w[51:]]) for i in range(60)]
    rows = [(i, t, "keep") for i, t in enumerate(chain + many)]
    df = spark.createDataFrame(rows, "doc_id long, text string, size string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df).collect()}
    want = jaccard_brute([r[:2] for r in rows], 5, 80)
    assert got == want
    kept = ngram_join.drop_near_copies(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in want.values()})


def target_brute(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = total / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 2 * sizes[s]]
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = 2.0 * sizes[s]
            total -= out[s]
            open_.remove(s)
    return out


@pytest.mark.parametrize("name", ["odd", "real", "empty"])
def test_mixing(request, name):
    df = request.getfixturevalue(name)
    source = {r.doc_id: r.source for r in df.select("doc_id", "source").collect()}
    sizes = {i: len(WORD.findall(t or "")) for i, t in rows_of(df)}
    totals = defaultdict(int)
    for i, n in sizes.items():
        totals[source[i]] += n
    want = target_brute(totals)
    got = mixing.mix_rates(df).collect()
    assert sorted(r.doc_id for r in got) == sorted(sizes)
    taken = defaultdict(int)
    for r in got:
        s = source[r.doc_id]
        assert r["size"] == sizes[r.doc_id] and r.source_size == totals[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 2 * r["size"] and r.taken % max(1, r["size"]) == 0
        taken[s] += r.taken
    for s in totals:
        most = max(n for i, n in sizes.items() if source[i] == s)
        assert abs(taken[s] - want[s]) <= max(0.02 * want[s], most / 2), s
    again = mixing.mix_rates(df.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)


def test_mix_documents(odd):
    taken = {r.doc_id: r.copies for r in mixing.mix_rates(odd).collect()}
    mixed = mixing.mix_documents(odd)
    assert mixed.columns == odd.columns
    count = defaultdict(int)
    for r in mixed.collect():
        count[r.doc_id] += 1
    assert count == {i: c for i, c in taken.items() if c}


def test_mix_of_equal_rows(spark):
    """Equal rows, rows without an id and rows that repeat one: each is taken as often as its own copies say."""
    text = lambda n: " ".join(f"w{k}" for k in range(n))
    rows = [(1, text(10), "a")] * 5 + [(1, text(10), "b")] * 3 + [(None, text(7), "a")] * 4 + [(None, text(9), None), (1, text(11), "a"), (2, text(30), "b")] + [(9, text(5), "a")] * 700
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
        rates = mixing.mix_rates(df).collect()
        assert len(rates) == len(rows)
        want = defaultdict(int)
        for r in rates:
            want[r.doc_id, r["size"], r.sk] += r.copies
        count = defaultdict(int)
        for r in mixing.mix_documents(df).collect():
            count[r.doc_id, len(r.text.split()), "n" if r.source is None else "s" + r.source] += 1
        assert count == {k: v for k, v in want.items() if v}


def test_targets_of_many_sources(spark):
    rng = np.random.default_rng(5)
    sizes = {f"s{k:03}": int(rng.integers(0, 10 ** rng.integers(1, 6))) for k in range(300)} | {None: 77}
    df = spark.createDataFrame([("n" if s is None else "s" + s, s, n, 1) for s, n in sizes.items()], "sk string, source string, source_size long, n_docs long")
    want = target_brute(sizes)
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s]) for s in want)


def test_repeats_survive_hash_collisions(spark):
    """With so few bits that keys collide in every text, the counts are still right."""
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, top, n)) for n, top in ((200, 5), (300, 40), (50, 3), (400, 400), (2, 2), (3, 1), (5, 1))]
    df = spark.createDataFrame([(k, t.split()) for k, t in enumerate(texts)], "k int, _words array<string>")
    df = df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    for bits in (64, 3):
        got = {r.k: r.n_repeat_words for r in quality_rules._with_repeat_words(df, hash_bits=bits).collect()}
        for k, t in enumerate(texts):
            w, seen, where = t.split(), defaultdict(list), set()
            for i in range(len(w) - 2):
                seen[tuple(w[i : i + 3])].append(i)
            for ks in seen.values():
                if len(ks) > 1:
                    where.update(i + j for i in ks for j in range(3))
            assert got[k] == len(where), (bits, k)


def test_bpe_of_other_vocabularies(spark, tmp_path):
    """A vocabulary that isn't spelt in the byte alphabet is left to the library."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    library = Tokenizer(models.BPE({"a": 0, "b": 1, "ü": 2, "日": 3, "ab": 4, "日日": 5, "[UNK]": 6}, [("a", "b"), ("日", "日")], unk_token="[UNK]"))
    library.pre_tokenizer = pre_tokenizers.Whitespace()
    path = str(tmp_path / "other.json")
    library.save(path)
    texts = ["ab ab 日日", "", None, "xü b", "日 日日a"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    coded = bpe.bpe_encode(df, path)
    assert {r.doc_id: r.ids for r in coded.collect()} == {k: library.encode(t or "", add_special_tokens=False).ids for k, t in enumerate(texts)}
    assert {r.doc_id: r.text for r in bpe.bpe_decode(coded, path).collect()} == {k: library.decode(library.encode(t or "", add_special_tokens=False).ids) for k, t in enumerate(texts)}


@pytest.mark.parametrize("name", ["odd", "real", "empty"])
def test_bpe(request, name):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    df = request.getfixturevalue(name)
    library = Tokenizer.from_file(path)
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.bpe_digest(df, path).collect()}
    ids_of = {r.doc_id: r.ids for r in bpe.bpe_encode(df, path).collect()}
    assert len(got) == df.count()
    for i, t in rows_of(df):
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert got[i] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()), i
        assert ids_of[i] == ids
    back = {r.doc_id: r.text for r in bpe.bpe_decode(bpe.bpe_encode(df, path), path).collect()}
    assert back == {i: t or "" for i, t in rows_of(df)}


def test_bpe_cuts_agree_with_library():
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    codec, library = bpe.ForcedBoundaryCodec(bpe.read_tokenizer(path)), Tokenizer.from_file(path)
    assert codec.exact
    rng = random.Random(2)
    alphabet = ["a", "the", " ", "  ", "\n", "\t", "'s", "'", "é", "9", "12", ".", "...", " ", " ", "\x1c", "\x85", "日本", "😀", "<|endoftext|>", "!", "ing", "\r\n", "\x00", "-"]
    for _ in range(1500):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25)))
        ids = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(codec.encode(t), "<u4").tolist() == ids, repr(t)
        assert codec.decode(codec.encode(t)) == library.decode(ids, skip_special_tokens=False), repr(t)


def test_bpe_cuts_at_every_absent_pair():
    """Strings of awkward characters, most of them with cuts, against the library."""
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    codec, library = bpe.ForcedBoundaryCodec(bpe.read_tokenizer(path)), Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    rng = random.Random(1)
    kinds = ["abcXYZ", "0123456789", "'!?.,-_#", "sStTrReEvVmMlLdD'", "  \t\n\r\x0b\x0c\x1c\x1f\x85\xa0", "　  中文字漢日本語", "éüñçßÉ", "́̈‍", "😀👍🏽", "²½Ⅷ৩", "\x00\x01\x7f\xad"]
    cut = 0
    for _ in range(20_000):
        pool = rng.sample(kinds, rng.randint(1, 4))
        text = "".join(rng.choice(rng.choice(pool)) for _ in range(rng.randint(1, 40))) + rng.choice(["", "", "", "<|endoftext|>x"])
        pieces = codec.pieces(text)
        cut += len(pieces) > 1
        assert "".join(pieces) == text
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert cut > 15_000
    # A text without blanks falls to pieces.
    assert max(map(len, codec.pieces("漢字かな交じり文" * 50 + "aZ9" * 500))) < 1600 and len(codec.pieces("漢字かな交じり文" * 50)) > 50


def test_bpe_hands_new_pieces_over_together(monkeypatch):
    """Many texts of new words are one call of the library; double blanks, blanks behind white space and stores that overflow change no id."""
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    codec, library = bpe.ForcedBoundaryCodec(bpe.read_tokenizer(path)), Tokenizer.from_file(path)
    rng = random.Random(4)
    texts = ["".join(rng.choice(["abq", "zü", "日本", "x", "7", ".", "'s", "\n", "\x1c", "\xa0", "<|endoftext|>", " ", " ", " ", " ", "  "]) for _ in range(40)) for _ in range(400)] + ["", " ", "  a", "a  ", " a", "a", "<|endoftext|>"]
    wanted = [library.encode(t, add_special_tokens=False).ids for t in texts]
    calls, whole = [], codec._encode_pieces
    monkeypatch.setattr(codec, "_encode_pieces", lambda pieces: calls.append(len(pieces)) or whole(pieces))
    for most in (bpe.CACHE_ENTRIES, 50):
        monkeypatch.setattr(bpe, "CACHE_ENTRIES", most)
        for k in range(0, len(texts), 100):
            assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode_all(texts[k : k + 100])] == wanted[k : k + 100]
    assert 1 <= len(calls) <= 10 and calls[0] > 20


def test_packed_signatures_lose_none():
    """Packed signatures come back, in less than their rows took, and a bucket's candidates are those of plain grouping."""
    import pyarrow as pa

    rng = np.random.default_rng(1)
    for n, buckets, top in ((1, 4, 1 << 63), (5000, 7, 1 << 63), (400_000, 3, 1 << 63), (100, 1, 1 << 40)):
        sigs, nodes = rng.integers(0, top, n, dtype=np.uint64), rng.integers(-9, 9, n) * 10**17
        sigs[n // 2 :] = sigs[: n - n // 2]
        rows = list(ngram_join.pack(sigs, nodes, buckets))
        pairs = [p for _, *row in rows for p in zip(*(x.tolist() for x in ngram_join.unpack(*row)), strict=True)]
        assert sorted(pairs) == sorted(zip((sigs >> np.uint64(64 - ngram_join.SIG_BITS)).tolist(), nodes.tolist(), strict=True))
        if n == 400_000:
            assert sum(len(x) for _, *row in rows for x in row) < 7 * n
        groups = defaultdict(set)
        for s, x in pairs:
            groups[s].add(x)
        table = pa.table([pa.array(c) for c in zip(*rows, strict=True)], names=["bucket", "steps", "places", "names"])
        got = [(-1 if r["sig"] is None else r["sig"], r["pivot"], r["node"]) for r in ngram_join._candidate_rows(table).to_pylist()]
        assert sorted(got) == sorted((s if len(v) > 2 else -1, min(v), x) for s, v in groups.items() for x in v - {min(v)})


def plain_em(counts):
    """EM over vote patterns in plain Python: ``(prior, good, bad)``."""
    q = quality_rules
    signs = [v for _, v, _ in q.RULES]
    own, other = [q.PRIOR_OWN[v] for v in signs], [q.PRIOR_OWN[v] / q.SPECIFIC[v] for v in signs]
    good0, bad0 = [o if v > 0 else x for v, o, x in zip(signs, own, other, strict=True)], [o if v < 0 else x for v, o, x in zip(signs, own, other, strict=True)]
    prior, good, bad, w = q.PRIOR_GOOD, good0, bad0, q.PRIOR_WEIGHT
    for _ in range(q.ITERATIONS):
        post = {p: posterior(p, prior, good, bad) for p in counts}
        yes, no = sum(post[p] * n for p, n in counts.items()), sum((1 - post[p]) * n for p, n in counts.items())
        prior = min(0.99, max(0.01, (q.PRIOR_GOOD * w + yes) / (w + yes + no)))
        raw_good = [(g * w + sum(post[p] * n for p, n in counts.items() if p[k])) / (w + yes) for k, g in enumerate(good0)]
        raw_bad = [(b * w + sum((1 - post[p]) * n for p, n in counts.items() if p[k])) / (w + no) for k, b in enumerate(bad0)]
        held = lambda x, most: min(0.999, max(1e-6, min(x, most)))
        good = [held(g, b / q.SPECIFIC[-1] if v < 0 else 1e9) for g, b, v in zip(raw_good, raw_bad, signs, strict=True)]
        bad = [held(b, g / q.SPECIFIC[1] if v > 0 else 1e9) for g, b, v in zip(raw_good, raw_bad, signs, strict=True)]
    return prior, good, bad


def posterior(votes, prior, good, bad):
    odds = prior / (1 - prior)
    for v, g, b in zip(votes, good, bad, strict=True):
        odds *= g / b if v else (1 - g) / (1 - b)
    return odds / (1 + odds)


@pytest.mark.parametrize("name", ["odd", "real"])
def test_quality_posteriors_are_those_of_plain_em(request, name):
    """The estimate and the verdicts again, pattern by pattern, in plain Python."""
    rows = quality_rules.score_quality(request.getfixturevalue(name)).collect()
    counts = defaultdict(int)
    for r in rows:
        counts[tuple(r.votes)] += 1
    prior, good, bad = plain_em(counts)
    for r in rows:
        p = posterior(r.votes, prior, good, bad)
        assert r.p_good == pytest.approx(p, abs=1e-6) and r.kept == (not r.base_failed and r.p_good >= quality_rules.THRESHOLD)
