"""Texts made so that sums of powers collide, and names cut to few bits: content decides."""

import hashlib

import numpy as np
import pytest

from textloom.llm import hashing, ngram_join, repeated_bytes, substring_dedup


def parity(k):
    return bin(k).count("1") % 2


def test_equal_powers_are_no_repeat_of_bytes(spark):
    pairs = ["!\"", "=t", "Di"]
    x = "".join(p[parity(k)] for p in pairs for k in range(128)) + "z" * 16
    y = "".join(p[1 - parity(k)] for p in pairs for k in range(128)) + "z" * 16
    raws = [s.encode() for s in (x, y)]
    assert (hashing.rolling(np.frombuffer(raws[0], np.uint8).astype(np.uint64), 400) == hashing.rolling(np.frombuffer(raws[1], np.uint8).astype(np.uint64), 400)).all()
    texts = [x, y, x[:399], x[1:], y[:399], y[1:]]
    got = repeated_bytes.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_removed for r in got} == dict.fromkeys(range(6), 0)


def test_equal_powers_are_no_repeat_of_words(spark):
    pair = ["w1853414", "w3245324"]
    a = [pair[parity(k)] for k in range(32)] + [f"end{k}" for k in range(18)]
    b = [pair[1 - parity(k)] for k in range(32)] + [f"end{k}" for k in range(18)]
    texts = [a, b, a[:25], a[:25] + ["other"] * 30, b[:25] + ["more"] * 30]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in substring_dedup.substring_dedup(df).collect()} == dict.fromkeys(range(5), 0)


@pytest.mark.parametrize("bits", [64, 8, 1])
def test_few_bits_of_names_leave_the_rest_to_checks(spark, odd, bits):
    rows = [(r.doc_id, (r.text or "").encode()) for r in odd.collect()]
    seen: dict[bytes, int] = {}
    length = 40
    for _, raw in rows:
        for k in range(len(raw) - length + 1):
            seen[raw[k : k + length]] = seen.get(raw[k : k + length], 0) + 1
    want = {}
    for i, raw in rows:
        gone = np.zeros(len(raw) + 1, bool)
        for k in range(len(raw) - length + 1):
            if seen[raw[k : k + length]] > 1:
                gone[k : k + length] = True
        want[i] = (int(gone.sum()), hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone[: len(raw)]].tobytes()).hexdigest())
    got = repeated_bytes.remove_repeats(odd, length=length, order=2, gram=12, name_bits=bits).collect()
    assert {r.doc_id: (r.n_removed, r.kept_sha256) for r in got} == want


def test_doubled_names_are_equal_for_equal_runs_only():
    rng = np.random.default_rng(0)
    raw = rng.integers(97, 99, 3000).astype(np.uint8).tobytes()
    for length in (8, 9, 15, 16, 31, 100):
        names = hashing.byte_names(raw, length, 5)
        found = {}
        for k, name in enumerate(names.tolist()):
            assert found.setdefault(name, raw[k : k + length]) == raw[k : k + length]
        assert len(found) == len({raw[k : k + length] for k in range(len(raw) - length + 1)})
    assert len(hashing.byte_names(b"short", 8, 5)) == 0
    assert (hashing.byte_names(raw, 40, 5) != hashing.byte_names(raw, 40, 6)).all()


def test_pairs_with_one_first_name():
    wanted = np.array([[1, 5], [1, 7], [3, 3]], np.uint64)
    pairs = np.array([[1, 7], [1, 6], [3, 3], [9, 9], [0, 0], [1, 5]], np.uint64)
    assert hashing.among_pairs(pairs, wanted).tolist() == [True, False, True, False, False, True]
    names, checks = np.array([7, 7, 7, 1], np.uint64), np.array([2, 1, 2, 9], np.uint32)
    by, new = repeated_bytes.pair_order(names, checks)
    assert [(names[k], checks[k]) for k in by] == [(1, 9), (7, 1), (7, 2), (7, 2)] and new.tolist() == [True, True, True, False]


def test_words_decide_near_the_edge():
    x, y = " ".join(f"w{k}" for k in range(100)), " ".join(f"w{k}" for k in range(9, 100))
    sets = lambda: (ngram_join.word_shingles(x, 4), ngram_join.word_shingles(y, 4))
    assert len(sets()[0]) == 97 and len(sets()[0] & sets()[1]) == 88
    # Hashes that claim two shared shingles too many or too few don't move the verdict.
    for claimed in (86, 88, 90):
        assert ngram_join.similar(claimed, 97, 88, 90, sets) and not ngram_join.similar(claimed, 97, 88, 91, sets)
    assert ngram_join.word_shingles(None, 4) == set() and ngram_join.word_shingles("a b", 4) == {(b"a", b"b")}
