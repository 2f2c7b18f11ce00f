"""The pipeline's stages against the operators' own results and plain Python."""

import re
from collections import Counter

import corpus_pipeline
from test_first_five import jaccard_brute
from textloom.llm import quality_rules
from textloom.llm.exact_dedup import drop_exact_copies
from textloom.llm.ngram_join import drop_near_copies
from textloom.session import materialize

DIR = "/root/testdata/sf0.001"


def test_stages(spark, real):
    docs, seen = real, []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, DIR), "test-stage")
        seen.append((name, docs))
    assert len(corpus_pipeline.STAGES) == 5
    for _, df in seen[:-1]:
        assert df.columns == real.columns
    text = {r.doc_id: r.text for r in real.collect()}
    ids = [[r.doc_id for r in df.select("doc_id").collect()] for _, df in seen]
    kept = {r.doc_id for r in quality_rules.score_quality(real).where("kept").collect()}
    assert sorted(ids[0]) == sorted(kept)
    groups = {}
    for i in sorted(kept):
        key = re.sub(r"[\x20\x09-\x0D]", "", text[i])
        if key not in groups or len(text[i]) > len(text[groups[key]]):
            groups[key] = i
    assert sorted(ids[1]) == sorted(groups.values())
    linked = jaccard_brute([(i, text[i]) for i in ids[1]], 5, 80)
    assert sorted(ids[2]) == sorted({c for _, c in linked.values()})
    copies = Counter(ids[3])
    assert set(copies) <= set(ids[2]) and max(copies.values()) <= 2
    words = sum(len(text[i].split()) * c for i, c in copies.items())
    assert abs(words - 1.5 * sum(len(text[i].split()) for i in ids[2])) < 0.1 * words
    assert Counter(ids[4]) == copies


def test_run_odd(spark, tmp_path):
    """Nulls, blanks and an empty table pass through every stage."""
    rows = [(1, None, "en", "a", None), (None, "x y", None, None, 3), (2, "", "en", "a", 0), (3, "word " * 60, "en", "a", 300), (4, " ".join(f"the w{k}" for k in range(90)), "en", "b", 9)]
    for k, data in enumerate((rows, [])):
        spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/{k}/documents.parquet")
        got = corpus_pipeline.run(spark, f"{tmp_path}/{k}").collect()
        assert {r.doc_id for r in got} <= {4}


def test_rows_without_own_id(spark, real):
    """A row is judged by itself, not by others that repeat its id or have none."""
    scored = quality_rules.score_quality(real).select("doc_id", "kept").collect()
    good, bad = (sorted(r.doc_id for r in scored if r.kept == k)[:3] for k in (True, False))
    alias = {good[0]: None, bad[0]: None, bad[1]: good[1]}
    rows = [(alias.get(r.doc_id, r.doc_id), *r[1:]) for r in real.collect()]
    got = quality_rules.filter_quality(spark.createDataFrame(rows, real.schema)).select("text").collect()
    kept = {r.doc_id for r in scored if r.kept}
    assert Counter(r.text for r in got) == Counter(r.text for r in real.collect() if r.doc_id in kept)

    rows = [(1, "a b c"), (None, "abc"), (None, "own text"), (2, "a bc"), (2, "other text"), (3, "x"), (None, "x"), (None, None), (4, "")]
    got = drop_exact_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {tuple(r) for r in got} == {(1, "a b c"), (None, "own text"), (2, "other text"), (3, "x"), (4, "")}


def test_near_copies_without_own_id(spark):
    text = lambda k: " ".join(f"{k}w{i}" for i in range(60))
    near = lambda k: text(k).replace(f"{k}w30", "other")
    rows = [(None, text("a")), (None, text("a").upper()), (None, text("b")), (3, near("b")), (4, text("c")), (5, text("c")), (5, text("d")), (6, near("d")), (None, text("e")), (None, near("e")), (None, text("f")), (None, ""), (7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in drop_near_copies(df).collect()]
    one = [[r for r in got if r[1] and r[1].lower() in (text(k), near(k))] for k in "abcdef"]
    assert [len(x) for x in one] == [1] * 6
    assert one[1:4] == [[rows[3]], [rows[4]], [rows[6]]]
    assert len(got) == 8


def test_stages_keep_odd_rows_whole(spark, odd, tmp_path):
    """Nulls, ties, repeated rows and columns named like internal ones: every stage but the last keeps all columns, and only whole rows."""
    docs, rows = odd, Counter(tuple(r) for r in odd.collect())
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, DIR), "test-odd")
        assert docs.columns == odd.columns
        now = Counter(tuple(r) for r in docs.collect())
        assert set(now) <= set(rows)
        rows = now
    odd.unionByName(odd.limit(5)).write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} <= {r.doc_id for r in odd.collect()}
