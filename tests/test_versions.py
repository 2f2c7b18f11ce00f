"""The versioned ledger: writers that are lost between steps, writers that meet, versions read back. And what surrounds it."""

import threading

import pytest
from pyspark.sql import functions as F

from textloom.functions import markup
from textloom.plans import made
from textloom.sources import files, versions


class Lost(Exception):
    pass


@pytest.fixture()
def book(spark, tmp_path):
    return versions.VersionedLedger(spark, str(tmp_path / "book"))


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_versions_are_kept(spark, book):
    assert book.read() is None and book.versions() == []
    one = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    assert book.commit(lambda head: one) == 1
    assert book.commit(versions.merged("k", spark.createDataFrame([(2, "c"), (3, None)], "k long, v string"))) == 2
    assert book.commit(lambda head: one) == 3
    assert rows(book.read(1)) == rows(book.read()) == [(1, "a"), (2, "b")] and rows(book.read(2).fillna("-")) == [(1, "a"), (2, "c"), (3, "-")]
    assert book.manifest(1)["snapshot"] == book.manifest(3)["snapshot"] != book.manifest(2)["snapshot"]
    status = {r.k: r.status for r in versions.compared(book.read(1), book.read(2), "k", "v").collect()}
    assert status == {1: "same", 2: "changed", 3: "new"}


@pytest.mark.parametrize("step", ["_rename 1", "_publish 1", "_rename 2"])
def test_a_writer_lost_between_steps_leaves_the_ledger_readable(spark, tmp_path, step):
    path = str(tmp_path / "book")
    versions.VersionedLedger(spark, path).commit(lambda head: spark.range(3).toDF("k"))
    name, at = step.split()
    lost, calls = versions.VersionedLedger(spark, path), []
    own = getattr(lost, name)

    def dies(*args):
        calls.append(args)
        if len(calls) == int(at):
            raise Lost
        return own(*args)

    setattr(lost, name, dies)
    with pytest.raises(Lost):
        lost.commit(lambda head: spark.range(5).toDF("k"))
    again = versions.VersionedLedger(spark, path)
    assert again.versions() == [1] and again.read().count() == 3
    assert again.commit(lambda head: head.unionByName(spark.range(3, 5).toDF("k"))) == 2 and again.read().count() == 5


def test_two_writers_lose_no_rows(spark, tmp_path):
    path = str(tmp_path / "book")
    books = [versions.VersionedLedger(spark, path) for _ in range(2)]
    meet = threading.Barrier(2, timeout=60)

    def write(k):
        met = []

        def change(head):
            if not met:
                met.append(meet.wait())
            new = spark.createDataFrame([(k, 1)], "k long, v int")
            return new if head is None else head.unionByName(new)

        books[k].commit(change)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert books[0].versions() == [1, 2] and rows(books[0].read()) == [(0, 1), (1, 1)]


def test_too_many_conflicts(spark, book):
    book._publish = lambda *_: False
    with pytest.raises(versions.Conflict):
        book.commit(lambda head: spark.range(1).toDF("k"), tries=2)


def test_journal_below_a_path_that_repeats_its_name(spark, tmp_path):
    top = tmp_path / "run" / "a" / "run" / "run"
    for folder, k in (("", 1), ("b", 2), ("b/run/c", 3), ("1/2/3/4", 4), ("1/2/3/4/5", 5)):
        (top / folder).mkdir(parents=True, exist_ok=True)
        (top / folder / "x.jsonl").write_text('{"type":"result","result":{"k":%d}}\n\n{"type":"start"}\n' % k)
    assert sorted(r.k for r in files.journal(spark, str(top), "k long").collect()) == [1, 2, 3, 4]
    assert files.journal(spark, str(tmp_path / "none"), "k long").isEmpty()


def test_made_texts_keep_every_character(spark):
    d = "/root/testdata/sf0.001"
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    for r in made.marked(spark, d).collect():
        kept = iter(r.text)
        assert all(c in kept for c in before[r.doc_id].replace("*", "+").replace("`", "+") if not c.isspace()), r.doc_id


def test_protected_segments_hold_any_character():
    assert markup.outside_protected("\x007\x00 `a` b", str.upper) == "\x007\x00 `a` B"
    assert markup.outside_protected("`x`", str.upper) == "`x`" and markup.outside_protected("", str.upper) == ""
    every = "".join(markup.NONCHARACTERS)
    assert markup.outside_protected(f"a{every} `k` b", str.upper) == f"A{every} `k` B"
    assert markup.outside_protected("a `k` b", lambda t: t.replace(markup.NONCHARACTERS[0], "")) == "a `k` b"


def test_swap_sets_the_old_folder_aside(spark, tmp_path):
    path = str(tmp_path / "l")
    df = spark.range(4).toDF("k")
    files.Plan(df, path, "json").write()
    files.swap(files.Plan(df.where(F.col("k") > 1), path, "json"), spark)
    assert spark.read.json(path).count() == 2 and not (tmp_path / "l.old").exists() and not (tmp_path / "l.new").exists()
