"""The doctor as a stream against the batch doctor: late, repeated and withdrawn versions, and a restart."""

import datetime
import random

import pytest

from textloom.operators import corpus
from textloom.streaming import doctor

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def batch_answer(spark, events):
    """The batch doctor over the last version of each side."""
    last = {}
    for e in events:
        if (e[0], e[1]) not in last or e[2] > last[e[0], e[1]][2]:
            last[e[0], e[1]] = e
    records = [(e[0], e[5], e[6], e[7]) for e in last.values() if e[1] == "record" and not e[4]]
    files = [(e[0], e[6], e[7]) for e in last.values() if e[1] == "file" and not e[4]]
    r = spark.createDataFrame(records, "chunk string, status string, source_hash string, output_hash string")
    f = spark.createDataFrame(files, "chunk string, source_now string, output_now string")
    return sorted(tuple(x[c] for c in ("chunk", *doctor.FLAGS)) for x in corpus.reconcile_records(r, f, "chunk").collect())


@pytest.mark.parametrize("seed", [1])
def test_stream_answers_as_the_batch_does(spark, tmp_path, seed):
    rng, start = random.Random(seed), datetime.datetime(2024, 1, 1, 12)
    pool = []
    for chunk in "abcdefgh":
        for version in range(1, 9):
            side = rng.choice(["record", "file"])
            pool.append((chunk, side, version, start + datetime.timedelta(seconds=rng.randint(0, 300)), rng.random() < 0.15, rng.choice(["pending", "done"]) if side == "record" else None, rng.choice(["s1", "s2"]), rng.choice([None, "o1", "o2"])))
    rng.shuffle(pool)  # late versions
    batches = [pool[:20], [*pool[20:40], *pool[:10]], [*pool[40:], *pool[15:30]]]  # repeated ones
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    answers, seen = {}, []

    def take(df, _):
        answers.update({r.chunk: tuple(r) for r in df.collect()})

    try:
        for k, batch in enumerate(batches):  # each batch in a query of its own, which goes on from the checkpoint
            spark.createDataFrame(batch, doctor.EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            seen += batch
            stream = spark.readStream.schema(doctor.EVENTS).parquet(str(tmp_path / "in"))
            q = doctor.watched(stream).writeStream.outputMode("update").foreachBatch(take).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
            q.awaitTermination(120)
            assert q.exception() is None and not q.isActive
            got = sorted((a[0], *a[2:]) for a in answers.values() if a[1] and any(a[2:]))
            assert got == batch_answer(spark, seen), k
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
    assert len(answers) == 8


def test_flags_of_one_chunk():
    record, file = (1, 0, False, "done", "s", "o"), (1, 0, False, None, "s", "o")
    assert doctor.flags(record, file) == (True, False, False, False, False, False)
    assert doctor.flags(record, None)[1:] == (True, False, False, False, False) and doctor.flags(None, file)[0] is False
    assert doctor.flags((1, 0, False, "pending", None, None), file)[1:] == (False, True, False, False, False)
    assert doctor.flags(record, (2, 0, False, None, "x", "y"))[1:] == (False, False, True, True, False)
    assert doctor.flags((1, 0, False, "done", "s", None), file)[1:] == (False, False, False, False, True)
    assert doctor.flags((3, 0, True, "done", "s", "o"), file)[0] is False
