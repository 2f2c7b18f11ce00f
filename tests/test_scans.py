"""Scans, stacks, spans and range joins against plain Python, with blocks so small that every key is many blocks."""

import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from textloom.operators import scans


@pytest.fixture(scope="module")
def rows():
    """One key with half of all rows, a null key, values with ties and nulls; falling and rising stretches."""
    rng = random.Random(7)
    out = []
    for key, n in ((1, 400), (2, 90), (3, 1), (None, 60), (5, 249)):
        for k in range(n):
            out.append((key, 3 * k, rng.choice([1, 2, 3]), n - k if key == 5 else rng.randint(0, 30), rng.choice([None, k])))
    rng.shuffle(out)
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "k int, o long, v int, x long, maybe long").repartition(5)


def by_key(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r[1]):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("blocks", [1, 7, 40])
def test_running(df, rows, blocks):
    t = scans.blocked(df, "k", "o", blocks=blocks)
    for how, value, before in (("sum", "x", False), ("sum", "x", True), ("min", "x", False), ("max", "maybe", True), ("last", "maybe", False), ("last", "maybe", True)):
        got = {(r.k, r.o): r.out for r in scans.running(t, "k", ["o"], F.col(value), "out", how, before).collect()}
        for key, own in by_key(rows).items():
            so_far = []
            for r in own:
                seen = so_far if before else [*so_far, r]
                values = [v for v in (s[3] if value == "x" else s[4] for s in seen) if v is not None]
                want = None if not values else {"sum": sum, "min": min, "max": max, "last": lambda v: v[-1]}[how](values)
                assert got[key, r[1]] == want, (how, value, before, key, r)
                so_far.append(r)


def test_islands_segments_and_balance(df, rows):
    got = sorted(map(tuple, scans.islands(df, "k", "o", "v", blocks=30).select("k", "v", "first", "last", "n").collect()), key=str)
    want, segs, bal = [], [], []
    for key, own in by_key(rows).items():
        for v, g in groupby(own, key=lambda r: r[2]):
            g = list(g)
            want.append((key, v, g[0][1], g[-1][1], len(g)))
        seg, counts, total, least = 0, {}, 0, None
        for r in own:
            seg += r[2] == 3
            counts[seg] = counts.get(seg, 0) + (r[2] != 3)
            total += r[3] - 15
            least = total if least is None else min(least, total)
        segs += [(key, s, n) for s, n in counts.items() if n]
        bal.append((key, total, least))
    assert got == sorted(want, key=str)
    assert sorted(map(tuple, scans.segments(df, "k", "o", F.col("v") == 3, blocks=30).select("k", "seg", "n").collect()), key=str) == sorted(segs, key=str)
    assert sorted(map(tuple, scans.balance(df, "k", "o", F.col("x") - 15, blocks=30).select("k", "balance", "least").collect()), key=str) == sorted(bal, key=str)


@pytest.mark.parametrize("blocks", [1, 25])
def test_next_greater_and_parent(df, rows, blocks):
    got = {(r.k, r.o): r.n for r in scans.next_greater(df, "k", "o", "x", "n", blocks=blocks).collect()}
    up = {(r.k, r.o): r.parent for r in scans.parent_of(df, "k", "o", "x", blocks=blocks).collect()}
    for key, own in by_key(rows).items():
        for i, r in enumerate(own):
            assert got[key, r[1]] == next((s[1] for s in own[i + 1 :] if s[3] > r[3]), None)
            assert up[key, r[1]] == next((s[1] for s in reversed(own[:i]) if s[3] < r[3]), None)


@pytest.mark.parametrize("most", [0, 20, 100])
def test_greedy_spans(df, rows, most):
    got = sorted(map(tuple, scans.greedy_spans(df, "k", "o", "x", most, blocks=20).select("k", "first", "last", "n", "total").collect()), key=str)
    want = []
    for key, own in by_key(rows).items():
        now = None
        for r in own:
            if now and now[3] + r[3] <= most:
                now[1:] = [r[1], now[2] + 1, now[3] + r[3]]
            else:
                want += [(key, *now)] if now else []
                now = [r[1], r[1], 1, r[3]]
        want.append((key, *now))
    assert got == sorted(want, key=str)


def test_empty(spark):
    none = spark.createDataFrame([], "k int, o long, v int, x long")
    assert scans.islands(none, "k", "o", "v").isEmpty() and scans.next_greater(none, "k", "o", "x", "n").isEmpty() and scans.greedy_spans(none, "k", "o", "x", 5).isEmpty()
    assert scans.range_pairs(none.select(F.col("k").alias("a"), "o", "x"), none.select("v"), "o", "x", "v").isEmpty()


@pytest.mark.parametrize("group", [None, "g"])
def test_range_pairs(spark, group):
    rng = random.Random(3)
    points = [(i, rng.choice([None, 1, 2]), 77 if i % 3 == 0 else rng.choice([None, *range(-400, 9000)])) for i in range(3500)]
    ranges = [(i, rng.choice([None, 1, 2]), a, a + w) for i, (a, w) in enumerate((rng.randint(-1000, 9500), rng.choice([-3, 0, 1, 50, 20000])) for _ in range(60))] + [(99, 1, None, 5), (100, 1, 5, None), (101, 1, -(10**6), 10**6)]
    p, r = spark.createDataFrame(points, "p long, g int, v long"), spark.createDataFrame(ranges, "r long, g int, a long, b long")
    out = scans.range_pairs(r if group else r.drop("g"), p if group else p.drop("g"), "a", "b", "v", group)
    plan = out._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = sorted((x.r, x.p) for x in out.collect())
    want = sorted((x[0], y[0]) for x in ranges for y in points if x[2] is not None and x[3] is not None and y[2] is not None and x[2] <= y[2] <= x[3] and (not group or x[1] is not None and x[1] == y[1]))
    assert got == want


def test_one_wide_range_and_one_hot_value_are_many_keys(spark):
    points = spark.range(60_000).select(F.col("id").alias("p"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("v"))
    ranges = spark.createDataFrame([(1, 0, 10**9)], "r int, a long, b long")
    out = scans.range_pairs(ranges, points, "a", "b", "v")
    assert out.count() == 60_000
    spread = out.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert spread[1] > 1 or "Broadcast" in out._jdf.queryExecution().toString()
