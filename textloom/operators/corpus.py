"""Census, mining, joins, windows and folds over text tables: DataFrame in, DataFrame out.

Windows are always partitioned by a document, page or group key. Aggregations are algebraic, so
Spark sums inside the map tasks before it shuffles. Column names are parameters or fixed in the
docstring; extra columns are dropped unless stated.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.operators import folds, grams
from textloom.session import BROADCAST_IDS, Scope, keep_ids, materialize  # noqa: F401

# --- explosions -----------------------------------------------------------------------------


def lines(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key, line_no (from 0), line``."""
    return df.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def tokens(df: DataFrame, key: list[str], text: str = "text", separators: str = X.BLANK) -> DataFrame:
    """``*key, pos (from 0), token`` without empty tokens."""
    return df.select(*key, F.posexplode(X.words(F.col(text), separators)).alias("pos", "token"))


#: What no n-gram crosses: line ends and marks.
RUN_MARKS = r"[\n.,;:!?]+"


def runs(df: DataFrame, key: list[str], text: str = "text", marks: str = RUN_MARKS, separators: str = X.BLANK) -> DataFrame:
    """``*key, w``: the tokens of each run between line ends or marks."""
    parts = F.transform(F.split(F.lower(text), marks), lambda r: X.words(r, separators))
    return df.select(*key, F.explode(parts).alias("w")).where(F.size("w") > 0)


def contexts(df: DataFrame, key: str, token: str, width: int = 2, order: str = "pos") -> DataFrame:
    """``signature``: up to ``width`` tokens on either side of each occurrence; the document's edges are ``^`` and ``$``."""
    w = Window.partitionBy(key).orderBy(order)
    before = [F.lag("token", k, "^").over(w) for k in range(width, 0, -1)]
    after = [F.lead("token", k, "$").over(w) for k in range(1, width + 1)]
    return df.select("token", F.concat_ws(" ", *before, F.lit("_"), *after).alias("signature")).where(F.col("token") == token).select("signature")


# --- aggregations ---------------------------------------------------------------------------


def census(df: DataFrame, keys: list[str]) -> DataFrame:
    """``*keys, n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def collisions(df: DataFrame, output: str, source: str) -> DataFrame:
    """Outputs that several sources share: ``output, n_sources, sources (ascending)``."""
    return df.select(output, source).distinct().groupBy(output).agg(F.count(F.lit(1)).alias("n_sources"), F.array_sort(F.collect_list(source)).alias("sources")).where("n_sources > 1")


def non_majority(counts: DataFrame, group: str, n: str = "n") -> DataFrame:
    """``group, n_all, n_other``: occurrences outside the group's commonest value."""
    return counts.groupBy(group).agg(F.sum(n).alias("n_all"), (F.sum(n) - F.max(n)).alias("n_other"))


def top_shares(counts: DataFrame, group: str, value: str, k: int = 3, n: str = "n") -> DataFrame:
    """``group, value, rank, n, share`` of the k commonest values; ties by value."""
    total = counts.groupBy(group).agg(F.sum(n).alias("_total"))
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(F.desc(n), value))).where(F.col("rank") <= k)
    return ranked.join(total, group).select(group, value, "rank", n, F.round(F.col(n) / F.col("_total"), 6).alias("share"))


def index_quantiles(df: DataFrame, group: str, value: str, forms: dict[str, str]) -> DataFrame:
    """Quantiles by index into the ascending values of each group.

    ``forms`` maps a name to the index, an expression over ``n``. Values are counted first, so the window of a
    hot group sees its distinct values.
    """
    counts = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(group).orderBy(value)
    total = counts.groupBy(group).agg(F.sum("c").alias("n"))
    spans = counts.withColumn("end", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("start", F.col("end") - F.col("c")).join(total, group)
    at = lambda e: F.max(F.when((F.expr(e) >= F.col("start")) & (F.expr(e) < F.col("end")), F.col(value)))
    return spans.groupBy(group).agg(*[at(e).alias(name) for name, e in forms.items()])


def weighted_mode(df: DataFrame, group: str, value: str, weight: str) -> DataFrame:
    """``group, mode, weight``: the value of the largest summed weight; ties by the smaller value."""
    sums = df.groupBy(group, value).agg(F.sum(weight).alias("w"))
    best = sums.groupBy(group).agg(F.min(F.struct((-F.col("w")).alias("neg"), F.col(value).alias("value"))).alias("b"))
    return best.select(group, F.col("b.value").alias("mode"), (-F.col("b.neg")).alias("weight"))


#: Tokens that a broadcast vocabulary may have: some 16 bytes each for the driver and each task.
VOCABULARY = 1 << 23


def branching(df: DataFrame, key: str, sizes: tuple[int, ...] = (1, 2, 3, 4, 5), least: int = 25, text: str = "text", most: int = VOCABULARY) -> DataFrame:
    """``gram, n_tokens, count, n_left, n_right`` of n-grams inside runs, seen ``least`` times.

    ``n_left`` and ``n_right`` count different neighbours (rare ones by 63-bit names); a run's edge is one of them. Level by level: an n-gram is counted only
    where its first and its last n - 1 tokens are frequent, and neighbours only of the frequent ones (see ``grams``), so the disk holds numbers of tokens, compressed,
    and one level's windows. A vocabulary beyond ``most`` tokens is not broadcast: then names of all n-grams are counted.
    """
    spark, longest = df.sparkSession, max(sizes)
    width = (longest + 1) // 2
    with Scope(spark) as scope:
        counted = runs(df, [key], text).select(F.explode("w").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("count"))
        often = scope.keep(counted.where(F.col("count") >= least).select("token", "count", F.xxhash64("token").alias("name")), "tokens-often")
        size, total = often.agg(F.count(F.lit(1)), F.coalesce(F.sum("count"), F.lit(0))).first()
        if size > most:
            return _branching_by_names(df, key, sizes, least, text)
        if not size:
            return spark.createDataFrame([], "gram string, n_tokens int, count long, n_left long, n_right long")
        # Numbers by frequency: small ones, which compress, for the most.
        vocabulary = often.toArrow().sort_by([("count", "descending"), ("token", "ascending")])
        names = vocabulary["name"].to_numpy()
        order = np.argsort(names)
        if (np.diff(names[order]) == 0).any():  # two tokens of one name
            return _branching_by_names(df, key, sizes, least, text)
        send = spark.sparkContext.broadcast
        known, tokens_ = send((names[order], (order + 1).astype(np.int32))), send(vocabulary["token"].combine_chunks())
        parts = F.transform(F.split(F.lower(text), RUN_MARKS), lambda r: F.concat(F.array(F.lit(0).cast("long")), F.transform(X.words(r, X.BLANK), lambda x: F.xxhash64(x))))
        codes = scope.keep(df.select(F.flatten(parts).alias("names")).mapInArrow(grams.coded(known), "ids binary, rare binary"), "codes")
        groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // grams.GROUP_WINDOWS)
        kinds = ", ".join(["n int", *(f"{k} long" for k in grams.columns(width)), "count long", "n_left long", "n_right long"])
        out = often.select("name", "count").mapInArrow(grams.numbered(known, width), kinds)
        bits = None
        for m in range(2, longest + 2):
            sides = m - 1 in sizes
            with Scope(spark):  # the shuffle goes with it
                found = codes.mapInArrow(grams.windows(m, bits, sides, groups), "part int, ids binary, rare binary, counts binary")
                level = scope.keep(grams.summed(found.groupBy("part").applyInArrow(grams.tallied(m, bits, sides, least, m <= longest, width), kinds), width), "grams-level")
            out = out.unionByName(level)
            n_often = level.where(f"n = {m}").count()
            if not n_often:
                break
            bits = send(grams.filter_of(level.where(f"n = {m}").select(*grams.columns(width)), m, n_often))
        named = materialize(grams.summed(out.where(F.col("n").isin(*sizes)), width).where("count > 0"), "grams")
    return named.mapInArrow(grams.spelled(tokens_, width), "gram string, n_tokens int, count long, n_left long, n_right long")


def _branching_by_names(df: DataFrame, key: str, sizes: tuple[int, ...], least: int, text: str) -> DataFrame:
    """The same for a vocabulary of any size: a first pass counts 64-bit names of all n-grams, so that strings are made and shuffled only for
    those frequent enough."""
    top = max(sizes)
    # One row a token, with what stands before it and the tokens that follow: shifted arrays, zipped.
    ahead = [F.slice("w", k + 1, F.size("w")).alias(f"t{k}") for k in range(top + 1)]
    rows = runs(df, [key], text).select(F.explode(F.arrays_zip(F.concat(F.array(F.lit(None)), "w").alias("left"), *ahead)).alias("z")).select("z.*").where("t0 IS NOT NULL")
    name = lambda n: F.when(F.col(f"t{n - 1}").isNotNull(), F.xxhash64(*[f"t{k}" for k in range(n)]))
    grams = rows.select("*", F.explode(F.array(*[F.struct(name(n).alias("h"), F.lit(n).alias("n_tokens")) for n in sizes])).alias("g")).select("*", "g.h", "g.n_tokens").where("h IS NOT NULL")
    often = grams.select("h").groupBy("h").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= least).select("h")
    seen = keep_ids(grams, materialize(often, "grams-often"), "h")
    tokens_ = F.array(*[f"t{k}" for k in range(top + 1)])
    sides = F.array("left", F.get(tokens_, F.col("n_tokens")))
    seen = seen.select(F.array_join(F.slice(tokens_, 1, F.col("n_tokens")), " ").alias("gram"), "n_tokens", F.posexplode(sides).alias("side", "other"))
    beside = seen.groupBy("gram", "n_tokens", "side", "other").agg(F.count(F.lit(1)).alias("c"))
    out = beside.groupBy("gram", "n_tokens").agg(F.sum(F.when(F.col("side") == 0, F.col("c"))).alias("count"), F.count_if(F.col("side") == 0).alias("n_left"), F.count_if(F.col("side") == 1).alias("n_right"))
    return out.where(F.col("count") >= least).select("gram", "n_tokens", "count", "n_left", "n_right")


def branching_score(count: Column, left: Column, right: Column, n: Column) -> Column:
    """ln(count) * ln(smaller variety) * (1 + 0.35 n), to two digits."""
    return F.round(F.log(count) * F.log(F.greatest(F.least(left, right), F.lit(1))) * (1 + 0.35 * n), 2)


def term_candidates(
    df: DataFrame, key: str, head_stop: list[str], tail_stop: list[str], sizes: tuple[int, ...] = (2, 3, 4, 5), least: int = 25, variety: int = 3, share: float = 0.85
) -> DataFrame:
    """Scored terms: no stopword of its kind at either end, ``variety`` neighbours on both sides, parts absorbed.

    A term goes if a longer candidate contains it with at least ``share`` of its count. Terms are
    matched by exploding the longer ones into their sub-grams, an equi-join rather than a
    containment test of all pairs.
    """
    w = F.split("gram", " ")
    found = branching(df, key, sizes, least).where((F.col("n_left") >= variety) & (F.col("n_right") >= variety))
    found = materialize(found.where(~F.element_at(w, 1).isin(head_stop) & ~F.element_at(w, -1).isin(tail_stop)), "terms")
    subs = F.flatten(F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda m: F.transform(F.sequence(F.lit(0), F.size(w) - m), lambda i: F.array_join(F.slice(w, i + 1, m), " "))))
    parts = found.where("n_tokens > 1").select(F.col("count").alias("longer"), F.explode(F.array_distinct(subs)).alias("gram")).groupBy("gram").agg(F.max("longer").alias("longer"))
    absorbed = parts.join(found.select("gram", "count"), "gram").where(F.col("longer") >= share * F.col("count")).select("gram")
    kept = found.join(absorbed, "gram", "left_anti")
    return kept.withColumn("score", branching_score(F.col("count"), F.col("n_left"), F.col("n_right"), F.col("n_tokens")))


def particle_rule(df: DataFrame, pairs: Column, expect: dict[str, str]) -> DataFrame:
    """``prev, got, want, n, agrees``: particles after each final letter against the one it asks for; the rest of the rule's
    rows are its violations. ``pairs`` are each text's ``got, prev``. Only particles that the rule knows, after letters that it knows, are checked."""
    asked = F.create_map(*[F.lit(x) for pair in expect.items() for x in pair])
    t = df.select(F.inline(pairs)).where(F.col("got").isin(sorted(set(expect.values()))) & F.col("prev").isin(list(expect)))
    t = t.groupBy("prev", "got").agg(F.count(F.lit(1)).alias("n")).withColumn("want", asked[F.col("prev")])
    return t.select("prev", "got", "want", "n", (F.col("got") == F.col("want")).alias("agrees"))


# --- joins ----------------------------------------------------------------------------------


def decode(df: DataFrame, key: str, dimension: DataFrame, default: Column) -> DataFrame:
    """Left join with a default: ``dimension`` has ``key, value``; adds ``value`` and ``known``."""
    d = dimension.select(key, F.col("value").alias("_v"))
    out = df.join(d, key, "left")
    return out.withColumn("known", F.col("_v").isNotNull()).withColumn("value", F.coalesce("_v", default)).drop("_v")


def reconcile(left: DataFrame, right: DataFrame, key: str, left_hash: str, right_hash: str) -> DataFrame:
    """Full outer reconciliation: ``key, status`` of missing, orphan, edited or same."""
    a = left.select(key, F.col(left_hash).alias("a"), F.lit(True).alias("in_a"))
    b = right.select(key, F.col(right_hash).alias("b"), F.lit(True).alias("in_b"))
    both = a.join(b, key, "full")
    return both.select(key, F.when(F.col("in_b").isNull(), "missing").when(F.col("in_a").isNull(), "orphan").when(F.col("a").eqNullSafe(F.col("b")), "same").otherwise("edited").alias("status"))


def as_of(events: DataFrame, anchors: DataFrame, group: str, at: str, value: str) -> DataFrame:
    """Last anchor value at or before each event, by one window over the union (no range join)."""
    u = events.select(group, at, F.lit(1).alias("is_event"), F.lit(None).cast(anchors.schema[value].dataType).alias(value))
    u = u.unionByName(anchors.select(group, at, F.lit(0).alias("is_event"), value))
    w = Window.partitionBy(group).orderBy(at, "is_event").rowsBetween(Window.unboundedPreceding, 0)
    return u.withColumn("found", F.last(value, ignorenulls=True).over(w)).where("is_event = 1").select(group, at, F.col("found").alias(value))


def reconcile_records(records: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Records against files: ``key, missing, orphan, edited, stale, unstamped``, for rows with a problem.

    ``records`` has ``key, status, source_hash, output_hash``; ``files`` has ``key, source_now, output_now``
    (null output: no file). Missing: done without a file. Orphan: pending with one. Edited and stale: a recorded
    hash differs from today's. Unstamped: done without a hash.
    """
    j = records.join(files, key, "left")
    done, file = F.col("status") != "pending", F.col("output_now").isNotNull()
    flags = {
        "missing": done & ~file, "orphan": ~done & file, "edited": file & (F.col("output_hash") != F.col("output_now")),
        "stale": done & (F.col("source_hash") != F.col("source_now")), "unstamped": done & F.col("output_hash").isNull(),
    }
    out = j.select(key, *[F.coalesce(v, F.lit(False)).alias(k) for k, v in flags.items()])
    return out.where(" OR ".join(flags))


def parent_of(df: DataFrame, doc: str, order: str, level: str) -> DataFrame:
    """``doc, order, parent``: the order number of the nearest earlier row of a smaller level."""
    rows = df.select(doc, F.col(order).cast("long").alias(order), F.col(level).cast("int").alias("_l"))
    return folds.folded(rows, doc, [order, "_l"], folds.parents, f"{order} long, parent long")


# --- windows --------------------------------------------------------------------------------


def islands(df: DataFrame, doc: str, order: str, kind: str) -> DataFrame:
    """Runs of equal ``kind``: ``doc, island, kind, first, last, n``."""
    w = Window.partitionBy(doc).orderBy(order)
    flagged = df.withColumn("_new", (~F.lag(kind).over(w).eqNullSafe(F.col(kind)) | (F.row_number().over(w) == 1)).cast("int"))
    numbered = flagged.withColumn("island", F.sum("_new").over(w))
    return numbered.groupBy(doc, "island", kind).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n"))


def running_balance(df: DataFrame, doc: str, order: str, change: Column) -> DataFrame:
    """``doc, balance, least``: final and smallest running sum of ``change``."""
    w = Window.partitionBy(doc).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_b", F.sum(change).over(w)).groupBy(doc).agg(F.sum(change).alias("balance"), F.min("_b").alias("least"))


# --- ordered folds --------------------------------------------------------------------------


def cluster_means(df: DataFrame, group: str, value: str, tolerance: float) -> DataFrame:
    """1-D clusters of ascending values by running mean, closer than ``tolerance``: ``group, cluster (from 1), mean, n``.

    A value can't be that close to an earlier cluster's mean without having joined it, so the last one decides.
    """
    return folds.folded(df.select(group, F.col(value).cast("double").alias("_v")), group, ["_v"], folds.clusters(tolerance), "cluster int, mean double, n long")


def greedy_spans(df: DataFrame, group: str, order: str, size: str, most: int) -> DataFrame:
    """Neighbouring rows merged while their sizes sum to at most ``most``: ``group, span, first, last, total``."""
    rows = df.select(group, F.col(order).cast("long").alias("_o"), F.col(size).cast("long").alias("_s"))
    return folds.folded(rows, group, ["_o", "_s"], folds.spans(most), "span int, first long, last long, total long")


def equal_parts(df: DataFrame, key: str, size: str, target: int) -> DataFrame:
    """Long spans in near-equal parts: ``key, part (from 1), start (from 0), length``."""
    n = F.greatest(F.lit(1), F.round(F.col(size) / target)).cast("int")
    parts = df.where(F.col(size) > 0).select(key, F.col(size).alias("_s"), n.alias("_n"), F.explode(F.sequence(F.lit(1), n)).alias("part"))
    start = F.floor((F.col("part") - 1) * F.col("_s") / F.col("_n"))
    return parts.select(key, "part", start.cast("long").alias("start"), (F.floor(F.col("part") * F.col("_s") / F.col("_n")) - start).cast("long").alias("length"))
