"""Mixing sources to target weights by entropy balancing, in Spark SQL functions only.

The rates of a source's documents minimise the relative entropy to "every document once" under
two constraints: the source's expected words equal its target, and no rate exceeds the cap. The
solution is an exponential tilt, ``rate = min(CAP, exp(lambda * words / mean words))``, with one
dual variable per source. The convex dual is solved by Newton steps kept inside a bracket; a step
is one aggregation of (source, size) counts, so hot sources are summed inside the map tasks. The
dual variables stay in a table (one row a source) that is written after each step.

Rates become whole copies by error diffusion inside buckets of about ``BUCKET`` documents of one
source (chosen by hash), large documents first, so a bucket misses its target by about its
smallest document; a hot source just has more buckets.

Edge cases: null texts have size 0, which takes nothing; the null source is a source and comes
last; ties (equal sizes) are ordered by id; repeated rows are taken row by row; an empty table
gives an empty result; if all sizes are 0, all targets are 0; other columns are ignored by
``mix_rates`` and kept by ``mix_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import keep_ids, materialize

SPACE = r"[\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
BUCKET = 512
TOLERANCE = 1e-7
MAX_STEPS = 60
BRACKET = 60.0


def word_count(text: Column) -> Column:
    blank = F.coalesce(text.cast("string"), F.lit(""))
    return F.size(F.filter(F.split(blank, SPACE), lambda w: w != "")).cast("long")


def ranked(df: DataFrame, order: Column, name: str) -> DataFrame:
    """Adds ``name``, the rank (from 0) by ``order``, without a window over all rows: ranges are sorted and then counted."""
    ranges = materialize(df.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), "mix-ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    start = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(order)) - 1
    return ranges.withColumn("_own", own).join(F.broadcast(start), "_range").withColumn(name, F.col("_start") + F.col("_own")).drop("_range", "_own", "_start")


def targets(totals: DataFrame) -> DataFrame:
    """Adds ``target`` to one row a source (``sk, source, source_size``), by water-filling.

    The common level of those below their cap follows from which are capped; raising it caps more, until none is
    added. Each round is one sum over the sources.
    """
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    out = ranked(totals, F.col("source").asc_nulls_last(), "_rank")
    out = out.withColumn("weight", F.element_at(weights, (F.col("_rank") % len(WEIGHTS) + 1).cast("int"))).withColumn("cap", F.col("source_size") * float(CAP))
    out = materialize(out.drop("_rank"), "mix-sources")
    total = (out.agg(F.sum("source_size")).first()[0] or 0) * SHARE
    level, capped = 0.0, -1
    for _ in range(MAX_STEPS):
        over = F.col("cap") < F.col("weight") * level
        r = out.agg(F.count_if(over).alias("n"), F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0.0)).alias("cap"), F.sum(F.when(~over, F.col("weight"))).alias("weight")).first()
        if r.n == capped or not r.weight:
            break
        level, capped = (total - r.cap) / r.weight, r.n
    else:
        raise RuntimeError("the sources' level did not settle")
    return out.select("sk", "source", "source_size", "n_docs", F.least(F.col("cap"), F.col("weight") * level).alias("target"))


def _rate(lam: str = "lam", x: str = "x") -> str:
    return f"least({CAP}D, exp(least(50D, {lam} * {x})))"


def solve(sizes: DataFrame) -> DataFrame:
    """The dual variables: ``sk, source_size, target, n_docs, unit, lam``, one row a source."""
    histogram = materialize(sizes.groupBy("sk", "size").agg(F.count(F.lit(1)).alias("n"), F.first("source").alias("source")), "mix-histogram")
    totals = histogram.groupBy("sk").agg(F.first("source").alias("source"), F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs"))
    state = targets(totals).select(
        "sk", "source_size", "target", "n_docs", (F.col("source_size") / F.col("n_docs")).alias("unit"),
        F.lit(-BRACKET).alias("lo"), F.lit(BRACKET).alias("hi"),
        # A source that is taken in full or not at all has its answer at an end of the bracket.
        F.expr(f"CASE WHEN target >= {CAP}D * source_size THEN {BRACKET}D ELSE 0D END").alias("lam"),
        F.expr(f"target >= {CAP}D * source_size").alias("done"),
    )
    state = materialize(state, "mix-state")
    for _ in range(MAX_STEPS):
        seen = histogram.where("size > 0").join(state.where("NOT done").select("sk", "lam", "unit"), "sk").withColumn("x", F.expr("size / unit"))
        slopes = seen.groupBy("sk").agg(F.sum(F.expr(f"n * x * {_rate()}")).alias("value"), F.sum(F.expr(f"CASE WHEN exp(least(50D, lam * x)) < {CAP}D THEN n * x * x * exp(lam * x) ELSE 0D END")).alias("slope"))
        step = state.join(slopes, "sk", "left").withColumn("gap", F.expr("value - target / unit"))
        step = step.withColumn("lo", F.expr("CASE WHEN NOT done AND gap < 0 THEN lam ELSE lo END")).withColumn("hi", F.expr("CASE WHEN NOT done AND gap >= 0 THEN lam ELSE hi END"))
        step = step.withColumn("now_done", F.expr(f"done OR gap IS NULL OR abs(gap) <= {TOLERANCE}D * target / unit OR hi - lo < 1e-12D"))
        step = step.withColumn("newton", F.expr("lam - gap / nullif(slope, 0D)"))
        step = step.withColumn("lam", F.expr("CASE WHEN now_done THEN lam WHEN newton > lo AND newton < hi THEN newton ELSE (lo + hi) / 2 END"))
        state = materialize(step.select("sk", "source_size", "target", "n_docs", "unit", "lo", "hi", "lam", F.col("now_done").alias("done")), "mix-state")
        if state.where("NOT done").isEmpty():
            break
    else:
        raise RuntimeError("the dual did not settle")
    # Rounded, so that the order in which sums were added up cannot show.
    return state.select("sk", "source_size", "target", "n_docs", "unit", F.round("lam", 9).alias("lam"))


def _source_key(source: Column) -> Column:
    source = source.cast("string")
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def number_equal(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Adds ``name``: the number (from 1) of a row among those with equal ``keys`` (null equals null); which is which cannot show.

    Rows that stand alone get 1 and stay where they are. The others are numbered inside each input partition, and
    the partitions' counts are added up, so that no key's rows meet in one task.
    """
    key = F.xxhash64(*[F.coalesce(F.concat(F.lit("v"), F.col(k).cast("string")), F.lit("n")) for k in keys])
    keyed = df.withColumn("_key", key).withColumn("_part", F.spark_partition_id())
    many = materialize(keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_key"), "mix-equal")
    if many.isEmpty():
        return df.withColumn(name, F.lit(1).cast("long"))
    again = materialize(keep_ids(keyed, many, "_key"), "mix-again")  # written, so that a row's partition is one and the same in what follows
    counts = again.groupBy("_key", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    start = counts.select("_key", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_key", "_part").orderBy(F.lit(1)))
    numbered = again.withColumn("_own", own).join(start, ["_key", "_part"]).withColumn(name, F.col("_start") + F.col("_own"))
    alone = keep_ids(keyed, many, "_key", anti=True).withColumn(name, F.lit(1).cast("long"))
    return alone.select(*df.columns, name).unionByName(numbered.select(*df.columns, name))


def mix_rates(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``id_col, sk, text_hash, nth, size, source_size, target, rate, copies, taken`` for every row of ``docs``.

    ``sk`` names the source; ``nth`` tells equal rows (of one id, source and text) apart.
    """
    sizes = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), _source_key(F.col(source_col)).alias("sk"),
        word_count(F.col(text_col)).alias("size"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"),
    )
    sizes = materialize(sizes, "mix-sizes")
    rated = number_equal(sizes, ["id", "sk", "text_hash"], "nth").join(solve(sizes), "sk").withColumn("x", F.expr("size / unit"))
    rated = rated.withColumn("rate", F.when(F.col("size") == 0, F.lit(1.0)).otherwise(F.round(F.expr(_rate()), 9)))
    rated = rated.withColumn("bucket", F.expr(f"pmod(xxhash64(id, text_hash, nth), CAST(ceil(n_docs / {BUCKET}) AS BIGINT))"))
    packs = rated.groupBy("sk", "bucket", "source_size", "target").agg(F.array_sort(F.collect_list(F.expr("struct(-size AS neg, id, text_hash, nth, size, rate)"))).alias("docs"))
    start = F.struct(F.lit(0.0).alias("err"), F.expr("CAST(array() AS ARRAY<INT>)").alias("copies"))

    def diffuse(s: Column, d: Column) -> Column:
        want = s["err"] + d["rate"] * d["size"]
        # One copy beyond the rate's neighbours lets small documents make up for large ones.
        low = F.greatest(F.lit(0), F.floor(d["rate"]).cast("int") - 1)
        high = F.least(F.lit(CAP), F.floor(d["rate"]).cast("int") + 2)
        copies = F.when(d["size"] == 0, F.lit(1)).otherwise(F.least(high, F.greatest(low, F.round(want / F.nullif(d["size"], F.lit(0))).cast("int"))))
        return F.struct((want - copies * d["size"]).alias("err"), F.concat(s["copies"], F.array(copies)).alias("copies"))

    packs = packs.withColumn("copies", F.aggregate("docs", start, diffuse, lambda s: s["copies"]))
    rows = packs.select("sk", "source_size", "target", F.explode(F.arrays_zip("docs", "copies")).alias("r"))
    return rows.select(
        F.col("r.docs.id").alias(id_col), "sk", F.col("r.docs.text_hash").alias("text_hash"), F.col("r.docs.nth").alias("nth"), F.col("r.docs.size").alias("size"), "source_size", "target",
        F.col("r.docs.rate").alias("rate"), F.col("r.copies").alias("copies"), (F.col("r.copies") * F.col("r.docs.size")).cast("long").alias("taken"),
    )


def mix_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the mix takes it, own columns only."""
    taken = mix_rates(docs, id_col, source_col, text_col).select(F.col(id_col).alias("_mix_id"), F.col("sk").alias("_mix_sk"), F.col("text_hash").alias("_mix_hash"), F.col("nth").alias("_mix_nth"), F.col("copies").alias("_mix_copies"))
    taken = materialize(taken, "mix-taken")
    rows, nth = docs, F.lit(1)
    if not taken.where("_mix_nth > 1").isEmpty():
        keyed = docs.withColumn("_mix_row_id", F.col(id_col)).withColumn("_mix_row_sk", _source_key(F.col(source_col))).withColumn("_mix_row_hash", F.xxhash64(F.col(text_col).cast("string")))
        rows = number_equal(keyed, ["_mix_row_id", "_mix_row_sk", "_mix_row_hash"], "_mix_row_nth")
        nth = F.col("_mix_row_nth")
    same = rows[id_col].eqNullSafe(F.col("_mix_id")) & (_source_key(rows[source_col]) == F.col("_mix_sk")) & (F.xxhash64(rows[text_col].cast("string")) == F.col("_mix_hash")) & (nth == F.col("_mix_nth"))
    found = rows.join(taken.where("_mix_copies > 0").hint("shuffle_hash"), same)
    return found.withColumn("_mix_again", F.explode(F.expr("sequence(1, _mix_copies)"))).select(*[rows[c] for c in docs.columns])
