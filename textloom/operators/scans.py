"""Scans, stacks, spans and range joins in which one key may hold any part of all rows.

A window by key is one task a key. Here rows are put in order by (key, order) over ranges, so a key of any size is many
ranges, and each range is a block. What a scan needs from before a block is a summary of the blocks before it, and in
the global order only the first key of a range can have begun earlier: there is one summary row a range at most,
which is joined by broadcast.

``running`` is such a scan for sums, least, greatest and last values. From it follow islands and segments, ``above`` (a
lookup of the nearest greater record, as one more scan), the next greater row and the parent of a row (a stack
inside blocks, then lookups for what a block leaves open), and greedy spans (next starts, doubled in rounds of joins).
``range_pairs`` joins points with ranges that hold them by dyadic cells.

Rows must be told apart by (key, order); null keys are one key; nulls of a value are passed over; an empty table gives
an empty result; columns that begin with an underscore are the functions' own.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.session import materialize

HOW = {"sum": F.sum, "min": F.min, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}


#: Rows of a block, about.
BLOCK_ROWS = 200_000


def blocked(df: DataFrame, key: str, *order: str, blocks: int | None = None, keep: Callable[[DataFrame, str], DataFrame] = materialize) -> DataFrame:
    """``df`` with ``_block``: ranges of rows in the order of (key, order), numbered in it, written once.

    Without ``blocks`` there are as many as the session has shuffle partitions, or more, so that a block (which some steps hold
    whole) has about ``BLOCK_ROWS`` rows however large the table is. ``keep`` writes the table.
    """
    n = blocks or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // BLOCK_ROWS))
    return keep(df.repartitionByRange(n, key, *order).withColumn("_block", F.spark_partition_id()), "blocks")


def running(blocks: DataFrame, key: str, order: list[str], value: Column, name: str, how: str = "sum", before: bool = False) -> DataFrame:
    """``blocks`` (of :func:`blocked` in the same order) with ``name``: the scan of ``value`` within the key, up to the row or up to the one before.

    ``how`` is ``sum``, ``min``, ``max`` or ``last`` (not null); of no value it is null.
    """
    rows = blocks.withColumn("_run_value", value)
    inside = Window.partitionBy(key, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    total = F.max_by("_run_value", F.when(F.col("_run_value").isNotNull(), F.struct(*order))) if how == "last" else HOW[how]("_run_value")
    summary = rows.groupBy(F.col(key).alias("_run_k"), F.col("_block").alias("_run_b")).agg(total.alias("_run_sum"))
    carried = _carried(rows, summary, key, how)
    out = rows.withColumn("_run_own", HOW[how]("_run_value").over(inside))
    out = out.join(F.broadcast(carried), rows[key].eqNullSafe(carried["_run_key"]) & (rows["_block"] == carried["_run_of"]), "left")
    both = {"sum": F.coalesce(F.col("_run_own") + F.col("_run_before"), "_run_own", "_run_before"), "min": F.least("_run_own", "_run_before"), "max": F.greatest("_run_own", "_run_before"), "last": F.coalesce("_run_own", "_run_before")}
    return out.withColumn(name, both[how]).drop("_run_value", "_run_own", "_run_key", "_run_of", "_run_before")


def _carried(rows: DataFrame, summary: DataFrame, key: str, how: str) -> DataFrame:
    """``_run_key, _run_of, _run_before``: for each block that continues a key, what the blocks before it sum to; a row a block at most."""
    starts = rows.groupBy(key).agg(F.min("_block").alias("_first"), F.max("_block").alias("_last")).where("_first < _last")
    continued = starts.select(key, F.explode(F.sequence(F.col("_first"), F.col("_last"))).alias("_block"))
    parts = continued.join(summary, continued[key].eqNullSafe(F.col("_run_k")) & (continued["_block"] == F.col("_run_b")), "left")
    w = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(F.col(key).alias("_run_key"), F.col("_block").alias("_run_of"), HOW[how]("_run_sum").over(w).alias("_run_before"))


def islands(df: DataFrame, key: str, order: str, value: str, blocks: int | None = None) -> DataFrame:
    """``key, value, first, last, n``: maximal runs of rows with one value."""
    rows = blocked(df.select(key, order, value), key, order, blocks=blocks)
    rows = running(rows, key, [order], F.struct(value), "_prev", "last", before=True)
    change = F.when(F.col("_prev").isNull() | ~F.col(f"_prev.{value}").eqNullSafe(F.col(value)), 1).otherwise(0)
    rows = running(rows, key, [order], change, "_island")
    return rows.groupBy(key, "_island", value).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n")).drop("_island")


def segments(df: DataFrame, key: str, order: str, stop: Column, blocks: int | None = None) -> DataFrame:
    """``key, seg, n``: the rows between stops, numbered by the stops before them; the stops aside."""
    rows = blocked(df.withColumn("_stop", stop.cast("long")).select(key, order, "_stop"), key, order, blocks=blocks)
    return running(rows, key, [order], F.col("_stop"), "seg").where("_stop = 0").groupBy(key, "seg").agg(F.count(F.lit(1)).alias("n"))


def balance(df: DataFrame, key: str, order: str, value: Column, blocks: int | None = None) -> DataFrame:
    """``key, balance, least``: the sum of ``value`` and the least of its running sums."""
    rows = blocked(df.withColumn("_x", value).select(key, order, "_x"), key, order, blocks=blocks)
    return running(rows, key, [order], F.col("_x"), "_sum").groupBy(key).agg(F.sum("_x").alias("balance"), F.min("_sum").alias("least"))


# --- lookups and stacks ---------------------------------------------------------------------


def above(queries: DataFrame, records: DataFrame, key: str, value: str, order: str, found: str, blocks: int | None = None) -> DataFrame:
    """``queries (key, value, …)`` with ``found``: ``order`` of the record (``key, value, order``) with the least value above, the first of those in order.

    Queries and records stand in one order, greatest values first and queries before records of their value; a scan
    for the last record is the lookup.
    """
    names = [c for c in queries.columns if c not in (key, value)]
    both = queries.select(key, value, F.lit(0).alias("_kind"), F.lit(None).cast(dict(records.dtypes)[order]).alias("_at"), *names)
    both = both.unionByName(records.select(key, value, F.lit(1).alias("_kind"), F.col(order).alias("_at")), allowMissingColumns=True)
    both = both.withColumn("_neg", -F.col(value)).withColumn("_late", F.coalesce(-F.col("_at"), F.lit(0)))
    order_by = ["_neg", "_kind", "_late"]
    rows = running(blocked(both, key, *order_by, blocks=blocks), key, order_by, F.col("_at"), found, "last")
    return rows.where("_kind = 0").select(key, value, *names, found)


def _stacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A block's rows in order: next greater row inside, or none; and whether a row is greater than all before it."""
    rows, values = table["_row"].to_numpy(), table["_v"].to_numpy()
    by = np.argsort(rows, kind="stable")
    rows, values = rows[by], values[by]
    nxt, stack = np.full(len(rows), -1, np.int64), []
    for i, v in enumerate(values.tolist()):
        while stack and values[stack[-1]] < v:
            nxt[stack.pop()] = i
        stack.append(i)
    records = np.ones(len(rows), bool)
    records[1:] = values[1:] > np.maximum.accumulate(values)[:-1]
    return rows, values, nxt, records


def next_greater(df: DataFrame, key: str, order: str, value: str, name: str, blocks: int | None = None) -> DataFrame:
    """``key, order, value`` and ``name``: ``order`` of the first later row of the key with a greater value, or null.

    ``order`` must be integers, ``value`` numbers (compared as doubles, not null). A block's stack finds what lies inside. For each of the rest a
    table of the blocks' greatest values (a row a block) tells the block, and a lookup among its records the row.
    """
    kinds = dict(df.dtypes)
    keyed = df.select(F.struct(F.col(key)).alias("_key"), F.col(order).cast("long").alias("_row"), F.col(value).cast("double").alias("_v"))
    rows = blocked(keyed, "_key", "_row", blocks=blocks)

    def fold(table: pa.Table) -> pa.Table:
        at, values, nxt, records = _stacked(table)
        found = pa.array([int(at[j]) if j >= 0 else None for j in nxt.tolist()], pa.int64())
        one = lambda c: pa.chunked_array([pa.repeat(table[c][0], len(at))])
        return pa.table([one("_key"), one("_block"), pa.array(at), pa.array(values), found, pa.array(records)], names=["_key", "_block", "_row", "_v", "_next", "_record"])

    folded = materialize(rows.groupBy("_key", "_block").applyInArrow(fold, f"_key struct<{key}: {kinds[key]}>, _block int, _row long, _v double, _next long, _record boolean"), "stacks")
    # One row a block; a key in one block has nothing to look up.
    most = folded.groupBy("_key", "_block").agg(F.max("_v").alias("m"))
    later = most.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("_block", "m"))).alias("_blocks")).where(F.size("_blocks") > 1)
    open_rows = folded.where("_next IS NULL").join(F.broadcast(later), "_key")
    target = materialize(open_rows.withColumn("_to", _block_above(F.col("_blocks"), F.col("_block"), F.col("_v"))).where("_to IS NOT NULL").select("_key", F.col("_to").alias("_block"), "_v", F.col("_row").alias("_asks")), "open")
    place = F.struct(F.col("_key"), F.col("_block")).alias("_place")
    found = above(target.select(place, "_v", "_asks"), folded.where("_record").select(place, "_v", "_row"), "_place", "_v", "_row", "_found", blocks)
    found = found.select(F.col("_place._key").alias("_key"), F.col("_asks").alias("_row"), "_found")
    out = folded.join(found, (folded["_key"] == found["_key"]) & (folded["_row"] == found["_row"]), "left")
    return out.select(folded[f"_key.{key}"].alias(key), folded["_row"].cast(kinds[order]).alias(order), folded["_v"].cast(kinds[value]).alias(value), F.coalesce("_next", "_found").cast(kinds[order]).alias(name))


@F.pandas_udf(T.IntegerType())
def _block_above(blocks, own, value):
    """The first later block whose greatest value is above the row's. Batches mostly hold rows of few blocks."""
    import pandas as pd

    out, tops = [None] * len(own), {}
    for k, (mine, v) in enumerate(zip(own, value, strict=True)):
        there = blocks.iloc[k]
        place = (mine, there[-1]["_block"])  # of the keys of a block only one goes on
        if place not in tops:
            rest = [(b["_block"], b["m"]) for b in there if b["_block"] > mine]
            tops[place] = [b for b, _ in rest], np.maximum.accumulate([m for _, m in rest]).tolist() if rest else []
        numbers, greatest = tops[place]
        at = bisect_right(greatest, v)
        out[k] = numbers[at] if at < len(greatest) else None
    return pd.Series(out, dtype="Int32")


def parent_of(df: DataFrame, key: str, order: str, level: str, name: str = "parent", blocks: int | None = None) -> DataFrame:
    """``key, order, level`` and ``name``: ``order`` of the last earlier row with a lower level: the next greater, seen backwards."""
    kinds = dict(df.dtypes)
    back = df.select(key, (-F.col(order).cast("long")).alias("_back"), (-F.col(level).cast("double")).alias("_depth"))
    out = next_greater(back, key, "_back", "_depth", "_up", blocks)
    return out.select(key, (-F.col("_back")).cast(kinds[order]).alias(order), (-F.col("_depth")).cast(kinds[level]).alias(level), (-F.col("_up")).cast(kinds[order]).alias(name))


# --- greedy spans ---------------------------------------------------------------------------


def greedy_spans(df: DataFrame, key: str, order: str, size: str, most: int, blocks: int | None = None) -> DataFrame:
    """``key, first, last, n, total``: neighbours merged while their sizes sum to at most ``most``; a larger row is alone.

    The start after a row's span is the first row whose running sum exceeds the sum before the row by more than ``most``.
    The starts of a key are what its first row reaches by that step. Reached rows take a step of 1, 2, 4, … starts in
    each round, and the step is joined with itself for the next: as many rounds as the longest chain has binary digits.
    ``order`` must be integers and ``size`` not negative.
    """
    rows = blocked(df.select(key, F.col(order).cast("long").alias("_row"), F.col(size).cast("long").alias("_size")), key, "_row", blocks=blocks)
    rows = running(rows, key, ["_row"], F.col("_size"), "_sum")
    rows = materialize(rows.select(F.struct(F.col(key)).alias("_key"), "_row", "_size", "_sum"), "sums")
    ask = rows.select("_key", (F.col("_sum") - F.col("_size") + most).alias("_limit"), "_row")
    nxt = above(ask.withColumnRenamed("_row", "_asks"), rows.select("_key", F.col("_sum").alias("_limit"), "_row"), "_key", "_limit", "_row", "_to", blocks)
    # A row larger than the limit is the first above it itself: the next start is the row after.
    following = _following(rows, blocks)
    step = nxt.select("_key", F.col("_asks").alias("_row"), "_to").join(following, ["_key", "_row"])
    step = step.select("_key", "_row", F.when(F.col("_to") > F.col("_row"), F.col("_to")).otherwise(F.when(F.col("_to") == F.col("_row"), F.col("_after"))).alias("_to"))
    step = materialize(step.where("_to IS NOT NULL"), "step")
    starts = materialize(rows.groupBy("_key").agg(F.min("_row").alias("_row")), "starts")
    while True:
        reached = starts.join(step, ["_key", "_row"]).select("_key", F.col("_to").alias("_row")).join(starts, ["_key", "_row"], "left_anti")
        more = materialize(reached.distinct(), "reached")
        if more.isEmpty():
            break
        starts = materialize(starts.unionByName(more), "starts")
        twice = step.alias("a").join(step.alias("b"), (F.col("a._key") == F.col("b._key")) & (F.col("a._to") == F.col("b._row")))
        step = materialize(twice.select(F.col("a._key").alias("_key"), F.col("a._row").alias("_row"), F.col("b._to").alias("_to")), "step")
    marked = rows.join(starts.select("_key", "_row", F.lit(1).alias("_start")), ["_key", "_row"], "left")
    marked = blocked(marked.withColumn("_start", F.coalesce("_start", F.lit(0))), "_key", "_row", blocks=blocks)
    spans = running(marked, "_key", ["_row"], F.col("_start"), "_span").groupBy("_key", "_span")
    return spans.agg(F.min("_row").alias("first"), F.max("_row").alias("last"), F.count(F.lit(1)).alias("n"), F.sum("_size").alias("total")).select(F.col(f"_key.{key}").alias(key), "first", "last", "n", "total")


def _following(rows: DataFrame, blocks: int | None) -> DataFrame:
    """``_key, _row, _after``: the next row of the key, by a scan of the rows in falling order."""
    falling = blocked(rows.select("_key", "_row", (-F.col("_row")).alias("_down")), "_key", "_down", blocks=blocks)
    return running(falling, "_key", ["_down"], F.col("_row"), "_after", "last", before=True).select("_key", "_row", "_after")


def section_chunks(sections: DataFrame, books: DataFrame, target: int = 4, most: int = 5, blocks: int | None = None) -> DataFrame:
    """``book, first, last, part, parts, n_sections, owner``: a book's pages cut to chunks at the starts of its sections.

    ``sections`` has ``book, page, level, title``, ``books`` has ``book, first, last`` (pages). A book begins a chunk at its first
    page; short neighbours are merged up to ``most`` pages, and what has more than ``target`` is cut to nearly equal parts.
    A chunk belongs to its section of lowest level, the first of them; without one to the last section before it (null: none).
    """
    inside = sections.join(books.select("book", F.col("first").alias("_first"), F.col("last").alias("_last")), "book").where("page BETWEEN _first AND _last")
    inside = materialize(inside.select(F.col("book").alias("book"), F.col("page").cast("long").alias("page"), "level", "title"), "sections")
    starts = inside.select("book", "page").unionByName(books.select("book", F.col("first").cast("long").alias("page"))).distinct()
    ends = starts.unionByName(books.select("book", (F.col("last") + 1).cast("long").alias("page"))).distinct()
    falling = blocked(ends.withColumn("_down", -F.col("page")), "book", "_down", blocks=blocks)
    sized = running(falling, "book", ["_down"], F.col("page"), "_next", "last", before=True).where("_next IS NOT NULL").select("book", "page", (F.col("_next") - F.col("page")).alias("size"))
    merged = greedy_spans(sized, "book", "page", "size", most, blocks)
    cut = merged.select("book", "first", "total", F.ceil(F.col("total") / target).cast("int").alias("parts")).withColumn("part", F.explode(F.sequence(F.lit(1), F.col("parts"))))
    wide = F.ceil(F.col("total") / F.col("parts"))
    cut = cut.withColumn("_from", F.col("first") + (F.col("part") - 1) * wide).withColumn("_to", F.least(F.col("first") + F.col("part") * wide, F.col("first") + F.col("total")) - 1)
    chunks = materialize(cut.where("_from <= _to").select("book", F.col("_from").cast("long").alias("first"), F.col("_to").cast("long").alias("last"), "part", "parts"), "chunks")
    found = range_pairs(chunks.select("book", "first", "last"), inside, "first", "last", "page", group="book")
    own = found.groupBy("book", "first").agg(F.count(F.lit(1)).alias("n_sections"), F.min(F.struct("level", "page", "title")).alias("_own"))
    # The last section before a chunk: a scan over sections and chunks in the order of pages.
    both = inside.groupBy("book", "page").agg(F.max_by("title", "level").alias("title")).unionByName(chunks.select("book", F.col("first").alias("page"), F.lit(None).cast("string").alias("title"), F.lit(True).alias("_asks")), allowMissingColumns=True)
    both = both.withColumn("_kind", F.coalesce("_asks", F.lit(False)).cast("int"))
    asked = running(blocked(both, "book", "page", "_kind", blocks=blocks), "book", ["page", "_kind"], F.col("title"), "_before", "last").where("_kind = 1").select("book", F.col("page").alias("first"), "_before")
    out = chunks.join(own, ["book", "first"], "left").join(asked, ["book", "first"])
    return out.select("book", "first", "last", "part", "parts", F.coalesce("n_sections", F.lit(0)).alias("n_sections"), F.coalesce("_own.title", "_before").alias("owner"))


def tiled(chunks: DataFrame, books: DataFrame) -> DataFrame:
    """``book, proved``: whether a book's chunks (``book, first, last``) cover each of its pages once."""
    sums = chunks.groupBy("book").agg(F.sum(F.col("last") - F.col("first") + 1).alias("_n"), F.min("first").alias("_a"), F.max("last").alias("_b"), F.count_distinct("first").alias("_k"), F.count(F.lit(1)).alias("_m"))
    after = chunks.select("book", (F.col("last") + 1).alias("first")).join(chunks.select("book", "first"), ["book", "first"]).groupBy("book").agg(F.count(F.lit(1)).alias("_joins"))
    j = books.join(sums, "book", "left").join(after, "book", "left")
    proof = (F.col("_n") == F.col("last") - F.col("first") + 1) & (F.col("_a") == F.col("first")) & (F.col("_b") == F.col("last")) & (F.col("_k") == F.col("_m")) & (F.coalesce("_joins", F.lit(0)) == F.col("_m") - 1)
    return j.select("book", F.coalesce(proof, F.lit(False)).alias("proved"))


# --- range join -----------------------------------------------------------------------------

#: Cells of the coarsest level that cover all points; a cell with more than one in ``HOT`` rows is split.
TOP_CELLS, HOT = 1024, 1000


def range_pairs(ranges: DataFrame, points: DataFrame, low: str, high: str, value: str, group: str | None = None) -> DataFrame:
    """Each range (``low`` to ``high``, integers, both included) with each point whose ``value`` it holds: the columns of both.

    A range is cut to dyadic cells, at most two a level and some of the coarsest; a point lies in one cell a level, and
    is looked up at the levels that occur. Cells of a range don't overlap, so a pair is found once. The coarsest cells are a
    ``TOP_CELLS``-th of all points' span, so a wide range is many keys. Cells with very many points are dealt to parts by hash,
    and ranges that have them are repeated for each part. ``group``, a column of both, must be equal too.
    Ranges with a null end or ``low > high`` and points without a value join nothing.
    """
    on = [group] if group else []
    found = points.where(F.col(value).isNotNull()).withColumn("_v", F.col(value).cast("long"))
    n, least, most = found.agg(F.count(F.lit(1)), F.min("_v"), F.max("_v")).first()
    least, most = least or 0, most or 0
    top = max(0, ((most - least) // TOP_CELLS).bit_length())
    cut = ranges.where(f"`{low}` IS NOT NULL AND `{high}` IS NOT NULL").withColumn("_a", F.greatest(F.col(low).cast("long"), F.lit(least)) - least).withColumn("_b", F.least(F.col(high).cast("long"), F.lit(most)) - least + 1).where("_a < _b")
    # At a level, what is left of the range is the cells from a to b; its odd ends are no whole cell of the next.
    at = cut.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(top))))
    a, b = F.expr("-shiftright(-_a, _level)"), F.expr("shiftright(_b, _level)")
    ends = F.array_compact(F.array(F.when((a < b) & (a % 2 == 1), a), F.when((a < b) & (b % 2 == 1), b - 1)))
    cells = F.when(F.col("_level") == top, F.when(a < b, F.sequence(a, b - 1)).otherwise(F.array().cast("array<bigint>"))).otherwise(ends)
    cells = materialize(at.withColumn("_cell", F.explode(cells)).drop("_a", "_b"), "range-cells")
    levels = [r[0] for r in cells.select("_level").distinct().collect()]
    looked = found.withColumn("_level", F.explode(F.array(*[F.lit(x) for x in levels]))) if levels else found.withColumn("_level", F.lit(0)).limit(0)
    looked = looked.withColumn("_cell", F.expr(f"shiftright(_v - {least}, _level)")).drop("_v")
    keys = [*on, "_level", "_cell"]
    hot = looked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max(HOT, n // HOT))
    hot = materialize(hot.withColumn("_parts", F.expr(f"cast(_n div {max(HOT, n // HOT)} as int) + 1")).drop("_n"), "hot-cells")
    parts = F.coalesce("_parts", F.lit(1))
    looked = looked.join(F.broadcast(hot), keys, "left").withColumn("_part", F.pmod(F.xxhash64(*points.columns), parts)).drop("_parts")
    cells = cells.join(F.broadcast(hot), keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), (parts - 1).cast("long")))).drop("_parts")
    return cells.join(looked, [*keys, "_part"]).drop("_level", "_cell", "_part")
