"""Ordered folds: the rows of one group, in order, through a plain function; linear in their number."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def folded(df: DataFrame, group: str, columns: list[str], fold: Callable[[list[tuple]], Iterable[tuple]], schema: str) -> DataFrame:
    """``group`` and the columns of ``schema``: what ``fold`` makes of a group's rows, ascending by ``columns``.

    A group (a document, a page) is one array; groups run in parallel.
    """
    kind = df.schema[group].dataType.simpleString()
    rows = df.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("rows"))
    out = StructType.fromDDL(schema)
    made = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                found = list(fold([tuple(r.values()) for r in batch.column(1)[k].as_py()]))
                values = list(zip(*found, strict=True)) if found else [()] * len(made)
                arrays = [pa.array(v, f.type) for v, f in zip(values, made, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([k] * len(found), pa.int64())), *arrays], names=[group, *made.names])

    return rows.mapInArrow(run, f"`{group}` {kind}, {schema}")


def clusters(tolerance: float) -> Callable[[list[tuple]], Iterator[tuple]]:
    """Ascending values ``(v,)`` to ``(cluster, mean, n)`` by running mean, closer than ``tolerance``."""

    def fold(rows: list[tuple]) -> Iterator[tuple]:
        total, n, k = 0.0, 0, 0
        for (v,) in rows:
            if n and abs(total / n - v) < tolerance:
                total, n = total + v, n + 1
            else:
                if n:
                    yield k, round(total / n, 6), n
                total, n, k = v, 1, k + 1
        if n:
            yield k, round(total / n, 6), n

    return fold


def spans(most: int) -> Callable[[list[tuple]], Iterator[tuple]]:
    """Rows ``(order, size)`` merged while their sizes sum to at most ``most``: ``(span, first, last, total)``."""

    def fold(rows: list[tuple]) -> Iterator[tuple]:
        k, now = 0, None
        for o, size in rows:
            if now and now[2] + size <= most:
                now = (now[0], o, now[2] + size)
            else:
                if now:
                    yield (k, *now)
                k, now = k + 1, (o, o, size)
        if now:
            yield (k, *now)

    return fold


def parents(rows: list[tuple]) -> Iterator[tuple]:
    """Rows ``(order, level)`` to ``(order, parent)``: the nearest earlier row of a smaller level."""
    open_: list[tuple] = []
    for o, level in rows:
        while open_ and open_[-1][1] >= level:
            open_.pop()
        yield o, open_[-1][0] if open_ else None
        open_.append((o, level))


def next_greater(rows: list[tuple]) -> Iterator[tuple]:
    """Rows ``(order, value)`` to ``(order, value, next)``: the first later value that is greater."""
    out, open_ = [], []
    for o, v in reversed(rows):
        while open_ and open_[-1] <= v:
            open_.pop()
        out.append((o, v, open_[-1] if open_ else None))
        open_.append(v)
    yield from reversed(out)


def y_lines(tolerance: float) -> Callable[[list[tuple]], Iterator[tuple]]:
    """Glyphs ``(ord, x, y, w, text)`` to lines ``(line, y, x0, x1, text)``: a glyph joins the first line near its y.

    Lines are told apart by buckets of y, so a glyph looks at the few lines near it.
    """

    def fold(rows: list[tuple]) -> Iterator[tuple]:
        lines: list[list] = []
        near: dict[int, list[int]] = {}
        for _, x, y, w, text in rows:
            cell = int(y // tolerance)
            hits = [k for c in (cell - 1, cell, cell + 1) for k in near.get(c, ()) if abs(lines[k][0] - y) <= tolerance]
            if hits:
                line = lines[min(hits)]
                line[1], line[2] = min(line[1], x), max(line[2], x + w)
                line[3].append(text or "")
            else:
                near.setdefault(cell, []).append(len(lines))
                lines.append([y, x, x + w, [text or ""]])
        for k, (y, x0, x1, parts) in enumerate(lines):
            yield k, y, x0, x1, "".join(parts)

    return fold


def carried_titles(rows: list[tuple]) -> Iterator[tuple]:
    """Contents lines ``(line, x0, text, number)`` to entries ``(first, last, x0, title, number)``.

    A line without a dotted leader or a number is the first half of a title that wrapped.
    """
    carry = None
    for line, x0, text, number in rows:
        if "..." not in text and number is None and carry is None:
            carry = (line, x0, text)
            continue
        first, left, before = carry or (line, x0, "")
        carry = None
        title = (before + text).rstrip(" .\t\n").strip()
        if title:
            yield first, line, left, title, number
    if carry and carry[2].strip():
        yield carry[0], carry[0], carry[1], carry[2].strip(), None


class Free:
    """Places still free, by page: the nearest to a wanted page, each used once; ties by order."""

    def __init__(self, places: list[tuple[int, int]]) -> None:
        self.by_page: list[tuple[int, int]] = []
        for order, page in places:
            insort(self.by_page, (page, order))

    def take(self, want: int | None, reach: int | None = None) -> tuple[int, int] | None:
        """``(page, order)``; without a wish the first in order. Nothing if the nearest is more than ``reach`` pages off."""
        if not self.by_page:
            return None
        if want is None:
            best = min(self.by_page, key=lambda p: p[1])
        else:
            at = bisect_left(self.by_page, (want, -1))
            near = self.by_page[at : at + 1]
            if at:
                below = self.by_page[at - 1][0]
                near.append(self.by_page[bisect_left(self.by_page, (below, -1))])
            best = min(near, key=lambda p: (abs(p[0] - want), p[1]))
            if reach is not None and abs(best[0] - want) > reach:
                return None
        self.by_page.pop(bisect_left(self.by_page, best))
        return best
