"""Positions carried through edits: what points into a text still points to the same words when the text has been rewritten.

A map is the list of stretches that both versions have, ascending in both: ``(old, new, length)``. It is read off the two
texts, so any rewrite leaves one, and maps of rewrites one after the other compose. A position inside a stretch is carried exactly; one
in words that went or changed goes to where they stood, and is told apart.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.review import places_within, word_edits

_PIECE = re.compile(r"\w+|\s|[^\w\s]")

#: One stretch: where it begins in the old text and in the new one, and its length.
Stretch = tuple[int, int, int]


def position_map(before: str, after: str) -> list[Stretch]:
    """The stretches of words, blanks and marks that a longest common subsequence keeps."""
    a, b = _PIECE.findall(before), _PIECE.findall(after)
    if (places := places_within(a, b)) is not None:
        return _stretches(np.arange(len(a)), np.array(places, np.int64), a, b)
    if (places := places_within(b, a)) is not None:
        return _stretches(np.array(places, np.int64), np.arange(len(b)), a, b)
    out: list[Stretch] = []
    old = new = 0
    for kind, piece in word_edits(a, b):
        n = len(piece)
        if kind == "=":
            if out and out[-1][0] + out[-1][2] == old and out[-1][1] + out[-1][2] == new:
                out[-1] = (*out[-1][:2], out[-1][2] + n)
            else:
                out.append((old, new, n))
        old += n if kind != "+" else 0
        new += n if kind != "-" else 0
    return out


def _stretches(i: np.ndarray, j: np.ndarray, a: list[str], b: list[str]) -> list[Stretch]:
    """Neighbouring pieces of ``a`` and ``b`` that are paired, as stretches."""
    if not len(i):
        return []
    old, new = (np.cumsum([0, *map(len, pieces)]) for pieces in (a, b))
    first = np.flatnonzero(np.append(True, (np.diff(i) != 1) | (np.diff(j) != 1)))
    last = np.append(first[1:], len(i)) - 1
    return list(zip(old[i[first]].tolist(), new[j[first]].tolist(), (old[i[last] + 1] - old[i[first]]).tolist(), strict=True))


def carry(at: int, stretches: list[Stretch], end: int) -> tuple[int, bool]:
    """Where a position goes, and whether what stood there still does; ``end`` is the new text's length."""
    k = bisect_right(stretches, at, key=lambda s: s[0]) - 1
    if k >= 0 and at < stretches[k][0] + stretches[k][2]:
        return stretches[k][1] + at - stretches[k][0], True
    return (stretches[k + 1][1] if k + 1 < len(stretches) else end), False


def composed(first: list[Stretch], second: list[Stretch]) -> list[Stretch]:
    """The map of one rewrite after another."""
    out, j = [], 0
    for old, mid, n in first:
        while j and second[j - 1][0] + second[j - 1][2] > mid:
            j -= 1
        while j < len(second) and second[j][0] < mid + n:
            a, b = max(mid, second[j][0]), min(mid + n, second[j][0] + second[j][2])
            if a < b:
                out.append((old + a - mid, second[j][1] + a - second[j][0], b - a))
            j += 1
    return out


def carried(texts: DataFrame, anchors: DataFrame, key: str, steps: list[str], at: str = "at") -> DataFrame:
    """``key, at, to, exact``: positions in the first of the text columns ``steps``, carried to the last one, step by step.

    ``anchors`` has ``key, at`` (from 0). Anchors without a text, and null positions, are left out; a text is one row, so are its distinct anchors.
    """
    kind = dict(texts.dtypes)[key]
    spots = anchors.where(F.col(at).isNotNull()).groupBy(F.col(key).alias("_of")).agg(F.array_sort(F.collect_set(F.col(at).cast("long"))).alias("_spots"))
    both = texts.select(key, *steps).join(spots, F.col(key) == F.col("_of")).select(key, "_spots", *steps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                versions = [batch.column(2 + n)[k].as_py() or "" for n in range(len(steps))]
                whole = position_map(versions[0], versions[1]) if len(versions) > 1 else [(0, 0, len(versions[0]))]
                for a, b in zip(versions[1:], versions[2:], strict=False):
                    whole = composed(whole, position_map(a, b))
                places = batch.column(1)[k].as_py()
                found = [carry(p, whole, len(versions[-1])) for p in places]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([k] * len(places), pa.int64())), pa.array(places, pa.int64()), pa.array([t for t, _ in found], pa.int64()), pa.array([e for _, e in found], pa.bool_())], names=[key, "at", "to", "exact"])

    return both.mapInArrow(run, f"`{key}` {kind}, at long, to long, exact boolean")
