"""Approximate nearest neighbours by cosine: a vantage-point tree for each shard of the vectors.

Every row is dealt to a shard by the hash of its row number, so shards are of one size whatever the
vectors are: a vector that a third of all rows hold is spread over all shards. A shard's task builds
its tree: a node keeps a vantage point and the least and greatest distance to it in its inner and its
outer half. The halves are cut by position, so equal distances need no special case. Distances are
those of unit vectors, ``sqrt(2 - 2 cos)``, for which the triangle inequality holds.

Queries come in blocks, each with its nearest rows among ``SEED_ROWS`` seeds, chosen by hash, as a
first radius. A task takes one shard and one block. A subtree whose distance to a query must be at
least ``gap`` is left out if ``factor * gap`` exceeds the radius. With factor one that is the triangle
inequality and the search is exact; a larger factor leaves out more. Leaves are then read in the order
of their gaps, in growing steps, and the radius shrinks between steps.

Scores are computed on the original vectors in double precision, each pair alone and in one order of
summation, so equal vectors have equal scores and ties go to the smaller id.

Edge cases: rows without an id, and vectors null, empty, all zero or holding null or non-finite
components, take no part; shorter vectors count as filled up with zeros; rows that repeat an id or a vector
are rows of their own (a repeated query is answered for each row, and its twin is a neighbour like any other);
with fewer than ``k`` candidates all are returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import materialize

#: Rows of a shard and of a block of queries, on average; rows of a leaf at most.
SHARD_ROWS, BLOCK_ROWS, LEAF_ROWS = 4096, 1024, 32
#: Rows that give every query its first radius. The index holds all rows, these too.
SEED_ROWS = 1024
#: How far pruning is relaxed.
FACTOR = 4.0
#: More than the rounding errors of a distance.
SLACK = 1e-7
#: Vantage points that a node tries, and rows that it tries them on.
TRIED, TRIED_ON = 6, 64


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows of doubles, each scaled by a power of two to a largest component of about one."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    out = np.zeros((len(column), dim))
    if len(column):
        sizes = column.value_lengths().to_numpy(zero_copy_only=False)
        values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
        row = np.repeat(np.arange(len(column)), sizes)
        out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
        out = np.ldexp(out, -np.frexp(np.abs(out).max(axis=1))[1][:, None])
    return out


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


# --- the tree ---------------------------------------------------------------------------------


class Tree:
    """Points in the order of the leaves; ``nodes`` holds start, end, vantage, left and right (-1: a leaf), ``bounds`` the distances."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, points: np.ndarray, nodes: np.ndarray, bounds: np.ndarray) -> None:
        self.ids, self.rows, self.points, self.nodes, self.bounds = ids, rows, points, nodes, bounds
        self.norms = norms(points)
        self.units = points / self.norms[:, None]

    @classmethod
    def build(cls, ids: np.ndarray, rows: np.ndarray, points: np.ndarray, leaf: int = LEAF_ROWS) -> Tree:
        units = points / norms(points)[:, None]
        order, nodes, bounds, open_nodes = np.arange(len(points)), [[0, len(points), -1, -1, -1]], [[0.0] * 4], [0]
        while open_nodes:
            at = open_nodes.pop()
            a, b = nodes[at][:2]
            if b - a <= leaf:
                continue
            own = units[order[a:b]]
            tried = np.linspace(0, b - a - 1, TRIED).astype(int)
            on = own[np.linspace(0, b - a - 1, min(TRIED_ON, b - a)).astype(int)]
            vantage = tried[distance(on @ own[tried].T).std(axis=0).argmax()]
            d, point = distance(own @ own[vantage]), order[a + vantage]
            by = np.argsort(d, kind="stable")
            order[a:b], d, half = order[a:b][by], d[by], (b - a) // 2
            nodes[at][2:] = [point, len(nodes), len(nodes) + 1]
            bounds[at] = [d[0], d[half - 1], d[half], d[-1]]
            open_nodes += [len(nodes), len(nodes) + 1]
            nodes += [[a, a + half, -1, -1, -1], [a + half, b, -1, -1, -1]]
            bounds += [[0.0] * 4, [0.0] * 4]
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        table = np.array(nodes)
        inner = table[:, 3] >= 0
        table[inner, 2] = place[table[inner, 2]]
        return cls(ids[order], rows[order], points[order], table, np.array(bounds))

    def gaps(self, units: np.ndarray, radius: np.ndarray, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """The leaves, and each query's least distance to each (infinite where pruned)."""
        leaves = np.flatnonzero(self.nodes[:, 3] < 0)
        column = {leaf: k for k, leaf in enumerate(leaves)}
        out = np.full((len(units), len(leaves)), np.inf)
        todo = [(0, np.arange(len(units)), np.zeros(len(units)))]
        while todo:
            at, active, gap = todo.pop()
            _, _, vantage, left, right = self.nodes[at]
            if left < 0:
                out[active, column[at]] = gap
                continue
            d = distance(units[active] @ self.units[vantage])
            low_in, high_in, low_out, high_out = self.bounds[at]
            for child, low, high in ((left, low_in, high_in), (right, low_out, high_out)):
                least = np.maximum(gap, np.maximum(low - d, d - high))
                near = factor * least <= radius[active] + SLACK
                if near.any():
                    todo.append((child, active[near], least[near]))
        return leaves, out


class Nearest:
    """The ``k`` best rows of each query so far: score descending, then id, then row."""

    def __init__(self, points: np.ndarray, rows: np.ndarray, k: int) -> None:
        self.points, self.rows, self.k = points, rows, k
        self.norms = norms(points)
        self.units = points / self.norms[:, None]
        shape = (len(points), k)
        self.score, self.id, self.row, self.new = np.full(shape, -np.inf), np.zeros(shape, np.int64), np.full(shape, -1), np.zeros(shape, bool)

    def radius(self) -> np.ndarray:
        worst = self.score[:, -1]
        return np.where(np.isfinite(worst), distance(np.where(np.isfinite(worst), worst, 0.0)), np.inf)

    def add(self, of: np.ndarray, units: np.ndarray, points: np.ndarray, sizes: np.ndarray, ids: np.ndarray, rows: np.ndarray, new: bool) -> None:
        """Offers rows to the queries ``of``: those about as good as the worst kept are scored exactly and merged."""
        about = self.units[of] @ units.T
        q, j = np.nonzero((about >= self.score[of, -1][:, None] - 1e-9) & (rows[None, :] != self.rows[of][:, None]))
        if not len(q):
            return
        score = (self.points[of[q]] * points[j]).sum(axis=1) / (self.norms[of[q]] * sizes[j])
        some = np.unique(q)
        back = np.searchsorted(some, q)
        old = of[some]
        who = np.concatenate([np.repeat(np.arange(len(some)), self.k), back])
        score = np.concatenate([self.score[old].ravel(), np.clip(score, -1.0, 1.0)])
        which, row = np.concatenate([self.id[old].ravel(), ids[j]]), np.concatenate([self.row[old].ravel(), rows[j]])
        fresh = np.concatenate([self.new[old].ravel(), np.full(len(q), new)])
        by = np.lexsort((fresh, row, which, -score, who))
        who, score, which, row, fresh = who[by], score[by], which[by], row[by], fresh[by]
        again = np.zeros(len(by), bool)  # a seed that its shard meets again
        again[1:] = (who[1:] == who[:-1]) & (row[1:] == row[:-1]) & (row[1:] >= 0)
        who, score, which, row, fresh = (x[~again] for x in (who, score, which, row, fresh))
        rank = np.arange(len(who)) - np.searchsorted(who, who)
        best = rank < self.k
        at = (old[who[best]], rank[best])
        self.score[at], self.id[at], self.row[at], self.new[at] = score[best], which[best], row[best], fresh[best]


def search(tree: Tree, found: Nearest, factor: float) -> None:
    """Offers the rows of a tree to the queries in ``found``."""
    leaves, gaps = tree.gaps(found.units, found.radius(), factor)
    order = np.argsort(gaps, axis=1, kind="stable")
    begin, step = 0, 1
    while begin < len(leaves):
        turn = order[:, begin : begin + step]
        near = factor * np.take_along_axis(gaps, turn, 1) <= found.radius()[:, None] + SLACK
        near &= np.isfinite(np.take_along_axis(gaps, turn, 1))
        if not near.any():
            break
        q, c = np.nonzero(near)
        leaf = turn[q, c]
        by = np.argsort(leaf, kind="stable")
        q, leaf = q[by], leaf[by]
        cuts = np.flatnonzero(np.diff(leaf)) + 1
        for of, k in zip(np.split(q, cuts), leaf[np.concatenate([[0], cuts])], strict=True):
            a, b = tree.nodes[leaves[k], :2]
            found.add(of, tree.units[a:b], tree.points[a:b], tree.norms[a:b], tree.ids[a:b], tree.rows[a:b], True)
        begin, step = begin + step, 2 * step


# --- shards and blocks ------------------------------------------------------------------------

_TREE = pa.schema([("shard", pa.int64())] + [(x, pa.binary()) for x in ("ids", "rows", "points", "nodes", "bounds")])
_BLOCK = pa.schema([("block", pa.int64())] + [(x, pa.binary()) for x in ("q_ids", "q_rows", "q_points", "scores", "near_ids", "near_rows")])
_HITS = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()), ("score", pa.float64())])
_TREE_DDL = "shard long, ids binary, rows binary, points binary, nodes binary, bounds binary"
_BLOCK_DDL = "block long, q_ids binary, q_rows binary, q_points binary, scores binary, near_ids binary, near_rows binary"
_HITS_DDL = "query_row long, query_id long, vec_id long, row long, score double"


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table[name].combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)


def build_index(rows: DataFrame, count: int, dim: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A tree for each shard of ``rows (row, id, vector)``; the table grows with the rows, a tree doesn't."""

    def build(table: pa.Table) -> pa.Table:
        tree = Tree.build(_numbers(table, "id"), _numbers(table, "row"), matrix(table["vector"], dim))
        own = [tree.ids, tree.rows, tree.points, tree.nodes.astype(np.int64), tree.bounds]
        return pa.table([[table["shard"][0].as_py()], *[[x.tobytes()] for x in own]], schema=_TREE)

    shard = F.pmod(F.xxhash64("row"), F.lit(-(-count // shard_rows)))
    return materialize(rows.withColumn("shard", shard).groupBy("shard").applyInArrow(build, _TREE_DDL), "vp-trees")


def _blocks(queries: DataFrame, n_blocks: int, dim: int, seeds: pa.Table, k: int) -> DataFrame:
    """Queries packed in blocks, each with its nearest seeds."""

    def pack(table: pa.Table) -> pa.Table:
        found = Nearest(matrix(table["vector"], dim), _numbers(table, "row"), k)
        points = matrix(seeds["vector"], dim)
        size = norms(points)
        found.add(np.arange(len(found.rows)), points / size[:, None], points, size, _numbers(seeds, "id"), _numbers(seeds, "row"), False)
        own = [_numbers(table, "id"), found.rows, found.points, found.score, found.id, found.row]
        return pa.table([[table["block"][0].as_py()], *[[x.tobytes()] for x in own]], schema=_BLOCK)

    block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(n_blocks))
    return queries.withColumn("block", block).groupBy("block").applyInArrow(pack, _BLOCK_DDL)


def _meet(dim: int, k: int, factor: float):
    """One shard's tree against one block: the shard's rows found, and with shard 0 the seeds that stayed."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return _HITS.empty_table()
        take = lambda table, name, kind, width=1: np.frombuffer(table[name][0].as_py(), kind).reshape(-1, width) if width > 1 else np.frombuffer(table[name][0].as_py(), kind)
        points = take(left, "points", np.float64).reshape(-1, dim)
        tree = Tree(take(left, "ids", np.int64), take(left, "rows", np.int64), points, take(left, "nodes", np.int64, 5), take(left, "bounds", np.float64, 4))
        found = Nearest(take(right, "q_points", np.float64).reshape(-1, dim), take(right, "q_rows", np.int64), k)
        found.score, found.id, found.row = (take(right, name, kind).reshape(-1, k).copy() for name, kind in (("scores", np.float64), ("near_ids", np.int64), ("near_rows", np.int64)))
        search(tree, found, factor)
        q, j = np.nonzero((found.row >= 0) & (found.new | (left["shard"][0].as_py() == 0)))
        return pa.table([found.rows[q], take(right, "q_ids", np.int64)[q], found.id[q, j], found.row[q, j], found.score[q, j]], schema=_HITS)

    return run


def nearest_neighbours(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50, k: int = 5, factor: float = FACTOR, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS, seed_rows: int = SEED_ROWS
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose id is divisible by ``every``, against all rows."""
    rows = vectors.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
    rows = rows.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    rows = materialize(rows, "vp-rows")
    asked = F.col("id") % every == 0
    count, n_queries, dim = rows.agg(F.count(F.lit(1)), F.count_if(asked), F.coalesce(F.max(F.size("vector")), F.lit(1))).first()
    seeds = rows.orderBy(F.xxhash64("row", F.lit(2)), "row").limit(seed_rows).toArrow()
    n_blocks, n_shards = max(1, -(-n_queries // block_rows)), max(1, -(-count // shard_rows))
    index = build_index(rows, max(1, count), dim, shard_rows).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    blocks = _blocks(rows.where(asked), n_blocks, dim, seeds, k).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long"))))
    hits = index.groupBy("shard", "block").cogroup(blocks.groupBy("shard", "block")).applyInArrow(_meet(dim, k, factor), _HITS_DDL)
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
