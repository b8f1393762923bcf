"""Exact top-k search without random access.

Every block of rows has, per dimension, a list of its rows sorted by their component. A query reads the lists
of its non-zero dimensions side by side, a batch of entries at a time, each from the end that adds most to its
score. It keeps for every row the sum of what it has been seen with and the lists it has not been seen in; the
row's score lies between that sum plus the least entry, and plus the last entry read, of those lists. A row
whose upper bound falls under the k-th best lower bound is out for good. Reading stops when few rows are left;
only their scores are resolved.

A block is read in pieces, each with its own lists: the k-th best score that a query has from the pieces before
is a bound for the next one too, under which rows are out long before lower bounds come together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import groups_for, is_finite_vector, table
from .forest import _matrix

BEST = 10
SCALE = 1024
#: Queries and rows that one task compares.
QUERIES, ROWS = 4096, 8192
#: Rows of a piece, and entries of each of its lists read between two looks at the bounds.
PIECE = 2048
BATCH = 512
#: Reading stops when a query has one row in so many left, or four times as many as it asks for.
FEW = 16


class Lists:
    """Rows as sorted lists: for each dimension row numbers and components, rising (a list is a line of both)."""

    def __init__(self, x: np.ndarray):
        self.x = x
        columns = np.ascontiguousarray(x.T)
        self.rows = np.argsort(columns, axis=1, kind="stable")
        self.values = np.take_along_axis(columns, self.rows, axis=1)
        #: the cell of each entry in a table of dimensions by rows
        self.cells = self.rows + np.arange(len(columns))[:, None] * len(x)

    def read(self, q: np.ndarray, start: int, end: int, dims: np.ndarray, falling: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row numbers, cells and contributions of entries ``start`` to ``end`` of some lists (lists by entries, the last one read last or, falling, first)."""
        n = len(self.x)
        part = slice(n - end, n - start) if falling else slice(start, end)
        return self.rows[dims, part], self.cells[dims, part], self.values[dims, part] * q[dims, None]


def candidates(lists: Lists, q: np.ndarray, k: int, own: np.ndarray, batch: int = BATCH, floor: float = -np.inf) -> tuple[np.ndarray, int]:
    """Rows that may be among the ``k`` best of a query (all of these among them), and how many entries of each list were read.

    ``own``: rows that are not to be found. Rows whose score is under ``floor`` are not asked for.
    """
    n = len(lists.x)
    alive = np.setdiff1d(np.arange(n), own)
    sides = [(d, falling) for d, falling in ((np.flatnonzero(q < 0), False), (np.flatnonzero(q > 0), True)) if len(d)]
    if not sides:
        return alive, 0
    ends = np.zeros((2, len(q)))  # what a list's least and last entry add
    for d, falling in sides:
        ends[0, d] = lists.read(q, n - 1, n, d, falling)[2][:, 0]
    total = np.zeros(n)
    unseen = np.ones((len(q), n))
    depth = 0
    while depth < n and len(alive) > max(4 * k, n // FEW):
        end = min(n, depth + batch)
        for d, falling in sides:
            rows, cells, gain = lists.read(q, depth, end, d, falling)
            total += np.bincount(rows.ravel(), weights=gain.ravel(), minlength=n)
            unseen.reshape(-1)[cells] = 0
            ends[1, d] = gain[:, 0 if falling else -1]
        depth = end
        rest = ends @ unseen
        lower, upper = (total + rest)[:, alive]
        if len(alive) > k:
            floor = max(floor, np.partition(lower, len(lower) - k)[len(lower) - k])
        alive = alive[upper >= floor]
    return alive, depth


def best_rows(lists: Lists, ids: np.ndarray, q: np.ndarray, own: np.ndarray, k: int, batch: int = BATCH,
              floors: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the k best rows of each query, ties by id; a row with the query's ``own`` id is left out.

    With ``floors``, rows under a query's floor may be missing.
    """
    at, row, score = [], [], []
    for i in range(len(q)):
        few, _ = candidates(lists, q[i], k, np.flatnonzero(ids == own[i]), batch, -np.inf if floors is None else floors[i])
        s = np.einsum("ij,j->i", lists.x[few], q[i])
        order = np.lexsort((ids[few], -s))[:k]
        at.append(np.full(len(order), i))
        row.append(few[order])
        score.append(s[order])
    return tuple(np.concatenate(v) if v else np.zeros(0, np.int64) for v in (at, row, score))


def best_of_pieces(x: np.ndarray, ids: np.ndarray, q: np.ndarray, own: np.ndarray, k: int, piece: int = PIECE, batch: int = BATCH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``best_rows`` of rows that are read in pieces, by query; the k-th best score so far is the next piece's floor."""
    best, floors = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)), np.full(len(q), -np.inf)
    for start in range(0, len(x), piece):
        part = slice(start, start + piece)
        at, row, score = best_rows(Lists(x[part]), ids[part], q, own, k, batch, floors)
        at, row, score = np.concatenate([best[0], at]), np.concatenate([best[1], row + start]), np.concatenate([best[2], score])
        order = np.lexsort((ids[row], -score, at))
        at, row, score = at[order], row[order], score[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        best = at[place < k], row[place < k], score[place < k]
        floors[at[place == k - 1]] = score[place == k - 1]
    return best


def top(df: DataFrame, is_query: Column, k: int = BEST, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest integer inner products of floor(scale * x) for every query.

    Rows without an id, and vectors that are null, empty, or hold a null or non-finite component take
    no part; vectors are compared with those of the same length. Of rows with one id the least vector
    counts. Scores are exact as long as they stay below 2**53.

    Rows and queries are dealt to blocks; each pair of blocks is a task and returns k rows a query. The queries,
    the smaller side, go to every block of rows; rows are copied once per 4,096 queries. Other columns play no
    part, whatever their names.
    """
    v = F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    good = df.where(F.col(key).isNotNull() & is_finite_vector(vector)).select(F.col(key).cast("long").alias("id"), v.alias("v"), is_query.alias("asks"))
    rows = good.groupBy("id").agg(F.min("v").alias("v"), F.max("asks").alias("asks")).withColumn("d", F.size("v"))
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q")).first()
    shards, blocks = groups_for(n["n"], ROWS), groups_for(n["q"], QUERIES)
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    have = rows.select("id", "v", "d", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), every(blocks).alias("block"))
    asked = rows.where("asks").select("id", "v", "d", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"), every(shards).alias("shard"))

    def read(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        x, q = _matrix(left.column("v")), _matrix(right.column("v"))
        ids, own = left.column("id").to_numpy(), right.column("id").to_numpy()
        at, row, score = best_of_pieces(x, ids, q, own, k)
        return pa.table({"query_id": own[at], "vec_id": ids[row], "score": score.astype(np.int64)})

    part = (have.groupBy("d", "block", "shard").cogroup(asked.groupBy("d", "block", "shard"))
            .applyInArrow(read, "query_id long, vec_id long, score long"))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return part.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    """op8: the 10 highest scores of every 100th embedding."""
    return top(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM pairs QUALIFY rank <= 10
"""
