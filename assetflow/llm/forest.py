"""Approximate nearest neighbours by a forest of random-projection trees.

Each tree halves a bounded sample again and again at the median along the difference of two
of its vectors. Every vector is routed to one leaf of every tree. A query enters the roots of
all trees into one priority queue, ordered by the least margin by which its path strayed to the
far side; the leaves the queue yields first, whatever their tree, are its candidates, which are
ranked by their exact inner product in double precision.

A path's priority never rises on the way down, so the queue yields leaves in the order of
their priorities; these are worked out for a block of queries at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import is_finite_vector, stored, table

NEAREST = 20
TREES = 12
#: Vectors the trees are built on, at most: those with the smallest hash of their id.
SAMPLE = 20_000
#: Sample vectors in a leaf, at most.
LEAF = 100
#: Share of all leaves that a query visits, and the least number for each tree.
VISITED = 0.08
LEAST_VISITED = 6
#: Products of a leaf's rows and its queries worked out at a time; the k best of each such block stay.
CELLS = 4 << 20
#: Bytes of the vectors in a slice of a tree's leaves, about: what one task compares.
SLICE = 32 << 20


class Tree:
    """A tree as arrays: inner nodes have a normal, a threshold and two children; child -k-1 is leaf k."""

    def __init__(self, x: np.ndarray, rng: np.random.Generator, leaf: int):
        self.normal, self.threshold, self.child, self.sizes = [], [], [], []
        root = self._grow(x, np.arange(len(x)), rng, leaf)
        d = x.shape[1]
        self.root = root
        self.normal = np.array(self.normal).reshape(-1, d)
        self.threshold, self.child = np.array(self.threshold), np.array(self.child, np.int64).reshape(-1, 2)
        self.leaves = len(self.sizes)

    def _grow(self, x, rows, rng, leaf) -> int:
        if len(rows) > leaf:
            for _ in range(3):
                i, j = rng.choice(len(rows), 2, replace=False)
                w = x[rows[i]] - x[rows[j]]
                size = np.sqrt((w * w).sum())
                if not (np.isfinite(size) and size > 0):
                    continue
                w = w / size
                at = np.einsum("ij,j->i", x[rows], w)
                cut = float(np.median(at))
                low = at < cut
                if low.any() and not low.all():
                    node = len(self.normal)
                    self.normal.append(w)
                    self.threshold.append(cut)
                    self.child.append([0, 0])
                    kids = [self._grow(x, rows[low], rng, leaf), self._grow(x, rows[~low], rng, leaf)]
                    self.child[node] = kids
                    return node
        self.sizes.append(len(rows))
        return -len(self.sizes)

    def route(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        node = np.full(len(x), self.root)
        while True:
            at = np.flatnonzero(node >= 0)
            if not len(at):
                return -node - 1
            inner = node[at]
            side = np.einsum("ij,ij->i", x[at], self.normal[inner]) >= self.threshold[inner]
            node[at] = self.child[inner, side.astype(int)]

    def priorities(self, x: np.ndarray) -> np.ndarray:
        """Rows by leaves: the least margin on the path to the leaf (negative: on the far side)."""
        out = np.empty((len(x), self.leaves))
        margin = np.einsum("ij,kj->ik", x, self.normal) - self.threshold if len(self.normal) else None
        todo = [(self.root, np.full(len(x), np.inf))]
        while todo:
            node, least = todo.pop()
            if node < 0:
                out[:, -node - 1] = least
            else:
                todo.append((self.child[node, 0], np.minimum(least, -margin[:, node])))
                todo.append((self.child[node, 1], np.minimum(least, margin[:, node])))
        return out


def _matrix(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1)


def build(vectors: DataFrame, trees: int = TREES, sample: int = SAMPLE, leaf: int = LEAF) -> list[Tree]:
    """Trees over at most ``sample`` of the vectors (id, v); each tree is grown in a task of its own."""
    import pickle

    few = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).select("id", "v")
    rows = few.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))

    def grow(t: pa.Table) -> pa.Table:
        t = t.sort_by("id")
        k = t.column("tree")[0].as_py()
        tree = Tree(_matrix(t.column("v")), np.random.default_rng(977 * k + 1), leaf)
        return pa.table({"tree": pa.array([k], pa.int32()), "blob": pa.array([pickle.dumps(tree)], pa.binary())})

    got = rows.groupBy("tree").applyInArrow(grow, "tree int, blob binary").collect()
    return [pickle.loads(r["blob"]) for r in sorted(got, key=lambda r: r["tree"])]


def search(vectors: DataFrame, queries: DataFrame, k: int, forest: list[Tree], rows: int, dimension: int, visited: float = VISITED,
           least_visited: int = LEAST_VISITED, slice_bytes: int = SLICE) -> DataFrame:
    """(query, id, score): for each query (id, v) at least its ``k`` best candidates among vectors (id, v), ties included.

    Both sides have distinct ids and vectors of one length; a query finds itself too.
    """
    held = vectors.sparkSession.sparkContext.broadcast(forest)
    parts = max(1, math.ceil(rows * 8 * (dimension or 1) / slice_bytes))
    total = sum(t.leaves for t in forest)
    probes = min(total, max(least_visited * len(forest), math.ceil(visited * total)))

    def slice_of(tree: int, leaf: np.ndarray) -> np.ndarray:
        """Neighbouring leaves share a slice."""
        return tree * parts + leaf * parts // held.value[tree].leaves

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column("v"))
                for j, tree in enumerate(held.value):
                    leaf = tree.route(x)
                    yield pa.RecordBatch.from_arrays([pa.array(slice_of(j, leaf), pa.int32()), pa.array(leaf, pa.int32()), b.column("id"), b.column("v")],
                                                     ["slice", "leaf", "id", "v"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 512):
                b = whole.slice(a, 512)
                x = _matrix(b.column("v"))
                p = np.hstack([t.priorities(x) for t in held.value])
                best = np.argpartition(-p, probes - 1, axis=1)[:, :probes] if probes < p.shape[1] else np.broadcast_to(np.arange(p.shape[1]), p.shape)
                first = np.cumsum([0, *[t.leaves for t in held.value]])
                tree = np.searchsorted(first, best, side="right") - 1
                leaf = best - first[tree]
                part = np.zeros_like(best)
                for j in range(len(held.value)):
                    part[tree == j] = slice_of(j, leaf[tree == j])
                row = np.repeat(np.arange(len(x)), probes)
                order = np.lexsort((leaf.reshape(-1), part.reshape(-1), row))
                row, part, leaf = row[order], part.reshape(-1)[order], leaf.reshape(-1)[order]
                new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (part[1:] != part[:-1])]))
                take = pa.array(row[new])
                lists = pa.ListArray.from_arrays(pa.array(np.append(new, len(row)), pa.int32()), pa.array(leaf, pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(part[new], pa.int32()), b.column("id").take(take), b.column("v").take(take), lists],
                                                 ["slice", "query", "v", "leaves"])

    def compare(have: pa.Table, asked: pa.Table) -> pa.Table:
        empty = {"query": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())}
        if not have.num_rows or not asked.num_rows:
            return pa.table(empty)
        x, y = _matrix(have.column("v")), _matrix(asked.column("v"))
        ids, queries_ = have.column("id").to_numpy(), asked.column("query").to_numpy()
        leaf = have.column("leaf").to_numpy()
        lists = asked.column("leaves").combine_chunks()
        wanted = lists.flatten().to_numpy()
        who = np.repeat(np.arange(len(y)), lists.value_lengths().to_numpy())
        by_leaf = np.argsort(leaf, kind="stable")
        by_want = np.argsort(wanted, kind="stable")
        q_all, i_all, s_all = [], [], []
        for one in np.unique(wanted):
            rows_ = by_leaf[np.searchsorted(leaf[by_leaf], one):np.searchsorted(leaf[by_leaf], one, side="right")]
            if not len(rows_):
                continue
            qs = who[by_want[np.searchsorted(wanted[by_want], one):np.searchsorted(wanted[by_want], one, side="right")]]
            across = min(len(rows_), CELLS // 64)
            for a, b in ((a, b) for a in range(0, len(qs), CELLS // across) for b in range(0, len(rows_), across)):
                ask, have_ = qs[a:a + CELLS // across], rows_[b:b + across]
                s = y[ask] @ x[have_].T
                if len(have_) > k:  # rounding differs by the shape of the product: keep what may be equal to the last
                    kth = -np.partition(-s, k - 1, axis=1)[:, k - 1]
                    qi, ri = np.nonzero(s >= kth[:, None] - 1e-9 * (1 + np.abs(kth[:, None])))
                else:
                    qi, ri = np.nonzero(np.ones_like(s, bool))
                q_all.append(ask[qi])
                i_all.append(have_[ri])
                s_all.append(s[qi, ri])
        if not q_all:
            return pa.table(empty)
        q, i, s = np.concatenate(q_all), np.concatenate(i_all), np.concatenate(s_all)
        order = np.lexsort((-s, q))
        q, i, s = q[order], i[order], s[order]
        first = np.searchsorted(q, q)
        last = s[np.minimum(first + k - 1, np.searchsorted(q, q, side="right") - 1)]
        keep = s >= last - 1e-9 * (1 + np.abs(last))
        q, i = q[keep], i[keep]
        score = np.einsum("ij,ij->i", y[q], x[i])  # the same sum for a pair wherever it is met
        return pa.table({"query": pa.array(queries_[q], pa.int64()), "id": pa.array(ids[i], pa.int64()), "score": pa.array(score)})

    placed = vectors.select("id", "v").mapInArrow(index, "slice int, leaf int, id long, v array<double>")
    asked = queries.select("id", "v").mapInArrow(visit, "slice int, query long, v array<double>, leaves array<int>")
    return (placed.groupBy("slice").cogroup(asked.groupBy("slice"))
            .applyInArrow(compare, "query long, id long, score double").distinct())


def nearest(df: DataFrame, is_query: Column, k: int = NEAREST, key: str = "vec_id", vector: str = "embedding",
            trees: int = TREES, sample: int = SAMPLE, leaf: int = LEAF, visited: float = VISITED) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row that ``is_query``, among all other ids.

    Equal vectors are one entry that stands for its k + 1 smallest ids; more of them cannot be in
    anyone's result. Rows without an id, and vectors that are null, empty, zero, or hold a null or
    non-finite component take no part. Vectors are compared with those of the same length. Rows
    with one id and different vectors are all candidates; a query never finds its own id.
    """
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    good = df.where(F.col(key).isNotNull() & is_finite_vector(vector) & F.exists(vector, lambda x: x != 0))
    rows = good.select(F.col(key).cast("long").alias("id"), v.alias("v"), is_query.alias("asks"))
    by_vector = Window.partitionBy("v").orderBy("id")
    few = rows.select("id", "v").distinct().withColumn("n", F.row_number().over(by_vector)).where(F.col("n") <= k + 1)
    entries = stored(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("id", F.col("ids")[0]), "entries")
    asking = stored(rows.where("asks").select(F.col("id").alias("query_id"), "v").distinct()
                    .join(entries.select("v", F.col("id").alias("query")), "v").select("query_id", "query", F.size("v").alias("d")), "asking")
    found = None
    for r in entries.groupBy(F.size("v").alias("d")).count().collect():  # usually one length
        own = entries.where(F.size("v") == r["d"])
        asked = own.join(asking.where(F.col("d") == r["d"]).select(F.col("query").alias("id")).distinct(), "id", "left_semi")
        part = search(own, asked, k + 1, build(own, trees, sample, leaf), r["count"], r["d"], visited)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "one")
    # a vector of a later rank has no id before those of k + 1 others that are as near
    first = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    found = found.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1).drop("r")
    each = (found.join(entries.select("id", "ids"), "id").select("query", "score", F.explode("ids").alias("one"))
            .withColumn("r", F.row_number().over(ranked)).where(F.col("r") <= k + 1))
    lists = each.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("r", F.col("one").alias("vec_id"), "score"))).alias("best"))
    out = asking.join(lists, "query").withColumn("best", F.slice(F.filter(
        "best", lambda b: b["vec_id"] != F.col("query_id")), 1, k))
    return (out.select("query_id", F.posexplode("best").alias("p", "b"))
            .select("query_id", (F.col("p") + 1).alias("rank"), "b.vec_id", "b.score"))


def query(spark, sf_dir: str) -> DataFrame:
    """op3: the 20 nearest found of every 20th embedding."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
