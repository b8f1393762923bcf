"""Gradient-boosted trees for every asset at once, by histograms.

Each asset has its own ensemble. Assets of at most ``LOCAL_ROWS`` rows are dealt to blocks of about
``BLOCK_ROWS``, and one task cuts the features of a block's assets and grows all their trees together, level by level,
from histograms (``local_cuts``, ``grow``): one job, however many trees and levels. Longer assets grow together over all tasks: per level ONE
``groupBy(asset, node, feature, bin)`` over the training rows sums counts and gradients (a partial aggregate,
so an asset with a third of all rows is combined inside every input partition), window sums over the at most
``BINS`` bins of a node's feature give the gain of every split, and ``max_by`` takes the best one. Their rows
never meet in one task. Both ways take the same splits.

Squared error; gradients are prediction minus label. With G and n the gradient sum and rows of a node,
``T(G) = sign(G) max(|G| - alpha, 0)``:

    gain  = T(GL)^2 / (nL + l2) + T(GR)^2 / (nR + l2) - T(G)^2 / (n + l2)
    value = -rate * T(G) / (n + l2)

A tree sees a sample of the features, drawn per asset and tree by a hash. Features are cut at the quantiles of
the asset's own training rows; a NULL goes left. A model is kept as node rows (one per tree and node, with the
cut as a value of the feature), so it is scored by a join and an expression, on rows of any origin.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..session import scratch_path

#: The type of a packed model.
MODEL = "array<struct<round:int,nodes:map<int,struct<feature:int,cut:double,value:double>>>>"
#: Cuts of a feature, at most: bin 0 is NULL, bin i the values up to cut i, the last one those above all cuts.
BINS = 32
LEFT = 0
#: Rows of an asset whose trees one task may grow, at most, and rows of a task's block of such assets, about.
LOCAL_ROWS = 50_000
BLOCK_ROWS = 16_384
#: Tasks of that job, at most; beyond, a task takes several blocks, one after another.
BLOCK_TASKS = 1024
#: From so many rows on ``percentile_approx`` may return another value than the exact quantile; shorter assets are cut by their task.
EXACT_ROWS = 5_000
#: What a block returns: a node's row, or (without a node) the error after a round.
_GROWN = ("_group long, round int, node int, feature int, cut double, value double, n long, gain double, train_rmse double, test_rmse double")


class Params(NamedTuple):
    rounds: int = config.GBT_PARAMS["maxIter"]
    depth: int = config.GBT_PARAMS["maxDepth"]
    rate: float = config.GBT_PARAMS["stepSize"]
    alpha: float = config.GBT_ALPHA
    l2: float = 1.0
    columns: float = float(config.GBT_PARAMS["featureSubsetStrategy"])
    least_rows: int = 1
    seed: int = 42


def cuts(rows: DataFrame, group: list[str], features: list[str], bins: int = BINS) -> DataFrame:
    """Per group: ``cuts``, for each feature the distinct quantiles of its values, rising."""
    share = [i / bins for i in range(1, bins)]
    per = rows.groupBy(*group).agg(*[F.percentile_approx(F.col(c).cast("double"), share, 10_000).alias(f"_q{i}") for i, c in enumerate(features)])
    return per.select(*group, F.array(*[F.coalesce(F.array_distinct(f"_q{i}"), F.array().cast("array<double>")) for i in range(len(features))]).alias("cuts"))


def binned(rows: DataFrame, edges: DataFrame, group: list[str], features: list[str]) -> DataFrame:
    """``rows`` with ``bins``: for each feature the number of cuts below its value, plus one; 0 for NULL."""
    def number(i: int, c: str) -> Column:
        x = F.col(c).cast("double")
        return F.when(x.isNull(), 0).otherwise(F.size(F.filter(F.col("cuts")[i], lambda e: e < x)) + 1).cast("tinyint")

    return rows.join(edges, group).withColumn("bins", F.array(*[number(i, c) for i, c in enumerate(features)])).drop("cuts")


def sampled(group: list[str], round_no: int, n: int, p: Params) -> Column:
    """Numbers of the features that a tree may split on, the ones with the least hash."""
    k = max(1, int(p.columns * n))
    draw = F.array(*[F.struct(h.alias("h"), F.lit(i).alias("i")) for i, h in enumerate(_hashes(group, round_no, n, p))])
    return F.transform(F.slice(F.array_sort(draw), 1, k), lambda x: x["i"])


def _hashes(group: list[str], round_no: int, n: int, p: Params) -> list[Column]:
    return [F.xxhash64(*group, F.lit(p.seed + round_no), F.lit(i)) for i in range(n)]


def _shrunk(g: Column, alpha: float) -> Column:
    return F.signum(g) * F.greatest(F.abs(g) - F.lit(alpha), F.lit(0.0))


def best_splits(hist: DataFrame, group: list[str], p: Params) -> DataFrame:
    """Per group and node: the split of largest gain from the histogram (feature, bin, n, g), if any gains.

    Gains within a billionth are equal; of equal ones the least feature, then the least bin, counts.
    """
    node = [*group, "node"]
    hist = hist.repartition(*group)  # sums only: all that follows needs no other shuffle
    run = Window.partitionBy(*node, "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*node, "feature")
    score = lambda g, n: F.pow(_shrunk(g, p.alpha), 2) / (n + p.l2)
    s = hist.select(*node, "feature", "bin", F.sum("n").over(run).alias("nl"), F.sum("g").over(run).alias("gl"),
                    F.sum("n").over(whole).alias("n"), F.sum("g").over(whole).alias("g"))
    s = s.withColumn("nr", F.col("n") - F.col("nl")).withColumn("gr", F.col("g") - F.col("gl"))
    gain = score(F.col("gl"), F.col("nl")) + score(F.col("gr"), F.col("nr")) - score(F.col("g"), F.col("n"))
    s = s.where((F.col("nl") >= p.least_rows) & (F.col("nr") >= p.least_rows)).withColumn("gain", F.round(gain, 9)).where("gain > 1e-9")
    best = F.max_by(F.struct("feature", "bin", "gain", "n", "g", "nl", "gl", "nr", "gr"), F.struct("gain", -F.col("feature"), -F.col("bin")))
    return s.groupBy(*node).agg(best.alias("_b")).select(*node, "_b.*")


def _walk(nodes: Column, depth: int, step) -> Column:
    """The node a row comes to, from the root down; ``step(split)`` is 0 for left and 1 for right."""
    def down(node: Column, _: Column) -> Column:
        split = nodes[node]
        return F.when(split.isNull(), node).otherwise(node * 2 + step(split))

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(1), down)


def _as_map(splits: DataFrame, group: list[str], fields: list[str], name: str) -> DataFrame:
    """Per group: a map from node to its split."""
    return splits.groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct(F.col("node"), F.struct(*fields)))).alias(name))


def local_cuts(x: np.ndarray, null: np.ndarray, at: np.ndarray, train: np.ndarray, given: list) -> tuple[np.ndarray, np.ndarray]:
    """What ``cuts`` and ``binned`` give, for several groups of rows that are in one task.

    ``at``: the number of each row's group; ``given``: by group its cuts, or None for a group that is cut here. Returns
    cuts by group and feature, NaN beyond their number, and the bins of the rows.
    """
    m, p, most = len(given), x.shape[1], BINS - 1
    edges, bins = np.full((m, p, most), np.nan), np.zeros(x.shape, np.int8)
    for i in range(p):
        has = np.flatnonzero(train & ~null[:, i])
        n = np.bincount(at[has], minlength=m)[:, None]
        if len(has):
            v = x[has[np.lexsort((x[has, i], at[has]))], i]
            place = np.cumsum(n)[:, None] - n + (np.arange(1, BINS) * n + BINS - 1) // BINS - 1
            found = v[np.clip(place, 0, len(v) - 1)]
            new = np.broadcast_to(n > 0, found.shape).copy()
            new[:, 1:] &= (found[:, 1:] != found[:, :-1]) & ~(np.isnan(found[:, 1:]) & np.isnan(found[:, :-1]))
        else:
            found, new = np.full((m, most), np.nan), np.zeros((m, most), bool)
        for g, own in enumerate(given):
            if own is not None:
                found[g, :len(own[i])], new[g] = own[i], np.arange(most) < len(own[i])
        g, j = np.nonzero(new)
        edges[g, i, np.cumsum(new, axis=1)[g, j] - 1] = found[g, j]
        # a NaN is above all else
        value, cut = x[:, i, None], edges[at, i]
        below = (cut < value) | (np.isnan(value) & ~np.isnan(cut))
        bins[:, i] = np.where(null[:, i], 0, below.sum(axis=1) + 1)
    return edges, bins


def grow(bins: np.ndarray, at: np.ndarray, y: np.ndarray, test: np.ndarray, start: np.ndarray, picks: np.ndarray, p: Params) -> tuple[dict, dict]:
    """Node columns and error columns of the ensembles of several groups of rows, grown side by side.

    ``at``: the number of each row's group; ``start``: the groups' mean labels; ``picks``: by group and round, the
    features of its tree, rising. A level's histogram has a line for each node that can still be split; a bin without
    rows splits like the one before it, so gains are taken at the others only.
    """
    m, width, size = len(start), BINS + 1, 1 << (p.depth + 1)
    shrunk = lambda g: np.sign(g) * np.maximum(np.abs(g) - p.alpha, 0.0)
    score = lambda g, n: shrunk(g) ** 2 / (n + p.l2)
    value = lambda g, n: -p.rate * shrunk(g) / (n + p.l2)
    train = np.flatnonzero(~test)
    f = start[at]
    nodes: dict[str, list] = {c: [] for c in ("group", "round", "node", "feature", "bin", "value", "n", "gain")}
    errors: dict[str, list] = {c: [] for c in ("group", "round", "train_rmse", "test_rmse")}

    def note(r: int) -> None:
        errors["group"].append(np.arange(m))
        errors["round"].append(np.full(m, r))
        for name, part in (("train_rmse", train), ("test_rmse", np.flatnonzero(test))):
            n = np.bincount(at[part], minlength=m)
            errors[name].append(np.sqrt(np.bincount(at[part], weights=(f[part] - y[part]) ** 2, minlength=m) / np.where(n > 0, n, np.nan)))

    def add(r: int, **columns: np.ndarray) -> None:
        n = len(columns["node"])
        for c in nodes:
            nodes[c].append(np.full(n, r) if c == "round" else columns.get(c, np.full(n, np.nan)))

    note(0)
    for r in range(1, p.rounds + 1):
        g = f - y
        feature, cut, leaf = np.full((m, size), -1), np.zeros((m, size), np.int64), np.zeros((m, size))
        row, node = train, np.ones(len(train), np.int64)
        for level in range(p.depth):
            key = (at[row] << level) + node - (1 << level)
            count = np.bincount(key, minlength=m << level)
            open_ = np.flatnonzero(count >= max(2, 2 * p.least_rows))
            line = np.full(m << level, -1)
            line[open_] = np.arange(len(open_))
            line = line[key]
            row, line = row[line >= 0], line[line >= 0]
            if not len(row):
                break
            group, name = open_ >> level, (open_ & ((1 << level) - 1)) + (1 << level)
            pick = picks[group, r - 1]
            k = pick.shape[1]
            cell = ((line[:, None] * k + np.arange(k)) * width + bins[row[:, None], pick[line]]).ravel()
            cells = len(open_) * k * width
            has_rows = np.zeros(cells, bool)
            has_rows[cell] = True
            at_bin = np.flatnonzero(has_rows)
            place = np.empty(cells, np.int32)
            place[at_bin] = np.arange(len(at_bin))
            place = place[cell]
            nl = np.bincount(place, minlength=len(at_bin))
            gl = np.bincount(place, weights=np.repeat(g[row], k), minlength=len(at_bin))
            # running sums over the bins of a line's feature, each from its first bin on
            part = at_bin // width
            first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            bins_of = np.diff(np.append(first, len(part)))
            of = np.repeat(np.arange(len(first)), bins_of)
            before, nl = nl, nl.cumsum()
            nl -= (nl[first] - before[first])[of]
            longer = np.arange(len(first))
            for j in range(1, int(bins_of.max())):
                longer = longer[bins_of[longer] > j]
                gl[first[longer] + j] += gl[first[longer] + j - 1]
            last = first + bins_of - 1
            n, whole, unsplit = nl[last][of], gl[last][of], score(gl[last], nl[last])[of]
            gain = np.round(score(gl, nl) + score(whole - gl, n - nl) - unsplit, 9)
            can = np.flatnonzero((nl >= p.least_rows) & (n - nl >= p.least_rows) & (gain > 1e-9))
            has = np.zeros(len(open_), bool)
            of = part[can] // k
            if len(can):
                # the first of equal ones has the least feature, then the least bin
                w, first = np.unique(of, return_index=True)
                has[w] = True
                top = np.repeat(np.maximum.reduceat(gain[can], first), np.diff(np.append(first, len(can))))
                equal = np.flatnonzero(gain[can] == top)
                can = can[equal[np.unique(of[equal], return_index=True)[1]]]
            else:
                w = of
            n, whole, nl, gl, gain = n[can], whole[can], nl[can], gl[can], gain[can]
            i, b = part[can] % k, at_bin[can] % width
            feature[group[w], name[w]], cut[group[w], name[w]] = pick[w, i], b
            add(r, group=group[w], node=name[w], feature=pick[w, i], bin=b, n=n, gain=gain)
            for child, cn, cg in ((0, nl, gl), (1, n - nl, whole - gl)):
                leaf[group[w], 2 * name[w] + child] = value(cg, cn)
                # a child that is split later counts as an inner node, its value is not looked up
                add(r, group=group[w], node=2 * name[w] + child, value=value(cg, cn), n=cn)
            row, line = row[has[line]], line[has[line]]
            node = 2 * name[line] + (bins[row, feature[group[line], name[line]]] > cut[group[line], name[line]])
        end = np.ones(len(f), np.int64)
        for _ in range(p.depth):
            chosen = feature[at, end]
            end = np.where(chosen >= 0, 2 * end + (bins[np.arange(len(f)), np.maximum(chosen, 0)] > cut[at, end]), end)
        f = f + leaf[at, end]
        note(r)
    out = {c: np.concatenate(v) if v else np.zeros(0) for c, v in nodes.items()}
    # of a node's two rows, the one it got as a child and the one of its split, the split's
    inner = ~np.isnan(out["feature"])
    code = lambda s: (out["group"][s].astype(np.int64) * (p.rounds + 1) + out["round"][s].astype(np.int64)) * size + out["node"][s].astype(np.int64)
    kept = inner.copy()
    kept[~inner] = ~np.isin(code(~inner), code(inner))
    return {c: v[kept] for c, v in out.items()}, {c: np.concatenate(v) for c, v in errors.items()}


def _grown(rows: DataFrame, head: DataFrame, group: list[str], features: list[str], blocks: int, p: Params) -> DataFrame:
    """The ensembles of groups that each fit a task, one task a block of groups (see ``_GROWN``)."""
    width, k = len(features), max(1, int(p.columns * len(features)))
    tasks = min(blocks, BLOCK_TASKS)
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    have = (rows.join(head.select(*group, "_group"), group)
            .select(block("_group").alias("_block"), "_group", "_y", "_test", *[F.col(c).alias(f"_x{i}") for i, c in enumerate(features)]).repartition(tasks, "_block"))
    draw = F.array(*[h for r in range(1, p.rounds + 1) for h in _hashes(group, r, width, p)])
    heads = head.select(F.col("_group").alias("_of"), "_f", "cuts", draw.alias("_draw")).withColumn("_in", block("_of")).repartition(tasks, "_in")
    null = lambda v, t: pa.array(v, t, from_pandas=True)
    schema = [("_group", pa.int64()), ("round", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("cut", pa.float64()), ("value", pa.float64()),
              ("n", pa.int64()), ("gain", pa.float64()), ("train_rmse", pa.float64()), ("test_rmse", pa.float64())]

    def build(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], t) for _, t in schema], names=[c for c, _ in schema])
        ids = right.column("_of").to_numpy()
        by = np.argsort(ids)
        at = by[np.searchsorted(ids, left.column("_group").to_numpy(), sorter=by)]
        columns = [left.column(f"_x{i}") for i in range(width)]
        x, missing = (np.column_stack([c.to_numpy() for c in v]) for v in (columns, [c.is_null() for c in columns]))
        test = left.column("_test").to_numpy()
        edges, bins = local_cuts(x, missing, at, ~test, right.column("cuts").to_pylist())
        # as ``sampled``: the features of least hash, of equal ones the first
        draw = right.column("_draw").combine_chunks().flatten().to_numpy().reshape(len(ids), p.rounds, width)
        picks = np.sort(np.argsort(draw, axis=2, kind="stable")[:, :, :k], axis=2)
        nodes, errors = grow(bins, at, left.column("_y").to_numpy(), test, right.column("_f").to_numpy(), picks, p)
        inner = np.flatnonzero(~np.isnan(nodes["feature"]))
        of, feature, b = (nodes[c][inner].astype(np.int64) for c in ("group", "feature", "bin"))
        nodes["cut"] = np.full(len(nodes["node"]), np.nan)
        nodes["cut"][inner] = np.where(b == 0, -np.inf, edges[of, feature, np.maximum(b, 1) - 1])
        n, e = len(nodes["node"]), len(errors["round"])
        out = []
        for c, t in schema:
            source = "group" if c == "_group" else c
            parts = [d[source] if source in d else np.full(size, np.nan) for d, size in ((nodes, n), (errors, e))]
            if c == "_group":
                parts = [ids[v.astype(np.int64)] for v in parts]
                out.append(pa.array(np.concatenate(parts), t))
            else:
                out.append(pa.concat_arrays([null(v, pa.float64()).cast(t) for v in parts]))
        return pa.table(out, names=[c for c, _ in schema])

    return have.groupBy("_block").cogroup(heads.groupBy("_in")).applyInArrow(build, _GROWN)


def fit(rows: DataFrame, group: list[str], key: list[str], features: list[str], label: str, test: str = "is_test", p: Params = Params(),
        local_rows: int = LOCAL_ROWS) -> tuple[DataFrame, DataFrame]:
    """Node rows of every group's ensemble, and the error per group and round.

    ``rows`` hold the group, a key within it, the features, the label and ``test``; those with a NULL label, and
    groups without a training row, take no part. Returns

    * nodes: group, round (0: the start, one row whose value is the mean label), node (root 1, children 2i and
      2i + 1), feature, cut, is_leaf, value, n, gain;
    * errors: group, round, train_rmse, test_rmse after that many trees.

    Groups of at most ``local_rows`` rows take one job, of which a lost executor costs a task. Where there are
    longer ones, every level of theirs is one job over their stored rows; splits and predictions are stored as
    they come, so a lost executor costs a task and not the levels before.
    """
    spark = rows.sparkSession
    root = scratch_path(spark, "trees")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    known = rows.where(F.col(label).isNotNull()).select(*group, *key, *[F.col(c).cast("double").alias(c) for c in features],
                                                        F.col(label).cast("double").alias("_y"), F.coalesce(F.col(test), F.lit(False)).alias("_test"))
    fitted = F.when(~F.col("_test"), F.col("_y"))
    start = stored(known.groupBy(*group).agg(F.avg(fitted).alias("_f"), F.count(fitted).alias("n"), F.count(F.lit(1)).alias("_rows")).where("n > 0")
                   .withColumn("_group", F.monotonically_increasing_id()), "start")
    head = start.dropna(subset=group)
    short, by_task = F.col("_rows") <= local_rows, F.col("_rows") < min(EXACT_ROWS, local_rows + 1)
    size = head.agg(F.coalesce(F.sum(F.when(short, F.col("_rows"))), F.lit(0)).alias("local"), F.count_if(~short).alias("long"), F.count_if(~by_task).alias("cut")).first()
    if size["cut"]:
        most = known.where("NOT _test").join(head.where(~by_task).select(*group), group, "left_semi")
        head = stored(head.join(cuts(most, group, features), group, "left"), "head")
    else:
        head = head.withColumn("cuts", F.lit(None).cast("array<array<double>>"))
    nodes = [start.select(*group, F.lit(0).alias("round"), F.lit(0).alias("node"), F.lit(None).cast("int").alias("feature"), F.lit(None).cast("double").alias("cut"),
                          F.lit(True).alias("is_leaf"), F.col("_f").alias("value"), "n", F.lit(None).cast("double").alias("gain"))]
    errors = []
    if size["local"] or not size["long"]:
        near = head.where(short)
        grown = stored(_grown(known, near, group, features, -(-size["local"] // BLOCK_ROWS) or 1, p), "grown")
        named = grown.join(near.select(*group, "_group"), "_group")
        nodes.append(named.where(F.col("node").isNotNull()).select(*group, "round", "node", "feature", "cut", F.col("feature").isNull().alias("is_leaf"), "value", "n", "gain"))
        errors.append(named.where(F.col("node").isNull()).select(*group, "round", "train_rmse", "test_rmse"))
    if size["long"]:
        picks = F.array(*[sampled(group, r, len(features), p) for r in range(1, p.rounds + 1)])
        more_nodes, more_errors = _by_level(known, head.where(~short).withColumn("_picks", picks), group, features, p, stored)
        nodes, errors = nodes + more_nodes, errors + more_errors
    return _union(nodes), _union(errors)


def _by_level(known: DataFrame, head: DataFrame, group: list[str], features: list[str], p: Params, stored) -> tuple[list[DataFrame], list[DataFrame]]:
    """Node rows by round and errors by round of groups that no task may hold, by one job a level."""
    edges = head.select(*group, "cuts")
    state = stored(binned(known, head.select(*group, "cuts", "_f"), group, features).select(*group, "_y", "_test", "bins", "_f"), "round=0")
    errors, nodes = [_errors(state, group, 0)], []
    for r in range(1, p.rounds + 1):
        splits = None
        picks = head.select(*group, F.col("_picks")[r - 1].alias("_pick"))
        for level in range(p.depth):
            at = state.where("NOT _test").join(picks, group)
            if splits is None:
                at = at.withColumn("node", F.lit(1))
            else:
                tree = _as_map(splits, group, ["feature", "bin"], "_tree")
                at = (at.join(tree, group).withColumn("node", _walk(
                    F.col("_tree"), level, lambda s: (F.get(F.col("bins"), s["feature"]) > s["bin"]).cast("int"))).where(F.col("node") >= 1 << level))
            some = F.explode(F.transform("_pick", lambda i: F.struct(i.alias("feature"), F.get(F.col("bins"), i).alias("bin"))))
            hist = (at.select(*group, "node", (F.col("_f") - F.col("_y")).alias("g"), some.alias("_s"))
                    .groupBy(*group, "node", F.col("_s.feature").alias("feature"), F.col("_s.bin").alias("bin"))
                    .agg(F.count(F.lit(1)).alias("n"), F.sum("g").alias("g")))
            found = stored(best_splits(hist, group, p), f"splits-{r}-{level}")
            splits = found if splits is None else splits.unionByName(found)
        tree = stored(_nodes(splits, edges, group, r, p), f"nodes-{r}")
        nodes.append(tree.drop("bin"))
        values = tree.groupBy(*group).agg(
            F.map_from_entries(F.collect_list(F.when(~F.col("is_leaf"), F.struct("node", F.struct("feature", "bin"))))).alias("_tree"),
            F.map_from_entries(F.collect_list(F.when(F.col("is_leaf"), F.struct("node", "value")))).alias("_value"))
        leaf = _walk(F.col("_tree"), p.depth, lambda s: (F.get(F.col("bins"), s["feature"]) > s["bin"]).cast("int"))
        moved = state.join(values, group, "left").withColumn("_f", F.col("_f") + F.coalesce(F.col("_value")[leaf], F.lit(0.0)))
        state = stored(moved.select(*group, "_y", "_test", "bins", "_f"), f"round={r}")
        errors.append(_errors(state, group, r))
    return nodes, errors


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _errors(state: DataFrame, group: list[str], r: int) -> DataFrame:
    sq = F.pow(F.col("_f") - F.col("_y"), 2)
    return state.groupBy(*group).agg(F.sqrt(F.avg(F.when(~F.col("_test"), sq))).alias("train_rmse"), F.sqrt(F.avg(F.when(F.col("_test"), sq))).alias("test_rmse")).select(
        *group, F.lit(r).alias("round"), "train_rmse", "test_rmse")


def _cut() -> Column:
    """The value of a row's ``cuts`` that its split's ``bin`` ends at; NULL at a leaf."""
    return F.when(F.col("bin") == 0, F.lit(float("-inf"))).otherwise(F.get(F.get(F.col("cuts"), F.col("feature")), F.col("bin") - 1))


def _nodes(splits: DataFrame, edges: DataFrame, group: list[str], r: int, p: Params) -> DataFrame:
    """Inner nodes of a tree with their cuts, and as leaves those children that were not split."""
    value = lambda g, n: -p.rate * _shrunk(g, p.alpha) / (n + p.l2)
    s = splits.join(edges, group)
    inner = s.select(*group, "node", "feature", F.col("bin").cast("int").alias("bin"), _cut().alias("cut"), F.lit(False).alias("is_leaf"), F.lit(None).cast("double").alias("value"), "n", "gain")
    child = F.explode(F.array(F.struct((F.col("node") * 2).alias("node"), F.col("nl").alias("n"), F.col("gl").alias("g")),
                              F.struct((F.col("node") * 2 + 1).alias("node"), F.col("nr").alias("n"), F.col("gr").alias("g"))))
    leaves = (splits.select(*group, child.alias("c")).select(*group, "c.node", "c.n", "c.g").join(splits.select(*group, "node"), [*group, "node"], "left_anti")
              .select(*group, "node", F.lit(None).cast("int").alias("feature"), F.lit(None).cast("int").alias("bin"), F.lit(None).cast("double").alias("cut"), F.lit(True).alias("is_leaf"),
                      value(F.col("g"), F.col("n")).alias("value"), "n", F.lit(None).cast("double").alias("gain")))
    return inner.unionByName(leaves).withColumn("round", F.lit(r))


def packed(nodes: DataFrame, group: list[str], features: list[str]) -> DataFrame:
    """Per group one row: ``trees``, its nodes as an array of trees (by round), each a map from node to (feature, cut, value).

    A model's size is bounded by its rounds and depth, whatever the rows it was fitted on.
    """
    tree = nodes.groupBy(*group, "round").agg(
        F.map_from_entries(F.collect_list(F.struct("node", F.struct("feature", "cut", "value")))).alias("nodes"))
    return tree.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("round", "nodes")), lambda a, b: a["round"] - b["round"]).alias("trees"))


def prediction(features: list[str], depth: int = Params().depth) -> Column:
    """The score of a row beside its group's ``trees``: the sum of the leaves it comes to."""
    x = F.array(*[F.col(c).cast("double") for c in features])

    def leaf(tree: Column) -> Column:
        def down(node: Column, _: Column) -> Column:
            split = tree["nodes"][node]
            at = F.get(x, split["feature"])
            return F.when(split["feature"].isNull(), node).otherwise(node * 2 + F.coalesce((at > split["cut"]).cast("int"), F.lit(LEFT)))

        # the start stands alone at node 0
        end = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.when(tree["round"] == 0, 0).otherwise(1), down)
        return F.coalesce(tree["nodes"][end]["value"], F.lit(0.0))

    return F.aggregate(F.col("trees"), F.lit(0.0), lambda s, t: s + leaf(t))


def score(rows: DataFrame, models: DataFrame, group: list[str], features: list[str], out: str, depth: int = Params().depth) -> DataFrame:
    """``rows`` with ``out``, each scored by its own group's ensemble (NULL if there is none)."""
    keep = [c for c in rows.columns if c != out]
    joined = rows.select(*keep).join(models.select(*group, "trees"), group, "left")
    return joined.select(*keep, F.when(F.col("trees").isNotNull(), prediction(features, depth)).alias(out))


def importance(nodes: DataFrame, group: list[str], features: list[str]) -> DataFrame:
    """Share of each feature in the gain of a group's splits."""
    names = F.array(*[F.lit(c) for c in features])
    per = nodes.where("NOT is_leaf").groupBy(*group, F.get(names, F.col("feature")).alias("feature")).agg(F.sum("gain").alias("w"))
    return per.select(*group, "feature", (F.col("w") / F.sum("w").over(Window.partitionBy(*group))).alias("importance"))
