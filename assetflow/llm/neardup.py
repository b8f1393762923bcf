"""Near-duplicates by BagMinHash: weighted-Jaccard signatures, bands, exact verification.

A text is the multiset of its shingles of five words (white-space-delimited, ASCII letters in
lower case; a shorter text is one shingle). Each shingle has a Poisson process over
(weight, time): on the weight interval [0, 1), and on each of [1, 2), [2, 4), [4, 8) ...,
points come in time order with the interval's length as their rate, from a hash of the
shingle and the interval. A text sees the points below its shingle's count. Every point
belongs to one register; a register keeps its earliest point. Two texts agree in a register
with the probability of their weighted Jaccard similarity, sum(min) / sum(max) of counts.

Texts that agree in a band of registers are candidates; candidates are verified on the
multisets themselves; links of at least the threshold join texts into classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pack, slices, stored, table, text_buffers, unpack
from .words import LOWER, MASK, mix, split

WORDS = 5
THRESHOLD = 0.8
#: Registers of a signature, and of a band: at similarity 0.8 all 24 bands miss once in 300,000 pairs.
REGISTERS = 96
BAND = 4
#: Candidates within a bucket are verified from this share of equal registers (52 of 96). A pair of similarity 0.8
#: has fewer with probability 3e-9, a thousandth of what the bands miss, so both together miss 3e-6 of such pairs.
LIKELY = 0.54
#: Texts of a bucket compared at a time.
BLOCK = 1000
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_NULL = -(1 << 63)


def shingles(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of each distinct shingle, by row; and a 128-bit digest of each row's words (0, 0: no words)."""
    n = len(off) - 1
    w = split(LOWER[data], off)
    per = np.bincount(w.doc, minlength=n)
    first = np.cumsum(per) - per
    place = (np.arange(len(w.doc)) - first[w.doc]).astype(np.uint64)
    digest = np.zeros((n, 2), np.uint64)
    for j, h in enumerate((w.h1, w.h2)):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h + (place + np.uint64(1)) * _GOLD), dtype=np.uint64)])
        digest[:, j] = mix(sums[first + per] - sums[first] + per.astype(np.uint64))
    digest[per == 0] = 0
    # a shingle starts at each word with enough words after it, and at the first of a short text
    start = np.flatnonzero((place.astype(np.int64) + WORDS <= per[w.doc]) | (place == 0))
    doc = w.doc[start]
    h = np.zeros(len(start), np.uint64)
    for j in range(WORDS):
        inside = place[start].astype(np.int64) + j < per[doc]
        nxt = w.h1[np.minimum(start + j, max(len(w.h1) - 1, 0))] if len(w.h1) else h
        h = h * np.uint64(0xD1342543DE82EF95) + np.where(inside, nxt, np.uint64(1))
    h = mix(h)
    if not len(h):
        return doc, h, np.zeros(0, np.int64), digest
    # the pair (row, shingle) as one hash: equal pairs meet, others hardly ever
    _, at, count = np.unique(mix(h ^ mix(doc.astype(np.uint64) + _GOLD)), return_index=True, return_counts=True)
    order = np.argsort(doc[at], kind="stable")
    at, count = at[order], count[order]
    return doc[at], h[at], count, digest


def signatures(doc: np.ndarray, shingle: np.ndarray, count: np.ndarray, rows: int, m: int = REGISTERS) -> np.ndarray:
    """BagMinHash signatures (rows x m, 32 bits a register); rows without shingles are 0."""
    weight = np.bincount(doc, weights=count, minlength=rows)
    out = np.zeros((rows, m), np.uint32)
    todo = np.flatnonzero(weight > 0)
    limit = np.zeros(rows)
    limit[todo] = m * (np.log(m) + 3) / weight[todo]
    chosen = np.zeros(rows, bool)
    while len(todo):
        chosen[:] = False
        chosen[todo] = True
        sel = np.flatnonzero(chosen[doc])
        d, x, c = doc[sel], shingle[sel], count[sel]
        cells, times, values = [], [], []
        low, length, level = 0, 1, 0
        while len(d):
            seed = mix(x + np.uint64((level + 1) * 0xC2B2AE3D27D4EB4F & MASK))
            t, who, step = np.zeros(len(d)), np.arange(len(d)), 0
            while len(who):
                step += 1
                u = mix(seed[who] + np.uint64(step * int(_GOLD) & MASK))
                t = t - np.log(((u >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53) / length
                early = t < limit[d[who]]
                who, t, u = who[early], t[early], u[early]
                v = mix(u ^ np.uint64(0x5851F42D4C957F2D))
                at = low + (v >> np.uint64(11)).astype(np.float64) * 2.0**-53 * length
                seen = at < c[who] if length > 1 else np.ones(len(who), bool)
                cells.append(d[who][seen] * m + (mix(v) % np.uint64(m)).astype(np.int64)[seen])
                times.append(t[seen])
                values.append((u[seen] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
            low, length, level = (1, 1, 1) if level == 0 else (2 * low, 2 * length, level + 1)
            more = c > low
            d, x, c = d[more], x[more], c[more]
        cell, time, value = np.concatenate(cells), np.concatenate(times), np.concatenate(values)
        least = np.full(rows * m, np.inf)
        np.minimum.at(least, cell, time)
        won = time == least[cell]
        out.reshape(-1)[cell[won]] = value[won]
        # a register without a point within the limit: look further in those rows, from the start
        todo = todo[np.isinf(least.reshape(rows, m)[todo]).any(axis=1)]
        limit[todo] *= 2
        out[todo] = 0
    return out


def overlap(a: str, b: str) -> float:
    """Weighted Jaccard similarity of two texts' shingles; 0 if one has no words."""
    return float(_overlaps(pa.array([a]), pa.array([b]))[0])


def _overlaps(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Similarity of each pair of rows."""
    n = len(left)
    da, xa, ca, _ = shingles(*text_buffers(left))
    db, xb, cb, _ = shingles(*text_buffers(right))
    pair = mix(np.concatenate([xa, xb]) ^ mix(np.concatenate([da, db]).astype(np.uint64) + _GOLD))
    order = np.argsort(pair, kind="stable")  # a shingle that both have stands twice in a row, the left one first
    doc, count = np.concatenate([da, db])[order], np.concatenate([ca, cb])[order]
    both = np.flatnonzero(pair[order][1:] == pair[order][:-1])
    common = np.bincount(doc[both], weights=np.minimum(count[both], count[both + 1]), minlength=n)
    total = np.bincount(doc, weights=count, minlength=n)
    return np.where(total > 0, common / np.maximum(total - common, 1), 0.0)


def sign(df: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: id, two halves of the digest of its words (null: no words) and the signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 1 << 20):
            doc, x, c, digest = shingles(*text_buffers(b.column("text")))
            sig = signatures(doc, x, c, b.num_rows)
            none = (digest == 0).all(axis=1)
            d = digest.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(d[:, 0], mask=none), pa.array(d[:, 1], mask=none),
                 pa.array([s.tobytes() for s in sig], pa.binary())], ["id", "d1", "d2", "sig"])

    rows = df.select(F.coalesce(F.col(key).cast("long"), F.lit(_NULL)).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id long, d1 long, d2 long, sig binary")


def bands(reps: DataFrame) -> DataFrame:
    """(bucket, id) for each band of each signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint32).reshape(b.num_rows, -1, BAND).astype(np.uint64)
            h = np.broadcast_to(np.arange(sig.shape[1], dtype=np.uint64) + np.uint64(1), sig.shape[:2]).copy()
            for j in range(BAND):
                h = mix(h * _GOLD + sig[:, :, j])
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64).reshape(-1)),
                                              pa.array(np.repeat(b.column("id").to_numpy(), sig.shape[1]))], ["bucket", "id"])

    return reps.select("id", "sig").mapInArrow(run, "bucket long, id long")


def verify(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts are at least ``threshold`` similar."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "ta", 1 << 20):
            ok = _overlaps(b.column("ta"), b.column("tb")) >= threshold - 1e-12
            yield b.select(["a", "b"]).filter(pa.array(ok))

    both = (pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
            .join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a"))
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(id, label) for every end of a link, the label being the least id it is connected to.

    Alternates large-star and small-star steps; each is a minimum per id and a join, so a hub is
    split over tasks like any skewed join. Ends when the links no longer change.
    """
    state = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first())
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    before = state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = stored(small.select("e.u", "e.v").where("u <> v").distinct(), "links")
        now = state(edges)
        if now == before:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(
                edges.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct())
        before = now


def _blocked(rows: DataFrame, group: str, block: int) -> DataFrame:
    """``rows`` (group, id, label, ...) dealt to pairs of blocks (p, q) of about ``block`` rows of a group.

    ``own`` is a row's block. A group within one block is one task. In a larger one the rows of its largest
    class meet the other rows only, not each other: each goes to as many tasks as the others have blocks, one
    for a class of copies with a few other texts, and the others, the smaller side, go to all.
    """
    size = (rows.groupBy(group, "label").agg(F.count(F.lit(1)).alias("n")).groupBy(group)
            .agg(F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("all")))
    blocks = lambda n: F.ceil(n / F.lit(block)).cast("int")
    size = size.select(group, F.col("most.label").alias("__large"), (F.col("all") <= block).alias("__one"),
                       blocks(F.col("most.n")).alias("__b"), blocks(F.col("all") - F.col("most.n")).alias("__r"))
    large = F.col("label") == F.col("__large")
    own = F.when(F.col("__one"), 0).when(large, F.pmod(F.xxhash64("id"), F.col("__b"))).otherwise(
        F.col("__b") + F.pmod(F.xxhash64("id"), F.col("__r"))).cast("int")
    others = F.when(F.col("__one"), F.array(F.lit(0))).otherwise(
        F.sequence(F.when(large, F.col("__b")).otherwise(0), F.col("__b") + F.col("__r") - 1))
    return (rows.join(size, group).withColumn("own", own).withColumn("other", F.explode(others))
            .withColumns({"p": F.least("own", "other"), "q": F.greatest("own", "other")})
            .drop("__large", "__one", "__b", "__r", "other"))


class _Sides:
    """Rows of a pair of blocks: their classes so far, and whom each is still to be compared with."""

    def __init__(self, t: pa.Table, likely: float):
        p, q = t.column("p")[0].as_py(), t.column("q")[0].as_py()
        own, self.ids, self.root = (t.column(c).to_numpy().copy() for c in ("own", "id", "label"))
        self.sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint32).reshape(len(own), -1)
        self.left, self.right, self.likely = np.flatnonzero(own == p), own == q, likely

    def central_first(self) -> np.ndarray:
        """The left rows, those most like the whole first: texts that many were copied from."""
        usual = np.zeros(len(self.ids))
        for j in range(self.sig.shape[1]):
            _, at, n = np.unique(self.sig[:, j], return_inverse=True, return_counts=True)
            usual += n[at]
        return self.left[np.argsort(-usual[self.left], kind="stable")]

    def partners(self, i: int) -> np.ndarray:
        at = np.flatnonzero(self.right & (self.root != self.root[i]))
        return at[(self.sig[at] == self.sig[i]).mean(axis=1) >= self.likely]

    def unite(self, i: int, others: np.ndarray) -> None:
        self.root[np.isin(self.root, self.root[others])] = self.root[i]


def _families(buckets: DataFrame, sigs: DataFrame, likely: float, block: int) -> DataFrame:
    """Links between classes (labels) that have texts with nearly equal signatures in one bucket.

    A group's links are a forest, at most one fewer than its classes.
    """
    def compare(t: pa.Table) -> pa.Table:
        s = _Sides(t, likely)
        label = s.root.copy()
        a, b = [], []
        for i in s.left:
            for j in s.partners(i):
                if s.root[j] != s.root[i]:
                    a.append(label[i])
                    b.append(label[j])
                    s.unite(i, np.array([j]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    rows = _blocked(buckets, "bucket", block).join(sigs.select("id", "sig"), "id")
    return rows.groupBy("bucket", "p", "q").applyInArrow(compare, "a long, b long")


def _within(families: DataFrame, sigs: DataFrame, texts: DataFrame, threshold: float, likely: float, block: int) -> DataFrame:
    """Verified links across classes within a family (family, id, label): a forest of them in each pair of blocks.

    Each text is compared with all texts of other classes whose signatures are nearly alike, on the
    multisets, inside the task; texts that a link has brought into one class need no other.
    """
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 1 << 20):
            doc, x, c, _ = shingles(*text_buffers(b.column("text")))
            cut = np.searchsorted(doc, np.arange(b.num_rows + 1))
            order = np.lexsort((x, doc))
            x, c = x[order], c[order]
            blobs = [pack(x[i:j], c[i:j].astype(np.uint32)) for i, j in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(blobs, pa.binary())], ["id", "multiset"])

    def compare(t: pa.Table) -> pa.Table:
        s = _Sides(t, likely)
        sets = [unpack(m, "u8", "u4") for m in t.column("multiset").to_pylist()]
        weight = np.array([c.sum() for _, c in sets], np.int64)
        a, b = [], []
        for i in s.central_first():
            at = s.partners(i)
            if not len(at):
                continue
            x, c = sets[i]
            size = np.array([len(sets[j][0]) for j in at])
            y, d = (np.concatenate([sets[j][k] for j in at]) for k in (0, 1))
            pos = np.minimum(np.searchsorted(x, y), len(x) - 1)
            both = np.where(x[pos] == y, np.minimum(c[pos], d), 0)
            common = np.add.reduceat(both.astype(np.int64), np.cumsum(size) - size)
            linked = at[common >= (threshold - 1e-12) * (weight[i] + weight[at] - common)]
            if len(linked):
                _, one = np.unique(s.root[linked], return_index=True)  # a link for each class that joins
                a += [s.ids[i]] * len(one)
                b += s.ids[linked[one]].tolist()
                s.unite(i, linked)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    ids = families.select("id").distinct()
    sets = texts.join(ids, "id", "left_semi").select("id", "text").mapInArrow(weigh, "id long, multiset binary")
    rows = _blocked(families, "family", block).join(sigs.select("id", "sig").join(sets, "id"), "id")
    return rows.groupBy("family", "p", "q").applyInArrow(compare, "a long, b long")


def classes(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
            likely: float = LIKELY, block: int = BLOCK) -> DataFrame:
    """One row per row of ``df``: its id and class_id, the least id of its class.

    Rows with one id share a class (null is an id). Texts without words are in no one's class but their own.

    1. Texts of the same words are one representative, the least id.
    2. Every representative is paired with the least of each of its buckets and the pairs are verified.
    3. Classes that share a bucket and have nearly equal signatures there form families. Within a
       family every text is compared with those of other classes, so each candidate pair is either
       compared or already in one class, and no more links than texts leave a task.
    """
    signed = stored(sign(df, key, text), "signatures")
    worded = signed.where(F.col("d1").isNotNull())
    reps = stored(worded.groupBy("d1", "d2").agg(F.min(F.struct("id", "sig")).alias("r")).select("d1", "d2", "r.id", "r.sig"), "representatives")
    rows = bands(reps)
    least = rows.groupBy("bucket").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a <> z").select("bucket", "a")
    shared = stored(rows.join(least, "bucket"), "buckets")  # buckets of several texts only
    pairs = shared.where("id <> a").select("a", F.col("id").alias("b")).distinct()
    ids = shared.select("id").distinct()
    source = df.select(F.coalesce(F.col(key).cast("long"), F.lit(_NULL)).alias("id"), F.col(text).alias("text"))
    texts = stored(source.join(ids.hint("shuffle_hash"), "id", "left_semi").groupBy("id").agg(F.min("text").alias("text")), "texts")
    links = stored(verify(pairs, texts, threshold), "verified")
    labels = components(links)
    labelled = shared.select("bucket", "id").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    several = labelled.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("bucket")
    rest = stored(labelled.join(several, "bucket"), "open_buckets")
    family = components(_families(rest, reps, likely, block))
    members = stored(rest.select("id", "label").distinct().join(
        family.select(F.col("id").alias("label"), F.col("label").alias("family")), "label"), "families")
    more = _within(members, reps, texts, threshold, likely, block)
    # classes so far count as links from each id to its label
    known = labels.where("id <> label").select(F.col("label").alias("a"), F.col("id").alias("b"))
    labels = components(known.unionByName(more))
    rep_of = (reps.select("d1", "d2", F.col("id").alias("rep")).join(labels.select(F.col("id").alias("rep"), "label"), "rep", "left")
              .select("d1", "d2", F.coalesce("label", "rep").alias("class_id")))
    member = worded.select("id", "d1", "d2").join(rep_of, ["d1", "d2"])
    named = member.select("id", "class_id").unionByName(signed.where(F.col("d1").isNull()).select("id", F.col("id").alias("class_id")))
    kind = df.schema[key].dataType
    real = lambda c: F.when(F.col(c) != _NULL, F.col(c)).cast(kind)
    return named.select(real("id").alias(key), real("class_id").alias("class_id"))


def query(spark, sf_dir: str) -> DataFrame:
    """op7: the near-duplicate class of every document."""
    return classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
