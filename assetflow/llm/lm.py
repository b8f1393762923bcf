"""Language-model scores from a log-bilinear model trained by noise-contrastive estimation.

Tokens are white-space-delimited words (ASCII letters in lower case) and one end per text. The
model predicts a token's class from the classes of the two tokens before it: the most frequent
tokens are classes of their own, as many as the root of the number of distinct tokens counted (192
at least), all others fall into classes by how they begin. Within a class
tokens have their smoothed share of the counts, with one share for all unseen ones.

    log P(class | a, b) = (A1[a] + A2[b]) . B[class] + bias[class] - log Z(a, b)

Training tells observed classes from noise drawn by class frequency (numpy, batches of
matrix products, Adagrad), which needs no Z; scoring works Z out, once per distinct context.

All counts cover the whole training fold: tokens per hash bucket, class trigrams per hash
bucket of their context. Each round is a full pass: every counted trigram is an example, weighted
by its count, and frequent ones are several. The buckets form shards of about equally many
trigrams, however many tasks there are; a shard holds all that follows its contexts. Parameters
and Adagrad's sums are averaged over the shards after each round.

Words are told apart by 64-bit hashes; two of a billion words share one with probability 0.03.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_bucket, groups_for, id_remainder, pack, slices, stored, table, text_buffers, unpack
from .words import LOWER, Prefix, boundaries, mix

SMOOTHING = 0.1
#: Classes of single frequent tokens (the end among them; the least number, see ``own_tokens``), and of all other tokens.
FREQUENT, RARE = 192, 64
WIDTH = 24
ROUNDS, NOISE, BATCH, RATE = 3, 64, 1024, 0.15
#: Trigrams in a training shard, about; sets the steps between two averages, whatever the number of tasks.
SHARD = 1_000_000
#: Bytes of text in a group, about; sets the number of groups and buckets, not the result.
GROUP_BYTES = 3 << 20
END = np.uint64(0)
#: Bits of a class in a trigram, at least.
_BITS = 9


def own_tokens(words: int) -> int:
    """How many tokens are classes of their own, of so many distinct ones counted."""
    return max(FREQUENT, math.isqrt(words))


def bits_of(contexts: int) -> int:
    """Bits that hold a class out of so many, the one before a text included."""
    return max(_BITS, (contexts - 1).bit_length())


class Tokens(NamedTuple):
    """Tokens of the rows in order, each row closed by the end."""
    hash: np.ndarray
    rare: np.ndarray  # the class among rare tokens that the first two bytes give
    size: np.ndarray  # per row


def tokens(data: np.ndarray, off: np.ndarray) -> Tokens:
    data = LOWER[data]
    start, end, doc = boundaries(data, off)
    n = len(off) - 1
    per = np.bincount(doc, minlength=n)
    if len(start):
        two = data[start].astype(np.uint64) * np.uint64(256)
        more = end - start > 1
        two[more] += data[start[more] + 1]
        h, rare = Prefix(data, 0).of(start, end), (mix(two) % np.uint64(RARE)).astype(np.int16)
    else:
        h, rare = np.zeros(0, np.uint64), np.zeros(0, np.int16)
    at = np.cumsum(per)
    return Tokens(np.insert(h, at, END), np.insert(rare, at, 0), per + 1)


class Counted:
    """Sums of counts by key, combined whenever they pile up."""

    def __init__(self, most: int = 3_000_000):
        self.most, self.parts, self.size = most, [], 0

    def add(self, key: np.ndarray, n: np.ndarray, tag: np.ndarray) -> None:
        self.parts.append((key, n, tag))
        self.size += len(key)
        if self.size > self.most:
            self.parts = [self.total()]
            self.size = len(self.parts[0][0])
            self.most = max(self.most, 2 * self.size)

    def total(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int16)
        key, n, tag = (np.concatenate([p[i] for p in self.parts]) for i in range(3))
        key, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        return key, np.bincount(inverse, weights=n).astype(np.int64), tag[first]


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(key + np.uint64(1)) % np.uint64(buckets)).astype(np.int64)


def _blobs(buckets: int, key: np.ndarray, n: np.ndarray, tag: np.ndarray, shift: int = 0) -> pa.RecordBatch:
    """Packed rows by bucket of the key without its lowest ``shift`` bits."""
    rows = [(b, pack(key[i], n[i], tag[i])) for b, i in by_bucket(_bucket(key >> np.uint64(shift), buckets))]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["bucket", "blob"])


def count_tokens(texts: DataFrame, buckets: int) -> DataFrame:
    """Per bucket: the tokens' hashes, counts and rare classes, and their totals by rare class."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Counted()
        for b in slices(batches, "text", 1 << 20):
            t = tokens(*text_buffers(b.column("text")))
            key, first, n = np.unique(t.hash, return_index=True, return_counts=True)
            c.add(key, n, t.rare[first])
        yield _blobs(buckets, *c.total())

    def merge(t: pa.Table) -> pa.Table:
        c = Counted()
        for x in t.column("blob").to_pylist():
            c.add(*unpack(x, "u8", "i8", "i2"))
        key, n, tag = c.total()
        by_class = [np.bincount(tag, weights=w, minlength=RARE).astype(np.int64).tolist() for w in (n, np.ones(len(n)))]
        return pa.Table.from_arrays(
            [t.column("bucket").slice(0, 1), pa.array([pack(key, n, tag)], pa.binary()), pa.array([by_class[0]]), pa.array([by_class[1]])],
            ["bucket", "blob", "tokens", "words"])

    got = texts.select("text").mapInArrow(count, "bucket int, blob binary")
    return stored(got.groupBy("bucket").applyInArrow(
        merge, "bucket int, blob binary, tokens array<bigint>, words array<bigint>"), "token-counts")


def most_frequent(counts: DataFrame, top: int) -> list:
    """The ``top`` most frequent tokens of all buckets (hash, n, rare)."""
    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column("blob").to_pylist():
                key, n, tag = unpack(x, "u8", "i8", "i2")
                at = np.lexsort((key, -n))[:top]
                yield pa.RecordBatch.from_arrays([pa.array(key[at].view(np.int64)), pa.array(n[at]), pa.array(tag[at].astype(np.int64))], ["hash", "n", "rare"])

    return counts.select("blob").mapInArrow(candidates, "hash long, n long, rare long").orderBy(F.desc("n"), "hash").limit(top).collect()


class Classes(NamedTuple):
    """Classes 0 to len(frequent)-1 are the tokens ``frequent`` (sorted by hash); rare class r follows as
    len(frequent)+r; one more, for what stands before a text, is only ever a context."""
    frequent: np.ndarray
    mass: np.ndarray  # training tokens of each class
    share: np.ndarray  # smoothed sum of counts of each rare class, its unseen token included
    tokens: int
    words: int

    def of(self, h: np.ndarray, rare: np.ndarray) -> np.ndarray:
        if not len(self.frequent):
            return rare.astype(np.int64)
        at = np.minimum(np.searchsorted(self.frequent, h), len(self.frequent) - 1)
        return np.where(self.frequent[at] == h, at, len(self.frequent) + rare)

    @property
    def size(self) -> int:
        return len(self.frequent) + RARE

    @property
    def bits(self) -> int:
        return bits_of(self.size + 1)


def classes(counts: DataFrame) -> Classes:
    """From sums by rare class (as many as there are) and the most frequent tokens of all buckets, more of them the more distinct ones there are."""
    sums = counts.select(F.posexplode(F.arrays_zip("tokens", "words")).alias("r", "x")).groupBy("r").agg(
        F.sum("x.tokens").alias("tokens"), F.sum("x.words").alias("words")).collect()
    n, w = np.zeros(RARE), np.zeros(RARE)
    for r in sums:
        n[r["r"]], w[r["r"]] = r["tokens"], r["words"]
    total, words = int(n.sum()), int(w.sum())
    most = most_frequent(counts, own_tokens(words))
    frequent = np.array([r["hash"] for r in most], np.int64).view(np.uint64)
    order = np.argsort(frequent)
    count = np.array([r["n"] for r in most], float)
    for r in most:
        n[r["rare"]] -= r["n"]
        w[r["rare"]] -= 1
    return Classes(frequent[order], np.concatenate([count[order], n]), n + SMOOTHING * (w + 1), total, words)


def contexts(c: np.ndarray, size: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray]:
    """The classes two before and one before each token; ``before`` stands before a text."""
    first = np.cumsum(size) - size
    one, two = np.empty_like(c), np.empty_like(c)
    one[1:], two[2:] = c[:-1], c[:-2]
    one[first] = two[first] = before
    second = (first + 1)[size > 1]
    two[second] = before
    return two, one


def count_trigrams(texts: DataFrame, c: Classes, buckets: int) -> DataFrame:
    """Per bucket of contexts: class trigrams (as one number), how often they occur, and how many there are."""
    held = texts.sparkSession.sparkContext.broadcast(c)
    bits = c.bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counted()
        for b in slices(batches, "text", 1 << 20):
            t = tokens(*text_buffers(b.column("text")))
            own = held.value.of(t.hash, t.rare)
            two, one = contexts(own, t.size, held.value.size)
            key, n = np.unique((two << 2 * bits | one << bits | own).astype(np.uint64), return_counts=True)
            total.add(key, n, np.zeros(len(key), np.int16))
        yield _blobs(buckets, *total.total(), shift=bits)

    def merge(t: pa.Table) -> pa.Table:
        total = Counted()
        for x in t.column("blob").to_pylist():
            total.add(*unpack(x, "u8", "i8", "i2"))
        key, n, tag = total.total()
        return pa.table({"bucket": t.column("bucket").slice(0, 1), "blob": pa.array([pack(key, n, tag)], pa.binary()), "trigrams": pa.array([len(key)], pa.int64())})

    return stored(texts.select("text").mapInArrow(count, "bucket int, blob binary").groupBy("bucket")
                  .applyInArrow(merge, "bucket int, blob binary, trigrams long"), "trigram-counts")


def training_shards(trigrams: DataFrame, most: int = SHARD) -> DataFrame:
    """Per shard: the trigrams and counts of its buckets; about ``most`` trigrams, or one bucket if that has more."""
    shards = groups_for(trigrams.agg(F.sum("trigrams").alias("n")).first()["n"], most)

    def merge(t: pa.Table) -> pa.Table:
        got = [unpack(x, "u8", "i8", "i2") for _, x in sorted(zip(t.column("bucket").to_pylist(), t.column("blob").to_pylist(), strict=True))]
        key, n = (np.concatenate([g[i] for g in got]) for i in (0, 1))
        return pa.table({"shard": t.column("shard").slice(0, 1), "blob": pa.array([pack(key, n)], pa.binary())})

    return stored(trigrams.select((F.col("bucket") % shards).alias("shard"), "bucket", "blob").repartition(shards, "shard").groupBy("shard")
                  .applyInArrow(merge, "shard int, blob binary"), "training-shards")


class Model(NamedTuple):
    a2: np.ndarray  # by the class two before
    a1: np.ndarray  # by the class before
    b: np.ndarray
    bias: np.ndarray

    def context(self, two: np.ndarray, one: np.ndarray) -> np.ndarray:
        return self.a2[two] + self.a1[one]

    def log_z(self, q: np.ndarray) -> np.ndarray:
        """Log of the sum over all classes, for contexts in rows."""
        out = np.empty(len(q))
        for a in range(0, len(q), 1024):
            s = q[a:a + 1024] @ self.b.T
            s += self.bias
            top = s.max(axis=1)
            s -= top[:, None]
            out[a:a + 1024] = top + np.log(np.exp(s, out=s).sum(axis=1))
        return out


#: Contexts whose Z a Python worker keeps between slices and tasks, at most (about 16 bytes each).
MEMO = 4_000_000
_memo: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def log_z_of(m: Model, name: str, pair: np.ndarray, bits: int) -> np.ndarray:
    """``log_z`` of the contexts ``pair`` (sorted), kept for the model ``name``: the same contexts come again and again.

    A memo only: the last model's, started afresh when it is full.
    """
    known, z = _memo.get(name) or (np.zeros(0, np.int64), np.zeros(0))
    at = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
    new = known[at] != pair if len(known) else np.ones(len(pair), bool)
    out = np.empty(len(pair))
    out[~new] = z[at[~new]]
    out[new] = m.log_z(m.context(pair[new] >> bits, pair[new] & ((1 << bits) - 1)))
    if new.any():
        if len(known) > MEMO:
            known, z = np.zeros(0, np.int64), np.zeros(0)
        spot = np.searchsorted(known, pair[new])
        _memo.clear()
        _memo[name] = np.insert(known, spot, pair[new]), np.insert(z, spot, out[new])
    return out


def start_model(c: Classes, width: int = WIDTH, seed: int = 7) -> Model:
    """Small random vectors; biases at the logarithm of the classes' frequencies, so Z starts near 1."""
    rng = np.random.default_rng(seed)
    f = (c.mass + SMOOTHING) / (c.mass + SMOOTHING).sum()
    r = lambda n: rng.normal(0, 0.1, (n, width)).astype(np.float32)
    return Model(r(c.size + 1), r(c.size + 1), r(c.size), np.log(f).astype(np.float32))


def examples(n: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """A full pass over trigrams counted ``n`` times: positions in random order and their weights, 1 on average.

    Each has its count as its weight; what is counted more often than the mean is dealt to several examples
    of equal weight, at most as many again as there are trigrams.
    """
    copies = np.ceil(n / (n.sum() / len(n))).astype(np.int64)
    at = rng.permutation(np.repeat(np.arange(len(n)), copies))
    return at, ((n / copies)[at] * (len(at) / n.sum())).astype(np.float32)


def start_sums(m: Model) -> Model:
    """Adagrad's sums before the first step."""
    return Model(*(np.full(x.shape, 1e-2, np.float32) for x in m))


def train(m: Model, key: np.ndarray, n: np.ndarray, noise: np.ndarray, draws: int | None, seed: int, k: int = NOISE, rate: float = RATE,
          sums: Model | None = None) -> Model:
    """Noise-contrastive estimation on a full pass over the counted trigrams, or on ``draws`` examples drawn from them.

    Each batch shares ``k`` noise classes, drawn from the frequencies ``noise``; a batch is three matrix
    products forward and back. Steps follow Adagrad, whose ``sums`` are added to in place.
    """
    rng = np.random.default_rng(seed)
    a2, a1, b, bias = (x.astype(np.float32, copy=True) for x in m)
    g2, g1, gb, gbias = sums or start_sums(m)
    cum, cum_noise = np.cumsum(n), np.cumsum(noise)
    log_kn = np.log(k * noise / noise.sum()).astype(np.float32)
    bits = bits_of(len(a2))
    mask = (1 << bits) - 1

    def step(x: np.ndarray, sum_: np.ndarray, rows: np.ndarray, grad: np.ndarray) -> None:
        """Adds up the gradients of equal rows, then one step for each row."""
        one, inverse = np.unique(rows, return_inverse=True)
        if grad.ndim == 1:
            g = np.bincount(inverse, weights=grad, minlength=len(one)).astype(np.float32)
        else:
            g = np.zeros((len(one), grad.shape[1]), np.float32)
            order = np.argsort(inverse, kind="stable")
            g[:] = np.add.reduceat(grad[order], np.searchsorted(inverse[order], np.arange(len(one))), axis=0)
        sum_[one] += g * g
        x[one] += rate * g / np.sqrt(sum_[one])

    def batches() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if draws is None:
            at, weight = examples(n, rng)
            for i in range(0, len(at), BATCH):
                yield at[i:i + BATCH], weight[i:i + BATCH]
        else:
            for _ in range(max(1, draws // BATCH)):
                yield np.searchsorted(cum, rng.integers(0, cum[-1], BATCH), side="right"), np.ones(BATCH, np.float32)

    for at, weight in batches():
        pick = key[at].astype(np.int64)
        two, one, w = pick >> 2 * bits, pick >> bits & mask, pick & mask
        fake = np.searchsorted(cum_noise, rng.random(k) * cum_noise[-1], side="right")
        q = a2[two] + a1[one]
        true = np.einsum("ij,ij->i", q, b[w]) + bias[w] - log_kn[w]
        false = q @ b[fake].T + (bias[fake] - log_kn[fake])
        up = weight / (1 + np.exp(np.clip(true, -30, 30)))
        down = -weight[:, None] / (1 + np.exp(-np.clip(false, -30, 30)))
        dq = (up[:, None] * b[w] + down @ b[fake]) / BATCH
        db = np.concatenate([up[:, None] * q, down.T @ q]) / BATCH
        dbias = np.concatenate([up, down.sum(axis=0)]) / BATCH
        classes_ = np.concatenate([w, fake])
        step(a2, g2, two, dq)
        step(a1, g1, one, dq)
        step(b, gb, classes_, db)
        step(bias, gbias, classes_, dbias)
    return Model(a2, a1, b, bias)


def fit(shards: DataFrame, c: Classes, rounds: int = ROUNDS) -> Model:
    """Rounds of a full pass in every shard from the last average; shards are averaged by the tokens they hold.

    One task trains one shard. The averages are taken in the tasks of two more stages, so one parameter set
    reaches the driver and goes out again: about 300 bytes a class, and classes grow with the root of the words.
    """
    sc = shards.sparkSession.sparkContext
    count = max(1, shards.count())
    model = start_model(c)
    sums = start_sums(model)
    shapes = [x.shape for x in model + sums]
    for r in range(rounds):
        held = sc.broadcast((model, sums, c.mass + SMOOTHING))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t in batches:
                for shard, x in zip(t.column("shard").to_pylist(), t.column("blob").to_pylist(), strict=True):
                    key, n = unpack(x, "u8", "i8")
                    model, sums, noise = held.value
                    sums = Model(*(x.copy() for x in sums))
                    m = train(model, key, n, noise, None, 100 * r + 31 * shard, sums=sums)
                    flat = np.concatenate([x.reshape(-1) for x in m + sums]).astype(np.float32)
                    yield pa.RecordBatch.from_arrays([pa.array([shard % 8], pa.int32()), pa.array([float(n.sum())]), pa.array([flat.tobytes()], pa.binary())],
                                                     ["part", "weight", "sums"])

        def add(t: pa.Table) -> pa.Table:
            weight = sum(t.column("weight").to_pylist())
            flat = sum(np.frombuffer(x, np.float32).astype(np.float64) * w for x, w in zip(t.column("sums").to_pylist(), t.column("weight").to_pylist(), strict=True))
            return pa.table({"part": pa.array([0], pa.int32()), "weight": pa.array([weight]), "sums": pa.array([(flat / weight).astype(np.float32).tobytes()], pa.binary())})

        parts = shards.repartitionByRange(count, "shard").mapInArrow(run, _PART).groupBy("part").applyInArrow(add, _PART)
        flat = np.frombuffer(parts.groupBy("part").applyInArrow(add, _PART).first()["sums"], np.float32)
        held.unpersist()
        parts, at = [], 0
        for s in shapes:
            parts.append(flat[at:at + int(np.prod(s))].reshape(s).copy())
            at += int(np.prod(s))
        model, sums = Model(*parts[:4]), Model(*parts[4:])
    return model


_PART = "part int, weight double, sums binary"
_ASK = "bucket int, src int, blob binary"
_TOLD = "__group int, blob binary"
_OUT = "n_tokens long, n_known long, base_score double, score double"


def score(df: DataFrame, counts: DataFrame, buckets: int, c: Classes, model: Model | None, groups: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_tokens, n_known, base_score and score (log10).

    Groups of texts ask the buckets for the counts of their distinct tokens, then score their texts.
    """
    held = df.sparkSession.sparkContext.broadcast((c, model))
    name = uuid.uuid4().hex
    kind = df.schema[key].dataType.simpleString()
    grouped = df.select(F.col(key).alias("__key"), F.coalesce(F.col(text), F.lit("")).alias("__text"),
                        F.pmod(F.xxhash64(key, text), F.lit(groups)).cast("int").alias("__group"))

    def cut(t: pa.Table) -> Iterator[tuple[pa.RecordBatch, Tokens]]:
        for b in slices(iter(t.combine_chunks().to_batches()), "__text", 1 << 20):
            yield b, tokens(*text_buffers(b.column("__text")))

    def ask(t: pa.Table) -> pa.Table:
        src = t.column("__group")[0].as_py()
        h = np.unique(np.concatenate([np.unique(x.hash) for _, x in cut(t.select(["__text"]))]))
        rows = [(b, pack(h[i])) for b, i in by_bucket(_bucket(h, buckets))]
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()), "src": pa.array([src] * len(rows), pa.int32()),
                         "blob": pa.array([r[1] for r in rows], pa.binary())})

    def tell(asked: pa.Table, have: pa.Table) -> pa.Table:
        out = []
        if asked.num_rows and have.num_rows:
            key_, n, _ = unpack(have.column("blob")[0].as_py(), "u8", "i8", "i2")
            for src, x in zip(asked.column("src").to_pylist(), asked.column("blob").to_pylist(), strict=True):
                h = unpack(x, "u8")[0]
                at = np.minimum(np.searchsorted(key_, h), len(key_) - 1)
                ok = key_[at] == h
                out.append((src, pack(h[ok], n[at[ok]])))
        return pa.table({"__group": pa.array([x[0] for x in out], pa.int32()), "blob": pa.array([x[1] for x in out], pa.binary())})

    def rate(t: pa.Table, told: pa.Table) -> pa.Table:
        c, m = held.value
        got = [unpack(x, "u8", "i8") for x in told.column("blob").to_pylist()]
        known = np.concatenate([np.zeros(0, np.uint64), *[g[0] for g in got]])
        order = np.argsort(known)
        known, counts_ = known[order], np.concatenate([np.zeros(0, np.int64), *[g[1] for g in got]])[order]
        cols: list[list[np.ndarray]] = [[], [], [], []]
        ids = []
        for b, x in cut(t):
            n = np.zeros(len(x.hash))
            if len(known):
                at = np.minimum(np.searchsorted(known, x.hash), len(known) - 1)
                n = np.where(known[at] == x.hash, counts_[at], 0).astype(float)
            doc = np.repeat(np.arange(len(x.size)), x.size)
            add_up = lambda v: np.bincount(doc, weights=v, minlength=len(x.size))  # noqa: E731, B023
            base = add_up(np.log10((n + SMOOTHING) / (c.tokens + SMOOTHING * (c.words + 1))))
            if m is None:
                own = base
            else:
                k = c.of(x.hash, x.rare)
                two, one = contexts(k, x.size, c.size)
                pair, inverse = np.unique(two << c.bits | one, return_inverse=True)
                q = m.context(pair >> c.bits, pair & ((1 << c.bits) - 1))
                z = log_z_of(m, name, pair, c.bits)
                p = np.einsum("ij,ij->i", q[inverse], m.b[k]) + m.bias[k] - z[inverse]
                rare = k >= len(c.frequent)
                p[rare] += np.log((n[rare] + SMOOTHING) / c.share[k[rare] - len(c.frequent)])
                own = add_up(p.astype(np.float64)) / np.log(10)
            for col, v in zip(cols, (x.size, add_up(n > 0).astype(np.int64), base, own), strict=True):
                col.append(v)
            ids.append(b.column("__key"))
        return pa.Table.from_arrays([pa.chunked_array(ids), *[pa.array(np.concatenate(v)) for v in cols]],
                                    ["__key", "n_tokens", "n_known", "base_score", "score"])

    asked = grouped.groupBy("__group").applyInArrow(ask, _ASK)
    told = asked.groupBy("bucket").cogroup(counts.select("bucket", "blob").groupBy("bucket")).applyInArrow(tell, _TOLD)
    out = grouped.groupBy("__group").cogroup(told.groupBy("__group")).applyInArrow(rate, f"__key {kind}, {_OUT}")
    return out.withColumnRenamed("__key", key)


def score_texts(df: DataFrame, learns: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Learns from the rows that ``learns`` and scores every row's whole text: ``key``, n_tokens, n_known,
    train_tokens, base_score, score.

    A null text is empty: its one token is the end. With nothing to learn from, score is base_score. Rows without
    an id, with one id or repeated are scored each; other columns play no part, whatever their names.
    """
    total = df.agg(F.sum(F.octet_length(F.col(text)).cast("long")).alias("b")).first()["b"]
    groups = groups_for(total, GROUP_BYTES, 48)
    fold = df.where(learns).select(F.col(text).alias("text"))
    counts = count_tokens(fold, groups)
    c = classes(counts)
    model = fit(training_shards(count_trigrams(fold, c, groups)), c) if c.tokens else None
    return score(df, counts, groups, c, model, groups, key, text).withColumn("train_tokens", F.lit(c.tokens).cast("long"))


def query(spark, sf_dir: str) -> DataFrame:
    """op4: the log10 probability of every document, learned from nine tenths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score_texts(docs, id_remainder("doc_id", 10) != 0)
    return out.select("doc_id", (id_remainder("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
