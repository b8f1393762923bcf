"""Packing token sequences: sum-of-squares placement of document pieces.

A document's ids are cut into pieces of at most ``capacity``; only documents longer than
that are cut. Pieces go one by one to the open bin (or a new one) for which the sum over
all residual gaps of the squared number of open bins with that gap becomes smallest.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import groups_for, ragged, slices, table, text_buffers
from .words import LOWER, Known, boundaries, distinct, split

CAPACITY = 2048
#: Id that ends each document.
END = 0
#: Pieces that one task packs together; more groups, not larger ones, hold more data.
GROUP = 40_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordIds:
    """Ids of texts, each distinct white-space-delimited word tokenized once.

    The vocabulary's pre-tokenizer never joins characters across white space and its
    normalizer acts within a word, so a text's ids are those of its words in a row. It also
    starts a new token at a stop that follows a letter, and ignores case, so words are cut
    there and met in lower case. Not so words that may hold a control token, which minds case, or
    a combining mark: the normalizer composes letters and marks before it lowers them, and some
    compose in lower case only. No character below U+0300, the last of two bytes led by 0xCB, is one.
    """

    letter = np.zeros(256, bool)
    letter[65:91] = letter[97:123] = True
    stop = np.zeros(256, bool)
    stop[list(b".,;:!?")] = True

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.known = Known(1_000_000)
        self._reset()

    def _reset(self) -> None:
        self.known.clear()
        self.flat, self.ptr, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    @staticmethod
    def lowered(data: np.ndarray, off: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """ASCII letters in lower case in every word that it makes no difference to."""
        low = LOWER[data]
        as_is = np.flatnonzero(data >= 0xCC)
        as_is = np.union1d(as_is, np.flatnonzero((data[:-1] == 60) & (data[1:] == 124)))
        if len(as_is):
            start, end, _ = boundaries(data, off, cuts)
            word = np.unique(np.searchsorted(start, as_is, side="right") - 1)
            at = ragged(start[word], end[word] - start[word])
            low[at] = data[at]
        return low

    def encode(self, data: np.ndarray, off: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, ``end`` closing each row, and the rows' offsets among them."""
        n = len(off) - 1
        cuts = np.flatnonzero(self.stop[data[1:]] & self.letter[data[:-1]]) + 1
        data = self.lowered(data, off, cuts)
        raw = data.tobytes()
        w = split(data, off, cuts)
        first, inverse = distinct(w.h1, w.h2)
        if self.known.size > self.known.most:
            self._reset()
        rows = self.known.find(w.h1[first], w.h2[first])
        miss = np.flatnonzero(rows < 0)
        if len(miss):
            a, b = w.start[first[miss]].tolist(), w.end[first[miss]].tolist()
            got = self.tokenizer.encode_batch_fast(
                [raw[x:y].decode("utf-8", "replace") for x, y in zip(a, b, strict=True)], add_special_tokens=False)
            ids = [e.ids for e in got]
            size = np.array([len(i) for i in ids], np.int64)
            ptr = len(self.flat) + np.cumsum(size) - size
            self.flat = np.concatenate([self.flat, np.fromiter((x for i in ids for x in i), np.int32, int(size.sum()))])
            self.ptr, self.size = np.concatenate([self.ptr, ptr]), np.concatenate([self.size, size])
            rows[miss] = self.known.add(w.h1[first[miss]], w.h2[first[miss]])
        row = rows[inverse]
        size = self.size[row]
        per = np.bincount(w.doc, weights=size, minlength=n).astype(np.int64)
        out_off = np.zeros(n + 1, np.int64)
        np.cumsum(per + 1, out=out_off[1:])
        out = np.full(int(out_off[-1]), end, np.int32)
        mask = np.ones(len(out), bool)
        mask[out_off[1:] - 1] = False
        out[mask] = self.flat[ragged(self.ptr[row], size)]
        return out, out_off


PIECES = "doc_id {key}, piece int, start long, length long, ids_crc32 long"


def pieces(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text",
           capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """The pieces of every row's whole text: number, start among its ids, length, CRC-32 of the ids.

    A null or empty text has one piece, the end id alone. One pass, no shuffle.
    """
    kind = df.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordIds(vocabulary)
        for b in slices(batches, "text", 3 << 19):
            ids, off = coder.encode(*text_buffers(b.column("text")), end)
            size = np.diff(off)
            count = -(-size // capacity)
            row = np.repeat(np.arange(len(size)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * capacity
            length = np.minimum(capacity, size[row] - start)
            at = (off[row] + start).tolist()
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * x:4 * (x + y)]) for x, y in zip(at, length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length),
                 pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(cut, PIECES.format(key=kind))


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset in it for each size (1 to ``capacity``), the largest placed first.

    Among bins that serve equally well the fullest takes the piece, an open bin before a new one.
    """
    bins, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    open_bins = np.zeros(capacity + 1, np.int64)  # by gap; those without a gap don't count
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    used = 0
    never = np.iinfo(np.int64).max
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        here = open_bins[s:capacity]
        gap = 0
        if s < capacity:
            cost = 2 * (open_bins[:capacity - s] - here) + 2
            cost[0] = 1 - 2 * here[0]
            cost[here == 0] = never
            best = int(cost.argmin())
            if cost[best] <= 2 * open_bins[capacity - s] + 1:
                gap = s + best
        if gap:
            at = stacks[gap].pop()
            open_bins[gap] -= 1
        else:
            at, gap, used = used, capacity, used + 1
        bins[i], offset[i] = at, capacity - gap
        if gap > s:
            stacks[gap - s].append(at)
            open_bins[gap - s] += 1
    return bins, offset


def pack(df: DataFrame, groups: int, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """``df`` (one row per piece) with ``sequence_id`` and ``offset``.

    Pieces are dealt to ``groups`` by a hash of all their columns, salted by the row's own
    place so that repeated rows spread too; each group is packed in one task.
    """
    schema = df.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema
    names = df.columns

    def place(t: pa.Table) -> pa.Table:
        sizes = t.column(length).to_numpy()
        bins, offset = sum_of_squares(sizes, capacity)
        group = t.column("__group")[0].as_py()
        return t.select(names).append_column("sequence_id", pa.array(bins + (group << 32))).append_column("offset", pa.array(offset))

    salted = df.withColumn("__group", F.pmod(F.xxhash64(*names, F.monotonically_increasing_id()), F.lit(groups)))
    return salted.groupBy("__group").applyInArrow(place, schema)


def pack_documents(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text",
                   capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all rows of ``df``, packed. The number of groups follows rows and text bytes."""
    total = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(text))).alias("b")).first()
    # a byte yields one id at most
    expected = (total["n"] or 0) + (total["b"] or 0) / (4 * capacity)
    return pack(pieces(df, vocabulary, key, text, capacity), groups_for(expected, GROUP), capacity)


def query(spark, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """op2: every document's pieces and their places in sequences of at most 2048 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary or default_vocabulary())
