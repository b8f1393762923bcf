"""Piece encoding and decoding by a streaming Viterbi search.

A text is cut before each run of spaces and around line breaks, which no piece crosses,
so its best segmentation is that of its parts in a row. Each part is a stream of bytes:
per byte the best path ending there is kept for the last ``longest piece`` positions; when
the paths of all those positions lead back to one boundary, the ids up to it are committed
and their back pointers dropped.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pieces as P
from .common import ragged, slices, table, text_buffers, with_columns
from .words import Known, Prefix, distinct

BREAK = 0x0A
BLANK = 0x20


def parts(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each part: spaces then other bytes, or one line break."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    blank, line = data == BLANK, data == BREAK
    cut[:n] |= line
    cut[1:n] |= (blank[1:] & ~blank[:-1]) | line[:-1]
    start = np.flatnonzero(cut[:n])
    end = np.append(start[1:], n)
    return start, end, np.searchsorted(off, start, side="right") - 1


def segment(v: P.Pieces, m: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best pieces of the streams in ``m`` (rows of bytes, ``size`` bytes each).

    Returns ids, and how many each stream has. Equal scores: the longest last piece. Streams
    run side by side; ``first`` is the position of the oldest column still kept.
    """
    n, width = m.shape
    window = v.longest
    best = np.zeros((window + 1, n))  # ring by position
    starts = np.zeros((n, 0), np.int32)  # column c: where the best piece ending at first + c + 1 starts
    ids = np.zeros((n, 0), np.int32)
    first = 0
    committed = np.zeros(n, np.int64)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    grow_s, grow_i = [], []

    def commit(lane: np.ndarray, upto: np.ndarray) -> None:
        at = upto.copy()
        while len(lane):
            col = at - first - 1
            out.append((lane, at.copy(), ids[lane, col]))
            at = starts[lane, col].astype(np.int64)
            more = at > committed[lane]
            lane, at = lane[more], at[more]

    for i in range(1, width + 1):
        live = size >= i
        score = np.full(n, -np.inf)
        since = np.zeros(n, np.int32)
        piece = np.zeros(n, np.int32)
        h = np.zeros(n, np.uint64)
        for back in range(1, min(i, window) + 1):
            h = v.extend(h, m[:, i - back])
            row = v.rows(h)
            hit = np.flatnonzero(row >= 0)
            s = best[(i - back) % (window + 1), hit] + v.scores[row[hit]]
            better = s >= score[hit]
            hit, s = hit[better], s[better]
            score[hit], since[hit], piece[hit] = s, i - back, v.ids[row[hit]]
        best[i % (window + 1)] = score
        grow_s.append(since)
        grow_i.append(piece)
        if i % window == 0 or i == width:
            starts = np.hstack([starts, np.stack(grow_s, axis=1)])
            ids = np.hstack([ids, np.stack(grow_i, axis=1)])
            grow_s, grow_i = [], []
            ended = np.flatnonzero((size <= i) & (committed < size))
            commit(ended, size[ended])
            committed[ended] = size[ended]
            if i == width:
                break
            # survivors: the last ``window`` positions, from which a later piece can still start
            lane = np.flatnonzero(live & (size > i))
            ptr = np.arange(max(0, i - window + 1), i + 1)[None, :].repeat(len(lane), axis=0)
            ptr = np.maximum(ptr, committed[lane, None])
            while True:
                top = ptr.max(axis=1)
                apart = np.flatnonzero(ptr.min(axis=1) < top)
                if not len(apart):
                    break
                move = ptr[apart] == top[apart, None]
                back_to = starts[lane[apart], top[apart] - first - 1].astype(np.int64)
                ptr[apart] = np.where(move, back_to[:, None], ptr[apart])
            on = np.flatnonzero(top > committed[lane])
            commit(lane[on], top[on])
            committed[lane[on]] = top[on]
            if len(lane):
                drop = int(committed[lane].min()) - first
                starts, ids, first = starts[:, drop:].copy(), ids[:, drop:].copy(), first + drop
    lane = np.concatenate([x[0] for x in out])
    order = np.lexsort((np.concatenate([x[1] for x in out]), lane))
    return np.concatenate([x[2] for x in out])[order], np.bincount(lane, minlength=n)


def segment_long(v: P.Pieces, data: np.ndarray) -> np.ndarray:
    """Best pieces of one long stream: the pieces of a stretch are looked up together, then chosen byte by byte.

    After each stretch the paths that end in the last ``longest`` positions are led back to where they meet; the
    ids up to there are committed and their back pointers dropped.
    """
    scores, window = np.append(v.scores, -np.inf), v.longest  # row -1: no piece
    last = np.full(window, -np.inf)
    last[-1] = 0.0
    since, piece = np.zeros(0, np.int64), np.zeros(0, np.int32)  # of the positions from ``first`` + 1 on
    first, out = 0, []
    for a, rows in P.stretches(v, data):
        n = len(rows)
        best = np.concatenate([last, np.zeros(n)])
        choice = np.empty(n, np.int64)
        weight = scores[rows]
        for i in range(n):
            s = best[i:i + window] + weight[i]
            c = s.argmax()  # of equal ones the longest piece
            choice[i] = c
            best[i + window] = s[c]
        last = best[n:].copy()
        since = np.concatenate([since, a + np.arange(n) + 1 + choice - window])
        piece = np.concatenate([piece, v.ids[rows[np.arange(n), choice]]])
        end = a + n
        paths = {end} if end == len(data) else set(range(max(first, end - window + 1), end + 1))
        while len(paths) > 1:  # the furthest goes back until all are one
            top = max(paths)
            paths.remove(top)
            paths.add(int(since[top - first - 1]))
        meet = paths.pop()
        ids, at = [], meet
        while at > first:
            ids.append(piece[at - first - 1])
            at = int(since[at - first - 1])
        out.append(np.array(ids[::-1], np.int32))
        since, piece, first = since[meet - first:].copy(), piece[meet - first:].copy(), meet
    return np.concatenate(out)


class PieceIds:
    """Ids of texts, each distinct part segmented once."""

    def __init__(self, vocabulary: str):
        self.v = P.load(vocabulary)
        self.known = Known()
        self._reset()

    def _reset(self) -> None:
        self.known.clear()
        self.flat, self.ptr, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, and the rows' offsets among them."""
        n = len(off) - 1
        start, end, doc = parts(data, off)
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
        h1, h2 = Prefix(data, 0).of(start, end), Prefix(data, 1).of(start, end)
        first, inverse = distinct(h1, h2)
        if self.known.size > self.known.most:
            self._reset()
        rows = self.known.find(h1[first], h2[first])
        miss = np.flatnonzero(rows < 0)
        s, size = start[first[miss]], (end - start)[first[miss]]
        number = self.known.add(h1[first[miss]], h2[first[miss]])
        rows[miss] = number
        ptr, count, at = np.zeros(len(miss), np.int64), np.zeros(len(miss), np.int64), len(self.flat)
        got = [self.flat]
        for i in np.flatnonzero(size > P.LONG):
            ids = segment_long(self.v, data[s[i]:s[i] + size[i]])
            ptr[i], count[i] = at, len(ids)
            got.append(ids)
            at += len(ids)
        short = np.flatnonzero(size <= P.LONG)
        for lane in P.lanes(size[short], 1 << 18):
            part = short[lane]
            ids, k = segment(self.v, P.block(data, s[part], size[part], lead=False), size[part])
            ptr[part], count[part] = at + np.cumsum(k) - k, k
            got.append(ids)
            at += len(ids)
        self.flat = np.concatenate(got)
        self.ptr, self.size = np.concatenate([self.ptr, ptr]), np.concatenate([self.size, count])
        row = rows[inverse]
        out_off = np.zeros(n + 1, np.int64)
        np.cumsum(np.bincount(doc, weights=self.size[row], minlength=n).astype(np.int64), out=out_off[1:])
        return self.flat[ragged(self.ptr[row], self.size[row])], out_off


class PieceText:
    """Texts of ids: the pieces' bytes joined."""

    def __init__(self, vocabulary: str):
        v = P.load(vocabulary)
        self.flat = np.frombuffer(b"".join(v.bytes_of), np.uint8)
        self.size = np.array([len(b) for b in v.bytes_of], np.int64)
        self.ptr = np.cumsum(self.size) - self.size

    def decode(self, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the rows, and the rows' offsets among them. An id outside the vocabulary raises IndexError."""
        size = self.size[ids]
        ends = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(size, out=ends[1:])
        return self.flat[ragged(self.ptr[ids], size)], ends[off]


def _list_array(flat: np.ndarray, off: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(flat, pa.int32()))


def encode(df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of each whole text. A null or empty text has no ids; a column ``ids`` is replaced. One pass, no shuffle."""
    schema = df.withColumn(ids, F.lit(None).cast("array<int>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = PieceIds(vocabulary)
        for b in slices(batches, text, 3 << 20):
            got = _list_array(*coder.encode(*text_buffers(b.column(b.schema.get_field_index(text)))))
            yield with_columns(b, schema.names, {ids: got})

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of each row of ids. Null ids, and null ids within a row, give no bytes;
    bytes that are not UTF-8 become the replacement character; a column ``text`` is replaced."""
    schema = df.withColumn(text, F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = PieceText(vocabulary)
        for b in batches:
            rows = b.column(b.schema.get_field_index(ids)).to_pylist()
            kept = [[x for x in r or () if x is not None] for r in rows]
            off = np.zeros(len(kept) + 1, np.int64)
            np.cumsum([len(r) for r in kept], out=off[1:])
            raw, at = coder.decode(np.fromiter((x for r in kept for x in r), np.int64, int(off[-1])), off)
            raw = raw.tobytes()
            texts = [raw[x:y].decode("utf-8", "replace") for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield with_columns(b, schema.names, {text: pa.array(texts, pa.string())})

    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: number and CRC-32 (little-endian 32-bit) of the ids, and CRC-32 and length of the bytes decoded from them.

    Encodes and decodes in one pass, so the ids never leave the task.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, reader = PieceIds(vocabulary), PieceText(vocabulary)
        for b in slices(batches, "text", 3 << 20):
            data, at = text_buffers(b.column("text"))
            ids, off = coder.encode(data, at)
            raw = memoryview(ids.astype("<u4").tobytes())
            back, back_off = reader.decode(ids, off)
            there, given = memoryview(back.tobytes()), memoryview(data.tobytes())
            o, p, q = off.tolist(), back_off.tolist(), at.tolist()
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array(np.diff(off)),
                pa.array([zlib.crc32(raw[4 * x:4 * y]) for x, y in zip(o[:-1], o[1:], strict=True)], pa.int64()),
                pa.array(np.diff(back_off)),
                pa.array([zlib.crc32(there[x:y]) for x, y in zip(p[:-1], p[1:], strict=True)], pa.int64()),
                pa.array([there[p[j]:p[j + 1]] == given[q[j]:q[j + 1]] for j in range(b.num_rows)], pa.bool_()),
            ], ["doc_id", "n_ids", "ids_crc32", "decoded_bytes", "decoded_crc32", "lossless"])

    rows = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_ids long, ids_crc32 long, decoded_bytes long, decoded_crc32 long, lossless boolean")


def query(spark, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """op6: ids of every whole document, and the text read back from them."""
    return round_trip(table(spark, sf_dir, "documents"), vocabulary or P.default_vocabulary())
