"""Removal of repeated byte strings by bucket-pointer refinement.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier in the
corpus. Equal strings contain the same least q-gram (by hash), so the strings whose least
q-gram is the same occurrence form a short run, and runs meet by that q-gram's hash:

1. texts are dealt to groups by id; each group tells the q-grams of its runs;
2. q-grams met in two places go back to the groups that have them;
3. groups send the bytes of those runs, equal ones once, to a task per bucket of q-grams;
4. there, buckets of 8-byte grams are refined by sorting on the bucket identifiers found
   8, 16 and 32 bytes later, until buckets of equal strings of the full length remain;
   all but the earliest of a bucket are repeats, and go back to their group;
5. each group takes the repeats out of its texts.

Runs of a q-gram that very many places have (a common line in ever new surroundings) are not
sent to one task: each of their strings is sent as a 128-bit hash, to the task of that hash.

"Earlier" is the smaller id, then the smaller start. Rows with one id are ordered by text.
Null ids come first; null texts are empty. Everything is judged on the input.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bucket, groups_for, pack, ragged, table, text_buffers, unpack
from .words import BASES, MASK, VALUES, Prefix, mix

LENGTH = 100
#: Bytes of the grams that runs meet by.
GRAM = 32
#: Bytes of text in a group of documents, about; sets the number of groups and buckets, not the result.
GROUP_BYTES = 2 << 20
#: Runs of one q-gram from which their strings are sent one by one.
COMMON = 2000
_BLOCK_BITS = 13
_COPY_BITS = 40
_NULL = -(1 << 63)


def runs(data: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, start and number of strings of each run of consecutive starts with one least gram.

    Of equal grams in a string the last counts, so two equal strings never share a run. The
    key is the gram's hash without the low bits, which tell occurrences apart in a block.
    """
    starts = len(data) - length + 1
    span = length - gram + 1  # grams in a string
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if starts <= 0:
        return none
    h, have = VALUES[0][data], 1
    while have < gram:  # a power of two
        h = h[:-have] * np.uint64(pow(BASES[0], have, MASK + 1)) + h[have:]
        have *= 2
    h = mix(h)
    size = 1 << _BLOCK_BITS
    stride = size - span + 1
    blocks = -(-starts // stride)
    h = np.concatenate([h, np.full((blocks - 1) * stride + size - len(h), MASK, np.uint64)]) if (blocks - 1) * stride + size > len(h) else h
    view = np.lib.stride_tricks.as_strided(h, (blocks, size), (stride * 8, 8), writeable=False)
    place = np.arange(size - 1, -1, -1, dtype=np.uint64)
    least = np.empty((blocks, stride), np.uint64)
    for a in range(0, blocks, 8):
        c = view[a:a + 8] & np.uint64(MASK - size + 1)
        c |= place
        k = 1
        while 2 * k <= span:
            c = np.minimum(c[:, :-k], c[:, k:])
            k *= 2
        if k < span:
            c = np.minimum(c[:, :k - span], c[:, span - k:])
        least[a:a + 8] = c
    flat = least.reshape(-1)[:starts]
    valid = np.ones(starts, bool)
    tail = np.maximum(off[:-1], off[1:] - length + 1)
    outside = ragged(tail, off[1:] - tail)
    valid[outside[outside < starts]] = False
    new = np.ones(starts, bool)
    new[1:] = (flat[1:] != flat[:-1]) | (valid[1:] != valid[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, starts))
    keep = valid[at]
    at, count = at[keep], count[keep]
    return flat[at] >> np.uint64(_BLOCK_BITS), at, count


def refine(body: np.ndarray, end: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each of the ``starts``, the bucket of its string of ``length`` bytes; equal strings, equal bucket.

    ``end``: for each byte, where its own item ends; strings don't cross. Bucket identifiers
    of depth d are refined to 2d by sorting on (identifier here, identifier d later); only
    buckets of several positions are sorted, the others keep their identifier. Updated
    identifiers are reused from one depth to the next, not within a depth: one that is refined
    further than its depth would tell apart strings that agree in all of their ``length`` bytes.
    """
    n = len(body)
    room = end - np.arange(n)
    wide = np.concatenate([body, np.zeros(8, np.uint8)]).astype(np.uint64)
    value = np.zeros(n, np.uint64)
    for j in range(8):
        value = value << np.uint64(8) | wide[j:j + n]
    rank = np.full(n, -1, np.int64)
    ok = np.flatnonzero(room >= 8)
    _, rank[ok] = np.unique(value[ok], return_inverse=True)
    depth = 8

    def deeper(rank: np.ndarray, at: np.ndarray, later: int) -> np.ndarray:
        """Identifiers of the positions ``at``, refined by those ``later`` on."""
        out = rank[at].copy()
        size = np.bincount(out)
        several = np.flatnonzero(size[out] > 1)
        here = at[several]
        pair = rank[here].astype(np.uint64) << np.uint64(32) | rank[here + later].astype(np.uint64)
        _, inverse = np.unique(pair, return_inverse=True)
        out[several] = len(size) + inverse
        return out

    while 2 * depth <= length:
        at = np.flatnonzero(room >= 2 * depth)
        finer = np.full(n, -1, np.int64)
        finer[at] = np.unique(deeper(rank, at, depth), return_inverse=True)[1]
        rank, depth = finer, 2 * depth
    return deeper(rank, starts, length - depth) if depth < length else rank[starts]


def _ordered(t: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A group's rows in the corpus order: table, text bytes, offsets, ids, number of the copy among equal ids."""
    ids = t.column("__key").to_numpy()
    order = np.argsort(ids, kind="stable")
    same = np.flatnonzero(np.diff(ids[order]) == 0)
    if len(same):
        texts = t.column("__text").fill_null("").to_pylist()
        order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], texts[i])), np.int64)
    t = t.take(pa.array(order))
    ids = ids[order]
    first = np.concatenate([[True], ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, bool)
    copy = np.arange(len(ids)) - np.maximum.accumulate(np.where(first, np.arange(len(ids)), 0))
    data, off = text_buffers(t.column("__text"))
    return t, data, off, ids, copy


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(key) % np.uint64(buckets)).astype(np.int64)


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


_ASK = pa.schema([("bucket", pa.int32()), ("src", pa.int32()), ("blob", pa.binary())])
_TOLD = pa.schema([("__group", pa.int32()), ("blob", pa.binary())])
_SEND = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("src", pa.int32()), ("blob", pa.binary()), ("body", pa.binary())])
_RUNS, _STRINGS, _KNOWN = 0, 1, 2


def _sql_schema(s: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'binary' if pa.types.is_binary(f.type) else 'int'}" for f in s)


def repeats(grouped: DataFrame, buckets: int, common: int = COMMON) -> DataFrame:
    """For texts dealt to ``__group`` (columns ``__key``, ``__text``): packed repeats (id, place, strings) by group."""

    def ask(t: pa.Table) -> pa.Table:
        src = t.column("__group")[0].as_py()
        _, data, off, _, _ = _ordered(t)
        key, count = np.unique(runs(data, off)[0], return_counts=True)
        count = np.minimum(count, 65535).astype(np.uint16)
        return _rows(_ASK, [(b, src, pack(key[i], count[i])) for b, i in by_bucket(_bucket(key, buckets))])

    def tell(t: pa.Table) -> pa.Table:
        got = [unpack(x, "u8", "u2") for x in t.column("blob").to_pylist()]
        src = np.repeat(t.column("src").to_numpy(), [len(g[0]) for g in got])
        key = np.concatenate([g[0] for g in got])
        count = np.concatenate([g[1] for g in got]).astype(np.int64)
        _, inverse = np.unique(key, return_inverse=True)
        total = np.bincount(inverse, weights=count)[inverse]
        again = np.flatnonzero(total > 1)
        many = (total > common).astype(np.uint8)
        return _rows(_TOLD, [(g, pack(key[again[i]], many[again[i]])) for g, i in by_bucket(src[again])])

    def send(t: pa.Table, told: pa.Table) -> pa.Table:
        if not t.num_rows or not told.num_rows:
            return _rows(_SEND, [])
        src = t.column("__group")[0].as_py()
        _, data, off, ids, copy = _ordered(t)
        got = [unpack(x, "u8", "u1") for x in told.column("blob").to_pylist()]
        known = np.concatenate([g[0] for g in got])
        order = np.argsort(known)
        known, many = known[order], np.concatenate([g[1] for g in got])[order].astype(bool)
        key, start, count = runs(data, off)
        at = np.minimum(np.searchsorted(known, key), len(known) - 1)
        hit = known[at] == key
        key, start, count, many = key[hit], start[hit], count[hit], many[at[hit]]
        doc = np.searchsorted(off, start, side="right") - 1
        place = (copy[doc] << _COPY_BITS) + start - off[doc]
        p1, p2 = Prefix(data, 0), Prefix(data, 1)
        stop = start + count + LENGTH - 1
        first, again = _firsts(p1.of(start, stop), p2.of(start, stop))
        out = [(src % buckets, _KNOWN, src, pack(ids[doc[again]], place[again], count[again]), b"")]
        runs_at = first[~many[first]]
        size = count + LENGTH - 1
        for b, i in by_bucket(_bucket(key[runs_at], buckets)):
            i = runs_at[i]
            out.append((b, _RUNS, src, pack(key[i], ids[doc[i]], place[i], count[i]), pack(data[ragged(start[i], size[i])])))
        common_at = first[many[first]]
        if len(common_at):
            row = np.repeat(common_at, count[common_at])
            one = ragged(start[common_at], count[common_at])
            h1, h2 = p1.of(one, one + LENGTH), p2.of(one, one + LENGTH)
            where = place[row] + one - start[row]
            one_first, one_again = _firsts(h1, h2)
            out.append((src % buckets, _KNOWN, src, pack(ids[doc[row[one_again]]], where[one_again], np.ones(len(one_again), np.int64)), b""))
            for b, i in by_bucket(_bucket(h1[one_first], buckets)):
                i = one_first[i]
                out.append((b, _STRINGS, src, pack(h1[i], h2[i], ids[doc[row[i]]], where[i]), b""))
        return _rows(_SEND, out)

    def meet(t: pa.Table) -> pa.Table:
        out: list[tuple] = []
        kind, srcs, blobs, bodies = (t.column(c).to_pylist() for c in ("kind", "src", "blob", "body"))
        out += [(s, b) for k, s, b in zip(kind, srcs, blobs, strict=True) if k == _KNOWN]

        def gathered(which: int, *types: str) -> tuple[np.ndarray, list[np.ndarray]]:
            got = [(s, unpack(b, *types)) for k, s, b in zip(kind, srcs, blobs, strict=True) if k == which]
            if not got:
                return np.zeros(0, np.int64), [np.zeros(0, x) for x in types]
            return (np.repeat([s for s, _ in got], [len(g[0]) for _, g in got]),
                    [np.concatenate([g[i] for _, g in got]) for i in range(len(types))])

        def tell_back(src, ids, place, count) -> None:
            out.extend((g, pack(ids[i], place[i], count[i])) for g, i in by_bucket(src))

        src, (h1, h2, ids, place) = gathered(_STRINGS, "u8", "u8", "i8", "i8")
        if len(src):
            order = np.lexsort((place, ids))
            _, again = _firsts(h1[order], h2[order])
            again = order[again]
            tell_back(src[again], ids[again], place[again], np.ones(len(again), np.int64))
        src, (key, ids, place, count) = gathered(_RUNS, "u8", "i8", "i8", "i8")
        if len(src):
            body = np.concatenate([unpack(b, "u1")[0] for k, b in zip(kind, bodies, strict=True) if k == _RUNS])
            size = count + LENGTH - 1
            ptr = np.cumsum(size) - size
            order = np.lexsort((place, ids))
            src, key, ids, place, count, size, ptr = (x[order] for x in (src, key, ids, place, count, size, ptr))
            whole = np.zeros((len(src), int(size.max()) + 1), np.uint8)
            whole[:, -1] = size - LENGTH  # runs of different lengths differ (at most 69 strings each)
            cells = np.arange(whole.shape[1]) < size[:, None]
            whole[cells] = body[ragged(ptr, size)]
            _, first, inverse = np.unique(whole.view(f"V{whole.shape[1]}").reshape(-1), return_index=True, return_inverse=True)
            copy = np.ones(len(src), bool)
            copy[first] = False
            tell_back(src[copy], ids[copy], place[copy], count[copy])
            one = np.sort(first)
            _, back, together = np.unique(key[one], return_inverse=True, return_counts=True)
            one = one[together[back] > 1]
            if len(one):
                n = size[one]
                text = body[ragged(ptr[one], n)]
                ends = np.cumsum(n)
                starts = ragged(ends - n, count[one])
                bucket = refine(text, np.repeat(ends, n), starts)
                _, earliest = np.unique(bucket, return_index=True)
                again = np.ones(len(starts), bool)
                again[earliest] = False
                item = np.repeat(np.arange(len(one)), count[one])
                nth = starts - (ends - n)[item]
                opens = again & ~np.concatenate([[False], again[:-1] & (item[1:] == item[:-1])])
                at = np.flatnonzero(opens)
                long = np.add.reduceat(again.astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
                # reduceat sums up to the next opening; between lie only positions that are not repeats
                i = one[item[at]]
                tell_back(src[i], ids[i], place[i] + nth[at], long)
        return _rows(_TOLD, out)

    asked = grouped.groupBy("__group").applyInArrow(ask, _sql_schema(_ASK))
    told = asked.groupBy("bucket").applyInArrow(tell, _sql_schema(_TOLD))
    sent = grouped.groupBy("__group").cogroup(told.groupBy("__group")).applyInArrow(send, _sql_schema(_SEND))
    return sent.groupBy("bucket").applyInArrow(meet, _sql_schema(_TOLD))


def _firsts(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the first of each distinct 128-bit hash, in their order, and of all others."""
    from .words import distinct

    first, _ = distinct(h1, h2)
    rest = np.ones(len(h1), bool)
    rest[first] = False
    return np.sort(first), np.flatnonzero(rest)


def remove(df: DataFrame, key: str = "doc_id", text: str = "text", group_bytes: int = GROUP_BYTES, common: int = COMMON,
           keep_text: bool = True) -> DataFrame:
    """``df`` with n_bytes, n_removed, n_spans and kept_sha256 for every row, and with what is left of its text
    (bytes that no longer form a character are dropped from it, not from the digest). A column of ``df``
    with the name of one of these is replaced; without ``keep_text`` the text column is left out."""
    total = df.agg(F.sum(F.octet_length(F.col(text)).cast("long")).alias("b")).first()["b"]
    n = groups_for(total, group_bytes, 48)
    names = df.columns
    kinds = df.schema[key].dataType.simpleString()
    if kinds not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{key} must be an integer: its order says which of two equal strings is earlier")
    place = F.coalesce(F.col(key).cast("long"), F.lit(_NULL))
    grouped = df.select("*", place.alias("__key"), F.coalesce(F.col(text), F.lit("")).alias("__text"),
                        F.pmod(F.xxhash64(place), F.lit(n)).cast("int").alias("__group"))
    grouped = grouped.drop(text)
    digests = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    out_cols = [c for c in names if c != text and c.lower() not in digests]

    def take_out(t: pa.Table, found: pa.Table) -> pa.Table:
        t, data, off, ids, copy = _ordered(t)
        got = [unpack(x, "i8", "i8", "i8") for x in found.column("blob").to_pylist()]
        got = [g for g in got if len(g[0])]
        gone = np.zeros(len(data) + 1, np.int64)
        if got:
            doc_id, where, count = (np.concatenate([g[i] for g in got]) for i in range(3))
            row = np.searchsorted(ids, doc_id) + (where >> _COPY_BITS)
            start = off[row] + (where & ((1 << _COPY_BITS) - 1))
            np.add.at(gone, start, 1)
            np.add.at(gone, start + count + LENGTH - 1, -1)
        gone = np.cumsum(gone[:-1]) > 0
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        inner = off[:-1][np.diff(off) > 0]
        opens[inner] = gone[inner]
        total, spans = np.concatenate([[0], np.cumsum(gone)]), np.concatenate([[0], np.cumsum(opens)])
        kept = data[~gone].tobytes()
        kept_off = (off - total[off]).tolist()
        left = [kept[a:b] for a, b in zip(kept_off[:-1], kept_off[1:], strict=True)]
        cols = [t.column(c) for c in out_cols]
        if keep_text:
            cols.append(pa.array([x.decode("utf-8", "ignore") for x in left], pa.string()))
        cols += [pa.array(np.diff(off)), pa.array(np.diff(total[off]).astype(np.int64)), pa.array(np.diff(spans[off]).astype(np.int64)),
                 pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string())]
        return pa.Table.from_arrays(cols, names=[*out_cols, *([text] if keep_text else []), *digests])

    schema = df.select(*out_cols, *([text] if keep_text else [])).withColumns({
        "n_bytes": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"), "n_spans": F.lit(0).cast("long"), "kept_sha256": F.lit("")}).schema
    found = repeats(grouped, n, common)  # the same rows each time, so that they are dealt to the groups once
    out = grouped.groupBy("__group").cogroup(found.groupBy("__group")).applyInArrow(take_out, schema)
    return out.select(*[c for c in names if c in out_cols or keep_text and c == text], *digests)


def query(spark, sf_dir: str) -> DataFrame:
    """op5: every document without the strings of 100 bytes that also start earlier."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove(docs, keep_text=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
