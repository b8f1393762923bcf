"""Personal data in texts: labelers vote, expectation-maximisation weighs them, a classifier decides.

Candidates of four kinds come from the bytes of whole texts:

* base matches: the fixed patterns below with their checks; these are always reported;
* matches of those patterns that fail their check (Luhn sum, parts over 255, number of digits): known negatives;
* other ways to write such data: obfuscated addresses (``name at site dot org``), addresses without a dot, IPv6
  addresses, telephone numbers without ``+``.

Six labelers (regex, gazetteer and context ones) vote +1, 0 or -1 on each. The votes of all candidates are counted
by pattern in the tasks and summed by Spark; there are at most 3^6 patterns a kind. Expectation-maximisation over
these counts gives each labeler's reliability and each pattern's probability. A logistic classifier over
discrete span features then learns those probabilities, again from counts over all candidates (at most
``4 * 3^5 * 2^2 * 4^2`` rows). A second pass over the texts finds the candidates again and keeps those that are
base matches or that the classifier gives ``ACCEPT`` at least, where they overlap nothing reported before.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, table, text_buffers
from .words import LOWER

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: Probability from which a span that is no base match is reported.
ACCEPT = 0.9
LABELERS = ("form", "writing", "gazetteer", "before", "edges", "company")
#: Bytes around a span in which context labelers look.
NEAR = 40

# --- fixed values: gazetteers and context words --------------------------------------------------
TOP_LEVEL = set(
    "com org net edu gov mil int info biz name io co app dev ai me tv eu at au be br ca ch cn cz de dk es fi fr gr hu ie il in it jp kr lu mx nl no nz "
    "pl pt ro ru se sk tr tw ua uk us za".split())
#: Country calling codes by their first digits.
CALLING = set("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
#: First digits of card issuers and the lengths they use.
ISSUERS = (("4", (13, 16, 19)), ("51", (16,)), ("52", (16,)), ("53", (16,)), ("54", (16,)), ("55", (16,)), ("22", (16,)), ("23", (16,)), ("24", (16,)),
           ("25", (16,)), ("26", (16,)), ("27", (16,)), ("34", (15,)), ("37", (15,)), ("36", (14,)), ("38", (14,)), ("6011", (16, 19)), ("65", (16, 19)), ("35", (16,)))
BEFORE = (
    {b"mail", b"email", b"contact", b"write", b"address", b"reach", b"correo", b"courriel", b"adresse"},
    {b"ip", b"host", b"server", b"address", b"addr", b"ping", b"gateway", b"dns"},
    {b"card", b"visa", b"mastercard", b"amex", b"credit", b"debit", b"karte", b"carte", b"tarjeta", b"cc"},
    {b"phone", b"tel", b"telephone", b"call", b"mobile", b"cell", b"fax", b"telefon", b"telefono", b"handy"})
NOT_BEFORE = {b"version", b"v", b"isbn", b"issn", b"order", b"invoice", b"token", b"key", b"secret", b"sha", b"id", b"section", b"chapter", b"page", b"date", b"year"}
# -------------------------------------------------------------------------------------------------

_DOMAIN = re.compile(rb"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LABEL = re.compile(rb"[A-Za-z0-9-]++")
_LOCAL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
_AT = rb"(?:\s?[\[({]\s?at\s?[\])}]\s?|\sat\s)"
_DOT = rb"(?:\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s)"
_SPOKEN = re.compile(rb"[a-z0-9_%+-][a-z0-9._%+-]{0,63}" + _AT + rb"[a-z0-9-]{1,63}(?:(?:" + _DOT + rb"|\.)[a-z0-9-]{1,63}){0,4}" + _DOT + rb"[a-z]{2,24}(?![a-z0-9])")
_WORDS = re.compile(rb"[a-z]+")
_is = np.zeros((4, 256), bool)
_is[0, 48:58] = True  # digits
_is[1, np.frombuffer(_LOCAL, np.uint8)] = True
_is[2] = _is[0]
_is[2, [*range(65, 71), *range(97, 103), 58]] = True  # of an IPv6 address
_is[3, np.frombuffer(_LOCAL, np.uint8)] = True
_is[3, [46, 95, 37, 43]] = False  # of a domain's label


class Span(NamedTuple):
    start: int  # bytes
    end: int
    kind: int
    base: bool
    fails: bool  # a base pattern whose check fails


def luhn(digits: bytes) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = (c - 48) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


class _Text:
    """The bytes of a slice of rows."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.data, self.off = data, off
        self.raw, self.low = data.tobytes(), LOWER[data].tobytes()
        self.points = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=self.points[1:])

    def row(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.off, at, side="right") - 1


def _digit_runs(t: _Text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of the runs of digits."""
    inside = _is[0][t.data]
    edge = np.zeros(len(inside) + 1, bool)
    edge[t.off] = True
    before = np.r_[False, inside[:-1]]
    after = np.r_[inside[1:], False]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    return start, np.flatnonzero(inside & (~after | edge[1:])) + 1, t.row(start)


def _chains(start: np.ndarray, end: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last run of each maximal chain of linked runs (``linked[i]``: run i to run i + 1)."""
    cut = np.flatnonzero(~linked)
    return np.r_[0, cut + 1], np.r_[cut, len(start) - 1]


def candidates(t: _Text) -> dict[int, list[Span]]:
    """Spans by row, base matches and look-alikes, by kind and start."""
    found: dict[int, list[Span]] = {}
    add = lambda row, *span: found.setdefault(int(row), []).append(Span(*span))
    if not len(t.data):
        return found
    _emails(t, add)
    start, end, row = _digit_runs(t)
    if len(start):
        gap = start[1:] - end[:-1]
        mark = t.data[np.minimum(end[:-1], len(t.data) - 1)]
        near = row[1:] == row[:-1]
        size = np.r_[0, np.cumsum(end - start)]
        _addresses(t, add, start, end, row, near & (gap == 1) & (mark == 46))
        a, b = _chains(start, end, near & (gap == 1) & ((mark == 32) | (mark == 45)))
        digits = size[b + 1] - size[a]
        for i in np.flatnonzero((digits >= 13) & (digits <= 19)):
            s, e = int(start[a[i]]), int(end[b[i]])
            ok = luhn(re.sub(rb"[^0-9]", b"", t.raw[s:e]))
            add(row[a[i]], s, e, CARD, ok, not ok)
    _phones(t, add)
    if len(start):
        soft = np.isin(mark, (32, 40, 41, 45, 46))
        second = t.data[np.minimum(end[:-1] + 1, len(t.data) - 1)]
        linked = near & (((gap == 1) & soft) | ((gap == 2) & soft & np.isin(second, (32, 40, 45))))
        a, b = _chains(start, end, linked)
        digits = size[b + 1] - size[a]
        for i in np.flatnonzero((digits >= 9) & (digits <= 12) & (b - a >= 2)):
            s, e = int(start[a[i]]), int(end[b[i]])
            if s > t.off[row[a[i]]] and t.data[s - 1] == 40:
                s -= 1
            if not (s > t.off[row[a[i]]] and t.data[s - 1] == 43):
                add(row[a[i]], s, e, PHONE, False, False)
    _long_addresses(t, add)
    for row_, spans in found.items():
        found[row_] = sorted(_apart(spans), key=lambda x: (x.kind, x.start, x.end))
    return found


def _apart(spans: list[Span]) -> list[Span]:
    """Without the look-alikes that overlap a match of a base pattern, such as the numbers of an IP address."""
    if all(s.base or s.fails for s in spans):
        return spans
    held = sorted((s.start, s.end) for s in spans if s.base or s.fails)
    starts, ends = np.array([h[0] for h in held], np.int64), np.maximum.accumulate(np.array([0, *[h[1] for h in held]], np.int64))
    return [s for s in spans if s.base or s.fails or ends[np.searchsorted(starts, s.end)] <= s.start]


def _emails(t: _Text, add) -> None:
    at = np.flatnonzero(t.data == 64)
    if len(at):
        row = t.row(at)
        low, high = t.off[row], t.off[row + 1]
        ok = (at > low) & (at + 1 < high)
        ok &= _is[1][t.data[np.maximum(at - 1, 0)]] & _is[3][t.data[np.minimum(at + 1, len(t.data) - 1)]]
        last = np.maximum(np.r_[0, at[:-1] + 1], low)  # a local part has no @ in it
        free = 0  # the end of the last match
        for p, r, lo, hi in zip(at[ok].tolist(), row[ok].tolist(), last[ok].tolist(), high[ok].tolist(), strict=True):
            lo = max(lo, free)
            m = _DOMAIN.match(t.raw, p + 1, hi)
            end = m.end() if m else _LABEL.match(t.raw, p + 1, hi).end()
            start = lo + len(t.raw[lo:p].rstrip(_LOCAL))
            if start < p:
                add(r, start, end, EMAIL, bool(m), False)
                free = end if m else free
    p = t.low.find(b"dot")
    free = 0
    while p >= 0:
        r = int(t.row(np.array([p]))[0])
        lo, hi = max(int(t.off[r]), free, p - 200), min(int(t.off[r + 1]), p + 100)
        m = _SPOKEN.search(t.low, lo, hi)
        if m and m.end() > p:
            add(r, m.start(), m.end(), EMAIL, False, False)
            free = m.end()
        p = t.low.find(b"dot", max(p + 3, free))


def _addresses(t: _Text, add, start, end, row, linked) -> None:
    """Four numbers of a chain at a time."""
    first, last = _chains(start, end, linked)
    for a, b in zip(first[last - first >= 3].tolist(), last[last - first >= 3].tolist(), strict=True):
        for i in range(a, b - 2, 4):
            parts = [t.raw[start[j]:end[j]].lstrip(b"0") for j in range(i, i + 4)]
            ok = all(len(x) < 3 or len(x) == 3 and int(x) <= 255 for x in parts)
            add(row[i], int(start[i]), int(end[i + 3]), IP, ok, not ok)


def _phones(t: _Text, add) -> None:
    plus = np.flatnonzero(t.data[:-1] == 43)
    plus = plus[_is[0][t.data[plus + 1]]]
    row = t.row(plus)
    for p, r, hi in zip(plus.tolist(), row.tolist(), t.off[row + 1].tolist(), strict=True):
        m = _PHONE.match(t.raw, p, hi)
        if m:
            ok = 9 <= sum(48 <= c < 58 for c in m.group()) <= 15
            add(r, p, m.end(), PHONE, ok, not ok)


def _long_addresses(t: _Text, add) -> None:
    """IPv6: runs of hexadecimal digits and colons that such an address can be written with."""
    colon = np.flatnonzero(t.data == 58)
    free = 0
    for p in colon[:-1][np.diff(colon) <= 5].tolist():
        if p < free:
            continue
        r = int(t.row(np.array([p]))[0])
        lo, hi = max(int(t.off[r]), p - 40), min(int(t.off[r + 1]), p + 80)
        left, right = _is[2][t.data[lo:p]], _is[2][t.data[p:hi]]
        s = p - int((left[::-1].cumprod()).sum())
        e = p + int(right.cumprod().sum())
        free = e
        if 2 < e - s <= 39 and t.raw[s:e].count(b":") >= 3:
            try:
                ipaddress.IPv6Address(t.raw[s:e].decode())
            except ValueError:
                continue
            add(r, s, e, IP, False, False)


# --- labelers -------------------------------------------------------------------------------------

def _writing(kind: int, x: bytes) -> int:
    """Whether it is written as such data usually is."""
    if kind == EMAIL:
        if b"@" not in x:
            return 0
        local, domain = x.rsplit(b"@", 1)
        end = domain.rsplit(b".", 1)[-1]
        return 1 if len(local) <= 64 and len(x) <= 254 and b"." in domain and 2 <= len(end) <= 24 and end.isalpha() and not local.startswith(b".") else -1
    if kind == IP:
        return 1 if b":" in x or not any(len(p) > 1 and p.startswith(b"0") for p in x.split(b".")) else -1
    groups = [len(g) for g in re.findall(rb"[0-9]+", x)]
    if kind == CARD:
        return 1 if len(groups) == 1 or groups[:-1] == [4] * (len(groups) - 1) or groups == [4, 6, 5] else -1
    if groups[-2:] == [3, 4]:
        return 1
    return -1 if groups[0] == 4 and groups[1:] and max(groups[1:]) <= 2 else 1 if x.startswith(b"+") and len(groups) <= 5 else 0


def _gazetteer(kind: int, x: bytes) -> int:
    if kind == EMAIL:
        return 1 if _WORDS.findall(x.lower())[-1:] and re.split(rb"[^a-z]", x.lower())[-1].decode() in TOP_LEVEL else -1
    if kind == IP:
        return 1 if b":" in x or (x.split(b".")[0].lstrip(b"0") or b"0") not in (b"0", b"127", b"255") else 0
    digits = re.sub(rb"[^0-9]", b"", x).decode()
    if kind == CARD:
        return 1 if any(digits.startswith(p) and len(digits) in n for p, n in ISSUERS) else -1
    return (1 if digits[:1] in CALLING or digits[:2] in CALLING else -1) if x.startswith(b"+") else 0


_CLOSE = set(b"/=\\_#@&:$%*<>\"'`|~^")


def judge(t: _Text, row: int, spans: list[Span]) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
    """Votes of the labelers and the features of each span of a row."""
    lo, hi = int(t.off[row]), int(t.off[row + 1])
    order = sorted((s.start, s.end, s.kind) for s in spans if s.base)
    starts = np.array([o[0] for o in order], np.int64)
    out = []
    for s in spans:
        x = t.raw[s.start:s.end]
        words = _WORDS.findall(t.low[max(lo, s.start - NEAR):s.start])[-3:]
        before = 1 if BEFORE[s.kind].intersection(words) else -1 if NOT_BEFORE.intersection(words) else 0
        sides = (t.data[s.start - 1:s.start] if s.start > lo else t.data[:0]).tolist() + (t.data[s.end:s.end + 1] if s.end < hi else t.data[:0]).tolist()
        edges = -1 if any(c >= 128 or chr(c).isalnum() or c in _CLOSE for c in sides) else 1
        i, j = np.searchsorted(starts, (s.start - 200, s.end + 200))
        # the nearest base matches of another kind; equal kinds say little
        company = int(any(o[2] != s.kind for o in (*order[i:i + 8], *order[max(i, j - 8):j])))
        form = 1 if s.base else -1 if s.fails else 0
        writing, gazetteer = _writing(s.kind, x), _gazetteer(s.kind, x)
        length = int(np.searchsorted((10, 16, 24), len(x), side="right"))
        parts = 0 if x.isalnum() else 1 if b" " in x else 2 if b"-" in x else 3
        plain = int(s.kind == IP and b":" not in x or s.kind == CARD or s.kind == PHONE and x[:1] == b"+" or s.kind == EMAIL and b"@" in x)
        out.append(((form, writing, gazetteer, before, edges, company),
                    (s.kind, int(s.fails), writing + 1, gazetteer + 1, before + 1, (edges + 1) // 2, company, length, parts, plain)))
    return out


#: How many values each feature has.
SIZES = (4, 2, 3, 3, 3, 2, 2, 4, 4, 2)


def reliabilities(votes: np.ndarray, counts: np.ndarray, negative: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray, np.ndarray]:
    """Share of positives, P(vote | class) by labeler, class and vote (-1, 1), and each pattern's probability of being positive.

    ``votes``: patterns by labelers, in -1, 0, 1; a labeler that says 0 says nothing, for or against. ``negative``
    patterns are known not to be positive. Starts from the majority of the votes; every probability is smoothed by
    one count.
    """
    q = np.where(negative, 0.0, np.clip(0.5 + votes.sum(axis=1) / (2 * votes.shape[1]), 0.05, 0.95))
    onehot = (votes[:, :, None] == np.array([-1, 1])).astype(float)
    for _ in range(rounds):
        weight = np.stack([counts * (1 - q), counts * q])
        table_ = np.einsum("cp,plv->lcv", weight, onehot) + 1
        table_ /= table_.sum(axis=2, keepdims=True)
        share = (weight[1].sum() + 1) / (counts.sum() + 2)
        log = np.einsum("plv,lcv->pc", onehot, np.log(table_)) + np.log([1 - share, share])
        new = np.where(negative, 0.0, 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500))))
        moved = np.abs(new - q).max(initial=0)
        q = new
        if moved < 1e-9:
            break
    return float(share), table_, q


class Classifier(NamedTuple):
    weights: np.ndarray  # of the features' values for each kind, one after the other, and a bias per kind

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(expand(features) @ self.weights, -500, 500)))


def expand(features: np.ndarray) -> np.ndarray:
    """One-hot values of each feature, apart for each kind."""
    n, per = len(features), sum(SIZES[1:]) + 1
    out = np.zeros((n, len(KINDS) * per))
    base = features[:, 0] * per
    out[np.arange(n), base] = 1
    at = 1
    for j, size in enumerate(SIZES[1:], 1):
        out[np.arange(n), base + at + features[:, j]] = 1
        at += size
    return out


def train(features: np.ndarray, q: np.ndarray, counts: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> Classifier:
    """Logistic regression on soft labels by Newton steps; counts weigh by their logarithm, so that rare patterns still tell."""
    x = expand(features)
    w = np.zeros(x.shape[1])
    weight = np.log1p(counts)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        grad = x.T @ (weight * (p - q)) + ridge * w
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 5 / max(1e-12, np.abs(step).max()))
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return Classifier(w)


def learn(texts: DataFrame, text: str = "text") -> tuple[Classifier | None, dict]:
    """The classifier from all candidates of all texts, and per kind the share of positives and the labelers' tables."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in slices(batches, "__text", 1 << 20):
            t = _Text(*text_buffers(b.column("__text")))
            for row, spans in candidates(t).items():
                total.update(judge(t, row, spans))
        yield pa.RecordBatch.from_arrays([pa.array([list(k[0]) for k in total], pa.list_(pa.int32())), pa.array([list(k[1]) for k in total], pa.list_(pa.int32())),
                                          pa.array(list(total.values()), pa.int64())], ["votes", "features", "n"])

    got = (texts.select(F.col(text).alias("__text")).mapInArrow(count, "votes array<int>, features array<int>, n long")
           .groupBy("votes", "features").agg(F.sum("n").alias("n")).orderBy("votes", "features").collect())
    if not got:
        return None, {}
    votes, features, n = np.array([r["votes"] for r in got]), np.array([r["features"] for r in got]), np.array([r["n"] for r in got], float)
    q, told = np.zeros(len(got)), {}
    for kind in range(len(KINDS)):
        of = np.flatnonzero(features[:, 0] == kind)
        if len(of):
            pattern, inverse = np.unique(votes[of], axis=0, return_inverse=True)
            inverse = inverse.reshape(-1)
            share, table_, p = reliabilities(pattern, np.bincount(inverse, n[of], len(pattern)), pattern[:, 0] < 0)
            q[of], told[KINDS[kind]] = p[inverse], (share, table_)
    return train(features, q, n), told


def _write(t: _Text, row: int, spans: list[Span]) -> str:
    zero = t.points[t.off[row]]
    return ",".join(f"{KINDS[s.kind]}:{t.points[s.start] - zero}:{t.points[s.end] - zero}" for s in spans)


def reported(t: _Text, row: int, spans: list[Span], model: Classifier | None) -> list[Span]:
    """Base matches, and other spans that the classifier accepts and that overlap nothing reported."""
    keep = [s for s in spans if s.base]
    other = [(s, f) for s, (_, f) in zip(spans, judge(t, row, spans), strict=True) if not s.base and not s.fails] if len(keep) < len(spans) and model else []
    if other:
        p = model.probability(np.array([f for _, f in other]))
        free = 0  # base matches are apart from these already; of two others that overlap the first stays
        for (s, _), x in sorted(zip(other, p, strict=True), key=lambda y: y[0][0].start):
            if x >= ACCEPT and s.start >= free:
                keep.append(s)
                free = s.end
        keep.sort(key=lambda x: (x.kind, x.start, x.end))
    return keep


_OUT = ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, n_email, n_ip, n_card, n_phone (base matches), base_sha256, spans.

    Null texts are empty; a text without a match has zeros, the digest of nothing and no spans. Repeated rows are
    reported each, null keys as any other; columns beyond the two play no part, whatever their names. Without any
    candidate in all texts there is no classifier and nothing to classify.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("__key"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    kind = rows.schema["__key"].dataType.simpleString()
    held = spark.sparkContext.broadcast(learn(rows, "__text")[0])

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        nothing = hashlib.sha256(b"").hexdigest()
        for b in slices(batches, "__text", 1 << 20):
            t = _Text(*text_buffers(b.column("__text")))
            counts = np.zeros((len(KINDS), b.num_rows), np.int64)
            digest, spans = [nothing] * b.num_rows, [""] * b.num_rows
            for row, found in candidates(t).items():
                base = [s for s in found if s.base]
                for s in base:
                    counts[s.kind, row] += 1
                digest[row] = hashlib.sha256(_write(t, row, base).encode()).hexdigest()
                spans[row] = _write(t, row, reported(t, row, found, model))
            yield pa.RecordBatch.from_arrays([b.column("__key"), *[pa.array(c) for c in counts], pa.array(digest, pa.string()), pa.array(spans, pa.string())],
                                             ["__key", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return rows.mapInArrow(report, f"__key {kind}, {_OUT}").withColumnRenamed("__key", key)


def query(spark, sf_dir: str) -> DataFrame:
    """op11: personal data in all documents."""
    return find(table(spark, sf_dir, "documents").select("doc_id", "text"))
