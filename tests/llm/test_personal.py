"""Personal data: base matches against the plain patterns, the labelers' weights, other writings, awkward rows."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assetflow.llm import personal
from assetflow.llm.common import table

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _digits(x):
    return [int(c) for c in x if c in "0123456789"]


def _luhn(x):
    d = _digits(x)[::-1]
    return 13 <= len(d) <= 19 and sum(d[::2] + [sum(divmod(2 * v, 10)) for v in d[1::2]]) % 10 == 0


def _base(x):
    """Spans of the plain patterns, in code points."""
    out = [("email", m.span()) for m in _EMAIL.finditer(x)]
    out += [("ip", m.span()) for m in _IP.finditer(x) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", m.span()) for m in _CARD.finditer(x) if _luhn(m.group())]
    return out + [("phone", m.span()) for m in _PHONE.finditer(x) if 9 <= len(_digits(m.group())) <= 15]


def _text(spans):
    return ",".join(f"{k}:{a}:{b}" for k, (a, b) in spans)


def _mine(texts):
    raw = [t.encode() for t in texts]
    t = personal._Text(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    got = personal.candidates(t)
    return [personal._write(t, i, [s for s in got.get(i, []) if s.base]) for i in range(len(texts))]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.text(alphabet="ab.@-_+%é1 0()日\n", max_size=40), max_size=6))
def test_base_matches_of_random_texts(texts):
    assert _mine(texts) == [_text(_base(t)) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["4539", "1488", "0343", "6467", "255", "256", "0007", ".", "-", " ", "+", "(", ")", "a@b", "x.y", "@", "é", "12", "3"]), max_size=16).map("".join), max_size=5))
def test_base_matches_of_numbers(texts):
    assert _mine(texts) == [_text(_base(t)) for t in texts]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_given_documents(spark, sf):
    docs = {r.doc_id: r.text or "" for r in table(spark, sf, "documents").collect()}
    rows = personal.query(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = _base(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(_text(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for k, _ in want) for n in personal.KINDS]
        assert set(_text(want).split(",")) <= set(r.spans.split(",")) or not want
        assert want or not r.spans  # texts without a base match hold nothing else here


def test_other_writings_are_learned(spark):
    """Other ways to write such data are found beside base matches, numbers that only look alike are not."""
    rng = np.random.default_rng(1)
    num = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    texts = []
    for i in range(300):
        good = [f"mail: user{i}@site{i}.com now", f"phone +1 ({num(3)}) {num(3)}-{num(4)} now", f"server {rng.integers(1, 250)}.7.8.{i % 250} now"]
        other = [f"email: user{i} (at) site{i} (dot) org now", f"call ({num(3)}) {num(3)}-{num(4)} now", f"host 2001:db8:0:0:1:0:0:{i % 10} now"]
        plain = [f"version 20{i % 90 + 10}-1{i % 2}-{i % 20 + 10} 11:30:0{i % 9} now", f"order {9}{num(15)} now", f"id 2020 11 12 10 30 {i}", f"see dot {i} at noon"]
        texts.append((3 * i, f"é {good[i % 3]}", 0))
        texts.append((3 * i + 1, f"日本 {other[i % 3]}", 1))
        texts.append((3 * i + 2, f"z {plain[i % 4]}", 2))
    df = spark.createDataFrame(texts, "doc_id long, text string, spans int")
    out = {r.doc_id: r for r in personal.find(df).collect()}
    by = {k: [out[d] for d, _, g in texts if g == k] for k in range(3)}
    assert all(r.spans for r in by[0])
    assert np.mean([bool(r.spans) for r in by[1]]) > 0.9 and all(r.n_email + r.n_ip + r.n_phone == 0 for r in by[1])
    said = {d: t for d, t, _ in texts}
    for r in by[2]:
        assert r.spans == _text(_base(said[r.doc_id]))


def test_reliabilities_find_the_good_labelers():
    rng = np.random.default_rng(0)
    truth = rng.random(20000) < 0.4
    right = np.array([0.95, 0.9, 0.8, 0.6, 0.85, 0.5])
    votes = np.where(rng.random((20000, 6)) < right, np.where(truth, 1, -1)[:, None], np.where(truth, -1, 1)[:, None])
    votes[rng.random(votes.shape) < 0.2] = 0
    pattern, inverse, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    share, tables, q = personal.reliabilities(pattern, n.astype(float), np.zeros(len(pattern), bool))
    assert abs(share - 0.4) < 0.03 and ((q[inverse.reshape(-1)] > 0.5) == truth).mean() > 0.95
    assert np.abs(tables[:, 1, 1] - right).max() < 0.05


def test_awkward_rows(spark):
    long = "a" * 1_000_000 + "@" + "1." * 200_000 + " " + "7" * 1_000_000 + "+1" * 100_000 + ":0" * 100_000 + "dot " * 50_000 + "a@b.cd"
    rows = [(1, None, 5), (2, "", 5), (3, long, 5), (3, "a@b.cd", 5), (3, "a@b.cd", 5), (None, "é a@b.cd", None), (4, "no data", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_email int")
    out = personal.find(df).collect()
    nothing = hashlib.sha256(b"").hexdigest()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_email) for r in out) == [
        (False, 1, 0), (False, 2, 0), (False, 3, 1), (False, 3, 1), (False, 3, 2), (False, 4, 0), (True, 0, 1)]
    assert all(r.base_sha256 == nothing and r.spans == "" for r in out if r.doc_id in (1, 2, 4))
    assert next(r.spans for r in out if r.doc_id is None) == "email:2:8"
    assert personal.find(df.where("false")).count() == 0
    none = personal.find(df.where(F.col("doc_id") == 4)).collect()
    assert len(none) == 1 and none[0].spans == ""
