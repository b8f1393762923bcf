"""Operators on documents against plain versions, and on awkward tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from assetflow.llm import language, licenses, lm, neardup, packing, pieces, substrings, viterbi
from assetflow.llm.common import text_buffers, table

SF = "/root/testdata/sf0.001"


def _random(seed, alphabet="abcdé "):
    r = random.Random(seed)
    return r, lambda n: "".join(r.choice(alphabet) for _ in range(n))


# --- language identification ----------------------------------------------------------

def test_forward_sums_all_segmentations():
    v = pieces.load(pieces.default_vocabulary())
    p = np.random.default_rng(1).random((len(v.ids), 2))
    p /= p.sum(axis=0)
    at = {b: i for i, b in enumerate(v.text)}

    def total(word, k):  # recursion over the first piece
        if not word:
            return 1.0
        return sum(p[at[word[:n]], k] * total(word[n:], k) for n in range(1, len(word) + 1) if word[:n] in at)

    words = [b"a", b"there", "läuft".encode(), b"\xff\x00", b"qzx"]
    data = np.frombuffer(b"".join(words), np.uint8)
    size = np.array([len(w) for w in words])
    got = language.forward(v, p, data, np.cumsum(size) - size, size)
    for i, w in enumerate(words):
        for k in range(2):
            assert got[i, k] == pytest.approx(math.log(total(b" " + w, k)))


def test_long_words_do_not_underflow():
    v = pieces.load(pieces.default_vocabulary())
    p = np.full((len(v.ids), 1), 1e-5)
    one = language.forward(v, p, np.full(3000, 120, np.uint8), np.array([0]), np.array([3000]))
    assert np.isfinite(one).all() and one[0, 0] < -1000


def test_language_held_out_accuracy(spark):
    out = language.query(spark, "/root/testdata/sf0.01").where("held_out").join(table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang"), "doc_id")
    n, right = out.count(), out.where("lang = lang_pred").count()
    assert n > 200 and right >= 0.97 * n


def test_language_awkward(docs, none):
    vocabulary = pieces.default_vocabulary()
    model = language.fit(docs, vocabulary)
    assert model[0] == ["de", "en"]
    out = language.identify(docs, model, vocabulary).collect()
    got = {r.doc_id: (r.lang_pred, r.score) for r in out}
    assert len(out) == 11 and got[4] == got[5] == got[6] == got[8] == ("und", 0.0)
    assert got[3][0] == got[7][0] == "de" and got[1][0] == "en" and all(0 <= s <= 1 for _, s in got.values())
    empty = language.fit(none, vocabulary)
    assert empty[0] == [] and {r.lang_pred for r in language.identify(docs, empty, vocabulary).collect()} == {"und"}
    assert language.identify(none.drop("score"), model, vocabulary).count() == 0


def test_long_words_equal_short_ones(monkeypatch):
    """Words gone through alone give what words side by side give, over several stretches."""
    v = pieces.load(pieces.default_vocabulary())
    p = np.random.default_rng(1).random((len(v.ids), 3))
    p /= p.sum(axis=0)
    r, rnd = _random(9, "abcdeéthin日")
    words = [rnd(n).encode() for n in (1, 30, 200, 700)]
    data = np.frombuffer(b"".join(words), np.uint8)
    size = np.array([len(w) for w in words])
    start = np.cumsum(size) - size
    plain = language.forward(v, p, data, start, size)
    flat, count = viterbi.segment(v, pieces.block(data, start, size, lead=False), size)
    for stretch in (64, 1 << 13):
        monkeypatch.setattr(pieces, "STRETCH", stretch)
        monkeypatch.setattr(pieces, "LONG", 0)
        assert language.forward(v, p, data, start, size) == pytest.approx(plain, rel=1e-12)
        ids = [viterbi.segment_long(v, data[a:a + n]) for a, n in zip(start, size, strict=True)]
        assert [len(x) for x in ids] == count.tolist() and np.concatenate(ids).tolist() == flat.tolist()


def test_a_megabyte_without_a_blank():
    import time

    v = pieces.load(pieces.default_vocabulary())
    p = np.random.default_rng(1).random((len(v.ids), 4))
    data = np.random.default_rng(2).integers(97, 123, 1 << 20).astype(np.uint8)
    t = time.time()
    assert np.isfinite(language.forward(v, p / p.sum(axis=0), data, np.array([0]), np.array([len(data)]))).all()
    assert viterbi.segment_long(v, data).size > len(data) / v.longest
    assert time.time() - t < 30


# --- packing ----------------------------------------------------------------------------

def _whole(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_ids_and_places(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_vocabulary())
    docs = table(spark, SF, "documents").select("doc_id", "text")
    rows = packing.pack_documents(docs, packing.default_vocabulary()).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for d in docs.collect():
        ids = np.array(t.encode(d.text or "", add_special_tokens=False).ids + [0], "<u4")
        want = [(i, s, min(2048, len(ids) - s), zlib.crc32(ids[s:s + 2048].tobytes())) for i, s in enumerate(range(0, len(ids), 2048))]
        assert want == sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by[d.doc_id])
    n = _whole(rows, 2048)
    assert n <= 1.06 * math.ceil(sum(r.length for r in rows) / 2048)


def test_word_ids_equal_the_tokenizer_on_odd_texts():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_vocabulary())
    r, rnd = _random(5, "aAbB'sStT.,!?<|>é́İΣς \n\t ​日本1２")
    texts = ["<|endoftext|> a<|ENDOFTEXT|>b <|startoftext|>", "I'll DON'T x.y.Z ...a", "\x1c a\x85b", "", " "] + [rnd(r.randint(0, 60)) for _ in range(300)]
    coder = packing.WordIds(packing.default_vocabulary())
    texts += ["J\u030c H\u0331 T\u0308 W\u030a Y\u030a", "J\u0323\u030c.A", "xJ\u030cX ÜBER J.\u030c <|J>"]
    for group in (texts, [x.replace("<|", "") for x in texts]):
        ids, off = coder.encode(*text_buffers(pa.array(group)), 0)
        for i, x in enumerate(group):
            assert ids[off[i]:off[i + 1]].tolist() == t.encode(x, add_special_tokens=False).ids + [0]


def test_sum_of_squares_takes_the_smallest_sum():
    sizes = np.random.default_rng(2).integers(1, 30, 120)
    bins, offset = packing.sum_of_squares(sizes, 30)
    left = {}
    for i in np.argsort(-sizes, kind="stable"):
        s = int(sizes[i])

        def after(gap):
            c = Counter(g for g in left.values() if g)
            c[gap] -= gap < 30
            c[gap - s] += 1
            c[0] = c[30] = 0
            return sum(n * n for n in c.values())
        gap = 30 - offset[i]
        assert gap >= s and left.get(bins[i], 30) == gap
        assert after(gap) == min(after(g) for g in {*left.values(), 30} if g >= s)
        left[bins[i]] = gap - s


def test_packing_awkward(docs, none):
    rows = packing.pack_documents(docs, packing.default_vocabulary()).collect()
    _whole(rows, 2048)
    length = Counter()
    for r in rows:
        length[r.doc_id] += r.length
    assert length[4] == length[5] == length[6] == 1 and length[2] == 2 * length[1] and length[7] > 2048
    assert packing.pack_documents(none, packing.default_vocabulary()).count() == 0


# --- language-model scores ---------------------------------------------------------------

def test_lm_counts_and_base(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    fold = lambda d: zlib.crc32(str(d.doc_id).encode()) % 10
    cut = lambda t: [w for w in re.split(rb"[\x20\x09-\x0d]+", (t or "").encode().translate(bytes(lm.LOWER))) if w] + [None]
    c = Counter(w for d in docs if fold(d) for w in cut(d.text))
    n, v = sum(c.values()), len(c)
    got = {r.doc_id: r for r in lm.query(spark, SF).collect()}
    for d in docs:
        t, r = cut(d.text), got[d.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(t), sum(c[w] > 0 for w in t), n, fold(d) == 0)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t))
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_is_normalised():
    """Over all tokens that can follow, one unseen for each rare class, the probabilities sum to 1."""
    c = lm.Classes(np.array([0, 5, 9], np.uint64), np.concatenate([[4.0, 3, 2], np.ones(lm.RARE)]), 1.0 + lm.SMOOTHING * 2 * np.ones(lm.RARE), 20, 70)
    m = lm.start_model(c)
    q = m.context(np.array([0, 1, c.size]), np.array([2, 1, c.size]))
    p = np.exp(q @ m.b.T + m.bias - m.log_z(q)[:, None])
    assert p.sum(axis=1) == pytest.approx(1)
    # a rare class with one known token (count 1) and the unseen one
    assert ((1 + lm.SMOOTHING) + lm.SMOOTHING) / c.share == pytest.approx(1)


def test_lm_training_finds_what_follows():
    c = lm.Classes(np.array([0, 5], np.uint64), np.concatenate([[50.0, 50], np.zeros(lm.RARE)]), np.ones(lm.RARE), 100, 2)
    key = np.array([0 << 18 | 0 << 9 | 1, 1 << 18 | 1 << 9 | 0], np.uint64)
    m = lm.train(lm.start_model(c), key, np.array([50, 50]), c.mass + 0.1, 60 * lm.BATCH, 3)
    q = m.context(np.array([0, 1]), np.array([0, 1]))
    p = np.exp(q @ m.b.T + m.bias - m.log_z(q)[:, None])
    assert p[0, 1] > 0.9 and p[1, 0] > 0.9


def test_lm_pass_takes_every_trigram_by_its_count():
    n = np.array([1, 1, 2, 3, 50, 1000])
    at, weight = lm.examples(n, np.random.default_rng(1))
    assert len(at) <= 2 * len(n) and weight.mean() == pytest.approx(1)
    assert np.bincount(at, weights=weight) / weight.sum() == pytest.approx(n / n.sum(), rel=1e-5)


def test_lm_shards_hold_whole_contexts_whatever_the_buckets(spark):
    """All that follows a context is in one shard, every token counts, and the steps do not depend on the buckets."""
    docs = table(spark, SF, "documents").select("text").where("text is not null").repartition(5)
    tokens = sum(len(re.findall(rb"[^\x20\x09-\x0d]+", d.text.encode())) + 1 for d in docs.collect())
    of = []
    for buckets in (8, 50):
        c = lm.classes(lm.count_tokens(docs, buckets))
        trigrams = lm.count_trigrams(docs, c, buckets)
        rows = [lm.unpack(r.blob, "u8", "i8") for r in lm.training_shards(trigrams, 20_000).collect()]
        contexts = [set((key >> np.uint64(c.bits)).tolist()) for key, _ in rows]
        assert len(rows) > 1 and sum(map(len, contexts)) == len(set().union(*contexts))
        assert sum(int(n.sum()) for _, n in rows) == tokens
        of.append((len(rows), sum(len(key) for key, _ in rows)))
    assert of[0] == of[1]


def test_lm_own_words_grow_with_the_words_counted(spark):
    """A corpus with more distinct words has more classes of single words, and all trigrams of them are told apart."""
    words = [f"w{i}" for i in range(160_000)]
    docs = spark.createDataFrame([(" ".join(words[i:i + 8000] + words[:500]),) for i in range(0, len(words), 8000)], "text string")
    c = lm.classes(lm.count_tokens(docs, 8))
    assert len(c.frequent) == 400 and c.mass.sum() == c.tokens and (c.mass[:400] >= 20).all()
    n = 700 - lm.RARE
    c = lm.Classes(np.arange(n, dtype=np.uint64), np.concatenate([np.ones(n), np.zeros(lm.RARE)]), np.ones(lm.RARE), n, n)
    key = np.array([600 << 2 * c.bits | 610 << c.bits | 620, 610 << 2 * c.bits | 600 << c.bits | 630], np.uint64)
    m = lm.train(lm.start_model(c), key, np.array([50, 50]), c.mass + 0.1, 60 * lm.BATCH, 3)
    q = m.context(np.array([600, 610]), np.array([610, 600]))
    p = np.exp(q @ m.b.T + m.bias - m.log_z(q)[:, None])
    assert p.shape[1] == c.size == 700 and p[0].argmax() == 620 and p[1].argmax() == 630


def test_lm_scores_worked_out_token_by_token(spark):
    """Each document's score again: a softmax over all classes per token, and the token's share within its class."""
    df = table(spark, SF, "documents").where("doc_id < 60").select("doc_id", "text")
    counts = lm.count_tokens(df, 8)
    c = lm.classes(counts)
    model = lm.fit(lm.training_shards(lm.count_trigrams(df, c, 8), 5_000), c, rounds=1)
    got = {r.doc_id: r.score for r in lm.score(df, counts, 8, c, model, 3).collect()}
    n = {}
    for r in counts.collect():
        key, count, _ = lm.unpack(r.blob, "u8", "i8", "i2")
        n.update(zip(key.tolist(), count.tolist(), strict=True))
    own = {h: i for i, h in enumerate(c.frequent.tolist())}
    for r in df.where("doc_id < 12 or text is null").collect():
        t = lm.tokens(*text_buffers(pa.array([r.text or ""])))
        two = one = c.size
        total = 0.0
        for h, rare in zip(t.hash.tolist(), t.rare.tolist(), strict=True):
            k = own.get(h, len(own) + rare)
            s = np.exp((model.a2[two] + model.a1[one]) @ model.b.T + model.bias)
            total += np.log10(s[k] / s.sum())
            if h not in own:
                total += np.log10((n.get(h, 0) + lm.SMOOTHING) / c.share[k - len(own)])
            two, one = one, k
        assert got[r.doc_id] == pytest.approx(total, rel=1e-4)


def test_lm_memo_of_normalisers(monkeypatch):
    c = lm.Classes(np.arange(5, dtype=np.uint64), np.ones(5 + lm.RARE), np.ones(lm.RARE), 5, 5)
    m = lm.start_model(c)
    rng = np.random.default_rng(0)
    for most in (10, 1000):
        monkeypatch.setattr(lm, "MEMO", most)
        for name in "ab":
            for _ in range(20):
                pair = np.unique(rng.integers(0, c.size + 1, 30) << c.bits | rng.integers(0, c.size + 1, 30))
                want = m.log_z(m.context(pair >> c.bits, pair & ((1 << c.bits) - 1)))
                assert np.allclose(lm.log_z_of(m, name, pair, c.bits), want, atol=1e-5)


def test_lm_awkward(docs, none):
    from pyspark.sql import functions as F

    out = {(r.doc_id, r.n_tokens): r for r in lm.score_texts(docs, F.lit(True)).collect()}
    assert out[4, 1].n_known == 1 and all(np.isfinite(r.score) for r in out.values()) and len(out) == 10
    bare = lm.score_texts(docs, F.lit(False)).collect()
    assert len(bare) == 11 and all(r.score == r.base_score == 0 and r.n_known == r.train_tokens == 0 for r in bare)
    assert lm.score_texts(none, F.lit(True)).count() == 0


# --- repeated strings ----------------------------------------------------------------------

def _removed(rows, length=substrings.LENGTH):
    seen, out = set(), []
    for k, t in sorted(rows, key=lambda r: (r[0] if r[0] is not None else -2**63, r[1] or "")):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if b[p:p + length] in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(b[p:p + length])
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((k, len(b), sum(gone), sum(1 for j in range(len(b)) if gone[j] and not (j and gone[j - 1])), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("how", [{}, {"common": 5}, {"group_bytes": 3000, "common": 30}])
def test_repeats_equal_brute_force(spark, how):
    r, rnd = _random(3)
    base, line, line2 = rnd(900), rnd(60), rnd(130)
    rows = [(1, base), (2, base), (3, base[:400] + "X" + base[400:]), (4, None), (5, ""), (6, "a" * 500), (7, "ab" * 300), (8, "a" * 99),
            (9, rnd(300) + "a" * 150), (None, base[100:350]), (2, base), (2, "zz" + base), (10, (line + rnd(7) + "\n") * 20)]
    rows += [(100 + i, rnd(r.randint(0, 150)) + line + rnd(r.randint(0, 150)) + line2 + rnd(40)) for i in range(80)]
    rows += [(300 + i, base[r.randint(0, 500):][:r.randint(50, 700)] + rnd(30)) for i in range(30)]
    got = substrings.remove(spark.createDataFrame(rows, "doc_id long, text string"), keep_text=False, **how)
    assert sorted((tuple(x) for x in got.collect()), key=str) == _removed(rows)


def test_repeats_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in substrings.query(spark, SF).collect()), key=str) == _removed(rows)


def test_repeats_awkward(docs, none):
    out = substrings.remove(docs).collect()
    assert len(out) == 11 and out[0].__fields__ == [*docs.columns, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    by = {r.doc_id: r for r in out}
    assert by[4].n_bytes == by[5].n_bytes == 0 and by[10].n_removed == 4999 and by[7].n_removed > 200_000
    assert substrings.remove(none).count() == 0


# --- pieces -------------------------------------------------------------------------------------

def test_viterbi_equals_brute_force_and_round_trips():
    v = pieces.load(pieces.default_vocabulary())
    score = dict(zip(v.text, zip(v.scores, v.ids, strict=True), strict=True))

    def best(b):
        top, back = [0.0] + [-1e300] * len(b), [0] * (len(b) + 1)
        for i in range(1, len(b) + 1):
            for n in range(1, min(i, v.longest) + 1):
                s = score.get(b[i - n:i])
                if s and top[i - n] + s[0] >= top[i]:
                    top[i], back[i] = top[i - n] + s[0], n
        out, i = [], len(b)
        while i:
            out.append(int(score[b[i - back[i]:i]][1]))
            i -= back[i]
        return out[::-1]

    r, rnd = _random(1, " abthe\nÉñ日▁")
    texts = ["", "  a", "Hello world\n\n  x  ", "é日本 語\x00\x01", "thth" * 400, rnd(900).replace(" ", ""), " " * 300, "a" * 500] + [rnd(r.randint(0, 80)) for _ in range(80)]
    data, off = text_buffers(pa.array(texts))
    ids, at = viterbi.PieceIds(pieces.default_vocabulary()).encode(data, off)
    for i, x in enumerate(texts):
        assert ids[at[i]:at[i + 1]].tolist() == best(x.encode())
    back, back_off = viterbi.PieceText(pieces.default_vocabulary()).decode(ids, at)
    assert back.tobytes() == data.tobytes() and back_off.tolist() == off.tolist()


def test_pieces_awkward(docs, none):
    p = pieces.default_vocabulary()
    out = viterbi.decode(viterbi.encode(docs, p), p).collect()
    assert all(r.decoded == (r.text or "") for r in out) and len(out) == 11
    assert viterbi.encode(none, p).count() == 0
    assert all(r.lossless for r in viterbi.round_trip(docs, p).collect())


# --- near duplicates ------------------------------------------------------------------------------

def _multiset(t):
    w = (t or "").lower().split()
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def _alike(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_signatures_are_unbiased():
    r = random.Random(2)
    error = []
    for trial in range(120):
        a = [f"w{r.randrange(300)}" for _ in range(200)] + [q + str(trial) for q in "xyzuv"] * r.randint(0, 30)
        b = list(a)
        for _ in range(r.randint(0, 8)):
            b[r.randrange(len(b))] = f"q{r.randrange(99)}"
        b += [q + str(trial) for q in "xyzuv"] * r.randint(0, 30)
        ta, tb = " ".join(a), " ".join(b)
        doc, x, c, _ = neardup.shingles(*text_buffers(pa.array([ta, tb])))
        s = neardup.signatures(doc, x, c, 2, m=256)
        want = _alike(_multiset(ta), _multiset(tb))
        assert neardup.overlap(ta, tb) == pytest.approx(want)
        error.append((s[0] == s[1]).mean() - want)
    assert abs(np.mean(error)) < 4 * np.std(error) / len(error) ** 0.5


def _classes(rows):
    sets, parent = [_multiset(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and _alike(sets[i], sets[j]) >= 0.8:
                parent[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), k), k)
    return {k: least[root(i)] for i, (k, _) in enumerate(rows)}


@pytest.mark.parametrize("block", [5, 1000])
def test_near_duplicates_equal_brute_force(spark, block):
    r = random.Random(9)
    base = [f"w{r.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(r.choice([0, 1, 2, 4, 8])):
            w[r.randrange(len(w))] = f"v{i}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join(f"u{r.randrange(500)}" for _ in range(r.randint(1, 40)))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x.doc_id: x.class_id for x in neardup.classes(df, block=block).collect()} == _classes(rows)


def test_near_duplicates_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert {r.doc_id: r.class_id for r in neardup.query(spark, SF).collect()} == _classes(rows)


def test_near_duplicates_awkward(docs, none):
    out = neardup.classes(docs).collect()
    got = {r.doc_id: r.class_id for r in out}
    assert len(out) == 11 and got[1] == got[2] == 1 and all(got[k] == k for k in (3, 4, 5, 6, 7, 8, None, 10))
    assert neardup.classes(none).count() == 0


# --- licences ---------------------------------------------------------------------------------------

def test_licence_rules(spark):
    text = lambda *ids: "Some words.\n" + "\nother words here.\n".join(licenses.SENTENCES[i] for i in ids)
    rows = [(1, text("mit_short")), (2, text("mit_grant", "mit_notice")), (3, text("mit_notice", "mit_grant")),
            (4, text("bsd_head", "bsd_source", "bsd_binary", "bsd_names")), (5, text("bsd_head", "bsd_source", "bsd_binary")),
            (6, "LICENSED   under the 'Apache' License, version 2.0!"), (7, "I have licensed under the MIT License."), (8, None), (9, ""),
            (10, text("gpl2_head", "gpl_no_warranty", "mit_short")), (11, "Released under the MIT License. " * 3)]
    out = {r.doc_id: r.licenses for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: ["MIT"], 2: ["MIT"], 3: [], 4: ["BSD-3-Clause"], 5: ["BSD-2-Clause"], 6: ["Apache-2.0"], 7: [], 8: [], 9: [],
                   10: ["GPL-2.0-or-later", "MIT"], 11: ["MIT"]}


def test_wrapped_licences(spark):
    """The public texts hard-wrapped, bare and behind comment marks, with list markers, and behind a colon on one line."""
    import textwrap

    known = {"MIT": ["mit_grant", "mit_notice"], "Apache-2.0": ["apache_head", "apache_copy", "apache_as_is"],
             "GPL-3.0-or-later": ["gpl3_head", "gpl_no_warranty"], "GPL-2.0-or-later": ["gpl2_head", "gpl_no_warranty"],
             "BSD-2-Clause": ["bsd_head", "bsd_source", "bsd_binary"], "BSD-3-Clause": ["bsd_head", "bsd_source", "bsd_binary", "bsd_names"],
             "MPL-2.0": ["mpl2_head"]}
    rows, want = [], {}
    for name, ids in known.items():
        for width in (12, 30, 70):
            for mark, item in (("", ""), ("# ", "1. "), (" * ", "(2) "), ("// ", "a) "), ("", "* ")):
                paragraphs = [textwrap.fill((item if i in ("bsd_source", "bsd_binary") else "") + licenses.SENTENCES[i], width, break_long_words=False) for i in ids]
                lines = ["Copyright (c) 2020 A. Person", "", *"\n\n".join(paragraphs).split("\n"), "", "More words."]
                rows.append((len(rows), "\n".join((mark + line).rstrip() for line in lines)))
                want[rows[-1][0]] = [name]
    grant, notice = licenses.SENTENCES["mit_grant"], licenses.SENTENCES["mit_notice"]
    rows += [(1000, f"{grant} {notice}"), (1001, grant.replace("hereby granted", "hereby\n\ngranted") + "\n" + notice),
             (1002, "Licensed under the Apache License, Version 2.0\n(the \"License\"); you may not use this file except in compliance\nwith the License."),
             (1003, "Version: 2.0"), (1004, "I have\nlicensed under the MIT License by now."), (1005, "One. Two\nthree: released under\r\nthe MIT License.")]
    want |= {1000: ["MIT"], 1001: [], 1002: ["Apache-2.0"], 1003: [], 1004: [], 1005: ["MIT"]}
    out = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: r.licenses for k, r in out.items()} == want
    assert all(x.id for r in out.values() for x in r.license_sentences)
    assert [x.position for x in out[1000].license_sentences] == [0, 0] and [x.position for x in out[1005].license_sentences] == [2]


def test_licences_awkward(docs, none):
    assert licenses.scan(docs).count() == 11 and licenses.scan(none).count() == 0


@pytest.mark.parametrize("sizes", [[30], [40, 1], [25, 25, 3], [5] * 9, [1] * 7])
def test_blocks_of_a_bucket_bring_rows_of_different_classes_together(spark, sizes):
    rows = [(1, 100 * c + i, 100 * c) for c, n in enumerate(sizes) for i in range(n)]
    got = neardup._blocked(spark.createDataFrame(rows, "bucket long, id long, label long"), "bucket", 10).collect()
    tasks = {}
    for r in got:
        tasks.setdefault((r.p, r.q), []).append(r)
    met = set()
    for (p, q), t in tasks.items():
        met |= {frozenset((a.id, b.id)) for a in t for b in t if a.own == p and b.own == q and a.label != b.label}
    assert met == {frozenset((a, b)) for _, a, x in rows for _, b, y in rows if x != y}
    if sizes == [40, 1]:  # 40 copies in four blocks, each in one task; the other row in every task
        assert len(got) == 40 + 5
