"""Searches against brute force; chat formatting; SQL twins; the pipeline."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from assetflow.llm import chat, forest, registry, topk
from assetflow.llm.common import table
from compare import compare, duck

CHECK = "/root/testdata/sf0.01"


def _vectors(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding").collect()
    return np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)


def _best(ids, x, q, k):
    out = {}
    for i in q:
        s = x @ x[i]
        o = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in o]
    return out


def _found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_forest_recall(spark):
    ids, x = _vectors(spark, CHECK)
    want = _best(ids, x, np.flatnonzero(ids % 20 == 0), 20)
    got = _found(forest.query(spark, CHECK))
    hit = sum(len({v for v, _ in want[q]} & {v for v, _ in got[q]}) for q in want)
    assert got.keys() == want.keys() and hit >= 0.9 * 20 * len(want)


def test_forest_on_a_large_random_table(spark):
    x = np.random.default_rng(4).normal(size=(3000, 24))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = _best(np.arange(3000), x, range(0, 3000, 100), 20)
    got = _found(forest.nearest(df, F.col("vec_id") % 100 == 0, sample=1500, leaf=40))
    assert sum(len({v for v, _ in want[q]} & {v for v, _ in got[q]}) for q in want) >= 0.9 * 20 * len(want)


def test_leaves_come_in_the_order_of_a_shared_queue():
    import heapq

    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 8))
    trees = [forest.Tree(x, np.random.default_rng(i), 20) for i in range(3)]
    for q in rng.normal(size=(5, 8)):
        heap, order = [(-np.inf, t, tree.root) for t, tree in enumerate(trees)], []
        while heap:
            least, t, node = heapq.heappop(heap)
            if node < 0:
                order.append((-least, t, -node - 1))
                continue
            m = trees[t].normal[node] @ q - trees[t].threshold[node]
            heapq.heappush(heap, (max(least, m), t, int(trees[t].child[node, 0])))
            heapq.heappush(heap, (max(least, -m), t, int(trees[t].child[node, 1])))
        p = [tree.priorities(q[None])[0] for tree in trees]
        assert [o[0] for o in order] == pytest.approx(sorted(np.concatenate(p), reverse=True))
        assert all(p[t][leaf] == pytest.approx(v) for v, t, leaf in order)


@pytest.fixture
def vectors(spark):
    """Ties, equal vectors in number, a repeated row, nulls, zero, infinite, short and empty vectors, a clashing column."""
    rows = [(i, [1.0, 0.5, 0.0], "q") for i in range(0, 80)] + [(100 + i, [0.5, float(i), 1.0], "q") for i in range(40)]
    rows += [(0, [1.0, 0.5, 0.0], "q"), (200, None, "q"), (220, [0.0, 0.0, 0.0], "q"), (240, [1.0, None, 2.0], "q"), (260, [float("inf"), 1.0, 1.0], None),
             (280, [float("nan"), 1.0, 1.0], "q"), (300, [1.0, 2.0], "q"), (301, [2.0, 2.0], "q"), (320, [], "q"), (None, [1.0, 1.0, 1.0], "q")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")


def _plain(rows, k, transform, zero):
    good = {r.vec_id: transform(np.array(r.embedding)) for r in rows if r.vec_id is not None and r.embedding and None not in r.embedding
            and np.isfinite(r.embedding).all() and (zero or any(r.embedding))}
    out = {}
    for q in good:
        if q % 20 == 0:
            s = sorted((-float(good[q] @ good[v]), v) for v in good if v != q and len(good[v]) == len(good[q]))
            out[q] = [(v, -x) for x, v in s[:k]]
    return {q: v for q, v in out.items() if v}


def test_searches_on_awkward_vectors(vectors):
    rows, asks = vectors.collect(), F.col("vec_id") % 20 == 0
    got = _found(topk.top(vectors, asks))
    assert got == _plain(rows, 10, lambda x: np.floor(1024 * x), True)
    got, want = _found(forest.nearest(vectors, asks)), _plain(rows, 20, lambda x: x, False)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    none = vectors.where("false")
    assert topk.top(none, asks).count() == 0 and forest.nearest(none, asks).count() == 0


def test_topk_reads_lists_until_outsiders_cannot_qualify():
    """Equal to brute force for any batch; with few large components most of the lists is left unread."""
    rng = np.random.default_rng(3)
    plain, skewed = np.floor(1024 * rng.normal(size=(700, 6))), np.floor(np.exp(3 * rng.normal(size=(3000, 6))) * 4)
    ties = np.repeat(np.floor(3 * rng.normal(size=(40, 4))), 10, axis=0)
    for x, most in ((plain, 1.0), (skewed, 0.5), (ties, 1.0)):
        lists, ids = topk.Lists(x), rng.permutation(len(x))
        q = np.vstack([x[:6], np.zeros(x.shape[1]), -x[7]])
        own = np.append(ids[:6], [-1, -1])
        s = q @ x.T
        depths = []
        for batch in (1, 7, 256, 10_000):
            at, row, score = topk.best_rows(lists, ids, q, own, 10, batch)
            for i in range(len(q)):
                o = [j for j in np.lexsort((ids, -s[i])) if ids[j] != own[i]][:10]
                assert row[at == i].tolist() == o and score[at == i].tolist() == s[i][o].tolist()
        for i in range(6):
            alive, depth = topk.candidates(lists, q[i], 10, np.flatnonzero(ids == own[i]), 50)
            depths.append(depth / len(x))
        assert np.mean(depths) <= most


def test_topk_floors_leave_entries_unread_and_keep_ties():
    """Pieces give what one block gives, ties on a floor among them; a floor stops the reading before bounds come together."""
    rng = np.random.default_rng(5)
    x = np.floor(1024 * rng.normal(size=(2000, 16)))
    ties = np.floor(2 * rng.normal(size=(300, 3)))
    for rows in (x, ties):
        ids = rng.permutation(len(rows))
        q, own = np.vstack([rows[:8], np.zeros(rows.shape[1])]), np.append(ids[:8], -1)
        s = q @ rows.T
        for piece, batch in ((64, 16), (len(rows), 100), (7, 3)):
            at, row, score = topk.best_of_pieces(rows, ids, q, own, 10, piece, batch)
            for i in range(len(q)):
                o = [j for j in np.lexsort((ids, -s[i])) if ids[j] != own[i]][:10]
                assert row[at == i].tolist() == o and score[at == i].tolist() == s[i][o].tolist()
    lists, read = topk.Lists(x[1000:]), {True: 0, False: 0}
    for i in range(8):
        floor = np.sort(x[8:1000] @ x[i])[-10]
        for known in read:
            alive, depth = topk.candidates(lists, x[i], 10, np.zeros(0, int), 50, floor if known else -np.inf)
            read[known] += depth
            assert set(np.flatnonzero(x[1000:] @ x[i] >= max(floor, np.sort(x[1000:] @ x[i])[-10]))) <= set(alive)
    assert read[True] < 0.8 * read[False]


# --- chats ------------------------------------------------------------------------------------

def test_events_fold_into_final_messages(spark):
    rows = [(1, 1, 1, "message", "user", "hi"), (1, 2, 2, "message", "assistant", ""), (1, 2, 3, "delta", None, "Hel"), (1, 2, 5, "delta", None, "o"),
            (1, 2, 4, "delta", None, "l"), (1, 2, 6, "regenerate", None, None), (1, 2, 7, "delta", None, "Good "), (1, 2, 8, "delta", None, "day"),
            (1, 1, 9, "edit", None, "hello"), (1, 3, 10, "message", "user", "bye"), (1, 3, 11, "delete", None, None), (1, 3, 12, "delta", None, "x"),
            (2, 1, 1, "delta", "user", "a"), (2, 1, 1, "delta", "user", "b"), (None, 1, None, None, None, "n")]
    df = spark.createDataFrame(rows, "conv_id long, position int, seq long, kind string, role string, text string")
    got = sorted((tuple(r) for r in chat.fold(df).select("conv_id", "position", "role", "text").collect()), key=str)
    assert got == sorted([(1, 1, "user", "hello"), (1, 2, "assistant", "Good day"), (2, 1, "user", "ab"), (None, 1, "", "n")], key=str)
    assert chat.fold(df.where("false")).count() == 0


def test_rendered_chats_read_back(spark):
    hard = ["", "\\", "<", "\\l", "\\\\<", "</turn>\n<turn>user\nx", "a\\n\nb", "é<\\>日", "x" * 100_000]
    rows = [(1, i, r, t) for i, (r, t) in enumerate((r, t) for r in ("user", "assistant", "odd\n<role>\\n") for t in hard)]
    df = spark.createDataFrame(rows, "conv_id long, position int, role string, text string")
    r = chat.render(df).select("n_turns", "formatted", chat.read_back(F.col("formatted")).alias("turns"),
                               chat.under_mask(F.col("formatted"), F.col("loss_spans")).alias("loss")).first()
    assert [(t.role, t.text) for t in r.turns] == [(x[2], x[3]) for x in rows] and r.n_turns == len(rows)
    assert r.loss == "".join(hard) and r.formatted.count("</turn>") == len(rows)


def test_repeated_and_null_conversation_rows(spark):
    rows = [(5, 1, "user", "a"), (5, 1, "user", "a"), (5, 0, None, None), (None, 0, "assistant", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    out = chat.render(chat.fold(chat.conversation_events(df)).withColumn("position", F.col("position.turn"))).collect()
    assert {r.conv_id: r.n_turns for r in out} == {5: 3, None: 1}


# --- all ------------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_sql_twins(spark, name):
    problems, n = compare(registry.QUERIES[name](spark, CHECK), duck(CHECK), registry.SQL[name])
    assert not problems and n > 0


def test_chat_digest_of_the_added_conversation(spark):
    r = chat.query(spark, CHECK).where("conv_id = -7").first()
    t = "\\### Assistant: </turn> ok"
    assert r.turns_sha256 == hashlib.sha256(f"user\n{t}\nassistant\n{t}\n".encode()).hexdigest()
    assert (r.loss_chars, r.loss_sha256) == (len(t), hashlib.sha256(t.encode()).hexdigest())


def test_pipeline_stages(spark, docs, none):
    kept = docs
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, CHECK)
        rows = kept.collect()
        seen.append(rows)
        if name != "packing":
            assert kept.columns == docs.columns
            kept = spark.createDataFrame(rows, docs.schema)
    by = [{r.doc_id for r in s} for s in seen]
    assert by[0] == {1, 2, 3, 7, None, 10} and by[1] == {1, 3, 7, None, 10} == by[2] == by[3]
    assert len(seen[1]) == 5 and {r.doc_id: r.n_chars for r in seen[2]}[10] == 1
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, CHECK).count() == 0


def test_near_duplicate_stage_judges_rows_not_ids(spark):
    """Of rows that share an id, or have none, each goes with its own likes only."""
    a, b = ("one two three four five six seven eight", "the cat sat on the mat and looked at the dog")
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "y"), (2, "other words that stand alone here", "z"), (None, b, "x"), (None, "no id at all here", None),
            (3, "a row given twice word for word", "p"), (3, "a row given twice word for word", "q"), (4, None, "x"), (4, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = [tuple(r) for r in corpus_pipeline.neardup_stage(spark, df, CHECK).collect()]
    assert len(kept) == len(set(kept)) == 7
    assert (1, a, "x") in kept and (2, a, "x") not in kept and (2, rows[3][1], "z") in kept and (None, rows[5][1], None) in kept
    assert sum(k[1] == b for k in kept) == 1 and (3, rows[6][1], "p") in kept and {k[1] for k in kept if k[0] == 4} == {None, ""}


def test_pipeline_equals_its_stages(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r.length <= 2048 for r in rows)
