"""Conversation repair against all edits of short conversations, a plain table of states, and awkward rows."""

import hashlib
import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from assetflow.llm import registry, repair
from compare import compare, duck


def _plain(rows):
    """Least (cost, audit) by a table over all states, row by row."""
    def inserts(labels):
        for _ in range(2):
            for s, (c, a) in list(labels.items()):
                t = repair.NEXT[s][repair.EMIT[s]]
                labels[t] = min(labels.get(t, (c + 3, a + "I")), (c + 3, a + "I"))
        return labels

    labels = inserts({repair.START: (0, "")})
    for initial, goes, cut in rows:
        new = {}
        for s, (c, a) in labels.items():
            ways = [(s, (c + 4, a + "D"))]
            if not goes:
                ways.append((repair.NEXT[s][repair.EMIT[s]], (c + 3 + 3 * cut, a + "R")))
                if initial in repair.NEXT[s]:
                    ways.append((repair.NEXT[s][initial], (c + 3 * cut, a + "K")))
            for t, label in ways:
                new[t] = min(new.get(t, label), label)
        labels = inserts(new)
    return min(labels[s] for s in repair.ACCEPT if s in labels)


_row = st.tuples(st.sampled_from("suuaaax "), st.booleans(), st.booleans()).map(lambda r: (r[0], r[1], r[2] and not r[1]))


@settings(max_examples=300, deadline=None)
@given(st.lists(_row, max_size=24), st.sampled_from([1, 2, 5, 16]))
def test_search_finds_the_least_label(rows, block):
    assert repair.cheapest(rows, block)[:2] == _plain(rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(_row, max_size=10))
def test_bounds_never_exceed_the_rest(rows):
    low = repair.bounds(rows, True)
    assert low[0][repair.START] <= _plain(rows)[0]
    assert all(low[i][repair.START] <= _plain(rows[i:])[0] for i in range(len(rows) + 1))


def test_every_sequence_of_edits_of_short_conversations():
    for rows in itertools.product([("u", False, False), ("a", False, True), ("s", False, False), ("u", True, False)], repeat=3):
        best = None
        for n in range(3, 7):
            for audit in itertools.product("DIKR", repeat=n):
                if sum(e != "I" for e in audit) != 3:
                    continue
                state, cost, at = repair.START, 0, iter(rows)
                for e in audit:
                    initial, goes, cut = next(at) if e != "I" else (None, False, False)
                    emit = initial if e == "K" else repair.EMIT[state]
                    if e == "D":
                        cost += 4
                        continue
                    if goes or emit not in repair.NEXT[state]:
                        break
                    cost += {"K": 0, "R": 3, "I": 3}[e] + 3 * cut
                    state = repair.NEXT[state][emit]
                else:
                    if state in repair.ACCEPT:
                        label = cost, "".join(audit)
                        best = label if best is None else min(best, label)
        assert repair.cheapest(list(rows))[:2] == best


def test_long_conversations_take_linear_work():
    rng = random.Random(5)
    for kind in ("suuuaaa x", "u", "s", "a", "ua"):
        rows = [(rng.choice(kind), rng.random() < 0.1, False) for _ in range(3000)]
        cost, audit, taken = repair.cheapest(rows)
        assert (cost, audit) == _plain(rows) and taken < 40 * len(rows)


def test_awkward_rows(spark):
    long = "a word. " * 200_000
    rows = [(1, None, "user", "hi.", "x"), (1, 3, None, None, "x"), (1, 3, "user", long, "y"), (1, 3, "user", long, "y"), (1, 7, "assistant", "é", None),
            (2, None, "user", "  \t", "x"), (None, 1, "assistant", "ok!", "x"), (None, None, "system", "s.", "x"), (3, 1, "", "?", "z"), (4, 5, "user", "gone.", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, cost string").selectExpr("*", "conv_id <=> 4 AS gone", "NOT conv_id <=> 4 AS alive")
    got = {r.conv_id: r for r in repair.repair(df, alive="alive").collect()}
    assert got.keys() == {1, 2, None, 3, 4}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    one = got[1]
    assert (one.gaps, one.blank, one.duplicate, one.truncated, one.illegal) == (3, 1, 1, 1, 3)
    assert (one.cost, one.audit) == _plain([("u", False, False), (" ", True, False), ("u", False, False), ("u", True, False), ("a", False, True)])
    assert got[2].cost == 4 and got[2].audit == "D" and got[2].gaps == 0 and got[2].repaired_sha256 == sha("")
    assert got[None].audit == _plain([("s", False, False), ("a", False, False)])[1] and got[None].repaired_sha256 == sha("system:s.\nuser:\nassistant:ok!")
    assert got[3].audit == _plain([("", False, False)])[1]
    four = got[4]
    assert (four.gaps, four.blank, four.duplicate, four.truncated, four.illegal, four.cost, four.audit, four.repaired_sha256) == (0, 0, 0, 0, 0, 0, "", sha(""))
    assert repair.repair(df.where("false")).count() == 0
    assert repair.damage(df).count() >= len(rows)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_twin_on_other_tables(spark, sf):
    problems, n = compare(registry.QUERIES["op12_structure_repair"](spark, sf), duck(sf), registry.SQL["op12_structure_repair"])
    assert not problems and n > 0
