"""Cheapest repair of a conversation's turn structure by depth-first branch-and-bound.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``. Going over its rows in order, a
repair keeps a row (0), gives it the role user or assistant (3), deletes it (4; it must, where the row is
blank or a duplicate) or inserts a row without text (3); a truncated row that stays adds 3. Of the cheapest
repairs the one whose audit (initials of its edits, in order) is ASCII-least counts.

The search walks an explicit stack of prefixes. A prefix stands at a node: the rows consumed, and the state of
the pattern after what it emitted. Three things cut it off: the lower bound of the rest (``bounds``) with the
incumbent's (cost, audit), and the node's dominance entry, the least (cost, audit) that ever reached it. Both
kinds of label order alike for every continuation: a prefix of equal cost is never a proper prefix of another
at its node, as more inserts cost more. The stack running empty proves the incumbent.

Rows of one conversation are read in order by one task, as its audit and digest are single values. The search
runs over ``BLOCK`` rows at a time: at a block's end only the best label of each of the four states goes on
(the nodes of that end, by dominance), and what these labels share at their front is settled, so its work and
memory are linear in a conversation's rows. Without blocks a depth-first search takes prefixes up again and
again as better ones reach their nodes (20 rows at a time: about 15 prefixes a row; 400 rows: no end). Texts beyond ``SPOOL`` bytes wait in a
file of the task.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Rows searched at a time, and bytes of a conversation's texts kept in memory.
BLOCK, SPOOL = 16, 8 << 20
#: States: nothing emitted, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: What each state becomes by a role initial; no entry, no way.
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ACCEPT = (START, ASSISTANT)
#: The initial that user/assistant edits emit from each state.
EMIT = "uuau"
#: States that can still be reached from each, and the cost of getting from one to another by inserts alone.
REACH = ((START, SYSTEM, USER, ASSISTANT), (SYSTEM, USER, ASSISTANT), (USER, ASSISTANT), (USER, ASSISTANT))
SHIFT = {(a, b): 0 if a == b else INSERT * (2 if a < USER and b == ASSISTANT else 1)
         for a in range(4) for b in range(4) if a == b or b >= USER}

Row = tuple[str, bool, bool]  # role initial, must go (blank or duplicate), truncated


def bounds(rows: list[Row], final: bool) -> list[list[int]]:
    """For each number of rows consumed and each state, a cost that no completion undercuts.

    Each row pays its own least edit. Rows that may stay stand next to each other unless an edit of one of
    them or an insert between them changes that, so of disjoint neighbours whose initials cannot follow each
    other each pair pays on top what the cheapest of these adds. ``final``: the end wants an assistant before it.
    """
    n = len(rows)
    out: list[list[int]] = [[0] * 4 for _ in range(n + 1)]
    own = 0  # sum of the rows' own least costs
    best, after = 0, 0  # pairs from the next staying row on, and from the one behind it
    head: Row | None = None  # the next staying row

    def pair(state: int, slack: int) -> int:
        """Extra cost of ``head`` (or the end) where it cannot follow ``state``, whose row can change for ``slack``."""
        if head is None:
            return min(slack, INSERT) if final and state not in ACCEPT else 0
        return 0 if head[0] in NEXT[state] else min(slack, INSERT, _slack(head))

    def fill(i: int) -> None:
        for state in range(4):  # what is emitted cannot be edited any more: an insert or an edit of the head helps
            out[i][state] = own + max(best, pair(state, INSERT) + after)

    fill(n)
    for i in range(n - 1, -1, -1):
        initial, goes, cut = rows[i]
        if goes:
            own += DELETE
        else:
            known = initial in AFTER
            stay = (KEEP if known else REROLE) + (TRUNCATED if cut else 0)
            own += min(stay, DELETE)
            # an unknown initial already pays its own edit, which may mend the neighbourhood as well
            joined = pair(AFTER[initial], _slack(rows[i])) + after if known else 0
            best, after = max(best, joined), best
            head = rows[i]
        fill(i)
    return out


def _slack(row: Row) -> int:
    """The least that another edit of a staying row costs beyond its own least cost."""
    initial, _, cut = row
    if initial not in AFTER:
        return 0
    return min(REROLE, DELETE - (TRUNCATED if cut else 0))


Label = tuple[int, str]  # cost, audit


def search(rows: list[Row], starts: dict[int, Label], final: bool) -> tuple[dict[int, Label], int]:
    """The least label in each end state (one, in an accepted state, if ``final``), and how many prefixes were taken up."""
    n = len(rows)
    low = bounds(rows, final)
    table_: dict[tuple[int, int], Label] = {}
    done: dict[int, Label] = {}
    reached: dict[int, int] = {}  # what each end state costs at most, by the incumbents and inserts
    stack: list[tuple[int, int, int, str]] = []
    taken = 0

    def cut_off(i: int, state: int, cost: int, audit: str) -> bool:
        """The incumbents are better than anything this prefix can become."""
        least = cost + low[i][state]
        if final:
            held = done.get(ASSISTANT)
            return held is not None and (least > held[0] or least == held[0] and audit > held[1][:len(audit)])
        return all(reached.get(end, least) < least for end in REACH[state])

    def offer(i: int, state: int, cost: int, audit: str) -> bool:
        held = table_.get((i, state))
        if held is not None and held <= (cost, audit) or cut_off(i, state, cost, audit):
            return False
        table_[i, state] = cost, audit
        return True

    for state, (cost, audit) in starts.items():
        if offer(0, state, cost, audit):
            stack.append((0, state, cost, audit))
    while stack:
        i, state, cost, audit = stack.pop()
        if table_[i, state] != (cost, audit) or cut_off(i, state, cost, audit):
            continue  # beaten since it was put there
        taken += 1
        if i == n:
            end = ASSISTANT if final else state
            if not final or state in ACCEPT:
                done[end] = min(done.get(end, (cost, audit)), (cost, audit))
                for b in range(4):
                    if (end, b) in SHIFT:
                        reached[b] = min(reached.get(b, done[end][0] + SHIFT[end, b]), done[end][0] + SHIFT[end, b])
        emitted = NEXT[state][EMIT[state]]
        ways = [(i, emitted, cost + INSERT, audit + "I")]
        if i < n:
            initial, goes, cut = rows[i]
            ways.append((i + 1, state, cost + DELETE, audit + "D"))
            if not goes:
                more = TRUNCATED if cut else 0
                if initial in NEXT[state]:
                    ways.append((i + 1, NEXT[state][initial], cost + KEEP + more, audit + "K"))
                ways.append((i + 1, emitted, cost + REROLE + more, audit + "R"))
        ways = [w for w in ways if offer(*w)]
        # the most promising comes off the stack first: least bound, then most rows, then least audit
        ways.sort(key=lambda w: w[3], reverse=True)
        ways.sort(key=lambda w: (w[2] + low[w[0]][w[1]], -w[0]), reverse=True)
        stack.extend(ways)
    return done, taken


def cheapest(rows: Iterable[Row], block: int = BLOCK) -> tuple[int, str, int]:
    """Cost and audit of the cheapest repair, and how many prefixes the search took up."""
    rows = list(rows)
    labels: dict[int, Label] = {START: (0, "")}
    settled: list[str] = []
    taken = 0
    at = 0
    while len(rows) - at > block:
        labels, more = search(rows[at:at + block], labels, False)
        at, taken = at + block, taken + more
        shared = len(os.path.commonprefix([a for _, a in labels.values()]))
        settled.append(next(iter(labels.values()))[1][:shared])
        labels = {s: (c, a[shared:]) for s, (c, a) in labels.items()}
    done, more = search(rows[at:], labels, True)
    cost, audit = done[ASSISTANT]
    return cost, "".join(settled) + audit, taken + more


def repaired(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The rows (role, text) that an audit leaves; ``rows`` are those it was worked out for."""
    state = START
    for edit in audit:
        if edit == "I":
            role, text = {"u": "user", "a": "assistant"}[EMIT[state]], ""
        else:
            role, text = next(rows)
            if edit == "D":
                continue
            if edit == "R":
                role = {"u": "user", "a": "assistant"}[EMIT[state]]
        state = NEXT[state][role[:1]]
        yield role, text


_OUT = ("conv_id {0}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
        "repaired_sha256 string, n_rows long, searched long")


def repair(rows: DataFrame, key: str = "conv_id", position: str = "turn", role: str = "role", text: str = "text",
           alive: str | None = None) -> DataFrame:
    """One row per ``key``: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, n_rows, searched.

    Rows of a conversation are taken by ``position``, nulls first; rows of one position by role and text. Null
    roles and texts are one space. A null key is a conversation as any other. Rows where ``alive`` is false
    only name their conversation; one without other rows has zeros, an empty audit and the digest of nothing.
    Columns beyond the four play no part, whatever their names. ``searched``: prefixes the search took up.
    """
    kind = rows.schema[key].dataType.simpleString()
    body = F.coalesce(F.col(text), F.lit(" "))
    last = F.regexp_extract(body, r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    flat = rows.select(
        F.col(key).alias("__key"), F.col(position).cast("long").alias("__at"), (F.col(alive) if alive else F.lit(True)).alias("__alive"),
        F.coalesce(F.col(role), F.lit(" ")).alias("__role"), body.alias("__text"),
        F.when(last == "", "b").when(last.isin(".", "!", "?"), "w").otherwise("t").alias("__ends"))

    def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one: _Conversation | None = None
        done: list[tuple] = []
        schema = None
        for b in batches:
            schema = pa.schema([pa.field("conv_id", b.schema.field("__key").type), *_FIELDS])
            for k, at, ok, who, said, ends in zip(*(b.column(c).to_pylist() for c in ("__key", "__at", "__alive", "__role", "__text", "__ends")), strict=True):
                if one is None or one.key != k:
                    if one is not None:
                        done.append(one.result())
                    one = _Conversation(k)
                if ok:
                    one.add(at, who, said, ends)
            if len(done) >= 4096:
                yield _batch(done, schema)
                done = []
        if one is not None:
            done.append(one.result())
        if done:
            yield _batch(done, schema)

    ordered = flat.repartition(F.col("__key")).sortWithinPartitions(
        F.col("__key"), F.col("__at").asc_nulls_first(), "__role", "__text")
    return ordered.mapInArrow(conversations, _OUT.format(kind)).withColumnRenamed("conv_id", key)


_FIELDS = [pa.field(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [
    pa.field("audit", pa.string()), pa.field("repaired_sha256", pa.string()), pa.field("n_rows", pa.int64()), pa.field("searched", pa.int64())]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


class _Conversation:
    """The rows of one conversation as they come by."""

    def __init__(self, key):
        self.key = key
        self.rows: list[Row] = []
        self.first = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.seen: set[bytes] = set()
        self.held = tempfile.SpooledTemporaryFile(max_size=SPOOL)

    def add(self, at: int | None, role: str, text: str, ends: str) -> None:
        if at is not None and at != self.last:
            self.first = at if self.first is None else self.first
            self.last, self.turns = at, self.turns + 1
        raw = (role.encode(), text.encode())
        digest = hashlib.blake2b(len(raw[0]).to_bytes(8, "little") + raw[0] + raw[1], digest_size=16).digest()
        again = digest in self.seen
        self.seen.add(digest)
        blank, duplicate = ends == "b", ends != "b" and again
        truncated = ends == "t" and not again
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated
        if self.rows and self.rows[-1][0] + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.rows.append((role[:1], blank or duplicate, truncated))
        for x in raw:
            self.held.write(len(x).to_bytes(8, "little") + x)

    def result(self) -> tuple:
        cost, audit, searched = cheapest(self.rows)
        digest, first = hashlib.sha256(), True
        self.held.seek(0)

        def again() -> Iterator[tuple[str, str]]:
            for _ in self.rows:
                role, text = (self.held.read(int.from_bytes(self.held.read(8), "little")) for _ in range(2))
                yield role.decode(), text.decode()

        for role, text in repaired(audit, again()):
            digest.update((("" if first else "\n") + f"{role}:{text}").encode())
            first = False
        self.held.close()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, digest.hexdigest(), len(self.rows), searched)


def damage(conversations: DataFrame) -> DataFrame:
    """conversations with damage by crc32 of ``conv_id:turn`` modulo 20, and ``alive``, false for dropped rows.

    0 drops the row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats the row, 4 makes its role user.
    Nulls are one space, in the key of the sum as well.
    """
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    x = (F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20).alias("x")
    text: Column = F.when(F.col("x") == 1, "").when(F.col("x") == 2, F.regexp_replace(word("text"), "[.!?]", "")).otherwise(word("text"))
    copies = F.sequence(F.lit(1), F.when(F.col("x") == 3, 2).otherwise(1))
    return (conversations.select("conv_id", "turn", "role", "text", x)
            .select("conv_id", "turn", F.when(F.col("x") == 4, "user").otherwise(word("role")).alias("role"), text.alias("text"),
                    (F.col("x") != 0).alias("alive"), F.explode(copies).alias("copy")).drop("copy"))


def query(spark, sf_dir: str) -> DataFrame:
    """op12: the damaged conversations and their cheapest repairs."""
    out = repair(damage(table(spark, sf_dir, "conversations")), alive="alive")
    return out.drop("n_rows", "searched")


#: The damage, the faults, and the least labels of the four states row by row.
SQL = r"""
WITH RECURSIVE
steps AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
keyed AS (SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(name, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]::BIGINT))) % 20 AS x FROM named, steps),
damaged AS (SELECT conv_id, turn, CASE WHEN x = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN x = 1 THEN '' WHEN x = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM keyed, range(CASE x WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
judged AS (SELECT *, left(role, 1) AS initial, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ends,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
faults AS (SELECT *, ends = '' AS blank, ends <> '' AND again AS duplicate,
    ends <> '' AND NOT again AND ends NOT IN ('.', '!', '?') AS truncated FROM judged),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
    FROM faults GROUP BY conv_id),
every AS (SELECT DISTINCT conv_id FROM conversations),
-- before a row: the least label (cost, audit, repaired rows) at the start, after a system, a user and an assistant row
walk AS (
    SELECT conv_id, 0::BIGINT AS i, {'c': 0, 'a': '', 't': ''} AS s, NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR) AS y,
        {'c': 3, 'a': 'I', 't': chr(10) || 'user:'} AS u, {'c': 6, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'} AS z FROM every
    UNION ALL
    SELECT conv_id, i, s, y,
        list_min([u, CASE WHEN z IS NOT NULL THEN {'c': z.c + 3, 'a': z.a || 'I', 't': z.t || chr(10) || 'user:'} END,
            CASE WHEN y IS NOT NULL THEN {'c': y.c + 3, 'a': y.a || 'I', 't': y.t || chr(10) || 'user:'} END,
            {'c': s.c + 3, 'a': s.a || 'I', 't': s.t || chr(10) || 'user:'}]),
        list_min([z, CASE WHEN u IS NOT NULL THEN {'c': u.c + 3, 'a': u.a || 'I', 't': u.t || chr(10) || 'assistant:'} END,
            CASE WHEN y IS NOT NULL THEN {'c': y.c + 6, 'a': y.a || 'II', 't': y.t || chr(10) || 'user:' || chr(10) || 'assistant:'} END,
            {'c': s.c + 6, 'a': s.a || 'II', 't': s.t || chr(10) || 'user:' || chr(10) || 'assistant:'}])
    FROM (
        SELECT conv_id, i + 1 AS i, {'c': s.c + 4, 'a': s.a || 'D', 't': s.t} AS s,
            list_min([CASE WHEN y IS NOT NULL THEN {'c': y.c + 4, 'a': y.a || 'D', 't': y.t} END,
                CASE WHEN stays AND initial = 's' THEN {'c': s.c + more, 'a': s.a || 'K', 't': s.t || own} END]) AS y,
            list_min([CASE WHEN u IS NOT NULL THEN {'c': u.c + 4, 'a': u.a || 'D', 't': u.t} END] || list_transform([s, y, z], lambda p:
                CASE WHEN p IS NULL OR NOT stays THEN NULL WHEN initial = 'u' THEN {'c': p.c + more, 'a': p.a || 'K', 't': p.t || own}
                ELSE {'c': p.c + 3 + more, 'a': p.a || 'R', 't': p.t || chr(10) || 'user:' || text} END)) AS u,
            list_min([CASE WHEN z IS NOT NULL THEN {'c': z.c + 4, 'a': z.a || 'D', 't': z.t} END,
                CASE WHEN u IS NULL OR NOT stays THEN NULL WHEN initial = 'a' THEN {'c': u.c + more, 'a': u.a || 'K', 't': u.t || own}
                ELSE {'c': u.c + 3 + more, 'a': u.a || 'R', 't': u.t || chr(10) || 'assistant:' || text} END]) AS z
        FROM (SELECT w.*, f.initial, f.text, NOT (f.blank OR f.duplicate) AS stays, CASE WHEN f.truncated THEN 3 ELSE 0 END AS more,
                chr(10) || f.role || ':' || f.text AS own
            FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1))),
best AS (SELECT w.conv_id, CASE WHEN z IS NULL OR s <= z THEN s ELSE z END AS b
    FROM walk w LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id WHERE w.i = coalesce(c.n, 0))
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
    coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, b.c::BIGINT AS cost, b.a AS audit,
    sha256(substr(b.t, 2)) AS repaired_sha256
FROM every e JOIN best ON best.conv_id IS NOT DISTINCT FROM e.conv_id
    LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""
