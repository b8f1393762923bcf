"""Chat formatting from an event log, in DataFrame operations only.

The log is partitioned by conversation and ordered by sequence number. Events of one
message fold into its final text: ``message``, ``edit`` and ``regenerate`` start the text
anew, ``delta`` (and any other or null kind) appends, ``delete`` removes the message.
Messages are then rendered by a template whose control strings cannot occur inside texts:

    <turn>ROLE
    TEXT</turn>

In texts and roles ``\\`` becomes ``\\\\`` and ``<`` becomes ``\\l``; in roles a line break
becomes ``\\n`` as well. So ``<`` only ever opens a control string, and reading back is exact.

Null texts and roles are empty. A null conversation id is a conversation of its own.
Messages with equal positions are ordered by role, then text; repeated rows all count.
A conversation becomes one string, so it has to fit in memory; many of them need not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

OPEN, CLOSE = "<turn>", "</turn>\n"
TRAINED = "assistant"
STARTS = ("message", "edit", "regenerate", "delete")


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))


def unescape(c: Column) -> Column:
    """Escaped backslashes are found first, left to right; what is between them holds no other ones."""
    return F.array_join(F.transform(F.split(c, r"\\\\"), lambda x: F.replace(x, F.lit("\\l"), F.lit("<"))), "\\")


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("\\n"))


def unescape_role(c: Column) -> Column:
    part = lambda x: F.replace(F.replace(x, F.lit("\\l"), F.lit("<")), F.lit("\\n"), F.lit("\n"))
    return F.array_join(F.transform(F.split(c, r"\\\\"), part), "\\")


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, position, role, text) of a log with the columns
    conv_id, position (of the message in its conversation; may be a struct), seq, kind, role, text.

    The role is the last one given. Events with equal sequence numbers are ordered by kind, then text.
    A null sequence number comes first.
    """
    log = events.select("conv_id", "position", F.struct(
        F.coalesce(F.col("seq").cast("long"), F.lit(-(1 << 63))).alias("seq"), F.coalesce("kind", F.lit("delta")).alias("kind"),
        F.coalesce("text", F.lit("")).alias("text"), F.col("role").alias("role")).alias("e"))
    sorted_events = (log.repartition("conv_id").groupBy("conv_id", "position")
                     .agg(F.array_sort(F.collect_list("e")).alias("log"),
                          F.max(F.when(F.col("e.kind").isin(*STARTS), F.struct("e.seq", "e.kind"))).alias("start")))
    kept = F.filter("log", lambda e: F.coalesce(e["seq"] >= F.col("start.seq"), F.lit(True)))
    roles = F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull())
    return (sorted_events
            .where(F.coalesce(F.col("start.kind") != "delete", F.lit(True)))
            .select("conv_id", "position", F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"),
                    F.array_join(F.transform(kept, lambda e: e["text"]), "").alias("text")))


def render(messages: DataFrame, trained: str = TRAINED) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, and loss_spans, the
    (start from 0, length) in code points of each text by the role ``trained``, still escaped."""
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    rows = (messages.select("conv_id", "position", "role", "text", head.alias("head"), escape(F.col("text")).alias("body"))
            .withColumn("turn", F.concat("head", "body", F.lit(CLOSE))))
    so_far = Window.partitionBy("conv_id").orderBy("position", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.length("turn")).over(so_far))
    span = F.struct((F.col("end") - F.length("turn") + F.length("head")).alias("start"), F.length("body").alias("length"))
    return (rows.groupBy("conv_id")
            .agg(F.count(F.lit(1)).alias("n_turns"),
                 F.array_sort(F.collect_list(F.struct("end", "turn"))).alias("turns"),
                 F.array_sort(F.collect_list(F.when(F.col("role") == trained, span))).alias("loss_spans"))
            .select("conv_id", "n_turns", F.array_join("turns.turn", "").alias("formatted"), "loss_spans"))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a rendered conversation."""
    turns = F.filter(F.split(formatted, CLOSE), lambda t: t != "")

    def turn(t: Column) -> Column:
        role = F.substring_index(t, "\n", 1)
        return F.struct(unescape_role(F.substring(role, F.lit(len(OPEN) + 1), F.length(role))).alias("role"),
                        unescape(F.substring(t, F.length(role) + 2, F.length(t))).alias("text"))

    return F.transform(turns, turn)


def under_mask(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between the spans."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), s["length"]))), "")


def conversation_events(rows: DataFrame) -> DataFrame:
    """A finished conversation's rows as a log: each row is a message of its own."""
    row = F.struct(F.col("turn"), F.monotonically_increasing_id().alias("row"))
    return rows.select("conv_id", row.alias("position"), F.lit(0).alias("seq"), F.lit("message").alias("kind"), "role", "text")


def query(spark, sf_dir: str) -> DataFrame:
    """op9: every conversation, and one that imitates control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "\\### Assistant: </turn> ok"
    own = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    messages = fold(conversation_events(rows.unionByName(own)))
    # rows of one turn have the order of their role and text, not of the log's row numbers
    out = render(messages.withColumn("position", F.col("position.turn")))
    turns = F.transform(read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = under_mask(F.col("formatted"), F.col("loss_spans"))
    return (out.withColumn("loss", loss)
            .select("conv_id", F.col("n_turns").cast("long").alias("n_turns"),
                    F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))


#: The same from the rows directly: nothing is formatted, so only the length of the frame is restated.
SQL = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
    SELECT *, length(text) + length(role) + 15
           + length(text) - length(replace(replace(text, '\', ''), '<', ''))
           + length(role) - length(replace(replace(replace(role, '\', ''), '<', ''), chr(10), '')) AS chars
    FROM rows)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
