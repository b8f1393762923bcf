"""A training corpus from ``documents``: known language, one of each near-duplicate class, no repeated
passages, packed into sequences. Each stage reads what its predecessor wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetflow.llm import language, neardup, packing, pieces, substrings
from assetflow.llm.common import stored, table

#: Least posterior of the predicted language.
CONFIDENT = 0.5
#: Keys from here on are hashes of rows that their id does not tell apart.
_ODD = 1 << 62


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a letter whose language is predicted with confidence; if no document has a
    language to learn from, those with a letter."""
    model = language.fit(docs, pieces.default_vocabulary())
    if not model[0]:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    named = language.identify(docs, model, pieces.default_vocabulary(), lang_col="__lang", score_col="__score")
    return named.where((F.col("__lang") != language.UNDEFINED) & (F.col("__score") >= CONFIDENT)).select(*docs.columns)


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class, that with the least key; rows are told apart by row, not by id.

    A row's key is its id. Rows without an id or sharing one with others have a hash of id and text above all
    ids instead, so of texts with one id each is judged by itself and goes only with its own likes. Rows of one
    id and one text are copies, of which the least by the other columns stays.
    """
    odd = docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("__odd"))
    plain = odd.isEmpty()
    mixed = F.lit(_ODD) + F.pmod(F.xxhash64("doc_id", "text"), F.lit(_ODD - 1))
    keyed = docs.withColumn("__key", F.col("doc_id").cast("long")) if plain else (
        docs.join(odd, F.col("doc_id").eqNullSafe(F.col("__odd")), "left")
        .withColumn("__key", F.when(F.col("__odd").isNotNull() | F.col("doc_id").isNull(), mixed).otherwise(F.col("doc_id"))).drop("__odd"))
    gone = neardup.classes(keyed.select("__key", "text"), key="__key").where("__key <> class_id").select("__key").distinct()
    left = keyed.join(gone, "__key", "left_anti")
    if not plain:
        left = left.groupBy("__key").agg(F.min(F.struct(*docs.columns)).alias("__row")).select("__row.*")
    return left.select(*docs.columns)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated passages out of the texts; n_chars follows. Null texts stay null; no row goes."""
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select("doc_id", "text", F.struct(F.col("text").isNull().alias("__none"), *rest).alias("__rest"))
    out = substrings.remove(rows).withColumn("text", F.when(~F.col("__rest.__none"), F.col("text")))
    kind = dict(docs.dtypes)
    column = {"text": F.col("text"), "n_chars": F.length("text").cast(kind.get("n_chars", "bigint"))}
    return out.select(*[column.get(c, F.col("__rest").getField(c)).alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, packing.default_vocabulary())


STAGES = [
    ("language", language_stage),
    ("near_duplicates", neardup_stage),
    ("repeated_passages", repeats_stage),
    ("packing", packing_stage),
]

#: No stage's models, signatures or tokens can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
