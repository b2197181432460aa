"""Documents to training sequences: filter by language and toxicity, drop near-duplicates, redact secrets, pack.

Each stage reads what its predecessor kept, from Parquet in the shared folder, and calls one operator of
``marketlake.llm`` with its production parameters. All but the last return the columns of ``documents``, whatever
their names: beside what an operator reads, a row travels as one struct.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import langid, minhash, packing, secret_scan, toxicity
from marketlake.llm.graph import if_small, tables, written

# A text of this many characters whose grams are almost all foreign to every learned language is not text.
LEAST_CHARS = 40
LEAST_SCORE = 0.3


def carried(docs: DataFrame, *names: str | Column) -> DataFrame:
    """The columns ``names`` and the whole row as ``row``, out of the way of columns that an operator adds."""
    return docs.select(*names, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def restored(rows: DataFrame) -> DataFrame:
    return rows.select("row.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a learned language: texts without a letter go, and longer ones that fit no language.

    Languages are learned from the rows that are not held out (crc32 of doc_id modulo 4 is not 2). Null texts go.
    """
    filters = langid.learn(docs.where(~langid.held_out("doc_id", 4, 2)))
    found = langid.identified(carried(docs, "text"), filters, ["row"])
    foreign = (F.length("row.text") >= LEAST_CHARS) & (F.col("score") < LEAST_SCORE)
    return restored(found.where((F.col("lang_pred") != langid.UNKNOWN) & ~foreign))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier calls toxic; it learns from labels that are not held out (modulo 3 is not 1)."""
    labels = tables(spark, sf_dir, "labels").where(~langid.held_out("doc_id", 3, 1))
    model = toxicity.learn(docs.select("doc_id", "text"), labels)
    return restored(toxicity.scored(carried(docs, "text"), model, ["row"]).where("predicted = 0"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each group of near-duplicates, and one row of rows that repeat a doc_id and its text.

    Rows are told apart by doc_id and text. Documents without words or without a doc_id belong to no group and stay.
    """
    key = ["doc_id", "text_hash"]
    found = written(minhash.near_duplicates(docs, hashed=True), "near-duplicates")
    gone = written(found.where("NOT kept").select(*key).distinct(), "gone")
    again = written(found.where("kept AND doc_id IS NOT NULL").groupBy(*key).count().where("count > 1").select(*key), "repeated")
    left = carried(docs, "doc_id", F.xxhash64("text").alias("text_hash")).join(if_small(gone), key, "left_anti")
    again = if_small(again)
    once = left.join(again, key, "left_anti").select("row")
    return restored(once.unionByName(left.join(again, key, "left_semi").dropDuplicates(key).select("row")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Redact secrets; ``n_chars`` is the length of the text that is left."""
    return secret_scan.redacted(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of full sequences of 2048 ids, neighbours on the curve together."""
    return packing.packed_sequences(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("packing", pack),
]

# A learned classifier and a tokenizer are no SQL; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = tables(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
