"""The corpus pipeline: five stages over ``documents``, each calling an operator
of ``tidemark.llm``; each stage's result is written as Parquet and read again as
the next stage's input. All stages but the last return the columns of their
input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import langid, omh, queries, substring, toxicity
from tidemark.llm.common import cut
from tidemark.session import scratch_path

#: A document stays when its language holds at least this share of its words' posterior mass.
LEAST_LANGUAGE_SHARE = 0.3
TOXIC_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: neither ``und`` (null, or without letters)
    nor a mixture in which no language has LEAST_LANGUAGE_SHARE."""
    judged = langid.predict(docs, langid.fit(docs), lang="__lang", score="__share")
    return judged.where(F.col("__lang") != langid.UNKNOWN).where(F.col("__share") >= LEAST_LANGUAGE_SHARE).select(*docs.columns)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below TOXIC_SCORE."""
    model = queries.toxicity_model(spark, sf_dir, docs)
    return toxicity.score(docs, model, out="__score").where(F.col("__score") < TOXIC_SCORE).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of near copies.
    Documents without a doc_id stay."""
    gone = omh.near_duplicates(docs).where("NOT kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 35-word windows that occur more than once. A document
    that loses all its words stays, empty; n_chars follows the text."""
    done = substring.remove_repeats(docs, 35)
    return done.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a packed piece. The pieces are written here: only so do a few
    texts at a time reach the workers (see ``cut``)."""
    return cut(queries.packed(docs), "packed")


STAGES = [("language ID", language), ("toxicity", toxic), ("MinHash near-dedup", near_copies), ("substring dedup", repeats), ("packing", pack)]

#: SQL can state neither the learned stages nor near copies and packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
