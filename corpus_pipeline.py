"""The corpus pipeline: language, near duplicates, personal data, source mix, pieces.  Each stage works on what the one before kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import language, mixing, near_join, pieces, private
from ledgerloom.session import ensure_checkpoint_dir

#: A document needs this share of its letters in one language.
MIN_LANGUAGE_SHARE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those in which no language holds half of the letters."""
    labelled = language.identify(docs, language.train(docs), prefix="_stage_")
    return labelled.filter((F.col("_stage_lang_pred") != language.UNKNOWN) & (F.col("_stage_score") >= MIN_LANGUAGE_SHARE)).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_join.keep_first(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return private.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.apply_mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs, pieces.Pieces.load(pieces.MODEL)).select("doc_id", "ids", F.coalesce(F.size("ids"), F.lit(0)).alias("n_ids"))


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("PII", without_personal_data),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", encoded),
]

#: SQL cannot express signatures, subset sums and merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
