"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import (
    language, merkle, mixing, near_join, near_vectors, oracles, pages, pieces, private, quality, repeats, spelling, substrings, token_count,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken", "repeats")


@query
def op2_near_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_join.near_join(table(spark, folder, "documents")).select("doc_id", "class_id", "n_links", "n_copies")


@query
def op3_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = pieces.Pieces.load(pieces.MODEL)
    encoded = pieces.encode(table(spark, folder, "documents"), vocabulary)
    return encoded.select("doc_id", "ids", F.coalesce(F.size("ids"), F.lit(0)).alias("n_ids"),
                          F.unhex(F.md5(pieces.decode(F.col("ids"), vocabulary))).eqNullSafe(F.col("text_md5")).alias("round_trip"))


@query
def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labelled = language.identify(docs.select("doc_id", "text"), language.train(docs))
    return labelled.select("doc_id", language.is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op10_private(spark: SparkSession, folder: str) -> DataFrame:
    return private.digest(private.find_private(table(spark, folder, "documents")))


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


@query
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_count.count_tokens(table(spark, folder, "documents"), token_count.automaton_of(pieces.MODEL))


@query
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.judge(docs, quality.log_ratios(docs, table(spark, folder, "labels")))


@query
def op7_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op9_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, folder, "embeddings"))


@query
def op8_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeated_spans(table(spark, folder, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(table(spark, folder, "documents"))


@query
def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


ORACLES["op11_merkle"] = oracles.merkle()
ORACLES["op13_spelling"] = oracles.spelling()


@query
def op12_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.repeated_words(table(spark, folder, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLES["op12_substrings"] = oracles.substrings()
