"""The queries of this subpackage, and the SQL that states those which SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.llm import embedding_dedup, licences, line_dedup, neighbours, oracle, sentencepiece_codec, toxicity
from hourlake.llm.common import read, stored, text_or_empty
from hourlake.llm.minhash import near_duplicates
from hourlake.llm.mixing import default_quality, mix, word_count
from hourlake.llm.token_counts import count_tokens
from hourlake.llm.warc import round_trip

#: Tokens beyond which a document is over the limit.
TOKEN_LIMIT = 1024


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = sentencepiece_codec.round_trip(read(spark, sf_dir, "documents", "doc_id", "text"), model).select("doc_id", "pieces.*")
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.sha2("ends", 256).alias("span_ends_sha256"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.train(docs, toxicity.training_rows(read(spark, sf_dir, "labels", "doc_id", "toxic")))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"),
        F.size("toxicity.spans").alias("n_spans"),
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "source", "text")
    sized = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("words")), "mix-sizes")
    mixed = mix(sized, size="words", quality=default_quality(F.col("words")))
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"), words=2, threshold=80).drop("text_hash")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = round_trip(read(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [F.col("doc_id"), line_dedup.lines_with_words(F.col("text")).cast("long").alias("n_lines")]
    rows = line_dedup.with_removed(read(spark, sf_dir, "documents", "doc_id", "text"), "removed", columns=columns)
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return rows.select(
        "doc_id",
        "n_lines",
        F.size(removed).cast("long").alias("n_removed"),
        F.array_join(removed.cast("array<string>"), ",").alias("removed_lines"),
    )


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licences.scan(read(spark, sf_dir, "documents", "doc_id", "text"))
    return scanned.select(
        "doc_id",
        F.array_join("licence_scan.licences", ",").alias("licences"),
        F.array_join("licence_scan.sentences", ",").alias("sentences"),
        F.col("licence_scan.unknown").alias("n_unknown"),
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    counted = count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
    )


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_toxicity": op2_toxicity,
    "op3_mixing": op3_mixing,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_neighbours": op5_neighbours,
    "op6_minhash": op6_minhash,
    "op7_warc": op7_warc,
    "op8_line_dedup": op8_line_dedup,
    "op9_licences": op9_licences,
    "op10_token_counts": op10_token_counts,
}

ORACLE: dict[str, str] = oracle.SQL
