"""From documents to training tokens: five stages, each an operator of hourlake.llm on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.llm import line_dedup, minhash, mixing, sentencepiece_codec, toxicity
from hourlake.llm.common import fresh, lean, read, stored

MODEL = "piece_bpe_32k.model"


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half, with all their columns, whatever those are called.

    A null text is scored as the empty one, repeated rows each; a null doc_id is scored and not learnt from. Documents in no labels are
    scored like all others. An empty table gives an empty result.
    """
    lean(spark)
    model = toxicity.train(docs, toxicity.training_rows(read(spark, sf_dir, "labels", "doc_id", "toxic")))
    found = fresh(docs, "_toxicity")
    scored = toxicity.score(docs, model, into=found)
    return scored.where(F.col(found)["score"] < 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that match earlier ones; n_chars, if there is such a column, follows the text.

    A document that loses all its lines with words goes; an empty or null text stays as it is (n_chars of a null text is null). Of lines
    that tie, that of the smaller doc_id stays, a null doc_id first; repeated rows are one document and stay, cut alike. An empty table gives an empty result.
    """
    lean(spark)
    out = line_dedup.dedup_lines(docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: sets of five-word shingles, a Jaccard index of 0.8 or more.

    The least doc_id of a group stays; rows repeated in doc_id and text are one. Empty and null texts are in no group and stay. An empty table gives an empty result.
    """
    lean(spark)
    return minhash.deduplicated(docs, words=5, threshold=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, with all their columns.

    Null sources are one source. Texts without words take no share and go. Ties are broken by doc_id and size. An empty table gives an empty result.
    """
    lean(spark)
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, packed in 32 bits each, with begin and end ids, and the hash of the text that they decode to.

    A null text has the begin and end ids alone; repeated rows are encoded each; an empty table gives an empty result. Other columns than doc_id and source are left out.
    """
    lean(spark)
    coded = sentencepiece_codec.round_trip(docs.select("doc_id", "source", "text"), public_tokenizers.path(MODEL), into="pieces")
    return coded.select(
        "doc_id",
        "source",
        (F.octet_length("pieces.ids") / 4).cast("long").alias("n_tokens"),
        F.col("pieces.ids").alias("ids"),
        F.sha2(F.col("pieces.decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("near-dedup", without_near_copies),
    ("mixing", mixed),
    ("encoding", encoded),
]

#: The first stage is a trained model, which SQL cannot express; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of sf_dir, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs
