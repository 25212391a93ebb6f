"""The corpus pipeline: STAGES over documents, each stage's output the next one's input.

Each stage takes documents with any further columns, and all but the last return the columns they got.  Defined results: a null text is
the empty text throughout, is scored by the classifier like any other, has no near-duplicates but other empty texts, weighs nothing in
the mix and so ends there; repeated rows are copies, of which exact dedup keeps one; ties and very long texts are handled as each operator's
module says; an empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scriptorium.llm import byte_bpe, exact_dedup, mixing, near_dedup, pu_quality
from scriptorium.llm.shared import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores under its cut go; it learns from the labels that are not held out."""
    return pu_quality.accepted(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the row with the least doc_id stays."""
    return near_dedup.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.repeat(docs)


#: Pieces that the encoder remembers here, fewer than by itself, as a worker has held the stages before as well.
PIECES = 100_000


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns but text, the ids of the text, and the SHA-256 of the bytes that the ids decode to."""
    import public_tokenizers

    return byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, pieces=PIECES, decoded_col="decoded_sha256")


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("near dedup", near), ("mixing", mix), ("byte-level BPE", encode)]
#: Learnt models and signatures have no SQL; tests/llm/test_pipeline.py holds each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
