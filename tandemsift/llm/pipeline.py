"""The corpus pipeline: quality, near duplicates, personal data, mixing, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, mixing, ngram_join, pii, quality, sentence_pieces


def whole(docs: DataFrame) -> Column:
    """All columns of a row as one, so that none meets a column of an operator's result."""
    return F.struct(*docs.columns).alias("_doc")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps.

    Nulls and empty texts are judged as empty ones, repeated rows alike; an empty table gives none; all columns stay.
    """
    packed = docs.select("doc_id", "text", "source", "lang", whole(docs))
    return quality.classify(packed, common.table(spark, sf_dir, "labels"), texts=False).filter("keep").select("_doc.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the smallest id. Documents without words stay.

    Shingles have five words and sets link at a similarity of 0.8. Rows that repeat an id with another text are
    documents of their own; of rows without an id, and of equal rows, one of a component stays at most.
    """
    return ngram_join.survivors(docs, n=5, percent=80)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked in their text, and n_chars to match; null texts keep theirs."""
    return pii.masked(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, at most twice.

    A null source is a source of its own; null and empty texts have no words and may go; rows that repeat an id are
    documents of their own; an empty table gives none.
    """
    packed = docs.select("doc_id", "source", common.word_count(F.col("text")).alias("size"), whole(docs))
    return mixing.emitted(mixing.mix(packed)).select("_doc.*")


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids; round_trip and parity tell whether decoding and the original library agree.

    Null texts have no ids; an empty table gives none; all rows and columns stay.
    """
    return sentence_pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("personal data", personal_data_stage),
    ("mixing sources", mixing_stage),
    ("SentencePiece tokens", token_stage),
]

#: Trained classifiers and tokens have no SQL form; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Every stage's output is written to the shared folder and read again.

    What a stage stored on its way is removed once its output is written; the last stage's input stays, as the result
    is read from it. Nulls, repeated rows and an empty table are as in the stages.
    """
    docs = common.table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES[:-1]):
        mark, before = common.mark(), docs
        docs = common.stored(stage(spark, before, sf_dir), f"stage-{place}")
        common.clean(spark, mark, docs)
        if place:
            common.remove(before, spark)
    return STAGES[-1][1](spark, docs, sf_dir)
