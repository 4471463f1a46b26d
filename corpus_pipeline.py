"""The corpus pipeline: five operators one after the other, each on what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cargoweave.llm import byte_bpe, line_dedup, minhash_dedup, mixing, toxicity
from cargoweave.llm.common import small_batches, staged, table
from cargoweave.llm.queries import PATTERN, RANKS


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model rejects go. It learns from the given labels, of which
    those of documents no longer here do not count."""
    small_batches(spark)
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier in the corpus go; n_chars follows the text. A document of which
    no line stays goes with them."""
    small_batches(spark)
    lines = line_dedup.without_repeated_lines(docs)
    stays = ~((F.col("n_removed") > 0) & (F.trim(F.col("text")) == ""))
    return (
        lines.where(F.coalesce(stays, F.lit(True)))
        .withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
        .select(*docs.columns)
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays."""
    small_batches(spark)
    return minhash_dedup.one_of_each_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated, so that sources have their target shares."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become token ids: doc_id, source, n_tokens, ids."""
    small_batches(spark)
    coded = byte_bpe.encode(docs.select("doc_id", "source", "text"), RANKS, PATTERN)
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("byte_bpe", encode),
]

#: Stages 1 to 3 and 5 cannot be expressed in SQL; they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; what a stage returns is written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
