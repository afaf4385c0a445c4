"""The documents made ready for training: stages applied one after another to the whole table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last keep the columns of ``documents``. ``run`` writes each result as Parquet
in the shared folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from emberwall.llm import bpe, linededup, minhash, mixing, toxicity
from emberwall.llm.common import cut_lineage, table

#: Near-duplicates share this share of their shingles of five words; a pair at 0.8 agrees in fewer than 36 of 64
#: coordinates about four times in a million.
NEAR_PERCENT, NEAR_MATCHES = 80, 36


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose noisy-or of sentence scores reaches one half go; learnt from the labels not held out."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are cut out; a document left without a line goes."""
    cut = linededup.dedup_lines(docs).where("line_dedup.n_removed < line_dedup.n_lines")
    left = F.col("line_dedup.text")
    changed = F.col("line_dedup.n_removed") > 0
    return cut.withColumns({"text": left, "n_chars": F.when(changed, F.length(left)).otherwise(F.col("n_chars")).cast(
        docs.schema["n_chars"].dataType)}).select(*docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one of the smallest doc_id."""
    return minhash.one_of_each(docs, percent=NEAR_PERCENT, matches=NEAR_MATCHES)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated or left out so that each source's words come near its target."""
    return mixing.repeat_rows(mixing.mix(docs), docs.columns)


def encode_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids."""
    return bpe.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("minhash_neardup", dedup_near),
    ("mix_sources", mix_sources),
    ("bpe", encode_text),
]

#: The first stage learns a model, which SQL cannot express; tests/llm/test_pipeline.py holds the stages to plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut_lineage(docs)
    return docs
