"""The corpus pipeline: from `documents` to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and gives what the next one reads; its result is written as Parquet in between.
All but the last give rows of `documents`. Classifiers learn from the `labels` of the documents that their stage is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from solvind.llm import minhash, mixing, packing, quality, toxicity
from solvind.llm.common import stored, table
from solvind.llm.queries import PACKING_TOKENIZER, on_workers, tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the labelled examples near them do not make toxic."""
    on_workers(spark)
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier good than bad."""
    on_workers(spark)
    return quality.without_bad(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates."""
    on_workers(spark)
    return minhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for."""
    return mixing.mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place."""
    on_workers(spark)
    return packing.pack_documents(docs, tokenizer_path(PACKING_TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_bad),
    ("minhash_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL cannot express the stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
