"""The registered queries of this subpackage and, where SQL can express one, the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from solvind.llm import extraction, fingerprints, language, minhash, mixing, neighbours, packing, prefixes, quality, ranking, scoring, sharding, toxicity
from solvind.llm.common import id_remainder, table

PACKING_TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str) -> str:
    """Path of a public tokenizer's file, the same on every machine that has the tokenizers installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 40)


def _fold(spark: SparkSession, sf_dir: str, modulus: int, held_out: int) -> DataFrame:
    """Labels that may be learned from."""
    return table(spark, sf_dir, "labels").where(id_remainder("doc_id", modulus) != held_out)


def _judged(scores: DataFrame, modulus: int, held_out: int, threshold: float) -> DataFrame:
    return scores.select(
        "doc_id", (id_remainder("doc_id", modulus) == held_out).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), *[c for c in scores.columns if c not in ("doc_id", "score")],
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = toxicity.train(docs, _fold(spark, sf_dir, 3, 1))
    return _judged(toxicity.score(docs, index), 3, 1, toxicity.THRESHOLD)


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 5) == 1
    scores = scoring.score(docs, scoring.train(docs.where(~held_out)))
    return scores.select("doc_id", held_out.alias("held_out"), *scores.columns[1:])


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, _fold(spark, sf_dir, 4, 2))
    return _judged(quality.score(docs, model), 4, 2, quality.THRESHOLD)


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract_pages(table(spark, sf_dir, "pages"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(PACKING_TOKENIZER))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 4) == 2
    found = language.score(docs, language.train(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

BATCH_BYTES = 2 << 20
READ_ROWS = 1024


def on_workers(spark: SparkSession) -> None:
    """Python workers that were started elsewhere than in the repository's folder find the package too, and get rows by bytes.

    By Spark's defaults a batch holds 10,000 rows of any length; `BATCH_BYTES` bounds what a worker and its JVM hold at once
    (a longer text is a batch of its own). Parquet is read `READ_ROWS` rows at once instead of 4,096, as a reader keeps arrays
    for that many texts.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", READ_ROWS)


def _with_path(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(run)
    def started(spark: SparkSession, sf_dir: str) -> DataFrame:
        on_workers(spark)
        return run(spark, sf_dir)

    return started


QUERIES = {
    run.__name__: _with_path(run)
    for run in (
        op1_sharding, op2_toxicity, op3_html_extraction, op4_embedding_dedup, op5_best_fit_packing, op6_lm_scoring, op7_quality, op8_mixing,
        op9_minhash_dedup, op10_fingerprints, op11_prefix_trie, op12_language_id, op13_ranked_search,
    )
}

SQL: dict[str, str] = {"op11_prefix_trie": prefixes.SQL, "op13_ranked_search": ranking.SQL}
