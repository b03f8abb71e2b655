"""The pipeline's stages against their operators, and the registered queries on the smallest tables."""

from pathlib import Path

import pytest

import corpus_pipeline
from acceptance.check import oracle_connection
from solvind.llm import minhash, mixing, quality, toxicity
from solvind.llm.common import components, stored
from solvind.llm.queries import QUERIES, SQL, on_workers

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are absent")


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (105, 100), (200, 200)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == [(k, 0) for k in range(61)] + [(100, 100), (101, 100), (105, 100)]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@needs_tables
def test_every_stage_does_its_work(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, SF_DIR), name)
        assert docs.columns == columns
        given, kept = ([row.doc_id for row in frame.select("doc_id").collect()] for frame in (before, docs))
        if name == "toxicity":
            scores = toxicity.score(before, toxicity.train(before, labels))
            assert sorted(kept) == sorted(row.doc_id for row in scores.collect() if row.score < toxicity.THRESHOLD)
        elif name == "quality":
            scores = quality.score(before, quality.train(before, labels))
            assert sorted(kept) == sorted(row.doc_id for row in scores.collect() if row.score >= quality.REJECTED_BELOW)
        elif name == "minhash_dedup":
            assert sorted(kept) == sorted(row.doc_id for row in minhash.near_duplicates(before).collect() if row.kept) and len(kept) < len(given)
        else:
            copies = {row.doc_id: row.copies for row in mixing.mix_documents(before).collect()}
            assert sorted(kept) == sorted(k for k in given for _ in range(copies[k]))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {row.doc_id for row in pieces.select("doc_id").collect()} == set(kept)


ROW_QUERIES = [name for name in QUERIES if name not in ("op11_prefix_trie", "op13_ranked_search")]


@needs_tables
@pytest.mark.parametrize("name", ROW_QUERIES)
def test_queries_give_a_row_for_every_row(spark, name):
    table, key = {"op3_html_extraction": ("pages", "page_id"), "op4_embedding_dedup": ("embeddings", "vec_id")}.get(name, ("documents", "doc_id"))
    given = {row[0] for row in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key).collect()}
    assert {row[0] for row in QUERIES[name](spark, SF_DIR).select(key).collect()} == given


@needs_tables
@pytest.mark.parametrize("name", [*SQL])
def test_queries_agree_with_sql(spark, name):
    frame = QUERIES[name](spark, SF_DIR)
    relation = oracle_connection(SF_DIR).sql(SQL[name])
    assert sorted(frame.columns) == sorted(relation.columns)
    assert sorted(map(tuple, frame.select(*relation.columns).collect()), key=repr) == sorted(relation.fetchall(), key=repr)


def test_rows_move_in_small_batches(spark):
    on_workers(spark)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 2 << 20
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 1024
