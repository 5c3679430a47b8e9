"""The registered queries: SQL where there is some, and the pipeline stage by stage."""

import duckdb
import pytest
from compare import differences
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from kerbside.llm.catalog import ORACLE, QUERIES

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    db = duckdb.connect()
    for name in ("documents", "embeddings", "labels"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TABLES}/{name}.parquet'")
    return db


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, db, name):
    assert differences(QUERIES[name](spark, TABLES), db, ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op6_multi_index_search", "op10_chunk_dedup"} - set(ORACLE)))
def test_a_row_for_every_row(spark, name):
    table = "embeddings" if name.startswith("op1_") else "documents"
    assert QUERIES[name](spark, TABLES).count() == spark.read.parquet(f"{TABLES}/{table}.parquet").count()


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLE) <= set(oracle_sql())
    assert [name.split("_")[0] for name in QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    read, counts = docs, [docs.count()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, read, TABLES).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        if number < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns
        if number < 2:
            # Filters give back rows as they are.
            assert after.exceptAll(read).isEmpty()
        read = after
        counts.append(after.count())
    assert counts[0] > counts[1] > counts[2] == counts[3] > 0
    masked = spark.read.parquet(f"{tmp_path}/personal_data")
    assert masked.filter(F.col("text").rlike(r"\w@\w+\.\w")).count() == 0
    assert masked.filter(F.length("text") != F.col("n_chars")).count() == 0
    assert read.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_pipeline_runs_as_one_query(spark):
    assert queries()["pipeline"](spark, TABLES).count() > 0
