"""The pipeline's stages against brute force, and the registered queries that have SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelspark.llm import queries
from panelspark.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    odd = spark.createDataFrame([(9001, None, None, None, 0), (9002, "...", "en", "s", 3), (9003, None, "de", "s", 0)], docs.schema)
    docs = docs.unionByName(odd).withColumn("word", F.lit(1))
    benchmark = table(spark, SF, "benchmark").first().text
    planted = spark.createDataFrame([(9010, "Before it. " + benchmark + " After it.", "en", "s", 1, 1)], docs.schema)
    docs = docs.unionByName(planted)
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns
        rows = [tuple(r) for r in kept.collect()]
        docs = spark.createDataFrame(rows, kept.schema)
        sizes.append(len(rows))
        if name == "language_id":
            assert sizes[-1] == sizes[0] - 3
        if name == "decontamination":
            assert docs.filter("doc_id = 9010").isEmpty()
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.7 * sizes[0]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == sizes[-1]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).isEmpty()


def test_line_dedup_extends_matches(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "word " * 45 + "\nshort\nmine", "en", "s", 1), (2, "own\n" + "word " * 45 + "\nshort\nother", "en", "s", 1)]
    kept = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, spark.createDataFrame(rows, schema), SF).collect()}
    assert kept == {1: rows[0][1], 2: "own\nother"}


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    db = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = db.sql(queries.ORACLES[name])
    assert sorted(want.columns) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))
