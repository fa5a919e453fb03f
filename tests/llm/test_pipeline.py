"""The stages one after the other."""

from pyspark.sql import functions as F

import corpus_pipeline
from isoquilt.llm.catalog import ORACLES, QUERIES

from .helpers import documents, odd_rows


def test_stages(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns, rows = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "tokens":
            assert docs.columns == columns
    straight = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert sorted(map(str, straight.collect())) == sorted(map(str, docs.collect())) and rows <= 200


def test_odd_rows(spark):
    docs = documents(spark, odd_rows())
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() > 0


def test_any_column_name(spark):
    plain = documents(spark, odd_rows())
    names = ["a.b", "_", "x`y", "text hash", "none", "row.text"]
    docs = plain.select("*", *[F.col("doc_id").alias(n) for n in names])
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs, plain = stage(spark, docs, ""), stage(spark, plain, "")
        assert docs.columns == plain.columns + names
        got = [r.asDict() for r in docs.collect()]
        assert all(r[n] == r["doc_id"] for r in got for n in names)
        assert sorted(str([r[c] for c in plain.columns]) for r in got) == sorted(str(list(r)) for r in plain.collect())


def test_names():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)
