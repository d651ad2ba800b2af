"""The stages one after the other over the smallest tables, and each over rows that are odd."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillon.session import materialise

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    bad = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0").collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF))
        counts.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert len(ids & bad) <= len(bad) // 4
    assert counts[0] > counts[1] > counts[2] >= counts[3] and counts[4] == counts[5]
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, stage, empty):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "one two three", "en", None, 13), (3, "one two three", "en", None, 13), (None, "no id at all here", None, "s", 17), (5, "word " * 3000, "en", "s", 15000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = (docs.limit(0) if empty else docs).withColumns({c: F.lit(None).cast("string") for c in ("_row", "_size", "_words", "_at", "leader", "bucket", "part", "score")})
    got = stage[1](spark, docs, SF)
    n = got.count()
    assert (n == 0) == empty or stage[0].startswith("quality")
    if stage is not corpus_pipeline.STAGES[-1]:
        assert got.columns == docs.columns
