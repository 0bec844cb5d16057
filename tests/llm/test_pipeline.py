"""The corpus pipeline on the smallest tables: each stage against its operator's promise."""

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "suffix_dedup", "pii", "packing"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == corpus_pipeline.COLUMNS, name
        counts.append(docs.count())
    assert counts[0] >= counts[1] >= counts[2] == counts[3] == counts[4] and counts[2] > 0.5 * counts[0]
    assert docs.where("n_chars <> length(text)").count() == 0 and docs.select("doc_id").distinct().count() == counts[4]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert pieces.select("doc_id").distinct().count() == counts[4]
    assert pieces.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0
