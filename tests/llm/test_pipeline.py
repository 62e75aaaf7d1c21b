"""The pipeline's stages one after another against plain versions, and on odd tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from test_mixing_packing import plain_mix, reference_ids
from test_near_dedup import plain_components
from vellum.llm import language, toxicity

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages_against_plain_versions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").unionByName(spark.createDataFrame([(10_000, "123 456 !", "en", "src0", 9), (10_001, None, None, None, None)], DOCS)).cache()
    stages = dict(C.STAGES)
    assert [n for n, _ in C.STAGES] == ["language_id", "toxicity", "near_dedup", "mixing", "packing"]

    told = stages["language_id"](spark, docs, sf_dir).cache()
    model = language.train(docs, language.fold("doc_id", 3) != 1)
    scores = {r.doc_id: r.score for r in language.identify(docs, model).collect()}
    assert rows_of(told) == sorted((tuple(r) for r in docs.collect() if scores[r.doc_id] >= 0.5), key=str)
    assert 10_000 not in {r.doc_id for r in told.collect()} and told.count() == docs.count() - 2

    clean = stages["toxicity"](spark, told, sf_dir).cache()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    fitted = toxicity.train(told, labels, language.fold("doc_id", 5) != 0)
    bad = {r.doc_id for r in toxicity.score(told, fitted).filter("score >= 0.5").collect()}
    assert rows_of(clean) == sorted((tuple(r) for r in told.collect() if r.doc_id not in bad), key=str)

    kept = stages["near_dedup"](spark, clean, sf_dir).cache()
    before = clean.collect()
    groups = plain_components([r.doc_id for r in before], [r.text for r in before], 5)
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, least) in groups.items() if i == least}

    mixed = stages["mixing"](spark, kept, sf_dir).cache()
    want = {d: t // n for d, n, _, _, t in plain_mix([(r.doc_id, r.text, r.source) for r in kept.collect()]) if t}
    got = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert got == want
    for df in (told, clean, kept, mixed):
        assert df.columns == docs.columns

    packed = stages["packing"](spark, mixed, sf_dir)
    length = {r.doc_id: r.n for r in packed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert length == {r.doc_id: got[r.doc_id] * len(reference_ids(r.text)) for r in kept.collect() if r.doc_id in got}


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None), (1, None, None, None, None)], [(None, "the same text of some words", "en", "s", 1)] * 3 + [(5, "12", None, None, 0)]])
def test_odd_tables(spark, sf_dir, tmp_path, rows):
    (spark.createDataFrame(rows, DOCS).withColumn("row", F.lit(1)).withColumn("_kept", F.lit("x"))).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in C.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert name == "packing" or out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert C.run(spark, str(tmp_path)).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
