"""The pipeline's stages take effect, keep clean rows and the columns of documents."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tests.conftest import SMALL
from tidemark.llm import decontam, mixing, nearjoin, packing


def test_stages_in_order(spark):
    assert [n for n, _ in pipeline.STAGES] == ["language", "near_duplicates", "decontaminate", "mix", "pack"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in pipeline.STAGES[:4]:
        before, docs = docs, stage(spark, docs, SMALL).cache()
        counts.append(docs.count())
        assert docs.columns == columns
        if name != "mix":
            assert docs.exceptAll(before).isEmpty()
        if name == "near_duplicates":  # one of each group stays, all others are apart
            found = nearjoin.near_components(before, k=5, percent=80)
            assert counts[-1] == found.select("component_id").distinct().count()
            assert docs.join(found, "doc_id").where("doc_id <> component_id").isEmpty()
        if name == "decontaminate":
            bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
            assert decontam.overlaps(docs, bench).isEmpty()
            assert counts[-2] - counts[-1] == decontam.overlaps(before, bench).select("doc_id").distinct().count()
        if name == "mix":
            plan = mixing.mix_plan(before)
            assert docs.count() == plan.agg(F.sum("copies")).first()[0]
    assert counts[1] == counts[0] and counts[2] < counts[1]
    tokens = pipeline.pack(spark, docs, SMALL).agg(F.sum("n_tokens")).first()[0]
    enc = packing.encoder(packing.VOCABULARY)
    assert tokens == sum(len(enc.bpe.encode_ordinary(r.text)) for r in docs.select("text").collect())


def test_run_equals_its_stages(spark):
    rows = pipeline.run(spark, SMALL).collect()
    assert rows and all(len(np.frombuffer(r.input_ids, "<u2")) == 2048 for r in rows)


def test_empty_and_odd_documents_pass_through(spark, empty, clashing):
    for docs in (empty, clashing):
        out = docs
        for name, stage in pipeline.STAGES:
            out = stage(spark, out, SMALL)
            assert name == "pack" or out.columns == docs.columns
        assert (out.count() > 0) == (not docs.isEmpty())
