"""Each stage of the pipeline against brute force on what it was given."""

import corpus_pipeline
from pyspark.sql import functions as F

from marginalia.llm import ranking
from test_documents import components_by_hand, repeats_by_hand

SMALL = "/root/testdata/sf0.001"


def test_stages_take_effect(spark, scratch):
    columns = spark.read.parquet(f"{SMALL}/documents.parquet").columns
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("runs", F.lit(1)).drop("runs")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = scratch.keep(stage(spark, docs, SMALL), name)
        kept[name] = docs
        if name != "packing":
            assert docs.columns == columns
        texts = [(r.doc_id, r.text) for r in before.select("doc_id", "text").orderBy("doc_id").collect()] if "text" in before.columns else []
        if name == "quality":
            labels = spark.read.parquet(f"{SMALL}/labels.parquet")
            good = ranking.quality_scores(before, labels).filter("predicted = 1").select("doc_id")
            assert sorted(r.doc_id for r in good.collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())
            bad = labels.filter("quality = 0").join(before, "doc_id", "left_semi")
            wrong = bad.join(docs, "doc_id", "left_semi").count()
            assert wrong <= bad.count() / 4 and labels.filter("quality = 1").join(docs, "doc_id", "left_anti").count() == 0
        if name == "near_duplicates":
            want = [d for d, (_, _, low) in components_by_hand(texts).items() if d == low]
            assert sorted(r.doc_id for r in docs.select("doc_id").collect()) == want
        if name == "repeated_passages":
            want = repeats_by_hand(texts)
            for r in docs.collect():
                assert r.n_chars == len(r.text) and len(r.text.encode()) <= want[r.doc_id][1] - want[r.doc_id][2]
    ends = kept["packing"].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"))
    assert ends.filter("n <> all").count() == 0 and ends.count() == kept["repeated_passages"].count()


def test_one_document_stays_of_rows_whose_ids_repeat_or_lack(spark):
    text = " ".join(f"word{i}" for i in range(60))
    near, other, third = text + " end", " ".join(f"other{i}" for i in range(60)), " ".join(f"third{i}" for i in range(60))
    rows = [(5, text, "a"), (5, text, "a"), (7, near, "b"), (5, other, "c"), (None, other, "d"), (None, third, "e"), (None, third, "e"), (8, "", "f"), (8, "", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = corpus_pipeline.near_duplicates(spark, docs, SMALL)
    assert got.columns == docs.columns
    kept = sorted(((r.doc_id or 0, r.text, r.source) for r in got.collect()))
    assert kept == sorted([(5, text, "a"), (5, other, "c"), (0, third, "e"), (8, "", "f"), (8, "", "f")])


def test_pipeline_of_no_documents(spark, scratch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = scratch.keep(stage(spark, docs, SMALL), "stage")
    assert docs.count() == 0
