"""The pipeline as a whole: empty tables, and odd rows through every stage."""
from pyspark.sql import functions as F

import corpus_pipeline


def test_empty_tables(spark, no_documents, tmp_path):
    no_documents.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_keep_the_columns_and_every_stage_takes_effect(spark, documents, tmp_path):
    docs = documents.select("doc_id", "text", "lang", "source", "n_chars").withColumn("row", F.lit("mine"))
    spark.createDataFrame([(0, 1, 0), (1, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, str(tmp_path)), f"test-{name}")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "row"]
        counts.append(docs.count())
    # Clean documents stay, copies go, near copies (a chain of 41 texts) go.
    assert counts[0] >= documents.count() - 2 and counts[1] <= counts[0] - 50 and counts[2] <= counts[1] - 35
    assert corpus_pipeline.pack(spark, docs, str(tmp_path)).count() > 0
