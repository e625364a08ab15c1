"""The pipeline against its stages worked out one by one, and stages on rows of all kinds."""

from pyspark.sql import functions as F

import corpus_pipeline as P
from bookmill.llm import language_id, lm_scoring, packing, quality
from bookmill.llm.queries import QUERIES, WORD_BPE

from .test_similarity import components

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_run_equals_the_stages_by_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = language_id.train(docs.where(~lm_scoring.remainder("doc_id", 4, 2)))
    known = {r.doc_id for r in language_id.predict(docs, model, keep=["doc_id"]).collect() if r.lang_pred != "und" and r.score >= 0.4}
    first = docs.where(F.col("doc_id").isin(*known))
    good = {
        r.doc_id for r in quality.score(
            first, quality.train(first, spark.read.parquet(f"{data}/labels.parquet")), keep=["doc_id"]
        ).collect() if r.score >= 0.3
    }
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}
    kept = {i for i, (_, c) in components(texts).items() if i == c}
    want = packing.pack(docs.where(F.col("doc_id").isin(*kept)), WORD_BPE).collect()
    got = P.run(spark, data).collect()
    piece = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(piece, got)) == sorted(map(piece, want))
    assert len({r.sequence_id for r in got}) == len({r.sequence_id for r in want})


def test_stages_return_the_columns_of_documents(spark, data, tmp_path):
    odd = [
        (9001, None, None, None, None), (9002, "", "en", "s", 0),
        (9003, "the same words here now and then", "en", "s", 32),
        (9003, "the same words here now and then", "en", "s", 32),
        (9004, "The same words HERE now and then", "en", None, 32), (None, "the of and to in is", "en", "s", 19)
    ]
    docs = spark.read.parquet(f"{data}/documents.parquet").unionByName(spark.createDataFrame(odd, DOCS)).withColumn("score", F.lit("clash"))
    for k, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, data)
        if k < len(P.STAGES) - 1:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    assert [r.n for r in docs.where("doc_id > 9000").groupBy("doc_id").agg(F.count("*").alias("n")).collect()] in ([1], [])
    assert docs.where("doc_id IN (9001, 9002, 9004)").count() == 0


def test_stages_on_an_empty_table(spark, data):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, data)
    assert docs.count() == 0


def test_every_operator_has_its_query():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 11)]
