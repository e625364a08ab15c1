"""Bins of fingerprints against plain Python, and very long texts of many different words."""

import random

import xxhash
from pyspark.sql import functions as F

import corpus_pipeline as P
from bookmill.llm import fingerprints, language_id, lm_scoring, quality

DOCS = "doc_id bigint, text string"


def words(n, seed=1):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))


def bins_by_hand(text):
    """Least values by bin, empty bins filled along their own walk; low eight bits, as hexadecimal text."""
    ws = [w for w in "".join(" " if c in fingerprints.WHITE else c for c in text.lower()).split(" ") if w]
    if not ws:
        return ""
    least = {}
    for i in range(max(1, len(ws) - 4)):
        h = 42
        for w in ws[i : i + 5]:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        top = ((h >> 56) + 128) % 256  # signed order
        least[top] = min(least.get(top, 1 << 60), h & ((1 << 56) - 1))
    starts, steps = fingerprints._probe_orders()
    out = []
    for j in range(256):
        at = next(k for k in [j, *((starts[j] + t * steps[j]) % 256 for t in range(256))] if k in least)
        out.append(f"{least[at] & 255:02x}")
    return "".join(out)


def test_bins_are_those_of_plain_python(spark, data):
    texts = [r.text for r in spark.read.parquet(f"{data}/documents.parquet").limit(40).collect()]
    texts += ["", "  ", "one", "one two three", "A b\tc\nd e f", "É Ü ß ẞ x y z", words(300), words(7)]
    rows = spark.createDataFrame(list(enumerate(texts)), DOCS).withColumn("fingerprint", F.lit("clash"))
    got = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(rows).collect()}
    assert all(got[k] == bins_by_hand(t) for k, t in enumerate(texts))


def test_a_very_long_text_in_every_operator(spark, data):
    long = words(40_000)
    rows = [(1, long), (2, long + " tail"), (3, words(3, 2)), (4, None), (5, "")]
    df = spark.createDataFrame(rows, DOCS)
    prints = {r.doc_id: r for r in fingerprints.fingerprint_edits(df).collect()}
    assert prints[1].fingerprint == bins_by_hand(long) and prints[1].near_next > 0.9 and prints[1].n_chars == len(long)
    scores = {r.doc_id: r for r in lm_scoring.score_held_out(df).collect()}
    assert scores[1].n_tokens == 40_001 and scores[2].n_tokens == 40_002 and scores[1].score < scores[3].score < 0
    model = language_id.train(spark.read.parquet(f"{data}/documents.parquet"))
    found = {r.doc_id: r for r in language_id.predict(df, model, keep=["doc_id"]).collect()}
    assert found[1].lang_pred != "und" and found[4].lang_pred == "und"
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    full = docs.limit(60).unionByName(
        df.withColumns(
            {
                "lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long"),
                "doc_id": F.col("doc_id") + 90_000
            }
        )
    )
    assert quality.score(full, quality.train(full, labels), keep=["doc_id"]).where("score IS NULL").isEmpty()


def test_pipeline_stages_on_a_very_long_text(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    source = docs.orderBy(F.desc("n_chars")).first()
    long = " ".join([source.text] * 12)
    extra = [
        (90_001, long, source.lang, source.source, len(long)),
        (90_002, long.encode().upper().decode(), source.lang, source.source, len(long)),
        (90_003, long[: len(long) // 3], source.lang, source.source, len(long) // 3)
    ]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, data).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < 2:
            assert docs.where("doc_id IN (90001, 90002)").count() == 2
        elif k == 2:
            assert {r.doc_id for r in docs.where("doc_id > 90000").collect()} <= {90_001}  # near copies: the same word runs again and again
    assert docs.where("length > 4096").count() == 0


def test_of_repeated_rows_one_stays_whatever_their_order(spark, data):
    rows = [
        (1, "one two three four five six", "en", "b"), (1, "one two three four five six", "en", "a"),
        (1, "one two three four five six", "de", "a"), (2, "x", None, None), (2, "x", "en", None)
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    kept = [sorted(map(tuple, P.one_of_each_group(spark, docs.repartition(n), data).collect())) for n in (1, 4)]
    assert kept[0] == kept[1] and len(kept[0]) == 2 and kept[0][0] == (1, "one two three four five six", "de", "a")
