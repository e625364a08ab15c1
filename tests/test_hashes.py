"""Hashes of JSON as Python writes it."""

import hashlib
import json

from pyspark.sql import functions as F

from bookmill.functions import text as T

TEXTS = [
    "", "a", 'quote " and \\ back', "tab\tline\nreturn\r", "".join(map(chr, range(1, 0x80))), "é 中 😀   \x7f",
    "\\u000B literal", "\x0b\x1f\\\x0b", "/"
]


def test_json_strings(spark):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "k int, t string").select(
        "k", T.json_quote(F.col("t")).alias("q"), T.json_hash(F.col("t")).alias("h")
    )
    for r in rows.collect():
        want = json.dumps(TEXTS[r.k], ensure_ascii=False)
        assert r.q == want and r.h == hashlib.sha256(want.encode()).hexdigest()


def test_term_fingerprints(spark):
    terms = [("Ann", "Анна", ["a b", 'x"y'], "female"), (None, "", [], None), ("O\tB", "ё", None, "")]
    rows = spark.createDataFrame([(k, *t) for k, t in enumerate(terms)], "k int, s string, t string, a array<string>, g string")
    for r in rows.select("k", T.term_fingerprint(F.col("s"), F.col("t"), F.col("a"), F.col("g")).alias("h")).collect():
        s, t, a, g = terms[r.k]
        body = {"source": s or "", "target": t or "", "aliases": a or [], "gender": g or ""}
        assert r.h == hashlib.sha256(json.dumps(body, sort_keys=True, ensure_ascii=False).encode()).hexdigest()
