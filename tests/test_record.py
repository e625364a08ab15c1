"""record over all of documents, against brute force."""

import re

from bookmill.plans import catalog
from bookmill.plans.dictionary import _TERMS


def test_record_covers_every_document(spark, tmp_path):
    texts = ("The thing, pathetic; abc", "of in the text", "nothing here", "La-la", "tion ab")
    rows = [(k, texts[k % 5], f"s{k % 2}") for k in (0, 1, 199, 200, 201, 999, 12345)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))

    def occurs(surface, text):
        return surface in text if len(surface) <= 2 else re.search(f"(?<![a-zа-я0-9]){surface}(?![a-zа-я0-9])", text)

    want = sorted((s, k, sum(any(x and occurs(x, t.lower()) for x in (term[1], term[3])) for term in _TERMS), len(t)) for k, t, s in rows)
    got = catalog.QUERIES["record"](spark, str(tmp_path)).collect()
    assert sorted((r.book_id, r.chunk_no, r.n_terms, r.output_size) for r in got) == want
