"""Merged chunks have no table of contents."""

from bookmill.operators import sections as S


def test_a_contents_block_is_stripped_from_merged_chunks(spark):
    rows = [
        ("b", 1, "  # Contents\n\n- One"), ("b", 2, " \n"), ("b", 3, "- Two\n\n# Real"), ("b", 4, "Text."),
        ("c", 1, "# One\n\nNo contents here.")
    ]
    chunks = spark.createDataFrame(rows, "book_id string, chunk_no int, text string")
    got = {r.book_id: (r.text, r.n_chunks) for r in S.merge_chunks_text(chunks).collect()}
    assert got == {"b": ("# Real\n\nText.", 3), "c": ("# One\n\nNo contents here.", 1)}
