"""Ids, duplicates and matching of terms against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from bookmill.operators import glossary as G

NAMES = ("Kept", "kept", "Kept 2", "kept_2", "?", "Zo", "Zo Zo", "the Zo", "The", "the grey", "Grey the", "Lamps", "Lamp", "Moon")


def slug(name):
    return re.sub(r"[^0-9a-zа-яё]+", "_", re.sub("['’ʼ`]", "", name.strip().lower())).strip("_") or "term"


def ids_by_brute_force(rows):
    seen, out = set(), []
    for own, source in rows:
        if not own.strip() or own in seen:
            base = own = slug(source)
            n = 1
            while own in seen:
                n += 1
                own = f"{base}_{n}"
        seen.add(own)
        out.append(own)
    return out


def test_ids_are_unique_whatever_names_and_ids_are_given(spark):
    rng = random.Random(3)
    books = {
        f"b{k}": [
            (
                rng.choice(("", "", " ", "kept", "kept_2", "kept_3", "zo")), rng.choice(NAMES)
            ) for _ in range(rng.randrange(1, 25))
        ] for k in range(60)
    }
    rows = [(b, p, i, s) for b, terms in books.items() for p, (i, s) in enumerate(terms)] + [("n", 1, None, None), ("n", 2, None, None)]
    got = G.ensure_term_ids(spark.createDataFrame(rows, "book_id string, pos int, id string, source string").repartition(3)).collect()
    for b, terms in books.items():
        own = [r.id for r in sorted(got, key=lambda r: r.pos) if r.book_id == b]
        assert own == ids_by_brute_force(terms) and len(set(own)) == len(own)
    assert sorted(r.id for r in got if r.book_id == "n") == ["term", "term_2"]


def test_duplicates_are_those_of_all_pairs(spark):
    rng = random.Random(5)
    words = ["the", "zo", "grey", "lamp", "lamps", "moon", "sun"]
    names = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 4))) for _ in range(60)]
    rows = spark.createDataFrame(
        [("b", k, n, [rng.choice(words)] if k % 9 == 0 else [], n) for k, n in enumerate(names)],
        "book_id string, pos int, source string, aliases array<string>, target string"
    )
    got = {(r.a_pos, r.b_pos): r.reason for r in G.find_duplicates(rows).collect()}
    low, norm = F.lower(F.col("source")), G.normalize_dedup(F.col("source"))
    full = rows.select(
        "book_id", "pos", low.alias("low"), norm.alias("norm"), G.tokenize(F.col("source")).alias("tok"),
        G.surface_forms(F.col("source"), F.col("aliases")).alias("surf")
    )
    a, b = (full.select("book_id", *(F.col(c).alias(f"{s}_{c}") for c in ("pos", "low", "norm", "tok", "surf"))) for s in "ab")
    every = a.join(b, "book_id").where("a_pos < b_pos").withColumn("reason", G._pair_reason()).where("reason IS NOT NULL")
    assert got == {(r.a_pos, r.b_pos): r.reason for r in every.collect()}


@pytest.mark.parametrize("sent", [0, 10**6])
def test_terms_are_found_as_by_search(spark, sent):
    terms = [
        ("b", 1, "Zo", ["the Zo"]), ("b", 2, "Grey", []), ("b", 3, "O'Connor", ["oc"]), ("b", 4, "Wit-Bit", []),
        ("b", 5, "ab", []), ("b", 6, "Лампа", [None, " "]), ("c", 1, "grey", []), ("d", 1, "", None)
    ]
    chunks = [
        ("b", 1, "the zo; GREY. cab"), ("b", 2, "O'Connor's wit-bit greyish zoo"), ("b", 3, None), ("b", 4, ""),
        ("b", 5, "лампа, лампах oc"), ("c", 1, "grey grey"), ("c", 2, "x-grey_"), ("d", 9, "any"), ("e", 1, "grey"),
        ("c", 3, "grey5 7grey")
    ]
    t = spark.createDataFrame(terms, "book_id string, pos int, source string, aliases array<string>")
    c = spark.createDataFrame(chunks, "book_id string, chunk_no int, text string")
    want = set()
    for b, pos, source, aliases in terms:
        for b2, no, text in chunks:
            for s in [source, *(x for x in aliases or [] if x and x.strip())]:
                s = s.lower()
                if b == b2 and text and s and (
                    s in text.lower() if len(s) <= 2 else re.search(
                        f"(?<![A-Za-zА-Яа-я0-9]){re.escape(s)}(?![A-Za-zА-Яа-я0-9])", text.lower()
                    )
                ):
                    want.add((b, no, pos))
    got = G.terms_in_chunk(t, c, sent_bytes=sent)
    assert got.schema["pos"].dataType == t.schema["pos"].dataType
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want)
