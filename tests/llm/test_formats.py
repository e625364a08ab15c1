"""URL filters, packing, WARC archives and byte-level BPE."""

import base64
import hashlib
import io
import itertools
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import zstandard
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bookmill.llm import _store, bpe, packing, url_filter, warc
from bookmill.llm.queries import BYTE_BPE, WORD_BPE

DOCS = "doc_id bigint, text string"
PAGES = "page_id bigint, url string, html string"


def by_rules(url):
    """host, path, rule and the rule's verdict, in plain Python."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = []
    for verdict, rule in url_filter.RULES:
        name, slash, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + tail):
            fit.append((len(rule), rule, verdict))
    return (host, path, *(max(fit)[1:] if fit else (None, None)))


URLS = [
    None, "", "no scheme", "http://Example.ORG/es/1", "https://a.example.org/en/12?x#y", "http://example.org/en/2",
    "http://badexample.org/es/", "http://x.com/fr/a", "http://X.COM/de/a", "http://x.com/de", "http://org/",
    "http://org", "http://a.org?x/y", "http://a.com#/de/", "a://b://c.org/", "http://ünï.org/é",
    "http://casino-win.net/", "http://user@x.com:80/de/1", "http://" + "a" * 5000 + ".org/" + "b" * 50_000, "://x.org/",
    "http://a.org/\n", "http://xn--é.com/fr/",
]


def test_rules_decide_before_the_model(spark, data):
    urls = [*URLS, *(r.url for r in spark.read.parquet(f"{data}/pages.parquet").collect())]
    rows = spark.createDataFrame([(k, u, None) for k, u in enumerate([*urls, urls[3]])], PAGES).withColumn("verdict", F.lit("clash"))
    got = {r.page_id: r for r in url_filter.judge(rows).collect()}
    assert len(got) == len(urls) + 1
    for k, u in enumerate(urls):
        host, path, rule, verdict = by_rules(u)
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, rule)
        assert got[k].verdict == (verdict or ("block" if got[k].p_block > 0.5 else "allow"))
    assert got[0].verdict == "allow"
    assert url_filter.judge(spark.createDataFrame([], PAGES)).count() == 0


def test_model_tells_held_out_hosts_apart():
    table = url_filter.labelled_urls()
    for held in range(3):
        w, b = url_filter.train([r for k, r in enumerate(table) if k % 5 != held])
        test = [r for k, r in enumerate(table) if k % 5 == held]
        said = url_filter._log_odds(w, b, [" ".join(url_filter._split(u)).encode() for u, _ in test]) > 0
        truth = np.array([k for _, k in test], bool)
        assert said[truth].mean() > 0.9 and (~said[~truth]).mean() > 0.98


def test_probabilities_equal_brute_force_in_any_batch(spark):
    w, b = url_filter.train(url_filter.labelled_urls())
    w = w.astype(np.float32)
    urls = [u for u in URLS if u is None or len(u) < 1000] * 2 + ["http://casino-win.net/", "http://x.y/1", "http://x.y/2"]
    rows = spark.createDataFrame([(k, u, None) for k, u in enumerate(urls)], PAGES)
    seen = {}
    for n in (1, 3):
        for r in url_filter.judge(rows.repartition(n)).collect():
            assert seen.setdefault(urls[r.page_id], r.p_block) == r.p_block
    for u, p in seen.items():
        text = re.sub(r"[0-9]", "0", " ".join(by_rules(u)[:2])).encode()
        found = []
        for n in url_filter.GRAMS:
            for i in range(len(text) - n + 1):
                h = np.array([n], np.uint64)
                for c in text[i : i + n]:
                    h = url_filter.mix(h + np.uint64(c) * np.uint64(0x9E3779B97F4A7C15))
                found.append(float(w[int(h[0]) >> 48]))
        want = 1 / (1 + np.exp(-(sum(found) / np.sqrt(len(found)) + b))) if found else 0.0
        assert p == pytest.approx(want, abs=1e-9)


def fewest(lengths, capacity):
    """The least number of sequences, by trying all ways."""
    best = len(lengths)

    def put(k, left):
        nonlocal best
        if len(left) >= best:
            return
        if k == len(lengths):
            best = len(left)
            return
        for r in sorted({x for x in left if x >= lengths[k]}):
            rest = list(left)
            rest[rest.index(r)] -= lengths[k]
            put(k + 1, rest)
        put(k + 1, [*left, capacity - lengths[k]])

    put(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_reduction_keeps_the_optimum_and_packing_holds_all(lengths):
    capacity = 20
    count = np.bincount(sorted(lengths), minlength=capacity + 1)
    rest = count.copy()
    fixed = packing.reduce_dominated(rest, capacity)
    left = sorted(np.repeat(np.arange(capacity + 1), rest).tolist(), reverse=True)
    assert sum(m for _, m in fixed) + (fewest(left, capacity) if left else 0) == fewest(sorted(lengths, reverse=True), capacity)
    patterns = packing.pack_lengths(count, capacity)
    held = np.zeros_like(count)
    for p, m in patterns:
        assert sum(s * k for s, k in p) <= capacity
        for s, k in p:
            held[s] += k * m
    assert (held == count).all()


def test_pieces_are_the_tokenizer_s_and_lie_gapless(spark, data):
    odd = [
        (-1, None), (-2, ""),
        (
            -3,
            "Don't STOP, I'll go; e.g. 3,000... naïve Ünïcode—dash “quoted” x\u00a0y İ K <|endoftext|> e\u0301t\u00e9"
        ),
        (-4, "long words " * 9000), (-5, "same"), (-5, "same"), (None, "no id")
    ]
    docs = (
        spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
        .unionByName(spark.createDataFrame(odd, DOCS)).withColumn("piece", F.lit("clash"))
    )
    got = packing.pack(docs, WORD_BPE).collect()
    t = Tokenizer.from_file(WORD_BPE)
    t.encode_special_tokens = True
    want = []
    for r in docs.collect():
        ids = [*t.encode(r.text or "", add_special_tokens=False).ids, 1]
        want += [
            (
                r.doc_id, k, at, len(ids[at : at + 4096]),
                zlib.crc32(struct.pack(f"<{len(ids[at : at + 4096])}I", *ids[at : at + 4096]))
            ) for k,
            at in enumerate(range(0, len(ids), 4096))
        ]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    for _, rows in itertools.groupby(sorted(got, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for r in rows:
            assert r.offset == at
            at += r.length
        assert at <= 4096
    assert packing.pack(spark.createDataFrame([], DOCS), WORD_BPE).count() == 0


def pages():
    same = "<p>" + "é" * 700 + "</p>"
    rows = [(k, f"http://x.org/{k}", same) for k in (3, 9, 4, 7)] + [
        (1, None, None), (2, "http://y\r\nInjected: 1", ""), (5, "u", "short"), (6, "u", "short"), (None, "u", same),
        (10, "u", "x" * 1000), (11, "u", "x" * 1000), (12, "u", "y" * 999), (13, "u", "y" * 999),
        (14, "u", "z\r\n\r\n" * 200_000), (11, "u", "x" * 1000)
    ]
    return rows


def test_archives_give_back_what_was_written(spark):
    df = spark.createDataFrame(pages(), PAGES).withColumn("payload", F.lit("clash"))
    manifest = warc.write_archives(df, archive_bytes=700)
    got = warc.read_archives(spark, manifest).collect()
    want = []
    for i, _, html in pages():
        b = (html or "").encode()
        other = max((j for j, _, h in pages() if j is not None and (h or "").encode() == b), default=None)
        again = len(b) >= 1000 and i is not None and i != other
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", other if again else None))
    assert sorted(
        ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr
    ) == sorted(want, key=repr)
    assert all(hashlib.sha1(r.payload).hexdigest() == r.payload_digest for r in got if r.record_type == "response")
    assert manifest.agg(F.sum("records")).first()[0] == len(pages()) and manifest.count() > 1
    assert warc.write_archives(spark.createDataFrame([], PAGES)).count() == 0


def test_each_record_is_a_frame_of_its_own_after_the_dictionary(spark, data):
    manifest = warc.write_archives(spark.read.parquet(f"{data}/pages.parquet"))
    with _store.open_read(manifest.first().path) as f:
        raw = f.read()
    magic, size = struct.unpack("<II", raw[:8])
    assert magic == 0x184D2A5D
    dictionary = zstandard.ZstdDecompressor().decompress(raw[8 : 8 + size])
    assert dictionary[:4] == b"\x37\xa4\x30\xec"
    z, at, n = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)), 8 + size, 0
    while at < len(raw):
        o = z.decompressobj()
        record = o.decompress(raw[at:])
        at, n = len(raw) - len(o.unused_data), n + 1
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
    assert n == manifest.first().records + 1


def test_archives_without_dictionary(spark):
    data = b"".join([zstandard.ZstdCompressor().compress(warc.page_record(1, None, b"x", None))])
    (fields, block), *_ = warc.ArchiveReader(io.BytesIO(data))
    assert fields["warc-type"] == "response" and block.endswith(b"x")


@pytest.fixture(scope="module")
def vocabulary():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE_BPE, "rb"))}
    return ranks, bpe.PerfectHash(ranks), tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_perfect_hash_is_minimal(vocabulary):
    ranks, hashed, _ = vocabulary
    assert len(hashed.keys) == len(ranks) and set(hashed.keys) == set(ranks)
    assert hashed.lookup(list(ranks)).tolist() == list(ranks.values())
    assert hashed.lookup([b"\xff\xff\xff", b"qqqqqqqqqq"]).tolist() == [-1, -1]
    assert bpe.PerfectHash({b"a": 7}).lookup([b"a", b"b"]).tolist() == [7, -1]


@settings(max_examples=300, deadline=None)
@given(
    st.text(
        alphabet=st.one_of(
            st.sampled_from(list("ab't s\n\r\t  \u00a0\u2003\u3000\x1c\x85.,!?0129é中😀Ж")),
            st.sampled_from([chr(c) for r in bpe._LATER for c in r]), st.characters(exclude_categories=["Cs"])
        ),
        max_size=40,
    )
)
def test_encoding_equals_the_library_s(vocabulary, text):
    ranks, hashed, library = vocabulary
    ids = np.frombuffer(bpe.Encoder(ranks, public_tokenizers.PATTERN, hashed).encode([text])[0], "<u4").tolist()
    assert b"".join(library.decode_single_token_bytes(i) for i in ids) == text.encode()
    assert ids == library.encode_ordinary(text)


def test_classes_of_all_code_points_are_the_library_s(vocabulary):
    text = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    bytes_only = {bytes([b]): b for b in range(256)}
    for kind in (r"\p{L}", r"\p{N}", r"\s", r"[^\s\p{L}\p{N}]"):
        library = tiktoken.Encoding("own", pat_str=kind, mergeable_ranks=bytes_only, special_tokens={})
        assert "".join(bpe.Encoder({}, kind, None).split(text)) == bytes(library.encode_ordinary(text)).decode()


def test_merges_by_heap_are_those_of_the_library(vocabulary):
    ranks, _, library = vocabulary
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 17, 300):
        word = "".join(rng.choice(list("etaoinshrdlu"), n))
        assert bpe.merge(word.encode(), ranks) == library.encode_ordinary(word)
    assert bpe.merge(b"a" * 5000, ranks) == library.encode_ordinary("a" * 5000)


def test_encode_and_decode_documents(spark, data, vocabulary):
    odd = [(-1, None), (-2, ""), (-3, "a  b\n\n c\u00a0 d\u2003\u2003\n e"), (-4, "word " * 50_000), (-4, "word " * 50_000), (None, "x")]
    docs = (
        spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
        .unionByName(spark.createDataFrame(odd, DOCS)).withColumn("ids", F.lit("clash"))
    )
    got = bpe.decode(bpe.encode(docs, BYTE_BPE, public_tokenizers.PATTERN, memo_entries=500), BYTE_BPE).collect()
    want = [
        (
            r.doc_id, struct.pack(f"<{len(ids)}I", *ids), (r.text or "").encode()
        ) for r in docs.collect() for ids in [vocabulary[2].encode_ordinary(r.text or "")]
    ]
    assert sorted(((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got), key=repr) == sorted(want, key=repr)
    assert bpe.encode(spark.createDataFrame([], DOCS), BYTE_BPE, public_tokenizers.PATTERN).count() == 0
