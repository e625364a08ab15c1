"""Cases that the queries' tables don't hold."""

import pyarrow as pa
import pytest
from pyspark.sql import Row, functions as F

from bookmill.config import Chunking, Config, load, overlay
from bookmill.functions import text as T
from bookmill.operators import build, glossary as G, qa as Q, sections as S, state as ST, structure as U
from bookmill.plans import planted
from bookmill.sources import books as B, sinks
from bookmill.streaming import ingest


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first().y


def test_split_by_size_counts_no_separators(spark):
    assert one(spark, "aaaaaa\n\nbbbbb\n\ncccc", lambda c: S.split_by_size(c, 11, 100)) == ["aaaaaa\n\nbbbbb", "cccc"]


def test_split_by_size_cuts_long_paragraphs_at_sentences(spark):
    assert one(spark, "x\n\nOne two. Three four. Five.", lambda c: S.split_by_size(c, 12, 15)) == ["x", "One two.", "Three four.", "Five."]


def test_empty_texts_have_no_chunks(spark):
    assert one(spark, " \n\n ", lambda c: S.split_by_size(c, 10, 20)) == []
    assert one(spark, None, lambda c: S.split_by_size(c, 10, 20)) is None


def test_surface_in_text(spark):
    rows = spark.createDataFrame(
        [("al", "albert"), ("brig", "brightsand"), ("o'neil", "said o'neil."), ("a.b", "a.b"), ("a.b", "axb")],
        "s string, t string"
    )
    assert [r.y for r in rows.select(T.surface_in_text(F.col("s"), F.col("t")).alias("y")).collect()] == [True, False, True, True, False]


def test_terms_in_chunk_sees_punctuated_and_spaced_surfaces(spark):
    terms = spark.createDataFrame(
        [("b", 1, "O'Neil", []), ("b", 2, "two words", []), ("b", 3, "x", ["Ünder"])],
        "book_id string, pos int, source string, aliases array<string>"
    )
    chunks = spark.createDataFrame(
        [("b", 1, "Said O'Neil, two  words."), ("b", 2, "Two words! ünder"), ("c", 1, "two words")],
        "book_id string, chunk_no int, text string"
    )
    assert sorted((r.chunk_no, r.pos) for r in G.terms_in_chunk(terms, chunks).collect()) == [(1, 1), (2, 2), (2, 3)]


def test_faulty_decisions_apply_nothing(spark):
    plan = spark.createDataFrame(
        [("b", "decision", "attribute_conflict", "A", "gender", "male", None, [1], "i1")],
        "book_id string, outcome string, kind string, source string, field string, value string, options array<string>, chunks array<int>, id string"
    )
    terms = spark.createDataFrame(
        [("b", 1, "a", "A", "x", [], "term", "female", "low", 0, [], "")],
        "book_id string, pos int, id string, source string, target string, aliases array<string>, category string, gender string, confidence string, frequency int, evidence_refs array<string>, notes string"
    )
    bad = spark.createDataFrame([("b", "i1", "neither", None)], "book_id string, id string, choice string, kind string")
    with pytest.raises(ValueError):
        G.apply_merge(plan, terms, bad)
    good = bad.withColumn("choice", F.lit("accept"))
    assert G.apply_merge(plan, terms, good).first().gender == "male"


def test_snapshots_and_the_guard_of_empty_ones(spark, tmp_path):
    path = str(tmp_path / "g")
    terms = spark.createDataFrame(
        [("b", 1, "", "A", "x", [], "term", "female", "low", 0, [], "")],
        "book_id string, pos int, id string, source string, target string, aliases array<string>, category string, gender string, confidence string, frequency int, evidence_refs array<string>, notes string"
    )
    sinks.write_glossary(terms, path)
    assert sinks.read_snapshot(spark, path).first().id == "a"
    with pytest.raises(ValueError):
        sinks.write_glossary(terms.limit(0), path)
    sinks.write_glossary(terms.withColumn("target", F.lit("y")), path)
    assert sinks.read_snapshot(spark, path).first().target == "y"


def test_sinks_and_chunk_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("chunk0001.md", "chunk0002.md", "chunk0001.md.bak", "chunk0001.polished.md"):
        (tmp_path / "in" / name).write_text(name)
    assert sorted(r.chunk_no for r in B.scan_chunks(spark, str(tmp_path / "in")).collect()) == [1, 2]
    rows = spark.createDataFrame([("b", 1, "x")], "book_id string, chunk_no int, text string")
    sinks.sink_chunks(rows, str(tmp_path / "c"))
    sinks.sink_json(rows, str(tmp_path / "j"))
    sinks.sink_texts(rows.select(F.col("text").alias("value")), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "c")).count() == spark.read.json(str(tmp_path / "j")).count() == spark.read.text(str(tmp_path / "t")).count() == 1


def test_plan_partitions_the_manifest(spark):
    key = "book_id string, chunk_no int"
    manifest = spark.createDataFrame([("b", k, "h") for k in range(4)], f"{key}, source string").withColumn("source", F.sha2("source", 256))
    sources = spark.createDataFrame([("b", k, "h") for k in range(4)], f"{key}, text string")
    outputs = spark.createDataFrame([("b", k, "o") for k in (1, 2, 3)], f"{key}, text string")
    records = spark.createDataFrame(
        [("b", 2, {}, True, False), ("b", 3, {"gone": "x"}, False, True)],
        f"{key}, entity_hashes map<string,string>, failed boolean, polish_failed boolean"
    )
    terms = spark.createDataFrame([], "book_id string, id string, source string, target string, aliases array<string>, gender string")
    got = {r.chunk_no: (r.category, r.polish_failed) for r in ST.plan(manifest, sources, outputs, records, terms).collect()}
    assert got == {0: ("translation", False), 1: ("record_only", False), 2: ("failed", False), 3: ("translation", True)}


def test_checks_read_texts_once(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    plan = Q.line_issues(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1


def test_line_checks_give_their_golden_rows(spark):
    text = "dошло FBI\n```\n— — —"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id int, text string")
    got = sorted((r.doc_id, r.check_name, r.line) for r in Q.all_issues(docs).collect())
    assert got == [(1, "code_fences", 2), (1, "garbage_dashes", 3), (1, "mixed_alphabets", 1)]


def test_html_subset():
    html = '<body><h2>T &amp; U</h2><p>a<br/>b <img src="i/x.png" alt="X"></p><ul><li>one</li></ul><script>no()</script><blockquote><p>q</p></blockquote></body>'
    assert B.to_markdown(html) == "## T & U\n\na\\\nb ![X](i/x.png)\n\n- one\n\n> q\n"


def test_inline_escapes_and_priority():
    assert build.inline_xml(
        r"\*x\* `a*b*` **c** _d_ e_f_ <&>"
    ) == "*x* <code>a*b*</code> <strong>c</strong> <emphasis>d</emphasis> e_f_ &lt;&amp;&gt;"


def test_fb2_is_well_formed_for_any_text(spark, data):
    from xml.etree import ElementTree

    blocks = build.md_blocks(
        spark.read.parquet(f"{data}/documents.parquet").select(F.col("doc_id").cast("string").alias("book_id"), "text")
    )
    author = F.struct(*(F.lit("A").alias(n) for n in ("first_name", "middle_name", "last_name", "nickname")))
    heads = (
        blocks.select("book_id").distinct()
        .select(
            "book_id", F.lit("<T>").alias("title"), author.alias("author"),
            *(F.lit("x").alias(n) for n in ("lang", "date", "uid"))
        )
    )
    for r in build.build_fb2(blocks, heads).collect():
        ElementTree.fromstring(r.fb2.encode())


def test_numbers_of_chunks_are_dense_and_lose_no_paragraph(spark):
    sections = spark.createDataFrame(
        [("b", 1, 1, "A", "p1 x\n\np2\n\n***\n\np3"), ("b", 2, 1, "B", "p4")],
        "book_id string, section_no int, level int, title string, text string"
    )
    rows = S.number_chunks(sections, Chunking(chunk_size=8, soft_limit=100)).orderBy("chunk_no").collect()
    assert [r.chunk_no for r in rows] == list(range(1, len(rows) + 1))
    assert [p for r in rows for p in r.text.split("\n\n")] == ["p1 x", "p2", "***", "p3", "p4"]


def test_config_overlay(tmp_path):
    (tmp_path / "c.toml").write_text("[chunking]\nchunk_size = 5\nother = 1\n[unknown]\nx = 1\n")
    (tmp_path / "bad.toml").write_text("[")
    assert load([tmp_path / "none", tmp_path / "c.toml"]).chunking == Chunking(chunk_size=5)
    assert load([tmp_path / "bad.toml"]) == Config() == overlay(Config(), {})


def test_streams(spark, tmp_path, data):
    src = tmp_path / "in" / "book"
    src.mkdir(parents=True)
    (src / "output_chunk0007.meta.json").write_text("{}")
    for _ in range(2):
        ingest.ingest_available(ingest.stream_metas(spark, str(tmp_path / "in")), str(tmp_path / "t"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "t")).collect() == [Row(book_id="book", chunk_no=7, meta="{}")]
    events = spark.read.parquet(f"{data}/events.parquet")
    assert ingest.sessions(events).agg(F.sum("n_events")).first()[0] == events.count()


def test_a_summary_reads_texts_once_and_deals_out_numbers_only(spark, tmp_path):
    texts = {
        1: "Short words.\n— A. B.\n\n# One {#a}\n\n## Two\r\nMore words.\u2028# Contents\nx\n# Three",
        2: "a[^1] b[^1]\n[^1]: note\n[^2]:\n> " + "q" * 30 + "\n> " + "q" * 29 + "\n# H\n" + "y" * 601 + "\n# I",
        3: "nothing", 4: "", 5: None, 6: "\n# A\n" + "y" * 600 + "\n# B"
    }
    spark.createDataFrame(list(texts.items()), "book_id long, text string").write.parquet(str(tmp_path / "books"))
    out = U.structural_summary(spark.read.parquet(str(tmp_path / "books")))
    assert {r[0]: tuple(r[1:]) for r in out.collect()} == {1: (2, 0, 0, 0), 2: (1, 1, 2, 1), 6: (1, 0, 0, 0)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Window" not in plan and "Generate" not in plan
    found = U.detect_epigraphs(spark.read.parquet(str(tmp_path / "books")).where("book_id = 1"))
    assert [tuple(r) for r in found.orderBy("before_heading_line").collect()] == [
        (1, 3, "One", 1, "Short words.\n— A. B.", "Short words.", "A. B."), (1, 9, "Three", 1, "x", "x", None)
    ]
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_planted_line_of_letters_is_that_of_two_passes(spark):
    odd = [(k, x) for k, x in enumerate(("a  b , c", " a1b ", "ж x\n\ny", "", "--", "a - b-c", None))]
    df = spark.createDataFrame(odd, "k int, text string")
    two = F.expr("trim(regexp_replace(regexp_replace(text, '[^A-Za-z ]+', ' '), ' +', ' '))")
    assert df.where(~two.eqNullSafe(F.expr(planted._ONE_LINE_SPARK))).count() == 0


def test_books_go_through_workers_in_bounded_pieces(spark):
    text = "# A\n\n" + "word " * 40_000 + "\n\n> q\n\n![i](images/a.png)\n\n[^1]: n"
    batch = pa.RecordBatch.from_pydict({"book_id": [str(k) for k in range(50)], "text": [text] * 50})
    seen = []

    def make(r):
        seen.append(r["book_id"])
        for k, b in enumerate(build.parse_blocks(r["text"])):
            yield r["book_id"], k, b["text"]

    schema = pa.schema([("book_id", pa.string()), ("block_no", pa.int32()), ("text", pa.string())])
    pieces = build._in_pieces(iter([batch]), make, schema)
    got = [next(pieces)]
    assert len(seen) < 15  # the first piece leaves before the batch is done
    got += list(pieces)
    assert max(p.nbytes for p in got) < build.BATCH_BYTES + 2 * len(text)
    assert [(r["book_id"], r["block_no"]) for p in got for r in p.to_pylist()] == [(str(k), n) for k in range(50) for n in range(5)]
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(limit)
    blocks = build.md_blocks(spark.createDataFrame([("a", text), ("b", ""), ("c", None)], "book_id string, text string"))
    assert int(spark.conf.get(limit)) == build.BATCH_BYTES
    assert [r.kind for r in blocks.orderBy("book_id", "block_no").collect()] == ["heading", "paragraph", "blockquote", "image", "footnote_def"]
