"""Queries of file formats, over archives made here: EPUB, FB2, text, images, sinks."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import functions as F

from ..functions import clean
from ..functions.text import guess_content_type
from ..operators import build, glossary
from ..sources import books as B
from .registry import query

_OPF = """<package xmlns="http://www.idpf.org/2007/opf" xmlns:dc="http://purl.org/dc/elements/1.1/"><metadata><dc:title>Glass</dc:title><dc:creator>Ann Bee</dc:creator><dc:creator>Cy Dee</dc:creator><dc:language>en</dc:language></metadata>
<manifest><item id="c1" href="t/chapter1.xhtml" media-type="application/xhtml+xml"/><item id="c2" href="t/part_two.xhtml" media-type="application/xhtml+xml"/><item id="cv" href="t/cover.xhtml" media-type="application/xhtml+xml"/></manifest>
<spine><itemref idref="cv"/><itemref idref="c1"/><itemref idref="c2"/><itemref idref="gone"/></spine></package>"""
_NCX = """<ncx xmlns="http://www.daisy.org/z3986/2005/ncx/"><navMap><navPoint><navLabel><text>One</text></navLabel><content src="t/chapter1.xhtml"/><navPoint><navLabel><text>Inner</text></navLabel><content src="t/chapter1.xhtml#a"/></navPoint></navPoint>
<navPoint><navLabel><text>Two</text></navLabel><content src="t/part_two.xhtml"/></navPoint></navMap></ncx>"""
_PAGES = {
    "t/cover.xhtml": "<p>Cover</p>",
    "t/chapter1.xhtml": "<h1>One</h1><p>It <i>was</i> a <b>day</b> &amp; night.</p><hr/>",
    "t/part_two.xhtml": '<h2>Two</h2><blockquote><p>Said.</p></blockquote><p>See <a href="x.html">this</a>.</p>'
}


def epub_bytes() -> bytes:
    """A small EPUB."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("META-INF/container.xml", '<container><rootfiles><rootfile full-path="OEBPS/book.opf"/></rootfiles></container>')
        z.writestr("OEBPS/book.opf", _OPF)
        z.writestr("OEBPS/toc.ncx", _NCX)
        for name, body in _PAGES.items():
            z.writestr(f"OEBPS/{name}", f"<html><head><title>x</title></head><body>{body}</body></html>")
        z.writestr("OEBPS/images/a.png", b"\x89PNG")
        z.writestr("OEBPS/images/notes.txt", b"no image")
    return out.getvalue()


def _files(t):
    return t.spark.createDataFrame([("b.epub", bytearray(epub_bytes()))], "path string, content binary")


@query(
    "SELECT 'b.epub' AS book_id, CAST(pos AS BIGINT) AS pos, href FROM (VALUES (0, 'OEBPS/t/cover.xhtml'), (1, 'OEBPS/t/chapter1.xhtml'), (2, 'OEBPS/t/part_two.xhtml')) v(pos, href)"
)
def scan_epub(t):
    return B.scan_epub(_files(t)).select("book_id", "pos", "href")


@query(
    "SELECT CAST(pos AS BIGINT) AS pos, stem, title FROM (VALUES (1, 'chapter1', 'Chapter 1'), (2, 'part_two', 'The Second')) v(pos, stem, title)"
)
def scan_epub_per_file(t):
    return B.scan_epub_per_file(_files(t), titles={"part_two": "The Second"}).select("pos", "stem", "title")


@query("SELECT replace('Cover¶¶# One¶¶It *was* a **day** & night.¶¶***¶¶## Two¶¶> Said.¶¶See [this](x.html).¶', '¶', chr(10)) AS text")
def epub_to_markdown(t):
    return B.epub_to_markdown(_files(t)).select("text")


@query("SELECT name, value FROM (VALUES ('title', 'Glass'), ('creator', 'Ann Bee; Cy Dee'), ('language', 'en')) v(name, value)")
def explore_epub_metadata(t):
    return B.epub_metadata(_files(t)).select("name", "value")


@query(
    "SELECT CAST(n AS BIGINT) AS n, CAST(level AS BIGINT) AS level, title, src FROM (VALUES (0, 1, 'One', 't/chapter1.xhtml'), (1, 2, 'Inner', 't/chapter1.xhtml#a'), (2, 1, 'Two', 't/part_two.xhtml')) v(n, level, title, src)"
)
def explore_ncx(t):
    return B.epub_contents(_files(t)).select("n", "level", "title", "src")


@query("SELECT 'OEBPS/images/a.png' AS path, 'image/png' AS content_type, CAST(4 AS BIGINT) AS size")
def copy_images(t):
    return B.epub_images(_files(t)).select(
        "path", guess_content_type(F.col("path")).alias("content_type"), F.octet_length("content").alias("size")
    )


@query("SELECT 'images/a.png' AS src, 'OEBPS/images/a.png' AS path, 'image/png' AS content_type")
def join_image_ref(t):
    refs = t.sql("SELECT 'b.epub' AS book_id, src FROM VALUES ('images/a.png'), ('images/lost.png') v(src)")
    return build.resolve_images(refs, B.epub_images(_files(t))).select("src", "path", "content_type")


_FB2 = "<FictionBook><description><title-info><author><first-name>Ann</first-name><last-name>Bee</last-name></author><book-title>Glass</book-title></title-info></description><body><section><title><p>One</p></title><p>Text.</p><empty-line/><cite><p>Said.</p></cite></section></body></FictionBook>"


@query("SELECT replace('# One¶¶Text.¶¶***¶¶> Said.¶', '¶', chr(10)) AS text")
def scan_fb2(t):
    return t.spark.createDataFrame([(_FB2,)], "x string").select(B.scan_fb2("x").alias("text"))


@query("SELECT 'Glass' AS title, 'Bee, Ann' AS author")
def meta_fb2(t):
    return t.spark.createDataFrame([(_FB2,)], "x string").select(B.meta_fb2("x").alias("m")).select("m.title", "m.author")


@query("SELECT 'a' AS path, 'x�y' AS text")
def scan_text_safe(t):
    return B.scan_text_safe(t.spark.createDataFrame([("a", bytearray(b"x\xffy"))], "path string, content binary"))


def _book(t):
    text = t.sql("SELECT 'b' AS book_id, replace('> Words.¶> — Ann¶¶# One¶¶A *b*[^1] \\\\*c.¶¶# Two¶¶[^1]: note', '¶', chr(10)) AS text")
    author = F.struct(
        F.lit("Ann").alias("first_name"), F.lit("C").alias("middle_name"), F.lit("Bee").alias("last_name"),
        F.lit(None).cast("string").alias("nickname")
    )
    heads = text.select(
        "book_id", F.lit("T").alias("title"), author.alias("author"), F.lit("en").alias("lang"),
        F.lit("2020-01-01").alias("date"), F.lit("u").alias("uid")
    )
    return build.build_fb2(build.md_blocks(text), heads)


@query(
    "SELECT part, xml FROM (VALUES ('body', '<body><section><title><p>One</p></title><epigraph><p>Words.</p><text-author>Ann</text-author></epigraph><p>A <emphasis>b</emphasis><a l:href=\"#note_1\" l:type=\"simple\"><sup>1</sup></a> *c.</p></section><section><subtitle>Two</subtitle></section></body>'), ('notes', '<body name=\"notes\"><section id=\"note_1\"><title><p>1</p></title><p>note</p></section></body>'), ('author', '<first-name>Ann</first-name><middle-name>C</middle-name><last-name>Bee</last-name>')) v(part, xml)"
)
def fb2_parts(t):
    parts = {"body": r"(<body>.*?</body>)", "notes": r"(<body name.*?</body>)", "author": r"<author>(.*?)</author>"}
    rows = F.array(*(F.struct(F.lit(k).alias("part"), F.regexp_extract("fb2", p, 1).alias("xml")) for k, p in parts.items()))
    return _book(t).select(F.explode(rows).alias("r")).select("r.part", "r.xml")


@query("SELECT true AS same, true AS more_lines")
def fb2_pretty(t):
    pretty = build.pretty_fb2(F.col("fb2"))
    bare = lambda c: F.regexp_replace(c, r"\n", "")
    return _book(t).select(
        (bare(pretty) == bare(F.col("fb2"))).alias("same"),
        (F.regexp_count(pretty, F.lit("\n")) > 10).alias("more_lines")
    )


@query(
    "SELECT CAST(id AS BIGINT) AS id, faults FROM (VALUES (1, ''), (2, 'section 0: parts out of order | section 1: no content'), (3, 'line 1: not well-formed')) v(id, faults)"
)
def fb2_validate(t):
    head = "<FictionBook><description><title-info><genre>g</genre><author/><book-title>t</book-title><lang>en</lang></title-info></description><body>"
    texts = t.spark.createDataFrame(
        [
            (2, f"{head}<section><p>x</p><title/></section><section><title/></section></body></FictionBook>"),
            (3, "<FictionBook>")
        ],
        "id long, x string"
    )
    return (
        _book(t).select(F.lit(1).cast("bigint").alias("id"), F.col("fb2").alias("x")).unionByName(texts)
        .select("id", build.fb2_validate("x").alias("faults"))
    )


@query("SELECT replace('# One¶link and X¶![image](images/a.png)¶', '¶', chr(10)) AS cleaned")
def clean_md_per_file(t):
    text = t.sql(
        "SELECT replace('# tfhabitatexpanded_bold_b_ 1¶# tfhabitatexpanded_bold_b_ One¶[link](#calibre_link-1){.c} and [X]{.minio}{.s}¶<img src=\"../images/a.png\"/>[]{#pg_1 .p}¶', '¶', chr(10)) AS x"
    )
    return text.select(clean.clean_md_per_file(F.col("x"), F.lit("One")).alias("cleaned"))


@query("SELECT id, choice FROM (VALUES ('a', 'skip'), ('b', 'accept'), ('c', 'x')) v(id, choice)")
def parse_decisions(t):
    texts = t.sql(
        """SELECT * FROM VALUES ('p', '[{"id":"a","choice":"skip"},{"id":"b","choice":"accept","kind":"k"}]'), ('q', '{"decisions":[{"id":"c","choice":"x"}]}') v(book_id, text)"""
    )
    return glossary.parse_decisions(texts).select("id", "choice")


@query(
    "SELECT CAST(pos AS BIGINT) AS pos, id, gender, CAST(frequency AS BIGINT) AS frequency FROM (VALUES (1, 'ann', 'female', 0), (2, 'bob', 'unknown', 3)) v(pos, id, gender, frequency)"
)
def load_glossary(t):
    texts = t.sql(
        """SELECT 'b' AS book_id, '{"version":2,"terms":[{"source":"Ann","target":"x","gender":"female"},{"source":"Bob","frequency":3}]}' AS text"""
    )
    return glossary.load_glossary(texts).select("pos", "id", "gender", "frequency")
