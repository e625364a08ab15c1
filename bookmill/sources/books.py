"""Book sources: EPUB and FB2 files, content pages, text, JSON and settings."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from pathlib import PurePosixPath
from urllib.parse import unquote
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.clean import strip_tags, unescape_html
from ..functions.text import strip, title_from_basename

# Stems of content files that hold no text of the book.
EXCLUDED = (
    "cover", "title", "mini_toc", "copyrightnotice", "contents", "adcard", "newsletter", "copyright", "torad", "toc",
    "tableofcontents", "imprint", "halftitle"
)
IMAGES = ("gif", "jpg", "jpeg", "png", "svg", "bmp")


class _Markdown(HTMLParser):
    """HTML to Markdown, block by block.

    Headings, paragraphs, line breaks, rules, quotations, lists (numbered and nested ones too), preformatted text, tables
    (the first row heads), bold, italic, code, links and images with their titles are kept; of all else, the text.
    """

    SKIP = ("script", "style", "head", "title")
    MARK = {"b": "**", "strong": "**", "i": "*", "em": "*", "code": "`"}
    PARTS = ("p", "div", "section", "article", "nav", "footer", "header", "body")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[str] = []
        self.line: list[str] = []
        self.prefix, self.skip, self.quote = "", 0, 0
        self.links: list[str | None] = []
        self.lists: list[int | None] = []  # of numbered lists, the last number
        self.table: list[list[str]] | None = None
        self.pre: list[str] | None = None

    def _taken(self) -> str:
        """The inline text since the last block."""
        text = re.sub(r"[ \t\r\n]+", " ", "".join(self.line)).replace(" \x00", "\x00").strip()
        self.line = []
        return text

    def _end(self) -> None:
        if self.table is not None:  # blocks in a cell are one line
            self.line.append(" ")
            return
        text = self._taken().replace("\x00", "\\\n")
        if text:
            self.blocks.append("> " * self.quote + self.prefix + text)
        self.prefix = ""

    def _end_table(self) -> None:
        rows, self.table, self.line = self.table or [], None, []
        width = max(map(len, rows), default=0)
        if width:
            told = ["| " + " | ".join([*r, *[""] * (width - len(r))]) + " |" for r in rows if r]
            self.blocks.append("\n".join([told[0], "|" + " --- |" * width, *told[1:]]))

    def _end_pre(self) -> None:
        text, self.pre = "".join(self.pre or []).strip("\n"), None
        if text:
            self.blocks.append(f"```\n{text}\n```")

    @staticmethod
    def _target(href: str, title: str | None) -> str:
        return f'({href} "{title}")' if title else f"({href})"

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = dict(attrs)
        if tag in self.SKIP:
            self.skip += 1
        elif tag == "pre" and self.table is None:
            self._end()
            self.pre = []
        elif self.pre is not None:
            return
        elif tag == "table":
            self._end()
            self.table = []
        elif tag == "tr" and self.table is not None:
            self.table.append([])
        elif tag in ("td", "th") and self.table:
            self.line = []
        elif re.fullmatch("h[1-6]", tag):
            self._end()
            self.prefix = "#" * int(tag[1]) + " "
        elif tag in ("ul", "ol"):
            self._end()
            self.lists.append(0 if tag == "ol" else None)
        elif tag == "li":
            self._end()
            depth = max(len(self.lists) - 1, 0)
            if self.lists and self.lists[-1] is not None:
                self.lists[-1] += 1
                self.prefix = f"{'    ' * depth}{self.lists[-1]}. "
            else:
                self.prefix = "    " * depth + "- "
        elif tag in self.PARTS:
            if not (self.prefix.lstrip().startswith("-") or self.prefix.endswith(". ")) or "".join(self.line).strip():
                self._end()  # the first part of a list item stays in its line
        elif tag == "blockquote":
            self._end()
            self.quote += 1
        elif tag == "hr":
            self._end()
            self.blocks.append("***")
        elif tag == "br":
            self.line.append("\x00" if self.table is None else " ")
        elif tag == "img":
            self.line.append(f"![{a.get('alt') or ''}]{self._target(a.get('src') or '', a.get('title'))}")
        elif tag == "a":
            self.links.append(self._target(a["href"], a.get("title")) if a.get("href") else None)
            self.line.append("[" if a.get("href") else "")
        elif tag in self.MARK:
            self.line.append(self.MARK[tag])

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag in (*self.SKIP, *self.PARTS, "li", "a", "blockquote", "table", "pre", "ul", "ol", *self.MARK):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in self.SKIP:
            self.skip = max(0, self.skip - 1)
        elif self.pre is not None:
            if tag == "pre":
                self._end_pre()
        elif tag == "table" and self.table is not None:
            self._end_table()
        elif tag in ("td", "th") and self.table:
            self.table[-1].append(self._taken().replace("|", "\\|"))
        elif tag in ("ul", "ol"):
            self._end()
            if self.lists:
                self.lists.pop()
        elif re.fullmatch("h[1-6]", tag) or tag == "li" or tag in self.PARTS:
            self._end()
        elif tag == "blockquote":
            self._end()
            self.quote = max(0, self.quote - 1)
        elif tag == "a" and self.links:
            target = self.links.pop()
            self.line.append(f"]{target}" if target else "")
        elif tag in self.MARK:
            self.line.append(self.MARK[tag])

    def handle_data(self, data: str) -> None:
        if not self.skip:
            (self.line if self.pre is None else self.pre).append(data)

    def close(self) -> None:
        super().close()
        if self.pre is not None:
            self._end_pre()
        if self.table is not None:
            self._end_table()
        self._end()


def to_markdown(html: str) -> str:
    p = _Markdown()
    p.feed(html)
    p.close()
    return "\n\n".join(p.blocks) + "\n" if p.blocks else ""


@F.pandas_udf(StringType())
def html_to_markdown(s: pd.Series) -> pd.Series:
    """Markdown of HTML; see _Markdown for what is kept."""
    return s.map(to_markdown, na_action="ignore")


def _parse(data: bytes) -> ElementTree.Element | None:
    try:
        return ElementTree.fromstring(data)
    except ElementTree.ParseError:
        return None


def _tag(el: ElementTree.Element) -> str:
    return el.tag.rpartition("}")[2]


def read_package(z: zipfile.ZipFile) -> dict:
    """An EPUB's package: metadata (values of one name joined by `; `), manifest and spine, with hrefs from the archive's root."""
    names = z.namelist()
    container = _parse(z.read("META-INF/container.xml")) if "META-INF/container.xml" in names else None
    roots = [e.get("full-path") for e in container.iter() if _tag(e) == "rootfile"] if container is not None else []
    opf = next((r for r in roots if r in names), None) or min(
        (n for n in names if n.lower().endswith(".opf")), key=lambda n: (len(n), n), default=None
    )
    root = _parse(z.read(opf)) if opf else None
    out: dict = {"metadata": {}, "manifest": {}, "spine": []}
    if root is None:
        return out
    base = PurePosixPath(opf).parent
    for e in root.iter():
        kind = _tag(e)
        if kind in ("title", "creator", "language", "identifier", "publisher", "date", "description") and (e.text or "").strip():
            had = out["metadata"].get(kind)
            out["metadata"][kind] = f"{had}; {e.text.strip()}" if had else e.text.strip()
        elif kind == "item" and e.get("id"):
            out["manifest"][e.get("id")] = (str(base / unquote(e.get("href", ""))), e.get("media-type", ""))
        elif kind == "itemref" and e.get("idref"):
            out["spine"].append(e.get("idref"))
    return out


def _pages(z: zipfile.ZipFile) -> list[tuple[int, str]]:
    """Content files in reading order; without a usable spine, the largest."""
    names, package = set(z.namelist()), read_package(z)
    listed = [package["manifest"][i][0] for i in package["spine"] if i in package["manifest"]]
    pages = [p for p in listed if p in names and p.lower().endswith((".html", ".xhtml", ".htm"))]
    if not pages:
        for end in (".xhtml", ".html"):
            if some := [n for n in names if n.lower().endswith(end)]:
                pages = [max(some, key=lambda n: (z.getinfo(n).file_size, n))]
                break
    return list(enumerate(pages))


def _body(html: str) -> str:
    m = re.search(r"(?is)<body[^>]*>(.*)</body>", html)
    return m[1] if m else html


def binary_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """Files as (path, content)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")


def _each(files: DataFrame, rows, schema: str) -> DataFrame:
    """rows(path, archive) of every EPUB; a file that is no archive gives none."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                if zipfile.is_zipfile(io.BytesIO(content)):
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        yield pd.DataFrame(list(rows(path, z)), columns=names)

    return files.mapInPandas(run, schema)


def scan_epub(files: DataFrame) -> DataFrame:
    """Content pages of EPUB files in reading order: book_id (path), pos, href, html (the body)."""
    return _each(
        files,
        lambda path, z: [(path, k, href, _body(z.read(href).decode("utf-8", "replace"))) for k, href in _pages(z)],
        "book_id string, pos int, href string, html string"
    )


def epub_to_markdown(files: DataFrame) -> DataFrame:
    """One Markdown text per EPUB."""
    pages = scan_epub(files).withColumn("md", html_to_markdown("html"))
    return pages.groupBy("book_id").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("pos", "md"))), lambda x: x.md), "\n"
        ).alias("text")
    )


def scan_epub_per_file(files: DataFrame, exclude: tuple[str, ...] = (), titles: dict[str, str] | None = None) -> DataFrame:
    """Content pages apart, without excluded stems, each with its title: book_id, pos, href, stem, title, html."""
    stem = F.regexp_extract("href", r"([^/]*?)(?:\.[^./]*)?$", 1)
    own = F.try_element_at(F.create_map(*(F.lit(x) for kv in (titles or {"": ""}).items() for x in kv)), stem)
    pages = scan_epub(files).withColumn("stem", stem)
    return pages.where(
        ~F.lower("stem").isin(*{*EXCLUDED, *(e.lower() for e in exclude)})
    ).withColumn("title", F.coalesce(own, title_from_basename(F.col("stem"))))


def epub_metadata(files: DataFrame) -> DataFrame:
    """(book_id, name, value) of the package metadata."""
    return _each(
        files, lambda path, z: [(path, k, v) for k, v in read_package(z)["metadata"].items()],
        "book_id string, name string, value string"
    )


def epub_contents(files: DataFrame) -> DataFrame:
    """Navigation points of NCX files, each once: book_id, n, level, title, src."""

    def points(el: ElementTree.Element, level: int) -> Iterator[tuple[int, str, str]]:
        for p in (c for c in el if _tag(c) == "navPoint"):
            label = next((" ".join(t.text.split()) for t in p.iter() if _tag(t) == "text" and t.text), "")
            src = next((c.get("src", "") for c in p if _tag(c) == "content"), "")
            if label and src:
                yield level, label, src
            yield from points(p, level + 1)

    def rows(path: str, z: zipfile.ZipFile) -> list[tuple]:
        found = []
        for name in sorted(n for n in z.namelist() if n.lower().endswith(".ncx")):
            root = _parse(z.read(name))
            nav = next((e for e in root.iter() if _tag(e) == "navMap"), None) if root is not None else None
            found += list(points(nav, 1)) if nav is not None else []
        return [(path, k, *f) for k, f in enumerate(found)]

    return _each(files, rows, "book_id string, n int, level int, title string, src string")


def epub_images(files: DataFrame) -> DataFrame:
    """Image files in folders named images: book_id, path, content."""
    keep = re.compile(r"(?i)(?:^|/)images/[^/]+\.(?:" + "|".join(IMAGES) + ")$")
    return _each(
        files, lambda path, z: [(path, n, z.read(n)) for n in z.namelist() if keep.search(n)],
        "book_id string, path string, content binary"
    )


def content_file_stats(pages: DataFrame, chunk_size: int = 30_000) -> DataFrame:
    """Per book (book_id, size): files, bytes, and the characters and chunks they may come to."""
    sums = pages.groupBy("book_id").agg(F.count("*").alias("n_files"), F.sum("size").alias("n_bytes"))
    chars = F.floor(F.col("n_bytes") / 2).cast("bigint")
    return sums.withColumn("est_chars", chars).withColumn(
        "est_chunks", F.greatest(F.lit(1), F.floor(F.col("est_chars") / chunk_size)).cast("bigint")
    )


def heading_titles(html: Column, most: int = 50) -> Column:
    """Texts of first- and second-level headings, tags removed, shorter than 200 characters."""
    raw = F.regexp_extract_all(html, F.lit(r"(?is)<h[12][^>]*>(.*?)</h[12]>"), F.lit(1))
    return F.slice(F.filter(F.transform(raw, lambda x: strip(strip_tags(x))), lambda x: (x != "") & (F.length(x) < 200)), 1, most)


def meta_html(html: Column) -> Column:
    """struct(title, author) of a page; the last author given counts."""
    title = unescape_free(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))
    author = F.element_at(
        F.concat(
            F.array(F.lit("")),
            F.regexp_extract_all(
                html, F.lit(r"(?is)<meta\s+name=[\"'](?:author|dc\.creator)[\"']\s+content=[\"']([^\"']*)[\"']"),
                F.lit(1)
            )
        ),
        -1
    )
    return F.struct(title.alias("title"), author.alias("author"))


def unescape_free(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


@F.pandas_udf(StructType([StructField("title", StringType()), StructField("author", StringType())]))
def meta_fb2(s: pd.Series) -> pd.DataFrame:
    """Title and `Last, First` author of FB2 texts; the author only where both names are given."""
    rows = []
    for text in s:
        root = _parse((text or "").encode())
        found: dict[str, str] = {}
        for e in root.iter() if root is not None else ():
            if _tag(e) in ("book-title", "first-name", "last-name") and (e.text or "").strip():
                found.setdefault(_tag(e), e.text.strip())
        both = "first-name" in found and "last-name" in found
        rows.append((found.get("book-title", ""), f"{found['last-name']}, {found['first-name']}" if both else ""))
    return pd.DataFrame(rows, columns=["title", "author"])


def fb2_markdown(text: str) -> str:
    """An FB2 document's main bodies as Markdown: titles as headings by depth, paragraphs, quotations, empty lines."""
    root = _parse(text.encode())
    out: list[str] = []

    def walk(el: ElementTree.Element, depth: int, mark: str = "") -> None:
        for c in el:
            kind = _tag(c)
            words = " ".join("".join(c.itertext()).split())
            if kind == "title":
                out.append("#" * min(max(depth, 1), 6) + " " + words)
            elif kind == "section":
                walk(c, depth + 1)
            elif kind in ("epigraph", "cite"):
                walk(c, depth, "> ")
            elif kind == "text-author":
                out.append(f"{mark}— {words}")
            elif kind == "empty-line":
                out.append("***")
            elif kind in ("p", "subtitle", "v") and words:
                out.append(mark + words)
            elif kind in ("poem", "stanza", "annotation"):
                walk(c, depth, mark)

    for body in root.iter() if root is not None else ():
        if _tag(body) == "body" and not body.get("name"):
            walk(body, 0)
    return "\n\n".join(out) + "\n" if out else ""


@F.pandas_udf(StringType())
def scan_fb2(s: pd.Series) -> pd.Series:
    """Markdown of FB2 texts."""
    return s.map(lambda x: fb2_markdown(x or ""))


def scan_text_safe(files: DataFrame) -> DataFrame:
    """(path, text): bytes as UTF-8, faults as the replacement character."""
    return files.select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def scan_json_safe(texts: DataFrame) -> DataFrame:
    """(path, json VARIANT, ok): unparsable texts have null json."""
    from ..functions.text import sanitize_surrogates

    v = F.try_parse_json(sanitize_surrogates(F.col("text")))
    return texts.select("path", v.alias("json"), v.isNotNull().alias("ok"))


def _json_fault(text: str | None, most: int = 120) -> str | None:
    try:
        json.loads(text or "")
    except ValueError as e:
        return str(e)[:most]
    return None


@F.pandas_udf(StringType())
def check_json(s: pd.Series) -> pd.Series:
    """What is wrong with JSON texts, in 120 characters at most; null for a sound one."""
    return pd.Series([_json_fault(x) for x in s], dtype=object)


def scan_chunks(spark: SparkSession, path: str, output: bool = False) -> DataFrame:
    """Chunk files (or output files) of a folder, without backups, half-written and polished ones: file_name, chunk_no, text."""
    name = F.col("_metadata.file_name")
    files = spark.read.text(
        path, wholetext=True, pathGlobFilter=f"{'output_chunk' if output else 'chunk'}*.md"
    ).select(name.alias("file_name"), F.col("value").alias("text"))
    return files.where(~F.col("file_name").rlike(r"\.(?:bak|tmp)$|\.polished\.md$")).withColumn(
        "chunk_no", F.regexp_extract("file_name", r"(\d+)", 1).cast("int")
    )


def config_map(text: Column) -> Column:
    """Settings `key=value` by line, split at the first `=`, both sides stripped; the last of equal keys counts."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.contains(x, F.lit("=")))
    pairs = F.transform(
        lines,
        lambda x: F.struct(
            strip(F.regexp_extract(x, r"^([^=]*)=", 1)).alias("k"),
            strip(F.regexp_replace(x, r"^[^=]*=", "")).alias("v")
        )
    )
    return pairs
