"""Structural units of books: epigraphs, footnotes, quotations, narrative arcs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.clean import clean_html_footnote
from ..functions.text import MATTER_TITLES, body_preview, heading_level, heading_title, strip
from .sections import LINE_END, lines

# Numbers as words in titles.
_NUMBERS = "one|two|three|four|five|six|seven|eight|nine|ten|first|second|third|fourth|fifth|sixth|seventh|eighth|ninth|tenth"
# Kinds of narrative arc by title, the first that matches.
ARCS = (
    (r"^interlude\s*([\divxlcm]+|[a-z]\b|(?:" + _NUMBERS + r"))", "interlude"), (r"^prologue\b", "prologue"),
    (r"^epilogue\b", "epilogue"), (r"^epigraphs?\b", "epigraph_only"),
    (r"^part\s*([\divxlcm]+|(?:" + _NUMBERS + r"))", "part"), (r"^глава\s*(\d+|[а-яё]+)", "chapter"),
    (r"^часть\s*(\d+|[а-яё]+)", "part"), (r"^chapter\s*(\d+|[a-z]+)", "chapter"),
    (r"^book\s*([\divxlcm]+|(?:" + _NUMBERS + r"))", "book"),
)
# How a footnote's definition and marker are written.
_FOOTNOTE = r"^\[\^([^\]]+)\]:(?U)\s*(.+)$"
_MARKER = r"\[\^([^\]]+)\](?!:)"


def match_arc(label: Column) -> Column:
    """struct(kind, group) by the first pattern that a title matches, or null."""
    s = strip(label)
    out = F.lit(None).cast("struct<kind:string,grp:string>")
    for pattern, kind in reversed(ARCS):
        p = f"(?iUu){pattern}"
        group = F.lower(F.regexp_extract(s, p, 1)) if "(" in pattern else F.lit("")
        out = F.when(s.rlike(p), F.struct(F.lit(kind).alias("kind"), group.alias("grp"))).otherwise(out)
    return out


def _arcs_marked(chunks: DataFrame) -> DataFrame:
    """Chunks (book_id, chunk_no, label) with their arc's number, kind and label."""
    w = Window.partitionBy("book_id").orderBy("chunk_no")
    arc = match_arc(F.col("label"))
    kind, label = F.coalesce(arc["kind"], F.lit("unknown")), F.when(arc.isNotNull(), F.col("label")).otherwise("main")
    named = chunks.withColumn("kind", kind).withColumn("label", label)
    starts = named.withColumn("new", (~F.col("label").eqNullSafe(F.lag("label").over(w))).cast("int"))
    return starts.withColumn("arc_no", F.sum("new").over(w))


def narrative_arcs(chunks: DataFrame) -> DataFrame:
    """Runs of consecutive chunks of one label (columns book_id, chunk_no, label): arc_no, label, kind, first, last and number of chunks."""
    return _arcs_marked(chunks).groupBy("book_id", "arc_no").agg(
        F.min("label").alias("label"), F.min("kind").alias("kind"), F.min("chunk_no").alias("first_chunk"),
        F.max("chunk_no").alias("last_chunk"), F.count("*").alias("n_chunks"),
    )


def chunk_to_arc(chunks: DataFrame) -> DataFrame:
    """book_id, chunk_no, arc_no: the running number of the arcs itself, so nothing is joined."""
    return _arcs_marked(chunks).select("book_id", "chunk_no", "arc_no")


def _headed(books: DataFrame) -> DataFrame:
    """Books (book_id, text) with their lines as an array, and the places (from 0) of the headings among them."""
    split = books.withColumn("lines", F.split(F.coalesce("text", F.lit("")), LINE_END))
    places = F.transform("lines", lambda x, i: F.when(x.startswith("#") & heading_level(x).isNotNull(), i))
    return split.withColumn("heads", F.array_compact(places))


def _epigraphs(most: int) -> Column:
    """Of a book of _headed, the epigraphs as array of (at, heading, text). A text's lines are looked at once."""

    def before(at: Column, k: Column) -> Column:
        start = F.coalesce(F.get("heads", k - 1) + 1, F.lit(0))
        body = strip(F.array_join(F.slice("lines", start + 1, at - start), "\n"))
        return F.struct(at.alias("at"), F.get("lines", at).alias("heading"), body.alias("text"))

    matter = r"(?iUu)^(" + "|".join(MATTER_TITLES) + r")\b"
    return F.filter(
        F.transform("heads", before),
        lambda x: (x.text != "") & (F.length(x.text) <= most) & ~heading_title(x.heading).rlike(matter)
    )


def detect_epigraphs(books: DataFrame, most: int = 600) -> DataFrame:
    """Short text right before a chapter heading, back to the heading before: before_heading_line (from 0), title, level, text, quoted, attribution."""
    found = _headed(books.select("book_id", "text")).select("book_id", F.explode(_epigraphs(most)).alias("e")).select(
        "book_id", F.col("e.at").alias("before_heading_line"), heading_title(F.col("e.heading")).alias("heading_text"),
        heading_level(F.col("e.heading")).alias("heading_level"), "e.text"
    )
    last = F.regexp_extract("text", r"(?:^|\n)\s*[—–-]\s*([^\n]+)$", 1)
    quoted = strip(F.regexp_replace("text", r"(?:^|\n)\s*[—–-]\s*[^\n]+$", ""))
    return found.select(
        "book_id", "before_heading_line", "heading_text", "heading_level", "text",
        F.when(last != "", quoted).otherwise(F.col("text")).alias("quoted_text"),
        F.nullif(strip(last), F.lit("")).alias("attribution")
    )


def footnote_defs(books: DataFrame) -> DataFrame:
    """Definitions `[^m]: text`: marker, definition_text, position (of the line in the text), line (from 1)."""
    w = Window.partitionBy("book_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    at = lines(books.select("book_id", "text")).withColumn("position", F.coalesce(F.sum(F.length("line") + 1).over(w), F.lit(0)))
    return at.where(F.col("line").rlike(_FOOTNOTE)).select(
        "book_id", F.regexp_extract("line", _FOOTNOTE, 1).alias("marker"),
        strip(F.regexp_extract("line", _FOOTNOTE, 2)).alias("definition_text"), "position",
        (F.col("line_no") + 1).alias("line")
    )


def footnote_markers(books: DataFrame) -> DataFrame:
    """Markers `[^m]` in texts, with their line (from 1) and order within it."""
    found = lines(books.select("book_id", "text")).select(
        "book_id", "line_no", F.posexplode(F.regexp_extract_all("line", F.lit(_MARKER), F.lit(1))).alias("k", "marker")
    )
    return found.select("book_id", "marker", (F.col("line_no") + 1).alias("line"), "k")


def footnote_orphans(books: DataFrame) -> DataFrame:
    """Markers without a definition and definitions without a marker: book_id, marker, side."""
    used, defined = (
        footnote_markers(books).select("book_id", "marker").distinct(), footnote_defs(books).select("book_id", "marker")
        .distinct()
    )
    return (
        used.exceptAll(defined).withColumn("side", F.lit("no_definition"))
        .unionByName(defined.exceptAll(used).withColumn("side", F.lit("no_marker")))
    )


def _quote(line: Column) -> Column:
    return strip(F.regexp_extract(line, r"(?U)^>\s+(.+)$", 1))


def inline_quotes(books: DataFrame, least: int = 30, most: int = 600) -> DataFrame:
    """Quoted lines `> text` of moderate length."""
    return (
        lines(books.select("book_id", "text"))
        .select("book_id", (F.col("line_no") + 1).alias("line"), _quote(F.col("line")).alias("quote"))
        .where(F.length("quote").between(least, most))
    )


def structural_summary(books: DataFrame) -> DataFrame:
    """Per book, how many of each unit; a book that has none is left out.

    Texts are read once and counted where they lie: of a book only its numbers are dealt out.
    """
    cut = _headed(books.select("book_id", "text")).withColumn("rows", F.split(F.coalesce("text", F.lit("")), "\n"))
    quoted = F.transform(F.filter("rows", lambda x: x.startswith(">")), lambda x: F.length(_quote(x)))
    kinds = {
        "n_epigraphs": F.size(_epigraphs(600)),
        "n_definitions": F.size(F.filter("rows", lambda x: x.startswith("[^") & x.rlike(_FOOTNOTE))),
        "n_markers": F.aggregate("rows", F.lit(0), lambda n, x: n + F.regexp_count(x, F.lit(_MARKER))),
        "n_quotes": F.size(F.filter(quoted, lambda n: n.between(30, 600)))
    }
    counts = cut.select("book_id", *(c.alias(name) for name, c in kinds.items()))
    summed = counts.groupBy("book_id").agg(*(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in kinds))
    return summed.where(" + ".join(kinds) + " > 0")


# How content files mark a footnote's text.
_LI = (
    r"(?is)<li[^>]*epub:type=[\"']footnote[\"'][^>]*\bid=[\"']([^\"']+)[\"'][^>]*>(.*?)</li>",
    r"(?is)<li[^>]*\bid=[\"']([^\"']+)[\"'][^>]*epub:type=[\"']footnote[\"'][^>]*>(.*?)</li>",
)


def footnote_bodies(files: DataFrame) -> DataFrame:
    """Footnote texts by id from content files (book_id, path, html): of several with one id, the first by kind of file, path and place."""
    rank = F.when(F.lower("path").endswith(".xhtml"), 0).otherwise(1)
    found = None
    for k, p in enumerate(_LI):
        pairs = F.arrays_zip(
            F.regexp_extract_all("html", F.lit(p), F.lit(1)).alias("id"),
            F.regexp_extract_all("html", F.lit(p), F.lit(2)).alias("body")
        )
        one = files.select("book_id", rank.alias("rank"), "path", F.lit(k).alias("form"), F.posexplode(pairs).alias("k", "x")).select(
            "book_id", "rank", "path", "form", "k", F.col("x.id").alias("footnote_id"),
            clean_html_footnote(F.col("x.body")).alias("body")
        )
        found = one if found is None else found.unionByName(one)
    first = F.row_number().over(Window.partitionBy("book_id", "footnote_id").orderBy("rank", "path", "form", "k"))
    return found.where("body != ''").withColumn("n", first).where("n = 1").select("book_id", "footnote_id", "body")


# Anchors as converters write them, wrapped in a span, or bare with a class.
ANCHOR = r"\[\[?\\?\*\]\((?:[^)]+\.xhtml#([\w\-]+))\)\{#[\w_]+[^}]*\}\]\{\.epub-sup-fn\}|\[\\?\*\]\((?:[^)]+\.xhtml#([\w\-]+))\)\{[^}]*\.noteref[^}]*\}"


def footnote_anchors(chunks: DataFrame) -> DataFrame:
    """Anchors of chunks (book_id, chunk_no, text) in order: k, footnote_id."""
    ids = F.transform(F.regexp_extract_all("text", F.lit(ANCHOR), F.lit(0)), lambda m: F.regexp_extract(m, r"\.xhtml#([\w\-]+)\)", 1))
    return chunks.select("book_id", "chunk_no", F.posexplode(ids).alias("k", "footnote_id"))


def footnote_numbering(chunks: DataFrame, bodies: DataFrame) -> DataFrame:
    """Anchors that have a body, numbered by first appearance in the book: chunk_no, k, footnote_id, number, is_first, body, body_preview."""
    anchored = footnote_anchors(chunks).join(bodies, ["book_id", "footnote_id"])
    first = anchored.groupBy("book_id", "footnote_id").agg(F.min(F.struct("chunk_no", "k")).alias("at"))
    numbers = first.withColumn("number", F.row_number().over(Window.partitionBy("book_id").orderBy("at")))
    joined = anchored.join(numbers, ["book_id", "footnote_id"])
    return joined.select(
        "book_id", "chunk_no", "k", "footnote_id", "number",
        (F.struct("chunk_no", "k") == F.col("at")).alias("is_first"), "body",
        body_preview(F.col("body")).alias("body_preview")
    )


def number_footnotes(chunks: DataFrame, bodies: DataFrame) -> DataFrame:
    """Chunk texts with anchors as `[^n]`, those without body removed, and definitions after the chunk of first appearance."""
    notes = (
        footnote_numbering(chunks, bodies).groupBy("book_id", "chunk_no")
        .agg(F.collect_list(F.struct("k", "number", "is_first", "body")).alias("notes"))
    )

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import re

        pattern = re.compile(ANCHOR)
        for pdf in batches:
            texts = []
            for text, found in zip(pdf["text"], pdf["notes"], strict=True):
                by_place = {n["k"]: n for n in (found if found is not None else [])}
                place = iter(range(len(text or "")))
                text = pattern.sub(lambda m: f"[^{by_place[k]['number']}]" if (k := next(place)) in by_place else "", text or "")
                new = sorted((n for n in by_place.values() if n["is_first"]), key=lambda n: n["number"])
                texts.append("\n\n".join([text.rstrip(), *(f"[^{n['number']}]: {n['body']}" for n in new)]) if new else text)
            yield pd.DataFrame({"book_id": pdf["book_id"], "chunk_no": pdf["chunk_no"], "text": texts})

    joined = chunks.select("book_id", "chunk_no", "text").join(notes, ["book_id", "chunk_no"], "left")
    return joined.mapInPandas(rewrite, joined.select("book_id", "chunk_no", "text").schema)
