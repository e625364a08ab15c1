"""Sections and chunks of books. Books are rows (book_id, text); a book's lines, sections and chunks carry their numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import Chunking
from ..functions.clean import strip_toc
from ..functions.text import FRONT, heading_level, heading_title, paragraphs, section_kind, strip

#: What Python's splitlines breaks at.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def lines(books: DataFrame, text: str = "text", end: str = "\n") -> DataFrame:
    """One row per line: the other columns, line_no from 0, line."""
    keep = [c for c in books.columns if c != text]
    return books.select(*keep, F.posexplode(F.split(text, end)).alias("line_no", "line"))


def split_sections(books: DataFrame) -> DataFrame:
    """Sections at first- and second-level headings: book_id, section_no, level, title, text. What stands before is level 0; empty ones go.

    A book is one window partition, whose rows are its lines: the order within a book is the data.
    """
    w = Window.partitionBy("book_id").orderBy("line_no")
    marked = lines(books.select("book_id", "text"), end=LINE_END).withColumn("level", heading_level(F.col("line")))
    numbered = marked.withColumn("section_no", F.count("level").over(w))
    joined = numbered.groupBy("book_id", "section_no").agg(
        F.coalesce(F.max("level"), F.lit(0)).alias("level"),
        F.coalesce(F.max(F.when(F.col("level").isNotNull(), heading_title(F.col("line")))), F.lit(FRONT)).alias("title"),
        strip(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x.line), "\n")).alias("text"),
    )
    return joined.where("text != ''")


def merge_front_back(sections: DataFrame, *, most: int = 15_000, append_trailing: bool = False) -> DataFrame:
    """Short front and back matter joins the next narrative section; what trails joins the last one (before it, or after if append_trailing)."""
    kind = F.when(F.length("text") >= most, "narrative").otherwise(section_kind(F.col("title")))
    w = Window.partitionBy("book_id").orderBy("section_no")
    story = F.when(F.col("kind") == "narrative", F.col("section_no"))
    hosted = (
        sections.withColumn("kind", kind)
        .withColumn("next", F.first(story, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("host", F.coalesce("next", F.max(story).over(Window.partitionBy("book_id")), "section_no"))
    )
    own = F.col("section_no") == F.col("host")
    place = F.when(own, 1).when(F.lit(append_trailing) & F.col("next").isNull(), 2).otherwise(0)
    parts = F.array_sort(F.collect_list(F.struct(place.alias("place"), "section_no", "text")))
    return hosted.groupBy("book_id", F.col("host").alias("section_no")).agg(
        F.max(F.when(own, F.col("level"))).alias("level"), F.max(F.when(own, F.col("title"))).alias("title"),
        F.array_join(F.transform(parts, lambda p: p.text), "\n\n").alias("text")
    )


def _greedy(parts: Column, fits) -> Column:
    """Consecutive parts joined by blank lines while `fits(current, next)`."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(None).cast("string").alias("cur"))

    def step(acc: Column, p: Column) -> Column:
        more = acc.cur.isNull() | fits(acc.cur, p)
        return F.struct(
            F.when(more, acc.out).otherwise(F.array_append(acc.out, acc.cur)).alias("out"),
            F.when(acc.cur.isNull() | ~more, p).otherwise(F.concat(acc.cur, F.lit("\n\n"), p)).alias("cur")
        )

    return F.aggregate(parts, start, step, lambda acc: F.when(acc.cur.isNull(), acc.out).otherwise(F.array_append(acc.out, acc.cur)))


def split_by_size(text: Column, chunk_size: int, soft_limit: int) -> Column:
    """Paragraphs packed in order up to chunk_size characters (blank lines not counted); longer ones than soft_limit by sentences, apart from what came before."""
    flag = lambda p: F.length(p) > soft_limit
    sentence = r"(?<=[.!?…»)])\s+(?=[А-ЯЁA-Z„\"«(])"
    units = F.flatten(
        F.transform(
            paragraphs(text),
            lambda p: F.when(
                flag(p), F.transform(F.split(p, sentence), lambda s, i: F.struct(s.alias("s"), (i == 0).alias("new")))
            ).otherwise(F.array(F.struct(p.alias("s"), F.lit(False).alias("new"))))
        )
    )
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(None).cast("string").alias("cur"))

    def step(acc: Column, u: Column) -> Column:
        more = acc.cur.isNull() | (~u.new & (F.length(acc.cur) + F.length(u.s) <= chunk_size))
        return F.struct(
            F.when(more, acc.out).otherwise(F.array_append(acc.out, strip(acc.cur))).alias("out"),
            F.when(acc.cur.isNull() | ~more, u.s).otherwise(F.concat(acc.cur, F.lit("\n\n"), u.s)).alias("cur")
        )

    return F.aggregate(units, start, step, lambda acc: F.when(acc.cur.isNull(), acc.out).otherwise(F.array_append(acc.out, strip(acc.cur))))


def split_scene_breaks(text: Column) -> Column:
    """Parts that end after a paragraph of three or more asterisks."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(None).cast("string").alias("cur"))

    def step(acc: Column, p: Column) -> Column:
        now = F.when(acc.cur.isNull(), p).otherwise(F.concat(acc.cur, F.lit("\n\n"), p))
        end = p.rlike(r"^\s*\*{3,}\s*$")
        return F.struct(F.when(end, F.array_append(acc.out, now)).otherwise(acc.out).alias("out"), F.when(~end, now).alias("cur"))

    return F.aggregate(
        paragraphs(text), start, step,
        lambda acc: F.when(acc.cur.isNull(), acc.out).otherwise(F.array_append(acc.out, acc.cur))
    )


def merge_small_chunks(parts: Column, limit: int) -> Column:
    """Neighbours joined while both and the blank line fit the limit."""
    return _greedy(parts, lambda a, b: F.length(a) + F.length(b) + 2 <= limit)


def chunk_section(text: Column, c: Chunking = Chunking()) -> Column:
    """The chunks of one section: whole if it fits; else by scenes and size, small ones merged; by size alone unless chapter_only."""
    by_size = split_by_size(text, c.chunk_size, c.soft_limit)
    if not c.chapter_only:
        return by_size
    scenes = F.flatten(F.transform(split_scene_breaks(text), lambda p: split_by_size(p, c.chunk_size, c.soft_limit)))
    return F.when(F.length(text) <= c.chunk_size, F.array(text)).otherwise(merge_small_chunks(scenes, c.chunk_size))


def number_chunks(sections: DataFrame, c: Chunking = Chunking()) -> DataFrame:
    """The manifest with texts: book_id, chunk_no, chunk_id, section_no, section_title, section_level, source (hash), size, text."""
    pieces = sections.select(
        "book_id", "section_no", "level", "title",
        F.posexplode(chunk_section(F.col("text"), c)).alias("piece_no", "text")
    )
    n = F.row_number().over(Window.partitionBy("book_id").orderBy("section_no", "piece_no"))
    return pieces.withColumn("chunk_no", n).select(
        "book_id", "chunk_no", F.format_string("chunk%04d", "chunk_no").alias("chunk_id"), "section_no",
        F.col("title").alias("section_title"), F.col("level").alias("section_level"),
        F.sha2("text", 256).alias("source"), F.length("text").cast("bigint").alias("size"), "text",
    )


def tiny_chunks(manifest: DataFrame, least: int, show: int = 8) -> DataFrame:
    """Per book: how many chunks are shorter than `least`, and the first few."""
    few = F.slice(F.array_sort(F.collect_list("chunk_id")), 1, show)
    return (
        manifest.where(F.col("size") < least).groupBy("book_id")
        .agg(
            F.count("*").alias("n_tiny"),
            F.concat(F.array_join(few, ", "), F.when(F.count("*") > show, "...").otherwise("")).alias("first_tiny")
        )
    )


def manifest_stats(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("book_id").agg(
        F.count("*").alias("n_chunks"), F.min("size").alias("min_size"), F.max("size").alias("max_size"),
        F.expr("sum(size) div count(*)").alias("mean_size")
    )


def inspect_manifest(manifest: DataFrame) -> DataFrame:
    """A readable table of each book's chunks: book_id, line_no, line. Line 0 is a header, the last one says how sizes range."""
    row = F.format_string(
        "%-12s %-6s %8s  %s", "chunk_id", F.col("section_level").cast("string"), F.col("size").cast("string"),
        "section_title"
    )
    n = F.row_number().over(Window.partitionBy("book_id").orderBy("chunk_no"))
    rows = manifest.select("book_id", n.cast("long").alias("line_no"), row.alias("line"))
    stats = manifest_stats(manifest)
    head = stats.select(
        "book_id", F.lit(0).cast("long").alias("line_no"),
        F.format_string(
            "%-12s %-6s %8s  %s", F.lit("chunk_id"), F.lit("level"), F.lit("size"), F.lit("section_title")
        ).alias("line")
    )
    range_ = F.format_string("%d chunks, size min %d, max %d, mean %d", "n_chunks", "min_size", "max_size", "mean_size")
    return head.unionByName(rows).unionByName(
        stats.select("book_id", (F.col("n_chunks") + 1).cast("long").alias("line_no"), range_.alias("line"))
    )


def neighbour_context(chunks: DataFrame, most: int = 300) -> DataFrame:
    """For each chunk the end of the chunk numbered one less and the start of the one numbered one more, cut at a paragraph where that keeps half."""
    w = Window.partitionBy("book_id").orderBy("chunk_no")
    prev = F.when(F.lag("chunk_no").over(w) == F.col("chunk_no") - 1, F.lag("text").over(w))
    nxt = F.when(F.lead("chunk_no").over(w) == F.col("chunk_no") + 1, F.lead("text").over(w))
    return chunks.select("book_id", "chunk_no", tail(prev, most).alias("prev_tail"), head(nxt, most).alias("next_head"))


def tail(text: Column, most: int) -> Column:
    """The last characters, from after the first blank line if that stands in the first half."""
    t = F.regexp_replace(F.substring(text, F.greatest(F.length(text) - most + 1, F.lit(1)), F.lit(most)), r"(?U)^\s+", "")
    at = F.locate("\n\n", t)
    cut = F.when((at > 0) & (at - 1 < F.floor(F.length(t) / 2)), F.substring(t, at + 2, F.length(t))).otherwise(t)
    return F.when(F.length(text) <= most, text).otherwise(cut)


def head(text: Column, most: int) -> Column:
    """The first characters, up to the last blank line if that stands in the second half."""
    t = F.regexp_replace(F.left(text, F.lit(most)), r"(?U)\s+$", "")
    back = F.locate("\n\n", F.reverse(t))
    at = F.length(t) - back - 1  # 0-based place of the last blank line
    cut = F.when((back > 0) & (at > F.floor(F.length(t) / 2)), F.left(t, at)).otherwise(t)
    return F.when(F.length(text) <= most, text).otherwise(cut)


def merge_chunks_text(chunks: DataFrame) -> DataFrame:
    """A book's chunks, stripped, without blank ones, joined by blank lines in order, without a table of contents."""
    bare = chunks.withColumn("text", strip(F.col("text"))).where("text != ''")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", "text"))), lambda x: x.text), "\n\n")
    merged = bare.groupBy("book_id").agg(joined.alias("text"), F.count("*").alias("n_chunks"))
    return merged.withColumn("text", strip_toc("text"))
