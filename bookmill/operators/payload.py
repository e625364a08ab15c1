"""What is handed to outside steps: task files, payloads, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import Payload
from .glossary import parse_metas
from .sections import neighbour_context


def size_switch(full: Column, short: Column, threshold: int) -> Column:
    """The full text below the threshold, else the short one."""
    return F.when(F.length(full) < threshold, full).otherwise(short)


def task_payload(chunks: DataFrame, tables: DataFrame, context_chars: int = 300) -> DataFrame:
    """A task text per chunk: terms, what stands before and after, and the chunk's name."""
    key = ["book_id", "chunk_no"]
    rows = chunks.select(*key).join(tables, key, "left").join(neighbour_context(chunks, context_chars), key, "left")
    part = lambda title, c, none: F.concat(
        F.lit(f"## {title}\n\n"), F.coalesce(F.nullif(c, F.lit("")), F.lit(none)), F.lit("\n\n")
    )
    text = F.concat(
        F.format_string("# chunk%04d\n\n", "chunk_no"), part("Terms", F.col("term_table"), "No terms."),
        part("Before", F.col("prev_tail"), "Nothing stands before."),
        part("After", F.col("next_head"), "Nothing follows."),
    )
    return rows.select(*key, text.alias("value"))


def chunk_range(chunks: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Chunks from start to end, both included; an open end is no limit."""
    low = F.lit(True) if start is None else F.col("chunk_no") >= start
    return chunks.where(low if end is None else low & (F.col("chunk_no") <= end))


def sort_chunks(chunks: DataFrame, numeric: bool = True) -> DataFrame:
    """Chunks in order of their books, then of their numbers, or of their ids as text."""
    name = F.format_string("chunk%04d", "chunk_no") if "chunk_id" not in chunks.columns else F.col("chunk_id")
    return chunks.orderBy("book_id", F.col("chunk_no") if numeric else name)


def snippets_limit(texts: DataFrame, limit: int = 20, chars: int = 200) -> DataFrame:
    """The starts of each book's first few chunks."""
    n = F.row_number().over(Window.partitionBy("book_id").orderBy("chunk_no"))
    return texts.withColumn("n", n).where(F.col("n") <= limit).select("book_id", "chunk_no", F.left("text", F.lit(chars)).alias("snippet"))


def glossary_sample(chunks: DataFrame) -> DataFrame:
    """First, last and three evenly spaced inner chunks of each book."""
    w = Window.partitionBy("book_id")
    ranked = chunks.withColumn("n", F.row_number().over(w.orderBy("chunk_no"))).withColumn("m", F.count("*").over(w))
    places = F.array(F.lit(1), F.col("m"), *(F.floor(F.lit(k) * (F.col("m") - 1) / 4).cast("int") + 1 for k in (1, 2, 3)))
    return ranked.where(F.array_contains(places, F.col("n"))).select("book_id", "chunk_no")


def _joined(rows: DataFrame, order: str, text: Column, name: str) -> DataFrame:
    items = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), text.alias("t")))), lambda x: x.t), ",")
    return rows.groupBy("book_id").agg(F.concat(F.lit("["), items, F.lit("]")).alias(name))


def pronoun_payload(terms: DataFrame, metas: DataFrame, outputs: DataFrame, p: Payload = Payload()) -> DataFrame:
    """Per book a JSON text of glossary, metas and starts of the outputs that have metas; long ones with fewer and shorter starts."""
    with_meta = outputs.join(metas.select("book_id", "chunk_no").distinct(), ["book_id", "chunk_no"], "left_semi")
    glossary = _joined(terms, "pos", F.to_json(F.struct("source", "target", "gender")), "glossary")
    found = _joined(metas, "chunk_no", F.coalesce("meta", F.lit("null")), "metas")
    long = _joined(with_meta, "chunk_no", F.to_json(F.struct("chunk_no", F.left("text", F.lit(p.snippet_chars)).alias("text"))), "long")
    short = _joined(
        snippets_limit(with_meta, p.snippet_limit, p.snippet_truncate), "chunk_no",
        F.to_json(F.struct("chunk_no", "snippet")), "short"
    )
    rows = glossary.join(found, "book_id", "left").join(long, "book_id", "left").join(short, "book_id", "left")
    whole = lambda s: F.concat(
        F.lit('{"glossary":'), "glossary", F.lit(',"metas":'), F.coalesce("metas", F.lit("[]")), F.lit(',"snippets":'),
        F.coalesce(s, F.lit("[]")), F.lit("}")
    )
    return rows.select("book_id", size_switch(whole(F.col("long")), whole(F.col("short")), p.pronoun_threshold).alias("payload"))


def _by_chunk(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Per book a JSON object of its chunks' JSON values, in order."""
    entry = F.concat(F.format_string('"chunk%04d":', "chunk_no"), value)
    items = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", entry.alias("t")))), lambda x: x.t), ",")
    return rows.groupBy("book_id").agg(F.concat(F.lit("{"), items, F.lit("}")).alias(name))


def issue_counts(issues: DataFrame) -> DataFrame:
    """Per chunk its issues by severity and by category: book_id, chunk_no, severity_counts, category_counts (JSON). Medium and other where none is given."""
    key = ["book_id", "chunk_no"]
    level, category = F.coalesce("severity", F.lit("medium")), F.coalesce("category", F.lit("other"))
    levels = issues.groupBy(*key).agg(
        F.to_json(
            F.struct(*(F.count_if(level == s).alias(s) for s in ("high", "medium", "low")))
        ).alias("severity_counts")
    )
    kinds = issues.groupBy(*key, category.alias("c")).agg(F.count("*").alias("n"))
    kinds = kinds.groupBy(*key).agg(
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("c", "n"))))).alias("category_counts")
    )
    return levels.join(kinds, key)


def post_mortem_payload(
    manifest: DataFrame, arcs: DataFrame, issues: DataFrame, p: Payload = Payload(), *, metas: DataFrame | None = None,
    sections: DataFrame | None = None, units: DataFrame | None = None
) -> DataFrame:
    """Per book a JSON text of chunks, arcs, issues, sections (book_id, chunk_no, section_title), units (book_id, units as JSON) and metas.

    Long ones hold counts for each chunk instead of its issues and its meta.
    """
    books = manifest.groupBy("book_id").agg(F.count("*").alias("n_chunks"))
    books = books.join(arcs.groupBy("book_id").agg(F.count("*").alias("n_arcs")), "book_id", "left")
    books = books.join(_joined(issues, "chunk_no", F.to_json(F.struct("chunk_no", "severity", "category")), "issues"), "book_id", "left")
    counts = F.concat(F.lit('{"severity_counts":'), "severity_counts", F.lit(',"category_counts":'), "category_counts", F.lit("}"))
    books = books.join(_by_chunk(issue_counts(issues), counts, "few_issues"), "book_id", "left")
    parts = [("issues", "issues", "few_issues", "[]")]
    if sections is not None:
        books = books.join(_by_chunk(sections, F.to_json(F.struct("section_title")), "sections"), "book_id", "left")
        parts.append(("sections", "sections", "sections", "{}"))
    if units is not None:
        books = books.join(units.select("book_id", "units"), "book_id", "left")
        parts.append(("units", "units", "units", "{}"))
    if metas is not None:
        parsed = parse_metas(metas).where(~F.array_contains("errors", "not_json"))
        fields = [c for c in meta_counts(parsed).columns if c not in ("book_id", "chunk_no")]
        books = books.join(_by_chunk(parsed, F.col("meta"), "metas"), "book_id", "left")
        books = books.join(_by_chunk(meta_counts(parsed), F.to_json(F.struct(*fields)), "few_metas"), "book_id", "left")
        parts.append(("metas", "metas", "few_metas", "{}"))
    head = [F.lit('{"chunks":'), F.col("n_chunks").cast("string"), F.lit(',"arcs":'), F.coalesce("n_arcs", F.lit(0)).cast("string")]
    body = lambda k: [x for part in parts for x in (F.lit(f',"{part[0]}":'), F.coalesce(part[k], F.lit(part[3])))]
    full, short = (F.concat(*head, *body(k), F.lit("}")) for k in (1, 2))
    return books.select("book_id", size_switch(full, short, p.aggregate_threshold).alias("payload"))


def meta_counts(metas: DataFrame) -> DataFrame:
    """Per chunk, how much its meta (parsed as m) holds, and whether the narrator is known."""
    size = lambda c: F.coalesce(F.size(F.col(f"m.{c}")), F.lit(0))
    return metas.select(
        "book_id", "chunk_no", size("new_entities").alias("n_entities"), size("alias_hypotheses").alias("n_aliases"),
        size("attribute_hypotheses").alias("n_attributes"), size("conflicts").alias("n_conflicts"),
        F.col("m.narrator_identification.name").isNotNull().alias("narrator_known"),
        F.col("m.narrator_identification.confidence").alias("narrator_confidence"),
    )


def last_notes(log: DataFrame, n: int = 5) -> DataFrame:
    w = Window.partitionBy("book_id").orderBy(F.desc("ts"), F.desc("seq"))
    return (
        log.where("note IS NOT NULL").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
        .select("book_id", "rank", "note")
    )
