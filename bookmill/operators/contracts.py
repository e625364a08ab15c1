"""Contracts between source and derived texts, and what reports count of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import Polish, Quality
from ..functions.text import FRONT, count_headings, count_paragraphs, english_leaks, ratio, strip


def verify_batch(chunks: DataFrame, outputs: DataFrame, metas: DataFrame, q: Quality = Quality()) -> DataFrame:
    """Each chunk's output: missing, short, bad_ratio or ok, and whether its meta is missing. Lengths are raw."""
    key = ["book_id", "chunk_no"]
    joined = (
        chunks.select(*key, F.length("text").alias("src"))
        .join(outputs.select(*key, F.length("text").alias("out")), key, "left")
        .join(metas.select(*key).distinct().withColumn("has_meta", F.lit(True)), key, "left")
    )
    r = ratio(F.col("out"), F.nullif(F.col("src"), F.lit(0)))
    state = (
        F.when(F.col("out").isNull(), "missing").when(F.col("out") < q.min_output_chars, "short")
        .when(~r.between(q.ratio_min, q.ratio_max), "bad_ratio").otherwise("ok")
    )
    return joined.select(*key, state.alias("status"), (F.col("out").isNotNull() & F.col("has_meta").isNull()).alias("missing_meta"))


def validate_manifest(
    manifest: DataFrame, sources: DataFrame, outputs: DataFrame, q: Quality = Quality(), strict: bool = False
) -> DataFrame:
    """One finding per chunk: a structural error; or, in books without any, warnings of content (errors if strict). Lengths are stripped."""
    key = ["book_id", "chunk_no"]
    joined = (
        manifest.select(*key, "source").join(sources.select(*key, F.col("text").alias("src")), key, "left")
        .join(outputs.select(*key, F.col("text").alias("out")), key, "left")
    )
    out = strip(F.col("out"))
    hard = (
        F.when(F.col("src").isNull(), "missing_source").when(F.col("out").isNull(), "missing_output")
        .when(out == "", "empty_output").when(F.sha2("src", 256) != F.col("source"), "hash_mismatch")
    )
    r = ratio(F.length(out), F.nullif(F.length(strip(F.col("src"))), F.lit(0)))
    soft = (
        F.when(r < q.ratio_min, "ratio_low").when(r > q.ratio_max, "ratio_high")
        .when(F.size(english_leaks(F.col("out"), q.en_leak_chars)) > 0, "english_leak")
    )
    any_hard = F.max(hard.isNotNull()).over(Window.partitionBy("book_id"))
    found = joined.withColumn("hard", hard).withColumn("soft", F.when(~any_hard, soft))
    severity = F.when(F.col("hard").isNotNull() | F.lit(strict), "error").otherwise("warning")
    return (
        found.withColumn("finding", F.coalesce("hard", "soft")).where("finding IS NOT NULL")
        .select(*key, severity.alias("severity"), "finding")
    )


def chunk_ratio(pairs: DataFrame, q: Quality = Quality()) -> DataFrame:
    """Per chunk (book_id, chunk_no, src, out): ratio of stripped lengths, its mark, number of leaks and the first 60 characters of one."""
    r = ratio(F.length(strip(F.col("out"))), F.nullif(F.length(strip(F.col("src"))), F.lit(0)))
    leaks = english_leaks(F.col("out"), q.en_leak_chars)
    return (
        pairs.withColumn("ratio", F.coalesce(r, F.lit(0.0))).withColumn("leaks", leaks)
        .select(
            "book_id", "chunk_no", F.round("ratio", 6).alias("ratio"),
            F.when(F.col("ratio") < q.ratio_min, "LOW").when(F.col("ratio") > q.ratio_max, "HIGH").otherwise("OK")
            .alias("mark"),
            F.size("leaks").alias("n_leaks"), F.left(F.get("leaks", F.lit(0)), F.lit(60)).alias("leak"),
        )
    )


def section_ratio(pairs: DataFrame, q: Quality = Quality()) -> DataFrame:
    """Per section (book_id, section_title, src, out): summed lengths and their ratio, where outside the limits. Front matter and sections without output don't count."""
    had = pairs.where((F.col("section_title") != FRONT) & F.col("out").isNotNull() & (F.length("src") > 0))
    sums = had.groupBy("book_id", "section_title").agg(
        F.sum(F.length("src")).alias("src_chars"), F.sum(F.length(strip(F.col("out")))).alias("out_chars")
    )
    r = ratio(F.col("out_chars"), F.col("src_chars"))
    marked = sums.where("out_chars > 0").withColumn("mark", F.when(r < q.ratio_min, "LOW").when(r > q.ratio_max, "HIGH"))
    return marked.where("mark IS NOT NULL").withColumn("ratio", F.round(r, 6))


def median_ratio(pairs: DataFrame) -> DataFrame:
    """Per book the median of output to backup lengths, exact: different ratios of one book are counted in one task."""
    r = ratio(F.length("out"), F.nullif(F.length("src"), F.lit(0)))
    return pairs.groupBy("book_id").agg(F.round(F.median(r), 6).alias("median_ratio"))


def _polish_faults(p: Polish) -> list[Column]:
    """Reasons against a polished text `out` of an original `src`."""
    r = ratio(F.length("out"), F.length("src"))
    paras = [count_paragraphs(F.col(c)) for c in ("src", "out")]
    heads = [count_headings(F.col(c)) for c in ("src", "out")]
    allowed = F.greatest(F.lit(2.0), F.bround(paras[0].cast("double") * F.lit(p.max_para_delta_ratio), 0))
    return [
        F.when(~r.between(p.ratio_min, p.ratio_max), "ratio"),
        F.when(F.abs(paras[1] - paras[0]) > allowed, "paragraphs"),
        F.when(F.abs(heads[1] - heads[0]) > p.max_heading_delta, "headings"),
    ]


def _empty(p: Polish) -> Column:
    return F.when(
        strip(F.coalesce("out", F.lit(""))) == "", "polished_empty"
    ).when(strip(F.coalesce("src", F.lit(""))) == "", "original_empty")


def polish_contract(pairs: DataFrame, p: Polish = Polish()) -> DataFrame:
    """Per chunk, the reasons against its polished text, joined by `; ` (empty: none)."""
    empty = _empty(p)
    reasons = F.coalesce(empty, F.array_join(F.array_compact(F.array(*_polish_faults(p))), "; "))
    return pairs.select("book_id", "chunk_no", reasons.alias("reasons"))


def apply_polish(pairs: DataFrame, p: Polish = Polish()) -> DataFrame:
    """Versions after polishing: where the contract holds, backup and output change places with the polish; else all stay."""
    judged = pairs.join(polish_contract(pairs, p), ["book_id", "chunk_no"])
    ok = F.col("reasons") == ""
    versions = F.when(ok, F.array(F.struct(F.lit("bak").alias("stage"), F.col("src").alias("text")), F.struct(F.lit("draft").alias("stage"), F.col("out").alias("text")))).otherwise(
        F.array(F.struct(F.lit("draft").alias("stage"), F.col("src").alias("text")), F.struct(F.lit("polished").alias("stage"), F.col("out").alias("text")))
    )
    return judged.select("book_id", "chunk_no", F.explode(versions).alias("v")).select("book_id", "chunk_no", "v.stage", "v.text")


def verify_polish(pairs: DataFrame, p: Polish = Polish()) -> DataFrame:
    """Faults of applied polishes: no backup, contract reasons, or a ratio off the book's median by more than the tolerance."""
    r = ratio(F.length("out"), F.nullif(F.length("src"), F.lit(0)))
    rated = pairs.withColumn("r", r).withColumn("m", F.median("r").over(Window.partitionBy("book_id")))
    off = F.when(F.abs(F.col("r") - F.col("m")) > F.col("m") * p.median_tolerance, "median")
    reasons = F.when(F.col("src").isNull(), "missing_bak").otherwise(
        F.coalesce(_empty(p), F.array_join(F.array_compact(F.array(*_polish_faults(p), off)), "; "))
    )
    return rated.select("book_id", "chunk_no", reasons.alias("reasons"))


def issue_rollup(issues: DataFrame, show: int = 10, lanes: int = 64) -> DataFrame:
    """Per check: how many issues, the first few by document and line, and how many more.

    A check may have most of all issues, so the first few are found in lanes by document and then among those.
    """
    place, lane = ("doc_id", "line", "message"), F.pmod(F.xxhash64("doc_id"), F.lit(lanes))
    first = issues.select("check_name", *place, lane.alias("lane"))
    for by in (("check_name", "lane"), ("check_name",)):
        first = first.withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy(*place))).where(F.col("n") <= show)
    messages = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "message"))), lambda x: x.message), "; ")
    shown = first.groupBy("check_name").agg(messages.alias("first_messages"))
    counts = issues.groupBy("check_name").agg(F.count("*").alias("n_issues"))
    more = F.greatest(F.col("n_issues") - show, F.lit(0)).alias("n_more")
    return counts.join(shown, "check_name").select("check_name", "n_issues", "first_messages", more)


def qa_severity_counts(issues: DataFrame) -> DataFrame:
    """Per chunk: issues by severity, medium where none is given."""
    s = F.coalesce("severity", F.lit("medium"))
    return issues.groupBy("book_id", "chunk_no").agg(*(F.count_if(s == k).alias(k) for k in ("high", "medium", "low")))


def qa_retranslate(counts: DataFrame) -> DataFrame:
    """Chunks to translate anew: any high issue, or more than two medium ones."""
    return counts.where("high > 0 OR medium > 2").select("book_id", "chunk_no")


def sanity_rollup(rows: DataFrame) -> DataFrame:
    """Per book: how many chunks are low, high, or leak."""
    return rows.groupBy("book_id").agg(
        F.count_if(F.col("mark") == "LOW").alias("n_low"), F.count_if(F.col("mark") == "HIGH").alias("n_high"),
        F.count_if(F.col("n_leaks") > 0).alias("n_leaking")
    )
