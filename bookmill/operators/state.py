"""Incremental work: what to do with each chunk, records of what was done, progress, guards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import phase_for_step, term_fingerprint
from .glossary import terms_in_chunk


def entity_hashes(terms: DataFrame) -> DataFrame:
    """(book_id, id, hash) of each term's deciding fields."""
    return terms.select(
        "book_id", "id",
        term_fingerprint(F.col("source"), F.col("target"), F.col("aliases"), F.col("gender")).alias("hash")
    )


def plan(
    manifest: DataFrame, sources: DataFrame, outputs: DataFrame, records: DataFrame, terms: DataFrame,
    retranslate_untracked: bool = False
) -> DataFrame:
    """Each chunk's category, the first that holds: failed, translation, record_only, unchanged; and whether its polish failed.

    records: book_id, chunk_no, entity_hashes (map of term id to hash), failed, polish_failed.
    """
    key = ["book_id", "chunk_no"]
    used = records.select(*key, F.explode("entity_hashes").alias("id", "was"))
    drifted = (
        used.join(entity_hashes(terms), ["book_id", "id"], "left").where("NOT (was <=> hash)").select(*key).distinct()
        .withColumn("drift", F.lit(True))
    )
    rows = (
        manifest.select(*key, "source").join(sources.select(*key, F.sha2("text", 256).alias("now")), key, "left")
        .join(outputs.select(*key, F.length("text").alias("out")), key, "left")
        .join(records.select(*key, "failed", "polish_failed", F.lit(True).alias("known")), key, "left")
        .join(drifted, key, "left")
    )
    stale = F.col("now").isNull() | (F.col("now") != F.col("source")) | (F.coalesce("out", F.lit(0)) == 0)
    category = (
        F.when(F.coalesce("failed", F.lit(False)) & F.lit(not retranslate_untracked), "failed")
        .when(stale, "translation")
        .when(F.col("known").isNull(), "translation" if retranslate_untracked else "record_only")
        .when(F.col("drift"), "translation").otherwise("unchanged")
    )
    return rows.select(*key, category.alias("category"), F.coalesce("polish_failed", F.lit(False)).alias("polish_failed"))


def plan_summary(planned: DataFrame) -> DataFrame:
    return planned.groupBy("book_id", "category").agg(F.count("*").alias("n"))


def record(records: DataFrame, chunks: DataFrame, outputs: DataFrame, terms: DataFrame, version: int) -> DataFrame:
    """Records after the given chunks: new ones replace old ones; hashes of the terms that occur, or of all terms where a chunk has no text."""
    key = ["book_id", "chunk_no"]
    found = terms_in_chunk(terms, chunks).join(terms.select("book_id", "pos", "id"), ["book_id", "pos"]).select(*key, "id")
    unknown = chunks.where("text IS NULL").select(*key).join(terms.select("book_id", "id"), "book_id").select(*key, "id")
    ids = found.unionByName(unknown).join(entity_hashes(terms), ["book_id", "id"])
    used = ids.groupBy(*key).agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("id", "hash")))).alias("entity_hashes"))
    fresh = (
        chunks.select(*key).join(used, key, "left")
        .join(outputs.select(*key, F.length("text").cast("bigint").alias("output_size")), key, "left")
        .select(
            *key, F.lit(version).alias("glossary_version"),
            F.coalesce("entity_hashes", F.expr("cast(map() as map<string,string>)")).alias("entity_hashes"),
            F.col("output_size").isNotNull().alias("output_exists"),
            F.coalesce("output_size", F.lit(0)).cast("bigint").alias("output_size"), F.lit(False).alias("failed"),
            F.lit("").alias("failure_reason"), F.lit(False).alias("polish_failed"),
            F.lit("").alias("polish_failure_reason"),
        )
    )
    return upsert(records, fresh, key)


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of `new`, and those of `old` whose key isn't in it."""
    return old.join(new.select(*key), key, "left_anti").unionByName(new)


def mark_failed(records: DataFrame, failures: DataFrame, polish: bool = False) -> DataFrame:
    """Records with failure flag and reason set for (book_id, chunk_no, reason)."""
    flag, why = ("polish_failed", "polish_failure_reason") if polish else ("failed", "failure_reason")
    joined = records.join(failures.select("book_id", "chunk_no", "reason"), ["book_id", "chunk_no"], "left")
    return joined.withColumns({flag: F.col(flag) | F.col("reason").isNotNull(), why: F.coalesce("reason", why)}).drop("reason")


#: One option of a save: op is set, set_int or append.
OPTIONS = "array<struct<op:string,key:string,value:string>>"


def state_save(log: DataFrame, saves: DataFrame) -> DataFrame:
    """The log of events with further saves (book_id, ts, step, note, options) after each book's last event; see state_load and state_values.

    Steps beyond 1 to 10 raise.
    """
    steps = F.when(F.col("step").between(1, 10), F.col("step")).otherwise(
        F.raise_error(F.concat(F.lit("no such step: "), F.col("step").cast("string"))).cast("int")
    )
    last = log.groupBy("book_id").agg(F.max("seq").alias("last"))
    order = F.row_number().over(Window.partitionBy("book_id").orderBy("ts", "step", "note"))
    fresh = saves.withColumn("k", order).join(last, "book_id", "left").withColumn("seq", F.coalesce("last", F.lit(0)) + F.col("k"))
    return log.unionByName(
        fresh.select(
            "book_id", "ts", F.col("seq").cast(log.schema["seq"].dataType).alias("seq"),
            steps.cast(log.schema["step"].dataType).alias("step"), "note", "options"
        )
    )


def state_values(log: DataFrame) -> DataFrame:
    """What the options of a book's events leave under each key: book_id, key, kind (text, int or list), value (a list's joined by commas).

    The last set wins; what is appended after it makes a list of different values, in order. A set_int of no integer is passed over.
    """
    given = log.select("book_id", "ts", "seq", F.posexplode("options").alias("k", "o")).select(
        "book_id", F.struct("ts", "seq", "k").alias("at"), "o.op", "o.key", "o.value"
    )
    sound = given.where("op IN ('set', 'append') OR (op = 'set_int' AND trim(value) RLIKE '^[+-]?[0-9]+$')")
    is_set = F.col("op") != "append"
    since = sound.groupBy("book_id", "key").agg(F.max(F.when(is_set, F.struct("at", "op", "value"))).alias("s"))
    later = (
        sound.where(~is_set).join(since, ["book_id", "key"]).where("s IS NULL OR at > s.at")
        .groupBy("book_id", "key", "value").agg(F.min("at").alias("at"))
    )
    lists = later.groupBy("book_id", "key").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x.value), ","
        ).alias("list")
    )
    kind = F.when(F.col("list").isNotNull(), "list").when(F.col("s.op") == "set_int", "int").otherwise("text")
    single = F.when(F.col("s.op") == "set_int", F.trim("s.value").cast("bigint").cast("string")).otherwise(F.col("s.value"))
    return since.join(lists, ["book_id", "key"], "left").select(
        "book_id", "key", kind.alias("kind"), F.coalesce("list", single).alias("value")
    )


def state_load(log: DataFrame, steps: int = 10) -> DataFrame:
    """The progress of each book from its events (book_id, ts, seq, step, note): steps done, the step to do and its phase, the last five notes."""
    w = Window.partitionBy("book_id").orderBy(F.desc("ts"), F.desc("seq"))
    noted = log.withColumn("recent", F.when(F.col("note").isNotNull(), F.count("note").over(w)))
    notes = F.transform(
        F.array_sort(F.collect_list(F.when(F.col("recent") <= 5, F.struct(F.col("ts"), F.col("seq"), F.col("note"))))),
        lambda x: x.note
    )
    done = noted.groupBy("book_id").agg(
        F.array_sort(F.collect_set("step")).alias("completed"), F.max_by("step", F.struct("ts", "seq")).alias("last"),
        notes.alias("notes")
    )
    now = F.least(F.coalesce(F.col("last") + 1, F.lit(1)), F.lit(steps))
    return done.select(
        "book_id", F.array_join("completed", ",").alias("completed_steps"), now.alias("current_step"),
        phase_for_step(now).alias("phase"), F.array_join("notes", " | ").alias("last_notes")
    )


def fingerprint_gate(sources: DataFrame, previous: DataFrame, outputs: DataFrame) -> DataFrame:
    """Per source (book_id, content) whether work may start over: the source changed, outputs exist, or ok."""
    now = sources.select("book_id", F.sha2("content", 256).alias("now")).join(
        previous.select("book_id", "source_sha256"), "book_id", "left"
    )
    had = outputs.select("book_id").distinct().withColumn("has", F.lit(True))
    gate = (
        F.when(F.col("source_sha256").isNotNull() & (F.col("source_sha256") != F.col("now")), "source_changed")
        .when(F.col("has"), "outputs_exist").otherwise("ok")
    )
    return now.join(had, "book_id", "left").select("book_id", gate.alias("gate"))


def guard_empty_overwrite(new: DataFrame, stored: DataFrame) -> None:
    """Raise where an empty table would replace one that isn't."""
    if new.isEmpty() and not stored.isEmpty():
        raise ValueError("refusing to replace a non-empty glossary by an empty one")
