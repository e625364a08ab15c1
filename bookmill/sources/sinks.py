"""Writes that appear whole or not at all."""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def write_snapshot(df: DataFrame, path: str) -> str:
    """Write a new version of a table beside the old ones and switch to it: readers of read_snapshot see all of it or none."""
    version = f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    return _switch(df.sparkSession, path, version)


def write_snapshots(tables: dict[str, DataFrame], path: str) -> str:
    """write_snapshot of several tables as one version."""
    version = f"v-{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.parquet(f"{path}/{version}/{name}")
    return _switch(df.sparkSession, path, version)


def _switch(spark, path: str, version: str) -> str:
    """Let CURRENT name the version: its file is written beside and renamed over the old one, so a reader always finds one.

    Local paths are renamed by the system; of others, the store must rename over a file at once, as HDFS does.
    """
    fs, base = _fs(spark, path)
    if fs.getUri().getScheme() == "file":
        write_file(f"{base(path).toUri().getPath()}/CURRENT", version.encode())
        return version
    tmp, pointer = base(f"{path}/.{version}"), base(f"{path}/CURRENT")
    out = fs.create(tmp, True)
    out.write(bytearray(version.encode()))
    out.close()
    jvm = spark._jvm
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(kind, 1)
    over[0] = kind.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(tmp), fs.makeQualified(pointer), over)
    return version


def read_snapshot(spark, path: str, *names: str):
    """The current version of a table, or of the named ones of write_snapshots."""
    version = spark.read.text(f"{path}/CURRENT").first()[0]
    found = [spark.read.parquet(f"{path}/{version}/{name}") for name in names]
    return found if names else spark.read.parquet(f"{path}/{version}")


def _fs(spark, path: str):
    jvm = spark._jvm
    make = jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


#: How often, and after how many seconds, a file that something holds is tried again.
RETRIES, PAUSE = 5, 0.2


def write_file(path: str, data: bytes) -> None:
    """Write a file whole under its name, in place of an older one: beside it first, then renamed. Plain paths, file: or any scheme of pyarrow.fs."""
    u = urlparse(path)
    if u.scheme in ("", "file"):
        at = unquote(u.path) if u.scheme else path
        os.makedirs(os.path.dirname(at) or ".", exist_ok=True)
        tmp = f"{at}.{uuid.uuid4().hex}.tmp"
        with open(tmp, "wb") as f:
            f.write(data)
        for k in range(RETRIES):
            try:
                return os.replace(tmp, at)
            except PermissionError:
                if k == RETRIES - 1:
                    os.remove(tmp)
                    raise
                time.sleep(PAUSE)
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path)
    tmp = f"{at}.{uuid.uuid4().hex}.tmp"
    store.create_dir(os.path.dirname(at), recursive=True)
    with store.open_output_stream(tmp) as f:
        f.write(data)
    store.move(tmp, at)


def sink_files(rows: DataFrame, folder: str) -> dict[str, int]:
    """One file for each row (name, value: text or bytes; null is empty), whole or not at all. How many files and bytes were written.

    A name is a relative path and stands once; a task that runs twice writes the same file again.
    """
    data = F.coalesce(
        F.col("value"), F.lit("")
    ).cast("binary") if dict(rows.dtypes)["value"] == "string" else F.coalesce("value", F.lit(b""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, values = b.column(0).to_pylist(), b.column(1).to_pylist()
            for name, value in zip(names, values, strict=True):
                if name.startswith("/") or ".." in name.split("/"):
                    raise ValueError(f"no name of a file in the folder: {name}")
                write_file(f"{folder.rstrip('/')}/{name}", value)
            yield pa.RecordBatch.from_pydict({"files": [len(names)], "bytes": [sum(map(len, values))]})

    done = rows.select("name", data.alias("value")).mapInArrow(run, "files bigint, bytes bigint")
    r = done.agg(F.coalesce(F.sum("files"), F.lit(0)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    return {"files": r["files"], "bytes": r["bytes"]}


def _in_book(name: Column, inner: str = "") -> Column:
    """A file's name in its book's folder."""
    return F.concat(F.col("book_id").cast("string"), F.lit(f"{inner}/"), name)


def sink_chunks(chunks: DataFrame, path: str) -> None:
    """Chunks with their texts, a folder for each book."""
    chunks.write.mode("overwrite").partitionBy("book_id").parquet(path)


def sink_chunk_files(manifest: DataFrame, folder: str, inner: str = "") -> dict[str, int]:
    """A file chunkNNNN.md for each chunk, then manifest.json of each book, which lists them (number_chunks has the columns). inner: folder in the book's."""
    texts = sink_files(
        manifest.select(
            _in_book(F.concat("chunk_id", F.lit(".md")), inner).alias("name"), F.col("text").alias("value")
        ),
        folder
    )
    entry = F.struct("chunk_id", "section_title", "section_level", "source", "size")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", entry.alias("e")))), lambda x: x.e)
    whole = manifest.groupBy("book_id").agg(F.to_json(F.struct(listed.alias("chunks"))).alias("value"))
    lists = sink_files(whole.select(_in_book(F.lit("manifest.json"), inner).alias("name"), "value"), folder)
    return {k: texts[k] + lists[k] for k in texts}


def sink_task_files(tasks: DataFrame, folder: str) -> dict[str, int]:
    """A file task_chunkNNNN.md for each task (payload.task_payload)."""
    return sink_files(tasks.select(_in_book(F.format_string("task_chunk%04d.md", "chunk_no")).alias("name"), "value"), folder)


def sink_books(built: DataFrame, folder: str, fb2: bool = True) -> dict[str, int]:
    """output.md, and book.fb2 unless not wanted, of each book (build.build_books)."""
    out = sink_files(built.select(_in_book(F.lit("output.md")).alias("name"), F.col("md").alias("value")), folder)
    if fb2:
        more = sink_files(
            built.where("fb2 IS NOT NULL").select(
                _in_book(F.lit("book.fb2")).alias("name"), F.col("fb2").alias("value")
            ),
            folder
        )
        out = {k: out[k] + more[k] for k in out}
    return out


def sink_texts(texts: DataFrame, path: str) -> None:
    """A `value` column as text files."""
    texts.select("value").write.mode("overwrite").text(path)


def _sanitized(rows: DataFrame) -> DataFrame:
    from ..functions.text import sanitize_surrogates

    text = [f.name for f in rows.schema if f.dataType.simpleString() == "string"]
    return rows.withColumns({c: sanitize_surrogates(F.col(c)) for c in text})


def sink_json(rows: DataFrame, path: str) -> str:
    """Rows as JSON lines, unpaired surrogates replaced: a new version, then CURRENT names it."""
    version = f"v-{uuid.uuid4().hex}"
    _sanitized(rows).write.json(f"{path}/{version}")
    return _switch(rows.sparkSession, path, version)


def sink_json_files(rows: DataFrame, name: Column, folder: str) -> dict[str, int]:
    """A JSON file for each row, unpaired surrogates replaced."""
    clean = _sanitized(rows)
    return sink_files(
        clean.select(name.alias("name"), F.to_json(F.struct(*(F.col(f"`{c}`") for c in clean.columns))).alias("value")),
        folder
    )


def write_glossary(terms: DataFrame, path: str) -> str:
    """A new glossary version; an empty one never replaces one that isn't."""
    from ..operators.glossary import ensure_term_ids
    from ..operators.state import guard_empty_overwrite

    spark = terms.sparkSession
    fs, make = _fs(spark, path)
    if fs.exists(make(f"{path}/CURRENT")):
        guard_empty_overwrite(terms, read_snapshot(spark, path))
    return write_snapshot(ensure_term_ids(terms), path)


def write_merge(terms: DataFrame, applied: DataFrame, path: str) -> str:
    """A merge's glossary and hashes (glossary.finish_merge) as one version; an empty glossary never replaces one that isn't."""
    from ..operators.glossary import ensure_term_ids
    from ..operators.state import guard_empty_overwrite

    spark = terms.sparkSession
    fs, make = _fs(spark, path)
    if fs.exists(make(f"{path}/CURRENT")):
        guard_empty_overwrite(terms, read_snapshot(spark, path, "terms")[0])
    return write_snapshots({"terms": ensure_term_ids(terms), "applied": applied}, path)


def write_plan(plan: DataFrame, consumed: DataFrame, path: str) -> str:
    """A merge's plan and the hashes of the metas that it is made of, for apply_merge_files."""
    return write_snapshots({"plan": plan, "consumed": consumed}, path)


def apply_merge_files(spark, plan_path: str, decisions_path: str, path: str) -> str:
    """Merge by a stored plan and a decisions file for each book (book_id.json, in a folder) into the stored glossary and hashes.

    Kinds come from the plan. Metas that changed since the plan stay unmerged, as their old hashes are recorded.
    """
    from ..operators.glossary import finish_merge, parse_decisions

    plan, consumed = read_snapshot(spark, plan_path, "plan", "consumed")
    terms, applied = read_snapshot(spark, path, "terms", "applied")
    files = spark.read.text(decisions_path, wholetext=True)
    book = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1)
    decisions = (
        parse_decisions(files.select(book.alias("book_id"), F.col("value").alias("text"))).drop("kind")
        .withColumn("kind", F.lit(None).cast("string"))
    )
    return write_merge(*finish_merge(plan, consumed, terms, applied, decisions), path)
