"""Streams: metas that arrive as files, and sessions of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def stream_metas(spark: SparkSession, path: str) -> DataFrame:
    """Meta files of a folder as they arrive: book_id (the folder's name), chunk_no, meta."""
    files = (
        spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.meta.json").load(path)
    )
    at = F.col("_metadata.file_path")
    return files.select(
        F.regexp_extract(at, r"([^/]+)/[^/]+$", 1).alias("book_id"),
        F.regexp_extract(at, r"(\d+)\.meta\.json$", 1).cast("int").alias("chunk_no"), F.col("value").alias("meta")
    )


def ingest_available(metas: DataFrame, table: str, checkpoint: str) -> None:
    """Append what has arrived to a Parquet table, each file once, and stop."""
    metas.writeStream.format("parquet").option("path", table).option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).start().awaitTermination()


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of users by gaps between their events (batch or stream): user_id, start, end, n_events, value."""
    marked = events.withWatermark("ts", late) if events.isStreaming else events
    out = marked.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(
        F.count("*").alias("n_events"), F.sum("value").alias("value")
    )
    return out.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n_events", "value")
