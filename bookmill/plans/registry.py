"""Queries by name with the SQL that gives the same rows, and the tables and fixtures that they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Integers as bigint, arrays as text: what any engine compares alike."""
    cols = []
    for f in df.schema:
        kind = f.dataType.simpleString()
        c = F.col(f"`{f.name}`")
        cols.append(
            (
                c.cast("bigint") if kind in ("int", "smallint", "tinyint") else F.array_join(
                    c.cast("array<string>"), " | "
                ) if kind.startswith("array") else c
            ).alias(f.name)
        )
    return df.select(*cols)


def query(oracle: str | None = None, name: str | None = None):
    """Register a function of the tables under its name; tables(name) reads a table or fixture."""

    def of(f):
        key = name or f.__name__
        QUERIES[key] = lambda spark, sf_dir: plain(f(Tables(spark, sf_dir)))
        if oracle is not None:
            ORACLES[key] = oracle
        return f

    return of


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text)

    def docs_as_chunks(self) -> DataFrame:
        """documents as chunks: a source is a book, doc_id the chunk's number."""
        return self("documents").select(F.col("source").alias("book_id"), F.col("doc_id").alias("chunk_no"), "text")

    def turns(self) -> DataFrame:
        """conversations as chunks: a conversation is a book, its turns the chunks."""
        return self("conversations").select(F.col("conv_id").alias("book_id"), F.col("turn").alias("chunk_no"), "role", "text")

    def pairs(self) -> DataFrame:
        """Each document as the output of the one before it in its source and its thousand of ids: a source may hold most of all rows."""
        from pyspark.sql import Window

        w = Window.partitionBy("source", F.floor(F.col("doc_id") / 1000)).orderBy("doc_id")
        before = F.lag("text").over(w).alias("src")
        rows = self("documents").select(
            F.col("source").alias("book_id"), F.col("doc_id").alias("chunk_no"), before, F.col("text").alias("out"),
            F.col("lang").alias("section_title")
        )
        return rows.where("src IS NOT NULL")

    def books(self) -> DataFrame:
        """A hundred ids of a source as a Markdown book: each document a chapter, its lines paragraphs."""
        part = F.concat(F.lit("# Chapter "), F.col("doc_id").cast("string"), F.lit("\n\n"), F.replace("text", F.lit("\n"), F.lit("\n\n")))
        whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", part.alias("t")))), lambda x: x.t), "\n\n")
        book = F.concat("source", F.lit("-"), F.floor(F.col("doc_id") / 100).cast("string"))
        return self("documents").groupBy(book.alias("book_id")).agg(whole.alias("text"))
