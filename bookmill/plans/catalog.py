"""All queries of the library by name, with SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import english_leaks
from . import dictionary, files, planted, structures, texts  # noqa: F401  they register their queries
from .registry import ORACLES, QUERIES, Tables
from .texts import manifest

__all__ = ["ORACLES", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By source: documents, characters, leaks of English prose, and chunks of about 1000 characters."""
    t = Tables(spark, sf_dir)
    docs = (
        t("documents").groupBy(F.col("source").alias("book_id"))
        .agg(
            F.count("*").alias("n_docs"), F.sum(F.length("text")).alias("n_chars"),
            F.sum(F.size(english_leaks(F.col("text")))).alias("n_leaks")
        )
    )
    return docs.join(
        manifest(t).groupBy("book_id")
        .agg(F.count("*").alias("n_chunks"), F.min_by("source", "chunk_no").alias("first_hash")),
        "book_id"
    )
