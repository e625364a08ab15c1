"""The document pipeline: language ID, quality classifier, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from bookmill.llm import _store, jaccard_join, language_id, packing, quality
from bookmill.llm._marks import marked, marks
from bookmill.llm.lm_scoring import remainder
from bookmill.llm.queries import WORD_BPE, _read


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str, *, least_share: float = 0.4) -> DataFrame:
    """Drop texts without letters, and those of which no language makes up `least_share`."""
    model = language_id.train(docs.where(~remainder("doc_id", 4, 2)))
    found = language_id.predict(docs, model, keep=docs.columns, language="__language", score="__share")
    return found.where((F.col("__language") != language_id.UNDETERMINED) & (F.col("__share") >= least_share)).select(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str, *, threshold: float = 0.3) -> DataFrame:
    """Drop texts that the co-trained classifier gives less than `threshold`."""
    model = quality.train(docs, _read(spark, sf_dir, "labels"))
    return quality.score(docs, model, keep=docs.columns, into="__score").where(F.col("__score") >= threshold).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, keep one row, of the least id (null last).

    Rows are told apart by id and text; of rows that repeat these, the one whose other columns are least as JSON stays.
    Ids and hashes decide; only texts that may go, or be repeated, are dealt out (see bookmill.llm._marks).
    """
    keyed = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    linked = _store.table(
        jaccard_join.link(keyed, doc_id="__row").groupBy(F.col("doc_id").alias("__row"))
        .agg(F.min("component_id").alias("component_id"), F.count("*").alias("times")),
        "linked"
    )
    many = linked.groupBy("component_id").agg(F.min("__row").alias("a"), F.max("__row").alias("b")).where("a < b").select("component_id")
    ranks = keyed.select("__row", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row").alias("rank")).distinct()
    grouped = _store.table(linked.join(many, "component_id").join(ranks, "__row"), "grouped")
    first = grouped.groupBy("component_id").agg(F.min("rank").alias("first"))
    others = _store.table(grouped.join(first, "component_id").where("__row != first.__row").select("__row"), "others")
    sent = marks(others.unionByName(linked.where("times > 1").select("__row")))
    keyed = keyed.withColumn("__may", marked(sent, F.col("__row")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rest = F.to_json(F.struct(*(c.cast("string") for c in columns)))
    asked = keyed.where("__may").join(others, "__row", "left_anti")
    one = asked.groupBy("__row").agg(F.min_by(F.struct(*columns), rest).alias("__one"))
    return keyed.where("NOT __may").select(*columns).unionByName(one.select("__one.*"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens, packed into sequences."""
    return packing.pack(docs, WORD_BPE)


STAGES = [("language_id", known_language), ("quality", good_quality), ("near_duplicates", one_of_each_group), ("packing", packed)]
#: Learned models and packing are not expressible in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table. What a stage keeps is written once; the stage before it is then dropped."""
    docs, before = _read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = _store.table(stage(spark, docs, sf_dir), name)
        if before is not None:
            _store.drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
