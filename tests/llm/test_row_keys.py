"""near_duplicates keeps one row per group, whatever ids its rows share."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as P
from bookmill.llm import _marks

WORDS = "one two three four five six seven eight nine ten eleven twelve thirteen"
OTHER = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"
THIRD = "red orange yellow green blue indigo violet black white grey brown pink gold"


def test_shared_and_null_ids(spark, data):
    rows = [
        (1, WORDS), (5, WORDS.upper()), (5, OTHER),  # the clean text of id 5 stays
        (7, THIRD), (7, THIRD.upper()),  # near copies under one id
        (None, "some text under no id that has a near copy"), (None, "SOME text under no id that has a near copy"), (9, ""), (9, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [(r.doc_id, (r.text or "").lower()) for r in P.one_of_each_group(spark, docs, data).collect()]
    assert sorted(got, key=repr) == sorted(
        [(1, WORDS), (5, OTHER), (7, THIRD), (None, "some text under no id that has a near copy"), (9, "")], key=repr
    )


def test_marks_hold_all_their_hashes_and_few_others(spark):
    rng = np.random.default_rng(1)
    held = rng.integers(-(2**63), 2**63, 20_000)
    rows = spark.createDataFrame([(int(h),) for h in held], "h bigint")
    sent = _marks.marks(rows)
    assert sent.value.nbytes == 4 << 20
    assert rows.where(~_marks.marked(sent, F.col("h"))).count() == 0
    other = spark.createDataFrame([(int(h),) for h in rng.integers(-(2**63), 2**63, 20_000)], "h bigint")
    assert other.where(_marks.marked(sent, F.col("h"))).count() < 100
    assert other.where(_marks.marked(_marks.marks(rows.limit(0)), F.col("h"))).count() == 0
