"""Consumed metas are recorded with the merge, in one snapshot with its terms."""

import json

import pytest
from pyspark.sql import functions as F

from bookmill.operators import glossary as G
from bookmill.plans.dictionary import _merging
from bookmill.plans.registry import Tables
from bookmill.sources import sinks


def test_a_merged_round_is_not_proposed_again(spark, data, tmp_path):
    metas, terms, applied = _merging(Tables(spark, data))
    plan = G.prepare_merge(metas, terms, applied)
    skip = plan.where("outcome = 'decision'").select("book_id", "id", F.lit("skip").alias("choice"), "kind")
    sinks.write_merge(*G.finish_merge(plan, G.consumed_metas(metas, applied), terms, applied, skip), str(tmp_path / "g"))
    terms, applied = sinks.read_snapshot(spark, str(tmp_path / "g"), "terms", "applied")
    assert sorted(r.chunk_no for r in applied.collect()) == [1, 2, 3, 6, 8]
    assert G.prepare_merge(metas, terms, applied).isEmpty() and G.consumed_metas(metas, applied).isEmpty()
    changed = metas.where("chunk_no = 2").withColumn("meta", F.lit("{}"))  # changes nothing, yet is consumed; its hash replaces the old one
    _, later = G.finish_merge(G.prepare_merge(changed, terms, applied), G.consumed_metas(changed, applied), terms, applied, skip.limit(0))
    assert later.count() == 5 and G.consumed_metas(changed, later).isEmpty()


def test_merging_by_files(spark, data, tmp_path):
    metas, terms, applied = _merging(Tables(spark, data))
    at, plan_at, files = str(tmp_path / "g"), str(tmp_path / "p"), tmp_path / "d"
    sinks.write_merge(terms, applied, at)
    plan = G.prepare_merge(metas, terms, applied)
    sinks.write_plan(plan, G.consumed_metas(metas, applied), plan_at)
    files.mkdir()
    ids = {r.kind: r.id for r in plan.where("outcome = 'decision'").collect()}
    (files / "b.json").write_text(json.dumps([{"id": ids["attribute_conflict"], "choice": "neither"}]))
    with pytest.raises(ValueError):
        sinks.apply_merge_files(spark, plan_at, str(files), at)
    assert sinks.read_snapshot(spark, at, "applied")[0].count() == 1
    (files / "b.json").write_text(json.dumps({"decisions": [{"id": ids["attribute_conflict"], "choice": "accept"}]}))
    sinks.apply_merge_files(spark, plan_at, str(files), at)
    terms, applied = sinks.read_snapshot(spark, at, "terms", "applied")
    assert {r.source: r.gender for r in terms.collect()}["Bob"] == "female"
    assert applied.count() == 5
