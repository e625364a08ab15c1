"""Fingerprints, the n-gram Jaccard join and top-k search against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from bookmill.llm import _store, fingerprints, jaccard_join, topk

DOCS = "doc_id bigint, text string"


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(texts: dict) -> dict:
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_copies(seed: int, groups: int, size: int, words: int, edits: int) -> dict:
    rng = random.Random(seed)
    out = {}
    for g in range(groups):
        base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randrange(edits + 1)):
                own[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
            out[len(out) * 3 + 1] = " ".join(own)
    return out


def linked(spark, texts, **how):
    rows = spark.createDataFrame(list(texts.items()), DOCS).withColumn("component_id", F.lit("clash"))
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link(rows, **how).collect()}


def test_join_equals_brute_force_on_near_copies(spark):
    texts = near_copies(1, 4, 14, 90, 6) | {
        1000: None, 1001: "", 1002: " \n ", 1003: "a b", 1004: "A  b", 1005: "a b c", 1006: "x " * 3000, 1007: "x " * 9
    }
    assert linked(spark, texts) == components(texts)


def test_large_groups_are_dealt_as_pairs_of_chunks(spark):
    texts = near_copies(2, 1, 60, 70, 5)
    assert linked(spark, texts, group_rows=7) == components(texts)
    assert linked(spark, texts, group_rows=1, part_tokens=300, chunk_tokens=500) == components(texts)


def test_frequent_passages_don_t_hide_links(spark):
    rng = random.Random(5)
    passage = " ".join(f"p{k}" for k in range(60))
    texts = {k: passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.choice((4, 60)))) for k in range(60)}
    assert linked(spark, texts) == components(texts)
    assert linked(spark, texts, hot_least=20) == components(texts)  # the passage's tokens are frequent ones


def test_texts_of_frequent_tokens_only(spark):
    texts = near_copies(8, 2, 30, 60, 3) | {900 + k: "one common passage of all these texts " * (1 + k) for k in range(6)}
    for least in (3, 12, 1024):
        assert linked(spark, texts, hot_least=least, hot_times=0, group_rows=9) == components(texts)


def test_a_very_long_text(spark):
    rng = random.Random(9)
    words = [f"w{rng.randrange(10**9)}" for _ in range(60_000)]
    texts = {1: " ".join(words), 2: " ".join(words[:-3000]), 3: " ".join(words[: len(words) // 2]), 4: "y " * 200_000, 5: "short"}
    got = linked(spark, texts)
    assert {i: c for i, (_, c) in got.items()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5} and got[1][0] == 59_996 and got[4][0] == 1


def test_join_of_real_documents(spark, data):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    assert linked(spark, texts) == components(texts)


def test_join_of_repeated_rows_and_null_ids(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (9, "a b c d e f"), (None, "z")]
    got = sorted(((r.doc_id, r.component_id) for r in jaccard_join.link(spark.createDataFrame(rows, DOCS)).collect()), key=repr)
    assert got == sorted([(5, 5), (5, 5), (None, 5), (9, 5), (None, None)], key=repr)
    assert jaccard_join.link(spark.createDataFrame([], DOCS)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 80), st.sampled_from([50, 80, 90]))
def test_tree_finds_all_that_its_bound_allows(seed, m, percent):
    rng = np.random.default_rng(seed)
    vec = rng.poisson(rng.choice([0.2, 3.0]), (m, jaccard_join.GROUPS)).astype(np.uint8)
    vec[rng.integers(0, m, m // 2)] = vec[0]
    n, root, node = vec.sum(1, dtype=np.int64), rng.integers(0, 5, m), rng.permutation(m).astype(np.int64)
    probe = rng.random(m) < 0.5
    least = lambda a, b: (100 + percent) * int(np.minimum(vec[a], vec[b]).sum(dtype=np.int64)) >= percent * int(n[a] + n[b])
    fits = lambda a, b: root[a] != root[b] and percent * max(n[a], n[b]) <= 100 * min(n[a], n[b])
    brute = {
        (
            min(node[a], node[b]), max(node[a], node[b])
        ) for a in np.flatnonzero(probe) for b in np.flatnonzero(~probe) if fits(a, b) and least(a, b)
    }
    found = set(map(tuple, jaccard_join.tree_pairs(node, vec, n, root, probe, percent).tolist()))
    assert {(a, b) for a, b in found} == brute
    owns = [frozenset(rng.integers(0, 12, rng.integers(0, 4)).tolist()) for _ in range(m)]
    apart = {frozenset((int(node[a]), int(node[b]))) for a in range(len(n)) for b in range(len(n)) if owns[a].isdisjoint(owns[b])}
    fewer = set(map(tuple, jaccard_join.tree_pairs(node, vec, n, root, probe, percent, owns.__getitem__).tolist()))
    assert fewer == {p for p in brute if frozenset(map(int, p)) in apart}


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 60))
def test_a_group_is_resolved_as_by_brute_force(seed, m):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**48, 40)
    sets = [
        np.unique(
            np.concatenate(
                [base[rng.random(40) < rng.choice([0.85, 0.97])], rng.integers(0, 2**48, rng.integers(0, 3))]
            )
        ) for _ in range(m)
    ]
    n = np.array(list(map(len, sets)))
    want = list(range(m))
    for a in range(m):
        for b in range(a):
            if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b])):
                x, y = want[a], want[b]
                want = [min(x, y) if w in (x, y) else w for w in want]
    assert jaccard_join.resolve(n, np.concatenate(sets), np.append(0, np.cumsum(n)), 80).tolist() == want


def test_groups_come_whole_from_any_batches():
    import pyarrow as pa

    keys = [1, 1, 2, 2, 2, 3, 4, 4, 4, 4]
    t = pa.table({"k": keys, "v": range(10)})
    for cuts in ([0, 10], [0, 1, 2, 5, 10], [0, 4, 4, 6, 7, 8, 10]):
        batches = [b for i, j in zip(cuts, cuts[1:]) for b in t.slice(i, j - i).combine_chunks().to_batches()]
        assert [(g.column(0)[0].as_py(), g.num_rows) for g in jaccard_join._groups(iter(batches), 1)] == [(1, 2), (2, 3), (3, 1), (4, 4)]


def test_blocks_return_what_they_were_given():
    rng = np.random.default_rng(4)
    token, cls = np.sort(
        rng.integers(0, 2**48, 500, dtype=np.uint64)
    ), rng.integers(0, 2**64, 20, dtype=np.uint64)[rng.integers(0, 20, 500)]
    for got, want in zip(jaccard_join._postings(jaccard_join._postings_block(token, cls)), (token, cls), strict=True):
        assert (got == want).all()
    own = (np.unique(cls), np.arange(20), np.full(20, 25), token, token % np.uint64(15))
    for got, want in zip(jaccard_join._own(jaccard_join._own_block(*own)), own, strict=True):
        assert (got == want).all()


def test_levels_sent_to_all_are_bounded(spark):
    rows = spark.createDataFrame([(1, b"a b c d e f"), (2, b"a b c d e f g")], "doc_id bigint, t binary")
    sets, _, _ = jaccard_join._sets(rows, 5)
    levels = jaccard_join._levels(sets, 2)
    assert levels.nbytes <= 4 << 20 and sorted(levels[levels > 0].tolist()) == [1, 1]


def test_fingerprints_estimate_likeness(spark, data):
    rows = [
        (r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()
    ] + [(10_000, None), (10_001, ""), (10_002, "one two"), (10_003, "one two")]
    rows.sort()
    got = {
        r.doc_id: r for r in fingerprints.fingerprint_edits(
            spark.createDataFrame(rows, DOCS).withColumn("bins", F.lit("clash")).repartition(5)
        ).collect()
    }
    split = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", t.lower()) if w]
    sets = lambda t: {tuple(split(t)[i : i + 5]) for i in range(max(1, len(split(t)) - 4))} if split(t) else set()
    off = []
    for k, (i, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(t) // 4
        edited = t[: len(t) - cut] + after[:cut]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        for name, other in (("near_edited", edited), ("near_next", after)):
            a, b = sets(t), sets(other)
            off.append(got[i][name] - (len(a & b) / len(a | b) if a | b else 1.0))
    assert abs(np.mean(off)) < 0.01 and np.sqrt(np.mean(np.square(off))) < 0.04
    assert got[10_000].fingerprint == got[10_001].fingerprint == "" and got[10_002].fingerprint == got[10_003].fingerprint
    assert got[10_000].near_next == 1.0 and got[10_001].near_next == 0.0


def test_fingerprints_of_blocks_ties_and_few_rows(spark):
    rows = [(None, "null id"), (1, "b b"), (1, "a a"), (7, "c c c c"), (-5, "d d d d")]
    placed = fingerprints.with_next(spark.createDataFrame(rows, DOCS), F.coalesce(F.col("doc_id"), F.lit(-(2**63))), ["text"], rows=1)
    order = ["null id", "d d d d", "a a", "b b", "c c c c"]
    assert {r.text: r.next_text for r in placed.collect()} == dict(zip(order, order[1:] + order[:1], strict=True))
    assert fingerprints.fingerprint_edits(spark.createDataFrame([], DOCS)).count() == 0
    assert fingerprints.fingerprint_edits(spark.createDataFrame([(1, "x y z w v u")], DOCS)).count() == 1


def test_fingerprints_run_no_python(spark, data):
    plan = fingerprints.fingerprint_edits(spark.read.parquet(f"{data}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


VECS = "vec_id bigint, embedding array<double>"


def best(rows, k=5, every=50):
    own = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            own[i] = np.floor(np.array(v) * 256)
    out = set()
    for q, a in own.items():
        if q % every == 0:
            s = sorted((-int(sum(int(x) * int(y) for x, y in zip(a, b, strict=False))), i) for i, b in own.items() if i != q)[:k]
            out |= {(q, r + 1, i, -score) for r, (score, i) in enumerate(s)}
    return out


def found(spark, rows, **how):
    df = spark.createDataFrame(rows, VECS).withColumn("norm", F.lit("clash"))
    return {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.search(df, F.col("vec_id") % 50 == 0, **how).collect()}


@pytest.mark.parametrize("spread", [0.0, 1.5])
def test_search_equals_brute_force(spark, spread):
    rng = np.random.default_rng(7)
    rows = [(i, (rng.normal(size=12) * np.exp(rng.normal(0, spread))).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[50][1]) for i in range(150)]  # a hot vector
    assert found(spark, rows, bucket_rows=32, block_rows=4, seeds=16) == best(rows)


def test_search_of_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, []),
        (6, [1.0]), (7, [-1.0, -2.0, 5.0]), (None, [9.0, 9.0]), (8, [1e12, 1e12]), (50, [0.0, 0.0]), (9, [1.0, 2.0]),
        (9, [1.0, 2.0])
    ]
    assert found(spark, rows) == best(rows)
    assert found(spark, [(1, [1.0])]) == set() == found(spark, [(50, [1.0])])
    assert topk.search(spark.createDataFrame([], VECS), F.col("vec_id") % 50 == 0).count() == 0


def test_search_holds_queries_once_not_for_each_bucket(spark, monkeypatch):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(3000, 48))
    x /= np.linalg.norm(x, axis=1)[:, None]  # lengths and coordinates prune nothing: each query reaches each bucket
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], VECS)
    held, table = [], _store.table

    def measured(df, name, **how):
        out = table(df, name, **how)
        binary = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c, kind in out.dtypes if kind == "binary"]
        held.append((name, sum(out.agg(*binary).first()) if binary else 0))
        return out

    monkeypatch.setattr(_store, "table", measured)
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.search(df, F.col("vec_id") % 2 == 0, bucket_rows=16).collect()}
    assert held and all(size <= 2 * x.nbytes for _, size in held), held
    w = np.floor(256 * x).astype(np.int64)
    scores, out = w[::2] @ w.T, set()
    for r, q in enumerate(range(0, 3000, 2)):
        order = [j for j in np.lexsort((np.arange(3000), -scores[r]))[:6].tolist() if j != q][:5]
        out |= {(q, rank + 1, j, int(scores[r, j])) for rank, j in enumerate(order)}
    assert got == out


def test_search_of_ids_with_several_vectors(spark):
    rows = [(0, [4.0, 1.0])] + [(7, [9.0 + j, 1.0]) for j in range(8)] + [(i, [1.0, i / 64]) for i in range(8, 30)]
    own = {}
    for i, v in rows[1:]:
        own[i] = max(own.get(i, 0), int(np.floor(np.array(v) * 256) @ np.array([1024.0, 256.0])))
    want = sorted((-s, i) for i, s in own.items())[:5]
    assert found(spark, rows, bucket_rows=64) == {(0, r + 1, i, -s) for r, (s, i) in enumerate(want)}


@pytest.mark.parametrize("pays", [0, 1 << 20])
@pytest.mark.parametrize("most", [100, 10**5, 10**9])
def test_buckets_equal_brute_force_by_coordinates_or_products_in_any_arithmetic(pays, most):
    rng = np.random.default_rng(5)
    p = rng.integers(-most, most, size=(300, 6)) * rng.choice([0, 1], size=(300, 6), p=[0.6, 0.4])
    q = np.concatenate([p[:20] + rng.integers(-3, 3, size=(20, 6)), p[20:25] * 0])
    lengths = lambda m: np.sqrt((m.astype(float) ** 2).sum(1))
    p = p[np.argsort(-lengths(p), kind="stable")]
    ids, block = rng.permutation(300), topk.Block(np.arange(25), q, lengths(q), 5)
    for a in range(0, 300, 60):
        topk.Bucket(ids[a : a + 60], p[a : a + 60], lengths(p)[a : a + 60]).search(block, pays=pays)
    for r in range(25):
        s = sorted((-sum(int(x) * int(y) for x, y in zip(q[r], v, strict=True)), int(i)) for i, v in zip(ids, p, strict=True) if i != r)[:5]
        assert list(zip((-block.score[r]).tolist(), block.held[r].tolist(), strict=True)) == s
