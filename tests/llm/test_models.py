"""Language-model scoring, language ID and the quality classifier."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from bookmill.llm import language_id, lm_scoring, quality
from bookmill.llm._hashing import shingle_hashes, word_hashes

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_words_are_what_split_gives():
    texts = [b"", b" a  B\tc\x0b\nA", "É é x   y".encode(), b"one"]
    h, n = word_hashes(texts)
    words = [w for t in texts for w in t.lower().split()]
    assert n.tolist() == [len(t.lower().split()) for t in texts]
    assert len(set(zip(words, h.tolist(), strict=True))) == len(set(words)) == len(set(h.tolist()))


def test_shingles_are_equal_where_their_words_are():
    texts = [b"a b c d e f", b"b c d e f", b"a b c d", b"a b c d x", b"", b"f e d c b"]
    words, n = word_hashes(texts)
    h, m = shingle_hashes(words, n, 5)
    own = [tuple(t.split()[i : i + 5]) for t in texts for i in range(max(1, len(t.split()) - 4)) if t]
    assert m.tolist() == [2, 1, 1, 1, 0, 1]
    assert len(set(zip(own, h.tolist(), strict=True))) == len(set(own)) == len(set(h.tolist()))


def kneser_ney(train: list[list[str]]):
    """The model by its textbook formulas over dictionaries."""
    pairs = Counter(p for ws in train for p in zip(["<s>", *ws], [*ws, "</s>"], strict=True))
    tokens = Counter(w for ws in train for w in [*ws, "</s>"])
    before, after = defaultdict(set), defaultdict(list)
    for (a, b), c in pairs.items():
        before[b].add(a)
        after[a].append(c)
    of = lambda counts: lm_scoring.discounts(*(sum(c == k for c in counts) for k in (1, 2, 3, 4)))
    d2, d1 = of(pairs.values()), of([len(x) for x in before.values()])
    types, v = len(pairs), len(tokens)
    cut = lambda c, d: max(c - ((0,) + d)[min(c, 3)], 0)
    left = sum(d1[min(len(x), 3) - 1] for x in before.values()) / types

    def p1(w: str) -> float:
        return cut(len(before.get(w, ())), d1) / types + left / (v + 1)

    def p2(a: str, b: str) -> float:
        if a not in after:
            return p1(b)
        total = sum(after[a])
        return cut(pairs.get((a, b), 0), d2) / total + sum(d2[min(c, 3) - 1] for c in after[a]) / total * p1(b)

    return tokens, p2


def test_scores_equal_the_formulas(spark, data):
    rows = [
        (r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    ] + [(None, "a b a b"), (7001, None), (7002, ""), (7003, "Unseen words  HERE"), (7003, "Unseen words  HERE")]
    out = {}
    for r in lm_scoring.score_held_out(
        spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("score", F.lit("clash")).repartition(3)
    ).collect():
        out.setdefault(r.doc_id, r)
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 if i is not None else False for i, _ in rows}
    split = lambda t: [w.decode() for w in (t or "").encode().lower().split()]
    tokens, p2 = kneser_ney([split(t) for i, t in rows if not held[i]])
    n, v = sum(tokens.values()), len(tokens)
    for i, t in rows:
        ws = [*split(t), "</s>"]
        r = out[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws), sum(w in tokens for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((tokens.get(w, 0) + 1) / (n + v + 1)) for w in ws))
        assert r.score == pytest.approx(sum(math.log10(p2(a, b)) for a, b in zip(["<s>", *ws[:-1]], ws, strict=True)), rel=1e-9)


def test_probabilities_sum_to_one():
    train = [["a", "b", "a", "b", "c"], ["b", "c"], ["a", "c", "c"], ["d"]]
    tokens, p2 = kneser_ney(train)
    for context in ["<s>", "a", "d", "zz"]:
        assert sum(p2(context, w) for w in [*tokens, "<unk>"]) == pytest.approx(1.0)


def test_scoring_without_documents(spark):
    assert lm_scoring.score_held_out(spark.createDataFrame([], DOCS)).count() == 0
    row = lm_scoring.score_held_out(spark.createDataFrame([(1, "x y")], "doc_id bigint, text string").where("doc_id = 1")).first()
    assert row.n_tokens == 3


def test_language_of_held_out_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = language_id.identify(docs).join(docs, "doc_id").where("held_out")
    assert got.where("lang_pred = lang").count() / got.count() >= 0.95
    assert got.where("score < 0 OR score > 1").count() == 0


def test_language_of_odd_rows(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    odd = spark.createDataFrame(
        [
            (9001, None, "en", "s", None), (9002, "", None, None, 0), (9003, "12 !?", "fr", "s", 4),
            (9004, "a" * 300_000, None, "s", 1), (None, "the and of the", None, "s", 1), (9005, "x", None, "s", 1),
            (9005, "x", None, "s", 1)
        ],
        DOCS
    )
    got = {
        r.doc_id: r for r in language_id.identify(
            docs.unionByName(odd).withColumn("lang_pred", F.lit("clash"))
        ).where("doc_id > 9000 OR doc_id IS NULL").collect()
    }
    assert [got[i].lang_pred for i in (9001, 9002, 9003)] == ["und"] * 3 and got[9001].score == 0
    assert got[9004].lang_pred != "und" and got[None].lang_pred == "en" and got[None].held_out is False
    assert language_id.identify(spark.createDataFrame([], DOCS)).count() == 0
    assert language_id.identify(spark.createDataFrame([(1, "word", None, "s", 4)], DOCS)).first().lang_pred == "und"


def test_mixture_shares_and_set_choice():
    rng = np.random.default_rng(1)
    a = [" ".join("".join(rng.choice(list("abcd"), 6)) for _ in range(80)) for _ in range(20)]
    b = [" ".join("".join(rng.choice(list("wxyz"), 6)) for _ in range(80)) for _ in range(20)]
    counts = np.stack([np.bincount(language_id.trigrams(t)[0], minlength=language_id.BUCKETS) for t in (a, b)])
    model = language_id.Model(["a", "b"], counts)
    best, share = language_id.infer(model, [a[0], b[0], a[0] + " " + b[0] + " " + b[1], ""])
    assert best.tolist() == [0, 1, 1, -1]
    assert share[0] > 0.97 and share[2] == pytest.approx(2 / 3, abs=0.05)


def brute_mixture(model, text, rounds=8, penalty=2.0, overlap=3.0):
    """The growing set and its shares over dictionaries, trying every set that the rule names."""
    low = f" {text.lower()} "
    low = "".join(c if c.isalpha() else " " for c in low)
    grams = Counter(low[i - 1 : i + 2] for i in range(1, len(low) - 1) if low[i] != " ")
    if not grams:
        return {}
    bucket = lambda g: int(language_id.mix(np.array([(ord(g[0]) << 42) | (ord(g[1]) << 21) | ord(g[2])], np.uint64))[0]) >> 48
    counts = Counter()
    for g, c in grams.items():
        counts[bucket(g)] += c
    p = {g: np.exp(model.log_p[g].astype(float) - model.log_p[g].max()) for g in counts}
    total, languages = sum(counts.values()), range(len(model.languages))
    like = lambda share: sum(
        c * math.log(max(sum(share.get(k, 0) * p[g][k] for k in languages), 1e-30)) for g, c in counts.items()
    )

    def em(chosen):
        share = {k: 1 / len(chosen) for k in chosen}
        for _ in range(rounds):
            new = dict.fromkeys(chosen, 0.0)
            for g, c in counts.items():
                w = {k: share[k] * p[g][k] for k in chosen}
                for k in chosen:
                    new[k] += c * w[k] / max(sum(w.values()), 1e-30) / total
            share = new
        return share

    share = {max(languages, key=lambda k: sum(c * float(model.log_p[g][k]) for g, c in counts.items())): 1.0}
    while len(share) < len(model.languages):
        mixed = {g: max(sum(s * p[g][k] for k, s in share.items()), 1e-30) for g in counts}
        new = max((k for k in languages if k not in share), key=lambda k: sum(c * p[g][k] / mixed[g] for g, c in counts.items()))
        grown = em([*share, new])
        if like(grown) - like(share) <= overlap * penalty * math.log(total + 1):
            break
        share = grown
    return share


def test_mixtures_equal_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = language_id.train(docs)
    by = {}
    for r in docs.where("length(text) > 400").orderBy("doc_id").collect():
        by.setdefault(r.lang, []).append(r.text)
    words = {k: " ".join(v[:6]).split() for k, v in by.items() if k}
    a, b, c, d = (words[k] for k in sorted(words)[:4])
    texts = [
        " ".join(a[:300]), " ".join(a[:150] + b[:150]), " ".join(a[:200] + b[:150] + c[:100]),
        " ".join(a[:250] + b[:200] + c[:200] + d[:200]), " ".join(a * 20 + b[: len(a) // 3]), "x", "", "12 !"
    ]
    got = language_id.mixtures(model, texts)
    for t, row in zip(texts, got, strict=True):
        want = brute_mixture(model, t)
        assert {k for k, s in enumerate(row) if s > 0} == set(want), t[:40]
        assert all(row[k] == pytest.approx(s, abs=2e-3) for k, s in want.items())
    assert [int((r > 0).sum()) for r in got[:4]] == [1, 2, 3, 4]  # no limit to the languages of a text


def test_equal_texts_get_equal_languages_wherever_they_stand(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = language_id.train(docs)
    odd = ["x", "y z", "é", "", "a1b", "der", "the"]
    texts = odd * 3 + [r.text for r in docs.limit(20).collect()] + odd
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    seen = defaultdict(set)
    for n in (1, 3, 7):
        for r in language_id.predict(rows.repartition(n), model, keep=["doc_id"]).collect():
            seen[texts[r.doc_id]].add((r.lang_pred, r.score, tuple(r.languages), tuple(r.shares)))
            assert r.lang_pred == (r.languages[0] if r.languages else "und")
    assert all(len(v) == 1 for v in seen.values()) and next(iter(seen["x"]))[0] != "und"


def test_languages_that_are_learned_are_bounded(spark):
    rows = spark.createDataFrame(
        [(k, f"word{chr(97 + k % 9)} " * 5, f"l{min(k, 40)}") for k in range(60)],
        "doc_id bigint, text string, lang string"
    )
    assert language_id.train(rows, most_languages=3).languages == ["l0", "l1", "l40"]


def test_quality_of_documents_with_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    held = lm_scoring.remainder("doc_id", 3, 1)
    got = quality.classify(docs, labels.where(~held))
    assert got.count() == docs.count()
    known = got.join(labels.where(held), "doc_id")
    assert known.count() > 50 and known.where("good = (quality = 1)").count() / known.count() >= 0.85


def test_scores_equal_brute_force(spark, data):
    """All scores from the fitted weights by plain dictionaries; the surest documents by sorting all."""
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    rows = docs.orderBy("doc_id").collect()
    got = {r.doc_id: r for r in quality.score(docs.repartition(5), model, keep=["doc_id"]).collect()}
    for r in rows[:40]:
        x, m = quality.text_features([r.text.encode()])[0], quality.meta_features([r.source], [r.lang], [r.n_chars])[0]
        odds = [
            v.slope * (sum(float(a) * float(b) for a, b in zip(f, v.w, strict=True)) + v.b) + v.offset for f,
            v in ((x, model.text), (m, model.meta))
        ]
        want = 1 / (1 + math.exp(-(sum(odds) - math.log(model.prior / (1 - model.prior)))))
        assert got[r.doc_id].score == pytest.approx(want, abs=1e-4)
        assert got[r.doc_id].text_score == pytest.approx(1 / (1 + math.exp(-odds[0])), abs=1e-4)


def test_columns_of_any_name_don_t_clash(spark, data):
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    plain = {r.doc_id: r.score for r in quality.classify(docs, labels).collect()}
    odd = docs
    for name in ("y", "t", "s", "l", "n", "h", "i", "quality", "rank", "view", "label", "score"):
        odd = odd.withColumn(name, F.lit("clash"))
    assert {r.doc_id: r.score for r in quality.classify(odd, labels.withColumn("text", F.lit("clash"))).collect()} == pytest.approx(plain)


def test_the_surest_of_all_documents_are_exchanged(spark):
    rng = np.random.default_rng(2)
    h, texts = np.arange(90), [b"good words here" if k % 2 else b"BAD 666" for k in range(90)]
    model = quality.Linear(
        rng.normal(size=quality.SHAPES + quality.WORDS + quality.RATES).astype(np.float32) * 9, 0.0
    ), quality.Linear(np.zeros(quality.META, np.float32), 0.0)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays(
        [pa.array(h), pa.array(texts), *(pa.array(["a"] * 90) for _ in range(2)), pa.array([3] * 90)],
        names=["h", "t", "s", "l", "n"]
    )
    taken = [np.array([1, 2]), np.zeros(0, np.int64)]
    out = [
        r for b in quality._surest_in_task(list(model), {1: 4, 0: 3}, taken)(
            iter([batch.slice(0, 50), batch.slice(50)])
        ) for r in b.to_pylist()
    ]
    odds = model[0].raw(quality.text_features(texts))
    for y, n in ((1, 4), (0, 3)):
        want = sorted(
            (-float(o if y else -o), int(k)) for k,
            o in zip(h, odds, strict=True) if k not in (1, 2) and quality.sure(np.array([o]), y)[0]
        )[:n]
        assert [r["h"] for r in out if r["label"] == y and r["view"] == 0] == [k for _, k in want]
    assert not [r for r in out if r["view"] == 1]


def test_quality_of_odd_rows_and_without_labels(spark, data):
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    odd = spark.createDataFrame(
        [
            (9001, None, None, None, None), (None, "", "en", "s", 0), (9002, "word " * 100_000, "en", None, -1),
            (9003, "x", "en", "s", 1), (9003, "x", "en", "s", 1)
        ],
        DOCS
    ).withColumn("score", F.lit("clash"))
    got = quality.classify(docs.withColumn("score", F.lit("clash")).unionByName(odd), labels)
    assert got.count() == docs.count() + 5 and got.where("score IS NULL OR isnan(score)").count() == 0
    assert {r.score for r in quality.classify(odd, labels.limit(0)).collect()} == {1.0}
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_an_id_that_many_documents_have_counts_once(spark, data, monkeypatch):
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    hot = labels.first().doc_id
    many = docs.unionByName(docs.withColumn("doc_id", F.lit(hot).cast("bigint")))
    seen = []
    monkeypatch.setattr(quality, "co_train", lambda views, y, surest, rounds: seen.append(len(y)))
    for rows in (docs, many):
        quality.train(rows, labels.unionByName(labels))
    assert seen[0] == seen[1] <= labels.count()


def test_co_training_learns_from_the_pool():
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 600).astype(float)
    views = [(y[:, None] * 2 - 1 + rng.normal(0, 1.0, (600, 3))).astype(np.float32) for _ in range(2)]
    few, pool = slice(0, 24), [v[24:424] for v in views]
    left = [np.ones(400, bool), np.ones(400, bool)]

    def surest(models, prior):
        new = []
        for learner, teacher in ((0, 1), (1, 0)):
            odds, own = models[teacher].raw(pool[teacher]), []
            for label, n in quality.shares_of(40, prior).items():
                fit = np.flatnonzero(quality.sure(odds, label) & left[teacher])
                own += [(k, label) for k in fit[np.argsort(-odds[fit] if label else odds[fit])][:n].tolist()]
            left[teacher][[k for k, _ in own]] = False
            new.append((pool[learner][[k for k, _ in own]], np.array([y for _, y in own], float)))
        return new

    model = quality.co_train([v[few] for v in views], y[few], surest)
    p = model.probability(*(m.log_odds(v[424:]) for m, v in zip((model.text, model.meta), views, strict=True)))
    assert ((p > 0.5) == (y[424:] > 0.5)).mean() > 0.93
