"""Quality classifier by co-training: two views of a document teach each other.

The text view sees content: hashed character-shape trigrams, hashed words and a few rates. The
metadata view sees source, language and length. Each is a logistic regression on a labelled
sample. In every round each view scores all unlabelled documents in one pass over them; the
`pseudo` different ones that it is surest of, of the whole table, are labelled and join the other
view's training set. Both are then calibrated on labelled documents kept apart (Platt), and their
log odds, less the prior's, are added.

Training reads about `labelled` labelled documents, chosen by a hash of the id; of several documents
or labels of one id, the one whose hash is least. Without labels of both kinds, every document gets
the share of good labels (1 if none). Null text is empty text; null metadata are values of their own.
Documents of equal text and metadata count as one when labels are exchanged; every row is scored.
Columns beyond doc_id, text, source, lang and n_chars, and doc_id and quality of labels, are not
looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ._hashing import U, mix, slices, word_hashes
from ._worker import arrow_map

SHAPES, WORDS, RATES = 1024, 1024, 6
META = 256


def _classes() -> np.ndarray:
    """Bytes by kind: lower, upper, digit, space, line end, other letters as lower; punctuation each its own."""
    kind = np.arange(256, dtype=np.uint64)
    for first, last, to in ((97, 122, 1), (65, 90, 2), (48, 57, 3), (128, 255, 1)):
        kind[first : last + 1] = to
    kind[[9, 11, 12, 32]] = 4
    return kind


_KIND = _classes()


def _lengths(texts: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, texts), np.int64, len(texts))


def _sums(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of n values."""
    c = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    ends = np.cumsum(n)
    return c[ends] - c[ends - n]


def _parts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shape buckets and their number by text, word buckets and their number, and rates by text."""
    size = _lengths(texts) + 2  # two line ends after each text, so that no window holds two texts
    kind = _KIND[np.frombuffer(b"\n\n".join(texts) + b"\n\n", np.uint8)]
    inner = np.ones(len(kind), bool)
    ends = np.cumsum(size)
    inner[ends - 1] = inner[ends - 2] = False
    padded = np.concatenate([kind, kind[-2:]])
    shape = (mix((kind << U(16)) | (padded[1:-1] << U(8)) | padded[2:]) >> U(54)).astype(np.int64)[inner]
    kind, size = kind[inner], size - 2
    words, n = word_hashes(texts)
    same = np.zeros(len(words))
    same[1:] = words[1:] == words[:-1]
    same[(np.cumsum(n) - n)[n > 0]] = 0
    chars = np.maximum(size, 1)
    rates = np.stack(
        [
            _sums(kind == 2, size) / chars, _sums(kind > 4, size) / chars, _sums(kind == 3, size) / chars,
            _sums(same, n) / np.maximum(n, 1), np.minimum(chars / np.maximum(n, 1), 30) / 30, n < 3
        ],
        1
    )
    return shape, size, (words >> U(54)).astype(np.int64), n, rates


def text_features(texts: list[bytes]) -> np.ndarray:
    """Shares of shapes and of words, then rates."""
    shape, size, word, n, rates = _parts(texts)
    k = len(texts)
    shapes = np.bincount(
        np.repeat(np.arange(k), size) * SHAPES + shape, minlength=k * SHAPES
    ).reshape(k, SHAPES) / np.maximum(size, 1)[:, None]
    words = np.bincount(np.repeat(np.arange(k), n) * WORDS + word, minlength=k * WORDS).reshape(k, WORDS) / np.maximum(n, 1)[:, None]
    return np.concatenate([np.sqrt(shapes), np.sqrt(words), rates], 1).astype(np.float32)


def meta_features(source: list, lang: list, chars: list) -> np.ndarray:
    """One of META buckets for the source, the language and the order of the length each."""
    out = np.zeros((len(source), META), np.float32)
    for name, col in (("s", source), ("l", lang), ("n", [None if c is None else int(np.log2(max(c, 0) + 1) * 2) for c in chars])):
        for k, v in enumerate(col):
            out[k, blake2b(repr((name, v)).encode("utf-8", "surrogatepass"), digest_size=1).digest()[0]] = 1
    return out


@dataclass
class Linear:
    """A logistic regression, with the slope and offset of its calibration."""

    w: np.ndarray
    b: float
    slope: float = 1.0
    offset: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log odds before calibration, summed in double precision: the rows that stand beside one don't matter."""
        return x @ self.w.astype(np.float64) + self.b

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.raw(x) + self.offset


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _fit(x: np.ndarray, y: np.ndarray, *, steps: int = 150, decay: float = 1e-4, rate: float = 0.3) -> Linear:
    """Full-batch Adam from zero: the same weights for the same rows."""
    w, m, v = (np.zeros(x.shape[1] + 1) for _ in range(3))
    for t in range(1, steps + 1):
        err = _sigmoid(x @ w[:-1].astype(np.float32) + w[-1]) - y
        g = np.append(x.T @ err.astype(np.float32) / len(y) + decay * w[:-1], err.mean())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Linear(w[:-1].astype(np.float32), float(w[-1]))


def _calibrate(model: Linear, x: np.ndarray, y: np.ndarray) -> Linear:
    """Platt's scaling with his smoothed targets, by Newton steps."""
    s, good = model.raw(x).astype(np.float64), y.sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (len(y) - good + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * s + b)
        r = p * (1 - p) + 1e-9
        g = np.array([((p - target) * s).sum() + 1e-3 * (a - 1), (p - target).sum()])
        h = np.array([[(r * s * s).sum() + 1e-3, (r * s).sum()], [(r * s).sum(), r.sum() + 1e-6]])
        a, b = np.array([a, b]) - np.clip(np.linalg.solve(h, g), -2, 2)
    return Linear(model.w, model.b, float(max(a, 0.0)), float(b))


@dataclass
class Classifier:
    text: Linear | None
    meta: Linear | None
    prior: float

    def probability(self, text_odds: np.ndarray, meta_odds: np.ndarray) -> np.ndarray:
        return _sigmoid(text_odds + meta_odds - np.log(self.prior / (1 - self.prior)))


def _rest(y: np.ndarray) -> np.ndarray:
    """Which labelled rows are kept apart for calibration: a quarter, if it has both kinds."""
    apart = np.arange(len(y)) % 4 == 3
    return apart if len(set(y[apart].tolist())) == 2 else np.zeros(len(y), bool)


def co_train(views: list[np.ndarray], y: np.ndarray, surest, *, rounds: int = 3) -> Classifier:
    """views: features of the two views' labelled rows; y: their labels.

    surest(models, prior) gives, for the two views that learn, features and labels of new rows that the other view chose.
    """
    if not len(y) or y.min() == y.max():
        return Classifier(None, None, float(y.mean()) if len(y) else 1.0)
    apart = _rest(y)
    test = apart if apart.any() else ~apart
    prior = float(y.mean())
    sets = [(x[~apart], y[~apart]) for x in views]
    models = [_fit(*s) for s in sets]
    for _ in range(rounds):
        sets = [tuple(np.concatenate(x) for x in zip(own, new, strict=True)) for own, new in zip(sets, surest(models, prior), strict=True)]
        models = [_fit(*s) for s in sets]
    return Classifier(*(_calibrate(m, x[test], y[test]) for m, x in zip(models, views, strict=True)), prior)


def shares_of(pseudo: int, prior: float) -> dict[int, int]:
    """How many documents a view labels good and bad in a round."""
    return {1: int(pseudo * prior), 0: pseudo - int(pseudo * prior)}


def sure(log_odds: np.ndarray, label: int, least: float = 0.9) -> np.ndarray:
    """Whether the probability of the label is above `least`."""
    return (log_odds if label else -log_odds) > np.log(least / (1 - least))


_FEATURES = pa.schema([("h", pa.int64()), ("y", pa.int32()), ("text", pa.binary()), ("meta", pa.binary())])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        t = [x or b"" for x in b.column(2).to_pylist()]
        meta = [b.column(k).to_pylist() for k in (3, 4, 5)]
        for i, j in slices(t, 1 << 18, 256):
            views = (text_features(t[i:j]).astype(np.float16), meta_features(*(m[i:j] for m in meta)).astype(np.float16))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).slice(i, j - i), b.column(1).slice(i, j - i),
                    *(pa.array([r.tobytes() for r in v], pa.binary()) for v in views)
                ],
                schema=_FEATURES
            )


_SURE = pa.schema([("view", pa.int32()), ("label", pa.int32()), ("sureness", pa.float64()), ("h", pa.int64())])


def _surest_in_task(models: list[Linear], wanted: dict[int, int], taken: list[np.ndarray]):
    """Of each view and label, the task's surest documents that neither are labelled nor were chosen before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {(v, y): (np.zeros(0), np.zeros(0, np.int64)) for v in (0, 1) for y in wanted}
        for b in batches:
            h, t = b.column(0).to_numpy(), [x or b"" for x in b.column(1).to_pylist()]
            meta = [b.column(k).to_pylist() for k in (2, 3, 4)]
            for i, j in slices(t, 1 << 18, 256):
                odds = models[0].raw(text_features(t[i:j])), models[1].raw(meta_features(*(m[i:j] for m in meta)))
                for (v, y), (score, ids) in best.items():
                    own = sure(odds[v], y) & ~np.isin(h[i:j], taken[v])
                    score = np.concatenate([score, (odds[v] if y else -odds[v])[own].astype(np.float64)])
                    ids, first = np.unique(np.concatenate([ids, h[i:j][own]]), return_index=True)
                    score = score[first]
                    order = np.lexsort((ids, -score))[: wanted[y]]
                    best[v, y] = score[order], ids[order]
        for (v, y), (score, ids) in best.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), v), pa.int32()), pa.array(np.full(len(ids), y), pa.int32()),
                    pa.array(score), pa.array(ids)
                ],
                schema=_SURE
            )

    return run


def _sampled(rows: DataFrame, most: int, key: str) -> DataFrame:
    """About `most` rows, by a hash of the key."""
    n = rows.count()
    return rows.where(F.pmod(F.xxhash64(key, F.lit(8)), F.lit(1 << 20)) < F.lit((1 << 20) * most // max(n, most)))


def _columns(docs: DataFrame) -> list:
    return [
        F.col("text").cast("binary").alias("t"), F.col("source").cast("string").alias("s"),
        F.col("lang").cast("string").alias("l"), F.col("n_chars").cast("long").alias("n")
    ]


def _views(rows: list) -> list[np.ndarray]:
    return [
        np.array([np.frombuffer(r[v], np.float16) for r in rows], np.float32).reshape(len(rows), width) for v,
        width in (("text", SHAPES + WORDS + RATES), ("meta", META))
    ]


def train(docs: DataFrame, labels: DataFrame, *, labelled: int = 3000, pseudo: int = 300, rounds: int = 3) -> Classifier:
    """Co-train on a sample of bounded size of the labelled documents, and on all others."""
    given = labels.select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("__y"))
    known = _sampled(given.where("__id IS NOT NULL AND __y IS NOT NULL").distinct(), labelled, "__id")
    rows = docs.select(F.col("doc_id").alias("__id"), *_columns(docs)).withColumn("h", F.xxhash64("t", "s", "l", "n"))
    own = rows.join(F.broadcast(known), "__id")  # about `labelled` rows
    least = F.min(F.struct("h", F.col("__y").alias("y"), "t", "s", "l", "n"))
    own = own.groupBy("__id").agg(least.alias("r")).select("r.*")  # one document of an id, however many have it
    found = sorted(
        own.dropDuplicates(["h", "y"]).transform(arrow_map, _features, "h bigint, y int, text binary, meta binary")
        .collect(),
        key=lambda r: (r["h"], r["y"])
    )
    y = np.array([r["y"] for r in found], float)
    taken = [np.array([r["h"] for r in found], np.int64)] * 2

    def surest(models: list[Linear], prior: float) -> list[tuple[np.ndarray, np.ndarray]]:
        wanted = shares_of(pseudo, prior)
        sent = (
            rows.select("h", "t", "s", "l", "n")
            .transform(
                arrow_map, _surest_in_task(models, wanted, taken), "view int, label int, sureness double, h bigint"
            )
            .distinct()
        )
        enough = F.when(F.col("label") == 1, wanted[1]).otherwise(wanted[0])
        order = (F.desc("sureness"), "h")
        for by in ([F.pmod("h", F.lit(64))], []):  # of 64 parts each, then of all
            rank = F.row_number().over(Window.partitionBy("view", "label", *by).orderBy(*order))
            sent = sent.withColumn("rank", rank).where((F.col("rank") <= pseudo) & (F.col("rank") <= enough)).drop("rank")
        chosen = sorted(sent.select("view", "label", "h").collect())  # at most 2 * pseudo
        ids = docs.sparkSession.createDataFrame([(h,) for h in sorted({h for *_, h in chosen})], "h bigint")
        texts = rows.join(F.broadcast(ids), "h").dropDuplicates(["h"]).select("h", F.lit(0).alias("y"), "t", "s", "l", "n")
        of = {r["h"]: r for r in texts.transform(arrow_map, _features, "h bigint, y int, text binary, meta binary").collect()}
        new = []
        for learner, teacher in ((0, 1), (1, 0)):
            own = [(label, h) for view, label, h in chosen if view == teacher]
            new.append((_views([of[h] for _, h in own])[learner], np.array([label for label, _ in own], float)))
            taken[teacher] = np.append(taken[teacher], np.array([h for _, h in own], np.int64))
        return new

    return co_train(_views(found), y, surest, rounds=rounds)


def score(docs: DataFrame, model: Classifier, *, keep: list[str], into: str = "score") -> DataFrame:
    """The columns `keep` with text_score, meta_score and the combined probability of good quality."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [*keep, "text_score", "meta_score", into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Classifier = shared.value
        for b in batches:
            t, *meta = (b.column(len(keep) + k).to_pylist() for k in range(4))
            t = [x or b"" for x in t]
            for i, j in slices(t, 1 << 18, 256):
                if m.text is None or m.meta is None:
                    found = [np.full(j - i, m.prior)] * 3
                else:
                    odds = m.text.log_odds(text_features(t[i:j])), m.meta.log_odds(meta_features(*(x[i:j] for x in meta)))
                    found = [_sigmoid(odds[0]), _sigmoid(odds[1]), m.probability(*odds)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(b.column(k).slice(i, j - i) for k in range(len(keep))),
                        *(pa.array(np.asarray(f, np.float64)) for f in found)
                    ],
                    names=names
                )

    schema = ", ".join(
        [
            *(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep), "text_score double",
            "meta_score double", f"`{into}` double"
        ]
    )
    return docs.select(*(F.col(k).alias(f"__{i}") for i, k in enumerate(keep)), *_columns(docs)).transform(arrow_map, run, schema)


def classify(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3) -> DataFrame:
    """Every document's scores, and whether it is good: score at least the threshold."""
    return score(docs, train(docs, labels), keep=["doc_id"]).withColumn("good", F.col("score") >= threshold)
