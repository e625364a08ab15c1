"""Language identification by multilingual mixture inference.

A model holds, for each language, smoothed likelihoods of hashed letter trigrams. A document is
a mixture of languages: expectation-maximisation over its trigram counts estimates the share of
each language of a set. The set grows from the likeliest language, by the one that the likelihood
rises with most, as long as the likelihood less a penalty for each language rises; it may hold all
languages. The strongest language of the set is predicted, with its share as the score; the set
and the shares are returned too, strongest first. (The likelihood is concave in the shares, so its
slope bounds what any further language can gain: a document whose bound is below the penalty is
done without trying.)

Training reads a bounded sample: the `most_languages` values of lang with the most documents, and
about `per_language` documents of each, chosen by a hash of the id. A text that is null or without
letters gets `und`, score 0 and empty lists, as do all where no language was learned. Only the text
is read to predict: equal texts get equal rows, wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ._hashing import U, mix, slices
from .lm_scoring import remainder
from ._worker import arrow_map

BUCKETS = 1 << 16
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashed letter trigrams of lower-cased texts and each one's text; a non-letter counts as a space."""
    low = [t.lower() for t in texts]
    codes = np.frombuffer((" " + " ".join(low) + " ").encode("utf-32-le", "replace"), np.uint32)  # a space before and after each text
    doc = np.repeat(np.arange(len(low)), np.fromiter((len(t) + 1 for t in low), np.int64, len(low)))
    letter = _letters()[codes]
    c = np.where(letter, codes, 32).astype(np.uint64)
    use = letter[1:-1]
    key = mix((c[:-2] << U(42)) | (c[1:-1] << U(21)) | c[2:])[use] >> U(48)
    return key.astype(np.int64), doc[: len(use)][use]


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct trigrams: bucket, text and count, in order of texts."""
    gram, doc = trigrams(texts)
    key = np.sort(doc * BUCKETS + gram)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(key)))
    return key[first] % BUCKETS, key[first] // BUCKETS, count


class Model:
    """Languages, and the log likelihood of each trigram in each."""

    def __init__(self, languages: list[str], counts: np.ndarray, smoothing: float = 0.05):
        self.languages = languages
        totals = counts.sum(1, keepdims=True)
        self.log_p = np.log((counts + smoothing) / (totals + smoothing * BUCKETS)).astype(np.float32).T.copy()


def _mixture(p: np.ndarray, count: np.ndarray, first: np.ndarray, where: np.ndarray, allowed: np.ndarray, rounds: int) -> np.ndarray:
    """Shares of the allowed languages by text that make its trigrams most likely."""
    share = allowed / allowed.sum(1, keepdims=True)
    total = np.add.reduceat(count, first)[:, None]
    for _ in range(rounds):
        w = p * share[where]
        w *= (count / np.maximum(w.sum(1), 1e-30))[:, None]
        share = np.add.reduceat(w, first, axis=0) / total
    return share


def _starts(doc: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))


def mixtures(model: Model, texts: list[str], *, rounds: int = 8, penalty: float = 2.0, overlap: float = 3.0) -> np.ndarray:
    """Shares of the languages by text, 0 outside its set; a row of zeros is undetermined. overlap: trigrams that say one thing thrice."""
    shares = np.zeros((len(texts), len(model.languages)), np.float32)
    gram, doc, count = gram_counts(texts)
    if not len(gram) or not model.languages:
        return shares
    first = _starts(doc)
    ids, where = doc[first], np.repeat(np.arange(len(first)), np.diff(np.append(first, len(doc))))
    log_p, n = model.log_p[gram], count.astype(np.float32)
    p = np.exp(log_p - log_p.max(1)[:, None])
    best = np.add.reduceat(n[:, None] * log_p, first, axis=0).argmax(1)
    share = np.zeros((len(ids), p.shape[1]), np.float32)
    share[np.arange(len(ids)), best] = 1
    open_ = np.arange(len(ids))
    while len(open_):
        total = np.add.reduceat(n, first)
        mixed = np.maximum((p * share[open_][where]).sum(1), 1e-30)
        like = np.add.reduceat(n * np.log(mixed), first)
        slope = np.add.reduceat(p * (n / mixed)[:, None], first, axis=0) / total[:, None]
        cost = overlap * penalty * np.log(total + 1)
        may = total * np.log(np.maximum(slope.max(1), 1)) > cost
        new = np.where(share[open_] > 0, -np.inf, slope).argmax(1)
        may &= share[open_, new] == 0
        part = may[where]  # the rows of texts that may gain, numbered anew
        p, n, where, new, like, cost = p[part], n[part], (np.cumsum(may) - 1)[where[part]], new[may], like[may], cost[may]
        open_ = open_[may]
        if not len(open_):
            break
        first = _starts(where)
        allowed = (share[open_] > 0).astype(np.float32)
        allowed[np.arange(len(open_)), new] = 1
        grown = _mixture(p, n, first, where, allowed, rounds)
        gain = np.add.reduceat(n * np.log(np.maximum((p * grown[where]).sum(1), 1e-30)), first) - like
        better = gain > cost
        share[open_[better]] = grown[better]
        part = better[where]
        p, n, where, open_ = p[part], n[part], (np.cumsum(better) - 1)[where[part]], open_[better]
        first = _starts(where) if len(where) else first[:0]
    shares[ids] = share
    return shares


def infer(model: Model, texts: list[str], **how: float) -> tuple[np.ndarray, np.ndarray]:
    """Index of each text's language (-1: undetermined) and its share."""
    shares = mixtures(model, texts, **how)
    if not shares.shape[1]:
        return np.full(len(texts), -1), np.zeros(len(texts))
    score = shares.max(1)
    return np.where(score > 0, shares.argmax(1), -1), np.clip(score.astype(np.float64), 0.0, 1.0)


_COUNTS = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for b in batches:
        langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
        for i, j in slices(texts, 1 << 18):
            gram, doc = trigrams(texts[i:j])
            for lang in set(langs[i:j]):
                own = np.array([x == lang for x in langs[i:j]])
                sums[lang] = sums.get(lang, 0) + np.bincount(gram[own[doc]], minlength=BUCKETS)
    for lang, s in sums.items():
        at = np.flatnonzero(s)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(s[at], pa.int64())],
            schema=_COUNTS
        )


def train(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", per_language: int = 2000,
    most_languages: int = 200
) -> Model:
    """Learn from about `per_language` documents of each of the `most_languages` most frequent languages."""
    rows = docs.select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("t"), F.col(doc_id).alias("i")
    ).where("lang IS NOT NULL AND t IS NOT NULL")
    sizes = {
        r["lang"]: r["n"] for r in rows.groupBy("lang").agg(
            F.count("*").alias("n")
        ).orderBy(F.desc("n"), "lang").limit(most_languages).collect()
    }
    languages = sorted(sizes)
    counts = np.zeros((len(languages), BUCKETS))
    if languages:
        fraction = F.create_map(*(F.lit(x) for name, n in sizes.items() for x in (name, min(1.0, per_language / n))))
        sample = rows.where(F.pmod(F.xxhash64("i"), F.lit(1 << 20)) < fraction[F.col("lang")] * float(1 << 20))
        for r in sample.select("lang", "t").transform(
            arrow_map, _count, "lang string, bucket int, n bigint"
        ).groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect():
            counts[languages.index(r["lang"]), r["bucket"]] = r["n"]  # at most BUCKETS rows a language
    return Model(languages, counts)


def _ranked(shares: np.ndarray, names: pa.Array) -> tuple[pa.Array, ...]:
    """Of each text: its strongest language (the last name, if none) and share, its languages and their shares."""
    none = len(names) - 1
    order = np.argsort(-shares, axis=1, kind="stable")
    ranked = np.take_along_axis(shares, order, 1)
    ends = pa.array(np.append(0, np.cumsum((ranked > 0).sum(1))), pa.int32())
    text = pa.ListArray.from_arrays(ends, names.take(pa.array(order[ranked > 0])))
    values = pa.ListArray.from_arrays(ends, pa.array(ranked[ranked > 0].astype(np.float64)))
    if not shares.shape[1]:
        return names.take(pa.array(np.full(len(shares), none))), pa.array(np.zeros(len(shares))), text, values
    top = np.clip(ranked[:, 0].astype(np.float64), 0.0, 1.0)
    return names.take(pa.array(np.where(top > 0, order[:, 0], none))), pa.array(top), text, values


def predict(
    docs: DataFrame, model: Model, *, text: str = "text", keep: list[str], language: str = "lang_pred",
    score: str = "score", languages: str = "languages", shares: str = "shares"
) -> DataFrame:
    """The columns `keep` of docs with each text's language and its share, and all its languages with their shares."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [docs.schema[k] for k in keep]
    names = [*keep, language, score, languages, shares]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        labels = pa.array([*m.languages, UNDETERMINED], pa.string())
        for b in batches:
            texts = [x or "" for x in b.column(len(keep)).to_pylist()]
            for i, j in slices(texts, (1 << 21) // max(8, len(m.languages))):
                found = _ranked(mixtures(m, texts[i:j]), labels)
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(i, j - i) for k in range(len(keep))), *found], names=names)

    own = [f"`{language}` string", f"`{score}` double", f"`{languages}` array<string>", f"`{shares}` array<double>"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), *own])
    return docs.select(*keep, F.col(text).alias("__text")).transform(arrow_map, run, schema)


def identify(docs: DataFrame, *, modulus: int = 4, held: int = 2) -> DataFrame:
    """Learn from all but one residue class of the documents and predict all of them."""
    out: Column = remainder("doc_id", modulus, held)
    model = train(docs.where(~out))
    return predict(docs.select("doc_id", out.alias("held_out"), "text"), model, keep=["doc_id", "held_out"])
