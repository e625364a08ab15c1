"""Language-model scoring: an interpolated modified Kneser-Ney model of word pairs.

Counting is one Spark job. Mappers count the pairs of a few million tokens at a time and send
them, sorted and delta-coded, to ranges of the pair hash; a reducer merges its range, writes it
as two sorted arrays (hash, count) to the shared folder and passes on, per word, what the lower
order needs (count, distinct predecessors, followers seen once, twice, more). A second exchange
by ranges of the word hash merges these into the word arrays. Ranges of a hash are even whatever
words are frequent, so no word is hot. Nothing but file names and totals reaches the driver.

Workers map the arrays into memory and look up sorted batches of hashes.
Null text is empty text, of one token (the end). A null doc_id counts as training. An empty
training set gives every text probability 1 at each token. Repeated rows are scored each.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from . import _store
from ._hashing import U, mix, slices, word_hashes
from ._worker import arrow_map

#: Begin and end of a text; the begin is a context only.
BEGIN, END = mix(np.array([1, 2], np.uint64))
STATS = ("c", "cont", "n1", "n2", "n3")


def pair_keys(prev: np.ndarray, cur: np.ndarray) -> np.ndarray:
    return mix(prev * U(0xA24BAED4963EE407) + cur * U(0x9FB21C651E98DF25))


def range_of(h: np.ndarray, n: int) -> np.ndarray:
    """Which of n even ranges of 64-bit values; ascending in h."""
    return ((h >> U(32)) * U(n) >> U(32)).astype(np.int64)


def token_pairs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(previous, current) for each token of each text, and the number of tokens by text."""
    h, words = word_hashes(texts)
    n = words + 1
    ends = np.cumsum(n) - 1
    cur = np.empty(int(n.sum()), np.uint64)
    inner = np.ones(len(cur), bool)
    inner[ends] = False
    cur[inner], cur[ends] = h, END
    prev = np.empty_like(cur)
    prev[1:] = cur[:-1]
    prev[ends - n + 1] = BEGIN
    return prev, cur, n


def _planes(x: np.ndarray) -> bytes:
    """An ascending array as differences, byte by byte, compressed."""
    d = np.diff(x, prepend=U(0)).view(np.uint8).reshape(-1, 8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(d.T).tobytes())


def _unplanes(b: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(raw.T).view(np.uint64).ravel(), dtype=np.uint64)


def _pack(ascending: np.ndarray, raw: np.ndarray | None, *small: np.ndarray) -> bytes:
    z = zstandard.ZstdCompressor(level=1)
    parts = [_planes(ascending), b"" if raw is None else raw.tobytes(), *(z.compress(s.astype(np.int64).tobytes()) for s in small)]
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def _unpack(b: bytes) -> list[np.ndarray]:
    parts, at = [], 0
    while at < len(b):
        n = int.from_bytes(b[at : at + 8], "little")
        parts.append(b[at + 8 : at + 8 + n])
        at += 8 + n
    z = zstandard.ZstdDecompressor()
    return [_unplanes(parts[0]), np.frombuffer(parts[1], np.uint64), *(np.frombuffer(z.decompress(p), np.int64) for p in parts[2:])]


def _group(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums of the values by key, keys ascending."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], first, order, *(np.add.reduceat(v[order], first) if len(keys) else v[:0] for v in values)


def _npy(x: np.ndarray) -> bytes:
    np.save(f := io.BytesIO(), x)
    return f.getvalue()


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({n: [r[k] for r in rows] for k, n in enumerate(schema.names)}, schema=schema)


_BLOCKS = pa.schema([("part", pa.int32()), ("block", pa.binary())])
_MADE = pa.schema([("kind", pa.string()), ("totals", pa.list_(pa.int64()))])


def _of_counts(c: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return [int((c == k).sum()) for k in (1, 2, 3, 4)]


def _count(parts: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            prev, cur = (np.concatenate(x) for x in zip(*kept, strict=True))
            kept.clear()
            keys, first, order, n = _group(pair_keys(prev, cur), np.ones(len(prev), np.int64))
            prev, cur, bounds = prev[order][first], cur[order][first], np.searchsorted(range_of(keys, parts), np.arange(parts + 1))
            rows = []
            for k in range(parts):
                at = slice(bounds[k], bounds[k + 1])
                if bounds[k] < bounds[k + 1]:
                    by = np.argsort(prev[at])
                    rows.append((k, _pack(prev[at][by], cur[at][by], n[at][by])))
            return _batch(_BLOCKS, rows)

        total = 0
        for b in batches:
            texts = [x or b"" for x in b.column(0).to_pylist()]
            for i, j in slices(texts, 1 << 20):
                prev, cur, _ = token_pairs(texts[i:j])
                kept.append((prev, cur))
                total += len(cur)
                if total >= chunk:
                    yield flush()
                    total = 0
        if total:
            yield flush()

    return run


def _path(folder: str, kind: str, part: int) -> str:
    return f"{folder}/{kind}-{part // 1000:06d}/{part:09d}"


def _by_part(merge):
    """merge(part, blocks) gives rows; over the partitions that `repartitionById` made, each of one part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for b in batches:
            for part, block in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.setdefault(part, []).append(block)
        for part in sorted(held):
            yield merge(part, [_unpack(b) for b in held.pop(part)])

    return run


def _merge_pairs(folder: str, word_parts: int):
    """One range of pairs: write its arrays; pass on the words' statistics, and its counts of counts as a block of part `word_parts`."""

    def merge(part: int, blocks: list[list[np.ndarray]]) -> pa.RecordBatch:
        prev, cur, n = (np.concatenate(x) for x in zip(*blocks, strict=True))
        blocks.clear()
        keys, first, order, n = _group(pair_keys(prev, cur), n)
        prev, cur = prev[order][first], cur[order][first]
        path = _path(folder, "pairs", part)
        _store.write(f"{path}.counts", _npy(n.astype(np.uint32) if n.max() < 2**32 else n.astype(np.uint64)))
        _store.write(f"{path}.keys", _npy(keys))
        words, _, _, *stats = _group(
            np.concatenate([cur, prev]),
            *(np.concatenate(x) for x in ((n, 0 * n), (0 * n + 1, 0 * n), (0 * n, n == 1), (0 * n, n == 2), (0 * n, n > 2))),
        )
        bounds = np.searchsorted(range_of(words, word_parts), np.arange(word_parts + 1))
        rows = [(word_parts, _pack(np.array([part], np.uint64), None, np.array(_of_counts(n))))]
        for k in range(word_parts):
            at = slice(bounds[k], bounds[k + 1])
            if bounds[k] < bounds[k + 1]:
                rows.append((k, _pack(words[at], None, *(s[at] for s in stats))))
        return _batch(_BLOCKS, rows)

    return merge


def _merge_words(folder: str, word_parts: int):
    """One range of words: write its arrays. The totals of a range, or of all ranges of pairs."""

    def merge(part: int, blocks: list[list[np.ndarray]]) -> pa.RecordBatch:
        if part == word_parts:
            return _batch(_MADE, [("pairs", [*np.sum([n for _, _, n in blocks], 0).tolist(), 0, 0, 0])])
        words, _, _, *stats = _group(
            np.concatenate([b[0] for b in blocks]),
            *(np.concatenate(x) for x in zip(*(b[2:] for b in blocks), strict=True))
        )
        path = _path(folder, "words", part)
        for name, s in zip(STATS, stats, strict=True):
            _store.write(f"{path}.{name}", _npy(s.astype(np.uint32) if s.max() < 2**32 else s))
        _store.write(f"{path}.keys", _npy(words))
        c, cont = stats[0], stats[1]
        return _batch(_MADE, [("words", [int(c.sum()), int((c > 0).sum()), int(cont.sum()), *_of_counts(cont)])])

    return merge


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and 3 or more; where a number of counts is 0, 0.5, 1 and 1.5 stand in."""
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(x, 0.0), k + 1.0) for k, x in enumerate(d))


@dataclass(frozen=True)
class KneserNey:
    """A trained model: the folder of its arrays, by ranges of the hash, and its totals."""

    folder: str
    pair_parts: int
    word_parts: int
    tokens: int
    vocabulary: int
    continuations: int
    pair_d: tuple[float, float, float]
    word_d: tuple[float, float, float]
    word_counts: tuple[int, int, int]


@lru_cache(maxsize=4096)
def _map(path: str) -> np.ndarray | None:
    """The array of a file, mapped; None for a range that nothing fell into."""
    try:
        return _store.mapped(path)
    except FileNotFoundError:
        return None


def _lookup(keys: np.ndarray, folder: str, kind: str, parts: int, names: tuple[str, ...]) -> list[np.ndarray]:
    """The named values of ascending keys; 0 where a key is not stored."""
    out = [np.zeros(len(keys), np.int64) for _ in names]
    bounds = np.searchsorted(range_of(keys, parts), np.arange(parts + 1))
    for k in np.flatnonzero(bounds[1:] > bounds[:-1]).tolist():
        path = _path(folder, kind, k)
        q, stored = keys[bounds[k] : bounds[k + 1]], _map(f"{path}.keys")
        if stored is None:
            continue
        at = np.minimum(np.searchsorted(stored, q), len(stored) - 1)
        hit = np.flatnonzero(stored[at] == q)
        for o, name in zip(out, names, strict=True):
            o[bounds[k] + hit] = _map(f"{path}.{name}")[at[hit]]
    return out


def _discount(c: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(c - np.array([0.0, *d])[np.minimum(c, 3)], 0.0)


def score_texts(model: KneserNey, texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """n_tokens, n_known, base_score and score of each text."""
    prev, cur, n = token_pairs(texts)
    words, where = np.unique(np.concatenate([cur, prev]), return_inverse=True)
    c, cont, n1, n2, n3 = _lookup(words, model.folder, "words", model.word_parts, STATS)
    total = c.copy()  # every word is followed by something; the begin stands before the texts only
    total[words == BEGIN] = c[words == END].max(initial=0)
    at_cur, at_prev = where[: len(cur)], where[len(cur) :]
    keys = pair_keys(prev, cur)
    order = np.argsort(keys)
    pair = np.empty(len(keys), np.int64)
    pair[order] = _lookup(keys[order], model.folder, "pairs", model.pair_parts, ("counts",))[0]
    flat = 1.0 / (model.vocabulary + 1)
    if model.continuations:
        left = sum(d * k for d, k in zip(model.word_d, model.word_counts, strict=True)) / model.continuations
        lower = _discount(cont, model.word_d) / model.continuations + left * flat
    else:
        lower = np.full(len(words), flat)
    seen = np.maximum(total, 1)
    gamma = np.where(total > 0, (model.pair_d[0] * n1 + model.pair_d[1] * n2 + model.pair_d[2] * n3) / seen, 1.0)
    p = _discount(pair, model.pair_d) / seen[at_prev] + gamma[at_prev] * lower[at_cur]
    first = np.cumsum(n) - n
    base = np.log10((c + 1.0) / (model.tokens + model.vocabulary + 1.0))
    return n, np.add.reduceat(
        (c > 0).astype(np.int64)[at_cur], first
    ), np.add.reduceat(base[at_cur], first), np.add.reduceat(np.log10(p), first)


def train(
    docs: DataFrame, *, text: str = "text", chunk_tokens: int = 2_500_000, part_bytes: int = 24 << 20,
    word_part_bytes: int = 128 << 20
) -> KneserNey:
    """Count the texts of `docs`. chunk_tokens: tokens counted in memory at once; part_bytes: text to a range of pairs."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts, word_parts = 1 + size // part_bytes, 1 + size // word_part_bytes
    folder = _store.new_dir(spark, "kneser-ney")
    made = (
        docs.select(F.col(text).cast("binary").alias("t"))
        .transform(arrow_map, _count(parts, chunk_tokens), "part int, block binary")
        .repartitionById(parts, "part")
        .transform(arrow_map, _by_part(_merge_pairs(folder, word_parts)), "part int, block binary")
        .repartitionById(word_parts + 1, "part")
        .transform(arrow_map, _by_part(_merge_words(folder, word_parts)), "kind string, totals array<bigint>")
        .groupBy("kind")
        .agg(F.array(*(F.sum(F.col("totals")[k]) for k in range(7))).alias("totals"))
        .collect()
    )
    totals = {r["kind"]: r["totals"] for r in made}
    of_pairs = totals.get("pairs", [0] * 7)[:4]
    tokens, vocabulary, continuations, *of_words = totals.get("words", [0] * 7)
    return KneserNey(
        folder, parts, word_parts, tokens, vocabulary, continuations, discounts(*of_pairs), discounts(*of_words),
        (of_words[0], of_words[1], vocabulary - of_words[0] - of_words[1]),
    )


_SCORES = pa.schema(
    [
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())
    ]
)


def score(docs: DataFrame, model: KneserNey, *, text: str = "text", doc_id: str = "doc_id", held_out: Column) -> DataFrame:
    """One row per text: its tokens, known tokens, unigram base and model log10 probabilities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [x or b"" for x in b.column(2).to_pylist()]
            for i, j in slices(texts, 1 << 21):
                n, known, base, own = score_texts(model, texts[i:j])
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).slice(i, j - i), b.column(1).slice(i, j - i),
                        *map(pa.array, (n, known, np.full(j - i, model.tokens), base, own))
                    ],
                    schema=_SCORES
                )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text).cast("binary").alias("t")).transform(arrow_map, 
        run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )


def remainder(doc_id: str, modulus: int, value: int) -> Column:
    """Whether crc32 of the id as text leaves that remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == value, F.lit(False))


def score_held_out(docs: DataFrame, *, modulus: int = 7, held: int = 2) -> DataFrame:
    """Train on all but one residue class of the documents and score all of them."""
    out = remainder("doc_id", modulus, held)
    return score(docs, train(docs.where(~out)), held_out=out)
