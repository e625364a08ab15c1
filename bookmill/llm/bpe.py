"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, the rest by a heap over linked bytes.

A text is split by the pattern of its ranks file. A pre-token that is itself in the vocabulary is
found at one slot of a minimal perfect hash (hash and displace: built once on the driver, of the
vocabulary's size, shared by broadcast). Any other is merged: its bytes are a linked list, the
pairs of neighbours that have a rank a heap, and the pair of least rank, leftmost first, is joined
until none is left.

Pre-tokens don't reach over the start of white space, so a text is taken apart there, and what a
worker has encoded it remembers from task to task, up to `memo_entries`: the older half is forgotten
at a time. Texts with white space outside ASCII are split whole. Letters and numbers are those of
Unicode 16, as in the tiktoken library, whatever the installed `regex` knows. Null text is empty
text, of no ids.
"""

from __future__ import annotations

import base64
import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, functions as F

from ._hashing import U, mix, slices
from ._worker import arrow_map, memos


def load_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a ranks file: base64 and number by line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PerfectHash:
    """A minimal perfect hash of a vocabulary: each token has a slot of its own among as many slots as tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        keys = list(ranks)
        n = self.n = max(len(keys), 1)
        self.buckets = max(1, n // 3)
        h = self.hashes(keys)
        self.shift = np.zeros(self.buckets, np.int64)
        free = np.ones(n, bool)
        own = (h % U(self.buckets)).astype(np.int64)
        order = np.argsort(own, kind="stable")
        size = np.bincount(own, minlength=self.buckets)
        first = np.cumsum(size) - size
        slot = np.zeros(len(keys), np.int64)
        for b in np.argsort(-size, kind="stable").tolist():
            at = order[first[b] : first[b] + size[b]]
            if size[b] < 2:
                break
            step, s = 0, None
            while s is None:
                tried = self._slots(h[at][:, None], np.arange(step, step + 64))
                for k in np.flatnonzero(free[tried].all(0)).tolist():
                    if len(set(tried[:, k].tolist())) == len(at):
                        step, s = step + k, tried[:, k]
                        break
                else:
                    step += 64
            self.shift[b], slot[at], free[s] = step, s, False
        alone = np.flatnonzero(size == 1)
        left = np.flatnonzero(free)[: len(alone)]
        slot[order[first[alone]]], self.shift[alone] = left, -left - 1
        self.keys: list[bytes] = [b""] * n
        self.ids = np.zeros(n, np.int64)
        for k, s in zip(keys, slot.tolist(), strict=True):
            self.keys[s], self.ids[s] = k, ranks[k]

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))

    def _slots(self, h: np.ndarray, step: np.ndarray) -> np.ndarray:
        return (mix(h + step.astype(np.uint64) * U(0x9E3779B97F4A7C15)) % U(self.n)).astype(np.int64)

    def lookup(self, tokens: list[bytes]) -> np.ndarray:
        """Each token's id, -1 if it isn't in the vocabulary."""
        if not tokens:
            return np.zeros(0, np.int64)
        h = self.hashes(tokens)
        step = self.shift[(h % U(self.buckets)).astype(np.int64)]
        slot = np.where(step < 0, -step - 1, self._slots(h, np.maximum(step, 0)))
        same = np.fromiter((self.keys[s] == t for s, t in zip(slot.tolist(), tokens, strict=True)), bool, len(tokens))
        return np.where(same, self.ids[slot], -1)


def merge(token: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token: merges by least rank, leftmost first. Bytes with no rank of their own raise KeyError."""
    n, get = len(token), ranks.get
    after, before = list(range(1, n + 1)), list(range(-1, n))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(token[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        mid = after[i]
        if mid < 0 or mid >= end or after[mid] != end:
            continue  # one of the two was joined to something else
        after[i], after[mid] = end, -1
        if end < n:
            before[end] = i
            if (r := get(token[i : after[end]])) is not None:
                heapq.heappush(heap, (r, i, after[end]))
        if (p := before[i]) >= 0 and (r := get(token[p:end])) is not None:
            heapq.heappush(heap, (r, p, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[token[i : after[i]]])
        i = after[i]
    return out


#: White space and separators beyond ASCII's, where Python's and the pattern's notions may differ.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")
_SEGMENT = re.compile(r"\s*\S+|\s+")
#: First and last code points that are unassigned in Unicode 16, which the tiktoken library's
#: patterns go by, and letters or numbers in later versions, which `regex` may know.
_LATER = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F),
    (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1),
    (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A),
    (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686),
    (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E),
    (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)
_UNASSIGNED = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in _LATER) + "]")
#: Stands for them when a text is split: neither letter, number nor space in any version.
_STAND_IN = "\ue000"


_ONE = struct.Struct("<I").pack


class Encoder:
    """Encodes texts with a vocabulary, a perfect hash of it and a pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, hashed: PerfectHash, memo_entries: int = 300_000):
        self.ranks, self.hashed, self.memo_entries = ranks, hashed, memo_entries
        self._pattern = regex.compile(pattern)
        self._tokens: dict[str, bytes] = {}
        self._segments: dict[str, bytes] = {}
        self._old_tokens: dict[str, bytes] = {}
        self._old_segments: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        """The pattern's matches by Unicode 16."""
        if text.isascii() or not _UNASSIGNED.search(text):
            return self._pattern.findall(text)
        return [text[m.start() : m.end()] for m in self._pattern.finditer(_UNASSIGNED.sub(_STAND_IN, text))]

    def _learn(self, segments: set[str]) -> None:
        parts = {s: self.split(s) for s in segments}
        new = list({t for ts in parts.values() for t in ts}.difference(self._tokens))
        old = self._old_tokens.get
        unknown = [t for t in new if (ids := old(t)) is None or not self._keep(t, ids)]
        raw = [t.encode("utf-8", "replace") for t in unknown]
        for t, b, k in zip(unknown, raw, self.hashed.lookup(raw).tolist(), strict=True):
            if k < 0:
                ids = merge(b, self.ranks)
                self._tokens[t] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                self._tokens[t] = _ONE(k)
        get = self._tokens.__getitem__
        for s, ts in parts.items():
            self._segments[s] = get(ts[0]) if len(ts) == 1 else b"".join(map(get, ts))

    def _keep(self, token: str, ids: bytes) -> bool:
        self._tokens[token] = ids
        return True

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [[t] if _ODD_SPACE.search(t) else _SEGMENT.findall(t) for t in texts]
        here = set().union(*split)
        if len(self._segments) > self.memo_entries // 2:  # what was used since the last turn is kept for one more
            self._old_segments, self._segments = self._segments, {}
            self._old_tokens, self._tokens = self._tokens, {}
        if new := here.difference(self._segments):
            kept = new.intersection(self._old_segments)
            self._segments.update(zip(kept, map(self._old_segments.__getitem__, kept), strict=True))
            if len(kept) < len(new):
                self._learn(new - kept)
        get = self._segments.__getitem__
        return [b"".join(map(get, s)) for s in split]


def _keep(docs: DataFrame, keep: list[str]) -> str:
    return ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
    memo_entries: int = 700_000
) -> DataFrame:
    """The columns `keep` and `ids`: each text's ids as little-endian unsigned 32-bit integers."""
    ranks = load_ranks(ranks_path)
    shared = docs.sparkSession.sparkContext.broadcast((ranks, PerfectHash(ranks)))  # of the vocabulary's size
    k = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = memos(__name__), (ranks_path, pattern, memo_entries)
        if key not in held:
            held.clear()
            held[key] = Encoder(shared.value[0], pattern, shared.value[1], memo_entries)
        encoder = held[key]
        for b in batches:
            texts = [x or "" for x in b.column(k).to_pylist()]
            for i, j in slices(texts, 1 << 20):
                yield pa.RecordBatch.from_arrays(
                    [
                        *(b.column(c).slice(i, j - i) for c in range(k)),
                        pa.array(encoder.encode(texts[i:j]), pa.binary())
                    ],
                    names=[*keep, "ids"]
                )

    return docs.select(*keep, F.col(text).alias("__text")).transform(arrow_map, run, f"{_keep(docs, list(keep))}, ids binary")


def decode(encoded: DataFrame, ranks_path: str, *, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """All columns, and the bytes that the ids stand for."""
    ranks = load_ranks(ranks_path)
    by_id: list[bytes] = [b""] * (max(ranks.values(), default=0) + 1)
    for t, r in ranks.items():
        by_id[r] = t
    shared = encoded.sparkSession.sparkContext.broadcast(by_id)
    at = encoded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.__getitem__
        for b in batches:
            whole = [b"".join(map(token, np.frombuffer(x or b"", "<u4").tolist())) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(whole, pa.binary())], names=[*b.schema.names, into])

    return encoded.transform(arrow_map, run, f"{_keep(encoded, encoded.columns)}, `{into}` binary")
