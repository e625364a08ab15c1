"""Exact n-gram Jaccard join of documents: count-vector R-trees within lossless groups.

Tokens are the hashes of a text's distinct five-word shingles. Texts with one token set are one
class, so copies cost no pairs. Tokens that only one class has link nothing: all tokens are counted
exactly, by ranges of the hash, and a class keeps those that others share. In the common order
(rarest first) two sets that link share a token among the first few of each, so a class with more
tokens of its own than that prefix is long is done; the others meet in groups, one for each shared
token of their prefixes.

Every candidate comes from an R-tree: a class is a point of counts of its shared tokens by hash
group, and the coordinate minima of a node's upper corner and the point, summed, bound the overlap
from above. First each class is searched in its largest group only, where surviving pairs are
verified on the token sets at once and joined classes leave the search. Groups that still have
several components are then searched in full, but for pairs within one component, and these pairs
are verified on the token sets. A group of more than `group_rows` classes is dealt in chunks, so no
task gathers an unbounded group.

Tokens far above the mean (by a bounded counting sketch of all texts) come last in the order and
travel with their class rather than by their hash, so none is hot. Classes are told apart by two
64-bit hashes; should the first ever be equal for different sets, all is hashed anew.

Null and blank texts have no tokens and link with nothing. Fewer words than the size are one
shingle. Rows that repeat, or share an id with another text, each keep a row. A row of a null id
gets the least non-null id of its component, or null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from . import _store
from ._components import components
from ._hashing import U, mix, shingle_hashes, slices, word_hashes
from .lm_scoring import _batch, _planes, _unplanes, range_of
from ._worker import arrow_map

TOKEN_BITS = 48
#: Counters of the sketch, and how many travel together; a broadcast of one byte for each.
COUNTER_BITS, SLICE = 22, 1 << 17
#: Sums of a slice's counters are made in so many lanes first.
LANES = 256
#: Hash groups of a point; a count of 255 or more is stored as 255 and counts as without limit.
GROUPS = 256
LEAF = 16


def token_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 48-bit shingle hashes of each of up to 2^16 texts, ascending within a text, and each one's text."""
    words, counts = word_hashes(texts)
    h, n = shingle_hashes(words, counts, size)
    keys = np.repeat(np.arange(len(texts), dtype=np.uint64) << U(TOKEN_BITS), n) | (h >> U(64 - TOKEN_BITS))
    keys.sort()
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    keys = keys[new]
    return keys & U((1 << TOKEN_BITS) - 1), (keys >> U(TOKEN_BITS)).astype(np.int64)


def signatures(h: np.ndarray, doc: np.ndarray, texts: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The size of each token set, and a hash of it."""
    n = np.bincount(doc, minlength=texts)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(mix(h ^ mix(np.array([seed + 3], np.uint64))), out=sums[1:])
    ends = np.cumsum(n)
    return n, mix(sums[ends] - sums[ends - n] + n.astype(np.uint64))


class _New:
    """Which classes a task meets for the first time; forgets them all beyond a bound, so some may come twice."""

    def __init__(self, most: int = 1 << 20):
        self.seen, self.most = set(), most

    def __call__(self, cls: np.ndarray) -> np.ndarray:
        if len(self.seen) > self.most:
            self.seen.clear()
        return np.array([c not in self.seen and not self.seen.add(c) for c in cls.tolist()], bool)


def _texts(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[tuple]:
    """Batch, range of its rows, and the token sets of their texts."""
    for b in batches:
        texts = [x or b"" for x in b.column(column).to_pylist()]
        for i, j in slices(texts, 1 << 19):
            yield b, i, j, *token_sets(texts[i:j], size)


_SETS = pa.schema(
    [
        ("doc_id", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()), ("other", pa.int64()), ("slice", pa.int32()),
        ("lane", pa.int32()), ("counters", pa.binary())
    ]
)


def _describe(size: int, seed: int):
    """A row for each text, then the task's counters of tokens, in slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, is_new = np.zeros(1 << COUNTER_BITS, np.uint32), _New()
        for b, i, j, h, doc in _texts(batches, 1, size):
            n, cls = signatures(h, doc, j - i, seed)
            _, other = signatures(h, doc, j - i, ~seed & 0xFFFF)
            np.add.at(counters, (h[is_new(cls)[doc]] >> U(TOKEN_BITS - COUNTER_BITS)).astype(np.int64), np.uint32(1))
            none = pa.nulls(j - i)
            ids = [pa.array(x.view(np.int64)) for x in (cls, other)]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).slice(i, j - i), pa.array(n), *ids, none.cast(pa.int32()), none.cast(pa.int32()),
                    none.cast(pa.binary())
                ],
                schema=_SETS
            )
        lane = TaskContext.get().partitionId() % LANES
        yield _batch(
            _SETS,
            [
                (
                    None, None, None, None, k, lane, _packed(counters[k * SLICE : (k + 1) * SLICE])
                ) for k in range(len(counters) // SLICE) if counters[k * SLICE : (k + 1) * SLICE].any()
            ]
        )

    return run


def _packed(counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(counts.tobytes())


def _summed(t: pa.Table) -> np.ndarray:
    total = np.zeros(SLICE, np.uint64)
    for x in t.column("counters"):
        raw = zstandard.ZstdDecompressor().decompress(x.as_py())
        total += np.frombuffer(raw, np.uint32 if len(raw) == 4 * SLICE else np.uint64)
    return total


def _lane_sums(key: tuple, t: pa.Table) -> pa.Table:
    return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "counters": pa.array([_packed(_summed(t))], pa.binary())})


def _slice_levels(least: float):
    """Sums of a slice's counters as levels: 0 below `least`, then one for each doubling, to 15."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        level = np.clip(np.floor(np.log2(np.maximum(_summed(t), 1) / least)) + 1, 0, 15).astype(np.uint8)
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "levels": pa.array([_packed(level)], pa.binary())})

    return run


def _levels(sets: DataFrame, least: float) -> np.ndarray:
    """How frequent a counter's tokens are, a byte each."""
    lanes = (
        sets.where("slice IS NOT NULL").select("slice", "lane", "counters").groupBy("slice", "lane")
        .applyInArrow(_lane_sums, "slice int, counters binary")
    )
    out = np.zeros(1 << COUNTER_BITS, np.uint8)
    for r in lanes.groupBy("slice").applyInArrow(_slice_levels(least), "slice int, levels binary").collect():  # 4 MB at most in all
        out[r["slice"] * SLICE : (r["slice"] + 1) * SLICE] = np.frombuffer(
            zstandard.ZstdDecompressor().decompress(bytes(r["levels"])), np.uint8
        )
    return out


def _frame(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def _unframe(b: bytes) -> list[bytes]:
    parts, at = [], 0
    while at < len(b):
        n = int.from_bytes(b[at : at + 8], "little")
        parts.append(b[at + 8 : at + 8 + n])
        at += 8 + n
    return parts


def _six(x: np.ndarray) -> bytes:
    """48-bit values as six bytes each."""
    return x.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unsix(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _postings_block(token: np.ndarray, cls: np.ndarray) -> bytes:
    """Postings of ascending tokens; a class is named once, then by its number."""
    names, at = np.unique(cls, return_inverse=True)
    return _frame(_planes(token), names.tobytes(), at.astype(np.uint16 if len(names) <= 1 << 16 else np.uint32).tobytes())


def _postings(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    token, names, at = _unframe(b)
    names = np.frombuffer(names, np.uint64)
    return _unplanes(token), names[np.frombuffer(at, np.uint16 if len(names) <= 1 << 16 else np.uint32)]


def _shared_block(token: np.ndarray, cls: np.ndarray, count: np.ndarray) -> bytes:
    """Counted postings, ascending by class."""
    names, n = np.unique(cls, return_counts=True)
    return _frame(_six(token), names.tobytes(), _packed(n.astype(np.uint32)), _packed(np.minimum(count, 2**32 - 1).astype(np.uint32)))


def _shared(b: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    token, names, *small = _unframe(b)
    n, count = (np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint32) for x in small)
    return _unsix(token), np.repeat(np.frombuffer(names, np.uint64), n), count


def _own_block(cls: np.ndarray, n: np.ndarray, m: np.ndarray, token: np.ndarray, level: np.ndarray) -> bytes:
    """Classes, their sizes, and the m frequent tokens of each with their levels."""
    return _frame(cls.tobytes(), *(_packed(x.astype(np.uint64)) for x in (n, m)), _six(token), level.astype(np.uint8).tobytes())


def _own(b: bytes) -> tuple[np.ndarray, ...]:
    cls, n, m, token, level = _unframe(b)
    n, m = (np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint64).astype(np.int64) for x in (n, m))
    return np.frombuffer(cls, np.uint64), n, m, _unsix(token), np.frombuffer(level, np.uint8)


_BLOCKS = pa.schema([("part", pa.int32()), ("own", pa.bool_()), ("block", pa.binary())])
BLOCKS = "part int, own boolean, block binary"


def _by_part(part: np.ndarray, parts: int, own: bool, block, *columns: np.ndarray) -> list[tuple]:
    """Rows of blocks; part ascends."""
    bounds = np.searchsorted(part, np.arange(parts + 1))
    return [(k, own, block(*(c[i:j] for c in columns))) for k, (i, j) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if i < j]


def _deal_tokens(size: int, seed: int, levels, parts: int, chunk: int):
    """All tokens of each class by ranges of tokens, but the frequent ones, which go with their class's own block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        level, is_new, total = levels.value, _New(), 0

        def flush() -> pa.RecordBatch:
            token, cls = (np.concatenate(x) for x in zip(*kept, strict=True))
            kept.clear()
            order = np.argsort(token)
            token, cls = token[order], cls[order]
            return _batch(_BLOCKS, _by_part(range_of(token << U(64 - TOKEN_BITS), parts), parts, False, _postings_block, token, cls))

        for _, i, j, h, doc in _texts(batches, 0, size):
            n, cls = signatures(h, doc, j - i, seed)
            new = is_new(cls) & (n > 0)
            rank = level[(h >> U(TOKEN_BITS - COUNTER_BITS)).astype(np.int64)]
            rare, hot = new[doc] & (rank == 0), new[doc] & (rank > 0)
            kept.append((h[rare], cls[doc[rare]]))
            total += int(rare.sum())
            m = np.bincount(doc[hot], minlength=j - i)
            of = np.flatnonzero(new)
            of = of[np.argsort(cls[of])]
            first = np.cumsum(m) - m
            at = np.repeat(first[of] - (np.cumsum(m[of]) - m[of]), m[of]) + np.arange(int(m[of].sum()))
            token, rank, part = h[hot][at], rank[hot][at], range_of(cls[of], parts)
            bounds, ends = np.searchsorted(part, np.arange(parts + 1)), np.append(0, np.cumsum(m[of]))
            yield _batch(
                _BLOCKS,
                [
                    (
                        k, True,
                        _own_block(
                            cls[of[a:b]], n[of[a:b]], m[of[a:b]], token[ends[a] : ends[b]], rank[ends[a] : ends[b]]
                        )
                    ) for k,
                    (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if a < b
                ]
            )
            if total >= chunk:
                yield flush()
                total = 0
        if total:
            yield flush()

    return run


def _count_tokens(parts: int):
    """Tokens of two or more classes with their counts, by ranges of classes; own blocks are passed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = []
        for b in batches:
            own = b.column(1)
            yield b.filter(own)
            blocks += b.column(2).filter(pa.array([not x for x in own.to_pylist()])).to_pylist()
        if not blocks:
            return
        token, cls = (np.concatenate(x) for x in zip(*map(_postings, blocks), strict=True))
        del blocks
        order = np.lexsort((cls, token))
        token, cls = token[order], cls[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])
        token, cls = token[new], cls[new]
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        count = np.diff(np.append(first, len(token)))
        count = np.repeat(count, count)
        many = count > 1
        token, cls, count = token[many], cls[many], count[many]
        order = np.argsort(cls, kind="stable")
        cls = cls[order]
        yield _batch(_BLOCKS, _by_part(range_of(cls, parts), parts, False, _shared_block, token[order], cls, count[order]))

    return run


_POINTS = pa.schema(
    [
        ("node", pa.int64()), ("n", pa.int64()), ("vec", pa.binary()), ("tokens", pa.list_(pa.int64())),
        ("prefix", pa.list_(pa.int64()))
    ]
)
POINTS = "node bigint, n bigint, vec binary, tokens array<bigint>, prefix array<bigint>"


def prefix_length(n, percent: int):
    """How many first tokens of a set of n, in a common order, hold one of any set that it links with."""
    return n - -(-n * percent // 100) + 1


def count_vectors(h: np.ndarray, doc: np.ndarray, texts: int) -> np.ndarray:
    """How many tokens of each set fall to each hash group."""
    counts = np.bincount(doc * GROUPS + (mix(h) >> U(56)).astype(np.int64), minlength=texts * GROUPS).reshape(texts, GROUPS)
    return np.minimum(counts, 255).astype(np.uint8)


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), pa.array(values.view(np.int64)))


def _make_points(percent: int, most: int = 1 << 20):
    """The classes that have shared tokens in their prefixes: those, and all shared tokens. Batches of about `most` tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, posts = [], []
        for b in batches:
            for is_own, block in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                (own if is_own else posts).append(block)
        if not own:
            return
        names, n, m, hot, level = (np.concatenate(x) for x in zip(*map(_own, own), strict=True))
        names, first = np.unique(names, return_index=True)  # a class may come from several tasks
        from_own = np.repeat(np.arange(len(m)), m)
        keep = np.isin(from_own, first)
        at_first = np.zeros(len(m), np.int64)
        at_first[first] = np.arange(len(first))
        n = n[first]
        token, cls, count = (np.concatenate(x) for x in zip(*map(_shared, posts), strict=True)) if posts else (
            np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        )
        del own, posts
        at = np.concatenate([np.searchsorted(names, cls), at_first[from_own[keep]]])
        token = np.concatenate([token, hot[keep]])
        level = np.concatenate([np.zeros(len(count), np.uint8), level[keep]])
        count = np.concatenate([count, np.zeros(int(keep.sum()), np.uint32)])
        shared = np.bincount(at, minlength=len(names))
        take = np.minimum(prefix_length(n, percent) - (n - shared), shared)
        use = take[at] > 0
        token, at, level, count = token[use], at[use], level[use], count[use]
        order = np.lexsort((token, count, level, at))
        of, shared = np.flatnonzero(take > 0), shared[take > 0]
        starts = np.append(0, np.cumsum(shared))
        rank = np.arange(len(token)) - np.repeat(starts[:-1], shared)
        prefix, lengths = token[order][rank < np.repeat(take[of], shared)], take[of]
        token = token[np.lexsort((token, at))]
        ends = np.append(0, np.cumsum(lengths))
        i = 0
        while i < len(of):
            j = max(i + 1, int(np.searchsorted(starts, starts[i] + most, "right")) - 1)
            own_tokens = token[starts[i] : starts[j]]
            vec = count_vectors(own_tokens, np.repeat(np.arange(j - i), shared[i:j]), j - i)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names[of[i:j]].view(np.int64)), pa.array(n[of[i:j]]),
                    pa.array([v.tobytes() for v in vec], pa.binary()), _lists(own_tokens, shared[i:j]),
                    _lists(prefix[ends[i] : ends[j]], lengths[i:j])
                ],
                schema=_POINTS
            )
            i = j

    return run


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _vectors(col: pa.Array) -> np.ndarray:
    return _unlimited(np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(-1, GROUPS))


def _unlimited(stored: np.ndarray) -> np.ndarray:
    full = stored == 255
    return np.where(full, np.uint32(1 << 24), stored.astype(np.uint32)) if full.any() else stored


class CountVectorTree:
    """An R-tree over count vectors, packed by size and the most varied coordinates.

    A node keeps its upper corner, its range of sizes and the component of its points (-1: several).
    """

    def __init__(self, vec: np.ndarray, n: np.ndarray, root: np.ndarray):
        self.order, self.levels = self._tiles(vec, n), []
        hi, lo_n, hi_n = vec[self.order], n[self.order], n[self.order]
        while True:
            self.levels.append((hi, lo_n, hi_n))
            if len(hi) <= LEAF:
                break
            cut = np.arange(0, len(hi), LEAF)
            hi, lo_n, hi_n = np.maximum.reduceat(hi, cut, axis=0), np.minimum.reduceat(lo_n, cut), np.maximum.reduceat(hi_n, cut)
        self.label(root)

    def label(self, root: np.ndarray) -> None:
        """Set the components of the points."""
        of = root[self.order]
        self.of = [of]
        for _ in self.levels[1:]:
            cut = np.arange(0, len(of), LEAF)
            low = np.minimum.reduceat(of, cut)
            of = np.where(low == np.maximum.reduceat(of, cut), low, -1)
            self.of.append(of)

    @staticmethod
    def _tiles(vec: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Sort by size, cut into slabs, sort each by the most varied coordinate, cut and sort by the next."""
        by = np.argsort(n, kind="stable")
        pages = -(-len(n) // LEAF)
        if pages == 1:
            return by
        slab = LEAF * max(1, round(pages ** (2 / 3)))
        tile = LEAF * max(1, round(pages ** (1 / 3)))
        first, second = np.argsort(-vec.var(axis=0), kind="stable")[:2]
        for width, axis in ((slab, first), (tile, second)):
            by = by[np.lexsort((vec[by, axis], np.arange(len(by)) // width))]
        return by

    def search(self, vec: np.ndarray, n: int, root: int, percent: int) -> np.ndarray:
        """Positions of the points of other components whose bound with (vec, n) reaches the threshold."""
        least = -(-percent * n // 100)
        at = np.arange(len(self.levels[-1][0]))
        for k in range(len(self.levels) - 1, -1, -1):
            hi, lo_n, hi_n = self.levels[k]
            at = at[(self.of[k][at] != root) & (hi_n[at] >= least) & (lo_n[at] * percent <= 100 * n)]
            at = at[(100 + percent) * np.minimum(hi[at], vec).sum(1, dtype=np.int64) >= percent * (n + np.maximum(lo_n[at], least))]
            if k:
                at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
                at = at[at < len(self.levels[k - 1][0])]
        return self.order[at]


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The rows of one key at a time; they come sorted by the first `keys` columns."""
    rest: list[pa.Table] = []
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        key = np.stack([t.column(k).to_numpy() for k in range(keys)], 1)
        cut = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
        if rest and [rest[0].column(k)[0].as_py() for k in range(keys)] != key[0].tolist():
            yield pa.concat_tables(rest)
            rest = []
        for i, j in zip([0, *cut.tolist()], cut.tolist(), strict=False):
            yield pa.concat_tables([*rest, t.slice(i, j - i)])
            rest = []
        rest.append(t.slice(int(cut[-1]) if len(cut) else 0))
    if rest:
        yield pa.concat_tables(rest)


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two ascending arrays share."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def resolve(n: np.ndarray, tokens: np.ndarray, at: np.ndarray, percent: int) -> np.ndarray:
    """The component (a number) of each of a group's classes, by all links among them. at: where each one's tokens begin, and the end."""
    m = len(n)
    vec = _unlimited(count_vectors(tokens.view(np.uint64), np.repeat(np.arange(m), np.diff(at)), m))
    root = np.arange(m)
    tree = CountVectorTree(vec, n, root)
    for k in range(m):
        joined = {int(root[k])}
        for h in tree.search(vec[k], int(n[k]), int(root[k]), percent).tolist():
            if int(root[h]) not in joined and (100 + percent) * _overlap(
                tokens[at[k] : at[k + 1]], tokens[at[h] : at[h + 1]]
            ) >= percent * int(n[k] + n[h]):
                joined.add(int(root[h]))
        if len(joined) > 1:
            root[np.isin(root, list(joined))] = min(joined)
            tree.label(root)
    return root


def _resolved(percent: int):
    """Over rows sorted by group (token, chunk, node, n, tokens): a pair of each class with the least of its component there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 2):
            if t.num_rows < 2:
                continue
            node, n, lists = t.column(2).to_numpy(), t.column(3).to_numpy(), t.column(4).combine_chunks()
            order = np.argsort(node)
            lists = lists.take(pa.array(order))
            root = resolve(n[order], lists.values.to_numpy(), lists.offsets.to_numpy(), percent)
            node, least = node[order], node[order][root]
            yield pa.RecordBatch.from_arrays([pa.array(least[least != node]), pa.array(node[least != node])], schema=_PAIRS)

    return run


def tree_pairs(
    node: np.ndarray, vec: np.ndarray, n: np.ndarray, root: np.ndarray, probe: np.ndarray, percent: int, earlier=None
) -> np.ndarray:
    """Pairs (a < b) of a probe and another row, of different components, whose bound reaches the threshold.

    earlier(k): tokens before the group's that row k has; a pair that shares one of them is found there.
    """
    build = np.flatnonzero(~probe)
    if not len(build):
        return np.zeros((0, 2), np.int64)
    tree = CountVectorTree(vec[build], n[build], root[build])
    found = [np.zeros((0, 2), np.int64)]
    for k in np.flatnonzero(probe).tolist():
        hit = build[tree.search(vec[k], int(n[k]), int(root[k]), percent)]
        if earlier is not None:
            hit = hit[[earlier(k).isdisjoint(earlier(h)) for h in hit.tolist()]] if len(hit) else hit
        found.append(np.stack([np.minimum(node[hit], node[k]), np.maximum(node[hit], node[k])], 1))
    return np.concatenate(found)


def _searched(percent: int):
    """Over rows sorted by group (token, i, j, probe, node, root, n, vec, first): its pairs that the tree can't tell from links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 3):
            token, (node, root, n) = t.column(0)[0].as_py(), (t.column(k).to_numpy() for k in (4, 5, 6))
            numbers = np.unique(root, return_inverse=True)[1]
            first = t.column(8)
            earlier = lru_cache(maxsize=None)(lambda k, first=first, token=token: frozenset(x for x in first[k].as_py() if x < token))
            pairs = tree_pairs(node, _vectors(t.column(7).combine_chunks()), n, numbers, t.column(3).to_numpy(), percent, earlier)
            pairs = np.unique(pairs, axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=_PAIRS)

    return run


def _rooted(rows: DataFrame, comps: DataFrame) -> DataFrame:
    return rows.join(comps, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _largest_groups(postings: DataFrame, points: DataFrame, group_rows: int, hubs: int = 8) -> DataFrame:
    """Each class in its largest group. Chunks of one group have some hubs in common."""
    own = postings.groupBy("node").agg(F.max(F.struct("m", "token")).alias("g")).select("node", "g.m", "g.token")
    chunks = F.ceil(F.col("m") / group_rows).cast("int")
    hub = (chunks > 1) & (F.pmod(F.xxhash64("node", F.lit(7)), F.ceil(F.col("m") / hubs)) == 0)
    one = F.array(F.pmod(F.xxhash64("node"), chunks).cast("int"))
    dealt = own.withColumn("chunk", F.explode(F.when(hub, F.sequence(F.lit(0), chunks - 1)).otherwise(one)))
    return (
        dealt.join(points.select("node", "n", "tokens"), "node").select("token", "chunk", "node", "n", "tokens")
        .repartition("token", "chunk").sortWithinPartitions("token", "chunk")
    )


def _mixed_groups(rooted: DataFrame, points: DataFrame, group_rows: int, first: int = 64) -> DataFrame:
    """Groups of several components, once for each set of members: all classes against those not of the most frequent component.

    Each row has the least `first` such tokens of its class, by which a pair of several groups is left to its first; should
    that be further on in the list, the pair is found in more groups.
    """
    by_root = rooted.groupBy("token", "root").agg(
        F.count("*").alias("m"), *(F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"x{k}") for k in (1, 2))
    )
    by_token = (
        by_root.groupBy("token")
        .agg(
            F.count("*").alias("roots"), F.sum("m").alias("m"), F.max(F.struct("m", "root")).alias("most"),
            F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2")
        )
        .where("roots > 1")
    )
    groups = by_token.groupBy("m", "x1", "x2").agg(F.min(F.struct("token", "most")).alias("g"))
    groups = groups.select(
        "g.token", F.col("g.most.root").alias("most"), F.ceil(F.col("m") / group_rows).cast("int").alias("r"),
        F.ceil((F.col("m") - F.col("g.most.m")) / group_rows).cast("int").alias("s")
    )
    rows = rooted.join(groups, "token")
    firsts = rows.groupBy("node").agg(F.slice(F.array_sort(F.collect_list("token")), 1, first).alias("first"))
    rows = rows.join(points.select("node", "n", "vec").join(firsts, "node"), "node")
    at = lambda k: F.pmod(F.xxhash64("node"), F.col(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    probes = rows.where("root != most").withColumns({"probe": F.lit(True), "i": at("s")}).withColumn("j", every("r"))
    builds = rows.withColumns({"probe": F.lit(False), "j": at("r")}).withColumn("i", every("s"))
    return (
        probes.unionByName(builds).select("token", "i", "j", "probe", "node", "root", "n", "vec", "first")
        .repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    )


def _verified(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The linked ones among pairs (a, b), by their token sets."""
    for side in ("a", "b"):
        pairs = pairs.join(
            points.select(
                F.col("node").alias(side), F.col("n").alias(f"{side}_n"), F.col("tokens").alias(f"{side}_tokens")
            ),
            side
        )
    both = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return pairs.where((100 + percent) * both >= percent * (F.col("a_n") + F.col("b_n"))).select("a", "b")


def _sets(rows: DataFrame, size: int) -> tuple[DataFrame, DataFrame, int]:
    """Each text's size and class (and the counters), the classes with a document of each, and the seed of their hash."""
    seed = 0
    while True:
        sets = _store.table(
            rows.transform(
                arrow_map, _describe(size, seed),
                "doc_id bigint, n bigint, cls bigint, other bigint, slice int, lane int, counters binary"
            ),
            "sets"
        )
        found = (
            sets.where("n > 0").groupBy("cls")
            .agg(F.min("doc_id").alias("rep"), F.min("other").alias("low"), F.max("other").alias("high"))
        )
        classes = _store.table(found, "classes")
        if classes.where("low != high").isEmpty():
            return sets, classes.select("cls", "rep"), seed
        _store.drop(sets)
        _store.drop(classes)
        seed += 1


def link(
    docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", size: int = 5, percent: int = 80,
    part_tokens: int = 1_000_000, chunk_tokens: int = 1_000_000, group_rows: int = 512, hot_least: int = 1024,
    hot_times: int = 8
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    part_tokens: tokens to a range; chunk_tokens: tokens sorted in memory at once; a token is frequent
    if its counter has hot_least more than hot_times the mean.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("t"))
    sets, classes, seed = _sets(rows, size)
    total = sets.agg(F.sum("n")).first()[0] or 0
    parts = 1 + total // part_tokens
    levels = spark.sparkContext.broadcast(_levels(sets, hot_least + hot_times * total / (1 << COUNTER_BITS)))
    points = _store.table(
        rows.select("t")
        .transform(arrow_map, _deal_tokens(size, seed, levels, parts, chunk_tokens), BLOCKS)
        .repartitionById(parts, "part")
        .transform(arrow_map, _count_tokens(parts), BLOCKS)
        .repartitionById(parts, "part")
        .transform(arrow_map, _make_points(percent), POINTS),
        "points",
    )
    levels.destroy()
    postings = points.select("node", F.explode("prefix").alias("token"))
    many = postings.groupBy("token").agg(F.count("*").alias("m")).where("m > 1")
    postings = _store.table(postings.join(many, "token").select("token", "node", "m"), "postings")
    found = _store.table(
        _largest_groups(postings, points, group_rows).transform(arrow_map, _resolved(percent), "a bigint, b bigint"),
        "links"
    )
    rooted = _rooted(postings.select("token", "node"), components(found))
    likely = _store.table(
        _mixed_groups(rooted, points, group_rows).transform(arrow_map, _searched(percent), "a bigint, b bigint")
        .distinct(),
        "likely"
    )
    comps = _store.table(components(found.unionByName(_verified(likely, points, percent))), "components")
    for done in (points, postings, found, likely):
        _store.drop(done)
    least = _rooted(classes.withColumnRenamed("cls", "node"), comps)
    least = least.join(
        least.groupBy("root").agg(F.min("rep").alias("component_id")), "root"
    ).select(F.col("node").alias("cls"), "component_id")
    linked = sets.where("n > 0").join(least, "cls").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.unionByName(sets.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
