"""Exact top-k search by inner product over norm buckets.

Vectors are sorted by length, longest first, and written to files of bounded size, which a search
reads in that order, a bucket of like length after another. Queries are written to files too; a
task takes a group of queries and a section of the files, and holds one file of vectors and the
group's best so far. No query is copied for a bucket, and no pair of rows is ever a row.

A query's threshold is its k-th best product so far, at first that with the longest vectors. A
bucket whose longest vector can't reach it is passed over, and the vectors of a bucket are cut
where they become too short for it. The threshold over both lengths is the cosine that a partner
must have. Where that is high enough for the query's largest coordinates to prune, and a bucket
has so many coordinates that it pays, a partner's coordinates must lie in intervals around the
query's. What is left is verified by integer products, in floating point where that is exact.

Vectors that are null or hold null, NaN or infinite components, and rows without id, take no part.
Shorter vectors count as padded by zeros. Components past +-2^62, and products past 64 bits, are
held at the bound. Rows with a query's id are its own. Repeated rows count once, and an id with
several vectors, a query's too, gets the best over them. Ties go to the smaller id; of equal
vectors only the k + 1 smallest ids can be among a query's best, and only those are searched.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import _store
from ._worker import arrow_map

_VECTORS = pa.schema(
    [("vec_id", pa.int64()), ("query", pa.bool_()), ("norm", pa.float64()), ("wide", pa.bool_()), ("vec", pa.binary())]
)
_NARROW, _WIDE = np.int16, np.int64
_LEAST, _MOST = -(2**63), 2**63 - 1
#: Rows and bytes of a file of vectors, and components of a bucket or of a block of queries. A single longer vector is one of its own.
PACK_ROWS, PACK_BYTES, COMPONENTS = 65536, 8 << 20, 1 << 20


def quantise(values: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) as integers."""
    return np.clip(np.floor(values * scale), -(2.0**62), 2.0**62).astype(np.int64)


def _lengths(m: np.ndarray) -> np.ndarray:
    return np.sqrt((m.astype(np.float64) ** 2).sum(1))


def _quantise(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            size = np.asarray(pc.list_value_length(lists)).astype(np.int64)
            start = np.cumsum(size) - size
            x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null: NaN
            finite = np.isfinite(x)
            odd = np.concatenate([[0], np.cumsum(~finite)])
            whole = odd[start + size] == odd[start]
            w = quantise(np.where(finite, x, 0.0), scale)
            for d in np.unique(size[whole]).tolist():
                rows = np.flatnonzero(whole & (size == d))
                m = w[start[rows][:, None] + np.arange(d)]
                wide = (m != m.astype(_NARROW)).any(1)
                for is_wide, kind in ((False, _NARROW), (True, _WIDE)):
                    if (of := np.flatnonzero(wide == is_wide)).size:
                        at, v = pa.array(rows[of]), np.ascontiguousarray(m[of], kind)
                        ends = np.arange(len(of) + 1, dtype=np.int32) * (d * v.itemsize)
                        data = pa.Array.from_buffers(pa.binary(), len(of), [None, pa.py_buffer(ends), pa.py_buffer(v.tobytes())])
                        yield pa.RecordBatch.from_arrays(
                            [b.column(0).take(at), b.column(1).take(at), pa.array(_lengths(v)), pa.array([is_wide] * len(of)), data],
                            schema=_VECTORS,
                        )

    return run


_PACKS = pa.schema([("name", pa.string()), ("rows", pa.int64()), ("longest", pa.float64())])


def _pack(folder: str, copies: int | None = None):
    """Rows (id, wide, vec) as they come in files of bounded size. copies: of vectors that are equal and follow one another, so many ids."""

    def save(ids: list[int], vecs: list[bytes], kinds: list[np.dtype]) -> pa.RecordBatch:
        rows = [np.frombuffer(v, kind) for v, kind in zip(vecs, kinds, strict=True)]
        m = np.zeros((len(rows), max(map(len, rows))), max(kinds, key=lambda kind: kind.itemsize))
        if len(set(map(len, rows))) == 1:
            np.stack(rows, out=m)
        else:
            for to, r in zip(m, rows, strict=True):
                to[: len(r)] = r
        norm, whole, name = _lengths(m), io.BytesIO(), uuid.uuid4().hex
        np.savez(whole, ids=np.array(ids, np.int64), vecs=m, norm=norm)
        _store.write(f"{folder}/{name}", whole.getvalue())
        return pa.RecordBatch.from_pydict({"name": [name], "rows": [len(ids)], "longest": [float(norm.max())]}, schema=_PACKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vecs, kinds, width, item = [], [], [], 0, 1
        last, last_id, seen = None, None, 0
        for b in batches:
            for i, is_wide, v in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if copies is not None:
                    if last == (is_wide, v):
                        if last_id == i or seen == copies:
                            continue
                        seen += 1
                    else:
                        last, seen = (is_wide, v), 1
                    last_id = i
                kind = np.dtype(_WIDE if is_wide else _NARROW)
                d = len(v) // kind.itemsize
                width, item = max(width, d), max(item, kind.itemsize)
                if ids and (len(ids) == PACK_ROWS or (len(ids) + 1) * width * item > PACK_BYTES):
                    yield save(ids, vecs, kinds)
                    ids, vecs, kinds, width, item = [], [], [], d, kind.itemsize
                ids.append(i)
                vecs.append(v)
                kinds.append(kind)
        if ids:
            yield save(ids, vecs, kinds)

    return run


def _load(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, vectors and lengths of a file."""
    with _store.open_read(path) as f, np.load(io.BytesIO(f.read())) as held:
        return held["ids"], held["vecs"], held["norm"]


def _kinds(reach: np.ndarray) -> np.ndarray:
    """Which arithmetic is exact where no product of lengths is larger, so no sum on the way either: of 32 bits 0, of 64 bits 1, of whole numbers 2."""
    return (reach >= 2**24).astype(np.int64) + (reach >= 2**53)


_FORMS = (np.float32, np.float64, object)


def products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """All inner products, exact, of vectors in a form that is; the longer ones' further components meet zeros."""
    d = min(q.shape[1], p.shape[1])
    whole = q[:, :d] @ p[:, :d].T
    return np.clip(whole, _LEAST, _MOST).astype(np.int64) if whole.dtype == object else whole


class _Rows:
    """Vectors in the forms that they are asked for."""

    def __init__(self, ids: np.ndarray, vecs: np.ndarray, norm: np.ndarray):
        self.ids, self.vecs, self.norm = ids, vecs, norm
        self._forms: dict[int, np.ndarray] = {}

    def form(self, kind: int) -> np.ndarray:
        if kind not in self._forms:
            self._forms[kind] = self.vecs.astype(_FORMS[kind])
        return self._forms[kind]


class Block(_Rows):
    """Queries, and the best of each so far."""

    def __init__(self, ids: np.ndarray, vecs: np.ndarray, norm: np.ndarray, k: int):
        super().__init__(ids, vecs, norm)
        peak = np.abs(vecs.astype(np.float64)).max(1, initial=0.0)
        self.peak = peak / np.maximum(norm, 1e-300)
        self.floor = np.full(len(ids), _LEAST, np.int64)
        self.score, self.held = np.full((len(ids), k), _LEAST, np.int64), np.full((len(ids), k), _MOST, np.int64)

    def theta(self) -> np.ndarray:
        """The least product that can still be among a query's best."""
        return np.maximum(self.floor, self.score[:, -1])

    def seed(self, seeds: _Rows) -> None:
        """A first threshold: the k-th best with the seeds, each of an id of its own."""
        k = self.score.shape[1]
        kinds = _kinds(self.norm * seeds.norm.max(initial=0.0))
        for kind in np.unique(kinds).tolist():
            rows = np.flatnonzero(kinds == kind)
            for r, s in zip(rows.tolist(), products(self.form(kind)[rows], seeds.form(kind)), strict=True):
                s = s[seeds.ids != self.ids[r]]
                if len(s) >= k:
                    self.floor[r] = int(np.partition(s, -k)[-k])

    def offer(self, r: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Take what is better than the worst that is held. r: the queries' places."""
        worst, worst_id = self.score[r, -1], self.held[r, -1]
        keep = (ids != self.ids[r]) & ((scores > worst) | ((scores == worst) & (ids < worst_id)))
        if not keep.any():
            return
        r, ids, scores = r[keep], ids[keep], scores[keep]
        rows, k = np.unique(r), self.score.shape[1]
        r = np.concatenate([np.repeat(rows, k), r])
        ids, scores = np.concatenate([self.held[rows].ravel(), ids]), np.concatenate([self.score[rows].ravel(), scores])
        at = np.lexsort((~scores, ids, r))  # ~: from the highest on, without overflow
        at = at[np.concatenate([[True], (np.diff(r[at]) != 0) | (ids[at][1:] != ids[at][:-1])])]  # an id once, by its best
        at = at[np.lexsort((ids[at], ~scores[at], r[at]))]
        rank = np.arange(len(at)) - np.searchsorted(r[at], r[at])
        at, rank = at[rank < k], rank[rank < k]
        self.score[rows], self.held[rows] = _LEAST, _MOST
        self.score[r[at], rank], self.held[r[at], rank] = scores[at], ids[at]

    def found(self) -> pa.RecordBatch:
        r, j = np.nonzero((self.score > _LEAST) | (self.held < _MOST))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (self.ids[r], self.held[r, j], self.score[r, j])], schema=_FOUND)


def can_reach(block: Block, longest: float) -> np.ndarray:
    """The queries that a vector of this length, or a shorter one, can still matter for."""
    return block.norm * longest * (1 + 1e-12) + 0.5 >= block.theta()


class Bucket(_Rows):
    """Vectors of like length, longest first, with their coordinates sorted as they are asked for."""

    def __init__(self, ids: np.ndarray, vecs: np.ndarray, norm: np.ndarray):
        super().__init__(ids, vecs, norm)
        self._sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _unit(self, f: int, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        return self.vecs[at, f] / np.maximum(self.norm[at], 1e-300)

    def _axis(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self._sorted:
            unit = self._unit(f)
            order = np.argsort(unit, kind="stable")
            self._sorted[f] = order, unit[order]
        return self._sorted[f]

    def by_length(self, norm: np.ndarray, theta: np.ndarray) -> int:
        """How many are long enough for some of the queries to reach its theta."""
        if not len(norm) or (theta <= 0).any() or not norm.all():
            return len(self.ids)
        least = ((theta - 0.5) / norm * (1 - 1e-12)).min()
        return int(np.searchsorted(-self.norm, -least, side="right"))

    def by_coordinate(self, q: np.ndarray, q_norm: float, cosine: float, focus: int) -> np.ndarray:
        """Those whose focus coordinates lie where a vector of that cosine with q must have them."""
        unit = q / q_norm
        found: np.ndarray | None = None
        for f in np.argsort(-np.abs(unit), kind="stable")[:focus]:
            wide = np.sqrt(max(0.0, (1 - cosine**2) * (1 - unit[f] ** 2))) + 1e-9
            low, high = unit[f] * cosine - wide, unit[f] * cosine + wide
            if unit[f] >= cosine:
                high = 1.0 + 1e-9
            if unit[f] <= -cosine:
                low = -1.0 - 1e-9
            if f >= self.vecs.shape[1]:  # zeros all
                if not low <= 0 <= high:
                    return np.arange(0)
            elif found is None:
                order, values = self._axis(int(f))
                found = order[np.searchsorted(values, low) : np.searchsorted(values, high, side="right")]
            else:
                x = self._unit(int(f), found)
                found = found[(x >= low) & (x <= high)]
        return np.arange(len(self.ids)) if found is None else np.sort(found)

    def search(self, block: Block, *, steep: float = 0.6, focus: int = 3, pays: int = 1 << 20) -> bool:
        """Offer the queries what can be among their best; whether there was a query that could be reached.

        Coordinates prune from the cosine `steep` on, where the interval of a query's largest one leaves out zero and the
        bucket has `pays` components: a search for one query alone costs as much as products with so many.
        """
        longest, theta = float(self.norm[0]), block.theta().astype(np.float64)
        go = can_reach(block, longest)
        if not go.any():
            return False
        reach = block.norm * longest
        cosine = (theta - 0.5) / np.maximum(reach, 1.0) * (1 - 1e-12)  # a length is 0, or 1 at least
        alone = go & (cosine >= steep) & (cosine <= 1) & (cosine**2 + block.peak**2 > 1) & (self.vecs.size >= pays)
        kinds = _kinds(reach)
        for i in np.flatnonzero(alone).tolist():
            at = self.by_coordinate(block.vecs[i], float(block.norm[i]), float(cosine[i]), focus)
            form = _FORMS[kinds[i]]
            scores = products(block.vecs[i : i + 1].astype(form), self.vecs[at].astype(form))[0]
            block.offer(np.full(len(at), i), self.ids[at], scores.astype(np.int64))
        for kind in range(len(_FORMS)):
            rows = np.flatnonzero(go & ~alone & (kinds == kind))
            if not len(rows):
                continue
            n = self.by_length(block.norm[rows], theta[rows])
            q = block.form(kind)
            scores = products(q if len(rows) == len(q) else q[rows], self.form(kind)[:n])
            least = block.theta()[rows].astype(scores.dtype)
            if len(some := np.flatnonzero(scores.max(1, initial=_LEAST) >= least)):  # few, once thresholds are high
                if len(some) < len(rows):
                    rows, least, scores = rows[some], least[some], scores[some]
                hits = np.flatnonzero(scores >= least[:, None])
                r, c = np.divmod(hits, n)
                block.offer(rows[r], self.ids[c], scores.ravel()[hits].astype(np.int64))
        return True


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _slices(path: str, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """A file's rows, so many or fewer at a time, and no more components than COMPONENTS."""
    ids, vecs, norm = _load(path)
    step = max(1, min(rows, COMPONENTS // max(1, vecs.shape[1])))
    for a in range(0, len(ids), step):
        yield ids[a : a + step], vecs[a : a + step], norm[a : a + step]


def _search(folder: str, groups: list, sections: list, k: int, seeds: int, bucket_rows: int, block_rows: int):
    """Of the task numbers of pairs of a group of queries and a section of the vectors; sections: of files' names and longest lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n in b.column(0).to_pylist():
                group, section = groups[n // len(sections)], sections[n % len(sections)]
                blocks = [Block(*s, k) for s in _slices(f"{folder}/{group}", block_rows)]
                ids, vecs, norm = next(_slices(f"{folder}/{sections[0][0][0]}", seeds))
                own = np.sort(np.unique(ids, return_index=True)[1])
                for block in blocks:
                    block.seed(_Rows(ids[own], vecs[own], norm[own]))
                for name, longest in section:
                    if not any(can_reach(block, longest).any() for block in blocks):
                        break
                    for s in _slices(f"{folder}/{name}", bucket_rows):
                        bucket = Bucket(*s)
                        if not any([bucket.search(block) for block in blocks]):  # a list: each block is searched
                            break
                yield from (block.found() for block in blocks)

    return run


def search(
    vectors: DataFrame, is_query: Column, *, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 5, scale: float = 256.0,
    bucket_rows: int = 2048, block_rows: int = 512, seeds: int = 1024, group_blocks: int = 4, section_rows: int = 1 << 21,
    part_rows: int = 65536, least_parts: int = 8, most_tasks: int = 16384,
) -> DataFrame:
    """Each query's k best rows by inner product of floor(scale * x): query_id, rank, vec_id, score.

    Vectors are sorted in parts of about `part_rows`. A task searches some `section_rows` of them for about `group_blocks`
    blocks of `block_rows` queries; beyond `most_tasks` pairs of a section and a group, a task searches several, one after
    another. The driver knows the files' names.
    """
    spark = vectors.sparkSession
    schema = "vec_id bigint, query boolean, norm double, wide boolean, vec binary"
    rows = vectors.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull()).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("query"),
        F.col(embedding).alias("e")
    )
    rows = _store.table(rows.transform(arrow_map, _quantise(scale), schema), "vectors")
    folder = _store.new_dir(spark, "packs")
    manifest = "name string, rows bigint, longest double"
    row = ["vec_id", "wide", "vec"]

    parts = max(least_parts, -(-rows.count() // part_rows))
    by = [F.desc("norm"), F.col("mark"), F.col("vec_id")]  # equal vectors follow one another
    ordered = rows.withColumn("mark", F.xxhash64("wide", "vec")).repartitionByRange(parts, *by).sortWithinPartitions(*by)
    files = ordered.select(row).transform(arrow_map, _pack(folder, copies=k + 1), manifest).collect()
    queries = rows.where("query").select(row)
    parts = max(least_parts, -(-queries.count() // (group_blocks * block_rows)))
    queries = queries.dropDuplicates().repartition(parts)
    groups = [r["name"] for r in queries.transform(arrow_map, _pack(folder), manifest).collect()]
    _store.drop(rows)

    sections, held = [], section_rows
    for f in sorted(files, key=lambda f: -f["longest"]):
        if held >= section_rows:
            sections, held = [*sections, []], 0
        sections[-1].append((f["name"], f["longest"]))
        held += f["rows"]
    tasks = len(groups) * len(sections)
    found = spark.range(0, tasks, 1, max(1, min(tasks, most_tasks))).transform(
        arrow_map, _search(folder, groups, sections, k, seeds, bucket_rows, block_rows), "query_id bigint, vec_id bigint, score bigint"
    )
    single = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return single.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
