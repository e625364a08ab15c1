"""Best-fit packing of token sequences after Martello and Toth's dominance reduction.

Only how many pieces there are of each length matters to the packing, and there are at most
`capacity` lengths: their counts go to the driver, however many documents there are. There a
reduction fixes small sets that dominate every other set with the same longest piece, and the
rest is packed best-fit, longest first. The result is a list of patterns with multiplicities; the
pieces of a length are numbered in parallel (by hash parts of bounded size, with the parts' counts
summed before each), and the number gives a piece its sequence and offset.

Null text is empty text, of one id (the end). Longer documents are cut into pieces of the
capacity; only the last may be shorter. Repeated rows are packed each.
"""

from __future__ import annotations

import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import _store
from ._hashing import slices
from ._worker import arrow_map, memos

Pattern = tuple[tuple[int, int], ...]


def reduce_dominated(count: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Fix dominating sets, taking their pieces from `count` (by length). A set with longest piece j is fixed if

    nothing fits beside j; or one piece fills j's sequence; or no two pieces fit beside j, and k is
    the longest that does; or no three fit, and k is no shorter than any two that fit together.
    """
    fixed: list[tuple[Pattern, int]] = []

    def fix(j: int, k: int) -> None:
        if k == 0:
            fixed.append((((j, 1),), int(count[j])))
            count[j] = 0
        elif k == j:
            fixed.append((((j, 2),), int(count[j]) // 2))
            count[j] %= 2
        else:
            m = int(min(count[j], count[k]))
            fixed.append((((j, 1), (k, 1)), m))
            count[j] -= m
            count[k] -= m

    while True:
        before = int(count.sum())
        for j in range(capacity, 0, -1):
            while count[j]:
                left = capacity - j
                others = count[: left + 1].copy()
                if j <= left:
                    others[j] -= 1
                sizes = np.flatnonzero(others)
                if not len(sizes):
                    fix(j, 0)
                    continue
                k = int(sizes[-1])
                short = np.repeat(sizes[:3], np.minimum(others[sizes[:3]], 3))[:3]
                two = int(short[:2].sum()) if len(short) > 1 else left + 1
                three = int(short.sum()) if len(short) > 2 else left + 1
                if k == left or two > left or (three > left and k >= _best_pair(others, sizes, left)):
                    fix(j, k)
                else:
                    break
        if int(count.sum()) == before:
            return [(p, m) for p, m in fixed if m]


def _best_pair(others: np.ndarray, sizes: np.ndarray, left: int) -> int:
    """The largest sum of two pieces that fit together."""
    best, i, j = 0, 0, len(sizes) - 1
    while i <= j:
        a, b = int(sizes[i]), int(sizes[j])
        if i == j and others[a] < 2:
            break
        if a + b > left:
            j -= 1
        else:
            best = max(best, a + b)
            i += 1
    return best


def best_fit(count: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing for many equal pieces at once: sequences of one content are one class."""
    room: dict[int, list[list]] = {}  # what is left -> classes of [pattern, how many]

    def put(left: int, pattern: Pattern, many: int) -> None:
        if many:
            room.setdefault(left, []).append([pattern, many])

    for size in np.flatnonzero(count)[::-1].tolist():
        n = int(count[size])
        while n:
            left = min((r for r in room if r >= size), default=None)
            if left is None:
                left, pattern, many = capacity, (), n
            else:
                pattern, many = room[left].pop()
                if not room[left]:
                    del room[left]
            each = min(left // size, n)
            full = min(n // each, many)
            put(left, pattern, many - full if pattern else 0)
            put(left - full_size, (*pattern, (size, each)), full) if (full_size := each * size) else None
            n -= each * full
    return [(p, m) for classes in room.values() for p, m in classes]


def pack_lengths(count: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns of (length, pieces) with multiplicities that hold exactly the counted pieces."""
    count = count.copy()
    return [*reduce_dominated(count, capacity), *best_fit(count, capacity)]


def places(patterns: list[tuple[Pattern, int]], capacity: int) -> dict[int, tuple[np.ndarray, ...]]:
    """By length, for runs of piece numbers: first number, first sequence, pieces a sequence, first offset."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    used = np.zeros(capacity + 1, np.int64)
    sequence = 0
    for pattern, many in patterns:
        at = 0
        for size, each in pattern:
            out.setdefault(size, []).append((int(used[size]), sequence, each, at))
            used[size] += each * many
            at += size * each
        sequence += many
    return {s: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for s, rows in out.items()}


def _tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    return t


_CLOSING = b".,;:!?"


def _visible() -> dict[int, int]:
    """The byte-level form's characters for bytes: printable ones stand for themselves, the others follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}


_VISIBLE = _visible()
_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
        ("ids_crc32", pa.int64())
    ]
)


class WordIds(dict):
    """Ids of words between white space, as bytes, worked out when first asked for (neither normalisation nor merges reach across white space)."""

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.one = self.tokenizer.model.tokenize
        self.old: dict[bytes, bytes] = {}

    def turn(self, most: int) -> None:
        """Beyond half of `most` words, what was used since the last turn is kept for one more."""
        if len(self) > most // 2:
            self.old = dict(self)
            self.clear()

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is not None:
            self[word] = ids
            return ids
        bare = word.rstrip(_CLOSING)
        if bare and len(bare) < len(word) and bare[-1:].isalnum():
            ids = self[bare] + self[word[len(bare) :]]  # closing punctuation after an ASCII letter or digit is a pre-token of its own
        else:
            text = word.decode("utf-8", "replace")
            form = unicodedata.normalize("NFC", text).lower() if text and max(text) < "\u0250" else ""
            if form.isalpha() and max(form) < "\u0250":  # one pre-token, so the model alone is needed
                found = [x.id for x in self.one(form if form.isascii() else form.encode().decode("latin-1").translate(_VISIBLE))]
            else:
                found = self.tokenizer.encode(text, add_special_tokens=False).ids
            ids = struct.pack(f"<{len(found)}I", *found)
        self[word] = ids
        return ids


def _encode(path: str, capacity: int, end: int, memo_words: int):
    """Pieces of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = struct.pack("<I", end)
        held = memos(__name__)  # kept from task to task
        memo = held[path] if path in held else held.setdefault(path, WordIds(path))
        for b in batches:
            docs, texts = b.column(0).to_pylist(), [x or b"" for x in b.column(1).to_pylist()]
            for i, j in slices(texts, 1 << 20):
                memo.turn(memo_words)
                rows = []
                for d, t in zip(docs[i:j], texts[i:j], strict=True):
                    ids = b"".join([*map(memo.__getitem__, t.lower().split()), tail])
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        rows.append((d, k, at // 4, len(part) // 4, zlib.crc32(part)))
                yield pa.RecordBatch.from_pydict({n: [r[c] for r in rows] for c, n in enumerate(_PIECES.names)}, schema=_PIECES)

    return run


_PLACED = pa.schema([*_PIECES, ("sequence_id", pa.int64()), ("offset", pa.int64())])


def _place(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length = table.value
        for b in batches:
            length, number = b.column(3).to_numpy(), b.column(5).to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for size in np.unique(length).tolist():
                own = np.flatnonzero(length == size)
                first, seq, each, at = by_length[size]
                run_of = np.searchsorted(first, number[own], side="right") - 1
                k = number[own] - first[run_of]
                sequence[own] = seq[run_of] + k // each[run_of]
                offset[own] = at[run_of] + k % each[run_of] * size
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset)], schema=_PLACED)

    return run


def pack(
    docs: DataFrame, tokenizer: str, *, text: str = "text", doc_id: str = "doc_id", capacity: int = 4096, end: int = 1,
    memo_words: int = 400_000, part_rows: int = 100_000
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. tokenizer: the file's path on every worker.

    The pieces of one length are numbered in hash parts of about `part_rows`, so a frequent length is not one task's.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("t"))
    pieces = _store.table(
        rows.transform(
            arrow_map, _encode(tokenizer, capacity, end, memo_words),
            "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
        ),
        "pieces"
    )
    count = np.zeros(capacity + 1, np.int64)
    for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect():  # at most capacity rows
        count[r["length"]] = r["n"]
    parts = [(size, 1 + int(count[size]) // part_rows) for size in np.flatnonzero(count).tolist()]
    dealt = F.broadcast(spark.createDataFrame(parts, "length bigint, parts bigint"))
    salted = (
        pieces.join(dealt, "length").withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.col("parts")))
        .select(*pieces.columns, "part")
    )
    before = {size: np.zeros(k, np.int64) for size, k in parts}
    for r in salted.groupBy("length", "part").agg(F.count("*").alias("n")).collect():  # at most capacity rows, and one for each part_rows pieces
        before[r["length"]][r["part"]] = r["n"]
    first = spark.sparkContext.broadcast({size: np.cumsum(n) - n for size, n in before.items()})
    table = spark.sparkContext.broadcast(places(pack_lengths(count, capacity), capacity))
    w = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    numbered = salted.withColumn("k", (F.row_number().over(w) - 1).cast("long")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "k", "part"
    )

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, part, number = (b.column(k).to_numpy() for k in (3, 6, 5))
            number = number.copy()
            for size in np.unique(length).tolist():
                own = length == size
                number[own] += first.value[size][part[own]]
            yield from _place(table)(
                iter([pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(number)], names=[*_PIECES.names, "number"])])
            )

    return numbered.transform(
        arrow_map, shift,
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    )
