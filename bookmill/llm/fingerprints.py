"""Document fingerprints by one-permutation MinHash, with DataFrame functions only.

A text's shingles (runs of five lower-cased words; all words if fewer) are hashed once. The
hash's top byte names one of 256 bins, the rest is the value of which each bin keeps the least.
An empty bin takes the value of another, found by probing the bins in an order of its own until
one is filled (optimal densification: the order depends on the bin alone, never on the text).
The low 8 bits of each value are packed to hexadecimal. Two fingerprints' share of equal bins,
less the 1/256 that agree by chance, estimates the Jaccard index of the shingle sets.

A text without words has the empty fingerprint; it is like another empty one (1) and unlike
any other (0). Null text is empty text. Null ids come before all others. Of rows with one id,
the order of texts decides.
"""

from __future__ import annotations

import random
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

BINS, VALUE_BITS, LOW_BITS = 256, 56, 8
_VALUE = (1 << VALUE_BITS) - 1
_PROBES = 10
WHITE = " \t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once a row however often body refers to it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _numbers(values: list[int], kind: str) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _words(text: Column) -> Column:
    bare = F.btrim(F.lower(text), F.lit(WHITE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def _probe_orders() -> tuple[list[int], list[int]]:
    """For each bin, start and odd step of a walk through all bins."""
    rng = random.Random(20141)
    return [rng.randrange(BINS) for _ in range(BINS)], [2 * rng.randrange(BINS // 2) + 1 for _ in range(BINS)]


def bin_values(text: Column, shingle: int = 5) -> Column:
    """The low bits (less 128) of all bins after densification; no element for a text without words."""
    starts, steps = (_numbers(x, "int") for x in _probe_orders())
    marks = _numbers([(b << VALUE_BITS) | _VALUE for b in range(-BINS // 2, BINS // 2)], "bigint")

    def hashes(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(w) - shingle + 1, F.lit(1))),
            lambda i: F.xxhash64(F.slice(w, i, shingle))
        )

    def least(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, VALUE_BITS) != F.shiftright(F.get(s, i - 1), VALUE_BITS)))

    def filled(m: Column) -> Column:
        def value(at: Column) -> Column:
            return F.nullif(F.get(m, at).bitwiseAND(F.lit(_VALUE)), F.lit(_VALUE))

        def probe(j: Column, t: Column) -> Column:
            return value((F.get(starts, j) + t * F.get(steps, j)) % BINS)

        def of(j: Column) -> Column:
            rest = F.filter(F.transform(F.sequence(F.lit(_PROBES), F.lit(BINS - 1)), lambda t: probe(j, t)), lambda v: v.isNotNull())
            return F.coalesce(value(j), *(probe(j, F.lit(t)) for t in range(_PROBES)), F.get(rest, F.lit(0)))

        return F.transform(
            F.sequence(F.lit(0), F.lit(BINS - 1)),
            lambda j: (of(j).bitwiseAND(F.lit((1 << LOW_BITS) - 1)) - 128).cast("tinyint")
        )

    return let(
        _words(text),
        lambda w: F.when(F.size(w) == 0, F.array().cast("array<tinyint>")).otherwise(
            let(let(F.sort_array(F.concat(hashes(w), marks)), least), filled)
        ),
    )


def pack(values: Column) -> Column:
    """The bins' low bits as hexadecimal text."""
    digits = F.split(F.lit(",".join(f"{x:02x}" for x in range(256))), ",")
    return F.array_join(F.transform(values, lambda v: F.get(digits, v.cast("int") + 128)), "")


def likeness(a: Column, b: Column) -> Column:
    """The estimated Jaccard index of two fingerprints' shingle sets."""
    chance = 2.0**-LOW_BITS

    def of(x: Column, y: Column) -> Column:
        same = F.size(F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.get(x, i) == F.get(y, i))) / F.lit(float(BINS))
        return F.greatest(F.lit(0.0), (same - chance) / (1.0 - chance))

    return F.when(
        (F.size(a) == 0) | (F.size(b) == 0), ((F.size(a) == 0) & (F.size(b) == 0)).cast("double")
    ).otherwise(let(a, lambda x: let(b, lambda y: of(x, y))))


def _blocks(key: Column, docs: DataFrame, rows: int, most: int) -> tuple[Column, Column, int]:
    """The block of a row, its least key, and the number of blocks: ranges of keys of about `rows` rows, at most `most` of them."""
    n = docs.count()
    cuts = max(1, min(most, -(-n // rows)))
    least, inner = docs.agg(F.min(key), F.percentile_approx(key, [k / cuts for k in range(1, cuts)] or [0.0], 10 * most)).first()
    bounds = sorted({least, *(inner or [])} - {None}) or [0]
    at = _numbers(bounds, "bigint")
    steps = _numbers([1 << k for k in range(len(bounds).bit_length(), -1, -1)], "int")
    block = F.aggregate(
        steps, F.lit(0),
        lambda low, s: F.when((low + s < len(bounds)) & (F.get(at, low + s) <= key), low + s).otherwise(low)
    )
    return block, F.get(at, F.col("_block")), len(bounds)


def with_next(docs: DataFrame, key: Column, columns: list[str], *, rows: int = 1024, most: int = 16384) -> DataFrame:
    """Each row with the `columns` of the next row by key as next_<column>; after the last comes the first.

    Rows are dealt once, by blocks of keys; the first row of a block is also sent, marked, to
    the block before it, so that no sort is global.
    """
    block, start, n = _blocks(F.col("_key"), docs.select(key.alias("_key")), rows, most)
    placed = docs.withColumn("_key", key).withColumn("_block", block).withColumn("_start", start)
    own = F.struct(F.col("_block").alias("at"), F.lit(0).alias("mark"))
    before = F.struct(((F.col("_block") + n - 1) % n).alias("at"), F.lit(1).alias("mark"))
    dealt = placed.withColumn("_to", F.explode(F.when(F.col("_key") == F.col("_start"), F.array(own, before)).otherwise(F.array(own))))
    w = Window.partitionBy("_to.at").orderBy("_to.mark", "_key", *columns)
    return (
        dealt.select("*", *(F.lead(c).over(w).alias(f"next_{c}") for c in columns)).where(F.col("_to.mark") == 0)
        .drop("_key", "_block", "_start", "_to")
    )


def fingerprint(docs: DataFrame, *, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """The packed fingerprint of each row's text."""
    return docs.withColumn(into, pack(bin_values(F.coalesce(F.col(text), F.lit("")))))


def fingerprint_edits(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Fingerprints of each text and of its edit: its last quarter replaced by the start of the next document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("bins", bin_values(F.col("text")))
    rows = with_next(rows, F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))), ["text", "bins"])
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut)))
    rows = rows.withColumn("edited_bins", bin_values(F.col("edited")))
    return rows.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        pack(F.col("bins")).alias("fingerprint"), pack(F.col("edited_bins")).alias("edited_fingerprint"),
        likeness(F.col("bins"), F.col("edited_bins")).alias("near_edited"),
        likeness(F.col("bins"), F.col("next_bins")).alias("near_next"),
    )
