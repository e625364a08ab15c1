"""The terminology dictionary: matching, frequencies, tables, validation, duplicates, merging of proposals.

Terms are rows (book_id, pos, id, source, target, aliases, category, gender, confidence, frequency,
evidence_refs, notes); pos is list order, which breaks ties. Chunks are rows (book_id, chunk_no, text).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import is_valid_source, make_term_id, normalize_dedup, strip, surface_forms, tokenize

# The values that a term's fields may take, and the order of confidence.
CATEGORIES = ("person", "place", "org", "term", "other")
GENDERS = ("male", "female", "neutral", "unknown")
CONFIDENCE = {"high": 3, "medium": 2, "low": 1}
#: Bytes of a dictionary that may be sent to all workers; a larger one is joined to the chunks by book.
SENT_BYTES = 8_000_000
#: Around a surface of three characters or more, none of these may stand.
_WORDLY = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") | {chr(c) for c in range(ord("А"), ord("я") + 1)}


class SurfaceMatcher:
    """Finds the surfaces of a dictionary in lower-cased texts, all in one pass: an automaton of the surfaces."""

    def __init__(self, pairs: Iterable[tuple[int, str]]):
        by_surface: dict[str, list[int]] = {}
        for pos, surface in pairs:
            by_surface.setdefault(surface, []).append(pos)
        self.automaton = ahocorasick.Automaton()
        for surface, positions in by_surface.items():
            self.automaton.add_word(surface, (surface, positions))
        if by_surface:
            self.automaton.make_automaton()

    def terms_in(self, low: str) -> set[int]:
        """Positions of the terms that occur: anywhere if a surface has at most two characters, else as whole words."""
        found: set[int] = set()
        seen: set[str] = set()
        for last, (surface, positions) in self.automaton.iter(low) if len(self.automaton) else ():
            if surface in seen:
                continue
            before, after = last - len(surface), last + 1
            if len(surface) > 2 and ((before >= 0 and low[before] in _WORDLY) or (after < len(low) and low[after] in _WORDLY)):
                continue
            seen.add(surface)
            found.update(positions)
        return found


_HIT = pa.schema([("book_id", pa.string()), ("chunk_no", pa.int64()), ("pos", pa.int64())])


def _hits(matcher_of: Callable[[str, object], SurfaceMatcher]):
    """Over rows (book_id, chunk_no, low, further columns that matcher_of may look at)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for k, (book, chunk, low) in enumerate(zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)):
                if low is not None and book is not None:
                    rows += [(book, chunk, pos) for pos in matcher_of(book, lambda k=k, b=b: b.column(3)[k].as_py()).terms_in(low)]
            yield pa.RecordBatch.from_pydict({n: [r[i] for r in rows] for i, n in enumerate(_HIT.names)}, schema=_HIT)

    return run


def terms_in_chunk(terms: DataFrame, chunks: DataFrame, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """(book_id, chunk_no, pos): which terms occur in which chunks, by name or alias.

    Each text is read once, by an automaton of all surfaces of its book. Dictionaries of up to `sent_bytes` together are
    broadcast, and texts stay where they are; larger ones are joined to the chunks, one list for each book.
    """
    spark = chunks.sparkSession
    surfaces = terms.select(
        F.col("book_id").cast("string").alias("book_id"), F.col("pos").cast("long").alias("pos"),
        F.explode(surface_forms(F.col("source"), F.col("aliases"))).alias("surface")
    ).distinct()
    low = chunks.select(
        F.col("book_id").cast("string").alias("book_id"), F.col("chunk_no").cast("long").alias("chunk_no"),
        F.lower("text").alias("low")
    )
    schema = "book_id string, chunk_no bigint, pos bigint"
    size = surfaces.agg(F.sum(F.octet_length("surface") + F.octet_length("book_id") + 32)).first()[0] or 0
    if size <= sent_bytes:
        by_book: dict[str, list[tuple[int, str]]] = {}
        for r in surfaces.collect():  # at most sent_bytes
            by_book.setdefault(r["book_id"], []).append((r["pos"], r["surface"]))
        sent = spark.sparkContext.broadcast(by_book)

        def sent_matcher(book: str, _: object, held: dict[str, SurfaceMatcher] = {}) -> SurfaceMatcher:  # noqa: B006
            if book not in held:
                held[book] = SurfaceMatcher(sent.value.get(book, ()))
            return held[book]

        found = low.mapInArrow(_hits(sent_matcher), schema)
    else:
        lists = surfaces.groupBy("book_id").agg(F.collect_list(F.struct("pos", "surface")).alias("surfaces"))

        def joined_matcher(book: str, own: Callable[[], list[dict]], held: dict[str, SurfaceMatcher] = {}) -> SurfaceMatcher:  # noqa: B006
            if book not in held:
                held.clear()  # rows of a book come together
                held[book] = SurfaceMatcher((x["pos"], x["surface"]) for x in own())
            return held[book]

        found = low.join(lists, "book_id").mapInArrow(_hits(joined_matcher), schema)
    pos_type, chunk_type, book_type = terms.schema["pos"].dataType, chunks.schema["chunk_no"].dataType, chunks.schema["book_id"].dataType
    return found.select(F.col("book_id").cast(book_type), F.col("chunk_no").cast(chunk_type), F.col("pos").cast(pos_type))


def term_frequency(terms: DataFrame, chunks: DataFrame) -> DataFrame:
    """How many chunks each term occurs in, 0 included: book_id, pos, source, frequency."""
    n = terms_in_chunk(terms, chunks).groupBy("book_id", "pos").agg(F.count("*").alias("frequency"))
    return (
        terms.drop("frequency").join(n, ["book_id", "pos"], "left")
        .select("book_id", "pos", "source", F.coalesce("frequency", F.lit(0)).alias("frequency"))
    )


def zero_freq_terms(frequencies: DataFrame) -> DataFrame:
    return frequencies.where("frequency = 0")


def one_off_terms(frequencies: DataFrame, chunks: DataFrame, least_chunks: int = 5) -> DataFrame:
    """Terms of one chunk, in books of at least so many chunks."""
    large = chunks.groupBy("book_id").agg(F.count("*").alias("n")).where(F.col("n") >= least_chunks).select("book_id")
    return frequencies.where("frequency = 1").join(large, "book_id", "left_semi")


def relevant_terms(terms: DataFrame, chunks: DataFrame, top_n: int = 20) -> DataFrame:
    """For each chunk, the book's top_n most frequent terms and those that occur in it: chunk_no, pos, source, target, aliases, rank."""
    rank = F.row_number().over(Window.partitionBy("book_id").orderBy(F.desc("frequency"), "pos"))
    ranked = terms.withColumn("rank", rank)
    top = chunks.select("book_id", "chunk_no").join(ranked.where(F.col("rank") <= top_n).select("book_id", "pos"), "book_id")
    return (
        top.unionByName(terms_in_chunk(terms, chunks)).distinct()
        .join(ranked.select("book_id", "pos", "rank", "source", "target", "aliases"), ["book_id", "pos"])
    )


def term_table(relevant: DataFrame) -> DataFrame:
    """The terms of each chunk as a Markdown table, in rank order."""
    cell = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit(r"\|"))
    row = F.concat(
        F.lit("| "), cell(F.col("source")), F.lit(" | "), cell(F.array_join("aliases", ", ")), F.lit(" | "),
        cell(F.col("target")), F.lit(" |")
    )
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", row.alias("r")))), lambda x: x.r), "\n")
    return relevant.groupBy("book_id", "chunk_no").agg(
        F.concat(F.lit("| Оригинал | Альтернативы | Перевод |\n| --- | --- | --- |\n"), rows).alias("term_table")
    )


def ensure_term_ids(terms: DataFrame) -> DataFrame:
    """Ids unique within a book, in list order: a non-blank id stays if no earlier term has it; other terms get one made from

    the name, numbered _2, _3 and so on to the first that no earlier term has. A book's dictionary is folded in one task.
    """
    rows = terms.select(
        "book_id", "pos", F.coalesce("id", F.lit("")).alias("id"),
        make_term_id(F.coalesce("source", F.lit(""))).alias("made")
    )

    def fold(t: pa.Table) -> pa.Table:
        t = t.sort_by("pos")
        ids, taken, number = [], set(), {}
        for own, base in zip(t.column("id").to_pylist(), t.column("made").to_pylist(), strict=True):
            if not own.strip() or own in taken:
                own, n = base, number.get(base, 1)  # numbers up to n were taken when last asked for
                while own in taken:
                    n += 1
                    own = f"{base}_{n}"
                number[base] = max(n, 1)
            taken.add(own)
            ids.append(own)
        return pa.table({"book_id": t.column("book_id"), "pos": t.column("pos"), "new_id": pa.array(ids, pa.string())})

    kinds = {f.name: f.dataType.simpleString() for f in terms.schema}
    made = rows.groupBy("book_id").applyInArrow(fold, f"book_id {kinds['book_id']}, pos {kinds['pos']}, new_id string")
    return terms.join(made, ["book_id", "pos"]).withColumn("id", F.col("new_id")).select(*terms.columns)


def validate_glossary(terms: DataFrame) -> DataFrame:
    """Faults of terms: book_id, pos, severity, rule. Each rule is a column; one pass finds all."""
    counted = terms.withColumn(
        "_names", F.count("*").over(Window.partitionBy("book_id", F.lower("source")))
    ).withColumn("_ids", F.count("*").over(Window.partitionBy("book_id", "id")))
    blank = lambda c: strip(F.coalesce(F.col(c), F.lit(""))) == ""
    rules = (
        ("error", "empty_source", blank("source")), ("error", "empty_target", blank("target")),
        ("error", "missing_id", blank("id")), ("error", "duplicate_id", ~blank("id") & (F.col("_ids") > 1)),
        ("error", "duplicate_source", ~blank("source") & (F.col("_names") > 1)),
        (
            "error", "blank_alias",
            F.exists(F.coalesce("aliases", F.array().cast("array<string>")), lambda a: a.isNull() | (strip(a) == ""))
        ),
        ("warning", "bad_category", ~F.coalesce("category", F.lit("")).isin(*CATEGORIES)),
        ("warning", "bad_gender", ~F.coalesce("gender", F.lit("")).isin(*GENDERS)),
        ("warning", "bad_confidence", ~F.coalesce("confidence", F.lit("")).isin(*CONFIDENCE)),
        ("warning", "frequency_0", F.coalesce("frequency", F.lit(0)) == 0),
        ("warning", "frequency_1", F.col("frequency") == 1),
    )
    found = F.array_compact(F.array(*(F.when(test, F.struct(F.lit(s).alias("severity"), F.lit(r).alias("rule"))) for s, r, test in rules)))
    own = counted.select("book_id", "pos", F.explode(found).alias("f")).select("book_id", "pos", "f.severity", "f.rule")
    names = terms.select("book_id", F.lower("source").alias("surface"), F.col("pos").alias("other"))
    shadowed = (
        terms.select("book_id", "pos", F.explode(F.coalesce("aliases", F.array().cast("array<string>"))).alias("a"))
        .select("book_id", "pos", F.lower("a").alias("surface")).join(names, ["book_id", "surface"])
        .where("pos != other")
    )
    return own.unionByName(
        shadowed.select(
            "book_id", "pos", F.lit("warning").alias("severity"), F.lit("alias_is_source").alias("rule")
        ).distinct()
    )


def fix_glossary(terms: DataFrame) -> DataFrame:
    """Optional fields filled and ids ensured."""
    filled = terms.withColumns(
        {
            "aliases": F.coalesce("aliases", F.array().cast("array<string>")),
            "category": F.coalesce("category", F.lit("term")), "gender": F.coalesce("gender", F.lit("unknown")),
            "confidence": F.coalesce("confidence", F.lit("low")), "frequency": F.coalesce("frequency", F.lit(0)),
            "notes": F.coalesce("notes", F.lit("")),
        }
    )
    return ensure_term_ids(filled)


def confirm_terms(
    terms: DataFrame, names: list[str] | None = None, ids: list[str] | None = None, note: str = "", force: bool = False
) -> DataFrame:
    """Confidence high for all terms, or those named (by any surface) or of the ids; a note joins unless already there."""
    wanted = F.lit(True) if names is None and ids is None else F.lit(False)
    if names:
        wanted = wanted | F.arrays_overlap(surface_forms(F.col("source"), F.col("aliases")), F.array(*(F.lit(n.lower()) for n in names)))
    if ids:
        wanted = wanted | F.col("id").isin(*ids)
    change = wanted & (F.lit(force) | (F.coalesce("confidence", F.lit("")) != "high"))
    old = F.coalesce("notes", F.lit(""))
    added = F.when(F.lit(note == "") | F.contains(old, F.lit(note)), old).otherwise(
        F.concat_ws("; ", F.nullif(old, F.lit("")), F.lit(note))
    )
    return terms.withColumns(
        {
            "confidence": F.when(change, "high").otherwise(F.col("confidence")),
            "notes": F.when(change, added).otherwise(F.col("notes"))
        }
    )


def reset_terms(terms: DataFrame, prune_zero: bool = False) -> DataFrame:
    """Without evidence and notes; optionally without terms that occur nowhere (an error if none are left)."""
    bare = terms.withColumns({"evidence_refs": F.array().cast("array<string>"), "notes": F.lit("")})
    if not prune_zero:
        return bare
    kept = bare.where(F.coalesce("frequency", F.lit(0)) > 0)
    if kept.isEmpty() and not bare.isEmpty():
        raise ValueError("pruning would empty the glossary")
    return kept


def _pair_reason() -> Column:
    a, b, na, nb, ta, tb = (F.col(c) for c in ("a_low", "b_low", "a_norm", "b_norm", "a_tok", "b_tok"))
    short, long = F.when(F.length(na) <= F.length(nb), na).otherwise(nb), F.when(F.length(na) <= F.length(nb), nb).otherwise(na)
    subset = lambda x, y: (F.size(F.array_except(x, y)) == 0) & (
        F.size(F.array_distinct(x)) < F.size(F.array_distinct(y))
    ) & (F.size(x) > 0)
    double = lambda x, y: F.array_join(F.concat(x, x), " ") == F.array_join(y, " ")
    few, many = F.when(F.size(ta) <= F.size(tb), ta).otherwise(tb), F.when(F.size(ta) <= F.size(tb), tb).otherwise(ta)
    return (
        F.when(a == b, "same_name")
        .when(na == nb, "same_normal_form")
        .when((F.length(short) > 3) & F.startswith(long, short) & (F.length(long) - F.length(short) <= 3), "prefix")
        .when(double(few, many), "repeated_name")
        .when(subset(few, many), F.when(F.get(few, F.lit(0)) == F.get(many, F.lit(0)), "short_long_name").otherwise("token_subset"))
        .when(F.arrays_overlap(F.col("a_surf"), F.col("b_surf")), "alias_overlap")
    )


def find_duplicates(terms: DataFrame) -> DataFrame:
    """Pairs of terms of a book that may be one: a_pos, b_pos, reason (the first rule that holds), same_target.

    Pairs meet by equal keys: normal form, its stems of up to three characters less, surfaces. Names of which one holds all
    words of the other meet by the rarest word of the shorter, so a word that many names share makes pairs only for names
    that have no rarer one.
    """
    low = F.lower(strip(F.col("source")))
    norm = normalize_dedup(F.col("source"))
    surfaces = surface_forms(F.col("source"), F.col("aliases"))
    rows = terms.select(
        "book_id", "pos", low.alias("low"), norm.alias("norm"), tokenize(F.col("source")).alias("tok"),
        surfaces.alias("surf"), "target"
    )
    stems = F.transform(
        F.sequence(F.lit(0), F.lit(3)),
        lambda k: F.when(F.length("norm") - k > 3, F.concat(F.lit("p:"), F.left(F.col("norm"), F.length("norm") - k)))
    )
    named = F.concat(F.array(F.concat(F.lit("n:"), "norm")), stems, F.transform("surf", lambda s: F.concat(F.lit("s:"), s)))
    keyed = rows.select("book_id", "pos", F.explode(F.array_distinct(F.array_compact(named))).alias("key"))
    words = rows.select("book_id", "pos", F.explode(F.array_distinct("tok")).alias("key"))
    often = words.groupBy("book_id", "key").agg(F.count("*").alias("n"))
    rarest = words.join(often, ["book_id", "key"]).groupBy("book_id", "pos").agg(F.min_by("key", F.struct("n", "key")).alias("key"))
    met = None
    for one, other in ((keyed, keyed), (rarest, words)):
        both = one.withColumnRenamed("pos", "x").join(other.withColumnRenamed("pos", "y"), ["book_id", "key"]).where("x != y")
        pair = both.select("book_id", F.least("x", "y").alias("a_pos"), F.greatest("x", "y").alias("b_pos"))
        met = pair if met is None else met.unionByName(pair)
    pairs = met.distinct()
    for side in ("a", "b"):
        own = rows.select("book_id", *(F.col(c).alias(f"{side}_{c}") for c in ("pos", "low", "norm", "tok", "surf", "target")))
        pairs = pairs.join(own, ["book_id", f"{side}_pos"])
    pairs = pairs.withColumn("reason", _pair_reason())
    same = F.col("a_target").eqNullSafe(F.col("b_target")).alias("same_target")
    return pairs.where("reason IS NOT NULL").select("book_id", "a_pos", "b_pos", "reason", same)


# Proposals: rows (book_id, chunk_no, meta) with meta a JSON text of one chunk's findings.

META_SCHEMA = (
    "new_entities array<struct<source:string,target_proposal:string,category:string,evidence:string>>, alias_hypotheses array<struct<variant:string,may_be_alias_of_source:string,evidence:string>>, " "attribute_hypotheses array<struct<entity_source:string,attribute:string,value:string,confidence:string,evidence:string>>, used_term_sources array<string>, " "conflicts array<struct<entity_source:string,field:string,injected:string,observed_better:string,evidence:string>>, narrator_identification struct<name:string,confidence:string>, chunk_id string"
)


def parse_metas(metas: DataFrame) -> DataFrame:
    """Metas with their parsed form m and errors; a meta with any error is malformed as a whole."""
    m = F.from_json("meta", META_SCHEMA)
    blank = lambda c: c.isNull() | (strip(c) == "")
    bad = lambda items, fields: F.exists(
        F.coalesce(F.col(f"m.{items}"), F.array()), lambda e: reduce(lambda x, y: x | y, [blank(e[f]) for f in fields])
    )
    tests = (
        ("not_json", F.expr("try_parse_json(meta) IS NULL") | ~F.ltrim("meta").startswith("{")),
        ("has_chunk_id", F.expr("try_variant_get(try_parse_json(meta), '$.chunk_id', 'string') IS NOT NULL")),
        ("bad_entity", bad("new_entities", ("source", "target_proposal"))),
        ("bad_source", F.exists(F.coalesce("m.new_entities", F.array()), lambda e: ~is_valid_source(e.source))),
        ("bad_alias", bad("alias_hypotheses", ("variant", "may_be_alias_of_source"))),
        ("bad_attribute", bad("attribute_hypotheses", ("entity_source", "attribute", "value"))),
        ("bad_conflict", bad("conflicts", ("entity_source", "field"))),
    )
    return (
        metas.withColumn("m", m)
        .withColumn("errors", F.array_compact(F.array(*(F.when(test, name) for name, test in tests))))
        .withColumn("hash", F.sha2("meta", 256))
    )


def _known(terms: DataFrame) -> DataFrame:
    """(book_id, surface) -> the first term of that name or alias."""
    pairs = terms.select(
        "book_id", "pos", "source", "target", "aliases", "gender", "category",
        F.explode(surface_forms(F.col("source"), F.col("aliases"))).alias("surface")
    )
    first = F.row_number().over(Window.partitionBy("book_id", "surface").orderBy("pos"))
    return pairs.withColumn("n", first).where("n = 1").drop("n")


def _chunks(order: str = "chunk_no") -> Column:
    return F.array_sort(F.collect_set(order))


def _fresh(metas: DataFrame, applied: DataFrame) -> DataFrame:
    """Parsed sound metas that weren't applied."""
    return (
        parse_metas(metas).where(F.size("errors") == 0)
        .join(applied.select("book_id", "chunk_no", "hash"), ["book_id", "chunk_no", "hash"], "left_anti")
    )


def consumed_metas(metas: DataFrame, applied: DataFrame) -> DataFrame:
    """(book_id, chunk_no, hash) of the metas that prepare_merge reads, those that change nothing included."""
    return _fresh(metas, applied).select("book_id", "chunk_no", "hash")


def prepare_merge(metas: DataFrame, terms: DataFrame, applied: DataFrame) -> DataFrame:
    """The plan of proposals of sound metas that weren't applied (by chunk and hash): outcome (auto, decision), kind, id, fields and evidence.

    Columns: book_id, outcome, kind, id, source, field, value, options, chunks. Proposals that agree with the glossary give no row.
    """
    fresh = _fresh(metas, applied)
    known = _known(terms)
    key = lambda *cols: F.left(F.sha1(F.concat_ws("\x01", *cols)), F.lit(8))
    none = F.lit(None).cast("string")

    def plan(df: DataFrame, outcome: Column, kind: Column, source: Column, field: Column, value: Column, options: Column) -> DataFrame:
        named = df.select(
            "book_id", outcome.alias("outcome"), kind.alias("kind"), source.alias("source"), field.alias("field"),
            value.alias("value"), options.alias("options"), "chunks"
        )
        return named.where("outcome IS NOT NULL").withColumn(
            "id",
            F.concat("kind", F.lit("_"), key("source", F.coalesce("field", F.lit("")), F.coalesce("value", F.lit(""))))
        )

    found = fresh.select("book_id", "chunk_no", F.explode("m.new_entities").alias("e"))
    entity = found.groupBy("book_id", F.col("e.source").alias("name")).agg(
        F.array_sort(F.collect_set("e.target_proposal")).alias("targets"),
        F.array_sort(F.collect_set(F.coalesce("e.category", F.lit("term")))).alias("cats"), _chunks().alias("chunks")
    )
    entity = entity.withColumn("surface", F.lower("name")).join(known, ["book_id", "surface"], "left")
    single = F.size("targets") == 1
    agreed = F.col("source").isNotNull() & single & (F.get("targets", F.lit(0)) == F.col("target"))
    clear = F.col("source").isNull() & single & (F.size("cats") == 1)
    e = plan(
        entity, F.when(agreed, None).when(clear, "auto").otherwise("decision"),
        F.when(F.col("source").isNotNull(), "existing_entity_conflict").when(clear, "add_entity")
        .otherwise("conflicting_new_entity_proposals"),
        F.col("name"), F.when(clear, F.get("cats", F.lit(0))), F.when(clear, F.get("targets", F.lit(0))),
        F.when(~clear, F.col("targets")),
    )
    found = fresh.select("book_id", "chunk_no", F.explode("m.alias_hypotheses").alias("a"))
    alias = (
        found.groupBy("book_id", F.col("a.variant").alias("variant"), F.col("a.may_be_alias_of_source").alias("of"))
        .agg(_chunks().alias("chunks")).withColumn("surface", F.lower("of")).join(known, ["book_id", "surface"], "left")
    )
    taken = known.select("book_id", F.col("surface").alias("v"), F.col("source").alias("v_source"))
    alias = alias.withColumn("v", F.lower("variant")).join(taken, ["book_id", "v"], "left")
    has = F.array_contains(surface_forms(F.col("source"), F.col("aliases")), F.col("v"))
    a = plan(
        alias,
        F.when(F.col("source").isNull(), "decision").when(has, None).when(F.col("v_source").isNotNull(), "decision")
        .otherwise("auto"),
        F.when(F.col("source").isNull(), "alias_candidate_missing")
        .when(F.col("v_source").isNotNull(), "alias_variant_is_term").otherwise("add_alias"),
        F.coalesce("source", "of"), F.lit("alias"), F.col("variant"), F.lit(None).cast("array<string>"),
    )
    found = fresh.select("book_id", "chunk_no", F.explode("m.attribute_hypotheses").alias("h"))
    rank = F.max(
        F.coalesce(
            F.try_element_at(F.create_map(*(F.lit(x) for kv in CONFIDENCE.items() for x in kv)), F.col("h.confidence")),
            F.lit(1)
        )
    )
    attr = (
        found.groupBy(
            "book_id", F.col("h.entity_source").alias("name"), F.col("h.attribute").alias("attr"),
            F.col("h.value").alias("val")
        )
        .agg(rank.alias("rank"), _chunks().alias("chunks")).withColumn("surface", F.lower("name"))
        .join(known, ["book_id", "surface"])
    )
    now = (
        F.when(F.col("attr") == "gender", F.col("gender")).when(F.col("attr") == "category", F.col("category"))
        .when(F.col("attr") == "target", F.col("target"))
    )
    open_ = F.coalesce(now, F.lit("")).isin("", "unknown")
    t = plan(
        attr, F.when(now == F.col("val"), None).when(open_ & (F.col("rank") >= 2), "auto").otherwise("decision"),
        F.when(open_ & (F.col("rank") >= 2), "set_attribute").when(open_, "attribute_low_confidence")
        .otherwise("attribute_conflict"),
        F.col("source"), F.col("attr"), F.col("val"), F.when(~open_, F.array(now, F.col("val"))),
    )
    found = fresh.select("book_id", "chunk_no", F.explode("m.conflicts").alias("c"))
    clash = found.groupBy(
        "book_id", F.col("c.entity_source").alias("name"), F.col("c.field").alias("f"), F.col("c.injected").alias("i")
    ).agg(F.min_by("c.observed_better", "chunk_no").alias("better"), _chunks().alias("chunks"))
    c = plan(
        clash, F.lit("decision"), F.lit("translation_conflict"), F.col("name"), F.col("f"), F.col("i"),
        F.array_compact(F.array("i", "better"))
    )
    return e.unionByName(a).unionByName(t).unionByName(c).withColumn("field", F.coalesce("field", none))


# What may be chosen for a kind of decision, besides one of its options.
CHOICES = ("skip", "accept")


def validate_decisions(plan: DataFrame, decisions: DataFrame) -> DataFrame:
    """Faulty decisions (book_id, id, choice, kind): unknown id, kind that differs, choice that isn't open."""
    wanted = plan.where("outcome = 'decision'").select("book_id", "id", F.col("kind").alias("plan_kind"), "options")
    joined = decisions.join(wanted, ["book_id", "id"], "left")
    fault = (
        F.when(F.col("plan_kind").isNull(), "unknown_id")
        .when(F.col("kind").isNotNull() & (F.col("kind") != F.col("plan_kind")), "wrong_kind")
        .when(
            ~F.col("choice").isin(*CHOICES) & ~F.coalesce(F.array_contains("options", F.col("choice")), F.lit(False)),
            "bad_choice"
        )
    )
    return joined.withColumn("fault", fault).where("fault IS NOT NULL").select("book_id", "id", "choice", "fault")


def apply_merge(plan: DataFrame, terms: DataFrame, decisions: DataFrame) -> DataFrame:
    """The glossary after all automatic items and then the decisions; any faulty decision leaves it alone and raises.

    New terms come after the old, in order of name, of unknown gender, low confidence, frequency 0.
    """
    if not validate_decisions(plan, decisions).isEmpty():
        raise ValueError("faulty decisions; nothing was applied")
    chosen = plan.join(decisions.select("book_id", "id", "choice"), ["book_id", "id"], "left").where("outcome = 'auto' OR choice != 'skip'")
    value = (
        F.when(F.col("outcome") == "auto", F.col("value"))
        .when(F.col("choice") == "accept", F.coalesce("value", F.element_at("options", -1))).otherwise(F.col("choice"))
    )
    acts = chosen.withColumn("value", value)
    sets = acts.where(
        "kind IN ('set_attribute', 'attribute_low_confidence', 'attribute_conflict', 'existing_entity_conflict', 'translation_conflict')"
    )
    field = F.when(F.col("kind") == "existing_entity_conflict", "target").otherwise(F.col("field"))
    by_field = (
        sets.select("book_id", F.lower("source").alias("key"), field.alias("field"), "value")
        .where("field IN ('gender', 'category', 'target')").groupBy("book_id", "key")
        .pivot("field", ["gender", "category", "target"]).agg(F.max("value"))
    )
    extra = (
        acts.where("kind IN ('add_alias', 'alias_variant_is_term')").groupBy("book_id", F.lower("source").alias("key"))
        .agg(F.array_sort(F.collect_set("value")).alias("new_aliases"))
    )
    old = (
        terms.withColumn("key", F.lower("source"))
        .join(by_field.toDF("book_id", "key", "g", "c", "t"), ["book_id", "key"], "left")
        .join(extra, ["book_id", "key"], "left")
    )
    aliases = F.coalesce("aliases", F.array().cast("array<string>"))
    old = old.withColumns(
        {
            "gender": F.coalesce("g", "gender"), "category": F.coalesce("c", "category"),
            "target": F.coalesce("t", "target"),
            "aliases": F.array_union(aliases, F.coalesce("new_aliases", F.array().cast("array<string>")))
        }
    ).select(*terms.columns)
    last = terms.groupBy("book_id").agg(F.max("pos").alias("last"))
    fresh = acts.where("kind IN ('add_entity', 'conflicting_new_entity_proposals')").join(last, "book_id", "left")
    pos = F.coalesce("last", F.lit(0)) + F.row_number().over(Window.partitionBy("book_id").orderBy("source"))
    fields = {
        "pos": pos.cast(terms.schema["pos"].dataType), "id": F.lit(""), "target": F.col("value"),
        "aliases": F.array().cast("array<string>"), "category": F.coalesce("field", F.lit("term")),
        "gender": F.lit("unknown"), "confidence": F.lit("low"),
        "frequency": F.lit(0).cast(terms.schema["frequency"].dataType),
        "evidence_refs": F.transform("chunks", lambda k: F.format_string("chunk%04d", k)), "notes": F.lit("merged"),
    }
    return ensure_term_ids(old.unionByName(fresh.withColumns(fields).select(*terms.columns)))


def finish_merge(
    plan: DataFrame, consumed: DataFrame, terms: DataFrame, applied: DataFrame, decisions: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """The glossary after apply_merge, and the hashes of applied metas with the consumed ones in place of older ones of their chunks.

    Both go into one snapshot: see sinks.write_merge. Faulty decisions raise, and neither is given.
    """
    merged = apply_merge(plan, terms, decisions)
    key, cols = ["book_id", "chunk_no"], ["book_id", "chunk_no", "hash"]
    return merged, applied.select(*cols).join(consumed.select(*key), key, "left_anti").unionByName(consumed.select(*cols))


def merge_status(metas: DataFrame, outputs: DataFrame, applied: DataFrame) -> DataFrame:
    """Per book: consumed, unmerged and malformed metas, and outputs without meta."""
    state = parse_metas(metas).join(
        applied.select("book_id", "chunk_no", "hash", F.lit(True).alias("done")), ["book_id", "chunk_no", "hash"],
        "left"
    )
    kind = F.when(F.col("done"), "consumed").when(F.size("errors") > 0, "malformed").otherwise("unmerged")
    rows = state.select("book_id", kind.alias("k")).unionByName(
        outputs.join(metas, ["book_id", "chunk_no"], "left_anti").select("book_id", F.lit("missing").alias("k"))
    )
    return rows.groupBy("book_id").agg(*(F.count_if(F.col("k") == k).alias(k) for k in ("consumed", "unmerged", "malformed", "missing")))


def parse_decisions(texts: DataFrame) -> DataFrame:
    """Decisions of files (book_id, text): a JSON list of {id, choice, kind}, or an object that holds it as `decisions`."""
    item = "array<struct<id:string,choice:string,kind:string>>"
    both = F.when(
        F.ltrim("text").startswith("["), F.from_json("text", item)
    ).otherwise(F.from_json("text", f"decisions {item}")["decisions"])
    return texts.select("book_id", F.explode(both).alias("d")).select("book_id", "d.id", "d.choice", "d.kind")


def load_glossary(texts: DataFrame) -> DataFrame:
    """Terms of glossary files (book_id, text): a JSON object with `terms`. A file that holds none stops the job; absent fields get defaults."""
    term = "struct<id:string,source:string,target:string,aliases:array<string>,category:string,gender:string,confidence:string,frequency:int,evidence_refs:array<string>,notes:string>"
    parsed = texts.select("book_id", F.from_json("text", f"version int, terms array<{term}>").alias("g"))
    checked = parsed.select(
        "book_id",
        F.when(
            F.col("g.terms").isNull(),
            F.raise_error(F.concat(F.lit("no terms in the glossary of "), "book_id")).cast(f"array<{term}>")
        )
        .otherwise(F.col("g.terms")).alias("terms")
    )
    rows = checked.select("book_id", F.posexplode("terms").alias("k", "t")).select("book_id", (F.col("k") + 1).alias("pos"), "t.*")
    return fix_glossary(rows.withColumn("evidence_refs", F.coalesce("evidence_refs", F.array().cast("array<string>"))))
