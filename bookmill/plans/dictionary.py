"""Queries of the dictionary, merging, planning and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import glossary as G, payload as P, state as ST
from ..sources import books as B
from .registry import query

# Terms of the queries on documents: frequent words, an alias, a short one, one that occurs nowhere.
_TERMS = (
    (1, "the", "der", "", "term"), (2, "thing", "Ding", "", "term"), (3, "tion", "tion", "ing the", "place"),
    (4, "onthe", "x", "of in", "person"), (5, "la", "la", "", "term"), (6, "nowhere at all", "y", "", "other"),
    (8, "pathetic", "z", "", "other"), (7, "ab", "kurz", "", "term"),
)
_VALUES = ", ".join("(" + ", ".join(str(x) if isinstance(x, int) else f"'{x}'" for x in r) + ")" for r in _TERMS)


def _terms(t):
    """The terms in every source's book."""
    fields = ("pos", "source", "target", "alias", "category")
    rows = F.array(*(F.struct(*(F.lit(x).alias(n) for n, x in zip(fields, r, strict=True))) for r in _TERMS))
    books = t("documents").select(F.col("source").alias("book_id")).distinct()
    aliases = F.when(F.col("alias") == "", F.array().cast("array<string>")).otherwise(F.array("alias"))
    return (
        books.select("book_id", F.explode(rows).alias("r")).select("book_id", "r.*")
        .select(
            "book_id", "pos", F.concat(F.lit("t"), F.col("pos").cast("string")).alias("id"), "source", "target",
            aliases.alias("aliases"), "category", F.lit("unknown").alias("gender"), F.lit("low").alias("confidence"),
            (F.lit(10) - F.col("pos")).alias("frequency"), F.array().cast("array<string>").alias("evidence_refs"),
            F.lit("").alias("notes"),
        )
    )


_HITS = f"""WITH t AS (SELECT * FROM (VALUES {_VALUES}) v(pos, source, target, alias, category)), s AS (SELECT pos, source AS x FROM t UNION ALL SELECT pos, alias FROM t WHERE alias <> ''),
h AS (SELECT DISTINCT d.source AS book_id, d.doc_id AS chunk_no, CAST(s.pos AS BIGINT) AS pos FROM documents d JOIN s ON CASE WHEN length(s.x) <= 2 THEN contains(lower(d.text), s.x) ELSE regexp_matches(lower(d.text), '(^|[^a-zа-я0-9])' || s.x || '([^a-zа-я0-9]|$)') END)"""


@query(_HITS + " SELECT * FROM h")
def terms_in_chunk(t):
    return G.terms_in_chunk(_terms(t), t.docs_as_chunks())


_FREQ = _HITS + ", f AS (SELECT b.book_id, CAST(t.pos AS BIGINT) AS pos, t.source, count(h.chunk_no) AS frequency FROM t CROSS JOIN (SELECT DISTINCT source AS book_id FROM documents) b LEFT JOIN h ON h.book_id = b.book_id AND h.pos = t.pos GROUP BY ALL)"


@query(_FREQ + " SELECT * FROM f")
def term_frequency(t):
    return G.term_frequency(_terms(t), t.docs_as_chunks())


@query(_FREQ + " SELECT * FROM f WHERE frequency = 0")
def zero_freq_terms(t):
    return G.zero_freq_terms(G.term_frequency(_terms(t), t.docs_as_chunks()))


@query(_FREQ + " SELECT book_id, pos, source, frequency FROM f WHERE frequency = 1")
def one_off_terms(t):
    chunks = t.docs_as_chunks()
    return G.one_off_terms(G.term_frequency(_terms(t), chunks), chunks)


_RELEVANT = _HITS + ", r AS (SELECT d.source AS book_id, d.doc_id AS chunk_no, CAST(t.pos AS BIGINT) AS pos, t.source, t.alias, t.target FROM documents d CROSS JOIN t WHERE t.pos <= 2 OR EXISTS (SELECT 1 FROM h WHERE h.book_id = d.source AND h.chunk_no = d.doc_id AND h.pos = t.pos))"


@query(_RELEVANT + " SELECT book_id, chunk_no, pos, pos AS rank, source, target FROM r")
def relevant_terms(t):
    return G.relevant_terms(_terms(t), t.docs_as_chunks(), 2).select("book_id", "chunk_no", "pos", "rank", "source", "target")


@query(
    _RELEVANT + " SELECT book_id, chunk_no, '| Оригинал | Альтернативы | Перевод |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg('| ' || source || ' | ' || alias || ' | ' || target || ' |', chr(10) ORDER BY pos) AS term_table FROM r GROUP BY book_id, chunk_no"
)
def term_table(t):
    return G.term_table(G.relevant_terms(_terms(t), t.docs_as_chunks(), 2))


@query(
    "SELECT CAST(pos AS BIGINT) AS pos, id FROM (VALUES (1, 'sing_sing'), (2, 'sing_sing_2'), (3, 'kept'), (4, 'kept_2'), (5, 'term')) v(pos, id)"
)
def ensure_term_ids(t):
    rows = t.sql(
        "SELECT * FROM VALUES ('b', 1, '', 'Sing Sing'), ('b', 2, '', 'sing sing'), ('b', 3, 'kept', 'X'), ('b', 4, 'kept', 'Kept'), ('b', 5, '', '?') v(book_id, pos, id, source)"
    )
    return G.ensure_term_ids(rows).select("pos", "id")


def _bad_terms(t):
    return t.sql("""SELECT book_id, pos, id, source, target, aliases, category, gender, confidence, frequency, array() AS evidence_refs, notes FROM VALUES
('b', 1, 'a', 'Ann', 'Анна', array('Annie'), 'person', 'female', 'high', 5, ''), ('b', 2, 'a', 'ann', 'Анна', array(' '), 'person', 'female', 'low', 3, ''),
('b', 3, '', 'Bob', '', array('Ann'), 'hero', 'male', 'low', 0, ''), ('b', 4, 'd', '', 'Д', array(), 'term', 'x', 'sure', 1, '') v(book_id, pos, id, source, target, aliases, category, gender, confidence, frequency, notes)""").withColumn("evidence_refs", F.array().cast("array<string>"))


_FAULTS = (
    (1, "error", "duplicate_id"), (1, "error", "duplicate_source"), (2, "error", "duplicate_id"),
    (2, "error", "duplicate_source"), (2, "error", "blank_alias"), (3, "error", "empty_target"),
    (3, "error", "missing_id"), (3, "warning", "bad_category"), (3, "warning", "frequency_0"),
    (3, "warning", "alias_is_source"), (4, "error", "empty_source"), (4, "warning", "bad_gender"),
    (4, "warning", "bad_confidence"), (4, "warning", "frequency_1")
)


@query(
    "SELECT CAST(pos AS BIGINT) AS pos, severity, rule FROM (VALUES " + ", ".join(
        f"({p}, '{s}', '{r}')" for p, s, r in _FAULTS
    ) + ") v(pos, severity, rule)"
)
def validate_glossary(t):
    return G.validate_glossary(_bad_terms(t)).select("pos", "severity", "rule")


@query(
    "SELECT CAST(pos AS BIGINT) AS pos, confidence, notes FROM (VALUES (1, 'high', ''), (2, 'high', 'checked'), (3, 'high', 'checked'), (4, 'sure', '')) v(pos, confidence, notes)"
)
def confirm_terms(t):
    return G.confirm_terms(_bad_terms(t), names=["Ann", "Bob"], note="checked").select("pos", "confidence", "notes")


@query("SELECT CAST(pos AS BIGINT) AS pos, notes FROM (VALUES (1, ''), (2, ''), (4, '')) v(pos, notes)")
def reset_run_state(t):
    return G.reset_terms(_bad_terms(t), prune_zero=True).select("pos", "notes")


_DUPS = (
    (1, 2, "same_normal_form"), (3, 4, "prefix"), (5, 6, "repeated_name"), (7, 8, "short_long_name"),
    (9, 10, "same_name"), (11, 12, "alias_overlap"), (8, 13, "token_subset")
)


@query(
    "SELECT CAST(a AS BIGINT) AS a_pos, CAST(b AS BIGINT) AS b_pos, reason FROM (VALUES " + ", ".join(
        f"({a}, {b}, '{r}')" for a, b, r in _DUPS if (a, b) != (8, 13)
    ) + ") v(a, b, reason)"
)
def find_duplicates(t):
    rows = t.sql("""SELECT 'b' AS book_id, pos, source, aliases, source AS target FROM VALUES (1, 'Lamps', array()), (2, 'Lamp', array()), (3, "Tracker's Lenses", array()), (4, "Tracker's Lens", array()), (5, 'Zo', array()), (6, 'Zo Zo', array()),
(7, 'Janci', array()), (8, 'Janci Patterson', array()), (9, 'Grey', array()), (10, 'grey', array()), (11, 'Moon', array('Luna')), (12, 'Satellite', array('luna')) v(pos, source, aliases)""")
    return G.find_duplicates(rows).select("a_pos", "b_pos", "reason")


_METAS = """('b', 1, '{"new_entities":[{"source":"Zed","target_proposal":"Зед","category":"person"}],"alias_hypotheses":[{"variant":"Annie","may_be_alias_of_source":"Ann"}]}'),
('b', 2, '{"new_entities":[{"source":"Zed","target_proposal":"Зед","category":"person"},{"source":"Yan","target_proposal":"Ян","category":"person"}],"attribute_hypotheses":[{"entity_source":"Ann","attribute":"gender","value":"female","confidence":"medium"}]}'),
('b', 3, '{"new_entities":[{"source":"Yan","target_proposal":"Йан","category":"person"},{"source":"Ann","target_proposal":"Анн","category":"person"}],"attribute_hypotheses":[{"entity_source":"Bob","attribute":"gender","value":"female","confidence":"high"},{"entity_source":"Cy","attribute":"gender","value":"male","confidence":"low"}]}'),
('b', 4, '{"chunk_id":"x"}'), ('b', 5, 'not json'), ('b', 6, '{"conflicts":[{"entity_source":"Ann","field":"target","injected":"Анна","observed_better":"Аня"}]}'), ('b', 7, '{"new_entities":[{"source":"Q","target":"К"}]}'), ('b', 8, '{}')"""


def _merging(t):
    metas = t.sql(f"SELECT * FROM VALUES {_METAS} v(book_id, chunk_no, meta)")
    terms = t.sql(
        "SELECT * FROM VALUES ('b', 1, 'ann', 'Ann', 'Анна', array(''), 'person', 'unknown', 'low', 1, ''), ('b', 2, 'bob', 'Bob', 'Боб', array(''), 'person', 'male', 'low', 1, ''), ('b', 3, 'cy', 'Cy', 'Сай', array(''), 'person', 'unknown', 'low', 1, '') v(book_id, pos, id, source, target, aliases, category, gender, confidence, frequency, notes)"
    )
    terms = terms.withColumn("aliases", F.array().cast("array<string>")).withColumn("evidence_refs", F.array().cast("array<string>"))
    applied = metas.where("chunk_no = 8").select("book_id", "chunk_no", F.sha2("meta", 256).alias("hash"))
    return metas, terms, applied


@query(
    "SELECT CAST(chunk_no AS BIGINT) AS chunk_no, errors FROM (VALUES (1, ''), (2, ''), (3, ''), (4, 'has_chunk_id'), (5, 'not_json'), (6, ''), (7, 'bad_entity'), (8, '')) v(chunk_no, errors)"
)
def valid_meta(t):
    return G.parse_metas(_merging(t)[0]).select("chunk_no", "errors")


@query(
    "SELECT outcome, kind, source, field, value, options, chunks FROM (VALUES ('auto', 'add_entity', 'Zed', 'person', 'Зед', NULL, '1 | 2'), ('decision', 'conflicting_new_entity_proposals', 'Yan', NULL, NULL, 'Йан | Ян', '2 | 3'), ('decision', 'existing_entity_conflict', 'Ann', NULL, NULL, 'Анн', '3'), ('auto', 'add_alias', 'Ann', 'alias', 'Annie', NULL, '1'), ('auto', 'set_attribute', 'Ann', 'gender', 'female', NULL, '2'), ('decision', 'attribute_conflict', 'Bob', 'gender', 'female', 'male | female', '3'), ('decision', 'attribute_low_confidence', 'Cy', 'gender', 'male', NULL, '3'), ('decision', 'translation_conflict', 'Ann', 'target', 'Анна', 'Анна | Аня', '6')) v(outcome, kind, source, field, value, options, chunks)"
)
def prepare_merge(t):
    return G.prepare_merge(*_merging(t)).drop("book_id", "id")


@query(
    "SELECT CAST(pos AS BIGINT) AS pos, source, target, gender, aliases FROM (VALUES (1, 'Ann', 'Анна', 'female', 'Annie'), (2, 'Bob', 'Боб', 'male', ''), (3, 'Cy', 'Сай', 'male', ''), (4, 'Yan', 'Ян', 'unknown', ''), (5, 'Zed', 'Зед', 'unknown', '')) v(pos, source, target, gender, aliases)"
)
def apply_merge(t):
    metas, terms, applied = _merging(t)
    plan = G.prepare_merge(metas, terms, applied)
    choices = {"conflicting_new_entity_proposals": "Ян", "attribute_low_confidence": "accept"}
    choice = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in choices.items() for x in kv)), F.col("kind")), F.lit("skip"))
    decisions = plan.where("outcome = 'decision'").select("book_id", "id", choice.alias("choice"), "kind")
    return G.apply_merge(plan, terms, decisions).select("pos", "source", "target", "gender", "aliases")


@query(
    f"SELECT CAST(chunk_no AS BIGINT) AS chunk_no, sha256(meta) AS hash FROM (VALUES {_METAS}) v(book_id, chunk_no, meta) WHERE chunk_no IN (1, 2, 3, 6, 8)"
)
def applied_metas(t):
    metas, terms, applied = _merging(t)
    plan = G.prepare_merge(metas, terms, applied)
    decisions = plan.where("outcome = 'decision'").select("book_id", "id", F.lit("skip").alias("choice"), "kind")
    return G.finish_merge(plan, G.consumed_metas(metas, applied), terms, applied, decisions)[1].select("chunk_no", "hash")


@query("SELECT fault, CAST(n AS BIGINT) AS n FROM (VALUES ('unknown_id', 1), ('bad_choice', 1), ('wrong_kind', 1)) v(fault, n)")
def validate_decisions(t):
    plan = G.prepare_merge(*_merging(t))
    own = plan.where("kind = 'translation_conflict'").select(
        "book_id", "id", F.lit("other").alias("choice"), F.lit(None).cast("string").alias("kind")
    )
    wrong = plan.where("kind = 'attribute_conflict'").select("book_id", "id", F.lit("skip").alias("choice"), F.lit("alias").alias("kind"))
    odd = t.sql("SELECT 'b' AS book_id, 'none' AS id, 'skip' AS choice, CAST(NULL AS STRING) AS kind")
    return G.validate_decisions(plan, own.unionByName(wrong).unionByName(odd)).groupBy("fault").agg(F.count("*").alias("n"))


@query(
    "SELECT 'b' AS book_id, CAST(1 AS BIGINT) AS consumed, CAST(4 AS BIGINT) AS unmerged, CAST(3 AS BIGINT) AS malformed, CAST(1 AS BIGINT) AS missing"
)
def merge_status(t):
    metas, _, applied = _merging(t)
    return G.merge_status(metas, t.sql("SELECT * FROM VALUES ('b', 1), ('b', 9) v(book_id, chunk_no)"), applied)


@query(
    "SELECT CAST(chunk_no AS BIGINT) AS chunk_no, CAST(n AS BIGINT) AS n_entities FROM (VALUES (1, 1), (2, 2), (3, 2), (6, 0), (8, 0)) v(chunk_no, n)"
)
def meta_counts(t):
    sound = G.parse_metas(_merging(t)[0]).where(F.size("errors") == 0)
    return P.meta_counts(sound).select("chunk_no", "n_entities")


_PLAN = """WITH m AS (SELECT source AS book_id, doc_id AS chunk_no, l.doc_id IS NOT NULL AS out, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)),
p AS (SELECT book_id, chunk_no, CASE WHEN out AND toxic = 1 THEN 'failed' WHEN NOT out OR chunk_no % 11 = 0 THEN 'translation' WHEN quality = 0 THEN 'record_only' WHEN chunk_no % 5 = 0 THEN 'translation' ELSE 'unchanged' END AS category FROM m)"""


def _planned(t):
    docs = t("documents").join(t("labels"), "doc_id", "left")
    chunks = docs.select(F.col("source").alias("book_id"), F.col("doc_id").alias("chunk_no"), "text", "quality", "toxic")
    manifest = chunks.select(
        "book_id", "chunk_no", F.when(F.col("chunk_no") % 11 == 0, "old").otherwise(F.sha2("text", 256)).alias("source")
    )
    one = {
        "source": F.lit("Ann"), "target": F.lit("Анна"), "gender": F.lit("female"), "id": F.lit("t1"),
        "aliases": F.array().cast("array<string>")
    }
    terms = chunks.select("book_id").distinct().withColumns(one)
    now = ST.entity_hashes(terms).select("book_id", "hash")
    had = chunks.where("quality = 1 OR toxic = 1").join(now, "book_id")
    records = had.select(
        "book_id", "chunk_no",
        F.create_map(
            F.lit("t1"), F.when(F.col("chunk_no") % 5 == 0, "old").otherwise(F.col("hash"))
        ).alias("entity_hashes"),
        (F.col("toxic") == 1).alias("failed"), F.lit(False).alias("polish_failed")
    )
    return ST.plan(manifest, chunks, chunks.where("quality IS NOT NULL"), records, terms)


@query(_PLAN + " SELECT book_id, chunk_no, category, false AS polish_failed FROM p")
def plan(t):
    return _planned(t)


@query(_PLAN + " SELECT book_id, category, count(*) AS n FROM p GROUP BY book_id, category")
def plan_summary(t):
    return ST.plan_summary(_planned(t))


@query(
    _HITS + " SELECT d.source AS book_id, d.doc_id AS chunk_no, count(h.pos) AS n_terms, CAST(length(d.text) AS BIGINT) AS output_size FROM documents d LEFT JOIN h ON h.book_id = d.source AND h.chunk_no = d.doc_id GROUP BY ALL"
)
def record(t):
    chunks = t.docs_as_chunks()
    none = ST.record(
        t.sql("SELECT * FROM VALUES ('', 0L) v(book_id, chunk_no)").where("false")
        .select(
            "book_id", "chunk_no", F.lit(0).alias("glossary_version"),
            F.expr("cast(map() as map<string,string>)").alias("entity_hashes"), F.lit(False).alias("output_exists"),
            F.lit(0).cast("bigint").alias("output_size"), F.lit(False).alias("failed"),
            F.lit("").alias("failure_reason"), F.lit(False).alias("polish_failed"),
            F.lit("").alias("polish_failure_reason"),
        ),
        chunks, chunks, _terms(t), 1
    )
    return none.select("book_id", "chunk_no", F.size("entity_hashes").alias("n_terms"), "output_size")


@query(
    "SELECT CAST(chunk_no AS BIGINT) AS chunk_no, failed, failure_reason FROM (VALUES (1, true, 'bad'), (2, false, '')) v(chunk_no, failed, failure_reason)"
)
def mark_failed(t):
    records = t.sql("SELECT * FROM VALUES ('b', 1, false, ''), ('b', 2, false, '') v(book_id, chunk_no, failed, failure_reason)")
    return ST.mark_failed(
        records, t.sql("SELECT 'b' AS book_id, 1 AS chunk_no, 'bad' AS reason")
    ).select("chunk_no", "failed", "failure_reason")


@query(
    "SELECT d.source AS book_id, d.doc_id AS chunk_no FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"
)
def join_outputs_minus_meta(t):
    return (
        t.docs_as_chunks().join(t("labels").select(F.col("doc_id").alias("chunk_no")), "chunk_no", "left_anti")
        .select("book_id", "chunk_no")
    )


@query(
    "SELECT d.source AS book_id, d.doc_id AS chunk_no, l.doc_id IS NOT NULL AS has_output FROM documents d LEFT JOIN labels l USING (doc_id)"
)
def join_manifest_outputs(t):
    outs = t("labels").select(F.col("doc_id").alias("chunk_no"), F.lit(True).alias("has"))
    return t.docs_as_chunks().join(outs, "chunk_no", "left").select("book_id", "chunk_no", F.col("has").isNotNull().alias("has_output"))


@query(
    "SELECT source AS book_id, count(*) AS n_metas, CAST(length(string_agg(left(text, 200), '' ORDER BY doc_id)) AS BIGINT) AS n FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents SEMI JOIN labels USING (doc_id)) WHERE k <= 20 GROUP BY source"
)
def join_snippets_semi(t):
    with_meta = t.docs_as_chunks().join(t("labels").select(F.col("doc_id").alias("chunk_no")), "chunk_no", "left_semi")
    return P.snippets_limit(with_meta).groupBy("book_id").agg(F.count("*").alias("n_metas"), F.sum(F.length("snippet")).alias("n"))


@query("SELECT source AS book_id, '{\"chunks\":' || count(*) || ',\"arcs\":0,\"issues\":' AS head FROM documents GROUP BY source")
def post_mortem_payload(t):
    chunks = t.docs_as_chunks()
    issues = chunks.select("book_id", "chunk_no", F.lit("high").alias("severity"), F.lit("other").alias("category"))
    arcs = t.sql("SELECT CAST(NULL AS STRING) AS book_id, 1 AS arc_no").where("false")
    return P.post_mortem_payload(chunks, arcs, issues).select("book_id", F.regexp_extract("payload", r"^(.*?issues\":)", 1).alias("head"))


@query("SELECT 'b' AS book_id, true AS whole")
def pronoun_payload(t):
    metas, terms, _ = _merging(t)
    outputs = metas.select("book_id", "chunk_no", F.concat(F.lit("text "), F.col("chunk_no").cast("string")).alias("text"))
    p = P.pronoun_payload(terms, metas.where("chunk_no < 4"), outputs).select("book_id", "payload")
    parsed = F.try_parse_json("payload")
    return p.select(
        "book_id",
        (F.expr("variant_get(try_parse_json(payload), '$.snippets[2].text', 'string')") == "text 3").alias("whole")
        & parsed.isNotNull()
    ).toDF("book_id", "whole")


@query(
    "SELECT conv_id AS book_id, count(*) AS n_files, CAST(sum(length(text)) AS BIGINT) AS n_bytes, CAST(sum(length(text)) AS BIGINT) // 2 AS est_chars, greatest(1, (CAST(sum(length(text)) AS BIGINT) // 2) // 30000) AS est_chunks FROM conversations GROUP BY conv_id"
)
def conversation_stats(t):
    return B.content_file_stats(t.turns().select("book_id", F.length("text").cast("bigint").alias("size")))
