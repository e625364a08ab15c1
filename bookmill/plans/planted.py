"""Queries that plant structure in the tables' rows, so that SQL can tell what an operator must find in every one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import Payload
from ..functions import clean, text as T
from ..operators import build, glossary as G, payload as P, qa as Q, sections as S, state as ST, structure as U
from ..sources import books as B
from ..streaming import ingest
from .registry import query
from .texts import _NUMBERED, manifest

_ONE_LINE = "trim(regexp_replace(regexp_replace(text, '[^A-Za-z ]+', ' ', 'g'), ' +', ' ', 'g'))"
# The same in one pass, as a run of anything but letters becomes one space: several times faster in Java's expressions.
_ONE_LINE_SPARK = "trim(regexp_replace(text, '[^A-Za-z]+', ' '))"


def _documents(t, **columns: str) -> DataFrame:
    """Documents with `one`, their text as one line of letters and spaces, and further columns by expression."""
    rows = t("documents").withColumn("one", F.expr(_ONE_LINE_SPARK))
    return rows.withColumns({k: F.expr(v) for k, v in columns.items()})


_D = f"WITH d AS (SELECT *, {_ONE_LINE} AS one FROM documents)"


@query(
    """SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(trim(name)), '[''`]', '', 'g'), '[^a-z0-9]+', '_', 'g'), '_') AS id
    FROM (SELECT p_partkey, p_name || CASE p_partkey % 4 WHEN 0 THEN '''s' WHEN 1 THEN ' & Co.' WHEN 2 THEN '  (x) ' ELSE '' END AS name FROM part)"""
)
def make_term_id_table(t):
    end = F.expr("""CASE p_partkey % 4 WHEN 0 THEN "'s" WHEN 1 THEN ' & Co.' WHEN 2 THEN '  (x) ' ELSE '' END""")
    return t("part").select("p_partkey", T.make_term_id(F.concat("p_name", end)).alias("id"))


@query(
    "SELECT p_brand AS book_id, count(*) AS n_terms, count(*) AS n_ids, count(*) FILTER (WHERE k = 1) AS n_kept_first FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS k FROM part) GROUP BY p_brand"
)
def ensure_term_ids_table(t):
    """No two terms of a book have one id, though names and given ids are planted to clash; a book's first given id stays."""
    given = "CASE WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 3 = 1 THEN lower(p_type) ELSE replace(p_name, ' ', '_') || CASE WHEN p_partkey % 2 = 0 THEN '_2' ELSE '' END END"
    first = F.row_number().over(_by("p_brand", "p_partkey"))
    rows = t("part").select(
        F.col("p_brand").alias("book_id"), F.col("p_partkey").alias("pos"), F.col("p_name").alias("source"),
        F.expr(given).alias("id"), first.alias("k")
    )
    rows = rows.withColumn(
        "id", F.when((F.col("k") == 1) & (F.col("id") == ""), "first").otherwise(F.col("id"))
    ).withColumn("given", F.col("id"))
    done = G.ensure_term_ids(rows)
    kept = F.count_if((F.col("k") == 1) & (F.col("id") == F.col("given")))
    return done.groupBy("book_id").agg(F.count("*").alias("n_terms"), F.countDistinct("id").alias("n_ids"), kept.alias("n_kept_first"))


def _by(part: str, order: str):
    from pyspark.sql import Window

    return Window.partitionBy(part).orderBy(order)


@query(
    """SELECT doc_id, CAST(CASE WHEN doc_id % 4 IN (1, 2) THEN doc_id % 4 END AS BIGINT) AS level, CASE WHEN doc_id % 4 IN (1, 2) THEN 'T' || doc_id || ' x' ELSE '' END AS title FROM documents"""
)
def parse_heading_table(t):
    line = "repeat('#', cast(doc_id % 4 as int)) || ' T' || doc_id || ' x' || CASE WHEN doc_id % 3 = 0 THEN ' {#id .c}  ' ELSE '' END"
    return _documents(t, line=line).select(
        "doc_id", T.heading_level(F.col("line")).alias("level"), T.heading_title(F.col("line")).alias("title")
    )


_TITLES = "CASE p_size % 5 WHEN 0 THEN 'CONTENTS' WHEN 1 THEN 'notes of ' || p_name WHEN 2 THEN 'Notebook ' || p_name WHEN 3 THEN '(front matter)' ELSE p_name END"


@query(
    "SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'frontback' WHEN 1 THEN 'frontback' WHEN 3 THEN 'front' ELSE 'narrative' END AS kind FROM part"
)
def section_kind_table(t):
    return t("part").select("p_partkey", T.section_kind(F.expr(_TITLES)).alias("kind"))


@query(
    """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Chapter ' || p_partkey WHEN 1 THEN 'Also by' ELSE array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') END AS title FROM part"""
)
def title_from_basename_table(t):
    name = "CASE p_partkey % 3 WHEN 0 THEN 'Chapter' || lpad(cast(p_partkey as string), 12, '0') WHEN 1 THEN 'AlsoBy' ELSE replace(p_name, ' ', '_') END"
    return t("part").select("p_partkey", T.title_from_basename(F.expr(name)).alias("title"))


@query("SELECT p_partkey, p_partkey % 3 = 0 AS ok FROM part")
def is_valid_source_table(t):
    name = "CASE p_partkey % 3 WHEN 0 THEN p_name || \"'s-x\" WHEN 1 THEN p_name || ' 2' ELSE '-' || p_name END"
    return t("part").select("p_partkey", T.is_valid_source(F.expr(name)).alias("ok"))


@query(
    """SELECT p_partkey, CASE WHEN p_partkey % 3 < 2 THEN a END AS first_name, CASE WHEN p_partkey % 3 = 1 THEN 'of the' END AS middle_name, CASE WHEN p_partkey % 3 < 2 THEN b END AS last_name, CASE WHEN p_partkey % 3 = 2 THEN a END AS nickname
    FROM (SELECT p_partkey, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b FROM part)"""
)
def fill_author_table(t):
    a, b = "split_part(p_name, ' ', 1)", "split_part(p_name, ' ', 2)"
    name = f"CASE p_partkey % 3 WHEN 0 THEN {b} || ',  ' || {a} WHEN 1 THEN {a} || ' of the ' || {b} ELSE {a} END"
    return (
        t("part").select("p_partkey", T.fill_author(F.expr(name)).alias("a"))
        .select("p_partkey", "a.first_name", "a.middle_name", "a.last_name", "a.nickname")
    )


@query(
    "SELECT page_id, ['image/png', 'image/jpeg', 'image/svg+xml', 'application/octet-stream', 'image/webp'][page_id % 5 + 1] AS content_type FROM pages"
)
def guess_content_type_table(t):
    path = F.concat(
        "url", F.lit("/"),
        F.expr("element_at(array('a.png', 'b.c.JPG', 'x.svg', 'noext', 'y.WebP'), cast(page_id % 5 as int) + 1)")
    )
    return t("pages").select("page_id", T.guess_content_type(path).alias("content_type"))


@query(
    "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'chapter' WHEN 1 THEN 'part' WHEN 2 THEN 'interlude' END AS kind, CASE p_partkey % 4 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN 'two' WHEN 2 THEN CAST(p_partkey AS VARCHAR) END AS grp FROM part"
)
def match_arc_table(t):
    label = "CASE p_partkey % 4 WHEN 0 THEN 'CHAPTER ' || p_size || ': ' || p_name WHEN 1 THEN ' Part Two' WHEN 2 THEN 'Interlude ' || p_partkey ELSE 'the ' || p_name END"
    return t("part").select("p_partkey", U.match_arc(F.expr(label)).alias("a")).select("p_partkey", "a.kind", "a.grp")


# Footnotes and quotations: line 1 has two markers, line 2 the text, line 3 a definition in even documents, line 4 a quotation.
_NOTED = (
    "'One[^' || doc_id || '] two[^x].' || chr(10) || one || chr(10) || CASE WHEN doc_id % 2 = 0 THEN '[^' || doc_id || ']: note ' || doc_id ELSE 'no note' END || chr(10) || '> quoted words of number ' || doc_id || ' and more'"
)


def _noted(t) -> DataFrame:
    return _documents(t, whole=_NOTED).select(F.col("doc_id").alias("book_id"), F.col("whole").alias("text"))


@query(
    _D + " SELECT doc_id AS book_id, CAST(doc_id AS VARCHAR) AS marker, 'note ' || doc_id AS definition_text, CAST(length('One[^' || doc_id || '] two[^x].') + 1 + length(one) + 1 AS BIGINT) AS position, CAST(3 AS BIGINT) AS line FROM d WHERE doc_id % 2 = 0"
)
def footnote_defs_table(t):
    return U.footnote_defs(_noted(t))


@query(
    "SELECT doc_id AS book_id, CAST(doc_id AS VARCHAR) AS marker, CAST(1 AS BIGINT) AS line, CAST(0 AS BIGINT) AS k FROM documents UNION ALL SELECT doc_id, 'x', 1, 1 FROM documents"
)
def footnote_markers_table(t):
    return U.footnote_markers(_noted(t))


@query(
    "SELECT doc_id AS book_id, 'x' AS marker, 'no_definition' AS side FROM documents UNION ALL SELECT doc_id, CAST(doc_id AS VARCHAR), 'no_definition' FROM documents WHERE doc_id % 2 = 1"
)
def footnote_orphans_table(t):
    return U.footnote_orphans(_noted(t))


@query("SELECT doc_id AS book_id, CAST(4 AS BIGINT) AS line, 'quoted words of number ' || doc_id || ' and more' AS quote FROM documents")
def inline_quotes_table(t):
    return U.inline_quotes(_noted(t))


@query(
    "SELECT doc_id AS book_id, CAST(0 AS BIGINT) AS n_epigraphs, CAST(1 - doc_id % 2 AS BIGINT) AS n_definitions, CAST(2 AS BIGINT) AS n_markers, CAST(1 AS BIGINT) AS n_quotes FROM documents"
)
def structural_summary_table(t):
    return U.structural_summary(_noted(t))


_EPIGRAPH = "'Short words ' || doc_id || '.' || chr(10) || CASE WHEN doc_id % 2 = 0 THEN '— A. B.' ELSE '' END || chr(10) || '# Chapter ' || doc_id || chr(10) || one"


@query(
    "SELECT doc_id AS book_id, CAST(2 AS BIGINT) AS before_heading_line, 'Chapter ' || doc_id AS heading_text, CAST(1 AS BIGINT) AS heading_level, 'Short words ' || doc_id || '.' AS quoted_text, CASE WHEN doc_id % 2 = 0 THEN 'A. B.' END AS attribution FROM documents"
)
def detect_epigraphs_table(t):
    return U.detect_epigraphs(
        _documents(t, whole=_EPIGRAPH).select(F.col("doc_id").alias("book_id"), F.col("whole").alias("text"))
    ).drop("text")


# Markdown as converters leave it, around each document's text.
_CONVERTED = (
    "'::: {.c}' || chr(10) || '# T' || doc_id || ' {#calibre_link-1}' || chr(10) || '[W]{.minio}ord ' || one || ' [l](#calibre_link-9){.x}' || chr(10) || '[]{#pg_1 .p}' || chr(10) || chr(10) || chr(10) || '{.note}' || chr(10) || 'end' || chr(10) || ':::'"
)


@query(
    _D + " SELECT doc_id, md5('# T' || doc_id || chr(10) || 'Word ' || one || ' l' || chr(10) || chr(10) || 'end' || chr(10)) AS digest FROM d"
)
def clean_markdown_table(t):
    return _documents(t, whole=_CONVERTED).select("doc_id", F.md5(clean.clean_markdown(F.col("whole"))).alias("digest"))


@query(_D + " SELECT doc_id, md5('Before.' || chr(10) || '# Real ' || doc_id || chr(10) || 'Text ' || one || '.') AS digest FROM d")
def strip_toc_table(t):
    whole = "'Before.' || chr(10) || '## Contents' || chr(10) || chr(10) || '- One' || chr(10) || '[Two](#b)' || chr(10) || 'Three' || chr(10) || '# Real ' || doc_id || chr(10) || 'Text ' || one || '.'"
    return _documents(t, whole=whole).select("doc_id", F.md5(clean.strip_toc(F.col("whole"))).alias("digest"))


@query(
    "SELECT page_id, CASE page_id % 4 WHEN 0 THEN '![image](images/p' || page_id || '.png)' WHEN 1 THEN '![Map](images/p' || page_id || '.png)' WHEN 2 THEN '![x](images/p' || page_id || '.png)' ELSE 'no ![y](images/q.png) more' END AS images FROM pages"
)
def normalize_images_table(t):
    name = "'p' || page_id || '.png'"
    whole = f"""CASE page_id % 4 WHEN 0 THEN '<figure><img src="../images/' || {name} || '"></figure>' WHEN 1 THEN '<img alt="Map" src="a/b/' || {name} || '"/>' WHEN 2 THEN '![x](../images/' || {name} || ')' ELSE 'no ![y](deep/images/q.png) more' END"""
    return t("pages").select("page_id", clean.normalize_images(F.expr(whole)).alias("images"))


@query("SELECT doc_id, md5(replace(text, chr(92), '')) AS digest FROM documents")
def unescape_md_table(t):
    bare = F.replace("text", F.lit("\\"), F.lit(""))
    return t("documents").select("doc_id", F.md5(T.unescape_md(F.regexp_replace(bare, r"([.!*_#>|~\-])", r"\\$1"))).alias("digest"))


@query("SELECT doc_id, CASE WHEN length(text) < 500 THEN text ELSE left(text, 50) END AS payload FROM documents")
def payload_size_switch(t):
    return t("documents").select("doc_id", P.size_switch(F.col("text"), F.left("text", F.lit(50)), 500).alias("payload"))


# A faulty line at the end of each document: (check, line, what is found).
_FAULTS = (
    ("garbage_dashes", "a — — — b", "— — —"), ("js_artifacts", "x [object Object] y", "[object Object]"),
    ("empty_headings", "## ", "## "), ("doubled_punct", "word.,word", ".,"),
    ("placeholders", "see {TERM_TABLE} here", "{TERM_TABLE}"),
    ("dialogue_quotes", '"Hi there" said', '"Hi there" said'), ("untranslated_headings", "# Три", "# Три"),
    ("dash_hyphen", "a - b", " - "), ("dates", "мая 12 день", "мая 12"),
    ("paired_spelling", "в отличии от", "в отличие от"),
)


def _faulty(t, checks: tuple[str, ...]) -> DataFrame:
    lines = F.array(*(F.lit(line) for _, line, _ in _FAULTS))
    rows = t("documents").select(
        "doc_id",
        F.concat(
            "text", F.lit("\n"), F.element_at(lines, (F.col("doc_id") % len(_FAULTS)).cast("int") + 1)
        ).alias("text")
    )
    last = rows.select("doc_id", F.size(F.split("text", "\n")).alias("line"))
    return Q.line_issues(rows, checks).join(last, ["doc_id", "line"]).select("doc_id", "check_name", "message")


def _faults_sql(checks) -> str:
    rows = ", ".join(f"({k}, '{name}', '{found}')" for k, (name, _, found) in enumerate(_FAULTS) if name in checks)
    return f"SELECT doc_id, check_name, message FROM documents JOIN (VALUES {rows}) v(k, check_name, message) ON doc_id % {len(_FAULTS)} = k"


@query(_faults_sql(Q.LINE_CHECKS))
def qa_line_rules_table(t):
    return _faulty(t, tuple(Q.LINE_CHECKS))


@query(_faults_sql(Q.EARLY))
def qa_early_checks(t):
    return _faulty(t, Q.EARLY)


def _glossary(t) -> DataFrame:
    """The parts of a brand as a book's terms."""
    return t("part").select(
        F.col("p_brand").alias("book_id"), F.col("p_partkey").alias("pos"),
        F.when(F.col("p_partkey") % 5 > 0, F.lower("p_type")).otherwise("").alias("id"),
        F.col("p_name").alias("source"),
        F.when(F.col("p_partkey") % 11 > 0, F.col("p_type")).otherwise(" ").alias("target"),
        F.array(F.concat(F.lit("alias"), F.col("p_partkey").cast("string"))).alias("aliases"),
        F.expr("element_at(array('person', 'hero', 'term'), p_size % 3 + 1)").alias("category"),
        F.lit("unknown").alias("gender"),
        F.expr("element_at(array('low', 'high'), p_size % 2 + 1)").alias("confidence"),
        (F.col("p_size") % 4).alias("frequency"), F.array().cast("array<string>").alias("evidence_refs"),
        F.when(F.col("p_partkey") % 2 == 0, "old").otherwise("").alias("notes"),
    )


_GLOSSARY = """WITH g AS (SELECT p_brand AS book_id, p_partkey AS pos, CASE WHEN p_partkey % 5 > 0 THEN lower(p_type) ELSE '' END AS id, p_name AS source, CASE WHEN p_partkey % 11 > 0 THEN p_type ELSE ' ' END AS target,
['person', 'hero', 'term'][p_size % 3 + 1] AS category, ['low', 'high'][p_size % 2 + 1] AS confidence, p_size % 4 AS frequency, CASE WHEN p_partkey % 2 = 0 THEN 'old' ELSE '' END AS notes FROM part),
c AS (SELECT *, count(*) OVER (PARTITION BY book_id, lower(source)) AS names, count(*) OVER (PARTITION BY book_id, id) AS ids FROM g)"""


@query(
    _GLOSSARY
    + """ SELECT book_id, pos, 'error' AS severity, 'empty_target' AS rule FROM c WHERE trim(target) = '' UNION ALL SELECT book_id, pos, 'error', 'missing_id' FROM c WHERE id = '' UNION ALL SELECT book_id, pos, 'error', 'duplicate_id' FROM c WHERE id <> '' AND ids > 1
    UNION ALL SELECT book_id, pos, 'error', 'duplicate_source' FROM c WHERE names > 1 UNION ALL SELECT book_id, pos, 'warning', 'bad_category' FROM c WHERE category = 'hero' UNION ALL SELECT book_id, pos, 'warning', 'frequency_' || frequency FROM c WHERE frequency < 2"""
)
def validate_glossary_table(t):
    return G.validate_glossary(_glossary(t))


@query(
    _GLOSSARY
    + """ SELECT book_id, pos, CASE WHEN w THEN 'high' ELSE confidence END AS confidence, CASE WHEN w AND confidence <> 'high' THEN CASE WHEN notes = '' THEN 'seen' ELSE notes || '; seen' END ELSE notes END AS notes
    FROM (SELECT *, lower(source) = 'red widget' OR pos = 7 OR id = 'economy' AS w FROM g)"""
)
def confirm_terms_table(t):
    return G.confirm_terms(
        _glossary(t), names=["Red Widget", "ALIAS7"], ids=["economy"], note="seen"
    ).select("book_id", "pos", "confidence", "notes")


@query(_GLOSSARY + " SELECT book_id, pos, '' AS notes FROM g WHERE frequency > 0")
def reset_run_state_table(t):
    return G.reset_terms(_glossary(t), prune_zero=True).select("book_id", "pos", "notes")


_PROPOSED = "p_partkey % 7 <> 3"


@query(
    f"""WITH m AS (SELECT p_brand AS book_id, p_partkey AS chunk_no, p_name AS name, p_type AS target FROM part WHERE {_PROPOSED}),
    g AS (SELECT book_id, name, list_sort(list(DISTINCT target)) AS targets, list_sort(list(DISTINCT chunk_no)) AS chunks FROM m GROUP BY book_id, name)
    SELECT book_id, CASE WHEN len(targets) = 1 THEN 'auto' ELSE 'decision' END AS outcome, CASE WHEN len(targets) = 1 THEN 'add_entity' ELSE 'conflicting_new_entity_proposals' END AS kind, name AS source,
    CASE WHEN len(targets) = 1 THEN 'term' END AS field, CASE WHEN len(targets) = 1 THEN targets[1] END AS value, CASE WHEN len(targets) > 1 THEN array_to_string(targets, ' | ') END AS options, array_to_string(chunks, ' | ') AS chunks FROM g"""
)
def prepare_merge_table(t):
    """Every part proposes its name with its type as the translation; some metas are no JSON, and some were applied before."""
    entity = F.to_json(
        F.struct(
            F.array(
                F.struct(
                    F.col("p_name").alias("source"), F.col("p_type").alias("target_proposal"),
                    F.lit("term").alias("category")
                )
            ).alias("new_entities")
        )
    )
    meta = F.when(F.expr(_PROPOSED) | (F.col("p_partkey") % 2 == 0), entity).otherwise(F.lit("{no json"))
    metas = t("part").select(F.col("p_brand").alias("book_id"), F.col("p_partkey").alias("chunk_no"), meta.alias("meta"))
    applied = metas.where("chunk_no % 7 = 3").select("book_id", "chunk_no", F.sha2("meta", 256).alias("hash"))
    return G.prepare_merge(metas, _glossary(t).limit(0), applied).drop("id")


@query(
    """SELECT source AS book_id, doc_id AS chunk_no, quality = 0 AS failed, CASE WHEN quality = 0 THEN 'poor ' || doc_id ELSE '' END AS failure_reason FROM documents JOIN labels USING (doc_id)"""
)
def mark_failed_table(t):
    rows = (
        t("documents").join(t("labels"), "doc_id")
        .select(
            F.col("source").alias("book_id"), F.col("doc_id").alias("chunk_no"), F.lit(False).alias("failed"),
            F.lit("").alias("failure_reason"), "quality"
        )
    )
    failures = rows.where("quality = 0").select(
        "book_id", "chunk_no", F.concat(F.lit("poor "), F.col("chunk_no").cast("string")).alias("reason")
    )
    return ST.mark_failed(rows.drop("quality"), failures)


@query(
    "SELECT doc_id AS book_id, CASE WHEN doc_id % 3 = 0 THEN 'source_changed' WHEN doc_id % 4 = 1 THEN 'outputs_exist' ELSE 'ok' END AS gate FROM documents"
)
def fingerprint_gate_table(t):
    docs = t("documents")
    before = F.when(F.col("doc_id") % 3 == 0, F.lit("other")).otherwise(F.sha2("text", 256))
    sources = docs.select(F.col("doc_id").alias("book_id"), F.col("text").alias("content"))
    return ST.fingerprint_gate(
        sources,
        docs.where("doc_id % 5 <> 4 OR doc_id % 3 = 0").select(
            F.col("doc_id").alias("book_id"), before.alias("source_sha256")
        ),
        docs.where("doc_id % 4 = 1").select(F.col("doc_id").alias("book_id"))
    )


_STATE = """WITH e AS (SELECT user_id AS book_id, ts, event_id AS seq, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)"""


@query(
    _STATE
    + """, f AS (SELECT book_id, event_type, min(struct_pack(t := ts, s := seq)) AS first_at FROM e GROUP BY book_id, event_type)
    SELECT book_id, 'last' AS key, 'text' AS kind, max_by(event_type, struct_pack(t := ts, s := seq)) AS value FROM e GROUP BY book_id
    UNION ALL SELECT book_id, 'k', 'int', CAST(max_by(k, struct_pack(t := ts, s := seq)) AS VARCHAR) FROM e GROUP BY book_id
    UNION ALL SELECT book_id, 'types', 'list', string_agg(event_type, ',' ORDER BY first_at) FROM f GROUP BY book_id"""
)
def state_save(t):
    """Every event saves a step with four options: a text, an integer, one that is none, and an entry of a list."""
    option = lambda op, key, value: F.struct(
        F.lit(op).alias("op"), F.lit(key).alias("key"), value.cast("string").alias("value")
    )
    k = F.get_json_object("props", "$.k")
    options = F.array(
        option("set", "last", F.col("event_type")), option("set_int", "k", F.concat(F.lit(" "), k)),
        option("set_int", "none", F.col("event_type")), option("append", "types", F.col("event_type"))
    )
    rows = t("events").select(
        F.col("user_id").alias("book_id"), "ts", F.col("event_id").alias("seq"),
        (F.col("event_id") % 10 + 1).cast("int").alias("step"), F.lit(None).cast("string").alias("note"),
        options.alias("options")
    )
    log = ST.state_save(rows.where("seq % 2 = 0"), rows.where("seq % 2 = 1").drop("seq"))
    fixed = (
        log.drop("seq")
        .join(rows.select("book_id", "ts", "seq", "step", F.col("options").alias("o")), ["book_id", "ts", "step"])
        .where("options = o").drop("o")
    )
    return ST.state_values(fixed.select(*rows.columns))


@query(
    _NUMBERED
    + """, w AS (SELECT c.*, d.lang, 'chunk' || lpad(CAST(chunk_no AS VARCHAR), CAST(greatest(4, length(CAST(chunk_no AS VARCHAR))) AS INTEGER), '0') AS chunk_id FROM c JOIN documents d USING (doc_id)),
    s AS (SELECT book_id, count(*) AS n, min(size) AS lo, max(size) AS hi, CAST(sum(size) AS BIGINT) // count(*) AS mean FROM w GROUP BY book_id)
    SELECT book_id, CAST(0 AS BIGINT) AS line_no, 'chunk_id     level      size  section_title' AS line FROM s
    UNION ALL SELECT book_id, chunk_no, rpad(chunk_id, CAST(greatest(12, length(chunk_id)) AS INTEGER), ' ') || ' ' || rpad('1', 6, ' ') || ' ' || lpad(CAST(size AS VARCHAR), 8, ' ') || '  ' || coalesce(lang, 'null') FROM w
    UNION ALL SELECT book_id, n + 1, n || ' chunks, size min ' || lo || ', max ' || hi || ', mean ' || mean FROM s"""
)
def inspect_manifest(t):
    return S.inspect_manifest(manifest(t))


@query(
    """WITH o AS (SELECT conv_id AS book_id, turn, text FROM conversations WHERE NOT (conv_id % 4 = 0 AND turn = 1)), s AS (SELECT *, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS bare FROM o),
    m AS (SELECT book_id, string_agg(bare, chr(10) || chr(10) ORDER BY turn) AS md FROM s WHERE bare <> '' GROUP BY book_id), e AS (SELECT book_id, count(*) AS n FROM s WHERE bare = '' GROUP BY book_id),
    g AS (SELECT conv_id AS book_id, count(*) AS n FROM conversations WHERE conv_id % 4 = 0 AND turn = 1 GROUP BY conv_id)
    SELECT b.book_id, coalesce(g.n, 0) + coalesce(e.n, 0) AS n_hard, coalesce(e.n, 0) AS n_empty, md5(coalesce(m.md, '')) AS digest FROM (SELECT DISTINCT CAST(conv_id AS VARCHAR) AS book_id, conv_id FROM conversations) b
    LEFT JOIN m ON m.book_id = conv_id LEFT JOIN e ON e.book_id = conv_id LEFT JOIN g ON g.book_id = conv_id"""
)
def build_books(t):
    """Conversations as books, their turns as chunks; of each fourth one, turn 1 is missing."""
    turns = t.turns().select("book_id", "chunk_no", "text")
    outputs = turns.where("NOT (book_id % 4 = 0 AND chunk_no = 1)")
    author = T.fill_author(F.lit("Ann Bee"))
    headers = (
        turns.select("book_id").distinct()
        .select(
            "book_id", F.col("book_id").cast("string").alias("title"), author.alias("author"),
            F.lit("en").alias("lang"), F.lit("2020-01-01").alias("date"), F.lit("u").alias("uid")
        )
    )
    built = build.build_books(turns.select("book_id", "chunk_no", F.sha2("text", 256).alias("source")), turns, outputs, headers)
    hard = F.filter("findings", lambda x: x.rlike("missing_output|empty_output|hash_mismatch"))
    return built.select("book_id", F.size(hard).alias("n_hard"), "n_empty", F.md5("md").alias("digest"))


@query(
    """WITH i AS (SELECT source AS book_id, doc_id AS chunk_no, quality, toxic FROM documents JOIN labels USING (doc_id)),
    c AS (SELECT book_id, string_agg('"chunk' || lpad(CAST(chunk_no AS VARCHAR), CAST(greatest(4, length(CAST(chunk_no AS VARCHAR))) AS INTEGER), '0') || '":{"severity_counts":{"high":' || toxic || ',"medium":' || (2 - toxic) || ',"low":0},"category_counts":{' || CASE WHEN quality = 0 THEN '"other":1,"style":1' ELSE '"style":2' END || '}}', ',' ORDER BY chunk_no) AS few FROM i GROUP BY book_id),
    n AS (SELECT source AS book_id, count(*) AS n FROM documents GROUP BY source)
    SELECT book_id, '{"chunks":' || n || ',"arcs":0,"issues":' || CASE WHEN few IS NULL THEN '[]' ELSE '{' || few || '}' END || '}' AS payload FROM n LEFT JOIN c USING (book_id)"""
)
def post_mortem_counts(t):
    """Two issues for each labelled document, counted for each chunk since the threshold is none."""
    marked = (
        t("documents").join(t("labels"), "doc_id")
        .select(F.col("source").alias("book_id"), F.col("doc_id").alias("chunk_no"), "quality", "toxic")
    )
    first = marked.select(
        "book_id", "chunk_no", F.when(F.col("toxic") == 1, "high").alias("severity"),
        F.when(F.col("quality") == 1, "style").alias("category")
    )
    second = marked.select("book_id", "chunk_no", F.lit("medium").alias("severity"), F.lit("style").alias("category"))
    arcs = t.sql("SELECT CAST(NULL AS STRING) AS book_id, 1 AS arc_no").where("false")
    return P.post_mortem_payload(t.docs_as_chunks(), arcs, first.unionByName(second), Payload(aggregate_threshold=0))


_FB2_HEAD = "'<FictionBook><description><title-info><genre>g</genre><author><nickname>n</nickname></author><book-title>t</book-title><lang>en</lang></title-info><document-info><author><nickname>n</nickname></author><date>d</date><id>i</id><version>1</version></document-info></description>'"
_FB2_BODY = "CASE doc_id % 4 WHEN 0 THEN '<p>' || one || '</p>' WHEN 1 THEN '<p>' || one || '</p><title/>' WHEN 2 THEN '<title/><p><b>' || one || '</b></p>' ELSE '<p>' || one || '</section>' END"


@query(
    "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'line 2: section can''t hold p, title' WHEN 2 THEN 'line 2: p can''t hold b' ELSE 'line 2: not well-formed' END AS faults FROM documents"
)
def fb2_schema_validate(t):
    whole = f"{_FB2_HEAD} || '<body>' || chr(10) || '<section>' || {_FB2_BODY} || '</section></body></FictionBook>'"
    return _documents(t, whole=whole).select("doc_id", build.fb2_schema_validate("whole").alias("faults"))


@query(
    """WITH e AS (SELECT user_id, event_id, ts, CASE WHEN ts - lag(ts) OVER w > INTERVAL 30 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM e) SELECT user_id, min(ts) AS first_ts, count(*) AS n FROM s GROUP BY user_id, k"""
)
def sessions(t):
    """Events of a user less than 30 minutes apart, by the same aggregation that runs on a stream."""
    return ingest.sessions(t("events")).select("user_id", F.col("start").alias("first_ts"), F.col("n_events").alias("n"))


@query(
    "SELECT p_brand AS book_id, 't' || p_partkey AS id, sha256('{\"aliases\": [\"' || p_type || '\", \"x\\\"y\"], \"gender\": \"\", \"source\": \"' || p_name || '\", \"target\": \"Имя ' || p_size || '\"}') AS hash FROM part"
)
def entity_hashes_table(t):
    terms = t("part").select(
        F.col("p_brand").alias("book_id"), F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("id"),
        F.col("p_name").alias("source"), F.concat(F.lit("Имя "), F.col("p_size").cast("string")).alias("target"),
        F.array("p_type", F.lit('x"y')).alias("aliases"), F.lit(None).cast("string").alias("gender"),
    )
    return ST.entity_hashes(terms)


@query("SELECT event_id, event_id % 3 <> 1 AS ok, CASE WHEN event_id % 3 = 1 THEN 'Expecting' END AS error FROM events")
def check_json_table(t):
    """Every third text of props lacks its end."""
    whole = F.when(F.col("event_id") % 3 == 1, F.substring_index("props", ":", 1)).otherwise(F.col("props"))
    error = B.check_json(whole)
    return t("events").select("event_id", error.isNull().alias("ok"), F.left(error, F.lit(9)).alias("error"))


@query(
    _D + ", w AS (SELECT doc_id, string_split(one, ' ') AS ws FROM d) SELECT doc_id, array_to_string(ws[1:8], ', ') || CASE WHEN len(ws) > 8 THEN ' and ' || (len(ws) - 8) || ' more' ELSE '' END AS first_words FROM w"
)
def top_n_reports(t):
    return _documents(t).select("doc_id", T.first_few(F.split("one", " "), 8).alias("first_words"))


@query(
    "SELECT doc_id, CAST(regexp_replace('x' || doc_id || 'y0', '[^0-9]', '', 'g') AS BIGINT) AS n, 'chunk' || lpad(CAST(doc_id AS VARCHAR), CAST(greatest(4, length(CAST(doc_id AS VARCHAR))) AS INTEGER), '0') AS chunk_id FROM documents"
)
def chunk_ids(t):
    name = F.concat(F.lit("x"), F.col("doc_id").cast("string"), F.lit("y0"))
    return t("documents").select(
        "doc_id", T.chunk_number(name).alias("n"),
        T.normalize_chunk_id(F.concat(F.lit("c"), F.col("doc_id").cast("string"))).alias("chunk_id")
    )
