"""Queries of structural units, contracts, checks and state."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..functions.text import sanitize_surrogates
from ..operators import build, contracts as C, payload as P, qa as Q, state as ST, structure as U
from .registry import query



@query(
    """SELECT name, kind, grp FROM (VALUES ('Interlude 5', 'interlude', '5'), ('Chapter 23', 'chapter', '23'), ('Prologue', 'prologue', ''), ('Part II', 'part', 'ii'), ('Глава 7', 'chapter', '7'), ('Book One', 'book', 'one'), ('Foo', NULL, NULL)) v(name, kind, grp)"""
)
def match_arc(t):
    names = t.sql(
        "SELECT * FROM VALUES ('Interlude 5'), ('Chapter 23'), ('Prologue'), ('Part II'), ('Глава 7'), ('Book One'), ('Foo') v(name)"
    )
    return names.select("name", U.match_arc(F.col("name")).alias("a")).select("name", "a.kind", "a.grp")


_ARCS = """WITH l AS (SELECT conv_id AS book_id, turn, CASE role WHEN 'user' THEN 'Part 1' WHEN 'system' THEN 'Prologue' ELSE 'main' END AS label FROM conversations),
n AS (SELECT *, CASE WHEN label IS DISTINCT FROM lag(label) OVER (PARTITION BY book_id ORDER BY turn) THEN 1 ELSE 0 END AS new FROM l), a AS (SELECT *, sum(new) OVER (PARTITION BY book_id ORDER BY turn) AS arc_no FROM n)"""


def _labelled(t):
    label = F.when(F.col("role") == "user", "Part 1").when(F.col("role") == "system", "Prologue").otherwise(F.col("role"))
    return t.turns().withColumn("label", label)


@query(
    _ARCS + """ SELECT book_id, CAST(arc_no AS BIGINT) AS arc_no, min(label) AS label, CASE min(label) WHEN 'Part 1' THEN 'part' WHEN 'Prologue' THEN 'prologue' ELSE 'unknown' END AS kind, min(turn) AS first_chunk, max(turn) AS last_chunk, count(*) AS n_chunks FROM a GROUP BY book_id, arc_no"""
)
def narrative_arcs(t):
    return U.narrative_arcs(_labelled(t))


@query(_ARCS + " SELECT book_id, turn AS chunk_no, CAST(arc_no AS BIGINT) AS arc_no FROM a")
def chunk_to_arc(t):
    return U.chunk_to_arc(_labelled(t))


_NOTES = "'b', 'One[^1] and two[^2].¶[^1]: First note¶>  A quotation that is long enough to count.¶Three[^1] four[^3].¶[^4]: Unused'"


def _noted(t):
    return t.sql(f"SELECT id AS book_id, replace(x, '¶', chr(10)) AS text FROM VALUES ({_NOTES}) v(id, x)")


@query(
    "SELECT 'b' AS book_id, marker, definition_text, CAST(position AS BIGINT) AS position, CAST(line AS BIGINT) AS line FROM (VALUES ('1', 'First note', 21, 2), ('4', 'Unused', 103, 5)) v(marker, definition_text, position, line)"
)
def footnote_defs(t):
    return U.footnote_defs(_noted(t))


@query(
    "SELECT 'b' AS book_id, marker, CAST(line AS BIGINT) AS line, CAST(k AS BIGINT) AS k FROM (VALUES ('1', 1, 0), ('2', 1, 1), ('1', 4, 0), ('3', 4, 1)) v(marker, line, k)"
)
def footnote_markers(t):
    return U.footnote_markers(_noted(t))


@query(
    "SELECT 'b' AS book_id, marker, side FROM (VALUES ('2', 'no_definition'), ('3', 'no_definition'), ('4', 'no_marker')) v(marker, side)"
)
def footnote_orphans(t):
    return U.footnote_orphans(_noted(t))


@query("SELECT 'b' AS book_id, CAST(3 AS BIGINT) AS line, 'A quotation that is long enough to count.' AS quote")
def inline_quotes(t):
    return U.inline_quotes(_noted(t))


@query(
    "SELECT 'b' AS book_id, CAST(0 AS BIGINT) AS n_epigraphs, CAST(2 AS BIGINT) AS n_definitions, CAST(4 AS BIGINT) AS n_markers, CAST(1 AS BIGINT) AS n_quotes"
)
def structural_summary(t):
    return U.structural_summary(_noted(t))


@query(
    "SELECT 'b' AS book_id, CAST(l AS BIGINT) AS before_heading_line, heading_text, CAST(1 AS BIGINT) AS heading_level, quoted_text, attribution FROM (VALUES (3, 'One', 'To be or not.', 'W. S.'), (6, 'Two', 'Body of one.', NULL)) v(l, heading_text, quoted_text, attribution)"
)
def detect_epigraphs(t):
    text = t.sql("SELECT 'b' AS book_id, replace('To be or not.¶— W. S.¶¶# One¶Body of one.¶¶# Two¶x¶# Contents¶y', '¶', chr(10)) AS text")
    return U.detect_epigraphs(text).drop("text")


@query(
    "SELECT CAST(chunk_no AS BIGINT) AS chunk_no, CAST(k AS BIGINT) AS k, footnote_id, CAST(number AS BIGINT) AS number, is_first, body FROM (VALUES (1, 0, 'x', 1, true, 'Note *x*'), (1, 1, 'y', 2, true, 'Note y'), (2, 0, 'y', 2, false, 'Note y')) v(chunk_no, k, footnote_id, number, is_first, body)"
)
def footnote_numbering(t):
    chunks = t.sql(
        r"""SELECT * FROM VALUES ('b', 1, 'a[[*](n.xhtml#x){#r1 .noteref}]{.epub-sup-fn} b[*](n.xhtml#y){.noteref}'), ('b', 2, 'c[*](n.xhtml#y){.noteref} d[*](n.xhtml#z){.noteref}') v(book_id, chunk_no, text)"""
    )
    return U.footnote_numbering(chunks, _bodies(t)).select("chunk_no", "k", "footnote_id", "number", "is_first", "body")


def _bodies(t):
    files = t.sql(
        """SELECT 'b' AS book_id, 'n.xhtml' AS path, '<ol><li epub:type="footnote" id="x"><p>Note <i>x</i></p></li><li id="y" epub:type="footnote">Note y <a class="reversefootnote">back</a></li></ol>' AS html"""
    )
    return U.footnote_bodies(files)


@query("SELECT 'b' AS book_id, footnote_id, body FROM (VALUES ('x', 'Note *x*'), ('y', 'Note y')) v(footnote_id, body)")
def footnote_bodies(t):
    return _bodies(t)


@query(
    "SELECT CAST(chunk_no AS BIGINT) AS chunk_no, replace(text, '¶', chr(10)) AS text FROM (VALUES (1, 'a[^1] b[^2]¶¶[^1]: Note *x*¶¶[^2]: Note y'), (2, 'c[^2] d')) v(chunk_no, text)"
)
def number_footnotes(t):
    chunks = t.sql(
        r"""SELECT * FROM VALUES ('b', 1, 'a[[*](n.xhtml#x){#r1 .noteref}]{.epub-sup-fn} b[*](n.xhtml#y){.noteref}'), ('b', 2, 'c[*](n.xhtml#y){.noteref} d[*](n.xhtml#z){.noteref}') v(book_id, chunk_no, text)"""
    )
    return U.number_footnotes(chunks, _bodies(t)).select("chunk_no", "text")


_PAIRS = "WITH p AS (SELECT source AS book_id, doc_id AS chunk_no, lang AS section_title, lag(text) OVER (PARTITION BY source, doc_id // 1000 ORDER BY doc_id) AS src, text AS out FROM documents), q AS (SELECT * FROM p WHERE src IS NOT NULL)"


@query("""SELECT d.source AS book_id, d.doc_id AS chunk_no, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN length(d.text) // 2 < 100 THEN 'short' WHEN length(d.text) > 0 AND ((length(d.text) // 2) / length(d.text) < 0.6 OR (length(d.text) // 2) / length(d.text) > 2.0) THEN 'bad_ratio' ELSE 'ok' END AS status,
l.doc_id IS NOT NULL AND l.quality = 0 AS missing_meta FROM documents d LEFT JOIN labels l USING (doc_id)""")
def verify_batch(t):
    docs = t.docs_as_chunks()
    labels = t("labels").select(F.col("doc_id").alias("chunk_no"), "quality")
    outputs = docs.join(labels, "chunk_no").select(
        "book_id", "chunk_no", F.left("text", F.floor(F.length("text") / 2).cast("int")).alias("text")
    )
    return C.verify_batch(docs, outputs, docs.join(labels.where("quality = 1"), "chunk_no", "left_semi"))


@query(_PAIRS + """, r AS (SELECT *, regexp_extract_all(out, '[A-Za-z][A-Za-z\\s.,;:''"!?\\-()\\[\\]]{79,}') AS runs, CASE WHEN length(regexp_replace(src, '^\\s+|\\s+$', '', 'g')) = 0 THEN 0 ELSE length(regexp_replace(out, '^\\s+|\\s+$', '', 'g')) / length(regexp_replace(src, '^\\s+|\\s+$', '', 'g')) END AS ra FROM q),
s AS (SELECT *, list_filter(runs, lambda r: regexp_matches(r, '\\b[A-Za-z]{4,}\\b')) AS l FROM r) SELECT book_id, chunk_no, CAST(round(ra, 6) AS DOUBLE) AS ratio, CASE WHEN ra < 0.6 THEN 'LOW' WHEN ra > 2.0 THEN 'HIGH' ELSE 'OK' END AS mark, CAST(len(l) AS BIGINT) AS n_leaks, left(l[1], 60) AS leak FROM s""")
def chunk_ratio(t):
    return C.chunk_ratio(t.pairs())


@query(_PAIRS + """, s AS (SELECT book_id, section_title, CAST(sum(length(src)) AS BIGINT) AS src_chars, CAST(sum(length(regexp_replace(out, '^\\s+|\\s+$', '', 'g'))) AS BIGINT) AS out_chars FROM q WHERE length(src) > 0 GROUP BY book_id, section_title)
SELECT book_id, section_title, src_chars, out_chars, CASE WHEN out_chars / src_chars < 0.6 THEN 'LOW' ELSE 'HIGH' END AS mark, CAST(round(out_chars / src_chars, 6) AS DOUBLE) AS ratio FROM s WHERE out_chars > 0 AND (out_chars / src_chars < 0.6 OR out_chars / src_chars > 2.0)""")
def section_ratio(t):
    return C.section_ratio(t.pairs())


@query(
    _PAIRS + " SELECT book_id, CAST(round(median(length(out) / nullif(length(src), 0)), 6) AS DOUBLE) AS median_ratio FROM q GROUP BY book_id"
)
def median_ratio(t):
    return C.median_ratio(t.pairs())


@query(
    _PAIRS + """, r AS (SELECT book_id, CASE WHEN length(out) / nullif(length(src), 0) < 0.6 THEN 'LOW' WHEN length(out) / nullif(length(src), 0) > 2.0 THEN 'HIGH' ELSE 'OK' END AS m FROM q) SELECT book_id, count(*) FILTER (WHERE m = 'LOW') AS n_low, count(*) FILTER (WHERE m = 'HIGH') AS n_high FROM r GROUP BY book_id"""
)
def sanity_rollup(t):
    r = F.try_divide(F.length("out").cast("double"), F.nullif(F.length("src"), F.lit(0)).cast("double"))
    rows = t.pairs().select(
        "book_id", F.when(r < 0.6, "LOW").when(r > 2.0, "HIGH").otherwise("OK").alias("mark"), F.lit(0).alias("n_leaks")
    )
    return C.sanity_rollup(rows).drop("n_leaking")


_POLISH = """WITH p AS (SELECT source AS book_id, doc_id AS chunk_no, replace(text, chr(10), chr(10) || chr(10)) AS src FROM documents), q AS (SELECT *, CASE WHEN chunk_no % 7 = 0 THEN left(src, length(src) - length(src) * 2 // 3) WHEN chunk_no % 7 = 1 THEN replace(src, chr(10) || chr(10), ' ') WHEN chunk_no % 7 = 2 THEN '' ELSE src END AS out FROM p),
n AS (SELECT *, length(out) / nullif(length(src), 0) AS r, len(list_filter(regexp_split_to_array(src, '\\n\\s*\\n'), lambda x: trim(x, ' ' || chr(10) || chr(9) || chr(13)) <> '')) AS a, len(list_filter(regexp_split_to_array(out, '\\n\\s*\\n'), lambda x: trim(x, ' ' || chr(10) || chr(9) || chr(13)) <> '')) AS b FROM q)"""


def _polished(t):
    src = F.replace("text", F.lit("\n"), F.lit("\n\n"))
    n = F.col("chunk_no") % 7
    out = (
        F.when(n == 0, F.left("src", F.length("src") - F.expr("length(src) * 2 div 3")))
        .when(n == 1, F.replace("src", F.lit("\n\n"), F.lit(" "))).when(n == 2, "").otherwise(F.col("src"))
    )
    return t.docs_as_chunks().select("book_id", "chunk_no", src.alias("src")).withColumn("out", out)


@query(
    _POLISH + " SELECT book_id, chunk_no, CASE WHEN trim(out) = '' THEN 'polished_empty' ELSE array_to_string(list_filter([CASE WHEN r < 0.5 OR r > 2.0 THEN 'ratio' END, CASE WHEN abs(b - a) > greatest(2.0, round_even(a * 0.1, 0)) THEN 'paragraphs' END], lambda x: x IS NOT NULL), '; ') END AS reasons FROM n"
)
def polish_contract(t):
    return C.polish_contract(_polished(t))


@query(
    _POLISH + ", m AS (SELECT *, median(r) OVER (PARTITION BY book_id) AS med FROM n) SELECT book_id, chunk_no, CASE WHEN trim(out) = '' THEN 'polished_empty' ELSE array_to_string(list_filter([CASE WHEN r < 0.5 OR r > 2.0 THEN 'ratio' END, CASE WHEN abs(b - a) > greatest(2.0, round_even(a * 0.1, 0)) THEN 'paragraphs' END, CASE WHEN abs(r - med) > med * 0.25 THEN 'median' END], lambda x: x IS NOT NULL), '; ') END AS reasons FROM m"
)
def verify_polish(t):
    return C.verify_polish(_polished(t))


@query(_POLISH + """, j AS (SELECT *, trim(out) <> '' AND r BETWEEN 0.5 AND 2.0 AND abs(b - a) <= greatest(2.0, round_even(a * 0.1, 0)) AS ok FROM n), u AS (SELECT CASE WHEN ok THEN 'bak' ELSE 'draft' END AS stage, src AS text FROM j UNION ALL SELECT CASE WHEN ok THEN 'draft' ELSE 'polished' END, out FROM j)
SELECT stage, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM u GROUP BY stage""")
def apply_polish(t):
    return C.apply_polish(_polished(t)).groupBy("stage").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("n_chars"))


@query("""SELECT CAST(chunk_no AS BIGINT) AS chunk_no, severity, finding FROM (VALUES (1, 'error', 'missing_source'), (2, 'error', 'missing_output'), (3, 'error', 'empty_output'), (4, 'error', 'hash_mismatch')) v(chunk_no, severity, finding)
UNION ALL SELECT CAST(11 AS BIGINT), 'warning', 'ratio_low' UNION ALL SELECT CAST(12 AS BIGINT), 'warning', 'ratio_high'""")
def validate_manifest(t):
    m = t.sql(
        "SELECT book_id, chunk_no, sha2(s, 256) AS source FROM VALUES ('a', 1, 'x'), ('a', 2, 'x'), ('a', 3, 'x'), ('a', 4, 'old'), ('a', 5, 'x'), ('b', 11, 'long source text'), ('b', 12, 'abc') v(book_id, chunk_no, s)"
    )
    s = t.sql(
        "SELECT * FROM VALUES ('a', 2, 'x'), ('a', 3, 'x'), ('a', 4, 'x'), ('a', 5, 'x'), ('b', 11, 'long source text'), ('b', 12, 'abc') v(book_id, chunk_no, text)"
    )
    o = t.sql(
        "SELECT * FROM VALUES ('a', 1, 'y'), ('a', 3, ' '), ('a', 4, 'y'), ('a', 5, 'yyyyyyyyy'), ('b', 11, 'short'), ('b', 12, 'much longer') v(book_id, chunk_no, text)"
    )
    return C.validate_manifest(m, s, o).select("chunk_no", "severity", "finding")


_QA = (
    ("garbage_dashes", "x — — — y ¶ a --- --- b", ((1, "— — —"), (2, "--- ---"))),
    ("garbage_dashes", "Minsk---Dink", ()),
    ("js_artifacts", "a [undefined] NaN", ((1, "[undefined]"), (1, "undefined"), (1, "NaN"))),
    ("js_artifacts", "nullable", ()), ("empty_headings", "##¶# x", ((1, "##"),)),
    ("doubled_punct", "a.,b¶c?. d!. e", ((1, ".,"), (2, "?."), (2, "!."))),
    ("doubled_punct", "wait... ../images/x", ()),
    ("placeholders", "{TERM_TABLE} {baseDir}", ((1, "{TERM_TABLE}"), (1, "{baseDir}"))),
    ("dialogue_quotes", '"Go on," said he', ((1, '"Go on," said'),)),
    ("untranslated_headings", "# Один¶# Одинокий", ((1, "# Один"),)),
    ("dash_hyphen", "Москва - столица", ((1, " - "),)), ("dash_hyphen", "10 - 20", ()),
    ("dates", "в мая 5 и году 1999", ((1, "мая 5"), (1, "году 1999"))),
    ("paired_spelling", "в течении часа", ((1, "в течение"),)),
)


def _rows(rows) -> str:
    return ", ".join("(" + ", ".join(str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'" for x in r) + ")" for r in rows)


@query(
    f"SELECT CAST(doc_id AS BIGINT) AS doc_id, check_name, CAST(line AS BIGINT) AS line, message FROM (VALUES {_rows([(k, name, line, m) for k, (name, _, found) in enumerate(_QA) for line, m in found])}) v(doc_id, check_name, line, message)"
)
def qa_line_rules(t):
    docs = t.sql(
        f"SELECT id AS doc_id, rule, replace(x, '¶', chr(10)) AS text FROM VALUES {_rows([(k, name, text) for k, (name, text, _) in enumerate(_QA)])} v(id, rule, x)"
    )
    return Q.line_issues(docs.select("doc_id", "text")).join(
        docs.select("doc_id", F.col("rule").alias("check_name")), ["doc_id", "check_name"], "left_semi"
    )


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents), m AS (SELECT doc_id, n, unnest(regexp_extract_all(line, '(?i)"[^"\\n]{2,200}"[,!?.]?\\s*(?:said|exclaimed|asked|replied|whispered|shouted|muttered|сказал|сказала|воскликнул|воскликнула|спросил|спросила|ответил|ответила|прошептал|прошептала|крикнул|пробормотал)')) AS message FROM l)
SELECT count(*) AS n FROM m""")
def qa_dialogue_quotes(t):
    return Q.line_issues(t("documents"), ("dialogue_quotes",)).agg(F.count("*").alias("n"))


@query(
    "SELECT CAST(1 AS BIGINT) AS doc_id, 'orphan_footnotes' AS check_name, CAST(1 AS BIGINT) AS line, '2' AS message UNION ALL SELECT CAST(2 AS BIGINT), 'code_fences', CAST(3 AS BIGINT), '3'"
)
def qa_footnotes_fences(t):
    docs = t.sql(
        "SELECT id AS doc_id, replace(x, '¶', chr(10)) AS text FROM VALUES (1L, 'a[^1] b[^2]¶[^1]: c'), (2L, '```¶x```¶```¶```'), (3L, '```¶```') v(id, x)"
    )
    return Q.orphan_footnotes(docs).unionByName(Q.code_fences(docs).withColumn("line", F.col("line") - 1))


_ISSUES = "WITH i AS (SELECT source AS book_id, doc_id AS chunk_no, CASE doc_id % 5 WHEN 0 THEN 'high' WHEN 1 THEN 'low' WHEN 2 THEN NULL ELSE 'medium' END AS severity FROM documents)"


def _issues(t):
    n = F.col("chunk_no") % 5
    severity = F.when(n == 0, "high").when(n == 1, "low").when(n > 2, "medium")
    return t.docs_as_chunks().select(
        "book_id", (F.col("chunk_no") % 40).alias("chunk_no"), severity.alias("severity"),
        F.lit("other").alias("category")
    )


@query(
    _ISSUES.replace(
        "doc_id AS chunk_no", "doc_id % 40 AS chunk_no"
    ) + " SELECT book_id, chunk_no, count(*) FILTER (WHERE severity = 'high') AS high, count(*) FILTER (WHERE coalesce(severity, 'medium') = 'medium') AS medium, count(*) FILTER (WHERE severity = 'low') AS low FROM i GROUP BY book_id, chunk_no"
)
def qa_severity_counts(t):
    return C.qa_severity_counts(_issues(t))


@query(
    _ISSUES.replace(
        "doc_id AS chunk_no", "doc_id % 40 AS chunk_no"
    ) + " SELECT book_id, chunk_no FROM i GROUP BY book_id, chunk_no HAVING count(*) FILTER (WHERE severity = 'high') > 0 OR count(*) FILTER (WHERE coalesce(severity, 'medium') = 'medium') > 2"
)
def qa_retranslate(t):
    return C.qa_retranslate(C.qa_severity_counts(_issues(t)))


_ROLL = "WITH i AS (SELECT lang AS check_name, doc_id, CAST(1 AS BIGINT) AS line, CAST(n_chars AS VARCHAR) AS message FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY check_name ORDER BY doc_id, line, message) AS n FROM i)"


@query(
    _ROLL + " SELECT check_name, count(*) AS n_issues, string_agg(message, '; ' ORDER BY n) FILTER (WHERE n <= 10) AS first_messages, greatest(count(*) - 10, 0) AS n_more FROM r GROUP BY check_name"
)
def issue_rollup(t):
    issues = t("documents").select(
        F.col("lang").alias("check_name"), "doc_id", F.lit(1).alias("line"),
        F.length("text").cast("string").alias("message")
    )
    return C.issue_rollup(issues)


@query("SELECT lang AS check_name, doc_id % 3 AS doc_id, count(*) AS n FROM documents GROUP BY CUBE (lang, doc_id % 3)")
def severity_cube(t):
    return Q.severity_cube(t("documents").select(F.col("lang").alias("check_name"), (F.col("doc_id") % 3).alias("doc_id")))


_LOG = """WITH e AS (SELECT user_id AS book_id, ts, event_id AS seq, CAST(json_extract(props, '$.k') AS BIGINT) % 10 + 1 AS step FROM events), l AS (SELECT book_id, string_agg(DISTINCT CAST(step AS VARCHAR), ',' ORDER BY CAST(step AS VARCHAR)) AS s, arg_max(step, (ts, seq)) AS last FROM e GROUP BY book_id)"""


@query(
    _LOG + " SELECT book_id, least(last + 1, 10) AS current_step, CASE WHEN least(last + 1, 10) <= 3 THEN CAST(1 AS BIGINT) WHEN least(last + 1, 10) <= 6 THEN 2 ELSE 3 END AS phase FROM l"
)
def state_load(t):
    step = F.expr("variant_get(parse_json(props), '$.k', 'int')") % 10 + 1
    log = t("events").select(
        F.col("user_id").alias("book_id"), "ts", F.col("event_id").alias("seq"), step.alias("step"),
        F.col("event_type").alias("note")
    )
    return ST.state_load(log).select("book_id", "current_step", "phase")


@query(
    "SELECT user_id AS book_id, CAST(r AS BIGINT) AS rank, event_type AS note FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r <= 5"
)
def last_notes(t):
    return P.last_notes(
        t("events").select(
            F.col("user_id").alias("book_id"), "ts", F.col("event_id").alias("seq"), F.col("event_type").alias("note")
        )
    )


@query(
    "SELECT source AS book_id, doc_id AS chunk_no, left(text, 200) AS snippet FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents) WHERE n <= 20"
)
def snippets_limit(t):
    return P.snippets_limit(t.docs_as_chunks())


@query(
    "SELECT source AS book_id, doc_id AS chunk_no FROM (SELECT *, row_number() OVER w AS n, count(*) OVER (PARTITION BY source) AS m FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id)) WHERE n IN (1, m, (m - 1) // 4 + 1, 2 * (m - 1) // 4 + 1, 3 * (m - 1) // 4 + 1)"
)
def glossary_sample(t):
    return P.glossary_sample(t.docs_as_chunks())


@query("SELECT source AS book_id, doc_id AS chunk_no FROM documents WHERE doc_id BETWEEN 100 AND 199")
def chunk_range(t):
    return P.chunk_range(t.docs_as_chunks(), 100, 199).select("book_id", "chunk_no")


@query("SELECT book_id, gate FROM (VALUES ('a', 'source_changed'), ('b', 'outputs_exist'), ('c', 'ok'), ('d', 'ok')) v(book_id, gate)")
def fingerprint_gate(t):
    s = t.sql("SELECT * FROM VALUES ('a', 'new'), ('b', 'same'), ('c', 'same'), ('d', 'first') v(book_id, content)")
    p = t.sql("SELECT book_id, sha2(c, 256) AS source_sha256 FROM VALUES ('a', 'old'), ('b', 'same'), ('c', 'same') v(book_id, c)")
    return ST.fingerprint_gate(s, p, t.sql("SELECT 'b' AS book_id"))


@query(
    """SELECT conv_id AS book_id, turn AS chunk_no, CAST(length('# chunk' || lpad(CAST(turn AS VARCHAR), 4, '0')) AS BIGINT) AS head_chars, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) IS NOT DISTINCT FROM turn - 1 AND length(lag(text) OVER (PARTITION BY conv_id ORDER BY turn)) > 0 AS has_before FROM conversations"""
)
def task_payload(t):
    empty = t.sql("SELECT CAST(0 AS BIGINT) AS book_id, CAST(-1 AS BIGINT) AS chunk_no, '' AS term_table")
    tasks = P.task_payload(t.turns(), empty)
    return tasks.select(
        "book_id", "chunk_no", F.length(F.substring_index("value", "\n", 1)).alias("head_chars"),
        (~F.contains("value", F.lit("Nothing stands before."))).alias("has_before")
    )


@query(
    "SELECT CAST(n AS BIGINT) AS n, kind, text FROM (VALUES (0, 'heading', 'One'), (1, 'paragraph', 'a b'), (2, 'scene_break', ''), (3, 'blockquote', 'q'), (4, 'image', ''), (5, 'code_block', 'x'), (6, 'footnote_def', 'note')) v(n, kind, text)"
)
def md_blocks(t):
    text = t.sql("SELECT 'b' AS book_id, replace('# One {#a}¶a b¶¶***¶> q¶¶![i](images/a.png)¶```¶x¶```¶[^1]: note', '¶', chr(10)) AS text")
    return build.md_blocks(text).select(F.col("block_no").alias("n"), "kind", "text")


@query("SELECT 'b' AS book_id, CAST(n AS BIGINT) AS n, src FROM (VALUES (0, 'images/a.png'), (1, 'images/c.png'), (2, 'b.png')) v(n, src)")
def fb2_images(t):
    text = t.sql(
        "SELECT 'b' AS book_id, replace('see ![x](b.png) and ![y](images/a.png)¶¶![i](images/a.png)¶¶![k](images/c.png)', '¶', chr(10)) AS text"
    )
    return build.image_refs(build.md_blocks(text))


@query("SELECT source || '-' || (doc_id // 100) AS book_id, CAST(count(*) AS BIGINT) AS n_sections FROM documents GROUP BY ALL")
def fb2_body(t):
    blocks = build.md_blocks(t.books())
    author = F.struct(
        F.lit("Ann").alias("first_name"), F.lit(None).cast("string").alias("middle_name"),
        F.lit("Bee").alias("last_name"), F.lit(None).cast("string").alias("nickname")
    )
    heads = t.books().select(
        "book_id", F.col("book_id").alias("title"), author.alias("author"), F.lit("en").alias("lang"),
        F.lit("2020-01-01").alias("date"), F.col("book_id").alias("uid")
    )
    return build.build_fb2(blocks, heads).select("book_id", F.regexp_count("fb2", F.lit("<section>")).alias("n_sections"))


@query("SELECT CAST(event_id AS BIGINT) AS event_id, replace(event_type, '�', '�') AS clean FROM events")
def sanitize(t):
    return t("events").select("event_id", sanitize_surrogates(F.col("event_type")).alias("clean"))
