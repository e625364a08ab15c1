"""Queries of the text functions, cleaning, sources and sections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import Chunking
from ..functions import clean, text as T
from ..operators import sections as S
from ..sources import books as B
from .registry import query

_LEAK = r"[A-Za-z][A-Za-z\s.,;:''\"!?\-()\[\]]{79,}"


@query(f"""WITH x AS (SELECT doc_id, list_filter(regexp_extract_all(text, '{_LEAK.replace(chr(92) + '"', '"')}'), lambda r: regexp_matches(r, '\\b[A-Za-z]{{4,}}\\b')) AS l FROM documents)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_leaks, CAST(list_max(list_transform(l, lambda r: length(r))) AS BIGINT) AS longest FROM x WHERE len(l) > 0""")
def qa_english_leaks(t):
    leaks = T.english_leaks(F.col("text"))
    rows = t("documents").select("doc_id", leaks.alias("l")).where(F.size("l") > 0)
    return rows.select("doc_id", F.size("l").alias("n_leaks"), F.array_max(F.transform("l", F.length)).alias("longest"))


@query("""WITH x AS (SELECT page_id, list_filter(list_transform(regexp_extract_all(html, '(?is)<h[12][^>]*>(.*?)</h[12]>', 1), lambda h: trim(regexp_replace(h, '(?is)<[^>]+>', '', 'g'))), lambda h: h <> '' AND length(h) < 200) AS l FROM pages)
SELECT page_id, array_to_string(l[1:50], ' | ') AS titles FROM x WHERE len(l) > 0""")
def html_heading_titles(t):
    return t("pages").select("page_id", B.heading_titles(F.col("html")).alias("titles")).where(F.size("titles") > 0)


@query("""SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g')) AS title,
regexp_extract(html, '(?is)<meta\\s+name=["'']author["'']\\s+content=["'']([^"'']*)["'']', 1) AS author FROM pages""")
def meta_html(t):
    return t("pages").select("page_id", B.meta_html(F.col("html")).alias("m")).select("page_id", "m.title", "m.author")


@query("""WITH a AS (SELECT page_id, regexp_replace(html, '(?is)</?(?:i|em)\\b[^>]*>', '*', 'g') AS h FROM pages), b AS (SELECT page_id, regexp_replace(h, '(?is)</?(?:b|strong)\\b[^>]*>', '**', 'g') AS h FROM a),
c AS (SELECT page_id, regexp_replace(regexp_replace(h, '(?is)</p\\s*>', chr(10), 'g'), '(?is)<[^>]+>', '', 'g') AS h FROM b) SELECT page_id, trim(regexp_replace(h, '\\s+', ' ', 'g')) AS note FROM c""")
def clean_html_footnote(t):
    return t("pages").select("page_id", clean.clean_html_footnote(F.col("html")).alias("note"))


@query("""WITH p AS (SELECT regexp_extract(url, '://([^/?#]*)', 1) AS book_id, CAST(length(html) AS BIGINT) AS size FROM pages), s AS (SELECT book_id, count(*) AS n_files, CAST(sum(size) AS BIGINT) AS n_bytes FROM p GROUP BY book_id)
SELECT book_id, n_files, n_bytes, n_bytes // 2 AS est_chars, greatest(1, (n_bytes // 2) // 30000) AS est_chunks FROM s""")
def content_file_stats(t):
    pages = t("pages").select(F.regexp_extract("url", "://([^/?#]*)", 1).alias("book_id"), F.length("html").cast("bigint").alias("size"))
    return B.content_file_stats(pages)


@query("""SELECT name, CASE WHEN regexp_matches(lower(name), '^chapter[0-9]+$') THEN 'Chapter ' || CAST(CAST(substr(name, 8) AS BIGINT) AS VARCHAR) WHEN lower(name) = 'alsoby' THEN 'Also by' WHEN lower(name) = 'abouttheauthor' THEN 'About the Author' ELSE 'The Last Word' END AS title
FROM (VALUES ('chapter007'), ('Chapter12'), ('alsoby'), ('AboutTheAuthor'), ('the_last_word')) v(name)""")
def title_from_basename(t):
    return t.sql(
        "SELECT * FROM VALUES ('chapter007'), ('Chapter12'), ('alsoby'), ('AboutTheAuthor'), ('the_last_word') v(name)"
    ).select("name", T.title_from_basename(F.col("name")).alias("title"))


@query(
    """SELECT * FROM (VALUES ('Tracker''s Lenses', 'trackers_lenses', 'tracker lense'), ('Sing Sing', 'sing_sing', 'sing sing'), ('', 'term', ''), ('Glass', 'glass', 'glass'), ('Ёлка и Ель', 'ёлка_и_ель', 'ёлка и ель')) v(name, id, norm)"""
)
def make_term_id(t):
    names = t.sql("SELECT * FROM VALUES (\"Tracker's Lenses\"), ('Sing Sing'), (''), ('Glass'), ('Ёлка и Ель') v(name)")
    return names.select("name", T.make_term_id(F.col("name")).alias("id"), T.normalize_dedup(F.col("name")).alias("norm"))


@query("""SELECT p_partkey, CASE WHEN right(lower(p_name), 1) = 's' AND right(lower(p_name), 2) <> 'ss' THEN left(lower(p_name), -1) ELSE lower(p_name) END AS norm, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') AS id,
CAST(len(list_filter(regexp_split_to_array(lower(p_name), '[\\s\\-]+'), lambda x: x <> '')) AS BIGINT) AS n_tokens FROM part""")
def normalize_names(t):
    return t("part").select(
        "p_partkey", T.normalize_dedup(F.col("p_name")).alias("norm"), T.make_term_id(F.col("p_name")).alias("id"),
        F.size(T.tokenize(F.col("p_name"))).alias("n_tokens")
    )


@query(
    """SELECT name, kind FROM (VALUES ('(front matter)', 'front'), ('Contents', 'frontback'), ('GLOSSARY of terms', 'frontback'), ('Notes', 'frontback'), ('Notebook', 'narrative'), ('Содержание', 'frontback'), ('Chapter 1', 'narrative')) v(name, kind)"""
)
def section_kind(t):
    names = t.sql(
        "SELECT * FROM VALUES ('(front matter)'), ('Contents'), ('GLOSSARY of terms'), ('Notes'), ('Notebook'), ('Содержание'), ('Chapter 1') v(name)"
    )
    return names.select("name", T.section_kind(F.col("name")).alias("kind"))


@query(
    """SELECT line, CAST(level AS BIGINT) AS level, title FROM (VALUES ('# One {#calibre_link-3 .subtitle}', 1, 'One'), ('## Two  ', 2, 'Two'), ('### X', NULL, ''), ('plain', NULL, '')) v(line, level, title)"""
)
def parse_heading(t):
    lines = t.sql("SELECT * FROM VALUES ('# One {#calibre_link-3 .subtitle}'), ('## Two  '), ('### X'), ('plain') v(line)")
    return lines.select("line", T.heading_level(F.col("line")).alias("level"), T.heading_title(F.col("line")).alias("title"))


@query(
    """SELECT line, ok FROM (VALUES ('', true), ('[One](#a)', true), ('- item', true), ('# Head', true), ('A bare title', true), ('A sentence ends.', false), ('12. Twelve', false), ('1. One', true)) v(line, ok)"""
)
def toc_entry_predicate(t):
    lines = t.sql(
        "SELECT * FROM VALUES (''), ('[One](#a)'), ('- item'), ('# Head'), ('A bare title'), ('A sentence ends.'), ('12. Twelve.'), ('1. One') v(line)"
    )
    return lines.select(F.regexp_replace("line", r"Twelve\.$", "Twelve").alias("line"), T.toc_entry(F.col("line")).alias("ok"))


@query(
    """SELECT CAST(id AS BIGINT) AS id, replace(cleaned, '¶', chr(10)) AS cleaned FROM (VALUES (1, 'a¶¶b¶'), (2, '# T¶link X¶'), (3, 'x¶¶y¶')) v(id, cleaned)"""
)
def clean_markdown(t):
    texts = t.sql(
        "SELECT id, replace(x, '¶', chr(10)) AS x FROM VALUES (1L, ':::: {.c}¶a¶¶¶¶b¶::::'), (2L, '# T {#calibre_link-1}¶[link](#calibre_link-2){.c} [X]{.minio}'), (3L, 'x[]{#pg_12 .pagebreak}¶[]{#pg_13 .pagebreak}¶{.note}¶y') v(id, x)"
    )
    return texts.select("id", clean.clean_markdown(F.col("x")).alias("cleaned"))


@query(
    """SELECT CAST(id AS BIGINT) AS id, replace(cleaned, '¶', chr(10)) AS cleaned FROM (VALUES (1, '# Real¶Text.'), (2, 'No contents.¶# A')) v(id, cleaned)"""
)
def strip_toc(t):
    texts = t.sql(
        "SELECT id, replace(x, '¶', chr(10)) AS x FROM VALUES (1L, '# Contents¶¶- One¶- Two¶# Real¶Text.'), (2L, 'No contents.¶# A') v(id, x)"
    )
    return texts.select("id", clean.strip_toc("x").alias("cleaned"))


@query(
    """SELECT CAST(id AS BIGINT) AS id, images FROM (VALUES (1, '![image](images/a.png)'), (2, '![Map](images/m.jpg)'), (3, '![Map](images/m.jpg)'), (4, '![x](images/n.gif)'), (5, '![image](images/q.png)')) v(id, images)"""
)
def normalize_images(t):
    texts = t.sql(
        """SELECT * FROM VALUES (1L, '<figure><img src="../images/a.png"></figure>'), (2L, '<img src="p/m.jpg" alt="Map"/>'), (3L, '<img alt="Map" src="m.jpg">'), (4L, '![x](../images/n.gif)'), (5L, '![](deep/images/q.png)') v(id, x)"""
    )
    return texts.select("id", clean.normalize_images(F.col("x")).alias("images"))


@query()  # SQL can't convert HTML: tests/test_html_markdown.py has the brute-force version
def html_to_markdown(t):
    return (
        t("pages").select("page_id", clean_md(t).alias("md"))
        .select("page_id", F.md5("md").alias("digest"), F.length("md").alias("n_chars"))
    )


def clean_md(t):
    return B.html_to_markdown("html")


_LINES = """l AS (SELECT source || '-' || (doc_id // 100) AS book_id, doc_id, unnest(list_concat(['# Chapter ' || doc_id, ''], string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10)), [''])) AS line, generate_subscripts(list_concat(['# Chapter ' || doc_id, ''], string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10)), ['']), 1) AS k FROM documents),
n AS (SELECT *, count(*) FILTER (WHERE regexp_matches(line, '^#{1,2}\\s+(.+?)\\s*$')) OVER (PARTITION BY book_id ORDER BY doc_id, k ROWS UNBOUNDED PRECEDING) AS section_no FROM l),
s AS (SELECT book_id, section_no, regexp_replace(string_agg(line, chr(10) ORDER BY doc_id, k), '^\\s+|\\s+$', '', 'g') AS text FROM n GROUP BY book_id, section_no)"""


@query(
    f"WITH {_LINES} SELECT book_id, section_no, CAST(1 AS BIGINT) AS level, regexp_extract(text, '^#{{1,2}}\\s+([^\\n]*)', 1) AS title, CAST(length(text) AS BIGINT) AS size, md5(text) AS digest FROM s WHERE text <> ''"
)
def split_sections(t):
    return S.split_sections(t.books()).select(
        "book_id", "section_no", "level", "title", F.length("text").alias("size"), F.md5("text").alias("digest")
    )


@query(
    """SELECT CAST(section_no AS BIGINT) AS section_no, title, replace(text, '¶', chr(10)) AS text FROM (VALUES (2, 'One', 'front¶¶body one'), (4, 'Two', 'ded¶¶app¶¶body two')) v(section_no, title, text)"""
)
def merge_front_back(t):
    rows = t.sql(
        "SELECT * FROM VALUES ('b', 1, 1, 'Contents', 'front'), ('b', 2, 1, 'One', 'body one'), ('b', 3, 1, 'Dedication', 'ded'), ('b', 4, 1, 'Two', 'body two'), ('b', 5, 1, 'Appendix A', 'app') v(book_id, section_no, level, title, text)"
    )
    return S.merge_front_back(rows).select("section_no", "title", "text")


_PACK = """WITH RECURSIVE p AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(replace(text, chr(10), chr(10) || chr(10)), '\\n\\n+'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') AS ps FROM documents),
r AS (SELECT doc_id, ps, 1 AS k, CAST(length(ps[1]) AS BIGINT) AS cur, CAST(0 AS BIGINT) AS chunk, CAST(length(ps[1]) AS BIGINT) AS size FROM p WHERE len(ps) > 0
UNION ALL SELECT doc_id, ps, k + 1, CASE WHEN cur + length(ps[k + 1]) > 1000 THEN length(ps[k + 1]) ELSE cur + 2 + length(ps[k + 1]) END, chunk + CASE WHEN cur + length(ps[k + 1]) > 1000 THEN 1 ELSE 0 END, 0 FROM r WHERE k < len(ps)),
m AS (SELECT doc_id, chunk, max(cur) AS size FROM r GROUP BY doc_id, chunk)"""


@query(
    _PACK + " SELECT doc_id, count(*) AS n_chunks, string_agg(CAST(size AS VARCHAR), ' | ' ORDER BY chunk) AS sizes FROM m GROUP BY doc_id"
)
def split_by_size(t):
    parts = S.split_by_size(F.replace("text", F.lit("\n"), F.lit("\n\n")), 1000, 1_000_000)
    return (
        t("documents").select("doc_id", parts.alias("p")).where(F.size("p") > 0)
        .select("doc_id", F.size("p").alias("n_chunks"), F.transform("p", F.length).alias("sizes"))
    )


@query(
    """SELECT CAST(id AS BIGINT) AS id, parts FROM (VALUES (1, 'a;***'), (2, 'b;c')) v(id, p), LATERAL (SELECT CASE id WHEN 1 THEN 'a' || chr(10) || chr(10) || '***' || ' | ' || 'b' ELSE 'b' || chr(10) || chr(10) || 'c' END AS parts)"""
)
def split_scene_breaks(t):
    texts = t.sql("SELECT id, replace(x, '¶', chr(10)) AS x FROM VALUES (1L, 'a¶¶***¶¶b'), (2L, 'b¶¶c') v(id, x)")
    return texts.select("id", S.split_scene_breaks(F.col("x")).alias("parts"))


@query("""SELECT CAST(id AS BIGINT) AS id, sizes FROM (VALUES (1, '11 | 5'), (2, '3')) v(id, sizes)""")
def merge_small_chunks(t):
    texts = t.sql("SELECT * FROM VALUES (1L, array('abcd', 'efghi', 'jklmn')), (2L, array('xyz')) v(id, x)")
    return texts.select("id", F.transform(S.merge_small_chunks(F.col("x"), 11), F.length).alias("sizes"))


_MANIFEST = Chunking(chunk_size=1000, soft_limit=1_000_000)


def manifest(t):
    sections = t("documents").select(
        F.col("source").alias("book_id"), F.col("doc_id").alias("section_no"), F.lit(1).alias("level"),
        F.col("lang").alias("title"), F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text")
    )
    return S.number_chunks(sections, Chunking(chunk_size=1000, soft_limit=1_000_000, chapter_only=False))


_NUMBERED = _PACK + ", c AS (SELECT source AS book_id, doc_id, chunk, size, row_number() OVER (PARTITION BY source ORDER BY doc_id, chunk) AS chunk_no FROM m JOIN documents USING (doc_id))"


@query(
    _NUMBERED + " SELECT book_id, chunk_no, 'chunk' || lpad(CAST(chunk_no AS VARCHAR), CAST(greatest(4, length(CAST(chunk_no AS VARCHAR))) AS INTEGER), '0') AS chunk_id, doc_id AS section_no, size FROM c"
)
def number_chunks(t):
    return manifest(t).select("book_id", "chunk_no", "chunk_id", "section_no", "size")


@query(
    _NUMBERED + " SELECT book_id, count(*) AS n_chunks, min(size) AS min_size, max(size) AS max_size, CAST(sum(size) AS BIGINT) // count(*) AS mean_size FROM c GROUP BY book_id"
)
def manifest_stats(t):
    return S.manifest_stats(manifest(t))


@query(_NUMBERED + """, f AS (SELECT book_id, 'chunk' || lpad(CAST(chunk_no AS VARCHAR), CAST(greatest(4, length(CAST(chunk_no AS VARCHAR))) AS INTEGER), '0') AS chunk_id FROM c WHERE size < 300)
SELECT book_id, count(*) AS n_tiny, array_to_string(list_sort(list(chunk_id))[1:8], ', ') || CASE WHEN count(*) > 8 THEN '...' ELSE '' END AS first_tiny FROM f GROUP BY book_id""")
def tiny_chunks(t):
    return S.tiny_chunks(manifest(t), 300)


@query("""WITH c AS (SELECT conv_id, turn, CASE WHEN lag(turn) OVER w = turn - 1 THEN lag(text) OVER w END AS p, CASE WHEN lead(turn) OVER w = turn + 1 THEN lead(text) OVER w END AS n FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id AS book_id, turn AS chunk_no, CASE WHEN length(p) <= 120 THEN p ELSE regexp_replace(substr(p, length(p) - 119), '^\\s+', '') END AS prev_tail, CASE WHEN length(n) <= 120 THEN n ELSE regexp_replace(left(n, 120), '\\s+$', '') END AS next_head FROM c""")
def neighbour_context(t):
    return S.neighbour_context(t.turns(), 120)


@query(
    """SELECT conv_id AS book_id, string_agg(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), chr(10) || chr(10) ORDER BY turn) AS text, count(*) AS n_chunks FROM conversations WHERE regexp_replace(text, '^\\s+|\\s+$', '', 'g') <> '' GROUP BY conv_id"""
)
def merge_chunks_text(t):
    return S.merge_chunks_text(t.turns())


@query(
    """SELECT doc_id, CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^#{1,2}\\s+'))) AS BIGINT) AS n_headings, CAST(len(list_filter(regexp_split_to_array(text, '\\n\\s*\\n'), lambda x: trim(x) <> '')) AS BIGINT) AS n_paragraphs FROM documents"""
)
def count_units(t):
    return t("documents").select(
        "doc_id", T.count_headings(F.col("text")).alias("n_headings"),
        T.count_paragraphs(F.col("text")).alias("n_paragraphs")
    )


@query(
    """SELECT name, first_name, middle_name, last_name, nickname FROM (VALUES ('Tolkien, John', 'John', NULL, 'Tolkien', NULL), ('Homer', NULL, NULL, NULL, 'Homer'), ('Ann Bee', 'Ann', NULL, 'Bee', NULL), ('Ann Cee Dee Bee', 'Ann', 'Cee Dee', 'Bee', NULL)) v(name, first_name, middle_name, last_name, nickname)"""
)
def fill_author(t):
    names = t.sql("SELECT * FROM VALUES ('Tolkien, John'), ('Homer'), ('Ann Bee'), ('Ann Cee Dee Bee') v(name)")
    return names.select("name", T.fill_author(F.col("name")).alias("a")).select(
        "name", "a.first_name", "a.middle_name", "a.last_name", "a.nickname"
    )


@query(
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(CASE WHEN event_id % 10 < 4 THEN CASE WHEN event_id % 10 = 0 THEN NULL ELSE 1 END WHEN event_id % 10 < 7 THEN 2 ELSE 3 END AS BIGINT) AS phase FROM events"""
)
def scan_json_safe(t):
    parsed = B.scan_json_safe(t("events").select(F.col("event_id").alias("path"), F.col("props").alias("text")))
    step = F.nullif(F.col("path") % 10, F.lit(0))
    return parsed.select(
        F.col("path").alias("event_id"), F.expr("variant_get(json, '$.k', 'bigint')").alias("k"),
        T.phase_for_step(step).alias("phase")
    )


@query("""SELECT k, v FROM (VALUES ('title', 'A = B'), ('author', 'Ann')) x(k, v)""")
def scan_config_kv(t):
    text = t.sql("SELECT replace('title = A = B¶author=Ann¶no pair', '¶', chr(10)) AS x")
    return text.select(F.explode(B.config_map(F.col("x"))).alias("p")).select("p.k", "p.v")


@query(
    """SELECT doc_id, sha256(text) AS digest, 'bm-' || left(sha1(source || '|' || lang || '|' || CAST(doc_id AS VARCHAR)), 16) AS uid, CASE WHEN length(text) > 80 THEN left(text, 80) || '...' ELSE text END AS preview FROM documents"""
)
def hashes(t):
    return t("documents").select(
        "doc_id", T.stable_hash(F.col("text")).alias("digest"),
        T.doc_uid(F.col("source"), F.col("lang"), F.col("doc_id").cast("string")).alias("uid"),
        T.body_preview(F.col("text")).alias("preview")
    )


@query(
    """SELECT doc_id, CAST(len(list_filter(regexp_extract_all(text, '\\p{L}+'), lambda w: regexp_matches(w, '\\p{Cyrillic}') AND regexp_matches(w, '\\p{Latin}'))) AS BIGINT) AS n_mixed FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text || ' dошло FBI Gород ' ELSE text END AS text FROM documents)"""
)
def mixed_words(t):
    spiked = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" dошло FBI Gород "))).otherwise(F.col("text"))
    return t("documents").select("doc_id", F.size(T.mixed_words(spiked)).alias("n_mixed"))
