"""Scalar text functions as Columns. Java's patterns need (?U), (?u) and (?d) to see Unicode and line ends as the rules mean them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Title beginnings of matter before and after a story.
MATTER_TITLES = (
    "СОДЕРЖАНИЕ", "Содержание", "Contents", "Table of Contents", "TOC", "Оглавление", "ОГЛАВЛЕНИЕ", "Title Page",
    "Copyright", "Acknowledgments?", "Благодарности", "About the Author", "Об авторе", "Also by", "Книги автора",
    "Dedication", "Посвящение", "Preface", "Предисловие", "Introduction", "Введение", "Glossary", "Глоссарий", "Index",
    "Указатель", "Appendix", "Приложение", "Postscript", "Послесловие", "Notes?", "Примечания",
)
# Titles of tables of contents.
TOC_TITLES = ("СОДЕРЖАНИЕ", "Содержание", "Contents", "Table of Contents", "TOC", "Оглавление", "ОГЛАВЛЕНИЕ")
# File names and the titles they stand for.
FILE_TITLES = {
    "dedication": "Dedication", "authorforeword": "Author's Foreword", "foreword": "Foreword", "preface": "Preface",
    "introduction": "Introduction", "map": "Map", "prologue": "Prologue", "epilogue": "Epilogue",
    "afterword": "Afterword", "acknowledgments": "Acknowledgments", "acknowledgements": "Acknowledgements",
    "abouttheauthor": "About the Author", "abouttheauthors": "About the Authors",
    "abouttheillustrator": "About the Illustrator", "illustration": "About the Illustrator", "alsoby": "Also by",
    "copyright": "Copyright",
}
# Media types of image files.
IMAGE_TYPES = {
    "png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif", "bmp": "image/bmp",
    "svg": "image/svg+xml", "webp": "image/webp"
}

FRONT = "(front matter)"


def strip(c: Column) -> Column:
    """Without white space, Unicode's included, at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def replace_all(c: Column, *steps: tuple[str, str]) -> Column:
    """Pattern replacements one after another."""
    return reduce(lambda x, s: F.regexp_replace(x, s[0], s[1]), steps, c)


def nonblank(c: Column) -> Column:
    return F.filter(c, lambda p: strip(p) != "")


def paragraphs(c: Column) -> Column:
    """Paragraphs between blank lines, stripped, without blank ones."""
    return F.filter(F.transform(F.split(c, r"\n\n+"), strip), lambda p: p != "")


def count_headings(c: Column) -> Column:
    """Lines that open a first- or second-level heading."""
    return F.regexp_count(c, F.lit(r"(?md)^#{1,2}\s+"))


def count_paragraphs(c: Column) -> Column:
    return F.size(nonblank(F.split(c, r"\n\s*\n")))


def sanitize_surrogates(c: Column) -> Column:
    """Unpaired surrogates as the replacement character."""
    return F.regexp_replace(c, r"[\x{D800}-\x{DFFF}]", "�")


def unescape_md(c: Column) -> Column:
    """Markdown backslash escapes undone."""
    return F.regexp_replace(c, r"\\([\\`*_{}\[\]()#+\-.!>|~])", "$1")


def make_term_id(c: Column) -> Column:
    """Lower case without apostrophes, other runs of non-alphanumerics as `_`; `term` if nothing is left."""
    bare = F.regexp_replace(F.lower(strip(c)), r"['’ʼ`]", "")
    out = F.btrim(F.regexp_replace(bare, r"(?U)[^\p{Alnum}]+", "_"), F.lit("_"))
    return F.when(out == "", "term").otherwise(out)


def normalize_dedup(c: Column) -> Column:
    """A surface for duplicate search: no possessive, no final `s` (but `ss` stays)."""
    x = F.regexp_replace(F.lower(strip(c)), r"['’]s\b", "")
    return F.when(x.endswith("s") & ~x.endswith("ss"), F.substring(x, F.lit(1), F.length(x) - 1)).otherwise(x)


def tokenize(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), r"[\s\-]+"), lambda t: t != "")


def surface_forms(source: Column, aliases: Column) -> Column:
    """Lower-cased name and aliases, without empty ones."""
    every = F.concat(F.array(source), F.coalesce(aliases, F.array().cast("array<string>")))
    return F.array_distinct(F.filter(F.transform(every, lambda s: F.lower(strip(s))), lambda s: s.isNotNull() & (s != "")))


#: A surface is bounded by what is not one of these.
_WORDLY = "A-Za-zА-Яа-я0-9"


def surface_in_text(surface: Column, lowered: Column) -> Column:
    """Whether a surface occurs in lower-cased text: anywhere if of two characters or fewer, else as whole words."""
    pattern = F.concat(F.lit(rf"(?iu)(?<![{_WORDLY}])\Q"), surface, F.lit(rf"\E(?![{_WORDLY}])"))
    return F.when(F.length(surface) <= 2, F.contains(lowered, surface)).otherwise(F.rlike(lowered, pattern))


def english_leaks(c: Column, least: int = 80) -> Column:
    """Runs of Latin prose of at least `least` characters that hold a word of four letters."""
    runs = F.regexp_extract_all(c, F.lit(r"[A-Za-z][A-Za-z\s.,;:'\"!?\-()\[\]]{%d,}" % (least - 1)), F.lit(0))
    return F.filter(runs, lambda r: r.rlike(r"\b[A-Za-z]{4,}\b"))


#: Alphabet of a text -> the alphabet whose letters inside its words are slips.
SLIPS = {"Cyrillic": "Latin", "Greek": "Latin", "Latin": "Cyrillic"}


def mixed_words(c: Column, script: str = "Cyrillic", protected: Column | None = None) -> Column:
    """Words with letters of the script and of its slip alphabet, but for protected ones."""
    words = F.regexp_extract_all(c, F.lit(r"\p{L}+"), F.lit(0))
    keep = F.filter(words, lambda w: w.rlike(rf"\p{{Is{script}}}") & w.rlike(rf"\p{{Is{SLIPS[script]}}}"))
    return keep if protected is None else F.filter(keep, lambda w: ~F.array_contains(protected, F.lower(w)))


def is_valid_source(c: Column) -> Column:
    """A term's name: Latin letters, white space, apostrophes and hyphens, first a letter."""
    return c.rlike(r"^[A-Za-z][A-Za-z\s'\-]*\z")


def chunk_number(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "").cast("int")


def normalize_chunk_id(c: Column) -> Column:
    """`chunk` and four digits; null where there is no number."""
    n = F.nullif(F.regexp_replace(c, r"\D", ""), F.lit("")).cast("int")
    return F.when(n.isNotNull(), F.format_string("chunk%04d", n))


def body_preview(c: Column, most: int = 80) -> Column:
    return F.when(F.length(c) > most, F.concat(F.left(c, F.lit(most)), F.lit("..."))).otherwise(c)


def ratio(out: Column, source: Column) -> Column:
    return F.try_divide(out.cast("double"), source.cast("double"))


def guess_content_type(path: Column) -> Column:
    ext = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    table = F.create_map(*(F.lit(x) for kv in IMAGE_TYPES.items() for x in kv))
    return F.coalesce(F.try_element_at(table, ext), F.lit("application/octet-stream"))


def fill_author(c: Column) -> Column:
    """Name parts in schema order: `Last, First`; one word is a nickname; of three or more, the inner ones are middle names."""
    by_comma = F.transform(F.split(c, ","), strip)
    words = F.split(strip(c), r"\s+")
    n = F.size(words)
    part = lambda x: F.nullif(x, F.lit(""))
    comma = F.contains(c, F.lit(","))
    first = F.when(comma, part(F.get(by_comma, F.lit(1)))).when(n > 1, F.get(words, F.lit(0)))
    middle = F.when(~comma & (n > 2), F.array_join(F.slice(words, 2, F.greatest(n - 2, F.lit(0))), " "))
    last = F.when(comma, part(F.get(by_comma, F.lit(0)))).when(n > 1, F.get(words, n - 1))
    nick = F.when(~comma & (n == 1), part(F.get(words, F.lit(0))))
    return F.struct(first.alias("first_name"), middle.alias("middle_name"), last.alias("last_name"), nick.alias("nickname"))


def doc_uid(title: Column, author: Column, date: Column, prefix: str = "bm-") -> Column:
    return F.concat(F.lit(prefix), F.left(F.sha1(F.concat_ws("|", title, author, date)), F.lit(16)))


def phase_for_step(step: Column) -> Column:
    return F.when(step <= 3, 1).when(step <= 6, 2).when(step <= 10, 3)


def section_kind(title: Column) -> Column:
    """front, frontback or narrative, by a section's title."""
    return (
        F.when(title == FRONT, "front").when(title.rlike(r"(?iUu)^(" + "|".join(MATTER_TITLES) + r")\b"), "frontback")
        .otherwise("narrative")
    )


def heading_level(line: Column) -> Column:
    """1 or 2 for a heading line of that level, else null."""
    marks = F.regexp_extract(line, r"(?U)^(#{1,2})\s+(.+?)\s*$", 1)
    return F.when(marks != "", F.length(marks))


def heading_title(line: Column) -> Column:
    """A heading's title without a trailing attribute block."""
    return strip(F.regexp_replace(F.regexp_extract(line, r"(?U)^(#{1,2})\s+(.+?)\s*$", 2), r"\s*\{[^}]*\}\s*$", ""))


def title_from_basename(name: Column) -> Column:
    low = F.lower(name)
    number = F.regexp_extract(low, r"^chapter(\d+)$", 1)
    table = F.create_map(*(F.lit(x) for kv in FILE_TITLES.items() for x in kv))
    return F.when(number != "", F.concat(F.lit("Chapter "), number.cast("bigint").cast("string"))).otherwise(
        F.coalesce(F.try_element_at(table, low), F.initcap(F.replace(name, F.lit("_"), F.lit(" "))))
    )


def toc_entry(line: Column) -> Column:
    """Whether a line could be an entry of a table of contents."""
    s = strip(line)
    link = F.contains(s, F.lit("](#")) | s.rlike(r"(?U)\[#?[\w\-]+\]") | s.startswith("<a ")
    return (s == "") | link | s.rlike(r"(?U)^[\d\-*+]\.?\s") | s.rlike(r"(?U)^#{1,6}\s+") | ((F.length(s) <= 120) & ~s.rlike(r"[.!?…:;»]$"))


def first_few(items: Column, n: int, more: str = " and %d more") -> Column:
    """The first n items of a report, and how many there are beyond them."""
    rest = F.size(items) - n
    return F.concat(F.array_join(F.slice(items, 1, n), ", "), F.when(rest > 0, F.format_string(more, rest)).otherwise(""))


def stable_hash(c: Column) -> Column:
    """Hash of a text's own bytes."""
    return F.sha2(c, 256)


#: Control characters whose escapes have a letter: Jackson writes it upper-case, Python lower-case.
_ESCAPES = [f"{k:04x}" for k in (*range(0x0B, 0x0C), *range(0x0E, 0x10), *range(0x1A, 0x20))]


def json_quote(c: Column) -> Column:
    """A text as a JSON string, letter for letter as Python's json.dumps(ensure_ascii=False) writes it."""
    whole = F.to_json(F.array(c))
    quoted = F.substring(whole, F.lit(2), F.length(whole) - 2)
    return replace_all(quoted, *((rf"(?<!\\)((?:\\\\)*)\\u{e.upper()}", rf"$1\\u{e}") for e in _ESCAPES))


def json_hash(c: Column) -> Column:
    """Hash of a text as a JSON string."""
    return F.sha2(json_quote(c), 256)


def term_fingerprint(source: Column, target: Column, aliases: Column, gender: Column) -> Column:
    """Hash of the fields of a term that decide how it is translated: of their JSON with sorted keys, as Python writes it."""
    text = lambda c: json_quote(F.coalesce(c, F.lit("")))
    names = F.coalesce(aliases, F.array().cast("array<string>"))
    listed = F.array_join(F.transform(names, lambda a: F.coalesce(json_quote(a), F.lit("null"))), ", ")
    body = (
        F.lit('{"aliases": ['), listed, F.lit('], "gender": '), text(gender), F.lit(', "source": '), text(source),
        F.lit(', "target": '), text(target), F.lit("}")
    )
    return F.sha2(F.concat(*body), 256)
