"""Cleaning of Markdown and HTML as Columns; what needs state over lines is an Arrow function over whole texts."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from .text import TOC_TITLES, replace_all, strip, toc_entry

# What marks a page, a drop cap and a link in converted books.
_PAGE_ID, _CAP_CLASS, _LINK_TARGET = r"#pg_\d+", r"\.minio", r"#calibre_link"
#: White space within a line.
_GAP = r"[^\S\n]*"


def _attributes(first: str = "", rest: str = r"[^}\n]*") -> str:
    """Pattern of an attribute block that begins so."""
    return r"\{" + first + rest + r"\}"


def _linked(opening: str = "", closing: str = "") -> str:
    """Pattern of a link into the book, its text captured, with its attributes; opening, closing: around it."""
    return rf"{opening}\[([^\]\n]+)\]\({_LINK_TARGET}[^)\n]*\)(?:{_attributes()})?{closing}"


_CAP = (r"\[([^\]\n])\]" + _attributes(_CAP_CLASS, ""), "$1")
_LINKS = ((_linked(), "$1"), (_linked(r"\[", r"\]"), "$1"))
_FENCE = rf":{{3,4}}\s*(?:{_attributes()})?"


def _without_marks(text: Column) -> Column:
    """Lines that are a fence go. Page marks go from lines that have one with further attributes, and the line too if it is blank then."""
    mark = _attributes(_PAGE_ID)
    bare = lambda line: F.regexp_replace(line, rf"(?:\[\])?{mark}", "")
    marked = lambda line: line.rlike(r"\{" + _PAGE_ID + r"\s")
    gone = lambda line: strip(line).rlike(rf"^{_FENCE}$") | (marked(line) & (strip(bare(line)) == ""))
    kept = F.filter(F.split(text, "\n"), lambda line: ~gone(line))
    return F.array_join(F.transform(kept, lambda line: F.when(marked(line), bare(line)).otherwise(line)), "\n")


def _bare_headings(text: Column) -> Column:
    """Heading lines without an id block, and then without a class block, at their end."""
    ending = lambda first: (rf"(?mdU)^({_GAP}#.*?){_GAP}{_attributes(first)}{_GAP}$", "$1")
    return replace_all(text, ending("#"), ending(r"\."))


def clean_markdown(text: Column) -> Column:
    """Markdown without a converter's remains; contents lists stay (see strip_toc).

    Fences of divisions, page marks, drop caps, heading attributes, links into the book, lines of attributes only, and
    blank lines beyond one go, in this order.
    """
    spans = replace_all(_bare_headings(F.regexp_replace(_without_marks(text), *_CAP)), *_LINKS)
    spaced = replace_all(spans, (r"\n" + _attributes(rest="[^}]*") + r"\s*\n", "\n\n"), (r"\n{3,}", "\n\n"))
    return F.concat(strip(spaced), F.lit("\n"))


def normalize_images(text: Column) -> Column:
    """All image forms as ![alt](images/name), alt `image` where none is given."""
    src, alt = r'src="(?:[^"]*/)?([^"/]+)"', r'alt="([^"]*)"'
    figure = (r"(?i)<figure[^>]*>\s*", r"\s*</figure>")
    steps = []
    for before, after in (figure, ("(?i)", "")):
        steps += [
            (rf"{before}<img[^>]*?{alt}[^>]*{src}[^>]*/?>{after}", "![$1](images/$2)"),
            (rf"{before}<img[^>]*{src}[^>]*?{alt}[^>]*/?>{after}", "![$2](images/$1)"),
            (rf"{before}<img[^>]*{src}[^>]*/?>{after}", "![](images/$1)"),
        ]
    steps += [
        (r"!\[([^\]]*)\]\((?:\.\./)*images/([^)]+)\)", "![$1](images/$2)"),
        (r"!\[([^\]]*)\]\([^)]*?/images/([^)/]+)\)", "![$1](images/$2)"), (r"!\[\]\(images/", "![image](images/")
    ]
    return replace_all(text, *steps)


#: Ends of a line, as the per-file rules count them.
_LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
# The class that marks a file's title heading.
_TITLE_CLASS = "tfhabitatexpanded_bold_b_"


def clean_md_per_file(text: Column, title: Column) -> Column:
    """Cleaning of one content file's Markdown: one title heading in place of the marked ones, no spans, attributes or fences."""
    lines = F.split(text, _LINE_END)
    marked = lambda x: F.ltrim(x).startswith("#") & F.contains(x, F.lit(_TITLE_CLASS))
    titled, head = title != "", F.concat(F.lit("# "), title)
    at = F.array_position(F.transform(lines, marked), True)
    replaced = F.transform(lines, lambda x, i: F.when(marked(x), F.when((i + 1 == at) & titled, head)).otherwise(x))
    kept = F.array_compact(replaced)
    body = F.array_join(F.when((at == 0) & titled, F.concat(F.array(head), kept)).otherwise(kept), "\n")
    anywhere = lambda first: _attributes(first, "[^}]*")
    pages = (rf"(?:\[\])?{anywhere('#pg_')}", "")
    fence = (rf"(?md)^\s*{_FENCE}\s*$", "")
    return normalize_images(replace_all(body, pages, _CAP, *_LINKS, (anywhere(r"[.#]"), ""), fence))


_TAGS = (
    (r"(?is)<a\b[^>]*(?:class=[\"'][^\"']*reversefootnote|rev=[\"']footnote)[^>]*>.*?</a>", ""),
    (r"(?is)</?(?:i|em)\b[^>]*>", "*"), (r"(?is)</?(?:b|strong)\b[^>]*>", "**"), (r"(?is)</p\s*>", "\n"), (r"(?is)<[^>]+>", ""),
)


@F.pandas_udf(StringType())
def unescape_html(s: pd.Series) -> pd.Series:
    """Character references resolved."""
    return s.map(html.unescape, na_action="ignore")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, r"(?is)<[^>]+>", "")


def clean_html_footnote(c: Column) -> Column:
    """A footnote's HTML as one line of Markdown; back links go. Character references stay: see unescape_html."""
    return strip(F.regexp_replace(replace_all(c, *_TAGS), r"(?U)\s+", " "))


_CONTENTS = r"(?iu)^#{1,6}\s+(?:" + "|".join(TOC_TITLES) + r")\s*(?:\{[^}]*\})?\s*$"


def _contents_marks(text: Column) -> Column:
    """A letter for each line: c a contents heading, h another heading, b a blank line, e another that could be an entry, p prose."""
    s = strip
    kind = lambda x: F.when(s(x) == "", "b").when(s(x).rlike(_CONTENTS), "c").when(
        s(x).rlike(r"(?U)^#{1,6}\s+"), "h"
    ).when(toc_entry(x), "e").otherwise("p")
    return F.array_join(F.transform(F.split(text, "\n"), kind), "")


def contents_spans(marks: str) -> list[tuple[int, int]]:
    """Lines (from, to) of contents headings with their entries, by the marks of all lines.

    A contents heading counts if an entry follows it. Its entries end at prose, or at a heading that prose or nothing follows.
    """
    spans, at = [], 0
    follows = lambda i: marks[i + 1 :].lstrip("b")[:1]
    while (at := marks.find("c", at)) >= 0:
        end = at + 1
        if follows(at) not in ("", "p"):
            while end < len(marks) and marks[end] != "p" and not (marks[end] in "ch" and follows(end) in ("", "p")):
                end += 1
            spans.append((at, end))
        at = end
    return spans


@F.pandas_udf(StringType())
def _without_contents(text: pd.Series, marks: pd.Series) -> pd.Series:
    out = []
    for t, m in zip(text, marks, strict=True):
        spans = contents_spans(m) if t is not None and "c" in m else []
        lines = t.split("\n") if spans else []
        for i, j in reversed(spans):
            del lines[i:j]
        out.append("\n".join(lines) if spans else t)
    return pd.Series(out, dtype=object)


def strip_toc(text: Column) -> Column:
    """Markdown without a manual table of contents."""
    return _without_contents(text, _contents_marks(text))
