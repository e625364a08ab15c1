"""The structure of FictionBook 2 documents as content models, and what a document has against them, by line.

A model says which children an element may have and in which order, as a regular expression over their names. Elements
without a model hold text only, elements of INLINE text and each other. Lists of genres and languages aren't checked.
"""

from __future__ import annotations

import re
from functools import cache
from xml.parsers import expat

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# The format's content models.
_PERSON = "(first-name middle-name? last-name nickname?|nickname) home-page* email* id?"
_QUOTED = "(p|poem|cite|subtitle|empty-line|table)*"
MODELS = {
    "FictionBook": "stylesheet* description body+ binary*",
    "description": "title-info src-title-info? document-info publish-info? custom-info* output*",
    "title-info": "genre+ author+ book-title annotation? keywords? date? coverpage? lang src-lang? translator* sequence*",
    "src-title-info": "genre+ author+ book-title annotation? keywords? date? coverpage? lang src-lang? translator* sequence*",
    "document-info": "author+ program-used? date src-url* src-ocr? id version history? publisher*",
    "publish-info": "book-name? publisher? city? year? isbn? sequence*", "author": _PERSON, "translator": _PERSON,
    "coverpage": "image+", "sequence": "sequence*", "body": "image? title? epigraph* section+",
    "section": "title? epigraph* image? annotation? (section+|(p|poem|subtitle|cite|empty-line|table) (p|poem|subtitle|cite|empty-line|table|image)*)",
    "title": "(p|empty-line)*", "epigraph": "(p|poem|cite|empty-line)* text-author*",
    "cite": "(p|poem|empty-line|subtitle|table)* text-author*", "annotation": _QUOTED, "history": _QUOTED,
    "poem": "title? epigraph* (subtitle|stanza)+ text-author* date?", "stanza": "title? subtitle? v+", "table": "tr+",
    "tr": "(th|td)+", "empty-line": "", "image": "",
}
INLINE = frozenset(("strong", "emphasis", "style", "a", "strikethrough", "sub", "sup", "code", "image"))
#: Elements of text with inline elements in it.
MIXED = frozenset(("p", "v", "subtitle", "text-author", "th", "td", *(INLINE - {"image"})))
NEEDED = {"binary": ("id", "content-type"), "image": ("href",), "a": ("href",)}
#: Elements whose text may not be blank.
FILLED = frozenset(("lang", "id", "version", "book-title"))


@cache
def _pattern(model: str) -> re.Pattern:
    """A model as an expression over `name ` for each child."""
    return re.compile(re.sub(r"\s+", "", re.sub(r"[a-z][a-z-]*", lambda m: f"(?:{m[0]}#)", model)).replace("#", r"\ ") + r"\Z", re.VERBOSE)


class _Element:
    def __init__(self, name: str, line: int, attributes: set[str]):
        self.name, self.line, self.attributes, self.children, self.text = name, line, attributes, [], []


def schema_faults(text: str) -> list[str]:
    """`line N: what is wrong`, in order of lines; of one that isn't well-formed, what comes before that too."""
    found: list[tuple[int, str]] = []
    stack: list[_Element] = []
    ids: set[str] = set()
    parser = expat.ParserCreate()
    local = lambda name: name.rpartition(":")[2]

    def start(name: str, attributes: dict[str, str]) -> None:
        el = _Element(local(name), parser.CurrentLineNumber, {local(k) for k in attributes})
        if stack:
            stack[-1].children.append(el.name)
        elif el.name != "FictionBook":
            found.append((el.line, f"the root is {el.name}, not FictionBook"))
        if (own := attributes.get("id")) is not None:
            if own in ids:
                found.append((el.line, f"{el.name} has an id that stands before: {own}"))
            ids.add(own)
        found.extend((el.line, f"{el.name} has no {need}") for need in NEEDED.get(el.name, ()) if need not in el.attributes)
        stack.append(el)

    def end(_: str) -> None:
        el = stack.pop()
        if el.name in MIXED:
            odd = [c for c in el.children if c not in INLINE]
        elif el.name in MODELS:
            odd = [] if _pattern(MODELS[el.name]).match("".join(f"{c} " for c in el.children)) else [", ".join(el.children) or "nothing"]
            if "".join(el.text).strip():
                found.append((el.line, f"{el.name} has text of its own"))
        else:
            odd = el.children
        if odd:
            found.append((el.line, f"{el.name} can't hold {odd[0]}"))
        if el.name in FILLED and not "".join(el.text).strip():
            found.append((el.line, f"{el.name} is blank"))

    parser.StartElementHandler, parser.EndElementHandler = start, end
    parser.CharacterDataHandler = lambda s: stack[-1].text.append(s) if stack else None
    try:
        parser.Parse(text.encode("utf-8", "replace"), True)
    except expat.ExpatError as e:
        found.append((e.lineno, "not well-formed"))
    return [f"line {line}: {what}" for line, what in sorted(found, key=lambda x: x[0])]


@F.pandas_udf(ArrayType(StringType()))
def fb2_schema_validate(s: pd.Series) -> pd.Series:
    """What FictionBook texts have against the content models; nothing for a valid one. Never stops a build."""
    return s.map(lambda x: schema_faults(x or ""))
