"""Rule-based checks of documents (doc_id, text): issues (doc_id, check_name, line, message), line from 1."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import english_leaks, mixed_words

# What the checks look for.
PLACEHOLDERS = ("{baseDir}", "{TERM_TABLE}", "{NEIGHBOR_CONTEXT}", "{CUSTOM_INSTRUCTIONS}", "{TARGET_LANGUAGE}", "{TEMP_DIR}")
ARTIFACTS = (
    (r"\[object Object\]", "[object Object]"), (r"\[undefined\]", "[undefined]"),
    (r"(?U)(?<![\w-])undefined(?![\w-])", "undefined"), (r"(?U)(?<![\w-])null(?![\w-])", "null"),
    (r"\[Function\]", "[Function]"), ("NaN", "NaN")
)
SPEECH = (
    "said", "exclaimed", "asked", "replied", "whispered", "shouted", "muttered", "сказал", "сказала", "воскликнул",
    "воскликнула", "спросил", "спросила", "ответил", "ответила", "прошептал", "прошептала", "крикнул", "пробормотал"
)
NUMBER_WORDS = (
    "Один", "Два", "Три", "Четыре", "Пять", "Шесть", "Семь", "Восемь", "Девять", "Десять", "Одиннадцать", "Двенадцать",
    "Тринадцать", "Четырнадцать", "Пятнадцать", "Шестнадцать", "Семнадцать", "Восемнадцать", "Девятнадцать", "Двадцать",
)
MONTHS = ("январ", "феврал", "март", "апрел", "ма", "июн", "июл", "август", "сентябр", "октябр", "ноябр", "декабр")
DURATIONS = ("часа", "дня", "года", "недели", "месяца", "минуты", "суток", "часов", "дней", "лет", "недель", "месяцев", "минут")
PAIRS = (
    (rf"(?iUu)\bв течении\s+(?:{'|'.join(DURATIONS)})\b", "в течение"), (r"(?iUu)\bиме\w+\s+ввиду\b", "иметь в виду"),
    (r"(?iUu)\bв отличии от\b", "в отличие от")
)


def _found(name: str, matches: Column) -> Column:
    """Issues of a line for an array of messages."""
    return F.transform(matches, lambda m: F.struct(F.lit(name).alias("check_name"), m.alias("message")))


def _all(line: Column, pattern: str, label: str = "") -> Column:
    hits = F.regexp_extract_all(line, F.lit(pattern), F.lit(0))
    return F.transform(hits, lambda _: F.lit(label)) if label else hits


def garbage_dashes(line: Column) -> Column:
    return F.array_distinct(F.concat(_all(line, r"([—–\-])(?:\s+\1){2,}"), _all(line, r"([—–\-]{2,})(?:\s+\1)+")))


def doubled_punct(line: Column) -> Column:
    """Doubled punctuation, but for `..` beside a slash and ellipses."""
    return _all(line, r"(?<!\.)\.,(?!\.)|(?<![./])\.\.(?![./])|,\.|(?<![?!])\?\.|(?<![?!])!\.")


def dash_hyphen(line: Column) -> Column:
    """Spaced hyphens between words, not between digits."""
    return _all(line, r"(?U)(?<=\S) - (?=\S)(?:(?<!\d - )|(?!\d))")


#: Checks of a line that need nothing but the line.
LINE_CHECKS = {
    "garbage_dashes": garbage_dashes,
    "js_artifacts": lambda c: F.flatten(F.array(*(_all(c, p, label) for p, label in ARTIFACTS))),
    "empty_headings": lambda c: _all(c, r"(?U)^#{1,6}\s*$"),
    "doubled_punct": doubled_punct,
    "placeholders": lambda c: F.flatten(F.array(*(_all(c, r"\Q" + p + r"\E", p) for p in PLACEHOLDERS))),
    "dialogue_quotes": lambda c: _all(c, r'(?iUu)"[^"\n]{2,200}"[,!?.]?\s*(?:' + "|".join(SPEECH) + ")"),
    "untranslated_headings": lambda c: _all(c, r"(?U)^#{1,3}\s+(?:" + "|".join(NUMBER_WORDS) + r")\s*$"),
    "dash_hyphen": dash_hyphen,
    "dates": lambda c: F.concat(_all(c, rf"(?iUu)\b(?:{'|'.join(MONTHS)})\w*\s+\d{{1,2}}\b"), _all(c, r"(?iUu)\bгоду\s+\d{4}\b")),
    "paired_spelling": lambda c: F.flatten(F.array(*(_all(c, p, hint) for p, hint in PAIRS))),
}
#: The ones that run on a chunk as soon as it is translated.
EARLY = ("garbage_dashes", "js_artifacts", "empty_headings", "doubled_punct", "placeholders", "dash_hyphen")


def line_issues(docs: DataFrame, checks: tuple[str, ...] = tuple(LINE_CHECKS)) -> DataFrame:
    """Issues of the line checks: texts are read and cut into lines once, whatever the number of checks."""
    rows = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    every = reduce(lambda a, b: F.concat(a, b), [_found(name, LINE_CHECKS[name](F.col("line"))) for name in checks])
    return rows.select(
        "doc_id", (F.col("n") + 1).alias("line"), F.explode(every).alias("i")
    ).select("doc_id", "i.check_name", "line", "i.message")


def orphan_footnotes(docs: DataFrame) -> DataFrame:
    """Markers without definition, at their first line."""
    from .structure import footnote_defs, footnote_markers

    books = docs.withColumnRenamed("doc_id", "book_id")
    used = footnote_markers(books).groupBy("book_id", "marker").agg(F.min("line").alias("line"))
    lost = used.join(footnote_defs(books).select("book_id", "marker"), ["book_id", "marker"], "left_anti")
    return lost.select(
        F.col("book_id").alias("doc_id"), F.lit("orphan_footnotes").alias("check_name"), "line",
        F.col("marker").alias("message")
    )


def leaks(docs: DataFrame, least: int = 80) -> DataFrame:
    """Runs of English prose; they may go over line ends, so the line is that of the text's first."""
    return docs.select(
        "doc_id", F.lit("english_leaks").alias("check_name"), F.lit(1).alias("line"),
        F.explode(english_leaks(F.col("text"), least)).alias("message")
    )


def mixed_alphabets(docs: DataFrame, protected: Column | None = None) -> DataFrame:
    rows = docs.select("*", F.posexplode(F.split("text", "\n")).alias("n", "line_text"))
    return rows.select(
        "doc_id", F.lit("mixed_alphabets").alias("check_name"), (F.col("n") + 1).alias("line"),
        F.explode(mixed_words(F.col("line_text"), protected=protected)).alias("message")
    )


def code_fences(docs: DataFrame) -> DataFrame:
    """An odd number of fences, at the last one."""
    at = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.when(x.startswith("```"), i + 1)), lambda x: x.isNotNull())
    found = docs.select("doc_id", at.alias("at")).where(F.size("at") % 2 == 1)
    return found.select(
        "doc_id", F.lit("code_fences").alias("check_name"), F.element_at("at", -1).alias("line"),
        F.size("at").cast("string").alias("message")
    )


def all_issues(docs: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [line_issues(docs), orphan_footnotes(docs), leaks(docs), mixed_alphabets(docs), code_fences(docs)])


def early_checks(docs: DataFrame) -> DataFrame:
    return line_issues(docs, EARLY)


def severity_cube(issues: DataFrame) -> DataFrame:
    """Issue counts by check and document, and their margins."""
    return issues.cube("check_name", "doc_id").agg(F.count("*").alias("n"))
