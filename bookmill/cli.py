"""Command line over folders of books: `python -m bookmill.cli COMMAND ROOT ...`.

A book is a folder of ROOT: process/manifest.json and process/chunkNNNN.md (its chunks), process/output_chunkNNNN.md,
process/output_chunkNNNN.meta.json, glossary.json, and what build writes, output.md and book.fb2. Every command works on
all books of ROOT at once. A file of no bytes counts as absent. Exit codes: 0 nothing to report, 1 issues, 2 input that
can't be worked on.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from .config import Config, load
from .functions import clean, text as T
from .operators import build, contracts as C, glossary as G, payload as P, qa as Q, sections as S, state as ST, structure as U
from .session import session
from .sources import books as B, sinks

OK, ISSUES, INVALID = 0, 1, 2
RECORDS = (
    "book_id string, chunk_no int, glossary_version int, entity_hashes map<string,string>, output_exists boolean, output_size bigint, "
    "failed boolean, failure_reason string, polish_failed boolean, polish_failure_reason string"
)
APPLIED = "book_id string, chunk_no int, hash string"


class Books:
    """The files of all books below a root, as tables."""

    def __init__(self, spark: SparkSession, root: str, config: Config):
        self.spark, self.root, self.config = spark, root.rstrip("/"), config

    def _files(self, place: str, glob: str) -> DataFrame:
        """(book_id, file, text) of the files of every book that fit."""
        depth = r"/([^/]+)/process/([^/]+)$" if place else r"/([^/]+)/([^/]+)$"
        try:
            rows = B.scan_text_safe(B.binary_files(self.spark, f"{self.root}/*{place}", glob))
        except AnalysisException:  # no such folder in any book
            return self.spark.createDataFrame([], "book_id string, file string, text string")
        at = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
        return rows.select(F.regexp_extract(at, depth, 1).alias("book_id"), F.regexp_extract(at, depth, 2).alias("file"), "text")

    def _numbered(self, glob: str) -> DataFrame:
        files = self._files("/process", glob).where(~F.col("file").rlike(r"\.(?:bak|tmp)$|\.polished\.md$"))
        return files.select("book_id", F.regexp_extract("file", r"(\d+)", 1).cast("int").alias("chunk_no"), "text")

    def chunks(self) -> DataFrame:
        return self._numbered("chunk*.md")

    def outputs(self) -> DataFrame:
        return self._numbered("output_chunk*.md")

    def metas(self) -> DataFrame:
        return self._numbered("output_chunk*.meta.json").withColumnRenamed("text", "meta")

    def manifest(self) -> DataFrame:
        entry = "array<struct<chunk_id:string,section_title:string,section_level:int,source:string,size:bigint>>"
        listed = self._files("/process", "manifest.json").select(
            "book_id", F.explode(F.from_json("text", f"chunks {entry}")["chunks"]).alias("c")
        )
        return listed.select("book_id", T.chunk_number(F.col("c.chunk_id")).alias("chunk_no"), "c.*")

    def terms(self) -> DataFrame:
        return G.load_glossary(self._files("", "glossary.json").select("book_id", "text"))

    def polished(self) -> DataFrame:
        """Polished texts beside the outputs that they are made of, and the backups of applied ones: src, out."""
        return self._pairs("output_chunk*.polished.md", r"\.polished\.md$", "src", "out")

    def applied_polish(self) -> DataFrame:
        return self._pairs("output_chunk*.md.bak", r"\.md\.bak$", "out", "src")

    def _pairs(self, glob: str, ending: str, of_output: str, of_other: str) -> DataFrame:
        files = self._files("/process", glob).where(F.col("file").rlike(ending))
        other = files.select("book_id", F.regexp_extract("file", r"(\d+)", 1).cast("int").alias("chunk_no"), F.col("text").alias(of_other))
        return other.join(self.outputs().withColumnRenamed("text", of_output), ["book_id", "chunk_no"])

    def table(self, name: str, schema: str) -> DataFrame:
        """The current version of a table that commands keep, or an empty one."""
        try:
            return sinks.read_snapshot(self.spark, f"{self.root}/.{name}")
        except AnalysisException:
            return self.spark.createDataFrame([], schema)

    def records(self) -> DataFrame:
        return self.table("records", RECORDS)

    def write(self, rows: DataFrame, dealt_by: str = "name") -> dict[str, int]:
        """Files (name, value) that may replace ones which the rows are made of: a shuffle stands between reading and writing."""
        return sinks.sink_files(rows.repartition(1 + self.spark.sparkContext.defaultParallelism, dealt_by), self.root)

    def write_terms(self, terms: DataFrame) -> None:
        """glossary.json of every book; the old files are read to the end before any is replaced."""
        fields = [c for c in terms.columns if c not in ("book_id", "pos")]
        whole = F.struct(
            F.lit(2).alias("version"),
            F.transform(
                F.array_sort(F.collect_list(F.struct("pos", F.struct(*fields).alias("t")))), lambda x: x.t
            ).alias("terms")
        )
        made = (
            terms.groupBy("book_id").agg(F.to_json(whole).alias("value"))
            .select(F.concat("book_id", F.lit("/glossary.json")).alias("name"), "value")
        )
        self.write(made)


def _told(rows: DataFrame, order: list[str], show: int = 200) -> int:
    """Print the first rows of a report; how many there are."""
    n = rows.count()
    for r in rows.orderBy(*order).limit(show).collect():
        print("\t".join("" if v is None else str(v) for v in r))
    if n > show:
        print(f"... and {n - show} more")
    return n


def _issues(rows: DataFrame, order: list[str]) -> int:
    return ISSUES if _told(rows, order) else OK


def convert(b: Books, a: argparse.Namespace) -> int:
    """EPUB, FB2 and Markdown files into chunk files and a manifest for each."""
    files = B.binary_files(b.spark, a.files, "*")
    kind = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    texts = B.epub_to_markdown(files.where(kind == "epub")).select(F.col("book_id").alias("path"), "text")
    plain = B.scan_text_safe(files.where(kind.isin("md", "txt", "fb2")))
    texts = texts.unionByName(plain.where(kind != "fb2")).unionByName(
        plain.where(kind == "fb2").select("path", B.scan_fb2("text").alias("text"))
    )
    names = F.regexp_extract(F.url_decode("path"), r"([^/]+)\.[^./]+$", 1)
    books = texts.select(names.alias("book_id"), clean.clean_markdown(clean.strip_toc(F.col("text"))).alias("text"))
    had = b.manifest().select("book_id").distinct()
    there = books.join(had, "book_id", "left_semi")
    if not a.force and _told(there.select("book_id", F.lit("has chunks already; --force replaces them")), ["book_id"]):
        return INVALID
    made = S.number_chunks(S.merge_front_back(S.split_sections(books)), b.config.chunking)
    done = sinks.sink_chunk_files(made, b.root, "/process")
    print(f"{done['files']} files written")
    return OK if done["files"] else INVALID


def explore(b: Books, a: argparse.Namespace) -> int:
    files = B.binary_files(b.spark, a.files, "*.epub")
    _told(B.epub_contents(files).select("book_id", "n", "level", "title", "src"), ["book_id", "n"])
    return OK if _told(B.epub_metadata(files), ["book_id", "name"]) else INVALID


def count_frequencies(b: Books, a: argparse.Namespace) -> int:
    terms = b.terms()
    counted = G.term_frequency(terms, b.chunks())
    merged = terms.drop("frequency").join(counted.select("book_id", "pos", "frequency"), ["book_id", "pos"]).select(*terms.columns)
    b.write_terms(merged)
    return _issues(G.zero_freq_terms(counted).select("book_id", "source", F.lit("occurs nowhere")), ["book_id", "source"])


def print_terms(b: Books, a: argparse.Namespace) -> int:
    chunks = P.chunk_range(b.chunks(), a.start, a.end)
    return OK if _told(
        G.term_table(G.relevant_terms(b.terms(), chunks, b.config.high_frequency_top_n)), ["book_id", "chunk_no"]
    ) else INVALID


def validate_glossary(b: Books, a: argparse.Namespace) -> int:
    terms = b.terms()
    if a.fix:
        b.write_terms(G.fix_glossary(terms))
        terms = b.terms()
    found = G.validate_glossary(terms)
    _told(found, ["book_id", "pos", "rule"])
    return ISSUES if found.where("severity = 'error'").count() else OK


def validate_manifest(b: Books, a: argparse.Namespace) -> int:
    found = C.validate_manifest(b.manifest(), b.chunks(), b.outputs(), b.config.quality, a.strict)
    _told(found, ["book_id", "chunk_no"])
    return ISSUES if found.where("severity = 'error'").count() else OK


def confirm_terms(b: Books, a: argparse.Namespace) -> int:
    if not (a.all or a.id or a.source):
        print("one of --all, --id, --source is needed", file=sys.stderr)
        return INVALID
    b.write_terms(G.confirm_terms(b.terms(), None if a.all else a.source, None if a.all else a.id, a.note or "", a.force))
    return OK


def reset_run_state(b: Books, a: argparse.Namespace) -> int:
    b.write_terms(G.reset_terms(b.terms(), a.prune_zero_freq))
    return OK


def verify_batch(b: Books, a: argparse.Namespace) -> int:
    found = C.verify_batch(P.chunk_range(b.chunks(), a.start, a.end), b.outputs(), b.metas(), b.config.quality)
    return _issues(found.where("status != 'ok' OR missing_meta"), ["book_id", "chunk_no"])


def check_metas(b: Books, a: argparse.Namespace) -> int:
    parsed = G.parse_metas(b.metas())
    return _issues(parsed.where(F.size("errors") > 0).select("book_id", "chunk_no", F.array_join("errors", ", ")), ["book_id", "chunk_no"])


def quality_check(b: Books, a: argparse.Namespace) -> int:
    outputs = P.chunk_range(b.outputs(), a.start, a.end)
    issues = Q.all_issues(outputs.select(F.concat_ws("/", "book_id", F.format_string("chunk%04d", "chunk_no")).alias("doc_id"), "text"))
    found = _told(C.issue_rollup(issues), ["check_name"])
    return ISSUES if a.strict and found else OK


def merge_status(b: Books, a: argparse.Namespace) -> int:
    _told(G.merge_status(b.metas(), b.outputs(), b.table("applied", APPLIED)), ["book_id"])
    return OK


def plan(b: Books, a: argparse.Namespace) -> int:
    planned = ST.plan(b.manifest(), b.chunks(), b.outputs(), b.records(), b.terms(), a.retranslate_untracked)
    _told(ST.plan_summary(planned), ["book_id", "category"])
    return _issues(planned.where("category IN ('failed', 'translation') OR polish_failed"), ["book_id", "chunk_no"])


def record(b: Books, a: argparse.Namespace) -> int:
    chunks = P.chunk_range(b.chunks(), a.start, a.end)
    kept = ST.record(b.records(), chunks, b.outputs(), b.terms(), 2).select(*(c.split()[0] for c in RECORDS.split(", ")))
    sinks.write_snapshot(kept.withColumn("glossary_version", F.col("glossary_version").cast("int")), f"{b.root}/.records")
    return OK


def mark_failed(b: Books, a: argparse.Namespace) -> int:
    failures = b.spark.createDataFrame([(a.book, a.chunk, a.reason)], "book_id string, chunk_no int, reason string")
    had = b.records()
    if failures.join(had, ["book_id", "chunk_no"]).isEmpty():
        print("no record of that chunk", file=sys.stderr)
        return INVALID
    sinks.write_snapshot(ST.mark_failed(had, failures, a.polish), f"{b.root}/.records")
    return OK


def prepare_batch(b: Books, a: argparse.Namespace) -> int:
    chunks = b.chunks()
    tables = G.term_table(G.relevant_terms(b.terms(), chunks, b.config.high_frequency_top_n))
    tasks = P.chunk_range(P.task_payload(chunks, tables, b.config.context_chars), a.start, a.end)
    done = sinks.sink_files(
        tasks.select(
            F.concat("book_id", F.format_string("/process/task_chunk%04d.md", "chunk_no")).alias("name"), "value"
        ),
        b.root
    )
    print(f"{done['files']} files written")
    return OK if done["files"] else INVALID


def prepare_merge(b: Books, a: argparse.Namespace) -> int:
    metas, applied = b.metas(), b.table("applied", APPLIED)
    proposed = G.prepare_merge(metas, b.terms(), applied)
    sinks.write_plan(proposed, G.consumed_metas(metas, applied), f"{b.root}/.plan")
    stored = sinks.read_snapshot(b.spark, f"{b.root}/.plan", "plan")[0]
    return _issues(
        stored.where("outcome = 'decision'").select(
            "book_id", "id", "kind", "source", "field", "value", F.array_join("options", " | ")
        ),
        ["book_id", "id"]
    )


def apply_merge(b: Books, a: argparse.Namespace) -> int:
    """Plan of prepare-merge, decisions in a folder of book.json files."""
    proposed, consumed = sinks.read_snapshot(b.spark, f"{b.root}/.plan", "plan", "consumed")
    files = b.spark.read.text(
        a.decisions, wholetext=True, pathGlobFilter="*.json"
    ) if a.decisions else b.spark.createDataFrame([], "value string")
    book = F.regexp_extract(F.url_decode(F.col("_metadata.file_path")), r"([^/]+)\.json$", 1) if a.decisions else F.lit("")
    decisions = G.parse_decisions(files.select(book.alias("book_id"), F.col("value").alias("text")))
    faulty = G.validate_decisions(proposed, decisions)
    if _told(faulty, ["book_id", "id"]):
        return INVALID
    terms, applied = G.finish_merge(proposed, consumed, b.terms(), b.table("applied", APPLIED), decisions)
    b.write_terms(terms)
    sinks.write_snapshot(applied.select("book_id", F.col("chunk_no").cast("int"), "hash"), f"{b.root}/.applied")
    return OK


def apply_polish(b: Books, a: argparse.Namespace) -> int:
    pairs = b.polished().join(C.polish_contract(b.polished(), b.config.polish), ["book_id", "chunk_no"])
    output = F.concat("book_id", F.format_string("/process/output_chunk%04d.md", "chunk_no"))
    files = F.array(
        F.struct(F.concat(output, F.lit(".bak")).alias("name"), F.col("src").alias("value")),
        F.struct(output.alias("name"), F.col("out").alias("value"))
    )
    b.write(pairs.where("reasons = ''").select("book_id", "chunk_no", F.explode(files).alias("f")).select("f.name", "f.value"))
    return _issues(pairs.where("reasons != ''").select("book_id", "chunk_no", "reasons"), ["book_id", "chunk_no"])


def verify_polish(b: Books, a: argparse.Namespace) -> int:
    return _issues(C.verify_polish(b.applied_polish(), b.config.polish).where("reasons != ''"), ["book_id", "chunk_no"])


def _payload(b: Books, rows: DataFrame, name: str, save: bool) -> int:
    if save:
        return OK if sinks.sink_files(
            rows.select(
                F.concat("book_id", F.lit(f"/process/{name}.json")).alias("name"), F.col("payload").alias("value")
            ),
            b.root
        )["files"] else INVALID
    return OK if _told(rows, ["book_id"]) else INVALID


def pronoun_check(b: Books, a: argparse.Namespace) -> int:
    return _payload(b, P.pronoun_payload(b.terms(), b.metas(), b.outputs(), b.config.payload), "pronouns", a.save)


def post_mortem(b: Books, a: argparse.Namespace) -> int:
    manifest = b.manifest()
    labels = manifest.select("book_id", "chunk_no", F.col("section_title").alias("label"))
    found = "issues array<struct<severity:string,category:string>>"
    issues = (
        b._numbered("output_chunk*.qa.json")
        .select("book_id", "chunk_no", F.explode(F.from_json("text", found)["issues"]).alias("i"))
        .select("book_id", "chunk_no", "i.*")
    )
    rows = P.post_mortem_payload(manifest, U.narrative_arcs(labels), issues, b.config.payload, metas=b.metas(), sections=manifest)
    return _payload(b, rows, "post_mortem", a.save)


def build_books(b: Books, a: argparse.Namespace) -> int:
    author = T.fill_author(F.lit(a.author))
    headers = (
        b.manifest().select("book_id").distinct()
        .select(
            "book_id", F.coalesce(F.lit(a.title), "book_id").alias("title"), author.alias("author"),
            F.lit(a.lang).alias("lang"), F.lit(datetime.now(timezone.utc).date().isoformat()).alias("date")
        )
    )
    headers = headers.withColumn("uid", T.doc_uid(F.col("title"), F.lit(a.author), F.col("date")))
    built = build.build_books(b.manifest(), b.chunks(), b.outputs(), headers, q=b.config.quality, fb2=not a.no_fb2).persist()
    done = sinks.sink_books(built, b.root, not a.no_fb2)
    print(f"{done['files']} files written")
    told = built.select("book_id", F.explode(F.concat("findings", F.coalesce("faults", F.array().cast("array<string>")))).alias("what"))
    _told(told, ["book_id", "what"])
    return OK if done["files"] else INVALID


def save_state(b: Books, a: argparse.Namespace) -> int:
    if not 1 <= a.step <= 10:
        print("a step is a number from 1 to 10", file=sys.stderr)
        return INVALID
    given = [
        (op, *pair.partition("=")[::2]) for op,
        pairs in (
            ("set", a.set), ("set_int", a.set_int), ("append", a.append_list)
        ) for pair in pairs or [] if "=" in pair
    ]
    rows = [
        (
            a.book, datetime.now(timezone.utc).replace(tzinfo=None), a.step, a.note,
            [{"op": o, "key": k, "value": v} for o, k, v in given]
        )
    ]
    saves = b.spark.createDataFrame(rows, f"book_id string, ts timestamp, step int, note string, options {ST.OPTIONS}")
    old = _log(b)
    ST.state_save(old, saves).join(
        old.select("book_id", "seq"), ["book_id", "seq"], "left_anti"
    ).select(*old.columns).write.mode("append").parquet(f"{b.root}/.state")
    return OK


def _log(b: Books) -> DataFrame:
    schema = f"book_id string, ts timestamp, seq bigint, step int, note string, options {ST.OPTIONS}"
    try:
        return b.spark.read.schema(schema).parquet(f"{b.root}/.state")
    except AnalysisException:
        return b.spark.createDataFrame([], schema)


def load_state(b: Books, a: argparse.Namespace) -> int:
    log = _log(b)
    found = _told(ST.state_load(log), ["book_id"])
    _told(ST.state_values(log), ["book_id", "key"])
    return OK if found else INVALID


def _simple(report: Callable[[Books], DataFrame], order: list[str], issues: bool) -> Callable[[Books, argparse.Namespace], int]:
    def run(b: Books, a: argparse.Namespace) -> int:
        n = _told(report(b), order)
        return ISSUES if issues and n else OK

    return run


_FLAG, _RANGE = {"action": "store_true"}, (("--start", {"type": int}), ("--end", {"type": int}))
COMMANDS: dict[str, tuple[Callable[[Books, argparse.Namespace], int], tuple]] = {
    "convert": (convert, (("files", {}), ("--force", _FLAG))), "explore": (explore, (("files", {}),)),
    "count-frequencies": (count_frequencies, ()), "print-terms": (print_terms, _RANGE),
    "validate-glossary": (validate_glossary, (("--fix", _FLAG),)),
    "validate-manifest": (validate_manifest, (("--strict", _FLAG),)),
    "find-duplicates": (_simple(lambda b: G.find_duplicates(b.terms()), ["book_id", "a_pos", "b_pos"], True), ()),
    "inspect-manifest": (_simple(lambda b: S.inspect_manifest(b.manifest()), ["book_id", "line_no"], False), ()),
    "confirm-terms": (
        confirm_terms,
        (("--all", _FLAG), ("--id", {"nargs": "+"}), ("--source", {"nargs": "+"}), ("--note", {}), ("--force", _FLAG))
    ),
    "reset-run-state": (reset_run_state, (("--prune-zero-freq", _FLAG),)), "verify-batch": (verify_batch, _RANGE),
    "check-metas": (check_metas, ()), "quality-check": (quality_check, (*_RANGE, ("--strict", _FLAG))),
    "merge-status": (merge_status, ()), "prepare-merge": (prepare_merge, ()),
    "apply-merge": (apply_merge, (("--decisions", {}),)), "plan": (plan, (("--retranslate-untracked", _FLAG),)),
    "record": (record, _RANGE),
    "mark-failed": (mark_failed, (("book", {}), ("chunk", {"type": int}), ("reason", {}), ("--polish", _FLAG))),
    "prepare-batch": (prepare_batch, _RANGE), "apply-polish": (apply_polish, ()), "verify-polish": (verify_polish, ()),
    "pronoun-check": (pronoun_check, (("--save", _FLAG),)), "post-mortem": (post_mortem, (("--save", _FLAG),)),
    "build": (
        build_books,
        (("--title", {}), ("--author", {"default": ""}), ("--lang", {"default": "ru"}), ("--no-fb2", _FLAG))
    ),
    "save-state": (
        save_state,
        (
            ("book", {}), ("step", {"type": int}), ("--note", {}), ("--set", {"action": "append"}),
            ("--set-int", {"action": "append"}), ("--append-list", {"action": "append"})
        )
    ),
    "load-state": (load_state, ()),
}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="bookmill", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    out.add_argument("--config", action="append", default=[], help="TOML file of limits and thresholds; the first that exists counts")
    commands = out.add_subparsers(dest="command", required=True)
    for name, (run, arguments) in COMMANDS.items():
        own = commands.add_parser(name, help=(run.__doc__ or name.replace("-", " ")).splitlines()[0])
        own.add_argument("root")
        for flag, how in arguments:
            own.add_argument(flag, **how)
    return out


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(arguments)
    books = Books(spark or session(), a.root, load(a.config))
    return COMMANDS[a.command][0](books, a)


if __name__ == "__main__":
    sys.exit(main())
