"""The command line over a folder of books, with its exit codes."""

import json

import pytest

from bookmill import cli
from bookmill.plans.files import epub_bytes


@pytest.fixture
def root(tmp_path, spark):
    given = tmp_path / "in"
    given.mkdir()
    (given / "glass.epub").write_bytes(epub_bytes())
    (given / "plain book.md").write_text("# One\n\nAnn went home. " + "Words and more words. " * 30 + "\n\n# Two\n\nBob stayed.\n")
    books = tmp_path / "books"
    books.mkdir()
    assert cli.main(["convert", str(books), str(given)], spark) == cli.OK
    return books


def run(spark, capsys, *arguments):
    capsys.readouterr()
    code = cli.main(list(map(str, arguments)), spark)
    return code, capsys.readouterr().out


def test_books_from_files_to_fb2(spark, root, capsys):
    listed = json.loads((root / "plain book/process/manifest.json").read_text())["chunks"]
    assert [c["section_title"] for c in listed] == ["One", "Two"]
    assert run(spark, capsys, "convert", root, root.parent / "in")[0] == cli.INVALID
    code, out = run(spark, capsys, "inspect-manifest", root)
    assert code == cli.OK and "chunk0001" in out and "2 chunks" in out
    assert run(spark, capsys, "verify-batch", root)[0] == cli.ISSUES  # no outputs yet
    for book in root.iterdir():
        for chunk in (book / "process").glob("chunk*.md"):
            (book / "process" / f"output_{chunk.name}").write_text(chunk.read_text())
            (book / "process" / f"output_{chunk.stem}.meta.json").write_text("{}")
    code, out = run(spark, capsys, "validate-manifest", root)
    assert code == cli.OK and "english_leak" in out and run(spark, capsys, "validate-manifest", root, "--strict")[0] == cli.ISSUES
    assert run(spark, capsys, "check-metas", root)[0] == cli.OK
    (root / "plain book/process/output_chunk0002.meta.json").write_text("no json")
    code, out = run(spark, capsys, "check-metas", root)
    assert code == cli.ISSUES and "plain book\t2\tnot_json" in out
    code, out = run(spark, capsys, "merge-status", root)
    assert code == cli.OK and "plain book\t0\t1\t1\t0" in out
    assert run(spark, capsys, "build", root, "--author", "Ann Bee")[0] == cli.OK
    assert (
        root / "plain book/output.md"
    ).read_text().startswith("# One") and "<last-name>Bee</last-name>" in (root / "glass/book.fb2").read_text()
    assert run(spark, capsys, "quality-check", root)[0] == cli.OK


def test_glossaries(spark, root, capsys):
    terms = [
        {"source": "Ann", "target": "Анна", "confidence": "low"}, {"source": "Anns", "target": "", "id": "x"},
        {"source": "Zed", "target": "Зед", "id": "x"}
    ]
    (root / "plain book/glossary.json").write_text(json.dumps({"terms": terms}))
    read = lambda: {t["source"]: t for t in json.loads((root / "plain book/glossary.json").read_text())["terms"]}
    code, out = run(spark, capsys, "validate-glossary", root, "--fix")
    assert code == cli.ISSUES and "empty_target" in out and [t["id"] for t in read().values()] == ["ann", "x", "zed"]
    code, out = run(spark, capsys, "count-frequencies", root)
    assert code == cli.ISSUES and "Zed" in out and read()["Ann"]["frequency"] == 1
    assert run(spark, capsys, "find-duplicates", root)[0] == cli.ISSUES
    assert run(spark, capsys, "confirm-terms", root)[0] == cli.INVALID
    assert run(
        spark, capsys, "confirm-terms", root, "--source", "Ann", "--note", "seen"
    )[0] == cli.OK and read()["Ann"]["confidence"] == "high" and read()["Zed"]["confidence"] == "low"
    code, out = run(spark, capsys, "print-terms", root, "--end", 1)
    assert code == cli.OK and "| Ann |  | Анна |" in out
    assert run(spark, capsys, "reset-run-state", root, "--prune-zero-freq")[0] == cli.OK and list(read()) == ["Ann"]


def test_states_and_exploring(spark, root, capsys):
    assert run(spark, capsys, "load-state", root)[0] == cli.INVALID and run(spark, capsys, "save-state", root, "b", 11)[0] == cli.INVALID
    assert run(spark, capsys, "save-state", root, "b", 2, "--note", "first", "--set", "lang=de", "--append-list", "l=x")[0] == cli.OK
    assert run(spark, capsys, "save-state", root, "b", 1, "--set-int", "n=7", "--append-list", "l=x", "--append-list", "l=y")[0] == cli.OK
    code, out = run(spark, capsys, "load-state", root)
    assert code == cli.OK and "b\t1,2\t2\t1\tfirst" in out and "b\tl\tlist\tx,y" in out and "b\tn\tint\t7" in out
    code, out = run(spark, capsys, "explore", root, root.parent / "in")
    assert code == cli.OK and "creator\tAnn Bee; Cy Dee" in out and "Inner" in out


def test_planning_merging_and_polishing(spark, root, capsys):
    book = root / "plain book"
    (book / "glossary.json").write_text(json.dumps({"terms": [{"source": "Ann", "target": "Анна", "id": "ann"}]}))
    (root / "glass/glossary.json").write_text(json.dumps({"terms": []}))
    assert run(
        spark, capsys, "prepare-batch", root, "--end", 1
    )[0] == cli.OK and "| Ann |  | Анна |" in (book / "process/task_chunk0001.md").read_text()
    for k in (1, 2):
        (book / f"process/output_chunk000{k}.md").write_text((book / f"process/chunk000{k}.md").read_text())
    metas = {
        1: {"new_entities": [{"source": "Zed", "target_proposal": "Зед"}]},
        2: {"new_entities": [{"source": "Ann", "target_proposal": "Анн"}]}
    }
    for k, m in metas.items():
        (book / f"process/output_chunk000{k}.meta.json").write_text(json.dumps(m))
    code, out = run(spark, capsys, "plan", root)
    assert code == cli.ISSUES and "glass\t1\ttranslation" in out and "plain book\trecord_only\t2" in out
    assert run(spark, capsys, "record", root)[0] == cli.OK and run(spark, capsys, "mark-failed", root, "plain book", 2, "bad")[0] == cli.OK
    assert run(spark, capsys, "mark-failed", root, "plain book", 9, "bad")[0] == cli.INVALID
    code, out = run(spark, capsys, "plan", root)
    assert "plain book\tunchanged\t1" in out and "plain book\t2\tfailed" in out
    code, out = run(spark, capsys, "prepare-merge", root)
    assert code == cli.ISSUES and "existing_entity_conflict" in out
    asked = out.split("\t")[1]
    chosen = root.parent / "decisions"
    chosen.mkdir()
    (chosen / "plain book.json").write_text(json.dumps([{"id": asked, "choice": "nonsense"}]))
    assert run(spark, capsys, "apply-merge", root, "--decisions", chosen)[0] == cli.INVALID
    (chosen / "plain book.json").write_text(json.dumps([{"id": asked, "choice": "Анн"}]))
    assert run(spark, capsys, "apply-merge", root, "--decisions", chosen)[0] == cli.OK
    terms = {t["source"]: t for t in json.loads((book / "glossary.json").read_text())["terms"]}
    assert terms["Ann"]["target"] == "Анн" and terms["Zed"]["target"] == "Зед"
    assert run(spark, capsys, "prepare-merge", root)[0] == cli.OK
    code, out = run(spark, capsys, "merge-status", root)
    assert "plain book\t2\t0\t0\t0" in out
    before = (book / "process/output_chunk0001.md").read_text()
    (book / "process/output_chunk0001.polished.md").write_text(before + " And a little more.")
    (book / "process/output_chunk0002.polished.md").write_text(" \n")
    code, out = run(spark, capsys, "apply-polish", root)
    assert code == cli.ISSUES and "plain book\t2\tpolished_empty" in out
    assert (book / "process/output_chunk0001.md").read_text().endswith("more.") and (
        book / "process/output_chunk0001.md.bak"
    ).read_text() == before
    assert run(spark, capsys, "verify-polish", root)[0] == cli.OK
    assert run(
        spark, capsys, "pronoun-check", root, "--save"
    )[0] == cli.OK and json.loads((book / "process/pronouns.json").read_text())["glossary"]
    (book / "process/output_chunk0001.qa.json").write_text(json.dumps({"issues": [{"severity": "high", "category": "x"}]}))
    assert run(spark, capsys, "post-mortem", root, "--save")[0] == cli.OK
    told = json.loads((book / "process/post_mortem.json").read_text())
    assert told["chunks"] == 2 and told["issues"][0]["severity"] == "high" and told["metas"]["chunk0001"]["new_entities"] and told["sections"]["chunk0002"] == {"section_title": "Two"}
