"""Files that appear whole: a file a row, books, versions; and HTML's lists, tables and preformatted text."""

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from bookmill.operators import build, sections
from bookmill.sources import books, sinks


def files(folder):
    return {
        os.path.relpath(os.path.join(d, n), folder): open(os.path.join(d, n), "rb").read() for d, _,
        names in os.walk(folder) for n in names
    }


def test_a_file_for_each_row_in_place_of_older_ones(spark, tmp_path):
    rows = spark.createDataFrame([("a/x.txt", "one é"), ("b.txt", None), ("a/y.txt", "")], "name string, value string")
    assert sinks.sink_files(rows, str(tmp_path)) == {"files": 3, "bytes": len("one é".encode())}
    sinks.sink_files(rows.where("name = 'b.txt'").withColumn("value", F.lit("new")), f"file://{tmp_path}")
    assert files(tmp_path) == {"a/x.txt": "one é".encode(), "b.txt": b"new", "a/y.txt": b""}
    with pytest.raises(Exception, match="no name of a file"):
        sinks.sink_files(spark.createDataFrame([("../x", "v")], "name string, value string"), str(tmp_path))
    assert sinks.sink_files(rows.limit(0), str(tmp_path)) == {"files": 0, "bytes": 0}


def test_a_held_file_is_tried_again(tmp_path, monkeypatch):
    tries = []

    def held(src, dst, real=os.replace):
        tries.append(dst)
        if len(tries) < 3:
            raise PermissionError(dst)
        real(src, dst)

    monkeypatch.setattr(sinks.os, "replace", held)
    monkeypatch.setattr(sinks, "PAUSE", 0)
    sinks.write_file(str(tmp_path / "x"), b"v")
    assert files(tmp_path) == {"x": b"v"} and len(tries) == 3
    monkeypatch.setattr(sinks, "RETRIES", 1)
    tries.clear()
    with pytest.raises(PermissionError):
        sinks.write_file(str(tmp_path / "x"), b"w")
    assert files(tmp_path) == {"x": b"v"}


def test_chunk_and_json_files(spark, tmp_path):
    rows = spark.createDataFrame(
        [("b", 1, 1, "T", "One. Two."), ("b", 2, 1, "U", "Three.")],
        "book_id string, section_no int, level int, title string, text string"
    )
    manifest = sections.number_chunks(rows)
    sinks.sink_chunk_files(manifest, str(tmp_path))
    got = files(tmp_path)
    assert got["b/chunk0001.md"] == b"One. Two." and got["b/chunk0002.md"] == b"Three."
    listed = json.loads(got["b/manifest.json"])["chunks"]
    assert [(c["chunk_id"], c["section_title"], c["size"]) for c in listed] == [("chunk0001", "T", 9), ("chunk0002", "U", 6)]
    sinks.sink_task_files(spark.createDataFrame([("b", 7, "task")], "book_id string, chunk_no int, value string"), str(tmp_path))
    assert files(tmp_path)["b/task_chunk0007.md"] == b"task"
    sinks.sink_json_files(spark.createDataFrame([(1, "x")], "k int, v string"), F.lit("one.json"), str(tmp_path))
    assert json.loads(files(tmp_path)["one.json"]) == {"k": 1, "v": "x"}


def test_readers_always_find_a_version(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_snapshot(spark.range(3), path)
    stop, lost = threading.Event(), []

    def read():
        while not stop.is_set():
            if not os.path.exists(f"{path}/CURRENT"):
                lost.append(1)

    reader = threading.Thread(target=read)
    reader.start()
    for n in (4, 5, 6):
        sinks.write_snapshot(spark.range(n), path)
        assert sinks.read_snapshot(spark, path).count() == n
    stop.set()
    reader.join()
    assert not lost


def test_books_are_built_and_written(spark, tmp_path):
    chunks = [
        ("b", 1, "# One\n\nText.[^1]\n\n![m](images/m.png)"), ("b", 2, "  "),
        ("b", 3, "## Two\n\nMore.\n\n[^1]: Note."), ("c", 1, "Only.")
    ]
    turns = spark.createDataFrame(chunks, "book_id string, chunk_no int, text string")
    manifest = turns.select(
        "book_id", "chunk_no",
        F.sha2(F.when(F.col("book_id") == "c", "other").otherwise(F.col("text")), 256).alias("source")
    )
    author = F.struct(
        F.lit("Ann").alias("first_name"), F.lit(None).cast("string").alias("middle_name"),
        F.lit("Bee").alias("last_name"), F.lit(None).cast("string").alias("nickname")
    )
    headers = spark.createDataFrame([("b", "B"), ("c", "C"), ("d", "D")], "book_id string, title string").select(
        "book_id", "title", author.alias("author"), F.lit("en").alias("lang"), F.lit("2020").alias("date"),
        F.lit("u").alias("uid")
    )
    images = spark.createDataFrame([("b", "OEBPS/images/m.png", bytearray(b"\x89PNG"))], "book_id string, path string, content binary")
    built = build.build_books(manifest, turns, turns, headers, images).cache()
    got = {r.book_id: r for r in built.collect()}
    assert got["b"].n_empty == 1 and got["b"].findings == ["chunk0002: empty_output"] and got["c"].findings == ["chunk0001: hash_mismatch"]
    assert got["b"].md == "# One\n\nText.[^1]\n\n![m](images/m.png)\n\n## Two\n\nMore.\n\n[^1]: Note." and got["d"].md == ""
    assert '<binary id="_img_0" content-type="image/png">iVBORw==</binary>' in got["b"].fb2 and got["b"].faults == [] and got["d"].faults
    assert sinks.sink_books(built, str(tmp_path))["files"] == 6
    assert files(tmp_path)["b/output.md"].decode() == got["b"].md and files(tmp_path)["c/book.fb2"].decode() == got["c"].fb2
    assert {r.fb2 for r in build.build_books(manifest, turns, turns, headers, fb2=False).collect()} == {None}


@pytest.mark.parametrize(
    "html, markdown",
    [
        (
            "<ul><li>a</li><li>b<ol><li>x</li><li><p>y</p></li></ol></li><li>c</li></ul>",
            "- a\n\n- b\n\n    1. x\n\n    2. y\n\n- c\n"
        ),
        (
            "<table><tr><th>A|</th><th>B</th></tr><tr><td>1</td><td><p>2</p><p>3</p></td></tr><tr><td>only</td></tr></table>after",
            "| A\\| | B |\n| --- | --- |\n| 1 | 2 3 |\n| only |  |\n\nafter\n"
        ),
        ("x<pre>  a\n <b>b</b> </pre>y", "x\n\n```\n  a\n b \n```\n\ny\n"),
        ("<a href='u' title='t'>l</a> <img src='s' alt='A' title='T'>", '[l](u "t") ![A](s "T")\n'),
        ("<pre>un", "```\nun\n```\n"), ("<table><tr><td>a", "") , ("</table></ul></pre>t", "t\n"),
    ],
)
def test_html_blocks(html, markdown):
    assert books.to_markdown(html) == markdown
