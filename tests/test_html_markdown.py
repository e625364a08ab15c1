"""html_to_markdown over every page, against Markdown written by hand."""

import hashlib

from bookmill.plans import catalog

PAGES = {
    "<html><head><title>no</title></head><body><h1>Plain</h1><p>One <b>two</b> <i>three</i>.</p></body></html>": "# Plain\n\nOne **two** *three*.\n",
    "<body><h1>A &amp; B</h1><p>x &lt; y &copy; &#233;</p></body>": "# A & B\n\nx < y © é\n",
    '<h2>No first level</h2><ul><li><a href="/u?a=1&amp;b=2">link</a></li><li>two</li></ul>': "## No first level\n\n- [link](/u?a=1&b=2)\n\n- two\n",
    '<blockquote><p>q<br>r</p></blockquote><hr><img src="i.png" alt="I">': "> q\\\nr\n\n***\n\n![I](i.png)\n",
    "<script>var t='</p>'</script>": "", None: None,
}


def test_every_page_has_its_whole_markdown(spark, tmp_path):
    rows = [(k, f"u{k}", h) for k, h in enumerate(PAGES)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted((r.page_id, r.digest, r.n_chars) for r in catalog.QUERIES["html_to_markdown"](spark, str(tmp_path)).collect())
    assert got == [
        (k, *((None, None) if m is None else (hashlib.md5(m.encode()).hexdigest(), len(m)))) for k,
        m in enumerate(PAGES.values())
    ]
