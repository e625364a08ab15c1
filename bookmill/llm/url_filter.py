"""URL filters: rules for hosts and paths, then logistic regression on hashed character n-grams.

A URL's host is what follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; its
path goes on to `?`, `#` or the end. Null, or without `://`: both empty. Of the rules that fit
(the rule's host or a subdomain of it; the path starts with the rule's), the longest decides.
Other URLs are judged by a model of the 3- to 5-grams of host and path, fitted on the driver to a
small labelled table of URLs. Every row is judged; the model allows what is too short for an
n-gram, so rows without host and path too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ._hashing import U, mix, slices
from ._worker import arrow_map

BUCKETS = 1 << 16
GRAMS = (3, 4, 5)
#: Rules as (verdict, host and path).
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))

#: Words of unwanted and of wanted sites. Both stand in the same forms of host, with the same paths, so that only they tell.
_UNWANTED = """
casino poker roulette blackjack jackpot slots betting bookmaker lottery bingo gambling wager
viagra cialis pills steroids painkiller weightloss diet-pills miracle-cure cheap-meds no-prescription
porn xxx nude hardcore escort sexcams camgirls adult-video milf hookup sexdating fetish
payday-loan quick-loan bad-credit get-rich easy-money forex-signals binary-options crypto-doubler pump-coins ponzi
replica-watches fake-rolex counterfeit knockoff warez keygen cracked torrent serial-key nulled
spam linkfarm backlinks seo-links doorway clickbait popunder adserver adtracker clickfraud malware phishing
verify-account prize-winner free-iphone claim-gift survey-reward lucky-draw cheap-deals cheap-pills hot-offers traffic-bot
"""
_WANTED = """
news journal gazette weather traffic-news radio television magazine editorial newspaper library archive
university college school campus faculty academy kindergarten research science physics chemistry biology
mathematics history geography philosophy literature poetry museum gallery theatre orchestra cinema opera
hospital clinic dentist nursing health medicine insurance court parliament ministry council police fire-brigade
garden farm forest river mountain island harbour village city tourism hotel camping
bakery restaurant recipes cooking kitchen market grocery furniture clothing shoes books toys bicycle
software developer docs manual tutorial forum community wiki encyclopedia dictionary database hosting
bank savings tax accounting engineering architecture plumbing carpentry railway airport shipping logistics
football tennis swimming athletics chess music dance choir painting photography knitting birds
"""
_FORMS = ("{0}.test", "www.{0}.test", "{0}-{1}.example", "blog.{1}{0}.test", "my{0}online.example", "the-{0}-site.test", "{0}24.invalid")
_PATHS = (
    "", "/", "/index.html", "/about", "/contact", "/2019/07/first-post", "/category/page/2", "/item.php", "/a/b/c",
    "/welcome.htm", "/search"
)


def labelled_urls() -> list[tuple[str, int]]:
    """The built-in labelled table: (url, 1 to block). Every word in every form, beside the next word of its kind."""
    out = []
    for words, label in ((_UNWANTED.split(), 1), (_WANTED.split(), 0)):
        for k, word in enumerate(words):
            beside = words[(k + 1) % len(words)]
            out += [(f"http://{form.format(word, beside)}{_PATHS[(k + 3 * j) % len(_PATHS)]}", label) for j, form in enumerate(_FORMS)]
    return out


_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _UPPER.lower())


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _split(url: str) -> tuple[str, str]:
    m = re.match(_PARTS, url)
    return (m[1].translate(str.maketrans(_UPPER, _UPPER.lower())), m[2]) if m else ("", "")


def rule_that_fits(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(slash + rest))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


#: A digit counts as any other.
_DIGITS = np.arange(256, dtype=np.uint64)
_DIGITS[48:58] = 48


def grams(urls: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of each text, and their number by text. Host and path are joined by a space."""
    buf = _DIGITS[np.frombuffer(b"\n".join(urls) + b"\n", np.uint8)]
    end = np.cumsum(np.fromiter((len(u) + 1 for u in urls), np.int64, len(urls)))
    text = np.repeat(np.arange(len(urls)), np.diff(end, prepend=0))
    last = end[text] - 1
    out, of = [], []
    for n in GRAMS:
        h = np.full(max(len(buf) - n + 1, 0), n, np.uint64)
        for j in range(n):
            h = mix(h + buf[j : len(buf) - n + 1 + j] * U(0x9E3779B97F4A7C15))
        whole = np.arange(len(h)) + n <= last[: len(h)]
        out.append((h[whole] >> U(48)).astype(np.int64))
        of.append(text[: len(h)][whole])
    gram, of = np.concatenate(out), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return gram[order], np.bincount(of, minlength=len(urls))


def _log_odds(w: np.ndarray, b: float, urls: list[bytes]) -> np.ndarray:
    gram, n = grams(urls)
    odds, some = np.full(len(urls), -30.0), n > 0  # nothing to go by: allow
    if some.any():
        sums = np.add.reduceat(w[gram].astype(np.float64), (np.cumsum(n) - n)[some])  # the same for equal texts, wherever they stand
        odds[some] = sums / np.sqrt(n[some]) + b
    return odds


def train(table: Sequence[tuple[str, int]], *, steps: int = 400, rate: float = 1.0, decay: float = 1e-2) -> tuple[np.ndarray, float]:
    """Weights and bias of the logistic regression of a small table, by gradient descent from zero."""
    urls = [" ".join(_split(u)).encode() for u, _ in table]
    y = np.array([k for _, k in table], float)
    gram, n = grams(urls)
    of, scale = np.repeat(np.arange(len(urls)), n), 1 / np.sqrt(np.maximum(n, 1))
    w, b = np.zeros(BUCKETS), 0.0
    for _ in range(steps):
        z = np.bincount(of, w[gram], len(urls)) * scale + b
        err = (1 / (1 + np.exp(-z)) - y) / len(y)
        w -= rate * 10 * (np.bincount(gram, (err * scale)[of], BUCKETS) + decay / len(y) * w)
        b -= rate * err.sum()
    return w, b


def judge(
    pages: DataFrame, *, url: str = "url", keep: Sequence[str] = ("page_id",), rules: Sequence[tuple[str, str]] = RULES,
    table: Sequence[tuple[str, int]] | None = None, threshold: float = 0.5
) -> DataFrame:
    """The columns `keep` with host, path, rule, verdict and the model's probability of block."""
    w, b = train(labelled_urls() if table is None else table)
    model = pages.sparkSession.sparkContext.broadcast((w.astype(np.float32), b))
    rows = pages.select(*keep, host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    rows = rows.withColumn("_rule", rule_that_fits(rules, F.col("host"), F.col("path")))
    rows = rows.select(
        *keep, "host", "path", F.col("_rule.rule").alias("rule"), F.col("_rule.verdict").alias("verdict"),
        F.concat_ws(" ", "host", "path").cast("binary").alias("_t")
    )
    cut = float(np.log(threshold / (1 - threshold)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = model.value
        for batch in batches:
            k = batch.num_columns - 1
            texts = batch.column(k).to_pylist()
            for i, j in slices(texts, 1 << 18):
                odds = _log_odds(weights, bias, texts[i:j])
                said = [
                    v or ("block" if o > cut else "allow") for v,
                    o in zip(batch.column(k - 1).slice(i, j - i).to_pylist(), odds, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(i, j - i) for c in range(k - 1)), pa.array(said, pa.string()),
                        pa.array(1 / (1 + np.exp(-odds)))
                    ],
                    names=[*batch.schema.names[: k - 1], "verdict", "p_block"]
                )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-2])
    return rows.transform(arrow_map, run, f"{kinds}, verdict string, p_block double")
