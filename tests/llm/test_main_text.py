"""Main text of pages: the line-block distribution, markup, and odd tables."""

import html
import re

import pytest
from pyspark.sql import functions as F

from loanloom.llm import main_text as M
from loanloom.llm.queries import QUERIES

LONG = "A paragraph of running text, long enough to be one, with commas and all."


@pytest.mark.parametrize(
    "source, want",
    [
        (None, ""),
        ("", ""),
        ("<!-- only a comment", ""),
        ("<script>var a = '</p>';", ""),
        ("no markup &lt;at&gt; all\n here", "no markup <at> all here"),
        ("<p>5 < 6 &amp; 7 &gt; 3</p>", "5 < 6 & 7 > 3"),
        ("<p>a<br>b<script>x()</script>c <b>d</b>e</p>", "a bc de"),
        (f"<div class=ad>Buy<article><h1>Be</h1><p>So.</p></article><div id=comments><p>{LONG}</p></div>", "Be\nSo."),
        (f"<body class='has-sidebar'><header><h1>Site</h1></header><main><header><h1>Title</h1></header><p>{LONG}</p>"
         f"<aside><p>{LONG}</p></aside><form>{LONG}</form><p>x</p></main></body>", f"Title\n{LONG}\nx"),
        (f"<div class='post-wrapper nav'><article>{LONG}</article></div>", LONG),
        (f"<nav><ul><li>menu</ul><article><p>{LONG}<p>Two", f"{LONG}\nTwo"),
        (f"<p hidden>{LONG}</p><p style='display: none'>{LONG}</p><p>{LONG}</p>", LONG),
        (f"<div role=navigation>{LONG}</div><p title='a > b'>{LONG}</p>", LONG),
        (f"<article><p>{LONG}</p></article><section id='comments'><article class='comment'>{LONG}</article></section>", LONG),
    ],
)
def test_pages(source, want):
    assert M.main_text(source) == want


def test_distribution_without_any_hint():
    links = "".join(f"<div><a href=/{k}>Menu entry number {k} of this site</a></div>" for k in range(4))
    page = f"<div>Home</div>{links}<h2>On it</h2><p>{LONG}</p><p>Short.</p><p>{LONG} {LONG}</p>{links}<div>Copyright 2020</div>"
    assert M.main_text(page) == f"On it\n{LONG}\nShort.\n{LONG} {LONG}"


def test_runs_against_plain_sums():
    import random

    rng = random.Random(3)
    for _ in range(300):
        weight = [rng.choice([0, 0, 0, 5, 40, 200]) for _ in range(rng.randrange(0, 20))]
        sums = [sum(weight[i : i + 3]) for i in range(len(weight))]
        least = min(86, 0.25 * max(sums, default=0))
        want = []
        for a in range(len(weight)):
            for b in range(a + 1, len(weight) + 1):
                # between a and b no sum is empty, and both ends are lines that count
                whole = all(sums[i] for i in range(a, b)) and weight[a] and weight[b - 1]
                left = not any(weight[i] for i in range(max(0, a - 3), a)) or a == 0
                right = all(not w for w in weight[b : b + 3])
                if whole and left and right and max(sums[a:b]) >= least:
                    want.append((a, b))
        assert M.runs(weight) == want, weight


def test_long_pages_stay_linear():
    assert M.main_text("<div>" * 200_000 + "</section>" * 200_000 + LONG).endswith(LONG)
    assert len(M.main_text("<p>" + "word " * 2_000_000)) == 5 * 2_000_000 - 1
    assert M.main_text("<a '" * 300_000 + LONG) is not None


def test_columns_repeats_and_empty_tables(spark):
    rows = [(1, "u", f"<p>{LONG}</p>", "x"), (1, "u", f"<p>{LONG}</p>", "x"), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = M.extract(pages, ["page_id", "text"], prefix="own_")
    assert sorted(map(tuple, found.collect()), key=str) == [(1, "x", LONG, len(LONG))] * 2 + [(None, None, "", 0)]
    assert M.extract(pages.filter("false"), ["page_id", "url"]).count() == 0


def test_sample_pages_give_their_articles(spark, sf_dir):
    found = {r.page_id: r for r in QUERIES["op11_main_text"](spark, sf_dir).collect()}
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    assert len(found) == pages.count() > 0
    for row in pages.select("page_id", F.col("html")).collect():
        body = re.search(r"<article>(.*)</article>", row.html, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert found[row.page_id].text == "\n".join(b for b in blocks if b)
        assert found[row.page_id].n_chars == len(found[row.page_id].text)
