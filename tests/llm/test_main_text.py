import html
import re

import numpy as np
import pytest

from plantpulse.llm.main_text import blocks, examples, extracted, grow, main_texts, trained
from plantpulse.llm.queries import queries

from .helpers import FOLDER, table


@pytest.fixture(scope="module")
def tree(spark):
    return trained(examples(spark))


def article(page):
    """Main text of the given pages, whose article is marked."""
    inner = re.search("<article>(.*?)</article>", page or "", re.S)
    lines = re.split(r"</?(?:p|h1|div|li|ul)[^>]*>", inner[1]) if inner else []
    lines = [" ".join(html.unescape(re.sub("<[^>]+>", lambda m: " " if m[0] == "<br>" else "", x)).split()) for x in lines]
    return "\n".join(x for x in lines if x)


def test_query(spark):
    want = {p["page_id"]: article(p["html"]) for p in table("pages")}
    got = queries()["op6_main_text"](spark, FOLDER).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_held_out_pages(spark, tree):
    rows = examples(spark, 200, seed=77).collect()
    got = main_texts([r.html for r in rows], tree)
    assert sum(g == r.text for g, r in zip(got, rows)) >= 0.97 * len(rows)


def test_blocks_and_references():
    page = """<head><title>t</title></head><body><p>a&amp;b &lt;i&gt; c&nbsp;d<br>e <a href="x>y">li nk</a>
      <p>second<script>var t="</p>";</script><!-- <p>no</p> --><div>x<b>y</b> z</div><button>press</button>&#65;"""
    assert [(b.text, b.words, b.linked) for b in blocks(page)] == [
        ("a&b <i> c d e li nk", 7, 2), ("second", 1, 0), ("xy z", 2, 0), ("A", 1, 0)]


def test_unusual_pages(tree):
    pages = ["", "no markup at all", "<article><p>unclosed <b>words", "<script>never closed <p>x", "<!-- open <p>x", "<", "<p", "</article></p>"]
    assert main_texts(pages, tree)[2] == "unclosed words"
    assert main_texts(pages, tree)[0] == main_texts(pages, tree)[3] == ""
    for big in ("<" * 50_000, '<a "' * 20_000, "<p>" * 50_000, "<div>" * 20_000, "<article>" + "word " * 100_000):
        main_texts([big], tree)
    assert len(main_texts(["<article><p>" + "word " * 100_000], tree)[0]) == 499_999


def test_splits():
    rng = np.random.default_rng(1)
    rows = rng.random((500, 3))
    label = ((rows[:, 1] > 0.4) & (rows[:, 2] <= 0.7)).astype(float)
    assert ((grow(rows, label)(rows) >= 0.5) == label).mean() > 0.98


def test_awkward_rows(spark, tree):
    df = spark.createDataFrame([(1, "u", None, "own"), (1, "u", None, "own"), (None, None, "", "own")], "page_id long, url string, html string, text string")
    assert [r.text for r in extracted(df, tree).collect()] == ["", "", ""]
    assert extracted(df.limit(0), tree).count() == 0
