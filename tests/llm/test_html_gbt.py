import html
import itertools
import random
import re

import numpy as np
import pytest

from loanlife.llm import html_gbt as H
from loanlife.llm.queries import op10_html

from .conftest import LONG


@pytest.fixture(scope="module")
def model(spark):
    return H.fit(H.labelled_pages(spark))


def test_unseen_drawn_pages(model):
    rng = random.Random(77)
    right = 0
    for page in (H.drawn_page(rng) for _ in range(150)):
        dom = H.Dom(page)
        keep = [True]
        for label, parent in zip(dom.labels[1:], dom.parents[1:], strict=True):
            keep.append(keep[parent] and label != "0")
        right += model.extract([re.sub(r' data-main="."', "", page)])[0] == H.kept_text(dom, keep)
    assert right >= 0.95 * 150


def test_given_pages_give_their_articles(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in op10_html(spark, sf).collect():
        article = pages[r["page_id"]].partition("<article>")[2].partition("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_decoding_equals_enumeration():
    rng = np.random.default_rng(4)
    for _ in range(60):
        parents = [-1] + [int(rng.integers(0, i)) for i in range(1, 8)]
        odds = rng.normal(0, 2, 8)
        best = max((k for k in itertools.product((True, False), repeat=8) if k[0] and all(
            k[parents[i]] or not k[i] for i in range(1, 8))),
            key=lambda k: sum(-np.logaddexp(0, -o if x else o) for x, o in zip(k, odds, strict=True)))
        assert H.decode(parents, odds) == list(best)


def test_boosting_learns_a_rule():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    assert ((H.boost(x, y, 30).log_odds(x) > 0) == (y > 0)).mean() > 0.97


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("just text", "just text"), ("<p>One &amp; two<br>three\n four", "One & two three four"),
    ("<p>a<script>var x='</p>';</script>b</p>", "ab"), ("<p>One<p>Two &eacute;&#33;", "One\nTwo é!"),
    ("<article><p>Cut in a ta", "Cut in a ta"),
    ("<p hidden>no</p><article><p>Some words of a text.</p></article>", "Some words of a text."),
    ("<article><h1>T</h1><p><b>X.<br><p>Y.</article><footer>f</footer>", "T\nX.\nY.")])
def test_markup(model, page, want):
    assert model.extract([page]) == [want]


@pytest.mark.parametrize("block,want", [
    ("Energy is <math><mi>E</mi></math> here, as they say.", "Energy is E here, as they say."),
    ("<noscript>Plain words</noscript> of a text, and more.", "Plain words of a text, and more."),
    ("Before it <svg/> and after it, in one line.", "Before it and after it, in one line."),
    ("A drawing <svg><title/><path d='M0'/><text>label</text></svg> stands, they say.", "A drawing label stands, they say."),
    ("A clip <video src=x>can not be shown</video>, sadly.", "A clip can not be shown, sadly."),
    ("An <object data=x>old <b>kind</b></object> of <canvas>thing</canvas>, really.", "An old kind of thing, really."),
    ("Some text<span class='ad-slot'>Buy it now</span> goes on, as before.", "Some text goes on, as before."),
    ("Some text<x-unit class='sponsored'>Buy it now</x-unit> goes on, as before.", "Some text goes on, as before."),
    ("Some text<span hidden>not for you</span> goes on, as before.", "Some text goes on, as before."),
    ("Some <span class='term'>text</span> goes <my-word>on</my-word>, as before.", "Some text goes on, as before.")])
def test_inline_and_foreign_elements(model, block, want):
    # Pages of another make than the drawn ones.
    pages = [f"<html><body><nav><a href=/>Home</a></nav><{tag}{attr}><h1>A headline</h1><p>First comes a sentence, then another one.</p>"
             f"<p>{block}</p><p>Last comes a sentence, and it ends here.</p></{tag}><footer>(c) us</footer></body></html>"
             for tag, attr in (("article", ""), ("main", ""), ("div", " class='post-content'"))]
    whole = f"A headline\nFirst comes a sentence, then another one.\n{want}\nLast comes a sentence, and it ends here."
    assert model.extract(pages) == [whole] * 3


def test_hostile_pages_end(model):
    for page in ("<" * 50000, "<div>" * 30000, "<b>" * 30000 + "<li>" * 3000, "<!--" * 20000, "<p>" + LONG, "</p>" * 30000, "&" * 50000, "<svg>" * 30000 + "<a/>" * 30000,
                 "<span hidden>" * 30000):
        model.extract([page])
    assert model.extract(["<article><p>" + LONG + "</p></article>"]) == [LONG.strip()]


def test_query_on_nulls_repeats_clashes_and_empty_tables(spark, model, as_tables):
    rows = [(1, "u", "<article><p>Some words here.</p></article>"), (1, "u", "<article><p>Some words here.</p></article>"),
            (2, None, None), (None, "v", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = sorted(map(tuple, op10_html(spark, as_tables(pages=pages)).collect()), key=str)
    assert got == sorted([(1, "u", "Some words here.", 16)] * 2 + [(2, None, "", 0), (None, "v", "", 0)], key=str)
    clash = pages.withColumnRenamed("url", "Text")
    assert H.extract(clash, model).columns == ["page_id", "Text", "html", "_text"]
    assert op10_html(spark, as_tables(pages=pages.limit(0))).collect() == []
