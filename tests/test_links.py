"""Link listing on hand-written pages."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from loanlife.operators.links import page_links

PAGE = "https://host.example/dir/page.html?x=1#top"
ANCHORS = [  # markup, text, link (None: no link of this filter)
    ("<a href='a.zip'>the 1999 file</a>", "the 1999 file", "https://host.example/dir/a.zip"),
    ('<A CLASS="b>c" HREF = "/r/b.zip" >the <b>1999</b>\n  <i>file</i></A >', "the 1999 file", "https://host.example/r/b.zip"),
    ("<a data-href=\"/no\" href=c.zip>the 1999</a>", "the 1999", "https://host.example/dir/c.zip"),
    ("<a href='//cdn.example/d.zip'>the 1999</a>", "the 1999", "https://cdn.example/d.zip"),
    ("<a href='mailto:x@y.example'>the 1999 desk</a>", "the 1999 desk", "mailto:x@y.example"),
    ("<a href='https://other.example'>the 2001</a>", "the 2001", "https://other.example"),
    ("<a href='?q=2'>the 2000</a>", "the 2000", "https://host.example/dir/page.html?q=2"),
    ("<a href='#end'>the 2000</a>", "the 2000", "https://host.example/dir/page.html?x=1#end"),
    ("<a href=''>the 2000</a>", "the 2000", "https://host.example/dir/page.html?x=1"),
    ("<a data-href='/no'>the 1999</a>", None, None), ("<a name=x>the 1999</a>", None, None),
    ("<abbr href='/x'>the 1999</abbr>", None, None), ("<a href='/x'>a 1999 file</a>", None, None),
    ("<a href='/x'>the 1998</a>", None, None), ("<!-- nothing --><p>the 1999</p>", None, None),
]


def test_every_spelling(spark):
    pages = spark.createDataFrame([(1, PAGE, "<p>" + "</p>\n<p>".join(a for a, _, _ in ANCHORS)), (2, PAGE, None), (3, None, "")],
                                  "page_id bigint, url string, html string")
    got = page_links(pages, "the", 1999, 2001).collect()
    assert sorted((r["link_text"], r["link_url"]) for r in got) == sorted((t, u) for _, t, u in ANCHORS if u is not None)


def test_folders(spark):
    pages = spark.createDataFrame([(i, u, "<a href=x>the</a>") for i, u in enumerate(
        ["http://h", "http://h/", "http://h/d", "http://h/d/", "http://h/d/e?f=/g/#/i", "http://h?q=/a"])],
        "page_id bigint, url string, html string")
    got = {r["page_id"]: r["link_url"] for r in page_links(pages, "the").collect()}
    assert got == {0: "http://h/x", 1: "http://h/x", 2: "http://h/x", 3: "http://h/d/x", 4: "http://h/d/x", 5: "http://h/x"}


def test_unclosed_anchors_end_at_the_next(spark):
    html = "<a href=1>the one <a href=2>the <i>two</i></a> the <a href=3>the three<!-- <b> --><p>"
    got = page_links(spark.createDataFrame([(1, "http://h/", html)], "page_id int, url string, html string"), "the").collect()
    assert [(r["href"], r["link_text"]) for r in got] == [("1", "the one"), ("2", "the two"), ("3", "the three")]


def test_quoted_signs_stay_in_their_value(spark):
    html = """<a title="<a href='/no'>the</a>" href="/x?a='>b">the link</a><a href='"/y"'>the other</a><a href="/z>the rest</a>"""
    got = page_links(spark.createDataFrame([(1, "http://h/", html)], "page_id int, url string, html string"), "the").collect()
    assert [(r["href"], r["link_text"]) for r in got] == [("/x?a='>b", "the link"), ('"/y"', "the other")]


MB = 1 << 20
LARGE = {"value without quotes": "<a x=" + "v" * MB + " href=/x>the link</a>", "quoted value": "<a x='" + "v" * MB + "' href=/x>the link</a>",
         "unclosed anchors": "<a href=/x>the link " * 10_000, "unclosed tags": "<a href=/y " * 90_000 + "<a href=/x>the link</a>",
         "open quotes": "<a \"" * 100_000 + "\">", "open comments": "<a href=/x>the link" + "<!--" * 100_000 + "</a>",
         "many signs": "<a href=/x>the link" + "< " * 100_000 + "</a>", "white space": "<a" + " " * MB + "href=/x>the link</a>"}


def test_a_megabyte_of_anything_takes_no_time(spark):
    pages = spark.createDataFrame(list(enumerate(LARGE.values())), "page_id int, html string").withColumn("url", F.lit("http://h/"))
    t0 = time.perf_counter()
    got = [r[0] for r in page_links(pages, "the link").select("page_id").collect()]
    assert time.perf_counter() - t0 < 60
    assert [got.count(i) for i in range(len(LARGE))] == [1, 1, 10_000, 1, 0, 1, 1, 1]
