"""Link listing over stored pages: anchors whose text carries a keyword (and,
optionally, a year in a range), with absolute URLs.

The whole ``pages`` table is filtered with built-in expressions in one pass, no
shuffle: anchors in any case, with nested markup and any quoting of ``href``.  A page is cut
once at its anchor tags; what stands between one and the next is an anchor's content (an
anchor that is not closed ends where the next begins, or with the page).  The patterns
take possessive runs only and never cross a "<" outside quotes, so that neither a value of a
megabyte nor thousands of unclosed tags cost more than time in proportion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# An attribute value may hold "<" and ">" only in quotes.
ATTRIBUTES = r"""((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)"""
OPENING = r"(?is)<a(?=[\s>])" + ATTRIBUTES + ">"
TAGS = OPENING + r"|</a\s*+>"
# One attribute with its value; then the one that is named href (neither data-href nor a word in another's value).
ATTRIBUTE = r"""[^\s=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"']++))?+"""
HREF = r"(?is)^href\s*+=\s*+(.+)$"
MARKUP = r"""(?s)<!--.*?(?:-->|\z)|<(?:[^<>"']++|"[^"]*+"|'[^']*+')*+>"""
SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:"
AUTHORITY = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)"


def year_pattern(year_from: int, year_to: int) -> str:
    return "(" + "|".join(str(y) for y in range(year_from, year_to + 1)) + ")"


def absolute_url(page_url: Column, href: Column) -> Column:
    """``href`` as seen from ``page_url``; links with a scheme of their own (mailto: too) stay as they are."""
    site = F.regexp_extract(page_url, AUTHORITY, 1)
    document = F.regexp_replace(page_url, r"#.*$", "")
    path = F.regexp_replace(document, r"\?.*$", "")
    folder = F.when(F.length(path) > F.length(site), F.regexp_replace(path, r"[^/]*$", "")).otherwise(
        F.concat(site, F.lit("/")))
    return (F.when(href.rlike(SCHEME), href)
            .when(href == "", document)
            .when(href.startswith("//"), F.concat(F.regexp_extract(page_url, SCHEME, 0), href))
            .when(href.startswith("/"), F.concat(site, href))
            .when(href.startswith("#"), F.concat(document, href))
            .when(href.startswith("?"), F.concat(path, href))
            .otherwise(F.concat(folder, href)))


def page_links(pages: DataFrame, keyword: str, year_from: int | None = None,
               year_to: int | None = None) -> DataFrame:
    """page_id, link_text, href, link_url of every anchor with a target whose text has
    ``keyword`` and, if given, a year of the range.  Text: markup removed,
    white space runs as one space."""
    # Tags and the texts after them, in step; the pattern starts with the case-blind anchor tag.
    cut = pages.select("page_id", "url", F.regexp_extract_all("html", F.lit(TAGS), F.lit(0)).alias("tags"),
                       F.split("html", TAGS, -1).alias("texts")).where(F.size("tags") > 0)
    told = F.arrays_zip("tags", F.slice("texts", F.lit(2), F.size("tags")).alias("inner"))
    anchors = cut.select("page_id", "url", F.explode(told).alias("a")).where(~F.startswith("a.tags", F.lit("</")))
    text = F.trim(F.regexp_replace(F.regexp_replace("a.inner", MARKUP, ""), r"\s+", " "))
    cond = F.col("link_text").contains(keyword)
    if year_from is not None and year_to is not None:
        cond = cond & F.col("link_text").rlike(year_pattern(year_from, year_to))
    named = F.filter(F.regexp_extract_all(F.regexp_extract("a.tags", OPENING, 1), F.lit(ATTRIBUTE), F.lit(0)), lambda x: x.rlike(HREF))
    value = F.regexp_extract(F.get(named, F.lit(0)), HREF, 1)
    bare = F.when(F.left(value, F.lit(1)).isin('"', "'"), F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)
    return (anchors.select("page_id", "url", text.alias("link_text"), "a").where(cond)
            .select("page_id", "url", "link_text", value.alias("value"), F.trim(bare).alias("href")).where("value != ''")
            .select("page_id", "link_text", "href",
                    absolute_url(F.col("url"), F.col("href")).alias("link_url")))
