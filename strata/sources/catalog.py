"""Selection of downloadable resources and link discovery, re-aimed from HTTP
scraping onto tables: a resources table (title, url) and a pages table
(page id, url, html). Everything is native string/regex functions; HTML is
scanned with ``regexp_extract_all`` and anchors are exploded, so pages are
processed in parallel and whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.exprs import ends_with_suffix, extract_year, resolve_relative_url

# anchor with a double-quoted href and plain text content
ANCHOR_PATTERN = r'<a\s[^>]*href="([^"]*)"[^>]*>([^<]*)</a>'


def select_resources(
    resources: DataFrame,
    years: Sequence[int] = (),
    download_all: bool = False,
    title_col: str = "resource_title",
    url_col: str = "resource_url",
    suffix: str = ".csv",
) -> DataFrame:
    """Resources whose url ends with ``suffix`` and (unless ``download_all``) whose
    title's first stand-alone ``20xx`` year is in ``years``; adds ``year``."""
    out = resources.filter(ends_with_suffix(url_col, suffix)).withColumn("year", extract_year(title_col))
    if not download_all:
        out = out.filter(F.col("year").isin([int(y) for y in years]))
    return out


def available_titles(resources: DataFrame, title_col: str = "resource_title") -> DataFrame:
    """What is on offer (reported when the selection comes back empty)."""
    return resources.select(title_col).distinct()


def page_anchors(pages: DataFrame, html_col: str = "html", url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """One row per anchor: (page id, href, resolved url, anchor text trimmed)."""
    html = F.col(html_col)
    pairs = F.arrays_zip(
        F.regexp_extract_all(html, F.lit(ANCHOR_PATTERN), 1).alias("href"),
        F.regexp_extract_all(html, F.lit(ANCHOR_PATTERN), 2).alias("text"),
    )
    exploded = pages.select(id_col, url_col, F.explode(pairs).alias("a"))
    return exploded.select(
        id_col,
        F.col("a.href").alias("href"),
        resolve_relative_url(F.col("a.href"), F.col(url_col)).alias("resolved_url"),
        F.trim(F.col("a.text")).alias("anchor_text"),
    )


def discover_links(pages: DataFrame, keyword: str, years: Sequence[int] = (), **cols: str) -> DataFrame:
    """Anchors whose upper-cased text contains ``keyword`` (and, if ``years`` is
    given, one of the years as text)."""
    anchors = page_anchors(pages, **cols)
    text = F.upper(F.col("anchor_text"))
    cond = text.contains(keyword.upper())
    if years:
        cond = cond & F.exists(F.array(*[F.lit(str(y)) for y in years]), lambda y: text.contains(y))
    return anchors.filter(cond)


def first_matching_link(pages: DataFrame, pattern: str, html_col: str = "html", url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """Per page, the first anchor href matching ``pattern`` (pages without one are dropped)."""
    hrefs = F.regexp_extract_all(F.col(html_col), F.lit(ANCHOR_PATTERN), 1)
    first = F.try_element_at(F.filter(hrefs, lambda h: h.rlike(pattern)), F.lit(1))
    out = pages.select(id_col, url_col, first.alias("href")).filter(F.col("href").isNotNull())
    return out.select(id_col, "href", resolve_relative_url(F.col("href"), F.col(url_col)).alias("resolved_url"))
