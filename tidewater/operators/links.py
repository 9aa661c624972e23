"""Links of crawled pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import html, text, urls


def page_links(pages: DataFrame, url: str = "url", content: str = "html") -> DataFrame:
    """Distinct (source_url, parsed_url) of all pages.

    A page without links gives nothing; a link that cannot be resolved is left
    out. Repeats within a page go before the shuffle.
    """
    found = pages.select(
        F.col(url).alias("source_url"),
        F.explode(F.array_distinct(html.hrefs(F.col(content)))).alias("link"),
    )
    resolved = urls.resolve_links(found, "source_url", "link", "parsed_url")
    return resolved.select("source_url", "parsed_url").distinct()


def keyword_page_links(
    pages: DataFrame, keyword: str, heading: str = "h1", content: str = "html"
) -> DataFrame:
    """The links of every page that has a heading with ``keyword`` in it."""

    def has_keyword(title: Column) -> Column:
        return text.contains_ignore_case(title, keyword)

    titles = html.element_texts(F.col(content), heading)
    others = [c for c in pages.columns if c != content]
    return pages.where(F.exists(titles, has_keyword)).select(
        *others, F.explode(html.hrefs(F.col(content))).alias("link")
    )
