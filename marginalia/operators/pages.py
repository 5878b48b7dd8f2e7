"""Operators on the pages of a dump."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions.links import page_links
from marginalia.functions.wikitext import clean_text

ARTICLE_NAMESPACE = 0


def articles(dump: DataFrame) -> DataFrame:
    """``(title, text)`` of the pages in the article namespace that have a text."""
    is_article = (F.col("ns") == ARTICLE_NAMESPACE) & F.col("text").isNotNull()
    return dump.filter(is_article).select("title", "text")


def with_links_and_clean_text(raw: DataFrame, tag_mode: str = "default") -> DataFrame:
    """``(title, text, edges)``: links come from the raw text, then the text is cleaned."""
    return raw.select(
        "title",
        clean_text(F.col("text"), tag_mode).alias("text"),
        page_links(F.col("title"), F.col("text")).alias("edges"),
    )


def find_page(pages: DataFrame, title: str) -> DataFrame:
    """The page of that title, or no row. The comparison reaches the parquet scan."""
    return pages.filter(F.col("title") == F.lit(title)).select("title", "text", "edges").limit(1)


def find_pages(pages: DataFrame, titles: DataFrame) -> DataFrame:
    """The pages of all titles in ``titles(title)``."""
    return pages.join(titles.select("title"), "title", "left_semi")


def outlinks(edges: Column) -> Column:
    """Distinct targets of a page in alphabetical order."""
    return F.array_sort(F.array_distinct(F.transform(edges, lambda e: e["dst"])))


def link_edges(pages: DataFrame) -> DataFrame:
    """``(src, dst)`` per link."""
    return pages.select(F.inline("edges"))


def page_count(pages: DataFrame) -> DataFrame:
    return pages.agg(F.count("*").alias("pages"))
