"""Boilerplate lines of a site.

A line is boilerplate of its site when the share of the site's pages that hold it exceeds a ratio.
A site can have at most (lines a page) / ratio such lines on average, however many pages it has, so
they travel as one small array of hashes per site and pages are filtered without being taken apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import materialized
from shelfline.plans.lookup import lookup_join

RATIO = 0.1
LEAST_PAGES = 3


def _hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def boilerplate(pages: DataFrame, site: str, text: str, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``site, lines``: hashes of each site's boilerplate lines. A line counts once a page, without
    the spaces around it; blank lines and rows without site or text do not take part."""
    rows = pages.select(F.col(site).alias("site"), F.col(text).alias("text")).where("site is not null and text is not null")
    totals = rows.groupBy("site").agg(F.count(F.lit(1)).alias("pages"))
    full = F.filter(_lines(F.col("text")), lambda line: F.trim(line) != "")
    seen = rows.select("site", F.explode(F.array_distinct(F.transform(full, _hash))).alias("line"))
    held = seen.groupBy("site", "line").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") >= least_pages)
    often = lookup_join(held, totals, "site", "inner").where(F.col("held") > ratio * F.col("pages"))
    return often.groupBy("site").agg(F.collect_list("line").alias("lines"))


def drop_site_lines(
    pages: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES, counted: str = "_dropped"
) -> DataFrame:
    """``pages`` with the boilerplate lines taken out of ``text``, and ``counted``, how many.

    A line goes when it is on more than ``ratio`` of its site's pages and on ``least_pages`` at
    least, so that a page and its copy lose nothing. Rows stay, with an empty text if need be;
    null texts stay null, rows without a site stay as they are, repeated rows count as pages of
    their own, and other columns are kept whatever they are called (``counted`` is to be a new name).
    """
    # Written first: a table of known size, so that Catalyst need not shuffle the pages to learn it.
    found = materialized(boilerplate(pages, site, text, ratio, least_pages), "boilerplate")
    marked = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), F.col(site).alias("site"))
    found = lookup_join(marked, found, "site")
    whole = F.col(f"row.`{text}`")
    kept = F.filter(_lines(whole), lambda line: ~F.array_contains(F.col("lines"), _hash(line)))
    cleaned = F.when(F.col("lines").isNull(), whole).otherwise(F.array_join(kept, "\n"))
    dropped = F.when(F.col("lines").isNull() | whole.isNull(), 0).otherwise(F.size(_lines(whole)) - F.size(kept))
    columns = [(cleaned if c == text else F.col(f"row.`{c}`")).alias(c) for c in pages.columns]
    return found.select(*columns, dropped.cast("int").alias(counted))
