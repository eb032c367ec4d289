"""Links and page numbers of saved pages, from their nodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapwatch.functions.text import first_of, normalize_space, to_int
from snapwatch.functions.urls import query_param, url_join
from snapwatch.operators.html_fields import Board, Field, Step, raw_records

# What the link patterns of the boards hold, and where their next-page links and page numbers are.
REGION_LINK = "/jobs/searchfilterHome.asp?type=ezor&l="
SUB_REGION_LINK = "/jobs/?l="
NEXT_PAGE = {
    "AllJobs": Field((Step("div", "class", equals="jobs-paging-next"), Step("a", "href", child=True)), "@href"),
    "JobMaster": Field((Step("a", "class", equals="paginationPrev"),), "@href"),
}
PAGE_LABELS = {"selected": "btnPaging Selected", "listed": "btnPaging "}

_HREFS = Field((Step("a", "href"),), "@href", only_first=False)


def _per_page(pages: DataFrame, **fields: Field) -> DataFrame:
    """(page_id, url and the fields) of every page, read from its root."""
    return raw_records(pages, Board(records=((),), fields=fields)).drop("pos")


def outlinks(pages: DataFrame, containing: str = "") -> DataFrame:
    """(page_id, position, href, target): links whose href holds ``containing``, in order, also made absolute."""
    found = F.filter("hrefs", lambda h: F.contains(h, F.lit(containing)))
    return _per_page(pages, hrefs=_HREFS).select("page_id", "url", F.posexplode(found).alias("position", "href")).select(
        "page_id", "position", "href", url_join(F.col("url"), F.col("href")).alias("target")
    )


def next_page_links(pages: DataFrame, site: str) -> DataFrame:
    """(page_id, href, target): the link to the following page, NULL on the last one."""
    found = _per_page(pages, href=NEXT_PAGE[site])
    return found.select("page_id", "href", F.when(F.col("href").isNotNull(), url_join(F.col("url"), F.col("href"))).alias("target"))


def region_links(pages: DataFrame) -> DataFrame:
    """(page_id, region, target): the region links of a start page, numbered in order."""
    return outlinks(pages, REGION_LINK).select("page_id", F.col("position").alias("region"), "target")


def sub_region_links(pages: DataFrame, region: str | Column = "region") -> DataFrame:
    """(page_id, location_id, target) of region pages with their ``region`` number: ``region_subregion`` in order."""
    numbers = pages.select(F.col("page_id").alias("_id"), (F.col(region) if isinstance(region, str) else region).alias("_region"))
    found = outlinks(pages, SUB_REGION_LINK).join(numbers, F.col("page_id") == F.col("_id"))
    return found.select("page_id", F.concat_ws("_", "_region", "position").alias("location_id"), "target")


def _labels(css_class: str) -> Field:
    return Field((Step("a", "class", equals=css_class),), only_first=False)


def page_numbers(pages: DataFrame) -> DataFrame:
    """(page_id, selected, listed, next_page) of pages with a pager.

    ``next_page`` is the selected page when the link asked for another one, else the following page
    if the pager lists it, else NULL.
    """
    raw = _per_page(pages, **{name: _labels(css_class) for name, css_class in PAGE_LABELS.items()})
    numbers = {name: F.transform(name, lambda x: to_int(normalize_space(x))) for name in PAGE_LABELS}
    listed = F.filter(numbers["listed"], lambda n: n.isNotNull())
    asked = query_param(F.col("url"), "p").try_cast("bigint")
    found = raw.select("page_id", asked.alias("asked"), first_of(numbers["selected"]).alias("selected"), listed.alias("listed"))
    following = F.col("selected") + 1
    next_page = F.when(F.col("asked") != F.col("selected"), F.col("selected")).when(
        F.array_contains("listed", following), following
    )
    return found.select("page_id", "selected", "listed", next_page.alias("next_page"))
