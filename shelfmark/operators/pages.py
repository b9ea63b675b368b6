"""Links of landed listing pages `(series, page, html)`."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.html import archive_hrefs, links_to_next, page_items, page_tags, projects_of
from shelfmark.operators.repos import one_per_key

MAX_PAGES = 100


def page_links(pages: DataFrame, series: str = "series_id") -> DataFrame:
    """Per page its project links and whether it has a link to the next page. The HTML is taken apart once."""
    staged = pages.select(series, "page", page_tags(F.col("html")).alias("_tags"))
    staged = staged.select(series, "page", page_items(F.col("_tags")).alias("_items"), links_to_next(F.col("_tags")).alias("has_next"))
    return staged.select(series, "page", projects_of(F.col("_items")).alias("links"), "has_next")


def _in_order(pages: DataFrame, series: str, limit: int) -> DataFrame:
    """Pages 1 to `limit`, each once, with `_last` (paging stops here) and `_reached` (paging gets here).

    Pages that follow on page 1 without a hole are those whose number is their place in the series.
    At most `limit` rows of a series meet: a page landed several times is cut to one before.
    """
    once = one_per_key(pages.where(F.col("page").between(1, limit)), [series, "page"])
    order = Window.partitionBy(series).orderBy("page")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    stops = once.withColumn("_last", ~F.col("has_next") | (F.size("links") == 0))
    on = ~F.coalesce(F.bool_or("_last").over(before), F.lit(False))
    return stops.withColumn("_reached", (F.col("page") == F.row_number().over(order)) & on)


def stop_paging(pages: DataFrame, series: str = "series_id", limit: int = MAX_PAGES) -> DataFrame:
    """Pages from the first on, up to one without projects or next link, or to a hole; at most `limit`.

    The stopping page itself is kept. A page that was not landed ends its series: what
    lies behind it is not known to belong to one listing.
    """
    return _in_order(pages, series, limit).where("_reached").drop("_last", "_reached")


def series_states(pages: DataFrame, series: str = "series_id", limit: int = MAX_PAGES) -> DataFrame:
    """`(series, status, pages, links, beyond)`: how far each series was read.

    `complete` ended by itself or at the limit, `incomplete` lacks the page its last one leads to,
    `missing` has no first page, `empty` ended without any project. `beyond` counts pages landed but not reached.
    Pages beyond the limit are not looked at, nor series that have no others.
    """
    reached = F.col("_reached")
    ends = (F.col("_last") | (F.col("page") == limit)) & reached
    found = _in_order(pages, series, limit).groupBy(series).agg(
        F.count_if(reached).alias("pages"),
        F.coalesce(F.sum(F.when(reached, F.size("links"))), F.lit(0)).cast("long").alias("links"),
        F.count_if(~reached).alias("beyond"),
        F.bool_or(ends).alias("_ended"),
    )
    status = (
        F.when(F.col("pages") == 0, "missing").when(~F.col("_ended"), "incomplete").when(F.col("links") == 0, "empty").otherwise("complete")
    )
    return found.select(series, status.alias("status"), "pages", "links", "beyond")


def link_rows(pages: DataFrame, series: str = "series_id") -> DataFrame:
    """One row per link.

    An inner explode would make Spark filter on the size of the array further
    down, which means reading the HTML twice; the outer one and a filter on its
    result do not.
    """
    exploded = pages.select(series, "page", F.posexplode_outer("links").alias("pos", "link"))
    return exploded.where(F.col("pos").isNotNull()).select(
        series, "page", "pos", "link.project_url", "link.score"
    )


def first_seen(links: DataFrame, series: str = "series_id") -> DataFrame:
    """Each URL of a series once, where it stands first.

    `row_number = 1` is cut per map task before the shuffle, so a URL on very
    many pages sends one row per task.
    """
    order = Window.partitionBy(series, "project_url").orderBy("page", "pos")
    return (
        links.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")
    )


def scraped(pages: DataFrame, series: str = "series_id", limit: int = MAX_PAGES) -> DataFrame:
    """The submission list of each series: `(series, project_url, score)`, each URL where it stands first.

    Both windows are dealt by series, so pages move once; `series_states` tells which lists are whole.
    """
    reached = stop_paging(page_links(pages, series), series, limit)
    return first_seen(link_rows(reached, series), series).select(series, "project_url", "score")


def archive_links(pages: DataFrame) -> DataFrame:
    """Links of home pages in their order, those of the archive section where there is one."""
    kept = [c for c in pages.columns if c != "html"]
    links = pages.select(*kept, F.posexplode_outer(archive_hrefs(F.col("html"))).alias("pos", "href"))
    return links.where(F.col("pos").isNotNull())
