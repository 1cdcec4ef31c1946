"""Listing pages (one HTML text per row) to torrent rows.

Pages are split into table rows inside the executors with SQL regular
expressions; a page is a row of the input table, so the work grows with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.functions.numbers import listing_size
from pulse.functions.text import magnet_infohash, unescape_html, view_id
from pulse.sources.feed import ROW
from pulse.sources.filenames import with_metadata

_TABLE = (
    r"(?s)<table\b[^>]*\bclass\s*=\s*[\"'][^\"']*\btorrent-list\b[^\"']*[\"'][^>]*>"
    r".*?<tbody[^>]*>(.*?)</tbody>"
)
_ROW = r"(?s)(<tr\b[^>]*>.*?</tr>)"
_CELL = r"(?s)(<td\b[^>]*>.*?</td>)"
_LINK = r"(?s)(<a\b[^>]*>.*?</a>)"


def attribute(tag: Column, name: str) -> Column:
    """An attribute of the tag the text starts with; null when absent or empty."""
    pattern = rf"""(?s)^\s*<[^>]*?\s{name}\s*=\s*(["'])(.*?)\1"""
    return unescape_html(F.nullif(F.regexp_extract(tag, pattern, 2), F.lit("")))


def inner_text(html: Column) -> Column:
    return F.trim(unescape_html(F.regexp_replace(html, r"(?s)<[^>]*>", "")))


def _has_class(tag: Column, name: str) -> Column:
    return F.coalesce(attribute(tag, "class").rlike(rf"(^|\s){name}(\s|$)"), F.lit(False))


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(_LINK), F.lit(1))


def view_links(html: Column) -> Column:
    """Links to an item page, comment links left out."""

    def leads_to_item(link: Column) -> Column:
        item = attribute(link, "href").rlike(r"(?s)^(?!.*#comments).*/view/\d+")
        return F.coalesce(item, F.lit(False)) & ~_has_class(link, "comments")

    return F.filter(links(html), leads_to_item)


def _once(rows: DataFrame, *columns: Column | str) -> DataFrame:
    """The columns behind a generator, so that no filter or column read later matches their patterns again."""
    return rows.select(F.inline(F.array(F.struct(*columns))))


def listing_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """Rows with at least eight cells, a view link, a magnet link, a readable
    size, time and counters; others are dropped."""
    body = F.regexp_extract(F.col(html), _TABLE, 1)
    rows = _once(pages, F.regexp_extract_all(body, F.lit(_ROW), F.lit(1)).alias("_rows")).select(F.explode("_rows").alias("_row"))
    rows = _once(rows, "_row", F.regexp_extract_all("_row", F.lit(_CELL), F.lit(1)).alias("_cells"))
    cell = [F.get("_cells", F.lit(i)) for i in range(8)]
    picked = _once(
        rows.filter(F.size("_cells") >= 8),
        "_row",
        F.get(view_links(cell[1]), F.lit(0)).alias("_view"),
        F.get(
            F.filter(links(cell[2]), lambda a: F.contains(attribute(a, "href"), F.lit("magnet:"))),
            F.lit(0),
        ).alias("_magnet"),
        inner_text(cell[3]).alias("_size"),
        attribute(cell[4], "data-timestamp").try_cast("bigint").alias("_epoch"),
        *[inner_text(cell[5 + i]).try_cast("bigint").alias(c)
          for i, c in enumerate(("seeders", "leechers", "downloads"))],
    )
    named = picked.withColumn(
        "filename",
        F.coalesce(F.nullif(attribute(F.col("_view"), "title"), F.lit("")), inner_text(F.col("_view"))),
    )
    out = _once(
        named,
        magnet_infohash(attribute(F.col("_magnet"), "href")).alias("infohash"),
        "filename",
        F.timestamp_seconds("_epoch").alias("pubdate"),
        listing_size(F.col("_size")).alias("size_bytes"),
        view_id(attribute(F.col("_view"), "href")).alias("source_id"),
        _has_class(F.col("_row"), "success").alias("trusted"),
        _has_class(F.col("_row"), "danger").alias("remake"),
        "seeders", "leechers", "downloads",
    )
    kept = out.dropna(
        subset=["infohash", "source_id", "pubdate", "size_bytes", "seeders", "leechers", "downloads"]
    )
    return with_metadata(kept, "filename", "guessit_data").select(*ROW)
