"""Title normalisation, identifiers and display text, all built from SQL functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulse.functions.numbers import round_half_up

_SPACE = r"(?U)[\s\x1c-\x1f]"

# Season name to survey code letter.
SEASON_LETTERS = {"WINTER": "A", "SPRING": "B", "SUMMER": "C", "FALL": "D"}
# HTML escapes, ampersand first.
HTML_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#039;"))
# Common entities when reading HTML, ampersand last.
HTML_ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#039;", "'"), ("&#39;", "'"),
    ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"),
)


def normalize_title(title: Column) -> Column:
    """Lower-case Latin letters, digits and single spaces only."""
    kept = F.regexp_replace(F.lower(title), r"(?U)[^a-z0-9\s\x1c-\x1f]", "")
    return F.trim(F.regexp_replace(kept, _SPACE + "+", " "))


def is_informative(normalized: Column) -> Column:
    return (F.length(normalized) >= 3) & normalized.rlike("[a-z]")


def sort_tokens(normalized: Column) -> Column:
    return F.array_join(F.array_sort(F.split(normalized, " ")), " ")


def strip_symbols(folded: Column) -> Column:
    """Drop whitespace, punctuation and symbols; input is already width-folded."""
    return F.regexp_replace(F.lower(folded), r"(?U)[\p{P}\p{S}\p{Z}\s\x1c-\x1f]", "")


def title_before_dash(title: Column) -> Column:
    """What precedes the first ``" - "``; null without one."""
    return F.when(
        F.contains(title, F.lit(" - ")), F.trim(F.substring_index(title, " - ", 1))
    )


def search_score(query: str, *titles: Column) -> Column:
    """100 exact, 80 prefix, 50 substring, else 0; case-insensitive."""
    wanted = query.lower()
    if not query.strip():
        return F.lit(0)
    lowered = [F.lower(F.coalesce(t, F.lit(""))) for t in titles]

    def any_of(test):
        result = F.lit(False)
        for t in lowered:
            result = result | test(t)
        return result

    return (
        F.when(any_of(lambda t: t == wanted), 100)
        .when(any_of(lambda t: t.startswith(wanted)), 80)
        .when(any_of(lambda t: t.contains(wanted)), 50)
        .otherwise(0)
    )


def season_code(season: Column, year: Column) -> Column:
    """``2026B``; null for an unknown season."""
    letter = F.lit(None).cast("string")
    for name, code in SEASON_LETTERS.items():
        letter = F.when(F.upper(season) == name, code).otherwise(letter)
    return F.concat(year.cast("string"), letter)


def season_slug(name: Column) -> Column:
    return F.replace(F.lower(name), F.lit(" "), F.lit("-"))


def is_infohash(text: Column) -> Column:
    return text.rlike("^([0-9a-fA-F]{2})+$")


def view_id(href: Column) -> Column:
    return F.get(F.regexp_extract_all(href, F.lit(r"/view/(\d+)"), F.lit(1)), F.lit(0)).try_cast("bigint")


def last_path_number(url: Column) -> Column:
    """The last path segment of a URL when it is an integer, else null."""
    pattern = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/|/?)(?:[^?#]*/)?(\d+)(?:[?#].*)?$"
    return F.get(F.regexp_extract_all(url, F.lit(pattern), F.lit(1)), F.lit(0)).try_cast("bigint")


def magnet_infohash(magnet: Column) -> Column:
    topic = F.try_url_decode(F.regexp_extract(magnet, r"[?&]xt=([^&]*)", 1))
    return F.get(F.regexp_extract_all(topic, F.lit("^urn:btih:(.+)$"), F.lit(1)), F.lit(0))


def escape_html(text: Column) -> Column:
    for raw, escaped in HTML_ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return text


def unescape_html(text: Column) -> Column:
    for escaped, raw in HTML_ENTITIES:
        text = F.replace(text, F.lit(escaped), F.lit(raw))
    return text


def pad_left(text: Column, width: int) -> Column:
    """Pad with spaces; unlike ``lpad`` a longer text is left whole."""
    missing = F.greatest(F.lit(width) - F.length(text), F.lit(0))
    return F.concat(F.repeat(F.lit(" "), missing), text)


def _percent_text(downloads: Column, previous: Column) -> tuple[Column, Column]:
    percent = round_half_up((downloads - previous) / previous * 100)
    sign = F.when(percent >= 0, "+").otherwise("-")
    text = F.concat(sign, pad_left(F.abs(percent).cast("string"), 3), F.lit("%"))
    return percent, text


def ranking_line(
    rank: Column,
    rank_change: Column,
    downloads: Column,
    previous: Column,
    is_new: Column,
    is_oldest: Column,
    title: Column,
    html: bool = False,
) -> Column:
    """One ranking as fixed-width text, or with colour classes as HTML."""

    def mark(css: str, text: Column) -> Column:
        return F.concat(F.lit(f'<span class="{css}">'), text, F.lit("</span>")) if html else text

    def arrow(symbol: str) -> Column:
        return F.concat(F.lit(symbol), pad_left(F.abs(rank_change).cast("string"), 2))

    movement = (
        F.when(is_oldest, "   ")
        .when(is_new, mark("rank-new", F.lit("NEW")))
        .when(rank_change > 0, mark("rank-up", arrow("↑")))
        .when(rank_change < 0, mark("rank-down", arrow("↓")))
        .when(rank_change == 0, mark("rank-same", F.lit(" — ")))
        .otherwise("   ")
    )
    percent, percent_text = _percent_text(downloads, previous)
    coloured = (
        F.when(percent > 0, mark("dl-up", percent_text))
        .when(percent < 0, mark("dl-down", percent_text))
        .otherwise(mark("dl-same", percent_text))
    )
    change = F.when(~is_oldest & (previous > 0), coloured).otherwise(" " * (5 if html else 6))
    return F.concat(
        F.lit("#"), pad_left(rank.cast("string"), 2),
        F.lit(" ("), movement, F.lit(") "),
        pad_left(F.format_number(downloads, 0), 6),
        F.lit(" ("), change, F.lit(") "), title,
    )
