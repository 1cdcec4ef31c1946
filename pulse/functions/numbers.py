"""Rounding rules, size texts and display numbers."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F


# Feed sizes, where KB and KiB are both 1024 bytes.
FEED_UNITS = {
    "B": 1,
    "KB": 1024, "KIB": 1024,
    "MB": 1024**2, "MIB": 1024**2,
    "GB": 1024**3, "GIB": 1024**3,
    "TB": 1024**4, "TIB": 1024**4,
}
# Listing sizes, where KB is decimal and KiB binary.
LISTING_UNITS = {
    "TiB": 1024**4, "GiB": 1024**3, "MiB": 1024**2, "KiB": 1024,
    "TB": 1000**4, "GB": 1000**3, "MB": 1000**2, "KB": 1000,
    "B": 1,
}
# Survey weights, best answer first.
SURVEY_WEIGHTS = (5, 4, 3, 2, 1)


def round_binary(value: Column, places: int) -> Column:
    """Round half to even on the exact binary value, as Python's ``round``.

    ``format_number`` rounds that way except below one unit of the last place.
    """
    unit = Fraction(1, 10**places)
    half = float(unit / 2)
    magnitude = F.abs(value)
    up = magnitude >= half if Fraction(half) > unit / 2 else magnitude > half
    tiny = F.when(up, F.lit(float(unit))).otherwise(F.lit(0.0)) * F.signum(value)
    text = F.regexp_replace(F.format_number(value, places), ",", "")
    return F.when(magnitude < float(unit), tiny).otherwise(text.cast("double"))


def round_half_up(value: Column) -> Column:
    """Browser rounding: halves go towards +infinity."""
    return F.floor(value + 0.5).cast("bigint")


def compact(number: Column) -> Column:
    """1234567 to ``1.2M``, 12345 to ``12K``, smaller numbers unchanged."""
    tenths = F.floor((number + 50_000) / 100_000)
    millions = F.concat(
        F.floor(tenths / 10).cast("string"), F.lit("."), F.pmod(tenths, F.lit(10)).cast("string"), F.lit("M")
    )
    thousands = F.concat(F.floor((number + 500) / 1000).cast("string"), F.lit("K"))
    return (
        F.when(number >= 1_000_000, millions)
        .when(number >= 1_000, thousands)
        .otherwise(number.cast("string"))
    )


def _factor(unit: Column, units: dict[str, int]) -> Column:
    """Bytes per unit; null for a unit not listed."""
    table = F.create_map(*[F.lit(x) for name, size in units.items() for x in (name, size)])
    return F.try_element_at(table, unit).cast("bigint")


def feed_size(text: Column) -> Column:
    """Two tokens, number and unit in any case; anything else is 0 bytes."""
    tokens = r"^\s*(\S+)\s+(\S+)\s*$"
    number, unit = (F.regexp_extract(text, tokens, i) for i in (1, 2))
    return F.coalesce((number.try_cast("double") * _factor(F.upper(unit), FEED_UNITS)).cast("bigint"), F.lit(0))


def listing_size(text: Column) -> Column:
    """Number then unit, case-sensitive; null when it cannot be read."""
    pattern = r"^\s*([-+0-9.eE_]+)\s*(TiB|GiB|MiB|KiB|TB|GB|MB|KB|B)\s*$"
    number = F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(0)).try_cast("double")
    return (number * _factor(F.regexp_extract(text, pattern, 2), LISTING_UNITS)).cast("bigint")


def weighted_mean(parts: list[Column]) -> Column:
    """Survey mean on a 1-5 scale, 5 best; null when nothing was answered."""
    zero = F.lit(0.0)
    total, weighted = zero, zero
    for weight, part in zip(SURVEY_WEIGHTS, parts, strict=True):
        total = total + F.coalesce(part, zero)
        weighted = weighted + weight * F.coalesce(part, zero)
    return F.when(total > 0, round_binary(weighted / total, 3))
