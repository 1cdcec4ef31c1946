"""Parsed-name metadata: a JSON object whose fields change type from row to row.

``episode`` may be an integer, a list, text, a fraction or absent. JSON text
functions cannot tell 3 from "3", so the fields are read as VARIANT.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulse.rules import TITLE_CORRECTIONS


def _get(parsed: Column, path: str) -> Column:
    return F.try_variant_get(parsed, path, "variant")


def _kind(variant: Column) -> Column:
    return F.schema_of_variant(variant)


def _as(variant: Column, target: str) -> Column:
    return F.try_variant_get(variant, "$", target)


def _is_list(kind: Column) -> Column:
    return kind.startswith("ARRAY")


def _only_int(variant: Column) -> Column:
    return F.when(_kind(variant).isin("BIGINT", "BOOLEAN"), _as(variant, "bigint"))


def aggregation_episode(json: Column) -> Column:
    """Episode for counting: lists are batches (null); text that reads as an
    integer counts, a fraction is truncated."""

    value = _get(F.try_parse_json(json), "$.episode")
    kind, text = _kind(value), F.trim(_as(value, "string"))
    return (
        F.when(_is_list(kind) | kind.startswith("OBJECT"), F.lit(None).cast("bigint"))
        .when(kind == "STRING", F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint")))
        .otherwise(_as(value, "bigint"))
    )


def corrected_title(title: Column) -> Column:
    """Known misreadings, looked up lower-cased and trimmed."""
    key = F.lower(F.trim(title))
    result = title
    for wrong, right in TITLE_CORRECTIONS.items():
        result = F.when(key == wrong, F.lit(right)).otherwise(result)
    return result


def matching_fields(json: Column) -> Column:
    """title, season and episode for title matching: integers only, a list of
    episodes counts as its first. A title that is not text makes the whole
    record unusable."""

    parsed = F.try_parse_json(json)
    title, episode = _get(parsed, "$.title"), _get(parsed, "$.episode")
    first = F.when(_is_list(_kind(episode)), _get(parsed, "$.episode[0]")).otherwise(episode)
    usable = F.coalesce(_kind(title).isin("STRING", "VOID"), F.lit(True))
    text = F.when(_kind(title) == "STRING", _as(title, "string"))
    return F.struct(
        corrected_title(text).alias("title"),
        F.when(usable, _only_int(_get(parsed, "$.season"))).alias("season"),
        F.when(usable, _only_int(first)).alias("episode"),
    )


def report_fields(json: Column) -> Column:
    """Fields of an unmatched name: text as written, numbers only if integers."""
    parsed = F.try_parse_json(json)
    return F.struct(
        _as(_get(parsed, "$.title"), "string").alias("parsed_title"),
        _only_int(_get(parsed, "$.season")).alias("season"),
        _only_int(_get(parsed, "$.episode")).alias("episode"),
    )


def json_or_error(json: Column) -> Column:
    """Readable JSON as is, otherwise an object that keeps the raw text."""
    failed = F.to_json(
        F.struct(F.lit("invalid_json").alias("_parse_error"), json.alias("_raw"))
    )
    return (
        F.when(json.isNull(), F.lit("{}"))
        .when(F.try_parse_json(json).isNull(), failed)
        .otherwise(json)
    )
