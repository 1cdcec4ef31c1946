"""URL filter with redirect equivalence.

A url is judged by the longest rule that fits its host (or a domain above it) and its path. A url
without a rule takes the decision of its aliases: pages are linked with the targets of
their canonical links and of their refreshes, distributed connected components over these
links are the aliases, and a component with an explicitly allowed member is allowed, else one
with a blocked member is blocked, else it is allowed. Targets count as members
whether or not they are in the table.

Everything is DataFrame operations. The html is read once for the two links and not moved. A null or empty
url, or one without ://, has an empty host and path, fits no rule, has no aliases and is allowed. Pages of
any length are searched whole. Repeated rows are judged alike; an empty table gives none. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm.common import components
from pulse.session import cut, literal_rows

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Of each kind of link: its tag, which ends at the first >, what marks it, and its address.
CANONICAL = (r"(?is)<link\b[^>]*+", r"""(?is)\brel\s*+=\s*+["']?canonical\b""", r"""(?is)\bhref\s*+=\s*+["']?([^"'\s>]+)""")
REFRESH = (r"(?is)<meta\b[^>]*+", r"""(?is)\bhttp-equiv\s*+=\s*+["']?refresh\b""", r"""(?is)\burl\s*+=\s*+["']?([^"'\s>]+)""")


def rules(spark: SparkSession, rows: Sequence[tuple[str, bool]]) -> DataFrame:
    """(rule, allow) such as ("example.net/en/", True) as a table of host, path, rule, allow."""
    return rule_table(literal_rows(spark, rows, "rule string, allow boolean"))


def rule_table(given: DataFrame) -> DataFrame:
    slash = F.instr("rule", "/")
    return given.where("rule IS NOT NULL").select(
        F.when(slash > 0, F.expr("substring(rule, 1, instr(rule, '/') - 1)")).otherwise(F.col("rule")).alias("rule_host"),
        F.when(slash > 0, F.expr("substring(rule, instr(rule, '/'))")).otherwise("").alias("rule_path"),
        "rule",
        "allow",
    )


def after_scheme(url: Column) -> Column:
    """What stands behind the first ://; null without one."""
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))


def split_url(rest: Column) -> tuple[Column, Column, Column]:
    """Host in lower case, path, and host with path and query as the key of the address."""
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, UPPER.lower())
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    key = F.concat(host, F.regexp_extract(rest, r"^[^/?#]*([^#]*)", 1))
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit("")), key


def judged(addresses: DataFrame, table: DataFrame) -> DataFrame:
    """Add `rule` and `allow` of the longest rule that fits (host, path); null without one.

    Rules meet the distinct hosts through the domains above them, so the large side is joined by
    equality with one row per host that has rules. Rules of equal length: allow goes first, then by text.
    """
    labels = F.split("host", r"\.")
    above = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    domains = addresses.select("host").where("host <> ''").distinct().select("host", F.explode(above).alias("rule_host"))
    order = F.struct((-F.length("rule")).alias("length"), (~F.col("allow")).alias("block"), "rule", "rule_path", "allow")
    # Written, so that the join below has nothing to sort or sum on this side and a hot host can be split.
    of_host = cut(domains.join(table, "rule_host").groupBy("host").agg(F.sort_array(F.collect_set(order)).alias("rules")))
    fits = F.filter("rules", lambda r: F.col("path").startswith(r["rule_path"]))
    found = F.get(fits, F.lit(0))
    return (
        addresses.join(of_host, "host", "left")
        .withColumn("rule", found["rule"])
        .withColumn("allow", found["allow"])
        .drop("rules")
    )


def address_of(html: Column, tag: str, mark: str, address: str) -> Column:
    """The address in the first such tag; empty without one. Tags are taken whole, so attributes may stand anywhere in them."""
    tags = F.regexp_extract_all(html, F.lit(tag), F.lit(0))
    first = F.get(F.filter(tags, lambda t: t.rlike(mark) & t.rlike(address)), F.lit(0))
    return F.coalesce(F.regexp_extract(first, address, 1), F.lit(""))


def alias_links(pages: DataFrame) -> DataFrame:
    """(a, b): the keys of a page and of where it points to."""
    target = F.when(F.col("target").contains("://"), after_scheme(F.col("target"))).when(
        F.col("target").startswith("//"), F.expr("substring(target, 3)")
    ).when(F.col("target").startswith("/"), F.concat("host", "target")).when(
        F.col("target").rlike(r"^[^:/?#]+:"), F.lit(None)
    ).when(F.col("target").rlike(r"^[?#]"), F.concat("host", "path", "target")).otherwise(
        F.concat("host", F.regexp_extract("path", r"^(.*/)?", 0), F.when(F.instr("path", "/") == 0, "/").otherwise(""), "target")
    )
    resolved = pages.select("host", "path", "key", F.explode("targets").alias("target")).where("target <> '' AND key <> ''")
    _, _, key = split_url(target)
    return resolved.select(F.col("key").alias("a"), key.alias("b")).where("b IS NOT NULL AND a <> b").distinct()


def filter_urls(
    pages: DataFrame, table: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row; `table` comes from `rules` or `rule_table`."""
    rest = after_scheme(F.col(url_col).cast("string"))
    host, path, key = split_url(rest)
    html = F.col(html_col).cast("string")
    targets = F.array(*[address_of(html, *kind) for kind in (CANONICAL, REFRESH)])
    parsed = cut(
        pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), key.alias("key"), targets.alias("targets"))
    )
    members = components(alias_links(parsed))
    own_host, own_path = F.regexp_extract("id", r"^[^/?]*", 0), F.regexp_extract("id", r"^[^/?]*([^?]*)", 1)
    nodes = judged(members.select("id", "component", own_host.alias("host"), own_path.alias("path")), table)
    decided = nodes.groupBy("component").agg(
        F.coalesce(F.bool_or("allow"), F.lit(False)).alias("any_allow"),
        F.coalesce(F.bool_or(~F.col("allow")), F.lit(False)).alias("any_block"),
    )
    blocked = decided.where("any_block AND NOT any_allow").select("component")
    # The aliases that inherit a block; the table's real size decides how it is joined.
    inherits = cut(members.join(blocked, "component").select(F.col("id").alias("key"), F.lit(True).alias("inherited")))
    rows = judged(parsed.drop("targets"), table).join(inherits, "key", "left")
    block = F.coalesce(~F.col("allow"), F.col("inherited"), F.lit(False))
    return rows.select("page_id", "host", "path", "rule", F.when(block, "block").otherwise("allow").alias("verdict"))
