"""URL decisions by rules, carried over to aliases.

A URL is its host and path. Rules (verdict, host, path) fit a host with its subdomains, and paths that begin with
theirs; the longest fitting rule decides. URLs that redirect to one another, or name one another as
canonical, are aliases: connected components over these links. A URL that no rule
fits is blocked if one of its aliases is blocked by a rule, else allowed. A URL that a rule
allows stays allowed, whatever its aliases are.

Links are `<link rel=canonical href=...>` and `<meta http-equiv=refresh content="...url=...">` in a page's html, and
any further edges given. All is done by DataFrame functions. The rules are a short list that
becomes part of the plan; only URLs with links enter the components.

Defined results: a null url, or one without `://`, has an empty host and path, no link and no
rule, and is allowed; null html has no link; repeated pages are judged each by themselves; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from texelframe.llm.common import stored
from texelframe.llm.components import connected_components

TAGS = r"(?is)<(?:link|meta)\s[^>]*>"
CANONICAL = r"(?is)^<link\s.*\brel\s*=\s*[\"']?canonical\b"
REFRESH = r"(?is)^<meta\s.*\bhttp-equiv\s*=\s*[\"']?refresh\b"
HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
TARGET = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"

Rule = tuple[str, str, str]


def _lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    return _lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The deciding rule as host and path in one, and its verdict; null where none fits."""
    rule = verdict = F.lit(None).cast("string")
    # from the shortest on, so that the longest is asked first
    for said, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[1:])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def page_links(pages: DataFrame) -> DataFrame:
    """(host, path, to_host, to_path) of canonical links and redirects in the pages' html."""
    tags = pages.select(
        host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        F.explode(F.regexp_extract_all(F.col("html"), F.lit(TAGS), F.lit(0))).alias("tag"),
    ).filter("host <> ''")
    target = F.when(F.col("tag").rlike(CANONICAL), F.regexp_extract("tag", HREF, 1)).when(F.col("tag").rlike(REFRESH), F.regexp_extract("tag", TARGET, 1))
    found = tags.withColumn("to", F.trim(F.replace(target, F.lit("&amp;"), F.lit("&")))).filter("to <> ''")
    to = F.col("to")
    bare = F.regexp_extract(to, r"(?s)^([^?#]*)", 1)
    whole = to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://")
    rooted = to.startswith("//")
    to_host = F.when(whole, host_of(to)).when(rooted, host_of(F.concat(F.lit("http:"), to))).otherwise(F.col("host"))
    beside = F.concat(F.regexp_extract("path", r"(?s)^(.*/)?", 0), bare)
    to_path = (
        F.when(whole, path_of(to)).when(rooted, path_of(F.concat(F.lit("http:"), to))).when(to.startswith("/"), bare)
        .when(bare == "", F.col("path")).otherwise(F.when(beside.startswith("/"), beside).otherwise(F.concat(F.lit("/"), beside)))
    )
    return found.select("host", "path", to_host.alias("to_host"), to_path.alias("to_path")).filter("to_host <> ''")


def judge(pages: DataFrame, rules: list[Rule], edges: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page of (page_id, url, html). edges: more links, as page_links gives them."""
    links = page_links(pages)
    if edges is not None:
        links = links.union(edges.select("host", "path", "to_host", "to_path"))
    # a host holds no "/", so that host and path in one name a URL
    pairs = stored(links.select(F.concat("host", "path").alias("a"), F.concat("to_host", "to_path").alias("b")).filter("a <> b").distinct())
    parts = connected_components(pairs)
    roots = parts.select(F.col("component").alias("node"), "component").distinct()
    nodes = parts.union(roots)
    host, path = F.regexp_extract("node", r"(?s)^([^/]*)", 1), F.regexp_extract("node", r"(?s)^[^/]*(.*)", 1)
    nodes = nodes.withColumn("own", rule_of(host, path, rules)[1])
    blocked = nodes.filter("own = 'block'").select("component").distinct()
    aliases = nodes.filter("own is null").join(blocked, "component", "left_semi").select(F.col("node"), F.lit(True).alias("alias"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = judged.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("own"), F.concat("host", "path").alias("node"))
    judged = judged.join(aliases, "node", "left")
    said = F.when(F.col("own").isNotNull(), F.col("own")).when(F.col("alias"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", "rule", said.alias("verdict"))
