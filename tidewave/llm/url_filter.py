"""URL filters with redirect equivalence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewave.llm.common import LOWER, UPPER, stored
from tidewave.llm.graph import connected_components

#: (action, host, path prefix); a rule covers its host and every subdomain.
RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]

_CANONICAL = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
_REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
_BASE = r"(?is)<base\b[^>]*\bhref\b[^>]*>"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def address_of(url: Column) -> Column:
    """What two spellings of an address share: no scheme, no fragment, host in lower case. Null without a host."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*[^?#]*(\?[^#]*)?", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), path_of(url), query))


def _resolved(to: Column, base: Column, host: Column, path: Column) -> Column:
    """``to`` made absolute as seen from a url ``base`` with ``host`` and ``path`` (RFC 3986); null for '', a fragment or another scheme such as mailto."""
    own = F.regexp_extract(to, r"(?s)^([^?#]*)", 1)
    steps = F.split(F.regexp_replace(F.when(own.startswith("/"), own).otherwise(F.concat(F.regexp_replace(path, r"[^/]*$", ""), own)), "^/", ""), "/")
    kept = F.aggregate(
        steps, F.array().cast("array<string>"),
        lambda a, s: F.when(s == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).when(s == ".", a).otherwise(F.array_append(a, s)),
        lambda a: F.when(own.rlike(r"(^|/)\.{1,2}$"), F.array_append(a, F.lit(""))).otherwise(a),
    )
    rest = F.regexp_extract(to, r"(?s)^[^?#]*(.*)$", 1)
    return (
        F.when(base.isNull() | (to == "") | to.startswith("#"), F.lit(None))
        .when(to.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), to)
        .when(to.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(to.startswith("//"), F.concat(F.lit("http:"), to))
        .when(to.startswith("?"), F.concat(F.lit("http://"), host, path, to))
        .otherwise(F.concat(F.lit("http://"), host, F.lit("/"), F.array_join(kept, "/"), rest))
    )


def _link_rows(pages: DataFrame) -> DataFrame:
    """(source, target): a row for every canonical link and every refresh of a page, absolute and with &amp; decoded."""
    plain = lambda c: F.regexp_replace(c, "(?i)&(?:amp|#38|#x26);", "&")
    href = lambda tag: plain(F.regexp_extract(tag, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1))
    hop = lambda tag: plain(F.regexp_extract(tag, r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1))
    tags = lambda kind: F.regexp_extract_all("html", F.lit(kind), F.lit(0))
    parts = lambda c: {"host": host_of(F.col(c)), "path": path_of(F.col(c))}
    linked = (
        pages.select("url", F.concat(F.transform(tags(_CANONICAL), href), F.transform(tags(_REFRESH), hop)).alias("to"), href(F.regexp_extract("html", _BASE, 0)).alias("base"))
        .where(F.size("to") > 0).withColumns(parts("url"))
        .withColumn("base", F.coalesce(_resolved(F.col("base"), F.col("url"), F.col("host"), F.col("path")), "url"))
    )
    each = linked.select("url", "base", F.explode("to").alias("to")).withColumns(parts("base"))
    return each.select(F.col("url").alias("source"), _resolved(F.col("to"), F.col("base"), F.col("host"), F.col("path")).alias("target"))


def ruled(rows: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``rows`` (host, path, ...) with rule and action of the longest rule that fits, the first listed on a tie; null if none fits.

    Every host is parted into the names above it, and these meet the table of rules in a join, so that the list may be
    long; what fits a host then comes back to its rows, and the path decides. Rows without a host don't take part.
    """
    table = rows.sparkSession.createDataFrame([(h, (len(h + p), -k, p, h + p, a)) for k, (a, h, p) in enumerate(rules)], "name string, r struct<size:int,place:int,path:string,rule:string,action:string>")
    parts = F.split("host", r"\.")
    names = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))
    hosts = rows.where("host != ''").select("host").distinct().select("host", F.explode(names).alias("name")).join(table, "name").groupBy("host").agg(F.collect_list("r").alias("fits"))
    best = F.array_max(F.filter("fits", lambda r: F.startswith("path", r["path"])))
    return rows.join(hosts, "host", "left").withColumn("best", best).select(*rows.columns, F.col("best.rule").alias("rule"), F.col("best.action").alias("action"))


def url_verdicts(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """Judge every page by the longest rule that fits its url, else by what its aliases are judged.

    Aliases: addresses joined by every canonical link and every refresh in the html, and by rows of ``redirects`` (source, target
    urls). Their connected components pass decisions on: one explicit allow in a component lets its unruled pages
    pass; else one block blocks them; else they pass. Columns: page_id, host, path, rule, verdict, component
    (null for a page without aliases). Null or host-less urls have host and path '' and no aliases, and are
    allowed; null html has no links; repeated rows are each judged; other columns are ignored.
    """
    judged = ruled(
        pages.select("page_id", "url").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
        .select("page_id", "host", "path", F.when(F.col("host") != "", F.xxhash64(address_of(F.col("url")))).alias("node")), rules,
    )
    urls = _link_rows(pages)
    if redirects is not None:
        urls = urls.unionByName(redirects.select("source", "target"))
    ends = urls.select(address_of(F.col("source")).alias("x"), address_of(F.col("target")).alias("y")).where("x is not null and y is not null")
    ends = stored(ends, "links")  # the html is read once
    links = connected_components(ends.select(F.xxhash64("x").alias("a"), F.xxhash64("y").alias("b")))
    # A redirect target need not be a page: the rules judge the addresses themselves.
    named = ends.select(F.explode(F.array("x", "y")).alias("address")).distinct()
    full = F.concat(F.lit("://"), F.col("address"))
    told = ruled(named.select(F.xxhash64("address").alias("node"), host_of(full).alias("host"), path_of(full).alias("path")), rules).where("action is not null").select("node", "action")
    decided = (
        told.join(links, "node").groupBy("component")
        .agg(F.when(F.max((F.col("action") == "allow").cast("int")) == 1, "allow").otherwise("block").alias("passed"))
    )
    aliases = links.join(decided, "component", "left").select("node", "component", "passed")
    out = lambda rows, passed, component: rows.select(
        "page_id", "host", "path", "rule", F.coalesce("action", passed, F.lit("allow")).alias("verdict"), component.cast("long").alias("component"))
    return out(judged.where("node is not null").join(aliases, "node", "left"), F.col("passed"), F.col("component")).unionByName(
        out(judged.where("node is null"), F.lit(None), F.lit(None)))
