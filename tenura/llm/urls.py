"""URL rules whose decisions reach all aliases of a page (operator 2, DataFrame functions only).

A rule names a host, a path prefix and a verdict. It fits its host and all subdomains when the url's path starts with the
prefix; of several that fit, the longest (host and path together) holds. Redirects, canonical links, relative ones
resolved on the page's url, and forms that differ in scheme, fragment, tracking parameters or a last slash make two urls aliases; connected components over these
edges spread decisions to urls without a rule of their own. An own rule always holds. Without one, an allowed alias
takes precedence over blocked aliases, a blocked alias over none, and a url with neither is allowed.

Only distinct urls and edges move, never page bodies. Hosts are matched by an equality join on their suffixes (no more
labels than the longest rule has), so a large rule list needs no broadcast.

Edge cases: a null url, or one without ``://``, has an empty host and path, no rule, no alias and is allowed. Repeated rows
get equal results. Rules with a null part are ignored; of equal rules, allow holds. Other columns are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.components import components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Query parameters that do not change what a page shows.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "ref", "gclid", "fbclid", "sessionid")

# A tag ends before the next tag begins, so that a page of unclosed ones is read once.
_TAGS = r"(?is)<(?:link|meta)\b[^<>]*>"
_CANONICAL = r"""(?is)^<link\b.*\brel\s*=\s*(?:"[^"]*\bcanonical\b|'[^']*\bcanonical\b|canonical\b)"""
_HREF = r"""(?is)\bhref\s*=\s*(?:"([^"]*)|'([^']*)|([^\s"'>]+))"""
_REFRESH = r"""(?is)^<meta\b.*\bhttp-equiv\s*=\s*["']?refresh\b"""
_TARGET = r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def plain_form(url: Column) -> Column:
    """The url without fragment, tracking parameters and last slash, as https with a lower-case host."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_join(
        F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.split(p, "=")[0].isin(*TRACKING)), "&"
    )
    base = F.concat(F.lit("https://"), host_of(url), F.regexp_replace(path_of(url), "/+$", ""))
    web = F.translate(F.regexp_extract(url, r"(?s)^(.*?)://", 1), _UPPER, _LOWER).isin("http", "https")
    return F.when(web, F.concat(base, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit(""))))


def link_targets(html: Column) -> Column:
    """What all canonical links and refresh redirects of a page point to, entities of ``&`` resolved."""

    def target(tag: Column) -> Column:
        href = F.concat(*[F.regexp_extract(tag, _HREF, i) for i in (1, 2, 3)])
        return F.when(tag.rlike(_CANONICAL), href).when(tag.rlike(_REFRESH), F.regexp_extract(tag, _TARGET, 1))

    found = F.transform(F.regexp_extract_all(html, F.lit(_TAGS), F.lit(0)), target)
    return F.transform(found, lambda t: F.trim(F.regexp_replace(t, "(?i)&(?:amp|#38|#x26);", "&")))


def _without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` segments followed."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1).isin(".", "..")

    def step(done: Column, part: Column) -> Column:
        # The empty part before the first slash stays.
        up = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.concat(done, F.array(part)))

    kept = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array(F.lit("")), step)
    return F.array_join(F.concat(kept, F.when(last, F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))), "/")


def resolved(base: Column, target: Column) -> Column:
    """The url that a link target on the page ``base`` names; null for the page itself and for what is no address of a host."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    path, own = F.regexp_extract(target, r"(?s)^[^?#]*", 0), path_of(base)
    tail = F.substring(target, F.length(path) + 1, F.length(target))
    folder = F.regexp_extract(own, r"(?s)^.*/", 0)
    merged = (
        F.when(path.startswith("/"), path)
        .when(path == "", own)
        .otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), path))
    )
    place = F.concat(scheme, F.lit("://"), F.regexp_extract(base, r"(?s)^.*?://([^/?#]*)", 1))
    return (
        F.when((target == "") | target.startswith("#"), F.lit(None))
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.when(target.contains("://"), target))
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .otherwise(F.concat(place, F.when(merged == "", F.lit("")).otherwise(_without_dots(merged)), tail))
    )


def page_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Alias edges ``(a, b)`` from pages: plain forms, and all canonical links and refresh redirects, resolved on the page's url."""
    rows = pages.select(F.col(url_col).alias("a"), F.col(html_col).alias("_html")).where(F.col("a").contains("://"))
    links = rows.where(F.col("_html").isNotNull()).select("a", F.explode(link_targets(F.col("_html"))).alias("_t"))
    edges = links.select("a", resolved(F.col("a"), F.col("_t")).alias("b"))
    edges = edges.unionByName(rows.select("a", plain_form(F.col("a")).alias("b")))
    # A link target is known by its plain form as well.
    edges = edges.where(F.col("b").contains("://") & (F.col("a") != F.col("b")))
    plain = edges.select(F.col("b").alias("a"), plain_form(F.col("b")).alias("b")).where("b is not null and a <> b")
    return edges.unionByName(plain).distinct()


def matched_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url``, ``rule`` and ``own`` verdict of the distinct ``url`` values that a rule fits."""
    listed = rules.where("host is not null and path is not null and verdict is not null")
    labels = listed.select(F.max(F.size(F.split("host", r"\."))).alias("n")).first()["n"]
    if labels is None:
        return urls.select("url", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("own")).limit(0)
    parts = F.split(host_of(F.col("url")), r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.lit(labels), F.size(parts))), lambda n: F.array_join(F.slice(parts, -n, n), ".")
    )
    found = urls.select("url", path_of(F.col("url")).alias("_path"), F.explode(suffixes).alias("host")).join(listed, "host")
    text = F.concat("host", "path")
    best = F.max(F.struct(F.length(text), (F.col("verdict") == "allow"), text.alias("rule"), F.col("verdict").alias("own")))
    return found.where(F.col("_path").startswith(F.col("path"))).groupBy("url").agg(best.alias("_b")).select(
        "url", "_b.rule", "_b.own"
    )


def judge(urls: DataFrame, rules: DataFrame, edges: DataFrame) -> DataFrame:
    """``url``, ``rule`` and ``verdict`` of the distinct ``url`` values of ``urls``.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block), ``edges`` urls ``a`` and ``b`` that are aliases.
    """
    known = urls.select("url").where("url is not null").distinct()
    ends = reduce(DataFrame.unionByName, [known, *(edges.select(F.col(c).alias("url")) for c in "ab")])
    own = matched_rules(ends.where("url is not null").distinct(), rules)
    member = components(edges)
    told = (
        member.join(own, member["node"] == own["url"])
        .groupBy("component")
        .agg(F.max(F.when(F.col("own") == "allow", F.lit("allow"))).alias("_allow"), F.max("own").alias("_any"))
        .select("component", F.coalesce("_allow", "_any").alias("_told"))
    )
    spread = member.join(told, "component").select(F.col("node").alias("url"), "_told")
    return (
        known.join(own, "url", "left")
        .join(spread, "url", "left")
        .select("url", "rule", F.coalesce("own", "_told", F.lit("allow")).alias("verdict"))
    )


def judge_pages(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Id, ``host``, ``path``, ``rule`` and ``verdict`` of every row of ``pages``."""
    rows = pages.select(F.col(id_col), F.col(url_col).alias("url"))
    judged = judge(rows, rules, page_edges(pages, url_col, html_col))
    return rows.join(judged, "url", "left").select(
        id_col,
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        "rule",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"),
    )
