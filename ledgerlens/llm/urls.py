"""Block and allow rules for urls, carried to aliases over redirects and canonical links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import stage

from .common import fresh, others
from .components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def bare(url: Column) -> Column:
    """The url as a node: host lower-cased, without its fragment. Null without ``://``."""
    scheme = F.regexp_extract(url, r"(?s)^(.*?://)", 1)
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(F.contains(url, F.lit("://")), F.concat(scheme, host_of(url), rest))


def _resolved(found: DataFrame) -> DataFrame:
    """Adds ``to``: the link as an absolute url; ``..`` parts stay as written."""
    found = found.withColumns({
        "link": F.replace(F.trim("link"), F.lit("&amp;"), F.lit("&")),
        "scheme": F.regexp_extract("base", r"(?s)^(.*?:)//", 1),
        "site": host_of(F.col("base")),
        "folder": F.regexp_extract(path_of(F.col("base")), r"(?s)^(.*/)", 1),
    })
    link, site = F.col("link"), F.concat("scheme", F.lit("//"), "site")
    to = (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat("scheme", link))
        .when(link.startswith("/"), F.concat(site, link))
        .when((link != "") & (F.col("scheme") != ""), F.concat(site, F.when(F.col("folder") == "", "/").otherwise(F.col("folder")), link))
    )
    return found.withColumn("to", to)


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst): canonical links and refresh redirects that pages state, as bare urls; null where
    an url or link can't be one."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)(<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>|<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>)"), F.lit(1))
    to_link = lambda tag: F.coalesce(
        F.nullif(F.regexp_extract(tag, r"(?is)^<link\b[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1), F.lit("")),
        F.regexp_extract(tag, r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1),
    )
    found = pages.where(F.col(url).isNotNull() & F.col(html).isNotNull()).select(F.col(url).alias("base"), F.explode(tags).alias("tag"))
    found = found.select("base", to_link(F.col("tag")).alias("link")).where("link != ''")
    return _resolved(found).select(bare(F.col("base")).alias("src"), bare(F.col("to")).alias("dst"))


def match_rules(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """For each url that a rule fits: (url, rule, verdict) of the longest rule.

    A rule (host, path, verdict) fits its host and all subdomains when the url's path
    starts with the rule's. Of rules as long, allow wins, then the first in alphabet. Every
    url is looked up under its host's suffixes and the path prefixes of lengths that rules have.
    """
    rules = rules.select(F.translate("host", UPPER, LOWER).alias("h"), F.coalesce("path", F.lit("")).alias("p"), "verdict")
    lengths = sorted(r[0] for r in rules.select(F.length("p")).distinct().collect())
    if not lengths:
        return urls.select(F.col(url).alias("url")).where("false").selectExpr("url", "'' as rule", "'' as verdict")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fitting = F.filter(F.lit(lengths), lambda n: n <= F.length("path"))
    rows = urls.select(F.col(url).alias("url")).where("url is not null").distinct()
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}).where("host != ''")
    rows = rows.select("url", "path", F.explode(suffixes).alias("h"), fitting.alias("ns"))
    rows = rows.select("url", "h", F.explode("ns").alias("n"), "path").select("url", "h", F.expr("substr(path, 1, n)").alias("p"))
    rows = rows.join(rules, ["h", "p"])
    # the least of this order: longest, allow first, first in alphabet
    best = F.min(F.struct((-F.length(F.concat("h", "p"))).alias("n"), F.col("verdict").alias("verdict"), F.concat("h", "p").alias("rule")))
    return rows.groupBy("url").agg(best.alias("b")).select("url", "b.rule", "b.verdict")


def judge_urls(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, url: str = "url", html: str | None = "html") -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` (allow or block) to every page.

    A url's own rule decides it. Without one, it is blocked when a rule blocks any url of its
    component over redirect and canonical links (of ``html``, and of ``redirects`` with columns src
    and dst) or its own url without the fragment, and allowed otherwise. So an explicit allow
    always precedes a block that comes from an alias. A null url, or one without ``://``, has an empty
    host and path, no rule and no alias, and is allowed. Repeated urls are judged alike; a null html has no links, and
    whole pages are read, however long. Input columns of the same names are replaced, others stay. No pages: no rows; no
    rules: everything is allowed.
    """
    pages = pages.select(*others(pages, "host", "path", "rule", "verdict"))
    node, comp, blocked = fresh(pages, "_node", "_comp", "_blocked")
    links = [x for x in (page_links(pages, url, html) if html else None, redirects) if x is not None]
    at = pages.where(F.col(url).isNotNull()).select(F.col(url).alias("url"))
    edges = at.distinct().select(F.col("url").alias("src"), bare(F.col("url")).alias("dst"))
    for x in links:
        edges = edges.unionByName(x.select("src", "dst")).unionByName(x.select(F.col("src"), bare(F.col("src")).alias("dst"))).unionByName(x.select(F.col("dst").alias("src"), bare(F.col("dst")).alias("dst")))
    # a filter before the write would be pushed below the urls' expressions and repeat them
    edges = stage(edges.distinct(), "links").where("src is not null and dst is not null and src != dst")
    nodes = at.unionByName(edges.select(F.col("src").alias("url"))).unionByName(edges.select(F.col("dst").alias("url")))
    ruled = stage(match_rules(nodes, rules), "ruled")
    member = connected_components(edges, "src", "dst")
    bad = member.join(ruled.where("verdict = 'block'"), F.col("node") == F.col("url")).select(F.col("component").alias("c")).distinct()
    caught = member.join(bad, F.col("component") == F.col("c"), "left_semi").select(F.col("node").alias(node), F.lit(True).alias(blocked))
    rule = ruled.select(F.col("url").alias(comp), "rule", "verdict")
    out = pages.join(rule, F.col(url) == F.col(comp), "left").join(caught, F.col(url) == F.col(node), "left")
    verdict = F.coalesce(F.col("verdict"), F.when(F.col(blocked), "block").otherwise("allow"))
    out = out.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url)), "verdict": verdict})
    return out.select(*pages.columns, "host", "path", "rule", "verdict")
