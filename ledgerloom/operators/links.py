"""Links, sitemaps and crawl order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import policy as P
from ..functions import urls
from ..functions.text import squeeze

_ANCHOR = "(?is)<a\\s[^>]*>.*?</a>"


def anchors(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """page_url, pos, href, label: every a[href] of a page in its order. A null page has none."""
    found = pages.select(F.col(url).alias("page_url"), F.posexplode(F.regexp_extract_all(F.col(html), F.lit(_ANCHOR), F.lit(0))).alias("pos", "a"))
    raw = found.withColumn("href", F.regexp_extract("a", "(?is)^<a\\s[^>]*?href\\s*=\\s*[\"']([^\"']*)[\"']", 1)).filter(F.col("a").rlike("(?is)^<a\\s[^>]*?href\\s*="))
    text = squeeze(F.regexp_replace("a", "(?s)<[^>]+>", ""))
    return raw.select("page_url", "pos", unescape(F.col("href")).alias("href"), unescape(text).alias("label"))


def unescape(c: Column) -> Column:
    """The common HTML character references."""
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&")):
        c = F.replace(c, F.lit(name), F.lit(char))
    return c


def scored_links(links: DataFrame, policy: str = "classic") -> DataFrame:
    """page_url, pos, url, label, score of the links that stay on the site (classic) or are usable at all (batch)."""
    if P.check(policy) == "classic":
        u, score = urls.canonical(F.col("href"), F.col("page_url")), urls.classic_score
    else:
        u, score = urls.without_trackers(F.col("href"), F.col("page_url")), urls.batch_score
    known = links.withColumn("url", u).filter("url is not null")
    return known.select("page_url", "pos", "url", "label", score(F.col("url"), F.col("label")).alias("score"))


def page_key(url: Column) -> Column:
    """What two addresses of one page share: the URL without a trailing slash."""
    return F.regexp_replace(url, "/$", "")


def outline_links(outlines: DataFrame) -> DataFrame:
    """H3, H6: page_url, pos, url, label, score of the links of page outlines (columns url, links), as :func:`scored_links` (batch)."""
    found = outlines.select(F.col("url").alias("page_url"), F.posexplode("links").alias("pos", "l")).select("page_url", "pos", "l.href", "l.label")
    return scored_links(found, "batch")


def best_links(links: DataFrame) -> DataFrame:
    """For each page and linked page the link of the best score, the first one on ties; /x and /x/ are one page."""
    best = F.max_by(F.struct("url", "label", "pos"), F.struct("score", -F.col("pos"))).alias("b")
    rows = links.groupBy("page_url", page_key(F.col("url")).alias("_key")).agg(F.max("score").alias("score"), best)
    return rows.select("page_url", F.col("b.url").alias("url"), F.col("b.label").alias("label"), "score", F.col("b.pos").alias("pos"))


def merge_candidates(*groups: DataFrame) -> DataFrame:
    """The best candidate of each (site, page) over all groups; earlier groups win ties."""
    out = None
    for n, g in enumerate(groups):
        g = g.select("site", "url", "label", "score", F.lit(n).alias("grp"))
        out = g if out is None else out.unionByName(g)
    best = F.max_by(F.struct("url", "label", "grp"), F.struct("score", -F.col("grp"), "url")).alias("b")
    rows = out.groupBy("site", page_key(F.col("url")).alias("_key")).agg(F.max("score").alias("score"), best)
    return rows.select("site", F.col("b.url").alias("url"), "score", F.col("b.label").alias("label"), F.col("b.grp").alias("grp"))


def admissible(links: DataFrame) -> DataFrame:
    """links of the own site, not to denied paths, of the least score or more; all of them, however often a page was captured."""
    path = F.regexp_extract("url", "^[^/]*//[^/?#]*([^?#]*)", 1)
    return links.filter(urls.same_site(F.col("url"), F.col("page_url")) & ~path.rlike(P.LINK_DENIED) & (F.col("score") >= P.LEAST_SCORE))


def admitted(links: DataFrame) -> DataFrame:
    """The best admissible link of each page."""
    return best_links(admissible(links))


def top_links(links: DataFrame, n: int, least: int | None = None) -> DataFrame:
    """O3: the n best links of each page, by score and then URL, with their rank (the top-4 of a home page, the top-3 sub-pages)."""
    rows = links if least is None else links.filter(F.col("score") >= least)
    rank = F.row_number().over(Window.partitionBy("page_url").orderBy(F.desc("score"), "url"))
    return rows.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= n)


def frontier(links: DataFrame, seen: DataFrame | None = None, budget: int | Column = P.PAGE_BUDGET["classic"], least: int = P.LEAST_SCORE) -> DataFrame:
    """The best unseen pages of each site, up to its page budget, with their rank; one hop of the best-first crawl.

    The order is score, then URL; the budget (a number, or a column of links) is
    the feature itself. :func:`crawl_order` goes on hop by hop.
    """
    rows = links.filter(F.col("score") >= least).withColumns({"_key": page_key(F.col("url")), "_budget": budget if isinstance(budget, Column) else F.lit(budget)})
    if seen is not None:
        rows = rows.join(seen.select("site", page_key(F.col("url")).alias("_key")).distinct(), ["site", "_key"], "left_anti")
    best = rows.groupBy("site", "_key").agg(F.max("score").alias("score"), F.max_by("url", F.struct("score", "url")).alias("url"), F.max("_budget").alias("_budget"))
    rank = F.row_number().over(Window.partitionBy("site").orderBy(F.desc("score"), "url"))
    return best.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= F.col("_budget")).select("site", "url", "score", "rank")


def crawl_order(home: DataFrame, links: DataFrame, budget: int = P.PAGE_BUDGET["batch"], maps: DataFrame | None = None, step: int = 4, least: int = P.LEAST_SCORE) -> DataFrame:
    """O2: site, url, score, round of the pages of a best-first crawl over captured links.

    home: site, url of each verified site; links: site, page_url, url, score of
    captured pages (admitted ones); maps: site, url, score of sitemap pages. In
    each round every site takes the ``step`` best pages that its taken pages and
    maps link to, so a better page found later goes before a worse one found
    earlier, until the budget is used up or nothing is left: at most
    budget / step rounds more than the depth of the best pages, each of which is
    checkpointed. step = 1 is the strict order, a page at a time.
    """
    from ..sources.session import checkpoint

    known = links.withColumn("_from", page_key(F.col("page_url"))).select("site", "_from", "url", "score")
    taken = checkpoint(home.select("site", "url", F.lit(100).cast("long").alias("score"), F.lit(0).alias("round")))
    for n in range(1, budget + 1):
        used = taken.groupBy("site").agg(F.count(F.lit(1)).alias("_used")).filter(F.col("_used") < budget)
        open_ = taken.select("site", page_key(F.col("url")).alias("_from")).join(known, ["site", "_from"]).select("site", "url", "score")
        open_ = open_ if maps is None else open_.unionByName(maps.select("site", "url", "score"))
        room = open_.join(used, "site").withColumn("_room", F.least(F.lit(step), F.lit(budget) - F.col("_used")))
        new = checkpoint(frontier(room, taken, F.col("_room"), least).select("site", "url", "score", F.lit(n).alias("round")))
        if new.isEmpty():
            break
        taken = checkpoint(taken.unionByName(new))
    return taken


_LOC = r"(?is)<loc>\s*(.*?)\s*</loc>"


def sitemap_urls(maps: DataFrame, xml: str = "xml", site: str = "website") -> DataFrame:
    """H4: website, url, score of each <url><loc> of the own site; the maps that an index lists are no pages. Malformed XML gives what can be read."""
    entries = F.regexp_extract_all(F.col(xml), F.lit("(?is)<url(?:\\s[^>]*)?>(.*?)</url>"), F.lit(1))
    found = F.explode(F.array_compact(F.transform(entries, lambda e: F.nullif(F.regexp_extract(e, _LOC, 1), F.lit("")))))
    rows = maps.filter(~F.coalesce(F.col(xml).rlike("(?i)<sitemapindex"), F.lit(False))).select(F.col(site).alias("website"), found.alias("raw"))
    rows = rows.withColumn("url", urls.canonical(unescape(F.col("raw")), F.col("website"))).filter("url is not null")
    return rows.select("website", "url", urls.classic_score(F.col("url"), F.lit("")).alias("score")).distinct()


def sitemap_children(maps: DataFrame, xml: str = "xml", site: str = "website", most: int = 3) -> DataFrame:
    """Website, map of the first ``most`` maps of the own site that a sitemap index lists."""
    entries = F.regexp_extract_all(F.col(xml), F.lit("(?is)<sitemap(?:\\s[^>]*)?>(.*?)</sitemap>"), F.lit(1))
    found = F.explode(F.slice(F.transform(entries, lambda e: unescape(F.regexp_extract(e, _LOC, 1))), 1, most))
    rows = maps.filter(F.col(xml).rlike("(?i)<sitemapindex")).select(F.col(site).alias("website"), found.alias("map"))
    return rows.filter(urls.same_site(F.col("map"), F.col("website"))).distinct()


def declared_sitemaps(robots: Column) -> Column:
    """Sitemap addresses in robots text."""
    return F.regexp_extract_all(robots, F.lit("(?im)^sitemap:\\s*(https?://\\S+)"), F.lit(1))
