"""The scan job over captures: candidates, identity, best-first crawl, contacts, browser targets; and its replay.

Captured pages stand in for the network: a page is fetched if it was captured.
Columns of captures: url, html, observed_at, and status and content_type if known.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import policy as P
from ..functions import emails, names, text, urls
from ..operators import contacts as C
from ..operators import identity as I
from ..operators import links as L
from ..operators import metrics as M
from ..operators.robots import allowed, parse_robots
from ..sources import html as H
from ..sources.session import checkpoint
from .pipelines import AGENT, Extraction

SUB_PAGES = 3  # pages whose signals are added to the home page's
MAPS, MAP_CHILDREN = 2, 3  # sitemaps of a site that are read, and maps taken from an index


@dataclass
class Found:
    contacts: DataFrame
    review: DataFrame


@dataclass
class Scan:
    """verdicts: a row a school (website, source, identity); extraction: pages, contacts, review, per-school counts; targets: pages for the browser; errors: candidates and pages that failed; found: all observations."""

    verdicts: DataFrame
    extraction: Extraction
    targets: DataFrame
    errors: DataFrame
    found: Found


def _usable(captures: DataFrame, robots: DataFrame | None) -> DataFrame:
    """captures with page (their key), host, and error: why a capture is not read, null if it is."""
    for name in ("status", "content_type"):
        if name not in captures.columns:
            captures = captures.withColumn(name, F.lit(None).cast("int" if name == "status" else "string"))
    rows = captures.dropDuplicates(["url"]).withColumns({"page": L.page_key(F.col("url")), "host": urls.host(F.col("url"))})
    rows = allowed(rows, parse_robots(robots), AGENT) if robots is not None else rows.withColumn("allowed", F.lit(True))
    http = F.concat(F.lit("HTTP_"), F.col("status").cast("string"))
    error = F.when(~F.col("allowed"), "ROBOTS_DISALLOWED").when(F.coalesce(F.col("status") != 200, F.lit(False)), http).when(~M.is_html(F.col("content_type"), F.col("html")), "NON_HTML")
    return rows.withColumn("error", error)


def _signals(rows: DataFrame) -> Column:
    c = F.col
    return I.batch_signals(c("text"), c("mails"), c("ico"), c("red_izo"), c("emails"), c("street"), c("name"))


def confirm_websites(schools: DataFrame, read: DataFrame, portal: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(verdicts, errors) of schools by their candidate websites.

    read: outlines of captured pages with page and error. Signals of a home page
    and of its SUB_PAGES best linked pages are put together. The first confirmed
    candidate is taken, else the website that the portal's record names, if its
    home page was captured. A soft 404 confirms nothing.
    """
    own = schools.select("registry_id", "ico", "red_izo", "emails", "street", "name", "website")
    cands = own.select("*", F.posexplode(urls.candidates(F.col("website"), F.col("emails"), "batch")).alias("pos", "candidate")).withColumn("page", L.page_key(F.col("candidate")))
    homes = cands.join(read.select("page", "url", "error", "soft404", "text", "mails", "links"), "page", "left")
    error = F.when(F.col("url").isNull(), "NOT_CAPTURED").when(F.col("error").isNotNull(), F.concat(F.lit("HOME_"), F.col("error"))).when(F.col("soft404"), "SOFT_404")
    homes = checkpoint(homes.withColumns({"failed": error, "own": F.when(error.isNull(), _signals(homes))}))
    good = homes.filter("failed is null")
    links = L.top_links(L.admitted(L.outline_links(good.select("url", "links").distinct())), SUB_PAGES).select(F.col("page_url").alias("url"), L.page_key(F.col("url")).alias("_sub"))
    subs = read.filter("error is null").select(F.col("page").alias("_sub"), "text", "mails")
    more = good.drop("text", "mails").join(links, "url").join(subs, "_sub")
    more = more.select("registry_id", "pos", F.explode(_signals(more)).alias("s")).groupBy("registry_id", "pos").agg(F.collect_set("s").alias("more"))
    judged = good.join(more, ["registry_id", "pos"], "left").withColumn("signals", F.array_sort(F.array_union("own", F.coalesce("more", F.array().cast("array<string>")))))
    ok = I.identity_ok(F.col("signals"))
    first = judged.filter(ok).groupBy("registry_id").agg(F.min_by(F.struct("url", "signals"), "pos").alias("w"))
    verdicts = first.select("registry_id", F.col("w.url").alias("website"), F.lit("REGISTRY_EMAIL_DOMAIN_AND_IDENTITY").alias("source"), F.col("w.signals").alias("identity"))
    unsure = judged.filter(~ok).select("registry_id", F.col("candidate").alias("url"), F.lit("IDENTITY_NOT_CONFIRMED").alias("code"))
    errors = homes.filter("failed is not null").select("registry_id", F.col("candidate").alias("url"), F.col("failed").alias("code")).unionByName(unsure)
    if portal is not None:
        named = H.portal_websites(portal).withColumn("page", L.page_key(F.col("website"))).select("red_izo", "page", F.col("url").alias("record"))
        late = own.join(verdicts, "registry_id", "left_anti").join(named, "red_izo").join(read.filter("error is null and not soft404").select("page", F.col("url").alias("home")), "page")
        verdicts = verdicts.unionByName(late.select("registry_id", F.col("home").alias("website"), F.col("record").alias("source"), F.array(F.lit("CSI_EXPLICIT_WEB")).alias("identity")))
    return verdicts, errors


def scan_sites(schools: DataFrame, captures: DataFrame, robots: DataFrame | None = None, portal: DataFrame | None = None, maps: DataFrame | None = None, budget: int = P.PAGE_BUDGET["batch"], given=P.GIVEN_NAMES, confirmed: DataFrame | None = None) -> Scan:
    """Every school's website confirmed, crawled best-first within the page budget and read.

    maps: website, url, xml of captured sitemaps; confirmed: registry_id, website
    of schools whose website is known already (nothing is confirmed then).
    """
    usable = _usable(captures, robots)
    seen = H.outlines(usable.filter("error is null").select("url", "html"), given=given)
    read = checkpoint(usable.select("url", "page", "host", "error", "observed_at", text.sha256(F.col("html")).alias("content_hash")).join(seen, "url", "left"))
    if confirmed is None:
        verdicts, errors = confirm_websites(schools, read, portal)
        verdicts = checkpoint(verdicts)
    else:
        verdicts = confirmed.select("registry_id", "website", F.lit("GIVEN").alias("source"), F.array().cast("array<string>").alias("identity"))
        errors = verdicts.select("registry_id", F.col("website").alias("url"), F.lit("").alias("code")).limit(0)
    sites = verdicts.withColumn("_bare", urls.bare_host(F.col("website")))
    own = read.withColumn("_bare", urls.bare_host(F.col("url"))).join(sites.select("registry_id", "_bare", "website"), "_bare").drop("_bare")
    good = own.filter("error is null and not soft404")
    links = checkpoint(L.admitted(L.outline_links(good.select("url", "links").distinct())).join(good.select(F.col("url").alias("page_url"), F.col("registry_id").alias("site")), "page_url"))
    listed = None
    if maps is not None:
        children = L.sitemap_children(maps, most=MAP_CHILDREN).withColumnRenamed("map", "url").join(maps.select("url", "xml"), "url")
        found = L.sitemap_urls(maps.select("website", "xml").unionByName(children.select("website", "xml")))
        scored = found.withColumn("score", urls.batch_score(F.col("url"), F.lit(""))).filter(F.col("score") >= P.LEAST_SCORE)
        at_home = F.col("_bare") == urls.bare_host(F.col("url"))
        listed = scored.join(sites.select(F.col("registry_id").alias("site"), "_bare"), at_home).select("site", "url", "score")
    order = L.crawl_order(sites.select(F.col("registry_id").alias("site"), F.col("website").alias("url")), links.select("site", "page_url", "url", "score"), budget, listed)
    wanted = order.select(F.col("site").alias("registry_id"), L.page_key(F.col("url")).alias("page"), "score", "round")
    taken = checkpoint(wanted.join(own, ["registry_id", "page"], "left").withColumn("error", F.when(F.col("url").isNull(), "NOT_CAPTURED").when(F.col("error").isNotNull(), F.col("error")).when(F.col("soft404"), "SOFT_404")))
    pages = taken.filter("error is null")

    found = read_contacts(pages.select("registry_id", "url", "observed_at"), captures, schools, given)
    per_page = found.contacts.groupBy("url").agg(F.count(F.lit(1)).alias("contacts"))
    shown = pages.join(per_page, "url", "left").withColumns({"contacts": F.coalesce("contacts", F.lit(0)), "site": F.col("registry_id"), "names": F.size(F.array_distinct(F.transform("names", names.name_key)))})
    targets = M.browser_targets(shown).withColumnRenamed("site", "registry_id")
    left = links.select("site", L.page_key(F.col("url")).alias("page")).distinct().join(wanted.select(F.col("registry_id").alias("site"), "page"), ["site", "page"], "left_anti")
    counts = verdicts.select(F.col("registry_id").alias("school"), "website")
    for of, key, name in ((targets, "registry_id", "browser_targets"), (left, "site", "remaining"), (pages, "registry_id", "pages"), (pages.filter("pagination"), "registry_id", "notes")):
        counts = counts.join(of.groupBy(F.col(key).alias("school")).agg(F.count(F.lit(1)).alias(name)), "school", "left")
    counts = counts.select("school", "website", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("browser_targets", "remaining", "pages", "notes")])
    kept = winners(found.contacts, verdicts)
    lost = taken.filter("error is not null").select("registry_id", F.coalesce("url", "page").alias("url"), F.col("error").alias("code"))
    listing = taken.select("registry_id", F.coalesce("url", "page").alias("url"), "error", "content_hash")
    return Scan(verdicts, Extraction(listing, kept, found.review, counts), targets, errors.unionByName(lost), found)


def read_contacts(pages: DataFrame, captures: DataFrame, schools: DataFrame, given=P.GIVEN_NAMES) -> Found:
    """Contacts and review items of pages (registry_id, url, observed_at) that were captured; the school's own name is no person."""
    html = pages.select("url").distinct().join(captures.select("url", "html").dropDuplicates(["url"]), "url")
    # read once: contacts, conflicts and review all come from these rows
    rows = checkpoint(H.contacts(html, given=given).join(pages, "url").join(schools.select("registry_id", F.col("name").alias("school_name")), "registry_id"))
    person = text.fold(F.concat_ws("|", "first_name", "last_name"))
    mine = rows.filter("kind = 'CONTACT'").filter(~names.within(F.concat_ws(" ", "first_name", "last_name"), F.col("school_name")))
    obs = mine.select(
        F.col("registry_id").alias("school"), "url", F.lower("email").alias("mailbox"), person.alias("person"), F.col("url").alias("source"), F.nullif("role", F.lit("")).alias("role"), "first_name", "last_name", "method",
        "observed_at", F.concat_ws("|", F.col("observed_at").cast("string"), "url", "method", "evidence_hash").alias("pos"),
    )
    shared = C.conflicts(obs, C.KEY).select("school", F.col("mailbox").alias("email"), F.lit("SHARED_OR_CONFLICTING_PERSON").alias("reason"), F.lit("").alias("url"))
    review = rows.filter("kind = 'REVIEW'").select(F.col("registry_id").alias("school"), "email", "reason", "url").unionByName(shared)
    return Found(obs, review)


def winners(obs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """One row a mailbox of one person, with the school's website."""
    return C.first_with_unions(obs.drop("url").join(verdicts.select(F.col("registry_id").alias("school"), "website"), "school"), C.KEY)


def reparse(pages: DataFrame, captures: DataFrame, schools: DataFrame, given=P.GIVEN_NAMES) -> tuple[Extraction, DataFrame]:
    """(extraction, notes) of the pages of an earlier scan, read anew from their captures.

    pages: registry_id, url. Observations keep the time of their capture, and a
    page without one gives a note; nothing is fetched.
    """
    at = captures.select("url", "observed_at", "html").dropDuplicates(["url"])
    met = pages.select("registry_id", "url").distinct().join(at.select("url", "observed_at", text.sha256(F.col("html")).alias("content_hash"), F.lit(True).alias("_hit")), "url", "left")
    notes = met.filter("_hit is null").select("registry_id", F.concat(F.lit("SOURCE_CAPTURE_MISSING:"), "url").alias("note"))
    found = read_contacts(met.filter("_hit").select("registry_id", "url", "observed_at"), captures, schools, given)
    kept = winners(found.contacts, schools.select("registry_id", "website"))
    listing = met.select("registry_id", "url", F.when(F.col("_hit").isNull(), "SOURCE_CAPTURE_MISSING").alias("error"), "content_hash")
    return Extraction(listing, kept, found.review), notes


def profile_contacts(profiles: DataFrame, given=P.GIVEN_NAMES) -> tuple[DataFrame, DataFrame]:
    """(observations, review) of opened profile cards (H12, F9): registry_id, url and the columns of a profile capture.

    A card counts if it was opened and shows a name and exactly one well-formed
    address; others go to review with the reason.
    """
    o = F.col("o")
    rows = profiles.select("registry_id", "url", F.explode("observations").alias("o")).withColumn("name", names.split_name(o["publishedName"], given))
    mails = F.coalesce(o["publishedEmails"], F.array().cast("array<string>"))
    one = (F.size(mails) == 1) & emails.valid(F.get(mails, F.lit(0)), "batch")
    opened = F.coalesce(o["status"] == "OPENED", F.lit(False))
    reason = F.when(~opened, F.coalesce(o["status"], F.lit("NOT_OPENED"))).when(F.col("name").isNull(), "NAME_NEEDS_REVIEW").when(F.size(mails) > 1, "MULTIPLE_EMAILS").when(~one, "NO_PUBLISHED_EMAIL")
    judged = rows.withColumns({"reason": reason, "mail": F.lower(F.get(mails, F.lit(0)))})
    lines = F.split(F.coalesce(o["text"], F.lit("")), "\n")
    digest = text.sha256(F.coalesce(o["text"], F.lit("")))
    obs = judged.filter("reason is null").select(
        F.col("registry_id").alias("school"), "url", F.col("mail").alias("mailbox"), names.name_key(F.col("name")).alias("person"), F.col("url").alias("source"), F.nullif(text.squeeze(F.array_join(F.slice(lines, 3, 2), " ")), F.lit("")).alias("role"),
        "name.first_name", "name.last_name", F.lit("BROWSER_PROFILE_CARD").alias("method"), F.to_date(F.substring(o["observedAt"], 1, 10)).alias("observed_at"), F.concat_ws("|", F.substring(o["observedAt"], 1, 10), "url", F.lit("BROWSER_PROFILE_CARD"), digest).alias("pos"),
    )
    review = judged.filter("reason is not null").select(F.col("registry_id").alias("school"), F.when(F.size(mails) == 1, F.col("mail")).alias("email"), "reason", "url")
    return obs, review


def with_browser(scan: Extraction, static: Found, verdicts: DataFrame, schools: DataFrame, rendered: DataFrame, profiles: DataFrame, given=P.GIVEN_NAMES) -> Extraction:
    """A scan with what the browser saw: rendered pages (registry_id, url, html, observed_at) and profile captures (registry_id, url, ...).

    Static observations go before those of rendered pages and of profile cards;
    a mailbox that two of them give to different people is a conflict.
    """
    shown = read_contacts(rendered.select("registry_id", "url", "observed_at"), rendered, schools, given)
    cards, bad = profile_contacts(profiles, given)
    visible = shown.contacts.withColumn("method", F.lit("BROWSER_VISIBLE_DOM"))
    ordered = [o.withColumn("pos", F.concat_ws("|", F.lit(str(n)), "pos")) for n, o in enumerate((static.contacts, visible, cards))]
    obs = ordered[0].unionByName(ordered[1]).unionByName(ordered[2])
    shared = C.conflicts(obs, C.KEY).select("school", F.col("mailbox").alias("email"), F.lit("SHARED_OR_CONFLICTING_PERSON").alias("reason"), F.lit("").alias("url"))
    seen = F.transform("observations", lambda o: F.struct(o["idx"].alias("idx"), o["cardName"].alias("card_name"), o["publishedName"].alias("published_name"), o["status"].alias("status"), F.coalesce(o["publishedEmails"], F.array().cast("array<string>")).alias("emails")))
    coverage = M.profile_coverage(profiles.select("registry_id", F.concat_ws("|", "registry_id", "url").alias("capture"), "expected", "names", F.coalesce("exhausted", F.lit(False)).alias("exhausted"), seen.alias("observations")).drop("registry_id"))
    school = F.split_part("capture", F.lit("|"), F.lit(1)).alias("school")
    cover = coverage.groupBy(school).agg(F.count(F.lit(1)).alias("profiles"), F.bool_and(F.col("status") == "PROFILES_CHECKED").alias("profiles_checked"), F.sum("expected_cards").alias("profile_cards"), F.sum("opened_cards").alias("opened_cards"))
    browsers = rendered.groupBy(F.col("registry_id").alias("school")).agg(F.count(F.lit(1)).alias("browser_pages")).join(cover, "school", "full_outer")
    browsers = browsers.select("school", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("profiles", "browser_pages", "profile_cards", "opened_cards")], F.coalesce("profiles_checked", F.lit(False)).alias("profiles_checked"))
    review = scan.review.unionByName(shown.review).unionByName(bad).unionByName(shared).distinct()
    return Extraction(scan.pages, winners(obs, verdicts), review, scan.counts, browsers)
