"""The end-to-end jobs: import, resolve, extract, batch export, reviewed export.

Each takes and gives DataFrames; :mod:`ledgerloom.__main__` reads and writes
their files. Captured pages stand in for the network.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import emails, names, text, urls
from ..operators import contacts as C
from ..operators import identity as I
from ..operators import metrics as M
from ..operators import registry as G
from ..operators.links import declared_sitemaps
from ..operators.robots import allowed, parse_robots
from ..sources import html as H
from ..sources.sinks import set_websites

SCHOOL = "registry_id string, name string, school_type string, region string, street string, city string, postal_code string, address string, ico string, red_izo string, emails array<string>, director string, snapshot_date date"
AGENT = "ledgerloom"


def import_schools(payloads: DataFrame, current: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(schools, counts by type): a registry snapshot merged into the table, website columns kept."""
    new = G.accepted(G.parse(G.subjects(payloads)))
    new = C.keep_last(new, ["registry_id"], ["name", "address"])
    blank = {"website": F.lit(None).cast("string"), "website_status": F.lit("UNKNOWN")}
    counts = G.import_counts(new, current if current is not None else new.limit(0), "registry_id", "school_type")
    new = new.withColumns(blank)
    if current is None:
        return new, counts
    merged = C.upsert(current, new.select(*current.columns), "registry_id", keep=list(blank))
    return merged.withColumn("website_status", F.coalesce("website_status", F.lit("UNKNOWN"))), counts


def resolve_websites(schools: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(schools, verdicts): candidates from registry e-mails meet captured pages by site and are scored.

    pages: url, html. A candidate is verified by the best of its pages.
    """
    open_ = schools.filter("website_status = 'UNKNOWN'")
    cands = open_.select("registry_id", "ico", "red_izo", "emails", "street", "name", F.posexplode(urls.candidates(F.lit(None).cast("string"), F.col("emails"), "classic")).alias("pos", "candidate"))
    met = cands.withColumn("site", urls.bare_host(F.col("candidate"))).join(pages.withColumn("site", urls.bare_host(F.col("url"))), "site")
    c = F.col
    scored = met.withColumn("v", I.classic_signals(c("html"), c("ico"), c("red_izo"), c("emails"), c("street"), c("name")))
    rows = scored.select(c("registry_id").alias("school"), c("candidate").alias("website"), "pos", "v.status", "v.score", "v.signals")
    verdicts = I.best_candidate(rows, "school")
    done = set_websites(schools.withColumn("school", F.col("registry_id")), verdicts).drop("school")
    return done, verdicts


@dataclass
class Extraction:
    """Pages read, contacts and review items; counts: school, website, browser_targets, remaining, pages, notes of a scan."""

    pages: DataFrame
    contacts: DataFrame
    review: DataFrame
    counts: DataFrame | None = None
    browsers: DataFrame | None = None  # school, profiles, profiles_checked, browser_pages, profile_cards, opened_cards of browser runs


def extract_contacts(schools: DataFrame, pages: DataFrame, robots: DataFrame | None = None) -> Extraction:
    """Captured pages of verified sites to contacts and review items.

    pages: url, html, observed_at (date); robots: host, robots text. Pages of
    other sites are left out; disallowed ones are listed, not read.
    """
    sites = schools.filter("website_status = 'VERIFIED' AND website IS NOT NULL").select("registry_id", F.col("name").alias("school_name"), "address", "website", urls.bare_host(F.col("website")).alias("site"))
    own = pages.withColumn("site", urls.bare_host(F.col("url"))).join(sites, "site").withColumn("host", urls.host(F.col("url")))
    if robots is not None:
        own = allowed(own, parse_robots(robots), AGENT)
    else:
        own = own.withColumn("allowed", F.lit(True))
    error = F.when(~F.col("allowed"), "ROBOTS_DISALLOWED").when(~M.is_html(F.lit(None).cast("string"), F.col("html")), "NON_HTML")
    own = own.withColumn("error", error)
    good = own.filter("error IS NULL")
    found = H.contacts(good.select("url", "html").dropDuplicates(["url"])).join(good.select("url", "registry_id", "school_name", "website", "observed_at"), "url")
    person = text.fold(F.concat_ws("|", "first_name", "last_name"))
    rows = found.filter("kind = 'CONTACT'").filter(~names.within(F.concat_ws(" ", "first_name", "last_name"), F.col("school_name")))
    obs = rows.select(
        F.col("registry_id").alias("school"), F.lower("email").alias("mailbox"), person.alias("person"), F.col("url").alias("source"), F.nullif("role", F.lit("")).alias("role"), "first_name", "last_name", "website",
        "observed_at", F.concat_ws("|", F.col("observed_at").cast("string"), "url", "method", "evidence_hash").alias("pos"),
    )
    kept = C.first_with_unions(obs, C.KEY)
    shared = C.conflicts(obs, C.KEY).select("school", F.col("mailbox").alias("email"), F.lit("SHARED_OR_CONFLICTING_PERSON").alias("reason"), F.lit("").alias("url"))
    review = found.filter("kind = 'REVIEW'").select(F.col("registry_id").alias("school"), "email", "reason", "url").unionByName(shared)
    return Extraction(own.select("registry_id", "url", "error", text.sha256(F.col("html")).alias("content_hash")), kept, review)


@dataclass
class BatchResult:
    contacts: DataFrame
    schools: DataFrame
    review: DataFrame
    summary: DataFrame
    ledger: DataFrame


def batch_export(schools: DataFrame, extraction: Extraction, ledger: DataFrame) -> BatchResult:
    """BA9 and BA10: gate, ledger, statuses and summary of an extraction.

    Quarantined and suppressed mailboxes are not exported; the ledger keeps them.
    """
    found = extraction.contacts
    usable = found.filter(emails.valid(F.col("mailbox"), "batch"))
    merged = C.merge_ledger(usable.select("school", "mailbox", "person", "observed_at"), ledger)
    ok = merged.filter("reason IS NULL").select("school", "mailbox", "collected_at", "last_observed_at")
    sites = schools.select(F.col("registry_id").alias("school"), F.col("name").alias("school_name"), F.col("address").alias("school_address"), F.col("website").alias("school_website"), "website_status")
    out = usable.drop("website").join(ok, C.KEY).join(sites.drop("website_status"), "school")
    contacts = out.select("school", "first_name", "last_name", F.col("mailbox").alias("email"), "school_name", "school_address", "school_website", F.date_format("collected_at", "yyyy-MM-dd").alias("collected_at"), F.array_join("roles", "; ").alias("role"), "sources", "last_observed_at")
    held = merged.filter("reason IS NOT NULL").select("school", F.col("mailbox").alias("email"), "reason", F.lit("").alias("url"))
    bad = found.filter(~emails.valid(F.col("mailbox"), "batch")).select("school", F.col("mailbox").alias("email"), F.lit("INCOMPLETE_RECORD").alias("reason"), F.col("source").alias("url"))
    items = extraction.review.unionByName(held).unionByName(bad).withColumns({"name": F.lit("—"), "pos": F.lit(0)})
    review = C.prune_review(items, contacts).drop("name", "pos")
    pages = extraction.pages.groupBy(F.col("registry_id").alias("school")).agg(F.count_if(F.col("error").isNull()).alias("pages"), F.count_if(F.col("error").isNotNull()).alias("notes"))
    scans = sites.join(pages, "school", "left").select("school", F.col("school_website").alias("website"), F.lit(0).alias("browser_targets"), F.lit(0).alias("remaining"), F.coalesce("notes", F.lit(0)).alias("notes"), F.coalesce("pages", F.lit(0)).alias("pages"))
    if extraction.counts is not None:  # a scan tells more of the sites it has confirmed
        known = extraction.counts.select("school", *[F.col(c).alias(f"_{c}") for c in ("website", "browser_targets", "remaining", "pages", "notes")])
        scans = scans.join(known, "school", "left").select("school", F.coalesce("_website", "website").alias("website"), *[F.coalesce(f"_{c}", c).alias(c) for c in ("browser_targets", "remaining", "notes", "pages")])
    empty = [F.lit(0).alias(c) for c in ("profiles", "browser_pages", "profile_cards", "opened_cards")]
    browsers = extraction.browsers if extraction.browsers is not None else sites.limit(0).select("school", *empty, F.lit(False).alias("profiles_checked"))
    rows = M.school_rows(sites.select("school", "school_name"), scans, browsers, contacts)
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("browser_pages", "profile_cards", "opened_cards")})
    summary = M.batch_summary(rows, contacts.withColumn("person", text.fold(F.concat_ws(" ", "first_name", "last_name"))), review)
    return BatchResult(contacts, rows, review, summary, merged.drop("reason"))


def reviewed_export(capture: DataFrame, ledger: DataFrame, date: str) -> BatchResult:
    """PI3–PI7: a reviewed capture (one row) through the strict gate and the ledger.

    The capture's rows must name each school once; a ledger newer than the
    capture is an error.
    """
    s = capture.select(F.explode("schools").alias("s")).select(F.col("s.key").alias("key"), "s.name", "s.type", "s.scope", "s.address", "s.website", F.col("s.addressSourceUrl").alias("address_source_url"))
    if not s.groupBy("key").count().filter("key IS NULL OR key = '' OR count > 1").isEmpty():
        raise ValueError("missing or repeated school key")
    C.assert_not_newer(ledger, date)
    o = lambda n: F.col(f"o.{n}")
    obs = capture.select(F.posexplode("observations").alias("n", "o")).select(
        "n", o("schoolKey").alias("school_key"), o("firstName").alias("first_name"), o("lastName").alias("last_name"), o("email").alias("email"), o("publishedName").alias("published_name"), o("publishedEmail").alias("published_email"),
        o("role").alias("role"), o("sourceUrl").alias("source_url"), o("reviewed").alias("reviewed"), o("alternateEmails").alias("alternate_emails"), o("validFrom").alias("valid_from"), o("validUntil").alias("valid_until"),
    )
    good, bad = C.accept_reviewed(obs, s, date)
    low = lambda c: F.lower(text.squeeze(F.col(c)))
    rows = good.select(
        F.col("school_key").alias("school"), emails.normalize_published(F.col("email")).alias("mailbox"), F.concat_ws("|", low("first_name"), low("last_name")).alias("person"), F.col("source_url").alias("source"), "role",
        text.strip(F.col("first_name")).alias("first_name"), text.strip(F.col("last_name")).alias("last_name"), F.lit(date).cast("date").alias("observed_at"), "n",
    )
    merged = C.merge_ledger(rows.select("school", "mailbox", "person", "observed_at"), ledger)
    ok = merged.filter("reason IS NULL").select("school", "mailbox", "collected_at", "last_observed_at")
    last = rows.groupBy("school", "mailbox").agg(F.max_by(F.struct("first_name", "last_name", "role", "person"), "n").alias("w"), F.array_sort(F.collect_set("source")).alias("sources"), F.count(F.lit(1)).alias("seen"))
    met = last.join(ok, C.KEY).join(s, F.col("school") == F.col("key"))
    contacts = met.select(
        "school", "w.first_name", "w.last_name", F.col("mailbox").alias("email"), F.col("name").alias("school_name"), F.col("address").alias("school_address"), F.col("website").alias("school_website"), F.date_format("collected_at", "yyyy-MM-dd").alias("collected_at"),
        F.coalesce("w.role", F.lit("")).alias("role"), "sources", "address_source_url", "last_observed_at", "w.person", "seen",
    )
    unresolved = capture.select(F.explode("unresolved").alias("u")).select(F.col("u.schoolKey").alias("school"), F.col("u.name").alias("name"), F.lit(None).cast("string").alias("email"), F.coalesce("u.reason", F.lit("REVIEW_REQUIRED")).alias("reason"), F.lit(None).cast("string").alias("url"))
    full = F.concat_ws(" ", "first_name", "last_name")
    rejected = bad.select(F.col("school_key").alias("school"), full.alias("name"), "email", "reason", F.col("source_url").alias("url"))
    held = rows.join(merged.filter("reason IS NOT NULL").select("school", "mailbox", "reason"), C.KEY).select("school", full.alias("name"), F.col("mailbox").alias("email"), "reason", F.col("source").alias("url"))
    review = unresolved.unionByName(rejected).unionByName(held)
    per = contacts.groupBy("school").agg(F.count(F.lit(1)).alias("contacts"))
    schools = s.join(per.withColumnRenamed("school", "key"), "key", "left").withColumn("contacts", F.coalesce("contacts", F.lit(0)))
    one = lambda df: df.withColumn("_k", F.lit(1))
    totals = schools.agg(F.count(F.lit(1)).alias("schools_reviewed"), F.count_if(F.col("contacts") > 0).alias("schools_with_contacts"), *[F.count_if(F.col("type") == t).alias(n) for t, n in (("ZŠ", "primary_schools"), ("SŠ", "secondary_schools"), ("ZŠ+SŠ", "combined_schools"))])
    people = contacts.agg(F.count(F.lit(1)).alias("confirmed_contacts"), F.count_distinct("school", "person").alias("school_person_pairs"), F.coalesce(F.sum(F.col("seen") - 1), F.lit(0)).alias("duplicate_observations"))
    summary = one(totals).join(one(people), "_k").join(one(review.agg(F.count(F.lit(1)).alias("review_items"))), "_k").drop("_k").withColumn("collection_date", F.lit(date))
    return BatchResult(contacts.drop("person", "seen"), schools, review, summary, merged.drop("reason"))


def sitemap_addresses(robots: DataFrame) -> DataFrame:
    """Host, sitemap of every declaration."""
    return robots.select("host", F.explode(declared_sitemaps(F.col("robots"))).alias("sitemap"))
