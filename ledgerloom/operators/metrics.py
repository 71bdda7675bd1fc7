"""Counts, statuses and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import policy as P
from ..functions import text


def school_status(c) -> Column:
    """The first of seven statuses that fits."""
    return (
        F.when(~F.coalesce(c("scanned"), F.lit(False)), "NOT_PROCESSED")
        .when(F.coalesce(c("website"), F.lit("")) == "", "WEB_UNRESOLVED")
        .when((F.coalesce(c("browser_targets"), F.lit(0)) > 0) & ~F.coalesce(c("browsed"), F.lit(False)), "BROWSER_PENDING")
        .when((F.coalesce(c("notes"), F.lit(0)) > 0) | (F.coalesce(c("remaining"), F.lit(0)) > 0), "PARTIAL_COVERAGE")
        .when((F.coalesce(c("profiles"), F.lit(0)) > 0) & F.coalesce(c("profiles_checked"), F.lit(False)), "PROFILE_DIRECTORY_CHECKED")
        .when(F.coalesce(c("contacts"), F.lit(0)) > 0, "SOURCES_SCANNED_COMPLETENESS_UNCONFIRMED")
        .otherwise("NO_PERSONAL_CONTACTS")
    )


def school_rows(schools: DataFrame, scans: DataFrame, browsers: DataFrame, contacts: DataFrame) -> DataFrame:
    """Every school with its scan, browser run, number of contacts and status."""
    counted = contacts.groupBy("school").agg(F.count(F.lit(1)).alias("contacts"))
    met = schools.join(scans.withColumn("scanned", F.lit(True)), "school", "left").join(browsers.withColumn("browsed", F.lit(True)), "school", "left").join(counted, "school", "left")
    return met.withColumn("status", school_status(F.col)).withColumn("contacts", F.coalesce("contacts", F.lit(0)).cast("long"))


def histogram(rows: DataFrame, column: str) -> DataFrame:
    """A10 as rows; :func:`histogram_map` makes the map."""
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def histogram_map(rows: DataFrame, column: str) -> DataFrame:
    return histogram(rows, column).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(column, "n")))).alias("counts"))


def run_rows(runs: DataFrame, pages: DataFrame) -> DataFrame:
    """Every run with its totals, finish and status.

    runs: run, started_at, finished_at, failure (a message, null if it ended); a
    run with a failure is FAILED whatever its pages say, one without an end
    RUNNING, others PARTIAL or COMPLETED; a run without pages has zeros.
    """
    totals = run_totals(pages, ["run"]).withColumnRenamed("status", "_status")
    met = runs.join(totals, "run", "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("pages", "verified", "unpaired", "ambiguous", "conflicts", "contacts_found", "errors")]
    status = F.when(F.col("failure").isNotNull(), "FAILED").when(F.col("finished_at").isNull(), "RUNNING").otherwise(F.coalesce("_status", F.lit("COMPLETED")))
    return met.select("run", "started_at", "finished_at", "failure", *counts, status.alias("status"))


def scope_blob(**values: Column) -> Column:
    """What a run was asked to do, as a JSON text; nulls are left out."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in values.items()]))


def batch_summary(rows: DataFrame, contacts: DataFrame, review: DataFrame) -> DataFrame:
    """The 13 metrics of a batch, one row.

    rows: a row a school (status, website, contacts, pages, browser_pages,
    profile_cards, opened_cards); contacts: school, email, person; review: items.
    """
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    schools = rows.agg(
        F.count(F.lit(1)).alias("registry_schools"), F.count_if(F.col("status") != "NOT_PROCESSED").alias("processed_schools"), F.count_if(F.coalesce(F.col("website"), F.lit("")) != "").alias("schools_with_web"),
        F.count_if(F.col("contacts") > 0).alias("schools_with_contacts"), *[total(c).alias(n) for c, n in (("pages", "static_pages"), ("browser_pages", "browser_pages"), ("profile_cards", "profile_cards"), ("opened_cards", "opened_profile_cards"))],
    )
    unique = contacts.agg(F.count(F.lit(1)).alias("contact_rows"), F.count_distinct("email").alias("unique_emails"), F.count_distinct("school", "person").alias("unique_people_in_schools"))
    items = review.agg(F.count(F.lit(1)).alias("review_items"))
    statuses = histogram_map(rows, "status").withColumnRenamed("counts", "statuses")
    out = schools.withColumn("_k", F.lit(1))
    for other in (unique, items, statuses):  # a row each
        out = out.join(other.withColumn("_k", F.lit(1)), "_k")
    return out.drop("_k")


def run_totals(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Sums by key; contacts found are verified, unpaired and ambiguous ones, without conflicts."""
    found = F.sum(F.col("verified") + F.col("unpaired") + F.col("ambiguous"))
    return pages.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("pages"), F.sum("verified").alias("verified"), F.sum("unpaired").alias("unpaired"), F.sum("ambiguous").alias("ambiguous"), F.sum("conflicts").alias("conflicts"),
        found.alias("contacts_found"), F.count_if(F.col("error").isNotNull()).alias("errors"), F.when(F.count_if(F.col("error").isNotNull()) > 0, "PARTIAL").otherwise("COMPLETED").alias("status"),
    )


def fetch_outcome(c) -> Column:
    """the error code of a fetch, null if it can be parsed."""
    return F.when(~c("robots_allowed"), "ROBOTS_DISALLOWED").when(c("exception").isNotNull(), c("exception")).when(~c("http_status").between(200, 299), "HTTP_ERROR").when(~is_html(c("content_type"), c("html")), "NON_HTML")


def is_html(content_type: Column, body: Column) -> Column:
    """by the declared type, else by how the text begins."""
    return F.coalesce(content_type.rlike("(?i)text/html|application/xhtml[+]xml"), F.lit(False)) | F.coalesce(body.rlike(r"(?is)^\s*(<!doctype\s+html|<html|<head|<body)"), F.lit(False))


def browser_reason(c) -> Column:
    """why a page goes to the browser, null if it does not."""
    return F.when(c("interactive"), "INTERACTIVE_PROFILES").when(c("js_shell"), "JAVASCRIPT_PAGE").when(c("staff") & (c("names") > c("contacts") + 2), "STAFF_COVERAGE_GAP")


def is_staff(url: Column, title: Column) -> Column:
    """Whether the address or title of a page speaks of staff."""
    return F.coalesce(text.fold(F.concat_ws(" ", url, title)).rlike(P.STAFF_PAGES), F.lit(False))


def browser_targets(pages: DataFrame, n: int = 3) -> DataFrame:
    """Site, url, reason, weight, rank of the n pages of each site that the browser opens first.

    pages: site, url, title, interactive, js_shell, names, contacts, profile_cards.
    Profile cards weigh 100 each, an address that speaks of staff 20; the earlier
    URL goes first on ties. A page is a target once.
    """
    c = F.col
    path = F.regexp_extract("url", "^[^/]*//[^/?#]*([^?#]*)", 1)
    weight = F.coalesce(c("profile_cards"), F.lit(0)) * 100 + F.when(path.rlike(f"(?i){P.BROWSER_PATHS}"), 20).otherwise(0)
    rows = pages.withColumn("staff", is_staff(c("url"), c("title"))).withColumn("reason", browser_reason(c)).filter("reason is not null")
    once = rows.groupBy("site", "url").agg(F.min("reason").alias("reason"), F.max(weight).cast("long").alias("weight"))
    rank = F.row_number().over(Window.partitionBy("site").orderBy(F.desc("weight"), "url"))
    return once.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= n)


def profile_coverage(captures: DataFrame) -> DataFrame:
    """A row per capture (capture, expected, names, observations, exhausted).

    An observation counts if its card was opened and shows the name found at
    its place. People without e-mail are listed only of a whole directory.
    """
    ok = F.filter("observations", lambda o: (o["status"] == "OPENED") & o["idx"].between(0, F.col("expected") - 1) & (o["published_name"] == o["card_name"]) & (F.get(F.col("names"), o["idx"]) == o["card_name"]))
    rows = captures.withColumn("_ok", ok)
    opened = F.size(F.array_distinct(F.transform("_ok", lambda o: o["idx"]))).cast("long")
    mailed = F.array_distinct(F.transform(F.filter("_ok", lambda o: F.size(o["emails"]) > 0), lambda o: o["published_name"]))
    people = F.array_distinct("names")
    checked = (F.col("expected") > 0) & (opened == F.col("expected")) & ~F.col("exhausted")
    return rows.select(
        "capture", F.col("expected").cast("long").alias("expected_cards"), opened.alias("opened_cards"), F.size(people).cast("long").alias("expected_people"), F.size(mailed).cast("long").alias("people_with_email"),
        F.when(checked, F.array_sort(F.array_except(people, mailed))).otherwise(F.array().cast("array<string>")).alias("without_email"),
        F.when(F.col("expected") == 0, "NO_PROFILE_CONTROLS").when(checked, "PROFILES_CHECKED").otherwise("PARTIAL").alias("status"),
    )
