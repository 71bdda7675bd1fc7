"""Queries over counts and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from .catalogue import query
from .fixtures import read

_STATUS = """school_rows AS (SELECT s.school AS school, CASE WHEN sc.school IS NULL THEN 'NOT_PROCESSED' WHEN coalesce(sc.website, '') = '' THEN 'WEB_UNRESOLVED' WHEN browser_targets > 0 AND b.school IS NULL THEN 'BROWSER_PENDING' WHEN notes > 0 THEN 'PARTIAL_COVERAGE'
  WHEN profiles > 0 AND profiles_checked THEN 'PROFILE_DIRECTORY_CHECKED' WHEN coalesce(n, 0) > 0 THEN 'SOURCES_SCANNED_COMPLETENESS_UNCONFIRMED' ELSE 'NO_PERSONAL_CONTACTS' END AS status, coalesce(n, 0) AS contacts, sc.website AS website
  FROM fx_school s LEFT JOIN (SELECT school, website, school % 4 AS browser_targets, CAST(school % 5 = 0 AS INT) AS notes FROM fx_school WHERE school % 6 <> 0) sc ON s.school = sc.school
  LEFT JOIN (SELECT school, school % 7 AS profiles, school % 2 = 0 AS profiles_checked FROM fx_school WHERE school % 3 = 1) b ON s.school = b.school
  LEFT JOIN (SELECT o_custkey AS school, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) c ON s.school = c.school)"""


def _rows(spark, sf):
    s = read(spark, sf, "fx_school")
    scans = s.filter("school % 6 != 0").selectExpr("school", "website", "school % 4 AS browser_targets", "cast(school % 5 = 0 AS INT) AS notes", "0 AS remaining")
    browsers = s.filter("school % 3 = 1").selectExpr("school", "school % 7 AS profiles", "school % 2 = 0 AS profiles_checked")
    contacts = read(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("school"))
    return M.school_rows(s.select("school"), scans, browsers, contacts)


@query("SELECT school, status, contacts FROM school_rows", "fx_school", _STATUS)
def school_status(spark, sf):
    return _rows(spark, sf).select("school", "status", "contacts")


@query("SELECT status, count(*) AS n FROM school_rows GROUP BY 1", "fx_school", _STATUS)
def status_histogram(spark, sf):
    # the map of A10, read back as rows
    return M.histogram_map(_rows(spark, sf), "status").select(F.explode("counts").alias("status", "n"))


_BATCH = """batch_rows AS (SELECT school_rows.*, school % 9 AS pages, CASE WHEN school % 3 = 1 THEN school % 2 ELSE 0 END AS browser_pages, CASE WHEN school % 3 = 1 THEN school % 7 ELSE 0 END AS profile_cards, CASE WHEN school % 3 = 1 THEN school % 7 - CAST(school % 7 > 0 AND school % 2 = 1 AS INT) ELSE 0 END AS opened_cards FROM school_rows),
batch_contacts AS (SELECT o_custkey AS school, 'm' || (o_orderkey % 997) || '@example.org' AS email, o_orderpriority AS person FROM orders WHERE o_orderstatus = 'F'),
batch_review AS (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')"""


@query(
    """SELECT count(*) AS registry_schools, count_if(status <> 'NOT_PROCESSED') AS processed_schools, count_if(coalesce(website, '') <> '') AS schools_with_web, count_if(contacts > 0) AS schools_with_contacts, (SELECT count(*) FROM batch_contacts) AS contact_rows,
    (SELECT count(DISTINCT email) FROM batch_contacts) AS unique_emails, (SELECT count(DISTINCT (school, person)) FROM batch_contacts) AS unique_people_in_schools, (SELECT count(*) FROM batch_review) AS review_items,
    CAST(sum(pages) AS BIGINT) AS static_pages, CAST(sum(browser_pages) AS BIGINT) AS browser_pages, CAST(sum(profile_cards) AS BIGINT) AS profile_cards, CAST(sum(opened_cards) AS BIGINT) AS opened_profile_cards,
    (SELECT string_agg(status || '=' || n, ' ' ORDER BY status) FROM (SELECT status, count(*) AS n FROM batch_rows GROUP BY 1)) AS statuses FROM batch_rows""",
    "fx_school",
    f"{_STATUS},\n{_BATCH}",
)
def batch_summary(spark, sf):
    """All 13 metrics, one row."""
    k = F.col("school")
    browsed = lambda c: F.when(k % 3 == 1, c).otherwise(0)
    rows = _rows(spark, sf).withColumns({"pages": k % 9, "browser_pages": browsed(k % 2), "profile_cards": browsed(k % 7), "opened_cards": browsed(k % 7 - F.when((k % 7 > 0) & (k % 2 == 1), 1).otherwise(0))})
    orders = read(spark, sf, "orders")
    contacts = orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("school"), F.concat(F.lit("m"), (F.col("o_orderkey") % 997).cast("string"), F.lit("@example.org")).alias("email"), F.col("o_orderpriority").alias("person"))
    out = M.batch_summary(rows, contacts, orders.filter("o_orderstatus <> 'F'"))
    return out.withColumn("statuses", F.array_join(F.transform(F.map_entries("statuses"), lambda e: F.concat_ws("=", e["key"], e["value"])), " "))


_PAGES = "pages_seen AS (SELECT l_suppkey % 50 AS school, l_suppkey % 5 AS run, l_linenumber AS verified, l_partkey % 3 AS unpaired, l_partkey % 2 AS ambiguous, CAST(l_partkey % 17 = 0 AS INT) AS conflicts, CASE WHEN l_suppkey % 5 = 2 AND l_partkey % 19 = 0 THEN 'HTTP_ERROR' END AS error FROM lineitem)"
_ROLL = "count(*) AS pages, CAST(sum(verified) AS BIGINT) AS verified, CAST(sum(unpaired) AS BIGINT) AS unpaired, CAST(sum(ambiguous) AS BIGINT) AS ambiguous, CAST(sum(conflicts) AS BIGINT) AS conflicts, CAST(sum(verified + unpaired + ambiguous) AS BIGINT) AS contacts_found, count_if(error IS NOT NULL) AS errors, CASE WHEN count_if(error IS NOT NULL) > 0 THEN 'PARTIAL' ELSE 'COMPLETED' END AS status"


def _pages(spark, sf):
    return read(spark, sf, "lineitem").selectExpr(
        "l_suppkey % 50 AS school", "l_suppkey % 5 AS run", "l_linenumber AS verified", "l_partkey % 3 AS unpaired", "l_partkey % 2 AS ambiguous", "cast(l_partkey % 17 = 0 AS INT) AS conflicts", "CASE WHEN l_suppkey % 5 = 2 AND l_partkey % 19 = 0 THEN 'HTTP_ERROR' END AS error"
    )


@query(f"SELECT run, {_ROLL} FROM pages_seen GROUP BY run", "", _PAGES)
def run_rollup(spark, sf):
    return M.run_totals(_pages(spark, sf), ["run"])


@query(f"SELECT school, {_ROLL} FROM pages_seen GROUP BY school", "", _PAGES)
def school_rollup(spark, sf):
    return M.run_totals(_pages(spark, sf), ["school"])


@query(
    """SELECT count(*) AS total, count_if(school_type = 'PRIMARY') AS primary_schools, count_if(school_type = 'SECONDARY') AS secondary_schools, count_if(school_type = 'PRIMARY_AND_SECONDARY') AS both_schools, count_if(website_status = 'VERIFIED') AS verified_websites FROM fx_school""",
    "fx_school",
)
def stats_counts(spark, sf):
    """A1, A2: one pass."""
    of = lambda k: F.count_if(F.col("school_type") == k)
    return read(spark, sf, "fx_school").agg(F.count(F.lit(1)).alias("total"), of("PRIMARY").alias("primary_schools"), of("SECONDARY").alias("secondary_schools"), of("PRIMARY_AND_SECONDARY").alias("both_schools"), F.count_if(F.col("website_status") == "VERIFIED").alias("verified_websites"))


@query("SELECT region, count(*) AS attempted, count_if(website_status = 'VERIFIED') AS verified, count_if(website_status <> 'VERIFIED') AS unresolved FROM fx_school GROUP BY region", "fx_school")
def resolution_totals(spark, sf):
    """A5."""
    ok = F.col("website_status") == "VERIFIED"
    return read(spark, sf, "fx_school").groupBy("region").agg(F.count(F.lit(1)).alias("attempted"), F.count_if(ok).alias("verified"), F.count_if(~ok).alias("unresolved"))


def _coverage(spark, sf):
    rows = read(spark, sf, "fx_profile")
    seen = F.struct(F.col("idx"), "card_name", "published_name", "status", F.array_compact(F.array("mail")).alias("emails"))
    return M.profile_coverage(rows.groupBy("capture", "expected", F.split("names", "[|]").alias("names"), "exhausted").agg(F.sort_array(F.collect_list(seen)).alias("observations")))


@query(
    """SELECT capture, CAST(expected AS BIGINT) AS expected_cards, count(DISTINCT idx) FILTER (ok) AS opened_cards, count(DISTINCT published_name) FILTER (ok AND mail IS NOT NULL) AS people_with_email,
    CASE WHEN expected = 0 THEN 'NO_PROFILE_CONTROLS' WHEN count(DISTINCT idx) FILTER (ok) = expected AND NOT exhausted THEN 'PROFILES_CHECKED' ELSE 'PARTIAL' END AS status
    FROM (SELECT *, status = 'OPENED' AND published_name = card_name AND string_split(names, '|')[idx + 1] = card_name AS ok FROM fx_profile) GROUP BY capture, expected, exhausted""",
    "fx_profile",
)
def profile_coverage(spark, sf):
    return _coverage(spark, sf).select("capture", "expected_cards", "opened_cards", "people_with_email", "status")


@query("SELECT capture, person FROM (SELECT DISTINCT capture, unnest(string_split(names, '|')) AS person FROM fx_profile WHERE capture IN ('p1', 'p4')) p WHERE NOT EXISTS (SELECT 1 FROM fx_profile f WHERE f.capture = p.capture AND f.published_name = p.person AND f.mail IS NOT NULL)", "fx_profile")
def people_without_email(spark, sf):
    return _coverage(spark, sf).select("capture", F.explode("without_email").alias("person"))


_RUNS = "runs AS (SELECT s_suppkey % 12 AS run, min(s_suppkey) AS started_at, CASE WHEN s_suppkey % 12 <> 7 THEN max(s_suppkey) END AS finished_at, CASE WHEN s_suppkey % 12 IN (3, 11) THEN 'TIMEOUT' END AS failure FROM supplier GROUP BY s_suppkey % 12)"


@query(
    f"""SELECT r.run AS run, started_at, finished_at, failure, coalesce(pages, 0) AS pages, coalesce(contacts_found, 0) AS contacts_found, coalesce(errors, 0) AS errors,
    CASE WHEN failure IS NOT NULL THEN 'FAILED' WHEN finished_at IS NULL THEN 'RUNNING' WHEN coalesce(errors, 0) > 0 THEN 'PARTIAL' ELSE 'COMPLETED' END AS status FROM runs r LEFT JOIN (SELECT run, {_ROLL} FROM pages_seen GROUP BY run) p ON r.run = p.run""",
    "",
    f"{_PAGES},\n{_RUNS}",
)
def run_lifecycle(spark, sf):
    """Runs with their totals: FAILED, RUNNING, PARTIAL or COMPLETED."""
    run = (F.col("s_suppkey") % 12).alias("run")
    rows = read(spark, sf, "supplier").groupBy(run).agg(F.min("s_suppkey").alias("started_at"), F.max("s_suppkey").alias("finished_at"))
    rows = rows.withColumns({"finished_at": F.when(F.col("run") != 7, F.col("finished_at")), "failure": F.when(F.col("run").isin(3, 11), "TIMEOUT")})
    return M.run_rows(rows, _pages(spark, sf)).select("run", "started_at", "finished_at", "failure", "pages", "contacts_found", "errors", "status")
