"""Queries over registry data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import registry as R
from ..operators import contacts as C
from ..operators import registry as G
from ..sources import readers as S
from .catalogue import query
from .fixtures import read


def _payloads(spark, sf):
    """A JSON payload per subject, built from the fixture and parsed like a snapshot."""
    rows = read(spark, sf, "fx_registry")
    subject = F.struct(
        F.col("red_izo").alias("redIzo"), "ico", F.lit("Hlavní město").alias("kraj"), F.col("name").alias("uplnyNazev"),
        F.struct(F.lit("Dlouhá").alias("ulice"), F.col("k").cast("string").alias("cisloDomovni"), F.col("city").alias("obec"), F.lit("11000").alias("psc")).alias("adresa"),
        F.array("mail", F.lower("mail")).alias("emaily"), F.struct(F.col("director").alias("nazevOsoby")).alias("reditel"),
        F.transform(F.split("kinds", ","), lambda d: F.struct(d.alias("druh"))).alias("skolyAZarizeni"),
    )
    return rows.select(F.to_json(F.struct(F.lit("2026-01-31").alias("datumVystupu"), F.array(subject).alias("list"))).alias("payload"))


_KIND = "CASE kinds WHEN 'B00' THEN 'PRIMARY' WHEN 'C00' THEN 'SECONDARY' WHEN 'B00,C00' THEN 'PRIMARY_AND_SECONDARY' END"
_PARSED = f"""parsed AS (SELECT coalesce(red_izo, 'ico:' || nullif(trim(ico), '')) AS registry_id, name, {_KIND} AS school_type, 'Dlouhá ' || k || ', 110 00' || coalesce(' ' || city, '') AS address, nullif(trim(ico), '') AS ico,
  lower(mail) AS mails, director, CASE WHEN trim(ico) = '' THEN 'NO_ICO' WHEN name IS NULL THEN 'NO_NAME' WHEN {_KIND} IS NULL THEN 'NOT_A_SCHOOL' WHEN city IS NULL THEN 'NO_CITY' END AS reject_reason FROM fx_registry)"""


def _parsed(spark, sf):
    return G.parse(G.subjects(_payloads(spark, sf)))


@query("SELECT registry_id, name, school_type, address, ico, coalesce(mails, '') AS mails, director FROM parsed WHERE reject_reason IS NULL", "fx_registry", _PARSED)
def registry_parse(spark, sf):
    return G.accepted(_parsed(spark, sf)).select("registry_id", "name", "school_type", "address", "ico", F.array_join("emails", " ").alias("mails"), "director")


@query("SELECT coalesce(reject_reason, 'ACCEPTED') AS reason, count(*) AS n FROM parsed GROUP BY 1", "fx_registry", _PARSED)
def registry_reject_reasons(spark, sf):
    return _parsed(spark, sf).groupBy(F.coalesce("reject_reason", F.lit("ACCEPTED")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT k, {_KIND} AS school_type FROM fx_registry", "fx_registry")
def registry_classify(spark, sf):
    return read(spark, sf, "fx_registry").select("k", R.classify(F.split("kinds", ",")).alias("school_type"))


@query(
    """SELECT count(*) AS total, count_if(school_type = 'PRIMARY') AS primary_schools, count_if(school_type = 'SECONDARY') AS secondary_schools, count_if(school_type = 'PRIMARY_AND_SECONDARY') AS both_schools,
    count_if(mails IS NOT NULL) AS with_emails, count_if(director IS NOT NULL) AS with_director FROM parsed WHERE reject_reason IS NULL""",
    "fx_registry",
    _PARSED,
)
def registry_summary(spark, sf):
    return G.summary(G.accepted(_parsed(spark, sf)))


_UPSERT = "old AS (SELECT school, name, region, website FROM fx_school WHERE school % 2 = 0), new AS (SELECT school + 1 AS school, name || '*' AS name, region, CAST(NULL AS VARCHAR) AS website FROM fx_school WHERE school % 3 = 0)"


def _old_new(spark, sf):
    rows = read(spark, sf, "fx_school")
    return rows.filter("school % 2 = 0").select("school", "name", "region", "website"), rows.filter("school % 3 = 0").selectExpr("school + 1 AS school", "concat(name, '*') AS name", "region", "cast(NULL AS STRING) AS website")


@query("SELECT coalesce(new.school, old.school) AS school, coalesce(new.name, old.name) AS name, coalesce(new.region, old.region) AS region, old.website AS website FROM old FULL JOIN new ON old.school = new.school", "fx_school", _UPSERT)
def school_upsert(spark, sf):
    old, new = _old_new(spark, sf)
    return C.upsert(old, new, "school", keep=["website"])


@query("SELECT region, count(*) AS total, count_if(old.school IS NULL) AS created, count_if(old.school IS NOT NULL) AS updated FROM (SELECT school, region FROM new) n LEFT JOIN (SELECT school FROM old) old USING (school) GROUP BY region".replace("old.school", "o.s").replace("LEFT JOIN (SELECT school FROM old) old USING (school)", "LEFT JOIN (SELECT school AS s FROM old) o ON n.school = o.s"), "fx_school", _UPSERT)
def import_counts(spark, sf):
    old, new = _old_new(spark, sf)
    return G.import_counts(new, old, "school", "region")


@query("""SELECT school, name FROM fx_school WHERE website_status = 'UNKNOWN' AND school_type IN ('PRIMARY', 'SECONDARY', 'PRIMARY_AND_SECONDARY') ORDER BY name COLLATE "C", school LIMIT 25""", "fx_school")
def select_unresolved(spark, sf):
    return S.unresolved(read(spark, sf, "fx_school"), 25).select("school", "name")


@query("SELECT school, name, website FROM fx_school WHERE website_status = 'VERIFIED' AND website IS NOT NULL AND region = 'R3' AND school_type <> 'OTHER'", "fx_school")
def select_crawlable(spark, sf):
    return S.crawlable(read(spark, sf, "fx_school"), region="R3").select("school", "name", "website")


@query("SELECT school, name FROM fx_school WHERE school IN (SELECT school * 2 FROM fx_school)", "fx_school")
def existing_ids(spark, sf):
    rows = read(spark, sf, "fx_school")
    return S.existing(rows, rows.select((F.col("school") * 2).alias("school")), "school").select("school", "name")
