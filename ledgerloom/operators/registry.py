"""Registry snapshots to schools."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import registry as R
from ..functions.text import clean, valid_date

ADDRESS = "struct<ulice:string,castObce:string,cisloDomovni:string,cisloOrientacni:string,dodatekOrientacnihoCisla:string,obec:string,psc:string>"
SUBJECT = f"struct<redIzo:string,ico:string,kraj:string,uplnyNazev:string,adresa:{ADDRESS},emaily:array<string>,reditel:struct<nazevOsoby:string>,skolyAZarizeni:array<struct<izo:string,uplnyNazev:string,druh:string>>>"
PAYLOAD = f"struct<datumVystupu:string,list:array<{SUBJECT}>>"


def subjects(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """A row per subject of JSON payloads; a payload without a date or list is an error when it is read."""
    parsed = payloads.select(F.from_json(F.col(column), PAYLOAD).alias("p"))
    bad = F.col("p.list").isNull() | ~F.coalesce(valid_date(F.col("p.datumVystupu")), F.lit(False))
    checked = parsed.select(F.col("p.datumVystupu").alias("snapshot"), F.when(bad, F.raise_error(F.lit("not a registry payload"))).otherwise(F.col("p.list")).alias("list"))
    return checked.select("snapshot", F.explode("list").alias("s"))


def parse(rows: DataFrame, region: str = "Neznámý kraj") -> DataFrame:
    """subjects as schools with a column reject_reason, null for accepted ones (F1 drops the others)."""
    s = lambda name: F.col(f"s.{name}")
    a = lambda name: F.col(f"s.adresa.{name}")
    street = R.street(a("ulice"), a("castObce"), a("cisloDomovni"), a("cisloOrientacni"), a("dodatekOrientacnihoCisla"))
    city, postal = clean(a("obec")), R.postal_code(clean(a("psc")))
    full = R.full_address(street, postal, city)
    kind = R.classify(F.transform(s("skolyAZarizeni"), lambda u: clean(u["druh"])))
    mails = F.array_distinct(F.transform(F.array_compact(F.transform(F.coalesce(s("emaily"), F.array().cast("array<string>")), clean)), F.lower))
    ico, name = clean(s("ico")), clean(s("uplnyNazev"))
    reason = F.when(ico.isNull(), "NO_ICO").when(name.isNull(), "NO_NAME").when(kind.isNull(), "NOT_A_SCHOOL").when(city.isNull(), "NO_CITY").when(full.isNull(), "NO_ADDRESS")
    return rows.select(
        R.registry_key(s("redIzo"), s("ico")).alias("registry_id"), name.alias("name"), kind.alias("school_type"), F.coalesce(clean(s("kraj")), F.lit(region)).alias("region"),
        street.alias("street"), city.alias("city"), postal.alias("postal_code"), full.alias("address"), ico.alias("ico"), clean(s("redIzo")).alias("red_izo"), mails.alias("emails"),
        clean(s("reditel.nazevOsoby")).alias("director"), F.col("snapshot").cast("date").alias("snapshot_date"), reason.alias("reject_reason"),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter("reject_reason is null").drop("reject_reason")


def summary(schools: DataFrame) -> DataFrame:
    """A3: one row of counts."""
    of = lambda k: F.count_if(F.col("school_type") == k)
    return schools.agg(
        F.count(F.lit(1)).alias("total"), of("PRIMARY").alias("primary_schools"), of("SECONDARY").alias("secondary_schools"), of("PRIMARY_AND_SECONDARY").alias("both_schools"),
        F.count_if(F.size("emails") > 0).alias("with_emails"), F.count_if(F.col("director").isNotNull()).alias("with_director"),
    )


def import_counts(incoming: DataFrame, existing: DataFrame, key: str, kind: str) -> DataFrame:
    """Created and updated rows by type."""
    known = existing.select(key).distinct().withColumn("_known", F.lit(True))
    return incoming.join(known, key, "left").groupBy(kind).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("_known").isNull()).alias("created"), F.count_if("_known").alias("updated"))
