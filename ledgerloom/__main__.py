"""Commands: python -m ledgerloom COMMAND ... (see --help). Everything reads and writes files; nothing uses a network."""

from __future__ import annotations

import argparse
import datetime
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import policy as P
from .operators.delivery import encode_delivery
from .plans import pipelines as J
from .plans import scan as S
from .sources import readers, sinks

LEDGER = "school string, mailbox string, person string, collected_at date, last_observed_at date, suppressed boolean, status string"
ORDER = ["school_name", "last_name", "first_name", "email"]
COLUMNS = ["first_name", "last_name", "email", "school_name", "school_address", "school_website", "collected_at"]


def positive(value: str) -> int:
    """O8."""
    n = int(value)
    if n < 1:
        raise argparse.ArgumentTypeError("must be a positive integer")
    return n


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerloom", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, text: str, *required: str, **optional) -> None:
        c = sub.add_parser(name, help=text)
        for r in required:
            c.add_argument(f"--{r}", required=True)
        for o, kind in optional.items():
            c.add_argument(f"--{o.replace('_', '-')}", **({"action": "store_true"} if kind is bool else {"type": kind}))

    add("health", "whether a session starts")
    add("import-schools", "merge a registry snapshot into the schools table", "snapshot", "output", current=str, dry_run=bool)
    add("stats", "counts of the schools table", "schools")
    add("resolve-websites", "verify websites by captured pages", "schools", "pages", "output", limit=positive, dry_run=bool)
    add("extract", "contacts and review items of captured pages", "schools", "pages", "output", robots=str)
    add("scan", "websites confirmed, crawled best-first and read from captured pages", "schools", "pages", "output", robots=str, portal=str, maps=str, budget=positive, given_names=str)
    add("crawl", "the websites that are verified already, crawled and read from captured pages", "schools", "pages", "output", robots=str, maps=str, budget=positive, region=str, limit=positive, given_names=str)
    add("crawl-url", "one website crawled and read from captured pages", "url", "pages", "output", robots=str, maps=str, budget=positive, given_names=str)
    add("reparse", "the pages of an earlier scan read anew from their captures", "schools", "scan", "pages", "output", given_names=str)
    add("delivery", "a contact table as a compact coded delivery", "contacts", "output")
    add("batch-export", "gate, ledger, statuses and the contact file of captured pages", "schools", "pages", "output", robots=str, previous=str)
    add("export-csv", "a contact table as a file", "contacts", "output", policy=str)
    add("reviewed-export", "a reviewed capture through the strict gate", "input", "output", previous=str)
    return p


def _ledger(spark: SparkSession, path: str | None) -> DataFrame:
    return spark.read.parquet(path) if path else spark.createDataFrame([], LEDGER)


def run(argv: list[str], spark: SparkSession) -> dict:
    """Runs a command; gives what it reports."""
    a = parser().parse_args(argv)
    read = spark.read.parquet
    if a.command == "health":
        return {"status": "ok", "spark": spark.version}
    if a.command == "import-schools":
        payloads = spark.read.text(a.snapshot, wholetext=True).withColumnRenamed("value", "payload")
        schools, counts = J.import_schools(payloads, read(a.current) if a.current else None)
        if not a.dry_run:
            schools.write.mode("errorifexists").parquet(a.output)
        return {"types": [r.asDict() for r in counts.orderBy("school_type").collect()], "dry_run": a.dry_run}
    if a.command == "stats":
        s = read(a.schools)
        row = s.agg(F.count(F.lit(1)).alias("schools"), F.count_if(F.col("website_status") == "VERIFIED").alias("verified"), *[F.count_if(F.col("school_type") == t).alias(t.lower()) for t in ("PRIMARY", "SECONDARY", "PRIMARY_AND_SECONDARY")])
        return json.loads(sinks.report(row))
    if a.command == "resolve-websites":
        schools = read(a.schools)
        if a.limit:
            wanted = readers.unresolved(schools.withColumn("school", F.col("registry_id")), a.limit).select("registry_id")
            rest = schools.join(wanted, "registry_id", "left_anti")
            schools = schools.join(wanted, "registry_id", "left_semi")
        done, verdicts = J.resolve_websites(schools, read(a.pages))
        if not a.dry_run:
            (done.unionByName(rest) if a.limit else done).write.mode("errorifexists").parquet(a.output)
        row = verdicts.agg(F.count(F.lit(1)).alias("attempted"), F.count_if(F.col("status") == "VERIFIED").alias("verified"), F.count_if(F.col("status") != "VERIFIED").alias("unresolved"))
        return json.loads(sinks.report(row))
    if a.command == "export-csv":
        sinks.write_csv(read(a.contacts), a.output, COLUMNS, order=ORDER, policy=a.policy or "pilot")
        return {"output": a.output}
    if a.command == "reviewed-export":
        capture = readers.reviewed_capture(spark, a.input)
        date = capture.first()["collectionDate"]
        result = J.reviewed_export(capture, _ledger(spark, a.previous), date)
        audit = result.contacts.withColumns({"sources": F.array_join("sources", " | "), "last_observed_at": F.col("last_observed_at").cast("string")})
        sinks.write_csv(result.contacts, f"{a.output}/contacts", COLUMNS, order=ORDER)
        sinks.write_csv(audit, f"{a.output}/audit", [*COLUMNS, "role", "sources", "address_source_url", "last_observed_at"], (*sinks.HEADER, "Funkce", "Zdroj kontaktu", "Zdroj adresy", "Poslední kontrola"), ORDER)
        sinks.write_csv(result.schools.withColumn("contacts", F.col("contacts").cast("string")), f"{a.output}/schools", ["name", "type", "address", "website", "address_source_url", "contacts"], ("Škola", "Typ", "Adresa", "Web", "Zdroj adresy", "Potvrzené kontakty"), ["key"])
        sinks.write_csv(result.review, f"{a.output}/review", ["school", "name", "email", "reason", "url"], ("Klíč školy", "Jméno", "E-mail", "Důvod", "Zdroj"), ["school", "email", "reason"])
        return _finish(result, a.output)
    if a.command in ("scan", "crawl", "crawl-url", "reparse"):
        return _run_row(a, spark, _scan)
    if a.command == "delivery":
        rows = read(a.contacts)
        rows = rows.withColumnRenamed("mailbox", "email") if "email" not in rows.columns else rows
        for name, table in encode_delivery(rows.withColumn("source", F.get("sources", F.lit(0)))).items():
            table.write.mode("errorifexists").option("compression", "zstd").parquet(f"{a.output}/{name}")
        return {"contacts": rows.count(), "output": a.output}
    found = J.extract_contacts(read(a.schools), read(a.pages), read(a.robots) if a.robots else None)
    if a.command == "extract":
        for name in ("pages", "contacts", "review"):
            getattr(found, name).write.mode("errorifexists").parquet(f"{a.output}/{name}")
        return {"output": a.output}
    result = J.batch_export(read(a.schools), found, _ledger(spark, a.previous))
    sinks.write_csv(result.contacts, f"{a.output}/contacts", COLUMNS, order=ORDER)
    result.review.write.mode("errorifexists").parquet(f"{a.output}/review")
    return _finish(result, a.output)


def _run_row(a: argparse.Namespace, spark: SparkSession, work) -> dict:
    """The command's work between its start and its end, kept as one row: COMPLETED, PARTIAL or FAILED."""
    started = datetime.datetime.now(datetime.timezone.utc).isoformat()
    status, report, failure = "FAILED", {}, None
    try:
        report = work(a, spark)
        status = report["status"]
        return report
    except Exception as e:
        failure = f"{type(e).__name__}: {e}"[:500]
        raise
    finally:
        row = (a.command, started, datetime.datetime.now(datetime.timezone.utc).isoformat(), status, failure, report.get("pages"), report.get("errors"), report.get("contacts"))
        spark.createDataFrame([row], "command string, started_at string, finished_at string, status string, failure string, pages long, errors long, contacts long").write.mode("append").parquet(f"{a.output}/runs")


def _scan(a: argparse.Namespace, spark: SparkSession) -> dict:
    """The crawling commands and the replay; a run row tells how it went."""
    table = lambda path: spark.read.parquet(path) if path else None
    given = [r["value"] for r in spark.read.text(a.given_names).collect()] if a.given_names else P.GIVEN_NAMES
    if a.command == "reparse":
        found, notes = S.reparse(table(f"{a.scan}/pages").filter("error is null"), table(a.pages), table(a.schools), given)
        notes.write.mode("errorifexists").parquet(f"{a.output}/notes")
    else:
        budget = a.budget or P.PAGE_BUDGET["batch"]
        if a.command == "crawl-url":
            schools = spark.range(1).select(F.lit("url").alias("registry_id"), F.lit(a.url).alias("website"), F.lit("").alias("name"))
        elif a.command == "crawl":
            schools = readers.crawlable(table(a.schools).withColumn("school", F.col("registry_id")), a.region, a.limit)
        else:
            schools = table(a.schools)
        known = None if a.command == "scan" else schools.select("registry_id", "website")
        scan = S.scan_sites(schools, table(a.pages), table(a.robots), table(a.portal) if a.command == "scan" else None, table(a.maps), budget, given, known)
        found = scan.extraction
        for name in ("verdicts", "targets", "errors"):
            getattr(scan, name).write.mode("errorifexists").parquet(f"{a.output}/{name}")
        found.counts.write.mode("errorifexists").parquet(f"{a.output}/counts")
    for name in ("pages", "contacts", "review"):
        getattr(found, name).write.mode("errorifexists").parquet(f"{a.output}/{name}")
    pages = spark.read.parquet(f"{a.output}/pages")
    row = pages.agg(F.count_if(F.col("error").isNull()).alias("pages"), F.count_if(F.col("error").isNotNull()).alias("errors"), F.when(F.count_if(F.col("error").isNotNull()) > 0, "PARTIAL").otherwise("COMPLETED").alias("status"))
    return json.loads(sinks.report(row)) | {"contacts": spark.read.parquet(f"{a.output}/contacts").count()}


def _finish(result: J.BatchResult, output: str) -> dict:
    """The ledger, the summary and the report; the ledger is what the next run takes as --previous."""
    result.ledger.write.mode("errorifexists").parquet(f"{output}/ledger")
    sinks.write_json(result.summary, f"{output}/summary")
    return json.loads(sinks.report(result.summary))


if __name__ == "__main__":
    import sys

    from .sources.session import local_session

    print(json.dumps(run(sys.argv[1:], SparkSession.getActiveSession() or local_session()), ensure_ascii=False))
