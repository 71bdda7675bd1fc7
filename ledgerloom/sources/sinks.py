"""Sinks (K1–K11, K13): spreadsheet files, JSON, append-only facts, versioned tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import policy as P
from ..functions.text import csv_cell

#: The header of the contact file.
HEADER = ("Jméno", "Příjmení", "E-mail", "Škola", "Adresa školy", "Web", "Datum sebrání")


def csv_lines(rows: DataFrame, columns: list[str], policy: str = "pilot"):
    """The line column: cells of the policy joined by semicolons."""
    return F.concat_ws(";", *[csv_cell(F.col(c), policy) for c in columns])


MOST_ROWS = 1_048_575  # rows that a spreadsheet holds below its header


def write_csv(rows: DataFrame, path: str, columns: list[str], header: tuple[str, ...] = HEADER, order: list[str] | None = None, policy: str = "pilot") -> None:
    """K1–K3: one file with byte order mark, CRLF ends and header, in the given order; an existing path is an error (classic and batch replace it).

    The file is what a person opens in a spreadsheet, so it is one ordered
    part, written by one task; more rows than a spreadsheet holds are an error.
    Use JSON or Parquet sinks for larger results.
    """
    spark = rows.sparkSession
    if rows.limit(MOST_ROWS + 1).count() > MOST_ROWS:
        raise ValueError(f"a spreadsheet holds {MOST_ROWS} rows")
    cells = [csv_cell(F.lit(h), P.check(policy)) for h in header]
    top = spark.range(1).select(F.concat(F.lit("﻿"), F.concat_ws(";", *cells)).alias("value"), F.lit(0).alias("_k"), *[F.lit(None).cast(rows.schema[c].dataType).alias(f"_o{n}") for n, c in enumerate(order or [])])
    body = rows.select(csv_lines(rows, columns, policy).alias("value"), F.lit(1).alias("_k"), *[F.col(c).alias(f"_o{n}") for n, c in enumerate(order or [])])
    keys = ["_k", *[f"_o{n}" for n in range(len(order or []))]]
    lines = top.unionByName(body).repartition(1).sortWithinPartitions(*keys).select("value")
    lines.write.mode("errorifexists" if policy == "pilot" else "overwrite").option("lineSep", "\r\n").text(path)


def write_json(rows: DataFrame, path: str) -> None:
    """K4."""
    rows.write.mode("errorifexists").json(path)


def append(rows: DataFrame, path: str, *partition: str) -> None:
    """K7, K8: append-only facts."""
    rows.write.mode("append").partitionBy(*partition).parquet(path)


def write_version(rows: DataFrame, root: str, version: int) -> str:
    """A whole new version beside the old ones; the commit protocol makes it visible at once or not at all."""
    path = f"{root}/v={version:08d}"
    rows.write.mode("errorifexists").parquet(path)
    return path


def set_websites(schools: DataFrame, verified: DataFrame) -> DataFrame:
    """Schools with the websites that were verified; others keep what they have."""
    new = verified.filter("status = 'VERIFIED'").select("school", F.col("website").alias("_w"))
    return schools.join(new, "school", "left").withColumn("website", F.coalesce("_w", "website")).withColumn("website_status", F.when(F.col("_w").isNotNull(), "VERIFIED").otherwise(F.col("website_status"))).drop("_w")


def report(summary: DataFrame) -> str:
    """A one-row summary as JSON."""
    return summary.select(F.to_json(F.struct("*")).alias("j")).first()["j"]


def union_all(*rows: DataFrame) -> DataFrame:
    """U1."""
    return reduce(lambda a, b: a.unionByName(b), rows)
