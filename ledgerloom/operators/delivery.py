"""Exports and compact forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import emails
from ..sources.session import checkpoint


def ranked(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """rows with their rank from 1 in a total order.

    Rows are range-sorted and checkpointed, so ranges stand; a row's rank is its
    place in its range after the rows of the ranges before, whose sizes are one
    number a range. The order must be total, or ranks of ties may differ
    between runs.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = {f"_o{n}": c for n, c in enumerate(order)}
    ranged = checkpoint(rows.withColumns(keys).repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop(*keys))
    placed = ranged.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over one row a range
    starts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).select("_part", "_start")
    return placed.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).drop("_part", "_at", "_start")


def czech(c: Column) -> Column:
    """The value in Czech order, for sorting only."""
    return F.collate(c, "cs")


def export_rows(contacts: DataFrame, schools: DataFrame, names: tuple[str, ...] = ("school_name",)) -> DataFrame:
    """Contacts of schools with a verified website, ranked by school (and other names) in Czech order, then person and mailbox."""
    usable = schools.filter("website is not null")
    met = contacts.join(F.broadcast(usable) if small(usable) else usable, "school")
    return ranked(met, [*[czech(F.col(n)) for n in names], F.col("person"), F.col("mailbox")])


def small(rows: DataFrame, most: int = 64 << 20) -> bool:
    """Whether the optimizer's own estimate of the rows' size is below a bound, so that they may be broadcast."""
    return int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= most


def dictionary(rows: DataFrame, value: str, order: str) -> DataFrame:
    """(value, code) with codes from 0 by first appearance."""
    firsts = rows.groupBy(value).agg(F.min(order).alias("_p"))
    return ranked(firsts, [F.col("_p"), F.col(value)], "code").select(value, (F.col("code") - 1).alias("code"))


#: The ways that a contact is found, by their code.
METHODS = ("STATIC_MAILTO", "STATIC_TEXT", "BROWSER_VISIBLE_DOM", "BROWSER_PROFILE_CARD")


def encode_delivery(contacts: DataFrame, sources: str = "source") -> dict[str, DataFrame]:
    """Contacts (school, first_name, last_name, email, source, method) as tables of codes.

    ``firsts``, ``domains`` and ``sources`` are dictionaries by first appearance in
    the order of (school, last_name, first_name, email); ``contacts`` holds codes,
    the last name and either the number of the e-mail pattern or the local part.
    """
    rows = contacts.select("school", "first_name", "last_name", F.regexp_extract("email", "^(.*)@", 1).alias("_local"), F.substring_index("email", "@", -1).alias("_domain"), "email", F.col(sources).alias("_source"), "method")
    order = F.struct("school", "last_name", "first_name", "email")
    out, coded = {}, rows
    for name, column in (("firsts", "first_name"), ("domains", "_domain"), ("sources", "_source")):
        table = dictionary(rows.withColumn("_order", order).select(F.col(column).alias("value"), "_order"), "value", "_order")
        out[name] = table
        coded = coded.join(table.select(F.col("value").alias(column), F.col("code").alias(f"{name}_code")), column)
    code = emails.pattern_code(F.col("first_name"), F.col("last_name"), F.col("_local")).cast("int")
    method = F.array_position(F.array(*map(F.lit, METHODS)), F.col("method")) - 1
    out["contacts"] = coded.select("school", "firsts_code", "last_name", code.alias("pattern"), F.when(code.isNull(), F.col("_local")).alias("local"), "domains_code", "sources_code", method.cast("int").alias("method"))
    return out


def decode_delivery(tables: dict[str, DataFrame]) -> DataFrame:
    """The contacts of :func:`encode_delivery` again."""
    rows = tables["contacts"]
    for name, column in (("firsts", "first_name"), ("domains", "_domain"), ("sources", "source")):
        rows = rows.join(tables[name].select(F.col("code").alias(f"{name}_code"), F.col("value").alias(column)), f"{name}_code")
    local = F.coalesce("local", emails.pattern_local(F.col("first_name"), F.col("last_name"), F.col("pattern")))
    return rows.select("school", "first_name", "last_name", F.concat(local, F.lit("@"), F.col("_domain")).alias("email"), "source", F.element_at(F.array(*map(F.lit, METHODS)), F.col("method") + 1).alias("method"))
