"""Contacts: conflicts, winners, history, gates.

An observation has columns school, mailbox, person, source, observed_at and a
total order ``pos`` that replaces "first seen".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import policy as P
from ..functions import emails, names, text, urls
from ..sources.session import tasks
from .delivery import small

KEY = ["school", "mailbox"]


def conflicts(obs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Mailboxes with more than one person, with their number. Null persons do not count."""
    keys = keys or ["mailbox"]
    return obs.groupBy(*keys).agg(F.count_distinct("person").alias("persons")).filter("persons > 1")


def best_by_confidence(obs: DataFrame, keys: list[str] | None = None, first_seen: str | None = None) -> DataFrame:
    """One row for each mailbox of exactly one person: that of the highest confidence, the first on ties.

    first_seen names a column for the first time that the mailbox was observed
    (A14), taken in the same pass.
    """
    keys = keys or ["mailbox"]
    rest = [c for c in obs.columns if c not in keys]
    seen = [F.min("observed_at").alias(first_seen)] if first_seen else []
    best = obs.groupBy(*keys).agg(F.min("person").alias("_a"), F.max("person").alias("_b"), F.min_by(F.struct(*rest), F.struct(-F.col("confidence"), F.col("pos"))).alias("_w"), *seen)
    return best.filter("_a = _b").select(*keys, *[F.col(f"_w.{c}").alias(c) for c in rest], *([first_seen] if first_seen else []))


def first_with_unions(obs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Batch winner: the first row of each mailbox of one person, with all its sources and roles in first-seen order.

    Sightings are reduced to the first one of each (source, role) before they
    are put together, so a mailbox is gathered as its distinct values only.
    """
    keys = keys or ["mailbox"]
    rest = [c for c in obs.columns if c not in (*keys, "source", "role", "pos")]
    # pos, source and role travel once: in the winner's struct or the sighting's, not beside it
    first = F.min_by(F.struct("pos", *rest), "pos")
    kinds = obs.groupBy(*keys, "source", "role").agg(F.min("person").alias("_a"), F.max("person").alias("_b"), first.alias("_w"))
    all_ = F.sort_array(F.collect_list(F.struct("_w.pos", "source", "role"))).alias("_s")
    rows = kinds.groupBy(*keys).agg(F.min("_a").alias("_a"), F.max("_b").alias("_b"), F.min_by(F.struct("_w", "source", "role"), "_w.pos").alias("_w"), all_).filter("_a = _b")
    ordered = lambda c: F.array_distinct(F.transform("_s", lambda x: x[c]))
    columns = {"source": "_w.source", "role": "_w.role"}
    won = [F.col(columns.get(c, f"_w._w.{c}")).alias(c) for c in obs.columns if c not in keys]
    return rows.select(*keys, *won, ordered("source").alias("sources"), F.array_compact(ordered("role")).alias("roles"))


def sightings(obs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """rows_seen of each mailbox, evidence (distinct source and kind, neither null) and duplicates, the rest.

    Nearly all rows differ, so combining them before they are dealt would keep a
    whole split in one task's memory; they are dealt by what is counted, which
    also keeps a mailbox of many sightings from one task.
    """
    keys = keys or ["mailbox"]
    kinds = obs.select(*keys, "source", "kind").repartition(tasks(obs.sparkSession), *keys, "source", "kind").groupBy(*keys, "source", "kind").agg(F.count(F.lit(1)).alias("_n"))
    rows = kinds.groupBy(*keys).agg(F.sum("_n").alias("rows_seen"), F.count_if(F.col("source").isNotNull() & F.col("kind").isNotNull()).alias("evidence"))
    return rows.withColumn("duplicates", F.col("rows_seen") - F.col("evidence"))


def unique_occurrences(rows: DataFrame) -> DataFrame:
    """One row for each (e-mail, lower-cased context), a mail link first, then the earliest."""
    rest = [c for c in rows.columns if c != "email"]
    best = rows.groupBy(F.lower(text.strip(F.col("email"))).alias("email"), F.lower("context").alias("_c")).agg(F.min_by(F.struct(*rest), F.struct((F.col("kind") != "MAILTO"), F.col("pos"))).alias("_w"))
    return best.select("email", *[F.col(f"_w.{c}").alias(c) for c in rest])


def keep_last(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_w")).select(*keys, *[F.col(f"_w.{c}").alias(c) for c in rest])


def seen_span(obs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """First and last time seen, number of sightings and sorted sources of each key; sightings are counted by source first."""
    keys = keys or KEY
    by_source = obs.groupBy(*keys, "source").agg(F.min("observed_at").alias("_f"), F.max("observed_at").alias("_l"), F.count(F.lit(1)).alias("_n"))
    return by_source.groupBy(*keys).agg(F.min("_f").alias("first_seen"), F.max("_l").alias("last_seen"), F.sum("_n").alias("sightings"), F.array_sort(F.collect_list("source")).alias("sources"))


def merge_ledger(obs: DataFrame, ledger: DataFrame) -> DataFrame:
    """The new ledger (school, mailbox, person, collected_at, last_observed_at, suppressed, status, reason).

    A mailbox with more than one person, history included, is quarantined,
    which goes before suppression; suppressed ones stay so; others are
    confirmed and keep the date they were first collected. What the ledger
    holds and this run did not see is retained as it is.
    """
    new = obs.groupBy(*KEY).agg(F.min("person").alias("_lo"), F.max("person").alias("_hi"), F.min("observed_at").alias("_from"), F.max("observed_at").alias("_to"))
    old = ledger.select(*KEY, F.col("person").alias("_p"), F.col("collected_at").alias("_c"), F.col("last_observed_at").alias("_l"), F.coalesce("suppressed", F.lit(False)).alias("_s"), F.col("status").alias("_st"))
    both = new.join(old, KEY, "full_outer")
    seen = F.col("_lo").isNotNull()
    changed = seen & ((F.col("_lo") != F.col("_hi")) | (F.coalesce(F.col("_p"), F.col("_lo")) != F.col("_lo")))
    held = F.coalesce("_s", F.lit(False))
    reason = F.when(changed, "SHARED_OR_REASSIGNED_MAILBOX").when(seen & held, "SUPPRESSED_CONTACT")
    ok = seen & ~changed & ~held
    return both.select(
        *KEY,
        F.coalesce("_p", "_lo").alias("person"),
        F.coalesce("_c", "_from").alias("collected_at"),
        F.when(ok, F.col("_to")).otherwise(F.coalesce("_l", "_to")).alias("last_observed_at"),
        held.alias("suppressed"),
        F.when(changed, "REVIEW_REQUIRED").when(ok, "SOURCE_CONFIRMED").otherwise(F.coalesce("_st", F.lit("SOURCE_CONFIRMED"))).alias("status"),
        reason.alias("reason"),
    )


def newer(ledger: DataFrame, date: Column) -> DataFrame:
    """The ledger rows that were observed after the capture."""
    return ledger.filter(F.col("last_observed_at") > date)


def assert_not_newer(ledger: DataFrame, date: str) -> None:
    """A ledger from after the capture is an error."""
    if not newer(ledger, F.lit(date)).isEmpty():
        raise ValueError("the ledger is newer than the capture")


def upsert(current: DataFrame, incoming: DataFrame, key: str, keep: list[str]) -> DataFrame:
    """K5: incoming rows replace those of the same key, but for the columns to keep; other rows stay. The key is unique on both sides."""
    a, b = current.alias("a"), incoming.alias("b")
    met = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    new = F.col(f"b.{key}").isNotNull()

    def one(c: str) -> Column:
        if c == key:
            return F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}")).alias(c)
        if c in keep:
            return F.col(f"a.{c}").alias(c)
        return F.when(new, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c)

    return met.select(*[one(c) for c in current.columns])


def observation_errors(o: str = "o", s: str = "s", date: Column | None = None) -> Column:
    """The error codes of an observation (columns o.*) at its school (s.*, left-joined); empty if it is accepted."""
    c = lambda name: F.col(f"{o}.{name}")
    k = lambda name: F.col(f"{s}.{name}")
    blank = lambda x: F.coalesce(text.strip(x) == "", F.lit(True))
    mail = emails.normalize_published(c("email"))
    named = ~blank(c("first_name")) & ~blank(c("last_name"))
    word = "^[\\p{L}\\p{M}][\\p{L}\\p{M}\\s’'-]*$"
    low = lambda x: F.split(F.lower(text.squeeze(x)), " ")
    noise = F.array(*map(F.lit, P.NAME_NOISE))
    source_ok, site_ok = urls.public_http(c("source_url")), urls.public_http(k("website"))
    checks = (
        (blank(k("name")) | blank(k("address")) | ~F.coalesce(k("type").isin("ZŠ", "SŠ", "ZŠ+SŠ"), F.lit(False)), "INCOMPLETE_SCHOOL"),
        (F.coalesce((k("scope") != "Praha") | ~k("address").rlike("(?iu)Praha|Prague") | k("address").rlike("(?iu)Praha\\s*[-–—]\\s*(východ|západ)"), F.lit(True)), "OUTSIDE_SCOPE"),
        (~site_ok | ~urls.public_http(k("address_source_url")), "INVALID_SCHOOL_SOURCE"),
        (~source_ok, "INVALID_CONTACT_SOURCE"),
        (source_ok & site_ok & ~urls.same_site(k("website"), c("source_url")), "NON_OFFICIAL_CONTACT_SOURCE"),
        (~named, "MISSING_NAME"),
        (named & ~(c("first_name").rlike(word) & c("last_name").rlike(word)), "INVALID_NAME"),
        (named & F.arrays_overlap(F.concat(low(c("first_name")), low(c("last_name"))), noise), "NON_PERSON_NAME"),
        (named & ~names.in_evidence(c("first_name"), c("last_name"), c("published_name")), "NAME_NOT_IN_EVIDENCE"),
        (~emails.valid(mail, "pilot"), "INVALID_EMAIL_SYNTAX"),
        (mail != emails.normalize_published(c("published_email")), "EMAIL_NOT_PUBLISHED"),
        (F.split_part(mail, F.lit("@"), F.lit(1)).isin(*P.GENERIC["pilot"]), "GENERIC_MAILBOX"),
        (F.exists(F.coalesce(c("alternate_emails"), F.array().cast("array<string>")), lambda e: emails.normalize_published(e) != mail), "CONFLICTING_PUBLISHED_EMAILS"),
        (~F.coalesce(c("reviewed"), F.lit(False)), "SOURCE_REVIEW_REQUIRED"),
        (ended(c("valid_until"), date), "EXPIRED_ASSOCIATION"),
        (unbegun(c("valid_from"), date), "FUTURE_ASSOCIATION"),
    )
    codes = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), code) for bad, code in checks]))
    return F.when(k("key").isNull(), F.array(F.lit("UNKNOWN_SCHOOL"))).otherwise(codes)


def ended(until: Column, date: Column) -> Column:
    """an end that is no date, or before the date; an open one is not."""
    return F.coalesce((until != "") & (~text.valid_date(until) | (until < date)), F.lit(False))


def unbegun(since: Column, date: Column) -> Column:
    return F.coalesce((since != "") & (~text.valid_date(since) | (since > date)), F.lit(False))


def accept_reviewed(obs: DataFrame, schools: DataFrame, date: str) -> tuple[DataFrame, DataFrame]:
    """PI4 with J6: (accepted observations, rejected ones with their reason)."""
    met = obs.alias("o").join((F.broadcast(schools) if small(schools) else schools).alias("s"), F.col("o.school_key") == F.col("s.key"), "left")
    judged = met.select("o.*", observation_errors(date=F.lit(date)).alias("_errors"))
    return judged.filter(F.size("_errors") == 0).drop("_errors"), judged.filter(F.size("_errors") > 0).withColumn("reason", F.array_join("_errors", "; ")).drop("_errors")


def batch_reason(c) -> Column:
    """why a batch contact is not exported, null if it is."""
    missing = F.lit(False)
    for name in ("first_name", "last_name", "website", "source", "evidence"):
        missing = missing | F.coalesce(c(name) == "", F.lit(True))
    return F.when(missing | ~emails.valid(c("email"), "batch"), "INCOMPLETE_RECORD").when(~names.in_evidence(c("first_name"), c("last_name"), c("evidence"), "batch"), "NAME_EVIDENCE_MISMATCH")


def block_reason(c) -> Column:
    """why an e-mail found in a block is quarantined."""
    return (
        F.when((c("visible_email") != "") & (c("link_email") != "") & (c("visible_email") != c("link_email")), "LINK_TEXT_CONFLICT")
        .when((c("people") != 1) | c("foreign"), "AMBIGUOUS_BLOCK")
        .when(c("evidence").rlike(f"(?iu){P.SERVICE_WORDS}"), "EXTERNAL_SERVICE_CONTACT")
        .when(emails.is_generic(c("email"), "batch"), "GENERAL_MAILBOX")
    )


def prune_review(review: DataFrame, accepted: DataFrame) -> DataFrame:
    """Review items of accepted mailboxes go unless they tell of a conflict; the last of equal ones stays. F21: nameless noise goes."""
    noise = F.coalesce(F.col("name") == "", F.lit(True)) & F.col("reason").isin("EMAIL_WITHOUT_PERSON", "GENERAL_MAILBOX")
    items = review.filter(~F.coalesce(noise, F.lit(False)))
    sticky = F.coalesce(F.col("reason"), F.lit("")).rlike(P.STICKY_REASONS)
    free = items.filter(F.col("email").isNull() | sticky)
    bound = items.filter(F.col("email").isNotNull() & ~sticky).join(accepted.select("school", "email").distinct(), ["school", "email"], "left_anti")
    merged = free.unionByName(bound.select(*free.columns))
    return keep_last(merged.withColumn("_who", F.coalesce("email", "name", F.lit(""))), ["school", "_who", "reason", "url"], ["pos"]).drop("_who")
