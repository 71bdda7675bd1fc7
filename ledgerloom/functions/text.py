"""Text functions (P13–P18, P20–P24, P27): Catalyst expressions only."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import policy as P


def squeeze(c: Column) -> Column:
    """Runs of white space become one blank, ends trimmed."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def clean(c: Column) -> Column:
    """Trimmed text, null if blank; numbers as text."""
    return F.nullif(strip(c.cast("string")), F.lit(""))


def fold(c: Column) -> Column:
    """Lower case without diacritics."""
    return F.lower(F.translate(F.regexp_replace(c, "[\\u0300-\\u036f]", ""), P.FOLD_FROM, P.FOLD_TO))


def folded(s: str) -> str:
    """P14 of a constant."""
    return re.sub("[\u0300-\u036f]", "", s).translate(str.maketrans(P.FOLD_FROM, P.FOLD_TO)).lower()


def slug(c: Column) -> Column:
    """Folded, other characters as single hyphens."""
    return F.regexp_replace(F.regexp_replace(fold(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def comparison_key(c: Column) -> Column:
    """Folded, other characters as single blanks."""
    return F.trim(F.regexp_replace(fold(c), "[^a-z0-9]+", " "))


def html_text(c: Column) -> Column:
    """Folded text of HTML, only letters, digits, @ and dots."""
    t = F.regexp_replace(fold(c), "&nbsp;|&#160;", " ")
    for tag in ("script", "style"):
        t = F.regexp_replace(t, rf"(?s)<{tag}\b[^>]*>.*?</{tag}>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, "<[^>]+>", " "), "[^a-z0-9@.]+", " "))


def strip_titles(c: Column, policy: str = "batch") -> Column:
    """A name without academic titles (classic: only those before it)."""
    if P.check(policy) == "classic":
        return strip(F.regexp_replace(c, rf"(?i)^(?:(?:{P.TITLES})\.?\s+)+", ""))
    t = F.regexp_replace(squeeze(c), rf"(?i)^(?:(?:{P.TITLES_BEFORE})(?:\.\s*|\s+))+", "")
    return strip(F.regexp_replace(t, rf"(?i)(?:,?\s+(?:{P.TITLES_AFTER}))+$|\s*\([^)]*\)\s*$", ""))


def boundaries(c: Column) -> Column:
    """P20: a blank between a lower-case and an upper-case Czech letter."""
    return F.regexp_replace(c, f"([{P.LOWER}])([{P.UPPER}])", "$1 $2")


def first_role(c: Column) -> Column:
    """The role of the first pattern, in their order, that occurs."""
    out = None
    for pattern, role in P.CLASSIC_ROLES:
        hit = c.rlike(f"(?iu){pattern}")
        out = F.when(hit, role) if out is None else out.when(hit, role)
    return out


def all_roles(c: Column) -> Column:
    """All role words, distinct, joined by '; '."""
    return F.array_join(F.array_distinct(F.regexp_extract_all(c, F.lit(f"(?iu){P.BATCH_ROLES}"), F.lit(0))), "; ")


def confidence(kind: Column, role: Column, titled: Column) -> Column:
    """0.8, more for a mail link, a role and a title, at most 0.98."""
    total = F.lit(80) + F.when(kind == "MAILTO", 8).otherwise(0) + F.when(role.isNotNull(), 6).otherwise(0) + F.when(titled, 4).otherwise(0)
    return F.least(total, F.lit(98)) / F.lit(100.0)


def has_title(c: Column) -> Column:
    return c.rlike(rf"(?i)(?<![A-Za-z0-9_])(?:{P.TITLES})\.")


def sha256(c: Column) -> Column:
    """P27."""
    return F.sha2(c, 256)


def csv_cell(c: Column, policy: str = "pilot") -> Column:
    """A spreadsheet cell. classic: no formula guard; batch: guard; pilot: wider guard, always quoted."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    if P.check(policy) == "batch":
        text = F.when(text.rlike(r"^\s*[=+@-]"), F.concat(F.lit("'"), text)).otherwise(text)
    elif policy == "pilot":
        text = F.when(text.rlike("^[\\s\\ufeff]*[=+\\-@]") | text.rlike(r"^[\t\r\n]"), F.concat(F.lit("'"), text)).otherwise(text)
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return quoted if policy == "pilot" else F.when(text.rlike('[;"\r\n]'), quoted).otherwise(text)


def valid_date(c: Column) -> Column:
    """A real calendar date written YYYY-MM-DD."""
    return F.coalesce(c.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & c.try_cast("date").isNotNull(), F.lit(False))


def utc_date(ts: Column) -> Column:
    """P48, classic."""
    return F.date_format(ts, "yyyy-MM-dd")


def prague_date(ts: Column) -> Column:
    """P48, batch: the calendar date in Prague of a UTC time; the session's time zone does not matter."""
    return F.date_format(F.convert_timezone(F.lit("UTC"), F.lit("Europe/Prague"), ts.cast("timestamp_ntz")), "yyyy-MM-dd")


def positive_int(c: Column) -> Column:
    """The value of an option that must be a positive whole number, else null."""
    return F.when(c.rlike(r"^\s*[+]?[0-9]+\s*$") & (F.trim(c).try_cast("int") > 0), F.trim(c).try_cast("int"))


def regex_quote(c: Column) -> Column:
    """The text as a pattern that matches just it."""
    return F.regexp_replace(c, r"([.*+?^${}()|\[\]\\])", r"\\$1")


def chunks(values: Column, size: int) -> Column:
    """An array cut into arrays of ``size`` values, the last one shorter; an empty array has none."""
    n = F.size(values)
    starts = F.when(n > 0, F.sequence(F.lit(1), n, F.lit(size))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda at: F.slice(values, at, F.lit(size)))
