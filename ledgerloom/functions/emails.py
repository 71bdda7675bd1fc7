"""E-mail functions (P1–P12, P25) by policy: Catalyst expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import policy as P
from .text import fold, strip

_LABEL = "^[a-z0-9]([a-z0-9-]*[a-z0-9])?$"


def normalize(c: Column) -> Column:
    """P1."""
    return F.lower(strip(c))


def _local(c: Column) -> Column:
    return F.regexp_extract(c, "(?s)^(.*)@[^@]*$", 1)


def _local_ok(a: Column) -> Column:
    return (a != "") & (F.length(a) <= 64) & ~a.startswith(".") & ~a.endswith(".") & ~a.contains("..")


def valid(c: Column, policy: str = "pilot") -> Column:
    """P2 (classic), P3 (batch), P4 (pilot): whether an address is well formed; null is not."""
    if P.check(policy) == "classic":
        ok = normalize(c).rlike(r"^[^\s@]+@[^\s@]+\.[^\s@]+$")
    else:
        a, d = F.split_part(c, F.lit("@"), F.lit(1)), F.split_part(c, F.lit("@"), F.lit(2))
        labels = F.split(d, "[.]", -1)
        ok = (F.length(c) <= 254) & (F.length(c) - F.length(F.replace(c, F.lit("@"), F.lit(""))) == 1) & _local_ok(a) & d.contains(".")
        if policy == "batch":
            ok = ok & c.rlike("^[\\x21-\\x7e]*$") & ~c.rlike("[<>\"',;:]") & F.forall(labels, lambda x: F.lower(x).rlike(_LABEL))
        else:
            ok = ok & F.lower(a).rlike("^[a-z0-9.!#$%&'*+/=?^_`{|}~-]+$") & (F.length(d) <= 253)
            ok = ok & F.forall(labels, lambda x: (F.length(x) <= 63) & F.lower(x).rlike(_LABEL)) & F.lower(F.element_at(labels, -1)).rlike("^[a-z]{2,63}$")
    return F.coalesce(ok, F.lit(False))


def local_part(c: Column) -> Column:
    """P5: before the last @, null if there is nothing before it."""
    return F.nullif(_local(normalize(c)), F.lit(""))


def is_generic(c: Column, policy: str = "batch") -> Column:
    """Whether the mailbox is an office's (no address: no)."""
    return F.coalesce(local_part(c).isin(*P.GENERIC[P.check(policy)]), F.lit(False))


def domain(c: Column) -> Column:
    """The host after the last @ without www., null unless dotted and free of blanks."""
    n = normalize(c)
    host = F.regexp_replace(strip(F.substring_index(n, "@", -1)), "^www[.]", "")
    return F.when(local_part(c).isNotNull() & host.contains(".") & ~host.rlike(r"\s"), host)


def is_freemail(host: Column, policy: str = "batch") -> Column:
    """P8."""
    return F.coalesce(F.regexp_replace(normalize(host), "^www[.]", "").isin(*P.FREEMAIL["batch" if policy == "pilot" else P.check(policy)]), F.lit(False))


def decode_published(c: Column) -> Column:
    """Bracketed words for @ and dot replaced, each on its own."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), f"(?iu){P.BATCH_AT}", "@")
    return F.regexp_replace(t, f"(?iu){P.BATCH_DOT}", ".")


def _url_decode(c: Column) -> Column:
    return F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def normalize_published(c: Column) -> Column:
    """P10: mailto:, query and obfuscation removed; badly encoded or null: ''."""
    t = _url_decode(F.split_part(F.regexp_replace(strip(c), "(?i)^mailto:", ""), F.lit("?"), F.lit(1)))
    t = F.regexp_replace(F.regexp_replace(t, f"(?iu){P.PILOT_AT}", "@"), f"(?iu){P.PILOT_DOT}", ".")
    return F.coalesce(F.lower(F.regexp_replace(t, r"\s*@\s*", "@")), F.lit(""))


def from_mailto(href: Column) -> Column:
    """The address of a mailto link, raw if badly encoded, null if empty."""
    raw = F.split_part(F.regexp_replace(href, "(?i)^mailto:", ""), F.lit("?"), F.lit(1))
    return F.nullif(strip(F.coalesce(_url_decode(raw), raw)), F.lit(""))


def extract(c: Column) -> Column:
    """Distinct well-formed addresses of a text in their order, after decoding."""
    found = F.regexp_extract_all(decode_published(c), F.lit(f"(?i){P.BATCH_EMAIL}"), F.lit(0))
    return F.array_distinct(F.filter(F.transform(found, lambda e: F.lower(F.regexp_replace(e, "^[.]+|[.]+$", ""))), lambda e: valid(e, "batch")))


def distinct_count(c: Column) -> Column:
    """Distinct addresses in a context, classic pattern."""
    found = F.regexp_extract_all(c, F.lit(f"(?i){P.CLASSIC_EMAIL}"), F.lit(0))
    return F.size(F.array_distinct(F.transform(found, F.lower))).cast("long")


def _forms(first: Column, last: Column) -> Column:
    f, n = (F.regexp_replace(fold(x), "[^a-z]", "") for x in (first, last))
    i, dot = F.substring(f, 1, 1), F.lit(".")
    return F.array(n, F.concat(f, dot, n), F.concat(i, n), F.concat(i, dot, n), F.concat(n, dot, f), F.concat(f, n), F.concat(n, i))


def pattern_code(first: Column, last: Column, local: Column) -> Column:
    """P25: which of seven forms made of the name the local part is (0 to 6), else null."""
    at = F.array_position(_forms(first, last), local)
    return F.when(at > 0, at - 1)


def pattern_local(first: Column, last: Column, code: Column) -> Column:
    """The local part that a code of :func:`pattern_code` stands for; it only reads back an address that was observed."""
    return F.get(_forms(first, last), code.cast("int"))
