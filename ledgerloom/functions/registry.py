"""Registry functions (P40–P46, P49–P51): Catalyst expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import policy as P
from .text import clean, html_text, strip


def postal_code(c: Column) -> Column:
    """Five digits as 'ddd dd', anything else as it is."""
    compact = F.regexp_replace(c, r"\s+", "")
    return F.when(compact.rlike("^[0-9]{5}$"), F.concat(F.substring(compact, 1, 3), F.lit(" "), F.substring(compact, 4, 2))).otherwise(c)


def street(name: Column, district: Column, house: Column, orientation: Column, suffix: Column) -> Column:
    """Street (or district) and house number/orientation number with suffix; null if neither."""
    ori = F.concat(clean(orientation), F.coalesce(clean(suffix), F.lit("")))
    number = F.coalesce(F.concat(clean(house), F.lit("/"), ori), ori, clean(house))
    return F.nullif(F.concat_ws(" ", F.coalesce(clean(name), clean(district)), number), F.lit(""))


def full_address(street_col: Column, postal: Column, city: Column) -> Column:
    """P43: 'street, postal city' without the missing parts; null if nothing is left."""
    line = F.nullif(F.concat_ws(" ", postal, city), F.lit(""))
    return F.nullif(F.concat_ws(", ", street_col, line), F.lit(""))


def classify(kinds: Column) -> Column:
    """The school type of the kinds of a subject's units, null without either code."""
    one, two = (F.coalesce(F.array_contains(kinds, k), F.lit(False)) for k in ("B00", "C00"))
    return F.when(one & two, "PRIMARY_AND_SECONDARY").when(one, "PRIMARY").when(two, "SECONDARY")


def registry_key(red_izo: Column, ico: Column) -> Column:
    """P45."""
    return F.coalesce(clean(red_izo), F.concat(F.lit("ico:"), clean(ico)))


def street_name(c: Column) -> Column:
    """The street without its numbers, null if nothing is left."""
    return F.nullif(strip(F.regexp_replace(c, "[0-9/]+.*$", "")), F.lit(""))


def house_numbers(c: Column) -> Column:
    """All runs of digits."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("[0-9]+"), F.lit(0))


def name_tokens(c: Column, policy: str = "classic") -> Column:
    """P50: distinct folded words of four letters or more that are no stopwords."""
    stop = P.NAME_STOPWORDS["batch" if policy == "batch" else "classic"]
    return F.array_distinct(F.filter(F.split(html_text(c), " "), lambda t: (F.length(t) >= 4) & ~t.isin(*stop)))


def database_type(c: Column) -> Column:
    """Registry type to stored type; others are stored as OTHER."""
    return F.when(c.isin("PRIMARY", "SECONDARY", "PRIMARY_AND_SECONDARY"), c).otherwise("OTHER")


def registry_type(c: Column) -> Column:
    """P51, back: OTHER counts as PRIMARY."""
    return F.when(c == "OTHER", "PRIMARY").otherwise(c)
