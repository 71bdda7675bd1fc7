"""Name functions (P19, H8, F8, F14, F18, F25): Catalyst expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import policy as P
from .text import comparison_key, fold, folded, squeeze, strip_titles
from .urls import let

_WORD = "^\\p{L}[\\p{L}\\p{M}'’.-]*$"
_RUN = "(?<!\\p{L})(?:\\p{Lu}[\\p{L}'’-]+\\s+){1,3}\\p{Lu}[\\p{L}'’-]+"


def split_name(c: Column, given: Sequence[str] = P.GIVEN_NAMES) -> Column:
    """struct(first_name, last_name, published_name) of a published name, else null.

    Two to five words; a dictionary of given names decides the order: leading
    given names, or a last one after a surname (up to three words).
    """
    known = sorted(set(map(folded, given)))  # folded here: 200 names folded by expressions make a large plan

    def parts(words: Column, flags: Column, n: Column) -> Column:
        stop = F.array_position(F.slice(flags, F.lit(1), F.greatest(n - 1, F.lit(0))), F.lit(False))
        lead = F.when(stop > 0, stop - 1).otherwise(n - 1).cast("int")
        leading, trailing = F.get(flags, F.lit(0)), F.element_at(flags, -1) & (n <= 3)
        first = F.when(leading, F.slice(words, F.lit(1), lead)).when(trailing, F.slice(words, n, F.lit(1)))
        last = F.when(leading, F.slice(words, lead + 1, F.greatest(n - lead, F.lit(0)))).when(trailing, F.slice(words, F.lit(1), F.greatest(n - 1, F.lit(0))))
        return F.when(leading | trailing, F.struct(first.alias("f"), last.alias("l")))

    def name(words: Column) -> Column:
        n = F.size(words)
        ok = n.between(2, 5) & F.forall(words, lambda w: w.rlike(_WORD) & (F.length(w) >= 2))
        met = F.when(ok, let(F.transform(words, lambda w: fold(w).isin(known)), lambda flags: parts(words, flags, n)))
        proper = lambda p: F.forall(p["l"], lambda w: w.rlike("^\\p{Lu}") & ~fold(w).isin(*P.NO_SURNAME))
        return let(met, lambda p: F.when(proper(p), F.struct(F.array_join(p["f"], " ").alias("first_name"), F.array_join(p["l"], " ").alias("last_name"), squeeze(c).alias("published_name"))))

    return let(F.split(strip_titles(c), r"\s+"), name)


def name_key(s: Column) -> Column:
    return fold(F.concat_ws("|", s["first_name"], s["last_name"]))


def names_in(c: Column, given: Sequence[str] = P.GIVEN_NAMES) -> Column:
    """H8: distinct names of a text: whole lines, else runs of two to four capitalised words."""
    lines = F.split(F.coalesce(c, F.lit("")), r"[\n\r;|]+")
    runs = lambda line: F.array_compact(F.transform(F.regexp_extract_all(line, F.lit(_RUN), F.lit(0)), lambda m: split_name(m, given)))
    found = F.flatten(F.transform(lines, lambda line: let(split_name(line, given), lambda s: F.when(s.isNotNull(), F.array(s)).otherwise(runs(line)))))
    # of equal keys the first place stays, with the last form
    last = lambda f, keys: F.transform(F.array_distinct(keys), lambda k: F.element_at(f, -F.array_position(F.reverse(keys), k).cast("int")))
    return let(found, lambda f: let(F.transform(f, name_key), lambda keys: last(f, keys)))


def within(name: Column, whole: Column) -> Column:
    """Whether a name's folded form occurs in another name (an empty one does not)."""
    n = comparison_key(name)
    return F.coalesce((n != "") & comparison_key(whole).contains(n), F.lit(False))


def in_evidence(first: Column, last: Column, evidence: Column, policy: str = "pilot") -> Column:
    """F14 (pilot: every name token is a token of the evidence, at least two), F18 (batch: every word occurs in it)."""
    if P.check(policy) == "pilot":
        low = lambda x: F.lower(F.trim(F.regexp_replace(x, r"\s+", " ")))
        tokens = F.filter(F.split(low(F.concat_ws(" ", first, last)), "[\\s’'-]+"), lambda t: t != "")
        visible = F.split(F.regexp_replace(low(F.coalesce(evidence, F.lit(""))), "[^\\p{L}\\p{M}\\p{N}]+", " "), r"\s+")
        return F.coalesce((F.size(tokens) >= 2) & (F.size(F.array_except(tokens, visible)) == 0), F.lit(False))
    words = F.split(fold(F.concat_ws(" ", first, last)), r"\s+")
    return F.coalesce(F.forall(words, lambda w: fold(evidence).contains(w)), F.lit(False))
