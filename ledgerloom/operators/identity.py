"""Site identity (F10–F12, J8, J9, W10): signals of a page about its organisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import policy as P
from ..functions import registry
from ..functions.text import fold, html_text
from ..functions.urls import let


def classic_signals(html: Column, ico: Column, red_izo: Column, mails: Column, street: Column, name: Column) -> Column:
    """struct(score, signals, status). VERIFIED from 5 points with two strong signals."""
    texts = F.struct(html_text(html).alias("page"), fold(html).alias("raw"), html_text(registry.street_name(street)).alias("way"))

    def checks(t: Column) -> Column:
        page, raw, way = t["page"], t["raw"], t["way"]
        has = lambda x: F.coalesce((x != "") & page.contains(x), F.lit(False))
        mail = F.coalesce(F.exists(mails, lambda e: let(fold(e), lambda m: page.contains(m) | raw.contains(m))), F.lit(False))
        way_ok = F.coalesce((F.length(way) >= 4) & page.contains(way), F.lit(False))
        number = F.coalesce(F.arrays_overlap(registry.house_numbers(street), F.split(page, "[^0-9]+")), F.lit(False))
        hits = F.size(F.filter(registry.name_tokens(name), lambda w: page.contains(w)))
        return let(hits, lambda n: F.array(has(ico), has(red_izo), mail, way_ok, number, F.coalesce(n >= 2, F.lit(False)), F.coalesce(n == 1, F.lit(False))))

    parts = ((5, "ico"), (5, "redIzo"), (4, "registryEmail"), (2, "street"), (1, "addressNumber"), (3, "schoolName"), (1, "schoolNamePartial"))

    def judged(ok: Column) -> Column:
        score = sum((F.when(ok[k], points).otherwise(0) for k, (points, _) in enumerate(parts)), F.lit(0)).cast("long")
        signals = F.array_compact(F.array(*[F.when(ok[k], label) for k, (_, label) in enumerate(parts)]))
        strong = sum((F.when(ok[k], 1).otherwise(0) for k, (_, label) in enumerate(parts) if label in ("ico", "redIzo", "registryEmail", "street", "schoolName")), F.lit(0))
        return F.struct(score.alias("score"), signals.alias("signals"), F.when((score >= 5) & (strong >= 2), "VERIFIED").otherwise("UNKNOWN").alias("status"))

    return let(let(texts, checks), judged)


def batch_signals(page_text: Column, page_mails: Column, ico: Column, red_izo: Column, mails: Column, street: Column, name: Column) -> Column:
    """the signals of a page, identifiers and name words matched as whole tokens."""
    page = fold(page_text)
    tokens = F.split(page, "[^a-z0-9]+")
    way = F.regexp_replace(fold(F.coalesce(street, F.lit(""))), r"\s+[0-9].*$", "")
    words = F.filter(F.split(fold(name), "[^a-z]+"), lambda t: (F.length(t) > 3) & ~t.isin(*P.NAME_STOPWORDS["batch"]))
    found = F.size(F.filter(words, lambda t: F.array_contains(tokens, t)))
    parts = (
        (F.array_contains(tokens, ico), "ico"),
        (F.array_contains(tokens, red_izo), "redIzo"),
        (F.arrays_overlap(mails, page_mails), "registryEmail"),
        ((F.length(way) > 4) & page.contains(way), "street"),
        ((F.size(words) > 0) & (found >= F.least(F.lit(2), F.size(words))), "name"),
    )
    return F.array_compact(F.array(*[F.when(F.coalesce(ok, F.lit(False)), label) for ok, label in parts]))


def identity_ok(signals: Column) -> Column:
    """F12."""
    has = lambda s: F.array_contains(signals, s)
    return has("ico") | has("redIzo") | (has("registryEmail") & (has("name") | has("street"))) | (has("name") & has("street"))


def best_candidate(rows: DataFrame, key: str) -> DataFrame:
    """Of the candidates (pos, status, score) of a key the first verified one, else the first of the best score."""
    rest = [c for c in rows.columns if c != key]
    order = F.struct(F.col("status") != "VERIFIED", F.when(F.col("status") == "VERIFIED", 0).otherwise(-F.col("score")), F.col("pos"))
    return rows.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("_w")).select(key, *[F.col(f"_w.{c}").alias(c) for c in rest])
