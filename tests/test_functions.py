"""Scalar functions: cases that the fixtures do not reach, and properties."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom import policy
from ledgerloom.functions import emails, names, registry, text, urls


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def many(spark, values, f):
    rows = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, v string")
    return [r["x"] for r in rows.select("n", f(F.col("v")).alias("x")).orderBy("n").collect()]


@pytest.mark.parametrize(
    "policy_name, good, bad",
    [
        ("classic", ["a@b.c", " X@Y.Z "], ["a@b", "a b@c.d", "", None, "@b.c"]),
        ("batch", ["a@b.c1", "x.y@a-b.cz"], ["a..b@c.cz", ".a@c.cz", "a.@c.cz", "a@c", "a@-c.cz", "ž@c.cz", "a@b@c.cz", "x" * 65 + "@c.cz", None]),
        ("pilot", ["a+b@c.cz"], ["a@c.c1", "a@c.c", "a(b@c.cz", "a@" + "x" * 64 + ".cz", None]),
    ],
)
def test_email_validity_by_policy(spark, policy_name, good, bad):
    assert all(many(spark, good, lambda c: emails.valid(c, policy_name)))
    assert not any(many(spark, bad, lambda c: emails.valid(c, policy_name)))


def test_unknown_policy_is_an_error():
    with pytest.raises(ValueError):
        policy.check("other")


def test_plus_survives_decoding_and_bad_escapes_fall_back(spark):
    assert many(spark, ["mailto:a+b%40c.cz?x=1", "mailto:a%zz@c.cz"], emails.from_mailto) == ["a+b@c.cz", "a%zz@c.cz"]
    assert many(spark, ["a+b%40c.cz", "a%zz@c.cz", None], emails.normalize_published) == ["a+b@c.cz", "", ""]


def test_local_part_takes_the_last_at(spark):
    assert many(spark, ["a@b@c.cz", "@c.cz", "none"], emails.local_part) == ["a@b", None, None]


@settings(max_examples=25, deadline=None)
@given(st.text(max_size=30))
def test_fold_and_slug_are_idempotent(spark, s):
    a = one(spark, text.slug(F.lit(s)))
    assert one(spark, text.slug(F.lit(a))) == a


@pytest.mark.parametrize(
    "href, base, want",
    [
        ("../b?x#y", "https://www.example.org/a/c/d", "https://example.org/a/b"),
        ("//www.example.org//x/", "http://example.org", "https://example.org/x"),
        ("https://other.org/", "https://example.org", None),
        ("mailto:a@b.cz", "https://example.org", None),
        ("#top", "https://example.org", None),
        ("", "https://example.org", None),
        ("./../../z", "https://example.org/a/", "https://example.org/z"),
        ("?page=2", "https://example.org/a", "https://example.org/a"),
        ("rel/p", "https://example.org/d/e", "https://example.org/d/rel/p"),
        (None, "https://example.org", None),
    ],
)
def test_canonical_urls(spark, href, base, want):
    assert one(spark, urls.canonical(F.lit(href).cast("string"), F.lit(base))) == want


def test_trackers_and_credentials(spark):
    f = lambda h: one(spark, urls.without_trackers(F.lit(h), F.lit("https://example.org/")))
    assert f("/a?utm_source=x&b=1&gclid=2#f") == "https://example.org/a?b=1"
    assert f("https://u:p@example.org/") is None
    assert f("HTTP://Example.org:80/x") == "http://example.org/x"


def test_overlapping_terms_add_up(spark):
    score = lambda u: one(spark, urls.classic_score(F.lit(u), F.lit("")))
    assert score("https://example.org/kontakty") == 24
    assert score("https://example.org/a/b/c/d/e") == -2
    assert score("nothing") == -100


def test_masculine_roles_do_not_match_in_classic(spark):
    assert many(spark, ["ředitel", "ředitelka", "ŘEDITELKA"], text.first_role) == [None, "ředitel/ředitelka", "ředitel/ředitelka"]
    assert many(spark, ["ředitel"], text.all_roles) == ["ředitel"]


def test_names_need_the_dictionary_and_capitals(spark):
    pick = lambda s: one(spark, names.split_name(F.lit(s)))
    assert pick("Ing. Jan Novák")["last_name"] == "Novák"
    assert pick("Novák Jan")["first_name"] == "Jan"
    assert pick("Jan novák") is None and pick("Jan") is None and pick("") is None
    assert one(spark, names.names_in(F.lit("Jan Novák; Petr Šimek\nJan Novák"))) == [("Jan", "Novák", "Jan Novák"), ("Petr", "Šimek", "Petr Šimek")]


def test_empty_name_is_inside_nothing(spark):
    assert one(spark, names.within(F.lit("!"), F.lit("Škola"))) is False


def test_public_addresses_by_range(spark):
    assert many(spark, ["172.15.0.1", "172.31.0.1", "192.0.0.1", "1.2.3", None, "2001:db8::1"], urls.public_ip) == [True, False, False, False, False, False]


def test_guarded_cells(spark):
    assert many(spark, ["﻿=1", "\tx", 'a"b', None], lambda c: text.csv_cell(c, "pilot")) == ["\"'﻿=1\"", "\"'\tx\"", '"a""b"', '""']
    assert many(spark, ["=1"], lambda c: text.csv_cell(c, "classic")) == ["=1"]


def test_street_falls_back_to_district(spark):
    n = F.lit(None).cast("string")
    assert one(spark, registry.street(n, F.lit("Osada"), n, F.lit("5"), F.lit("a"))) == "Osada 5a"
    assert one(spark, registry.street(n, n, n, n, n)) is None
