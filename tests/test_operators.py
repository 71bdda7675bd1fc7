"""Operators, sources, sinks and streams on small tables."""

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import contacts as C
from ledgerloom.operators import delivery, links, metrics, robots
from ledgerloom.operators import registry as G
from ledgerloom.sources import html, readers, sinks
from ledgerloom.streaming import ledger as T

OBS = "school long, mailbox string, person long, observed_at date, source string"
LEDGER = "school long, mailbox string, person long, collected_at date, last_observed_at date, suppressed boolean, status string"


def day(n):
    return dt.date(2026, 1, n)


def merged(spark, obs, old):
    rows = C.merge_ledger(spark.createDataFrame(obs, OBS), spark.createDataFrame(old, LEDGER)).collect()
    return {r["mailbox"]: r for r in rows}


def test_conflict_goes_before_suppression_and_unseen_rows_stay(spark):
    old = [(1, "a", 1, day(1), day(2), True, "SOURCE_CONFIRMED"), (1, "b", 1, day(1), day(2), True, "SOURCE_CONFIRMED"), (1, "c", 1, day(1), day(2), False, "SOURCE_CONFIRMED"), (1, "d", 9, day(1), day(2), False, "SOURCE_CONFIRMED")]
    got = merged(spark, [(1, "a", 2, day(5), "s"), (1, "b", 1, day(5), "s"), (1, "d", 9, day(5), "s"), (1, "e", 3, day(5), "s")], old)
    assert got["a"]["reason"] == "SHARED_OR_REASSIGNED_MAILBOX"
    assert got["b"]["reason"] == "SUPPRESSED_CONTACT" and got["b"]["suppressed"]
    assert got["c"]["last_observed_at"] == day(2) and got["c"]["reason"] is None
    assert got["d"]["collected_at"] == day(1) and got["d"]["last_observed_at"] == day(5)
    assert got["e"]["collected_at"] == day(5)


def test_merge_is_idempotent(spark):
    obs = spark.createDataFrame([(1, "a", 1, day(3), "s"), (1, "b", 1, day(3), "s"), (1, "b", 2, day(4), "s")], OBS)
    once = C.merge_ledger(obs, spark.createDataFrame([], LEDGER)).drop("reason")
    twice = C.merge_ledger(obs, once).drop("reason")
    assert sorted(once.collect()) == sorted(twice.collect())


def test_newer_ledger_is_an_error(spark):
    with pytest.raises(ValueError):
        C.assert_not_newer(spark.createDataFrame([(1, "a", 1, day(1), day(9), False, "x")], LEDGER), "2026-01-05")


def test_robots_longest_rule_wins_and_ties_allow(spark):
    text = "User-agent: *\nDisallow: /a\nAllow: /a/b\nDisallow: /t\nAllow: /t\nDisallow: /*.pdf$\n\nUser-agent: loom\nUser-agent: other\nDisallow: /z"
    rules = robots.parse_robots(spark.createDataFrame([("h", text)], "host string, robots string"))
    pages = spark.createDataFrame([("h", f"https://h{p}") for p in ("/a/x", "/a/b", "/t", "/x.pdf", "/x.pdf?y", "/z", "")], "host string, url string")
    of = lambda agent: {r["url"][9:]: r["allowed"] for r in robots.allowed(pages, rules, agent).collect()}
    assert of("nobody") == {"/a/x": False, "/a/b": True, "/t": True, "/x.pdf": False, "/x.pdf?y": True, "/z": True, "": True}
    assert of("LoomBot/1")["/z"] is False and of("LoomBot/1")["/a/x"] is True


def test_anchors_read_single_quotes_entities_and_nested_tags(spark):
    page = "<a class=x href='/a?b=1&amp;c=2'><b>Pe</b> &amp; co</a><a>none</a><A HREF=\"/d\"> x\n y </A>"
    rows = links.anchors(spark.createDataFrame([("u", page), ("v", None)], "url string, html string")).orderBy("pos").collect()
    assert [(r["href"], r["label"]) for r in rows] == [("/a?b=1&c=2", "Pe & co"), ("/d", "x y")]


def test_registry_payload_without_list_is_an_error(spark):
    bad = spark.createDataFrame([('{"datumVystupu": "2026-01-01"}',), ("nonsense",)], "payload string")
    with pytest.raises(Exception, match="registry payload"):
        G.subjects(bad.limit(1)).collect()


def test_upsert_keeps_columns_and_keys_stay_unique(spark):
    old = spark.createDataFrame([(1, "a", "w"), (2, "b", None)], "id int, name string, site string")
    new = spark.createDataFrame([(2, "B", "x"), (3, "C", "y")], "id int, name string, site string")
    rows = C.upsert(old, new, "id", keep=["site"])
    assert sorted(map(tuple, rows.collect())) == [(1, "a", "w"), (2, "B", None), (3, "C", None)]
    assert rows.count() == rows.select("id").distinct().count()


def test_ranks_are_gapless_and_total(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = delivery.ranked(rows, [F.col("k")]).collect()
    assert sorted((r["k"], r["rank"]) for r in got) == [(k, k + 1) for k in range(1000)]


def test_status_is_the_first_that_fits(spark):
    s = spark.createDataFrame([(n,) for n in range(5)], "school int")
    scans = spark.createDataFrame([(1, "", 0, 0, 0), (2, "w", 1, 0, 0), (3, "w", 0, 0, 2), (4, "w", 0, 0, 0)], "school int, website string, browser_targets int, notes int, remaining int")
    empty = spark.createDataFrame([], "school int, profiles int, profiles_checked boolean")
    rows = metrics.school_rows(s, scans, empty, spark.createDataFrame([(4,)], "school int"))
    assert [r["status"] for r in rows.orderBy("school").collect()] == ["NOT_PROCESSED", "WEB_UNRESOLVED", "BROWSER_PENDING", "PARTIAL_COVERAGE", "SOURCES_SCANNED_COMPLETENESS_UNCONFIRMED"]


# --- trees ----------------------------------------------------------------------

GIVEN = frozenset(map(html.fold, ("Jan", "Eva", "Petr")))


def test_implied_ends_and_void_elements():
    root = html.parse("<ul><li>a<li>b<br>c</ul><p>d<p>e<table><tr><td>1<td>2<tr><td>3</table>")
    assert [n.text() for n in root.elements("li")] == ["a", "bc"]
    assert [n.text() for n in root.elements("p")] == ["d", "e"]
    assert [[c.text() for c in r.elements("td")] for r in root.elements("tr")] == [["1", "2"], ["3"]]


def test_link_and_hidden_addresses_are_found_once():
    page = '<body>skipped@x.cz<div>Jan Novák <a href="mailto:Jan%40x.cz?s=1">jan@x.cz</a></div><p>eva zavinac x tecka cz</p><script>no@x.cz</script></body>'
    assert sorted((m, k) for m, _, _, k in html.email_occurrences(page, "u")) == [("eva@x.cz", "OBFUSCATED"), ("jan@x.cz", "MAILTO")]


@pytest.mark.parametrize(
    "context, outcome",
    [
        ("Mgr. Jan Novák, jan@x.cz", "VERIFIED"),
        ("jan@x.cz Jan Novák", "UNPAIRED"),
        ("Jan Novák, Eva Malá, jan@x.cz", "AMBIGUOUS"),
        ("Jan Novák jan@x.cz eva@x.cz", "AMBIGUOUS"),
        ("Základní Škola, jan@x.cz", "UNPAIRED"),
        ("Jan Novák, " + "x" * 170 + " jan@x.cz", "UNPAIRED"),
    ],
)
def test_pairing(context, outcome):
    assert html.pair("jan@x.cz", context, "TEXT", None)[0] == outcome


def test_school_name_is_no_person_and_confidence_is_capped():
    assert html.pair("jan@x.cz", "Jan Novák, jan@x.cz", "TEXT", "ZŠ Jan Novák")[0] == "UNPAIRED"
    assert html.pair("jan@x.cz", "Mgr. Jan Novák, učitelka, jan@x.cz", "MAILTO", None)[4] == 0.98


@pytest.mark.parametrize(
    "page, want",
    [
        ("<ul><li>Jan Novák <a href='mailto:jan@x.cz'>jan@x.cz</a></li><li>Eva Malá eva@x.cz</li></ul>", {("CONTACT", "jan@x.cz", None), ("CONTACT", "eva@x.cz", None)}),
        ("<div><p>Jan Novák</p><p>a@x.cz</p><p>b@x.cz</p></div>", {("REVIEW", "a@x.cz", "AMBIGUOUS_BLOCK"), ("REVIEW", "b@x.cz", "AMBIGUOUS_BLOCK")}),
        ("<li>Jan Novák <a href='mailto:a@x.cz'>b@x.cz</a></li>", {("REVIEW", "a@x.cz", "LINK_TEXT_CONFLICT"), ("REVIEW", "b@x.cz", "LINK_TEXT_CONFLICT")}),
        ("<li>Jan Novák info@x.cz</li>", {("REVIEW", "info@x.cz", "GENERAL_MAILBOX")}),
        ("<li>Jan Novák, webdesign, j@x.cz</li>", {("REVIEW", "j@x.cz", "EXTERNAL_SERVICE_CONTACT")}),
        ("<footer>j@x.cz</footer>", {("REVIEW", "j@x.cz", "EMAIL_WITHOUT_PERSON")}),
        ("<li hidden>Jan Novák j@x.cz</li><li style='display: none'>Eva Malá e@x.cz</li>", set()),
    ],
)
def test_page_contacts(page, want):
    got = {(kind, mail, reason) for kind, mail, *_, reason, _m, _h in html.page_contacts(f"<html><body>{page}</body></html>", "u", GIVEN)}
    assert {g for g in got} >= want and (want or not got)


def test_profiles_and_portal():
    assert html.profile_names("<button><h3>Jan  N</h3>Zobrazit profil</button><button>zobrazit profil</button>") == ["Jan N"]
    row = "<table><tr><td>600123<tr><td>Web:<td><a href='/in'>in</a><a href='https://zs.example.org/'>x</a></table>"
    assert html.portal_website(row, "https://portal.example.com/1", "600123") == "https://zs.example.org/"
    assert html.portal_website(row, "https://portal.example.com/1", "999") is None


def test_labels_split_by_markup_or_entities_open_profiles(spark):
    pages = ["<BUTTON><H3>Jana A</H3>Zobrazit <b>profil</b></BUTTON>", "<button><h4>Eva B</h4>Zobrazit&#32;profil</button>", "<button>Jiné</button>", None]
    rows = html.inventories(spark.createDataFrame([(p, "u") for p in pages], "html string, url string")).collect()
    assert sorted(r["name"] for r in rows) == ["Eva B", "Jana A"]


def test_addresses_with_any_blank_before_the_bracket_are_extracted(spark, tmp_path):
    from ledgerloom.plans import scalars

    texts = ["a.b[at\t]x.cz", "c.d(at\n)x.cz", "e.f [at] x.cz", "nothing"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert {r["doc_id"]: r["found"] for r in scalars.email_extract_documents(spark, str(tmp_path)).collect()} == {0: "a.b@x.cz", 1: "c.d@x.cz", 2: "e.f@x.cz"}


def test_prefilter_keeps_every_page_that_can_give_an_address(spark):
    pages = ["a@b.cz", "a&#64;b.cz", "a&commat;b.cz", "a [at] b [dot] cz", "a (AT) b", "a zavinac b", "mailto:x", "nothing"]
    rows = spark.createDataFrame([(p,) for p in pages], "html string").filter(html.may_hold_mail(F.col("html"))).collect()
    assert len(rows) == len(pages) - 1


# --- sources and sinks ------------------------------------------------------------


def test_captures_keep_the_last_good_one(spark, tmp_path):
    for n, (url, status, at) in enumerate([("u", 200, "1"), ("u", 200, "2"), ("v", 404, "1")]):
        (tmp_path / f"{n}.json.gz").write_bytes(gzip.compress(json.dumps({"url": url, "status": status, "text": f"t{at}", "at": at}).encode()))
    assert [(r["url"], r["text"]) for r in readers.captures(spark, str(tmp_path)).collect()] == [("u", "t2")]


def test_checkpoints_are_keyed_by_content(spark, tmp_path):
    (tmp_path / "12.json").write_text(json.dumps({"school": {"externalRegistryId": "ico:5"}, "website": None}))
    (tmp_path / "notes.json").write_text("{}")
    rows = readers.checkpoints(spark, str(tmp_path)).collect()
    assert [(r["file_id"], r["school"]["externalRegistryId"]) for r in rows] == [("12", "ico:5")]


def test_reviewed_capture_checks_its_envelope(spark, tmp_path):
    good = {"schemaVersion": 1, "collectionDate": "2026-01-01", "collectionMethod": "ASSISTED_PUBLIC_WEB_REVIEW", "schools": [], "observations": []}
    (tmp_path / "a.json").write_text(json.dumps(good))
    (tmp_path / "b.json").write_text(json.dumps(good | {"schemaVersion": 2}))
    assert readers.reviewed_capture(spark, str(tmp_path / "a.json")).count() == 1
    with pytest.raises(ValueError):
        readers.reviewed_capture(spark, str(tmp_path / "b.json"))


def test_rendered_pages_and_one_city(spark, tmp_path):
    (tmp_path / ("a" * 64 + ".html")).write_text("<p>x</p>")
    (tmp_path / "other.html").write_text("no")
    assert [r["html"] for r in readers.rendered_pages(spark, str(tmp_path)).collect()] == ["<p>x</p>"]
    with pytest.raises(ValueError):
        readers.assert_one_city(spark.createDataFrame([("Praha",), (None,)], "city string"), "Praha")


def test_csv_file_is_ordered_marked_and_exclusive(spark, tmp_path):
    rows = spark.createDataFrame([("b", "=1"), ("a", "x;y")], "k string, v string")
    sinks.write_csv(rows, str(tmp_path / "out"), ["k", "v"], ("K", "V"), ["k"])
    data = next((tmp_path / "out").glob("part-*")).read_bytes()
    assert data == '﻿"K";"V"\r\n"a";"x;y"\r\n"b";"\'=1"\r\n'.encode()
    with pytest.raises(Exception):
        sinks.write_csv(rows, str(tmp_path / "out"), ["k", "v"], ("K", "V"), ["k"])


def test_appends_versions_and_reports(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a")], "k int, v string")
    for _ in range(2):
        sinks.append(rows, str(tmp_path / "facts"))
    assert spark.read.parquet(str(tmp_path / "facts")).count() == 2
    sinks.write_version(rows, str(tmp_path / "t"), 1)
    with pytest.raises(Exception):
        sinks.write_version(rows, str(tmp_path / "t"), 1)
    sinks.write_json(rows, str(tmp_path / "j"))
    assert json.loads(sinks.report(rows)) == {"k": 1, "v": "a"}
    schools = spark.createDataFrame([(1, None, "UNKNOWN"), (2, "w", "VERIFIED")], "school int, website string, website_status string")
    new = spark.createDataFrame([(1, "n", "VERIFIED"), (2, "x", "UNKNOWN")], "school int, website string, status string")
    assert sorted(tuple(r) for r in sinks.set_websites(schools, new).collect()) == [(1, "n", "VERIFIED"), (2, "w", "VERIFIED")]


# --- streams -----------------------------------------------------------------------


def test_ledger_stream_resumes_where_it_stopped(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "ledger")
    empty = spark.createDataFrame([], LEDGER + ", reason string")
    sink = T.LedgerSink(root, empty)
    for n, row in enumerate([(1, "a", 1, day(1), "s"), (1, "a", 1, day(4), "s"), (1, "a", 2, day(5), "s")]):
        spark.createDataFrame([row], OBS).coalesce(1).write.mode("append").parquet(folder)
        T.run_once(T.file_stream(spark, folder, spark.createDataFrame([], OBS).schema), sink, str(tmp_path / "cp"))
        r = sink.read(spark).first()
        assert (r["collected_at"], r["status"]) == (day(1), "SOURCE_CONFIRMED" if n < 2 else "REVIEW_REQUIRED")
    assert sink.read(spark).first()["last_observed_at"] == day(4)


def test_repeats_in_a_stream_are_dropped(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.createDataFrame([("a", dt.datetime(2026, 1, 1)), ("a", dt.datetime(2026, 1, 1)), ("b", dt.datetime(2026, 1, 1))], "k string, t timestamp").write.parquet(folder)
    rows = T.unique_in_window(T.file_stream(spark, folder, "k string, t timestamp"), ["k"], "t", "1 day")
    q = rows.writeStream.format("memory").queryName("repeats").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("repeats").count() == 2
