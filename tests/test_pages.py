"""Page trees, links, sitemaps, streams and the stated traps, on small cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom import policy as P
from ledgerloom.functions import emails, text, urls
from ledgerloom.operators import contacts as C
from ledgerloom.operators import links as L
from ledgerloom.operators import metrics as M
from ledgerloom.operators import robots as B
from ledgerloom.sources import html as H
from ledgerloom.sources import sinks
from ledgerloom.streaming import ledger as T

GIVEN = frozenset(map(H.fold, P.GIVEN_NAMES))


def outline(body, head=""):
    return H.page_outline(f"<html><head>{head}</head><body>{body}</body></html>", GIVEN)


# --- outlines and flags -------------------------------------------------------------------


def test_outline_shows_what_a_reader_sees():
    o = outline('<h1>Naše\n <b>škola</b></h1><p style="display : none">skryté a@x.cz</p><p hidden>b@x.cz</p><noscript>c@x.cz</noscript><p aria-hidden="true">d@x.cz</p><p>Jan Novák e@x.cz</p><a href="/k">Kon<i>takt</i></a>', "<title> Škola </title>")
    assert (o["title"], o["h1"], o["mails"]) == ("Škola", "Naše škola", ["e@x.cz"])
    assert o["links"] == [{"href": "/k", "label": "Kontakt", "rel": ""}] and [n["last_name"] for n in o["names"]] == ["Novák"]
    empty = H.page_outline("", GIVEN)
    assert empty["text"] == "" and not any(empty[k] for k in ("interactive", "js_shell", "pagination", "soft404"))


@pytest.mark.parametrize(
    "body, cards, accordions",
    [
        ('<a aria-expanded="false">Menu</a>', 0, 0), ('<button aria-expanded="false">Učitelský sbor</button>', 0, 1), ('<div role="button">Detail pracovníka</div>', 1, 0),
        ("<details><summary>Vedení školy</summary></details>", 0, 1), ("<details open><summary>Vedení školy</summary></details>", 0, 0), ("<button>Zobrazit <b>profil</b></button>", 1, 0), ("<button>Odeslat</button>", 0, 0),
    ],
)
def test_only_staff_controls_are_interactive(body, cards, accordions):
    o = outline(body)
    assert (o["profile_cards"], o["accordions"], o["interactive"]) == (cards, accordions, cards + accordions > 0)


def test_script_shells_soft_404_and_pagination():
    assert outline("<script>x</script><noscript>" + "slovo " * 200 + "</noscript>")["js_shell"]
    assert not outline("<script>x</script>" + "slovo " * 200)["js_shell"] and not outline("krátké")["js_shell"]
    assert outline("x", "<title>Page not found</title>")["soft404"] and outline("<h1>Stránka nenalezena</h1>")["soft404"] and not outline("404 žáků", "<title>Škola</title>")["soft404"]
    assert outline("<a href='?p=2'><b>další</b></a>")["pagination"] and outline("<a rel=next href='/2'>2</a>")["pagination"]
    assert not outline("<a href='javascript:x'>další</a><a href='/k'>Kontakt</a>")["pagination"]


def test_portal_records_must_be_valid():
    row = "<body>600123{0}<table><tr><td>Web: <a href='/x'>a</a><a href='https://zs.example.org/'>b</a></td></tr></table></body>"
    at = "https://portal.example.org/School/600123"
    assert H.portal_website(row.format(""), at, "600123") == "https://zs.example.org/"
    assert H.portal_website(row.format(" Tento záznam školy není platný"), at, "600123") is None
    assert H.portal_website(row.format(""), at, "999") is None and H.portal_website("", at, "") is None


def test_browser_targets_are_the_three_best_of_a_site(spark):
    rows = [("s", f"https://s/{p}", "T", i, j, n, 0, c) for p, i, j, n, c in [("sbor", True, False, 0, 1), ("a", True, False, 0, 2), ("b", False, True, 0, 0), ("vedeni", False, False, 5, 0), ("c", False, False, 9, 0), ("d", True, False, 0, 0)]]
    frame = spark.createDataFrame(rows, "site string, url string, title string, interactive boolean, js_shell boolean, names int, contacts int, profile_cards int")
    got = [(r["url"][10:], r["reason"], r["weight"]) for r in M.browser_targets(frame).orderBy("rank").collect()]
    assert got == [("a", "INTERACTIVE_PROFILES", 200), ("sbor", "INTERACTIVE_PROFILES", 120), ("vedeni", "STAFF_COVERAGE_GAP", 20)]


# --- links ---------------------------------------------------------------------------------


def links_of(spark, *rows):
    return spark.createDataFrame([("https://s.cz/", n, u, str(n), s) for n, (u, s) in enumerate(rows)], "page_url string, pos int, url string, label string, score long")


def test_a_trailing_slash_is_no_page_of_its_own(spark):
    rows = links_of(spark, ("https://s.cz/kontakt", 14), ("https://s.cz/kontakt/", 20), ("https://s.cz/a/", 4), ("https://s.cz/a", 4))
    assert {(r["url"], r["score"]) for r in L.best_links(rows).collect()} == {("https://s.cz/kontakt/", 20), ("https://s.cz/a/", 4)}
    assert L.admitted(rows).count() == 2
    site = rows.withColumn("site", F.lit("s"))
    assert L.frontier(site).count() == 2 and L.frontier(site, spark.createDataFrame([("s", "https://s.cz/a")], "site string, url string")).count() == 1
    assert L.merge_candidates(site.filter("pos < 2"), site.filter("pos >= 1")).count() == 2


def test_top_links(spark):
    rows = links_of(spark, *[(f"https://s.cz/{k}", k) for k in range(8)])
    assert [r["url"][-1] for r in L.top_links(rows, 4, 4).orderBy("rank").collect()] == ["7", "6", "5", "4"] and L.top_links(rows, 3).count() == 3


def test_paths_are_percent_encoded_once(spark):
    rows = spark.createDataFrame([("/škola a",), ("/%C5%A1kola%20a",), ("/skola",)], "h string")
    base = F.lit("https://www.s.cz/")
    assert {r[0] for r in rows.select(urls.canonical(F.col("h"), base)).collect()} == {"https://s.cz/%C5%A1kola%20a", "https://s.cz/skola"}
    assert rows.select(urls.without_trackers(F.col("h"), base)).first()[0] == "https://www.s.cz/%C5%A1kola%20a"


def test_maps_of_an_index_are_no_pages(spark):
    index = "<sitemapindex>" + "".join(f"<sitemap><loc>https://s.cz/{k}.xml</loc></sitemap>" for k in range(5)) + "<sitemap><loc>https://jinde.cz/x.xml</loc></sitemap></sitemapindex>"
    page = "<urlset><url><loc> https://s.cz/a?x=1&amp;y </loc></url><url><lastmod>1</lastmod></url></urlset>"
    maps = spark.createDataFrame([("https://s.cz", index), ("https://s.cz", page), ("https://s.cz", None), ("https://s.cz", "<urlset><url><loc>https://s.cz/b</loc>")], "website string, xml string")
    assert [r["url"] for r in L.sitemap_urls(maps).collect()] == ["https://s.cz/a"]
    assert sorted(r["map"][-5:] for r in L.sitemap_children(maps).collect()) == ["0.xml", "1.xml", "2.xml"]


# --- hot keys and streams --------------------------------------------------------------------


def test_a_hot_mailbox_is_gathered_as_distinct_values(spark):
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', concat('m', id)) AS mailbox", "0 AS person", "concat('s', id % 4) AS source", "concat('r', id % 2) AS role", "lpad(id, 6, '0') AS pos", "cast('2026-01-01' AS date) AS observed_at", "1 AS school")
    (r,) = C.first_with_unions(rows).filter("mailbox = 'hot'").collect()
    assert r["pos"] == "000000" and r["sources"] == ["s0", "s3", "s2", "s1"] and r["roles"] == ["r0", "r1"]
    (s,) = C.seen_span(rows).filter("mailbox = 'hot'").collect()
    assert s["sightings"] == 1000 and s["sources"] == ["s0", "s1", "s2", "s3"]


def test_a_sink_rewrites_only_what_a_batch_touches_and_prunes(spark, tmp_path):
    empty = spark.createDataFrame([], "k long, n long")
    sink = T.KeyedSink(str(tmp_path), empty, ["k"], lambda new, old: old.join(new.select("k"), "k", "left_anti").select("k", "n").unionByName(new), buckets=4)
    sink(spark.range(20).selectExpr("id AS k", "0L AS n"), 0)
    for number in range(1, 6):
        sink(spark.createDataFrame([(3, number)], "k long, n long"), number)
    sink(spark.createDataFrame([(3, 5)], "k long, n long"), 5)  # run again
    state = {r["k"]: r["n"] for r in sink.read(spark).collect()}
    assert state == {k: 5 if k == 3 else 0 for k in range(20)}
    versions = sink._versions(spark)
    assert sorted(len(v) for v in versions.values()) == [1, 1, 1, T.KEPT] and max(max(v) for v in versions.values()) == 5
    half = tmp_path / "v=00000009" / "_b=0"
    half.mkdir(parents=True)
    assert {r["k"]: r["n"] for r in sink.read(spark).collect()} == state  # without a mark of success


def test_an_unfinished_or_failed_run_says_so(spark):
    runs = spark.createDataFrame([(1, 0, 1, None), (2, 0, 1, "boom"), (3, 0, None, None), (4, 0, 1, None)], "run int, started_at int, finished_at int, failure string")
    pages = spark.createDataFrame([(1, 1, 1, 1, 0, "E"), (2, 1, 0, 0, 0, None)], "run int, verified int, unpaired int, ambiguous int, conflicts int, error string")
    assert {r["run"]: (r["status"], r["pages"]) for r in M.run_rows(runs, pages).collect()} == {1: ("PARTIAL", 1), 2: ("FAILED", 1), 3: ("RUNNING", 0), 4: ("COMPLETED", 0)}


def test_more_rows_than_a_spreadsheet_are_an_error(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "MOST_ROWS", 3)
    with pytest.raises(ValueError):
        sinks.write_csv(spark.range(4).selectExpr("cast(id AS string) AS a"), str(tmp_path / "x"), ["a"], ("A",))


def test_ledger_from_after_the_capture(spark):
    ledger = spark.createDataFrame([("a", dt.date(2026, 1, 2))], "school string, last_observed_at date")
    with pytest.raises(ValueError):
        C.assert_not_newer(ledger, "2026-01-01")
    C.assert_not_newer(ledger, "2026-01-02")


# --- traps that are kept or mended on purpose ---------------------------------------------------


def test_q2_a_name_takes_the_blank_behind_it():
    assert [n[1] for n in H.names_before("Jan Novák Eva Malá x@y.cz", "x@y.cz", None)] == ["Novák"]
    assert [n[1] for n in H.names_before("Jan Novák, Eva Malá x@y.cz", "x@y.cz", None)] == ["Novák", "Malá"]


def test_q4_boundaries_split_addresses_in_camel_case():
    assert H.pair("JanNovak@y.cz", "Jan Novák JanNovak@y.cz", "TEXT", None)[0] == "UNPAIRED"
    assert H.pair("jannovak@y.cz", "Jan Novák jannovak@y.cz", "TEXT", None)[0] == "VERIFIED"


def test_q6_word_bounds_are_ascii():
    assert H._HINT.search("učí Jan Novák") and not H._HINT.search("Šárka Železná")


def test_q7_letter_case_is_folded_beyond_ascii(spark):
    rows = spark.createDataFrame([("ŘEDITELKA",), ("Ředitelka",)], "c string")
    assert [r[0] for r in rows.select(text.first_role(F.col("c"))).collect()] == ["ředitel/ředitelka"] * 2
    assert rows.select(text.fold(F.col("c"))).distinct().count() == 1


def test_q8_text_right_below_the_body_is_not_searched():
    assert [m for m, *_ in H.email_occurrences("<body>a@x.cz<p>b@x.cz</p></body>", "u")] == ["b@x.cz"]


def test_q9_an_empty_agent_is_nobody(spark):
    rules = B.parse_robots(spark.createDataFrame([("h", "User-agent:\nDisallow: /\nUser-agent: *\nDisallow: /x")], "host string, robots string"))
    pages = spark.createDataFrame([("h", "https://h/a"), ("h", "https://h/x")], "host string, url string")
    assert {r["url"]: r["allowed"] for r in B.allowed(pages, rules, "ledgerloom").collect()} == {"https://h/a": True, "https://h/x": False}


def test_mail_patterns_are_read_back(spark):
    row = spark.createDataFrame([("Jiří", "Novák")], "f string, l string")
    for local, code in (("novak", 0), ("jiri.novak", 1), ("jnovak", 2), ("j.novak", 3), ("novak.jiri", 4), ("jirinovak", 5), ("novakj", 6), ("office", None)):
        r = row.select(emails.pattern_code(F.col("f"), F.col("l"), F.lit(local)).alias("c")).select("c", emails.pattern_local(F.lit("Jiří"), F.lit("Novák"), F.col("c")).alias("b")).first()
        assert r["c"] == code and r["b"] == (local if code is not None else None)
