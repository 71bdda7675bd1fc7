"""The commands end to end on temporary files."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.__main__ import parser, run


def subject(n, **changes):
    return {"redIzo": f"60000{n}", "ico": f"7000000{n}", "kraj": "Praha", "uplnyNazev": f"Základní škola Zvonice {n}", "adresa": {"ulice": "Dlouhá", "cisloDomovni": str(n), "obec": "Praha", "psc": "11000"}, "emaily": [f"info@zs{n}.example.org"], "reditel": {"nazevOsoby": "Jan Novák"}, "skolyAZarizeni": [{"druh": "B00"}]} | changes


@pytest.fixture
def root(spark, tmp_path):
    payload = {"datumVystupu": "2026-01-31", "list": [subject(1), subject(2), subject(3, skolyAZarizeni=[{"druh": "A00"}])]}
    (tmp_path / "snapshot.json").write_text(json.dumps(payload))
    page = "<html><body><h1>Základní škola Zvonice {0}</h1><p>IČO 7000000{0}, info@zs{0}.example.org, Dlouhá {0}</p><ul>{1}</ul></body></html>"
    pages = [
        ("https://zs1.example.org/", page.format(1, "<li>Mgr. Jan Novák, učitel, jan.novak@zs1.example.org</li><li>Eva Malá eva@zs1.example.org</li>"), dt.date(2026, 2, 1)),
        ("https://zs1.example.org/tajne", page.format(1, "<li>Petr Šimek petr@zs1.example.org</li>"), dt.date(2026, 2, 1)),
        ("https://elsewhere.example.com/", page.format(9, "<li>Hana Malá hana@elsewhere.example.com</li>"), dt.date(2026, 2, 1)),
    ]
    spark.createDataFrame(pages, "url string, html string, observed_at date").write.parquet(str(tmp_path / "pages"))
    spark.createDataFrame([("zs1.example.org", "User-agent: *\nDisallow: /tajne")], "host string, robots string").write.parquet(str(tmp_path / "robots"))
    return tmp_path


def test_registry_to_contact_file_and_back(spark, root):
    p = lambda n: str(root / n)
    got = run(["import-schools", "--snapshot", p("snapshot.json"), "--output", p("schools")], spark)
    assert got["types"] == [{"school_type": "PRIMARY", "total": 2, "created": 2, "updated": 0}]
    assert run(["resolve-websites", "--schools", p("schools"), "--pages", p("pages"), "--output", p("resolved")], spark) == {"attempted": 1, "verified": 1, "unresolved": 0}
    assert run(["stats", "--schools", p("resolved")], spark)["verified"] == 1
    again = run(["import-schools", "--snapshot", p("snapshot.json"), "--current", p("resolved"), "--output", p("schools2")], spark)
    assert again["types"][0]["updated"] == 2
    assert spark.read.parquet(p("schools2")).filter("website_status = 'VERIFIED'").count() == 1  # the import keeps websites

    out = run(["batch-export", "--schools", p("resolved"), "--pages", p("pages"), "--robots", p("robots"), "--output", p("out")], spark)
    assert (out["contact_rows"], out["unique_people_in_schools"], out["schools_with_contacts"]) == (2, 2, 1)
    assert out["statuses"] == {"PARTIAL_COVERAGE": 1, "WEB_UNRESOLVED": 1}
    lines = next((root / "out/contacts").glob("part-*")).read_text("utf-8-sig").splitlines()
    assert len(lines) == 3 and '"jan.novak@zs1.example.org"' in lines[2] and '"2026-02-01"' in lines[1]
    review = {(r["email"], r["reason"]) for r in spark.read.parquet(p("out/review")).collect()}
    assert ("info@zs1.example.org", "EMAIL_WITHOUT_PERSON") in review or any(e == "info@zs1.example.org" for e, _ in review)
    assert not any("petr@" in (e or "") or "hana@" in (e or "") for e, _ in review)

    # a replay with its own ledger gives the same contacts; a suppressed one stays out
    replay = run(["batch-export", "--schools", p("resolved"), "--pages", p("pages"), "--robots", p("robots"), "--previous", p("out/ledger"), "--output", p("replay")], spark)
    assert replay == out
    ledger = spark.read.parquet(p("out/ledger"))
    ledger.selectExpr("school", "mailbox", "person", "collected_at", "last_observed_at", "mailbox LIKE 'eva%' AS suppressed", "status").write.parquet(p("held"))
    third = run(["batch-export", "--schools", p("resolved"), "--pages", p("pages"), "--robots", p("robots"), "--previous", p("held"), "--output", p("third")], spark)
    assert third["contact_rows"] == 1
    assert spark.read.parquet(p("third/ledger")).filter("suppressed").count() == 1  # and in the ledger it stays


def test_extract_and_export(spark, root):
    p = lambda n: str(root / n)
    run(["import-schools", "--snapshot", p("snapshot.json"), "--output", p("schools")], spark)
    run(["resolve-websites", "--schools", p("schools"), "--pages", p("pages"), "--output", p("resolved"), "--limit", "5"], spark)
    run(["extract", "--schools", p("resolved"), "--pages", p("pages"), "--output", p("x")], spark)
    assert spark.read.parquet(p("x/contacts")).count() == 3  # without robots rules the page is read
    table = spark.createDataFrame([("A", "=B", "a@b.cz", "S", "X", "w", "2026-01-01")], "first_name string, last_name string, email string, school_name string, school_address string, school_website string, collected_at string")
    table.write.parquet(p("table"))
    run(["export-csv", "--contacts", p("table"), "--output", p("csv"), "--policy", "batch"], spark)
    assert next((root / "csv").glob("part-*")).read_text("utf-8-sig").splitlines()[1] == "A;'=B;a@b.cz;S;X;w;2026-01-01"


def observation(**changes):
    return {"schoolKey": "s1", "firstName": "Jan", "lastName": "Novák", "email": "jan@zs1.example.org", "publishedName": "Mgr. Jan Novák", "publishedEmail": "jan (at) zs1.example.org", "role": "učitel", "sourceUrl": "https://zs1.example.org/k", "reviewed": True, "alternateEmails": []} | changes


def capture(day, *observations):
    school = {"key": "s1", "name": "ZŠ Jedna", "type": "ZŠ", "scope": "Praha", "address": "Dlouhá 1, Praha", "website": "https://zs1.example.org", "addressSourceUrl": "https://registry.example.org/1"}
    return {"schemaVersion": 1, "collectionDate": day, "collectionMethod": "ASSISTED_PUBLIC_WEB_REVIEW", "schools": [school], "observations": list(observations), "unresolved": [{"schoolKey": "s1", "name": "?", "reason": None}]}


def test_reviewed_capture_through_the_gate(spark, tmp_path):
    p = lambda n: str(tmp_path / n)
    (tmp_path / "a.json").write_text(json.dumps(capture("2026-01-10", observation(), observation(sourceUrl="https://zs1.example.org/l"), observation(email="info@zs1.example.org", publishedEmail="info@zs1.example.org"))))
    got = run(["reviewed-export", "--input", p("a.json"), "--output", p("a")], spark)
    assert (got["confirmed_contacts"], got["duplicate_observations"], got["review_items"], got["primary_schools"]) == (1, 1, 2, 1)
    assert sorted(x.name for x in (tmp_path / "a").iterdir()) == ["audit", "contacts", "ledger", "review", "schools", "summary"]

    # reassigned to another person later: both go to review, the history stays
    (tmp_path / "b.json").write_text(json.dumps(capture("2026-02-10", observation(firstName="Eva", lastName="Malá", publishedName="Eva Malá"))))
    got = run(["reviewed-export", "--input", p("b.json"), "--previous", p("a/ledger"), "--output", p("b")], spark)
    assert (got["confirmed_contacts"], got["review_items"]) == (0, 2)
    row = spark.read.parquet(p("b/ledger")).first()
    assert (row["status"], row["person"], row["collected_at"]) == ("REVIEW_REQUIRED", "jan|novák", dt.date(2026, 1, 10))

    with pytest.raises(ValueError):  # the ledger is newer than the capture
        run(["reviewed-export", "--input", _older(tmp_path), "--previous", p("a/ledger"), "--output", p("c")], spark)
    with pytest.raises(Exception):  # and nothing is overwritten
        run(["reviewed-export", "--input", p("a.json"), "--output", p("a")], spark)


def _older(tmp_path):
    (tmp_path / "old.json").write_text(json.dumps(capture("2025-12-01", observation())))
    return str(tmp_path / "old.json")


def test_options_are_checked(spark):
    assert run(["health"], spark)["status"] == "ok"
    for bad in (["resolve-websites", "--schools", "a", "--pages", "b", "--output", "c", "--limit", "0"], ["nonsense"], ["stats"]):
        with pytest.raises(SystemExit):
            parser().parse_args(bad)


# --- scan, crawl, replay, delivery ------------------------------------------------------------


def site(body, title="Škola", h1="Škola"):
    return f"<html><head><title>{title}</title></head><body><h1>{h1}</h1>{body}</body></html>"


@pytest.fixture
def captured(spark, tmp_path):
    """Site 1 is confirmed by a linked page, site 2 by the portal only, site 3 not at all; site 4 shows a soft 404."""
    home = site('<a href="/kontakt/">Kontakt</a><a href="/kontakt">Kontakty</a><a href="/sbor">Pedagogický <b>sbor</b></a><a href="/aktuality">Aktuality</a><a href="/admin/sbor">x</a><a href="https://jinde.example.com/sbor">y</a>')
    pages = {
        "https://zs1.example.org/": home,
        "https://zs1.example.org/kontakt/": site("<p>IČO 70000001</p><a href='/vedeni'>Vedení</a><p>info@zs1.example.org</p>"),
        "https://zs1.example.org/sbor": site("<ul><li>Mgr. Jan Novák, učitel jan@zs1.example.org</li><li>Eva Malá eva@zs1.example.org</li></ul><button>Zobrazit profil</button><a href='/sbor?page=2'>další</a>"),
        "https://zs1.example.org/vedeni": site("<ul><li>Hana Horáková, ředitelka hana@zs1.example.org</li><li>Základní Škola x@zs1.example.org</li></ul>"),
        "https://zs1.example.org/tajne/sbor": site("<li>Petr Šimek petr@zs1.example.org</li>"),
        "https://zs1.example.org/stare/kontakt": site("", "Stránka nenalezena"),
        "https://zs2.example.net/": site("<ul><li>Petr Šimek petr@zs2.example.net</li></ul>"),
        "https://zs3.example.org/": site("nic"),
        "https://zs4.example.org/": site("IČO 70000004", "404"),
    }
    day = dt.date(2026, 2, 1)
    spark.createDataFrame([(u, h, day) for u, h in pages.items()], "url string, html string, observed_at date").write.parquet(str(tmp_path / "pages"))
    rows = [(str(n), f"Základní škola {n}", f"6000{n}", f"7000000{n}", "Dlouhá 1", [f"info@zs{n}.example.org"] if n != 2 else [], None, "Adresa", "UNKNOWN") for n in range(1, 5)]
    spark.createDataFrame(rows, "registry_id string, name string, red_izo string, ico string, street string, emails array<string>, website string, address string, website_status string").write.parquet(str(tmp_path / "schools"))
    spark.createDataFrame([("zs1.example.org", "User-agent: *\nDisallow: /tajne")], "host string, robots string").write.parquet(str(tmp_path / "robots"))
    portal = "<body>60002<table><tr><td>Web: <a href='https://zs2.example.net/'>www</a></td></tr></table></body>"
    spark.createDataFrame([("https://portal.example.org/School/60002", portal, "60002")], "url string, html string, red_izo string").write.parquet(str(tmp_path / "portal"))
    loc = lambda u: f"<url><loc>{u}</loc></url>"
    maps = [
        ("https://zs1.example.org", "https://zs1.example.org/sitemap.xml", "<sitemapindex><sitemap><loc>https://zs1.example.org/a.xml</loc></sitemap></sitemapindex>"),
        ("https://zs1.example.org", "https://zs1.example.org/a.xml", "<urlset>" + loc("https://zs1.example.org/tajne/sbor") + loc("https://zs1.example.org/stare/kontakt") + loc("https://zs1.example.org/obed") + "</urlset>"),
    ]
    spark.createDataFrame(maps, "website string, url string, xml string").write.parquet(str(tmp_path / "maps"))
    return tmp_path


def test_scan_confirms_crawls_and_reads(spark, captured):
    p = lambda n: str(captured / n)
    got = run(["scan", "--schools", p("schools"), "--pages", p("pages"), "--robots", p("robots"), "--portal", p("portal"), "--maps", p("maps"), "--output", p("out")], spark)
    verdicts = {r["registry_id"]: (r["website"], r["source"]) for r in spark.read.parquet(p("out/verdicts")).collect()}
    assert verdicts == {"1": ("https://zs1.example.org/", "REGISTRY_EMAIL_DOMAIN_AND_IDENTITY"), "2": ("https://zs2.example.net/", "https://portal.example.org/School/60002")}
    errors = {(r["registry_id"], r["code"]) for r in spark.read.parquet(p("out/errors")).collect()}
    assert {("3", "IDENTITY_NOT_CONFIRMED"), ("4", "SOFT_404"), ("1", "ROBOTS_DISALLOWED"), ("1", "SOFT_404")} <= errors
    pages = {r["url"]: r["error"] for r in spark.read.parquet(p("out/pages")).collect()}
    assert [u for u, e in pages.items() if e is None and "zs1" in u] and pages["https://zs1.example.org/vedeni"] is None
    assert not any("aktuality" in u or "admin" in u or "jinde" in u or "obed" in u for u in pages)
    assert sum("zs1.example.org/kontakt" in u for u in pages) == 1
    people = {(r["first_name"], r["last_name"], r["mailbox"], r["website"]) for r in spark.read.parquet(p("out/contacts")).collect()}
    assert people == {("Jan", "Novák", "jan@zs1.example.org", "https://zs1.example.org/"), ("Eva", "Malá", "eva@zs1.example.org", "https://zs1.example.org/"), ("Hana", "Horáková", "hana@zs1.example.org", "https://zs1.example.org/"), ("Petr", "Šimek", "petr@zs2.example.net", "https://zs2.example.net/")}
    (target,) = spark.read.parquet(p("out/targets")).collect()
    assert (target["url"], target["reason"], target["weight"]) == ("https://zs1.example.org/sbor", "INTERACTIVE_PROFILES", 120)
    counts = {r["school"]: r for r in spark.read.parquet(p("out/counts")).collect()}
    assert (counts["1"]["browser_targets"], counts["1"]["notes"], counts["2"]["pages"]) == (1, 1, 1)
    (row,) = spark.read.parquet(p("out/runs")).collect()
    assert got["contacts"] == 4 and (row["status"], row["contacts"]) == (got["status"], 4) == ("PARTIAL", 4)

    # the replay reads the same contacts with their first times; a page without capture gives a note
    spark.read.parquet(p("pages")).filter("url not like '%vedeni'").write.parquet(p("fewer"))
    schools = spark.read.parquet(p("schools")).drop("website").join(spark.read.parquet(p("out/verdicts")).select("registry_id", "website"), "registry_id", "left")
    schools.write.parquet(p("confirmed"))
    assert run(["reparse", "--schools", p("confirmed"), "--scan", p("out"), "--pages", p("pages"), "--output", p("again")], spark)["contacts"] == 4
    run(["reparse", "--schools", p("confirmed"), "--scan", p("out"), "--pages", p("fewer"), "--output", p("partly")], spark)
    assert [r["note"] for r in spark.read.parquet(p("partly/notes")).collect() if "vedeni" in r["note"]] == ["SOURCE_CAPTURE_MISSING:https://zs1.example.org/vedeni"]
    assert {r["observed_at"] for r in spark.read.parquet(p("again/contacts")).collect()} == {dt.date(2026, 2, 1)}

    assert run(["delivery", "--contacts", p("out/contacts"), "--output", p("delivery")], spark)["contacts"] == 4
    from ledgerloom.operators.delivery import decode_delivery

    back = decode_delivery({n: spark.read.parquet(p(f"delivery/{n}")) for n in ("firsts", "domains", "sources", "contacts")})
    assert {r["email"] for r in back.collect()} == {m for *_, m, _ in people}


def test_crawl_stops_at_its_budget_and_failures_are_kept(spark, captured):
    p = lambda n: str(captured / n)
    got = run(["crawl-url", "--url", "https://zs1.example.org/", "--pages", p("pages"), "--budget", "2", "--output", p("one")], spark)
    assert got["pages"] == 2 and {r["url"] for r in spark.read.parquet(p("one/pages")).collect()} == {"https://zs1.example.org/", "https://zs1.example.org/sbor"}
    assert spark.read.parquet(p("one/counts")).first()["remaining"] >= 1  # /kontakt; /vedeni was never seen
    with pytest.raises(Exception):
        run(["crawl", "--schools", p("nowhere"), "--pages", p("pages"), "--output", p("bad")], spark)
    assert spark.read.parquet(p("bad/runs")).first()["status"] == "FAILED"


def test_best_first_order_equals_a_queue(spark):
    """One page a round is the strict order of a priority queue."""
    import heapq
    import random

    from ledgerloom.operators.links import crawl_order

    rng, edges = random.Random(5), []
    for s in ("a", "b"):
        for k in range(12):
            for t in rng.sample(range(12), 4):
                edges.append((s, f"https://{s}/{k}", f"https://{s}/{t}/" if rng.random() < 0.3 else f"https://{s}/{t}", 4 + (t * 7) % 9))
    links = spark.createDataFrame(edges, "site string, page_url string, url string, score long")
    home = spark.createDataFrame([("a", "https://a/0"), ("b", "https://b/0")], "site string, url string")
    got = {(r["site"], r["round"]): r["url"].rstrip("/") for r in crawl_order(home, links, budget=8, step=1).collect()}
    for s in ("a", "b"):
        seen, queue, order = set(), [(-100, f"https://{s}/0")], []
        while queue and len(order) < 8:
            _, u = heapq.heappop(queue)
            if u in seen:
                continue
            seen.add(u)
            order.append(u)
            for q, f, t, w in edges:
                if q == s and f == u and t.rstrip("/") not in seen:
                    heapq.heappush(queue, (-w, t.rstrip("/")))
        assert [got.get((s, k)) for k in range(len(order))] == order
    assert len(crawl_order(home, links, budget=8, step=4).collect()) == 16


def test_browser_runs_are_merged_into_the_export(spark, captured):
    from ledgerloom.__main__ import LEDGER
    from ledgerloom.plans import pipelines as J
    from ledgerloom.plans import scan as S
    from ledgerloom.sources import readers

    p = lambda n: str(captured / n)
    schools, day = spark.read.parquet(p("schools")), dt.date(2026, 2, 2)
    scan = S.scan_sites(schools, spark.read.parquet(p("pages")), spark.read.parquet(p("robots")), spark.read.parquet(p("portal")))
    url = "https://zs1.example.org/sbor"
    rendered = spark.createDataFrame([("1", url, site("<ul><li>Mgr. Jan Novák jan@zs1.example.org</li><li>Petra Šimková petra@zs1.example.org</li><li>Eva Jiná eva@zs1.example.org</li></ul>"), day)], "registry_id string, url string, html string, observed_at date")
    card = lambda n, name, mails, status="OPENED": (n, status, name, name, mails, f"x\n{name}\nučitel\nfyziky", "2026-02-02T10:00:00Z")
    seen = [card(0, "Karel Malý", ["karel@zs1.example.org"]), card(1, "Dana Malá", []), card(2, "Neznámý Člověk", ["n@zs1.example.org"]), card(3, "Hana Bílá", ["a@x.cz", "b@x.cz"]), card(4, "Petr Bílý", ["p@x.cz"], "TIMEOUT")]
    profiles = spark.createDataFrame([("1", url, 5, [s[2] for s in seen], False, seen)], "registry_id string, url string, " + readers.PROFILES)
    merged = S.with_browser(scan.extraction, scan.found, scan.verdicts, schools, rendered, profiles)
    people = {(r["mailbox"], r["last_name"], r["method"], r["role"]) for r in merged.contacts.filter("school = '1'").collect()}
    assert people == {("jan@zs1.example.org", "Novák", "STATIC_TEXT", "učitel"), ("hana@zs1.example.org", "Horáková", "STATIC_TEXT", "ředitelka"), ("petra@zs1.example.org", "Šimková", "BROWSER_VISIBLE_DOM", None), ("karel@zs1.example.org", "Malý", "BROWSER_PROFILE_CARD", "učitel fyziky")}
    reasons = {(r["email"], r["reason"]) for r in merged.review.collect()}
    assert {("eva@zs1.example.org", "SHARED_OR_CONFLICTING_PERSON"), (None, "NO_PUBLISHED_EMAIL"), ("n@zs1.example.org", "NAME_NEEDS_REVIEW"), (None, "MULTIPLE_EMAILS"), ("p@x.cz", "TIMEOUT")} <= reasons
    known = schools.drop("website", "website_status").join(scan.verdicts.select("registry_id", "website", F.lit("VERIFIED").alias("website_status")), "registry_id", "left")
    result = J.batch_export(known, merged, spark.createDataFrame([], LEDGER))
    (row,) = result.schools.filter("school = '1'").collect()
    assert (row["contacts"], row["browser_pages"], row["profile_cards"], row["opened_cards"], row["status"]) == (4, 1, 5, 4, "PARTIAL_COVERAGE")
    totals = result.summary.first()
    assert (totals["contact_rows"], totals["schools_with_web"], totals["browser_pages"], totals["opened_profile_cards"]) == (5, 2, 1, 4)
    assert totals["statuses"] == {"PARTIAL_COVERAGE": 1, "SOURCES_SCANNED_COMPLETENESS_UNCONFIRMED": 1, "WEB_UNRESOLVED": 2}
