"""Fixtures: synthetic inputs built by the same expressions in Spark and DuckDB."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..sources.session import tasks


@dataclass(frozen=True)
class Fixture:
    """Expressions over a driver table, or rows of values."""

    table: str | None
    exprs: tuple[str, ...] = ()
    values: str = ""

    @property
    def sql(self) -> str:
        return f"SELECT {', '.join(self.exprs)} FROM {self.table}" if self.table else f"SELECT * FROM (VALUES {self.values}) AS t({', '.join(self.exprs)})"


def read(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A driver table, or a fixture. spread: its rows are dealt over all cores.

    A table of narrow rows is few splits, often one, however much is made of each
    row; spread deals the driver's rows, before a fixture widens them.
    """
    f = FIXTURES.get(name)
    if f and not f.table:
        return spark.sql(f.sql)
    rows = spark.read.parquet(f"{sf_dir}/{f.table if f else name}.parquet")
    if spread:
        rows = rows.repartition(tasks(spark))
    return rows.selectExpr(*f.exprs) if f else rows


#: Robots rules over the paths of the driver's pages.
RULES = (("/en", False), ("/en/1", True), ("/fr/", False), ("/fr/8", True), ("/*?page=", False), ("/de/*5$", False), ("/es/2*", True), ("/es", False), ("/", True))

FIXTURES = {
    "fx_email": Fixture(
        "customer",
        (
            "c_custkey AS k",
            "CASE c_custkey % 8 WHEN 0 THEN concat(' Info@WWW.zs', cast(c_nationkey AS STRING), '.CZ ') WHEN 1 THEN concat('c', cast(c_custkey AS STRING), CASE c_custkey % 5 WHEN 0 THEN '@gmail.com' WHEN 1 THEN '@seznam.cz' WHEN 2 THEN '@yahoo.com' WHEN 3 THEN '@zs.seznam.cz' ELSE '@tiscali.cz' END) WHEN 2 THEN 'invalid' WHEN 3 THEN 'x@localhost'"
            " WHEN 4 THEN concat('a..b@zs', cast(c_nationkey AS STRING), '.cz') WHEN 5 THEN concat('Jan.Novak+', cast(c_custkey AS STRING), '@Zs.Example.ORG') WHEN 6 THEN concat('podatelna@skola-', cast(c_nationkey AS STRING), '.cz') ELSE concat('j.n@zs', cast(c_nationkey AS STRING), '.cz') END AS raw",
            "c_nationkey AS nation",
        ),
    ),
    "fx_hidden": Fixture(
        "customer",
        (
            "c_custkey AS k",
            "CASE c_custkey % 7 WHEN 0 THEN concat('jan', cast(c_custkey AS STRING), ' [at] example (dot) org') WHEN 1 THEN concat('mailto:eva', cast(c_custkey AS STRING), '%40example.org?subject=x') WHEN 2 THEN concat('petr (zavináč) skola', cast(c_nationkey AS STRING), ' [tečka] cz')"
            " WHEN 3 THEN concat(' MAILTO:a+b', cast(c_custkey AS STRING), '@example.org ') WHEN 4 THEN concat('plain', cast(c_custkey AS STRING), ' @ example.org') WHEN 5 THEN '' ELSE concat('x', cast(c_custkey AS STRING), '@example.org') END AS raw",
        ),
    ),
    "fx_person": Fixture(
        "customer",
        (
            "c_custkey AS k",
            "CASE c_custkey % 5 WHEN 0 THEN 'Jan' WHEN 1 THEN 'Věra' WHEN 2 THEN 'Jiří' WHEN 3 THEN 'Eva' ELSE 'Zdeněk' END AS first_name",
            "CASE c_custkey % 4 WHEN 0 THEN 'Novák' WHEN 1 THEN 'Černá' WHEN 2 THEN 'Šimek' ELSE 'Dvořáková' END AS last_name",
            "CASE c_custkey % 9 WHEN 0 THEN 'novak' WHEN 1 THEN 'vera.cerna' WHEN 2 THEN 'jsimek' WHEN 3 THEN 'e.dvorakova' WHEN 4 THEN 'novak.zdenek' WHEN 5 THEN 'jancerna' WHEN 6 THEN 'simekv' ELSE 'office' END AS local",
            "concat('zs', cast(c_nationkey AS STRING), '.example.org') AS host",
        ),
    ),
    # invented observations of mailboxes: an order is a mailbox, a supplier a person
    "fx_obs": Fixture(
        "lineitem",
        (
            "l_orderkey % 100 AS school",
            "concat('m', cast(l_orderkey AS STRING), '@example.org') AS mailbox",
            "l_suppkey % 7 AS person",
            "cast(l_shipdate AS DATE) AS observed_at",
            "l_discount AS confidence",
            "concat('https://example.org/', cast(l_partkey % 50 AS STRING)) AS source",
            "CASE l_linenumber % 3 WHEN 0 THEN 'učitel' WHEN 1 THEN 'ředitelka' END AS role",
            "CASE l_returnflag WHEN 'A' THEN 'MAILTO' WHEN 'N' THEN 'TEXT' ELSE 'OBFUSCATED' END AS kind",
            "concat(lpad(cast(l_linenumber AS STRING), 3, '0'), '|', lpad(cast(l_partkey AS STRING), 12, '0'), '|', lpad(cast(l_suppkey AS STRING), 12, '0'), '|', lpad(cast(cast(l_quantity AS BIGINT) AS STRING), 6, '0'), '|', lpad(cast(cast(round(l_extendedprice * 100) AS BIGINT) AS STRING), 12, '0'), '|', cast(cast(l_shipdate AS DATE) AS STRING), '|', l_linestatus) AS pos",
        ),
    ),
    "fx_school": Fixture(
        "customer",
        (
            "c_custkey AS school",
            "c_name AS name",
            "CASE c_custkey % 5 WHEN 0 THEN 'PRIMARY' WHEN 1 THEN 'SECONDARY' WHEN 2 THEN 'PRIMARY_AND_SECONDARY' WHEN 3 THEN 'OTHER' ELSE 'PRIMARY' END AS school_type",
            "CASE c_custkey % 3 WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN 'VERIFIED' ELSE 'INVALID' END AS website_status",
            "CASE WHEN c_custkey % 3 = 1 AND c_custkey % 10 <> 0 THEN concat('https://zs', cast(c_custkey AS STRING), '.example.org') END AS website",
            "concat('R', cast(c_nationkey AS STRING)) AS region",
        ),
    ),
    "fx_names": Fixture(
        None,
        ("k", "raw"),
        "(1, 'Mgr. Jan Novák'), (2, 'Novák Jan'), (3, 'PhDr. Eva Černá, Ph.D.'), (4, 'Anna Marie Dvořáková'), (5, 'Škola Praha'), (6, 'Petr'), (7, 'Ing.  Tomáš  Šimek (zástupce)'), (8, 'Novotná Svobodová Věra'),"
        " (9, 'Jiří Kontakt'), (10, 'Neznámý Člověk'), (11, 'Bc. Hana Horáková-Malá'), (12, ''), (13, 'Karel von Berg'), (14, 'jan novák'), (15, 'Lucie Krátká MBA')",
    ),
    "fx_context": Fixture(
        None,
        ("k", "raw"),
        "(1, 'Mgr. Jan Novák, ředitelka školy'), (2, 'Eva Malá učitelka a asistentka pedagoga'), (3, 'ředitel'), (4, 'školní psycholog Petr Šimek'), (5, 'ICT koordinátor'), (6, 'zástupkyně ředitele; zástupkyně ředitele'), (7, 'Metodik prevence'),"
        " (8, 'nic'), (9, 'vedoucí školní jídelny'), (10, 'ŘEDITELKA'), (11, 'JanNovák EvaMalá'), (12, 'výchovná poradkyně Ing. Jana'), (13, 'hospodářka a ekonomka')",
    ),
    "fx_ip": Fixture(
        None,
        ("value",),
        "('8.8.8.8'), ('10.1.2.3'), ('127.0.0.1'), ('172.16.0.1'), ('172.32.0.1'), ('192.168.1.1'), ('169.254.3.4'), ('100.64.0.1'), ('100.128.0.1'), ('198.18.0.9'), ('192.0.2.1'), ('224.0.0.1'), ('0.1.2.3'), ('2001:4860::1'), ('2001:db8:1::1'), ('2002:1::1'), ('fe80::1'), ('example.org'), ('300.1.1.1')",
    ),
    "fx_url": Fixture(
        None,
        ("k", "value"),
        "(1, 'https://example.org/a'), (2, 'http://user:pw@example.org/'), (3, 'ftp://example.org/'), (4, 'https://example.org:8080/x'), (5, 'https://localhost/'), (6, 'https://10.0.0.1/'), (7, 'https://zs.test/'), (8, 'https://www.Example.org:443/'), (9, 'mailto:x@example.org'), (10, 'https://intranet.local/'), (11, 'https://9.9.9.9/')",
    ),
    "fx_dates": Fixture(None, ("k", "value"), "(1, '2024-02-29'), (2, '2023-02-29'), (3, '2024-2-9'), (4, '2024-13-01'), (5, ''), (6, '2024-12-31'), (7, 'x'), (8, '2024-01-01 ')"),
    "fx_valid": Fixture(None, ("k", "since", "until"), "(1, NULL, NULL), (2, '2026-01-01', NULL), (3, NULL, '2025-01-01'), (4, '2025-01-01', '2027-01-01'), (5, '2025-13-01', NULL), (6, '2025-06-01', '2025-06-01'), (7, '', '')"),
    "fx_cell": Fixture(None, ("k", "value"), "(1, 'Jan'), (2, '=1+1'), (3, '+420'), (4, '-x'), (5, '@y'), (6, 'a;b'), (7, '  =z'), (8, 'x''y'), (9, NULL), (10, ''), (11, concat('tab', chr(9))), (12, concat(chr(9), 'lead')), (13, concat('q', chr(34), 'q')), (14, concat('l', chr(10), 'm'))"),
    "fx_robots": Fixture(
        None,
        ("host", "robots"),
        "('a', concat('User-agent: *', chr(10), 'Disallow: /en', chr(10), 'Allow: /en/2', chr(10), 'Disallow:', chr(10), 'Sitemap: https://example.org/s.xml')),"
        " ('b', concat('# note', chr(13), chr(10), 'User-agent: LedgerLoom', chr(13), chr(10), 'User-agent: other', chr(13), chr(10), 'Disallow: /*?page=', chr(13), chr(10), 'User-agent: *', chr(10), 'Disallow: /')),"
        " ('c', concat('User-agent:', chr(10), 'Disallow: /', chr(10), 'User-agent: x', chr(10), 'Allow: /fr/*1$', chr(10), 'nonsense')), ('d', '')",
    ),
    "fx_rules": Fixture(None, ("pattern", "allow"), ", ".join(f"('{p}', {str(a).lower()})" for p, a in RULES)),
    "fx_address": Fixture(
        "supplier",
        (
            "s_suppkey AS k",
            "CASE WHEN s_suppkey % 4 = 0 THEN ' ' ELSE concat('Ulice ', cast(s_nationkey AS STRING)) END AS street",
            "CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'Osada' END AS district",
            "CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE cast(s_suppkey AS STRING) END AS house",
            "CASE WHEN s_suppkey % 2 = 0 THEN cast(s_nationkey AS STRING) END AS orientation",
            "CASE WHEN s_suppkey % 6 = 0 THEN 'a' END AS suffix",
            "CASE s_suppkey % 4 WHEN 0 THEN '11000' WHEN 1 THEN '110 00' WHEN 2 THEN 'PSČ 1' END AS postal",
            "CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 'Praha' END AS city",
        ),
    ),
    "fx_registry": Fixture(
        "supplier",
        (
            "s_suppkey AS k",
            "CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE cast(600000 + s_suppkey AS STRING) END AS red_izo",
            "CASE WHEN s_suppkey % 11 = 0 THEN ' ' ELSE cast(700000 + s_suppkey AS STRING) END AS ico",
            "CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE concat('Škola ', cast(s_suppkey AS STRING)) END AS name",
            "CASE s_suppkey % 4 WHEN 0 THEN 'B00' WHEN 1 THEN 'C00' WHEN 2 THEN 'B00,C00' ELSE 'X00' END AS kinds",
            "CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 'Praha' END AS city",
            "CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE concat('Info', cast(s_suppkey AS STRING), '@Example.org') END AS mail",
            "CASE WHEN s_suppkey % 2 = 0 THEN 'Jan Novák' END AS director",
        ),
    ),
    "fx_capture_school": Fixture(
        None,
        ("key", "name", "type", "scope", "address", "website", "address_source_url"),
        "('s1', 'ZŠ Jedna', 'ZŠ', 'Praha', 'Dlouhá 1, Praha', 'https://www.jedna.example.org', 'https://registry.example.org/1'), ('s2', 'SŠ Dva', 'SŠ', 'Praha', 'Krátká 2, Praha-východ', 'https://dva.example.org', 'https://registry.example.org/2'), ('s3', '', 'X', 'Brno', 'Brno', 'http://localhost', 'x')",
    ),
    "fx_capture": Fixture(
        None,
        ("k", "school_key", "first_name", "last_name", "email", "published_name", "published_email", "source_url", "reviewed", "alternate", "valid_from", "valid_until"),
        "(1, 's1', 'Jan', 'Novák', 'jan.novak@jedna.example.org', 'Mgr. Jan Novák', 'jan.novak (at) jedna (dot) example.org', 'https://jedna.example.org/kontakt', true, '', NULL, NULL),"
        " (2, 's1', 'Eva', 'Malá', 'info@jedna.example.org', 'Eva Malá', 'info@jedna.example.org', 'https://jedna.example.org/k', true, '', NULL, NULL),"
        " (3, 's9', 'Eva', 'Malá', 'e@jedna.example.org', 'Eva Malá', 'e@jedna.example.org', 'https://jedna.example.org/k', true, '', NULL, NULL),"
        " (4, 's2', 'Petr', 'Šimek', 'p@dva.example.org', 'Petr', 'q@dva.example.org', 'https://cizi.example.com/k', false, 'x@dva.example.org', '2027-01-01', '2020-01-01'),"
        " (5, 's1', ' ', 'Nový', 'bad', 'Nový', 'bad', 'ftp://x', true, '', NULL, '2024-13-01'),"
        " (6, 's3', 'Kontakt', 'Facebook', 'k@x.example.org', 'Kontakt Facebook', 'k@x.example.org', 'https://x.example.org', true, '', NULL, NULL),"
        " (7, 's1', 'Jana', 'Bílá', 'jan.novak@jedna.example.org', 'Jana Bílá', 'jan.novak@jedna.example.org', 'https://jedna.example.org/kontakt', true, '', NULL, NULL),"
        " (8, 's1', 'R2', 'Nový', 'r@jedna.example.org', 'R2 Nový', 'r@jedna.example.org', 'https://jedna.example.org', true, '', '2025-01-01', '2027-01-01'),"
        " (9, 's1', 'Hana', 'Dlouhá', 'hana@jedna.example.org', 'Hana Dlouhá', 'hana@jedna.example.org', 'https://jedna.example.org/a', true, '', NULL, NULL),"
        " (10, 's1', 'Hana', 'Dlouhá', 'hana@jedna.example.org', 'Hana Dlouhá', 'hana@jedna.example.org', 'https://jedna.example.org/b', true, '', NULL, NULL)",
    ),
    "fx_profile": Fixture(
        None,
        ("capture", "expected", "names", "idx", "card_name", "published_name", "status", "mail", "exhausted"),
        "('p1', 2, 'Jan Novák|Eva Malá', 0, 'Jan Novák', 'Jan Novák', 'OPENED', 'j@example.org', false), ('p1', 2, 'Jan Novák|Eva Malá', 1, 'Eva Malá', 'Eva Malá', 'OPENED', NULL, false),"
        " ('p2', 2, 'Jan Novák|Eva Malá', 0, 'Jan Novák', 'Jana Nová', 'NAME_MISMATCH', 'j@example.org', false), ('p2', 2, 'Jan Novák|Eva Malá', 1, 'Eva Malá', 'Eva Malá', 'OPENED', 'e@example.org', false),"
        " ('p3', 1, 'Petr Šimek', 0, 'Petr Šimek', 'Petr Šimek', 'OPENED', 'p@example.org', true), ('p4', 1, 'Petr Šimek', 0, 'Petr Šimek', 'Petr Šimek', 'OPENED', 'p@example.org', false)",
    ),
    # pages made of parts whose meaning is known: what the page shows follows from k
    "fx_page": Fixture(
        "customer",
        (
            "c_custkey AS k",
            "concat('https://zs', cast(c_custkey % 20 AS STRING), '.example.org/', CASE WHEN c_custkey % 4 = 0 THEN 'sbor' ELSE 'p' END, '/', cast(c_custkey AS STRING)) AS url",
            "concat('<html><head><title>', CASE WHEN c_custkey % 7 = 0 THEN 'Stránka  nenalezena' ELSE 'Škola' END, '</title></head><body><h1>', CASE WHEN c_custkey % 11 = 0 THEN 'Chyba 404' ELSE 'Naše <i>škola</i>' END, '</h1>',"
            " CASE c_custkey % 3 WHEN 0 THEN '<a href=\"/p/2\"><b>další</b></a>' WHEN 1 THEN '<a rel=\"next\" href=\"/p/3\">3</a>' ELSE '<a href=\"/kontakt/\">Kontakt</a><a href=\"/kontakt\">kontakty</a>' END,"
            " CASE c_custkey % 5 WHEN 0 THEN '<div role=\"button\">Detail pracovníka</div>' WHEN 1 THEN '<details><summary>Vedení školy</summary>x</details>' WHEN 2 THEN '<a aria-expanded=\"false\" href=\"/menu\">Menu</a>'"
            " WHEN 3 THEN '<button>Zobrazit <b>profil</b></button><button>view&#32;profile</button>' ELSE '<details open><summary>učitelé</summary></details>' END,"
            " CASE WHEN c_custkey % 2 = 0 THEN concat('<p hidden>', repeat('skryto ', 120), '</p><script>x()</script>') ELSE concat('<p>', repeat('slovo ', 120), '</p>') END,"
            " '<p>učí Jan Novák a Eva Malá: jan', cast(c_custkey AS STRING), '@zs.example.org</p></body></html>') AS html",
        ),
    ),
    # lists of people with addresses; every fourth entry names two people
    "fx_people_page": Fixture(
        "customer",
        (
            "c_custkey AS k",
            "concat('https://zs', cast(c_custkey AS STRING), '.example.org/lide') AS url",
            "CASE c_custkey % 5 WHEN 0 THEN 'Jan' WHEN 1 THEN 'Věra' WHEN 2 THEN 'Jiří' WHEN 3 THEN 'Eva' ELSE 'Zdeněk' END AS first_name",
            "CASE c_custkey % 3 WHEN 0 THEN 'Novák' WHEN 1 THEN 'Černá' ELSE 'Šimek' END AS last_name",
            "concat('<html><body><ul><li>Mgr. ', CASE c_custkey % 5 WHEN 0 THEN 'Jan' WHEN 1 THEN 'Věra' WHEN 2 THEN 'Jiří' WHEN 3 THEN 'Eva' ELSE 'Zdeněk' END, ' ', CASE c_custkey % 3 WHEN 0 THEN 'Novák' WHEN 1 THEN 'Černá' ELSE 'Šimek' END,"
            " CASE WHEN c_custkey % 4 = 0 THEN ' a Hana Malá' ELSE ', učitelka' END, ' <a href=\"mailto:m', cast(c_custkey AS STRING), '%40zs.example.org?subject=x\">m', cast(c_custkey AS STRING), '@zs.example.org</a></li></ul>',"
            " '<div><p>Kancelář: info [at] zs.example [dot] org</p></div><div><button><h3>Jan  Novák</h3>Zobrazit <b>profil</b></button><button><h4>Eva ', cast(c_custkey % 3 AS STRING), '</h4>zobrazit&#32;PROFIL</button><button><h3>Jiné</h3>Více</button></div></body></html>') AS html",
        ),
    ),
    # reviewed observations and their schools, with every kind of fault
    "fx_reviewed": Fixture(
        "customer",
        (
            "c_custkey AS k",
            "concat('s', cast(c_custkey % 6 AS STRING)) AS school_key",
            "CASE c_custkey % 17 WHEN 0 THEN ' ' WHEN 1 THEN 'R2' WHEN 2 THEN 'Kontakt' WHEN 3 THEN 'Jan' ELSE 'Eva' END AS first_name",
            "CASE c_custkey % 5 WHEN 0 THEN 'Novák' ELSE 'Malá' END AS last_name",
            "CASE WHEN c_custkey % 13 = 0 THEN 'Petr Jiný' ELSE concat('Mgr. ', CASE c_custkey % 17 WHEN 0 THEN ' ' WHEN 1 THEN 'R2' WHEN 2 THEN 'Kontakt' WHEN 3 THEN 'Jan' ELSE 'Eva' END, ' ', CASE c_custkey % 5 WHEN 0 THEN 'Novák' ELSE 'Malá' END) END AS published_name",
            "CASE c_custkey % 19 WHEN 0 THEN 'bad' WHEN 1 THEN 'info@s.example.org' ELSE concat('p', cast(c_custkey % 40 AS STRING), '@s.example.org') END AS email",
            "CASE WHEN c_custkey % 23 = 0 THEN 'other@s.example.org' ELSE replace(CASE c_custkey % 19 WHEN 0 THEN 'bad' WHEN 1 THEN 'info@s.example.org' ELSE concat('p', cast(c_custkey % 40 AS STRING), '@s.example.org') END, '@', ' (at) ') END AS published_email",
            "CASE c_custkey % 29 WHEN 0 THEN 'ftp://x' WHEN 1 THEN 'https://cizi.example.com/k' ELSE concat('https://www.s.example.org/k', cast(c_custkey % 3 AS STRING)) END AS source_url",
            "c_custkey % 31 <> 0 AS reviewed",
            "CASE WHEN c_custkey % 37 = 0 THEN 'x@s.example.org' ELSE '' END AS alternate",
            "CASE c_custkey % 41 WHEN 0 THEN '2027-01-01' WHEN 1 THEN '2025-13-01' END AS valid_from",
            "CASE c_custkey % 43 WHEN 0 THEN '2020-01-01' WHEN 1 THEN '2024-02-30' WHEN 2 THEN '2026-01-01' END AS valid_until",
        ),
    ),
    "fx_reviewed_school": Fixture(
        None,
        ("key", "name", "type", "scope", "address", "website", "address_source_url"),
        "('s0', 'ZŠ Nula', 'ZŠ', 'Praha', 'Dlouhá 1, Praha', 'https://s.example.org', 'https://registry.example.org/0'), ('s1', 'SŠ Jedna', 'X', 'Praha', 'Dlouhá 2, Praha', 'https://s.example.org', 'https://registry.example.org/1'),"
        " ('s2', 'SŠ Dva', 'SŠ', 'Praha', 'Krátká 2, Praha - východ', 'https://s.example.org', 'https://registry.example.org/2'), ('s3', 'ZŠ Tři', 'ZŠ+SŠ', 'Praha', 'Nová 3, Prague', 'http://localhost', 'https://registry.example.org/3'), ('s4', 'ZŠ Čtyři', 'ZŠ', 'Praha', 'Nová 4, Praha', 'https://s.example.org', 'https://registry.example.org/4')",
    ),
    "fx_octets": Fixture(
        "customer",
        (
            "c_custkey AS k",
            "concat(cast(CASE c_custkey % 11 WHEN 0 THEN 10 WHEN 1 THEN 172 WHEN 2 THEN 192 WHEN 3 THEN 169 WHEN 4 THEN 100 WHEN 5 THEN 198 WHEN 6 THEN 127 WHEN 7 THEN 0 ELSE c_custkey % 300 END AS STRING), '.', cast(CASE c_custkey % 3 WHEN 0 THEN (c_custkey * 7) % 256 WHEN 1 THEN 168 ELSE 254 END AS STRING), '.', cast(c_custkey % 256 AS STRING), '.', cast((c_custkey * 3) % 256 AS STRING)) AS value",
        ),
    ),
    "fx_html": Fixture(
        None,
        ("url", "school_name", "html"),
        "('https://a.example.org/k', 'ZŠ Alfa', '<html><body><ul><li>Mgr. Jan Novák, učitelka <a href=\"mailto:jan.novak@a.example.org\">e-mail</a></li><li>Eva Malá eva@a.example.org</li></ul></body></html>'),"
        " ('https://b.example.org/k', 'ZŠ Beta', '<html><body><table><tr><td>Petr Šimek<td>petr [at] b.example [dot] org</tr></table><p>info@b.example.org<p>Jan Novák a Eva Malá: dva@b.example.org</body></html>'),"
        " ('https://c.example.org/k', 'ZŠ Gama', '<div><button><h3>Jan  Novák</h3>Zobrazit profil</button><button><h4>Eva Malá</h4> zobrazit PROFIL</button><button>Jiné</button></div>'),"
        " ('https://d.example.org/k', NULL, NULL)",
    ),
}
