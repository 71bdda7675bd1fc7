"""Queries over files and options: what is written is read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text
from ..operators import delivery as D
from ..sources import readers as R
from ..sources import sinks as K
from ..sources.session import shared_folder
from .catalogue import query
from .fixtures import read


def _folder(spark):
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def _nations(spark, sf):
    return read(spark, sf, "nation").selectExpr("n_nationkey + 1 AS s_suppkey", "n_name AS s_name")


def _put(rows, folder, suffix=""):
    """A file for each row (name, value), written by the tasks through Hadoop: Spark's own writers choose the names of files."""
    spark = rows.sparkSession
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    for r in rows.collect():  # a file each of a driver table of 25 rows
        path = fs_path(f"{folder}/{r['name']}{suffix}")
        out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
        data = r["value"].encode()
        if suffix.endswith(".gz") or r["name"].endswith(".gz"):
            import gzip

            data = gzip.compress(data)
        out.write(bytearray(data))
        out.close()


@query("SELECT k AS line_no, first_name || ';' || last_name || ';' || CASE WHEN k % 3 = 0 THEN '''=1+' || k ELSE 'a ' || k END AS line FROM fx_person UNION ALL SELECT 0, 'Jméno;Příjmení;E-mail'", "fx_person")
def csv_file(spark, sf):
    """K2, K3: the file itself: byte order mark, header, CRLF, order and guarded cells (``batch`` quotes where it must)."""
    rows = read(spark, sf, "fx_person").select(F.lpad(F.col("k").cast("string"), 12, "0").alias("k"), "first_name", "last_name", F.when(F.col("k") % 3 == 0, F.concat(F.lit("=1+"), "k")).otherwise(F.concat(F.lit("a "), "k")).alias("mail"))
    folder = _folder(spark)
    K.write_csv(rows, folder, ["first_name", "last_name", "mail"], ("Jméno", "Příjmení", "E-mail"), ["k"], "batch")
    body = spark.read.text(folder, wholetext=True).select(F.posexplode(F.split(F.regexp_replace("value", "^﻿|\r\n$", ""), "\r\n")).alias("at", "line"))
    order = read(spark, sf, "fx_person").select("k").orderBy("k")
    return body.join(D.ranked(order, [F.col("k")]).select(F.col("rank").alias("at"), F.col("k").alias("line_no")), "at", "left").select(F.coalesce("line_no", F.lit(0)).alias("line_no"), "line")


@query("SELECT c_custkey AS k, c_name AS name, c_acctbal AS balance FROM customer")
def json_file(spark, sf):
    """K4."""
    folder = _folder(spark)
    K.write_json(read(spark, sf, "customer").selectExpr("c_custkey AS k", "c_name AS name", "c_acctbal AS balance"), folder)
    return spark.read.schema("k bigint, name string, balance double").json(folder)


@query("SELECT l_suppkey % 5 AS run, count(*) AS facts, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem GROUP BY 1")
def append_facts(spark, sf):
    """K7, K8: facts appended by two runs stay as they are."""
    folder, rows = _folder(spark), read(spark, sf, "lineitem").selectExpr("l_suppkey % 5 AS run", "l_quantity")
    K.append(rows.filter("run < 3"), folder, "run")
    K.append(rows.filter("run >= 3"), folder, "run")
    return spark.read.schema("l_quantity double, run bigint").parquet(folder).groupBy("run").agg(F.count(F.lit(1)).alias("facts"), F.sum("l_quantity").alias("quantity"))


@query("SELECT o_custkey AS school, max(o_orderkey) AS last FROM orders GROUP BY 1")
def atomic_versions(spark, sf):
    """A new version stands beside the old one; the latest is read."""
    folder, rows = _folder(spark), read(spark, sf, "orders").selectExpr("o_custkey AS school", "o_orderkey AS last")
    K.write_version(rows.filter("last % 2 = 0").groupBy("school").agg(F.max("last").alias("last")), folder, 1)
    old = spark.read.parquet(f"{folder}/v=00000001")
    new = old.unionByName(rows.filter("last % 2 = 1")).groupBy("school").agg(F.max("last").alias("last"))
    return spark.read.parquet(K.write_version(new, folder, 2))


@query(
    """SELECT s.school, CASE WHEN k IS NOT NULL THEN 'https://new' || s.school || '.example.org' ELSE s.website END AS website, CASE WHEN k IS NOT NULL THEN 'VERIFIED' ELSE website_status END AS website_status
    FROM fx_school s LEFT JOIN (SELECT school AS k FROM fx_school WHERE school % 4 = 0) v ON s.school = v.k""",
    "fx_school",
)
def website_update(spark, sf):
    """Verified websites are set, others stay."""
    schools = read(spark, sf, "fx_school").select("school", "website", "website_status")
    verdicts = schools.select("school", F.concat(F.lit("https://new"), "school", F.lit(".example.org")).alias("website"), F.when(F.col("school") % 4 == 0, "VERIFIED").otherwise("UNKNOWN").alias("status"))
    return K.set_websites(schools, verdicts)


@query("SELECT '{\"orders\":' || count(*) || ',\"customers\":' || count(DISTINCT o_custkey) || '}' AS report FROM orders")
def report_line(spark, sf):
    """The summary that a command prints."""
    totals = read(spark, sf, "orders").agg(F.count(F.lit(1)).alias("orders"), F.count_distinct("o_custkey").alias("customers"))
    return spark.createDataFrame([(K.report(totals),)], "report string")


@query("SELECT source, school, count(*) AS n FROM (SELECT 'static' AS source, o_custkey % 10 AS school FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'browser', o_custkey % 10 FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT 'review', c_custkey % 10 FROM customer) GROUP BY 1, 2")
def union_streams(spark, sf):
    """Contacts of pages and of the browser, and review items, one after the other."""
    of = lambda name: F.lit(name).alias("source")
    orders, school = read(spark, sf, "orders"), (F.col("o_custkey") % 10).alias("school")
    rows = K.union_all(orders.filter("o_orderstatus = 'F'").select(of("static"), school), orders.filter("o_orderstatus <> 'F'").select(school, of("browser")), read(spark, sf, "customer").select(of("review"), (F.col("c_custkey") % 10).alias("school")))
    return rows.groupBy("source", "school").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT k, CASE WHEN k % 4 = 0 AND k > 0 THEN CAST(k AS INT) WHEN k % 4 = 3 AND k % 5 > 0 THEN CAST(k % 5 AS INT) END AS value FROM fx_person", "fx_person")
def option_values(spark, sf):
    """Options that must be positive whole numbers."""
    k = F.col("k").cast("string")
    raw = F.when(F.col("k") % 4 == 0, k).when(F.col("k") % 4 == 1, F.concat(F.lit("-"), k)).when(F.col("k") % 4 == 2, F.concat(k, F.lit(".5"))).otherwise(F.concat(F.lit(" "), (F.col("k") % 5).cast("string")))
    return read(spark, sf, "fx_person").select("k", text.positive_int(raw).alias("value"))


@query(
    """SELECT '' || s_suppkey AS file_id, s_name AS name, 'https://zs' || s_suppkey || '.example.org' AS website, CAST(s_suppkey % 3 AS INT) AS contacts FROM (SELECT n_nationkey + 1 AS s_suppkey, n_name AS s_name FROM nation)"""
)
def checkpoint_folder(spark, sf):
    """Scan records, a file each, by the number in their names; other files are no records."""
    folder, s = _folder(spark), _nations(spark, sf)
    contact = "array_join(transform(sequence(0, cast(s_suppkey % 3 AS INT)), i -> if(i = 0, '', concat('{\"firstName\":\"Jan\",\"email\":\"a', i, '@example.org\"}'))), ',')"
    value = f"concat('{{\"parserVersion\":2,\"school\":{{\"externalRegistryId\":\"', s_suppkey, '\",\"name\":\"', s_name, '\"}},\\n\"website\":\"https://zs', s_suppkey, '.example.org\",\"contacts\":[', ltrim(',', {contact}), ']}}')"
    _put(s.selectExpr("concat(s_suppkey, '.json') AS name", f"{value} AS value"), folder)
    _put(s.filter("s_suppkey = 1").selectExpr("concat('note-', s_suppkey, '.json') AS name", "'{}' AS value"), folder)
    return R.checkpoints(spark, folder).select("file_id", F.col("school.name").alias("name"), "website", F.size("contacts").alias("contacts"))


@query("SELECT sha256('https://zs' || s_suppkey || '.example.org') AS url_digest, CAST(s_suppkey % 4 AS INT) AS expected, CAST(s_suppkey % 2 AS INT) AS observations, '<p>' || s_suppkey || '</p>' AS html FROM (SELECT n_nationkey + 1 AS s_suppkey FROM nation)")
def rendered_and_profiles(spark, sf):
    """Rendered pages and profile captures of one folder, by the digest of their URL."""
    folder, s = _folder(spark), _nations(spark, sf)
    digest = "sha2(concat('https://zs', s_suppkey, '.example.org'), 256)"
    _put(s.selectExpr(f"concat({digest}, '.html.gz') AS name", "concat('<p>', s_suppkey, '</p>') AS value"), folder)
    seen = "if(s_suppkey % 2 = 1, '{\"idx\":0,\"status\":\"OPENED\",\"publishedEmails\":[]}', '')"
    _put(s.selectExpr(f"concat({digest}, '.profiles.json.gz') AS name", f"concat('{{\"expected\":', s_suppkey % 4, ',\"names\":[],\"observations\":[', {seen}, ']}}') AS value"), folder)
    pages, profiles = R.rendered_pages(spark, folder), R.profile_captures(spark, folder)
    return profiles.select("url_digest", "expected", F.size("observations").alias("observations")).join(pages, "url_digest")


@query("SELECT 'snapshot.json' AS file, sha256('{\"datumVystupu\":\"2026-01-01\",\"n\":' || count(*) || '}') AS sha256, CAST(length('{\"datumVystupu\":\"2026-01-01\",\"n\":' || count(*) || '}') AS INT) AS chars FROM supplier")
def registry_snapshot(spark, sf):
    """A snapshot file with the digest of its bytes."""
    folder = _folder(spark)
    _put(read(spark, sf, "supplier").agg(F.count(F.lit(1)).alias("n")).select(F.lit("snapshot.json").alias("name"), F.concat(F.lit('{"datumVystupu":"2026-01-01","n":'), "n", F.lit("}")).alias("value")), folder)
    return R.snapshot(spark, folder).select("file", "sha256", F.length("payload").alias("chars"))


@query("SELECT '2026-01-01' AS date, CAST(count(*) AS INT) AS observations, count_if(s_suppkey % 2 = 0) AS reviewed FROM (SELECT n_nationkey + 1 AS s_suppkey FROM nation)")
def reviewed_file(spark, sf):
    """A reviewed capture, one JSON file."""
    folder = _folder(spark)
    each = "concat('{\"schoolKey\":\"s', s_suppkey, '\",\"reviewed\":', if(s_suppkey % 2 = 0, 'true', 'false'), '}')"
    body = _nations(spark, sf).selectExpr(f"{each} AS o").agg(F.array_join(F.array_sort(F.collect_list("o")), ",\n").alias("o"))
    head = '{"schemaVersion":1,"collectionDate":"2026-01-01","collectionMethod":"ASSISTED_PUBLIC_WEB_REVIEW","schools":[],"observations":['
    _put(body.select(F.lit("capture.json").alias("name"), F.concat(F.lit(head), "o", F.lit("]}")).alias("value")), folder)
    row = R.reviewed_capture(spark, folder)
    return row.select(F.col("collectionDate").alias("date"), F.size("observations").alias("observations"), F.size(F.filter("observations", lambda o: o["reviewed"])).cast("long").alias("reviewed"))


@query("SELECT k AS school, first_name, last_name, local || '@' || host AS email, 'https://' || host || '/' || (k % 5) AS source, (['STATIC_MAILTO', 'STATIC_TEXT', 'BROWSER_VISIBLE_DOM', 'BROWSER_PROFILE_CARD'])[CAST(k % 4 + 1 AS INT)] AS method FROM fx_person", "fx_person")
def delivery_file(spark, sf):
    """Contacts coded, written, read and decoded are what they were."""
    method = F.get(F.array(*map(F.lit, D.METHODS)), (F.col("k") % 4).cast("int"))
    rows = read(spark, sf, "fx_person").select(F.col("k").alias("school"), "first_name", "last_name", F.concat("local", F.lit("@"), "host").alias("email"), F.concat(F.lit("https://"), "host", F.lit("/"), (F.col("k") % 5).cast("string")).alias("source"), method.alias("method"))
    folder = _folder(spark)
    for name, table in D.encode_delivery(rows).items():
        table.write.option("compression", "zstd").parquet(f"{folder}/{name}")
    return D.decode_delivery({n: spark.read.parquet(f"{folder}/{n}") for n in ("firsts", "domains", "sources", "contacts")})


@query(r"SELECT page_id, regexp_replace(url || '(a|b)*[x]{2}$', '([.*+?^${}()|\[\]\\])', '\\\1', 'g') AS pattern, true AS matches FROM pages")
def regex_quoted(spark, sf):
    """A text quoted as a pattern matches just itself."""
    raw = F.concat("url", F.lit("(a|b)*[x]{2}$"))
    return read(spark, sf, "pages").select("page_id", text.regex_quote(raw).alias("pattern"), F.regexp_like(raw, F.concat(F.lit("^"), text.regex_quote(raw), F.lit("$"))).alias("matches"))


@query("SELECT o_custkey AS school, CAST((p - 1) // 3 AS INT) AS chunk, array_to_string(list(o_orderkey ORDER BY o_orderkey), ' ') AS keys FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p FROM orders) GROUP BY 1, 2")
def array_chunks(spark, sf):
    """Arrays cut into pieces of three."""
    rows = read(spark, sf, "orders").groupBy(F.col("o_custkey").alias("school")).agg(F.sort_array(F.collect_list("o_orderkey")).alias("keys"))
    return rows.select("school", F.posexplode(text.chunks(F.col("keys"), 3)).alias("chunk", "part")).select("school", "chunk", F.array_join("part", " ").alias("keys"))


@query("SELECT run, '{\"region\":\"Praha\",' || CASE WHEN run % 2 = 0 THEN '\"limit\":' || run || ',' ELSE '' END || '\"dry_run\":' || CASE WHEN run % 3 = 0 THEN 'true' ELSE 'false' END || '}' AS scope FROM (SELECT DISTINCT s_suppkey % 12 AS run FROM supplier)")
def run_scope(spark, sf):
    """The scope of a run."""
    from ..operators.metrics import scope_blob

    run = F.col("run")
    rows = read(spark, sf, "supplier").select((F.col("s_suppkey") % 12).alias("run")).distinct()
    return rows.select("run", scope_blob(region=F.lit("Praha"), limit=F.when(run % 2 == 0, run), dry_run=run % 3 == 0).alias("scope"))
