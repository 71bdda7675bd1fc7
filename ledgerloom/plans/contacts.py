"""Queries over contacts: winners, conflicts, ledgers, gates, exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contacts as C
from ..operators import identity as I
from ..operators.delivery import dictionary, export_rows
from ..sources import readers as S
from .catalogue import query
from .fixtures import read

_ONE = """winners AS (SELECT mailbox, min(person) AS person, arg_min(source, (-confidence, pos)) AS source, max(confidence) AS confidence, arg_min(school, (-confidence, pos)) AS school, min(observed_at) AS first_seen, max(observed_at) AS last_seen FROM fx_obs GROUP BY mailbox HAVING count(DISTINCT person) = 1)"""


@query("SELECT mailbox, person, source, confidence FROM winners", "fx_obs", _ONE)
def dedupe_best_confidence(spark, sf):
    return C.best_by_confidence(read(spark, sf, "fx_obs")).select("mailbox", "person", "source", "confidence")


@query("SELECT mailbox, count(DISTINCT person) AS persons FROM fx_obs GROUP BY mailbox HAVING count(DISTINCT person) > 1", "fx_obs")
def mailbox_conflicts(spark, sf):
    return C.conflicts(read(spark, sf, "fx_obs"))


_UNION = """firsts AS (SELECT mailbox, source, role, min(pos) AS p FROM fx_obs GROUP BY ALL),
once AS (SELECT mailbox FROM fx_obs GROUP BY mailbox HAVING count(DISTINCT person) = 1)"""


@query(
    """SELECT mailbox, person, sources, roles FROM (SELECT mailbox, arg_min(person, pos) AS person FROM fx_obs GROUP BY mailbox) JOIN once USING (mailbox)
    JOIN (SELECT mailbox, string_agg(source, ' ' ORDER BY p) AS sources FROM (SELECT mailbox, source, min(p) AS p FROM firsts GROUP BY 1, 2) GROUP BY 1) USING (mailbox)
    JOIN (SELECT mailbox, coalesce(string_agg(role, '; ' ORDER BY p), '') AS roles FROM (SELECT mailbox, role, min(p) AS p FROM firsts GROUP BY 1, 2) GROUP BY 1) USING (mailbox)""",
    "fx_obs",
    _UNION,
)
def dedupe_first_union(spark, sf):
    rows = C.first_with_unions(read(spark, sf, "fx_obs").select("mailbox", "person", "source", "role", "pos"))
    return rows.select("mailbox", "person", F.array_join("sources", " ").alias("sources"), F.array_join("roles", "; ").alias("roles"))


@query("SELECT mailbox AS email, lower(role) AS context, arg_min(kind, (kind <> 'MAILTO', pos)) AS kind FROM (SELECT mailbox, coalesce(role, 'x') AS role, kind, pos FROM fx_obs) GROUP BY 1, 2", "fx_obs")
def occurrence_dedupe(spark, sf):
    rows = read(spark, sf, "fx_obs").select(F.upper("mailbox").alias("email"), F.coalesce("role", F.lit("x")).alias("context"), "kind", "pos")
    return C.unique_occurrences(rows).select("email", F.lower("context").alias("context"), "kind")


@query("SELECT mailbox, count(*) AS rows_seen, count(DISTINCT (source, kind)) AS evidence, count(*) - count(DISTINCT (source, kind)) AS duplicates FROM fx_obs GROUP BY mailbox", "fx_obs")
def duplicate_observations(spark, sf):
    """W8, W9."""
    return C.sightings(read(spark, sf, "fx_obs"))


@query("SELECT school, mailbox, min(observed_at) AS first_seen, max(observed_at) AS last_seen, count(*) AS sightings, array_to_string(list_sort(list(DISTINCT source)), ' ') AS sources FROM fx_obs GROUP BY 1, 2", "fx_obs")
def first_last_seen(spark, sf):
    rows = C.seen_span(read(spark, sf, "fx_obs"))
    return rows.withColumn("sources", F.array_join("sources", " "))


_CUT = "1995-06-17"
_LEDGER = f"""history AS (SELECT school, mailbox, min(person) AS person, min(observed_at) AS collected_at, max(observed_at) AS last_observed_at, hash_bucket = 0 AS suppressed, 'SOURCE_CONFIRMED' AS status FROM
  (SELECT *, school % 9 AS hash_bucket FROM fx_obs WHERE observed_at < DATE '{_CUT}') GROUP BY school, mailbox, hash_bucket),
fresh AS (SELECT school, mailbox, min(person) AS lo, max(person) AS hi, min(observed_at) AS f, max(observed_at) AS t FROM fx_obs WHERE observed_at >= DATE '{_CUT}' GROUP BY 1, 2),
met AS (SELECT coalesce(fresh.school, h.school) AS school, coalesce(fresh.mailbox, h.mailbox) AS mailbox, h.person AS p, h.collected_at AS c, h.last_observed_at AS l, coalesce(h.suppressed, false) AS suppressed, h.status AS st, lo, hi, f, t,
  coalesce(lo IS NOT NULL AND (lo <> hi OR coalesce(h.person, lo) <> lo), false) AS changed FROM fresh FULL JOIN history h ON fresh.school = h.school AND fresh.mailbox = h.mailbox),
merged AS (SELECT school, mailbox, coalesce(p, lo) AS person, coalesce(c, f) AS collected_at, CASE WHEN lo IS NOT NULL AND NOT changed AND NOT suppressed THEN t ELSE coalesce(l, t) END AS last_observed_at, suppressed,
  CASE WHEN changed THEN 'REVIEW_REQUIRED' WHEN lo IS NOT NULL AND NOT suppressed THEN 'SOURCE_CONFIRMED' ELSE coalesce(st, 'SOURCE_CONFIRMED') END AS status,
  CASE WHEN changed THEN 'SHARED_OR_REASSIGNED_MAILBOX' WHEN lo IS NOT NULL AND suppressed THEN 'SUPPRESSED_CONTACT' END AS reason FROM met)"""


def _merged(spark, sf):
    obs = read(spark, sf, "fx_obs")
    old = obs.filter(F.col("observed_at") < F.lit(_CUT).cast("date"))
    ledger = old.groupBy("school", "mailbox").agg(F.min("person").alias("person"), F.min("observed_at").alias("collected_at"), F.max("observed_at").alias("last_observed_at"))
    ledger = ledger.withColumns({"suppressed": F.col("school") % 9 == 0, "status": F.lit("SOURCE_CONFIRMED")})
    return C.merge_ledger(obs.filter(F.col("observed_at") >= F.lit(_CUT).cast("date")), ledger)


@query("SELECT * FROM merged", "fx_obs", _LEDGER)
def ledger_merge(spark, sf):
    return _merged(spark, sf)


@query("SELECT school, mailbox, reason FROM merged WHERE reason = 'SHARED_OR_REASSIGNED_MAILBOX'", "fx_obs", _LEDGER)
def ledger_identity_change(spark, sf):
    return _merged(spark, sf).filter("reason = 'SHARED_OR_REASSIGNED_MAILBOX'").select("school", "mailbox", "reason")


@query("SELECT school, mailbox, status FROM merged WHERE suppressed", "fx_obs", _LEDGER)
def ledger_suppressed(spark, sf):
    return _merged(spark, sf).filter("suppressed").select("school", "mailbox", "status")


_CS = "customers AS (SELECT c_custkey % 100 AS school, min(c_name) AS school_name, min(n_name) AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)"


def _schools(spark, sf):
    rows = read(spark, sf, "customer").join(F.broadcast(read(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy((F.col("c_custkey") % 100).alias("school")).agg(F.min("c_name").alias("school_name"), F.min("n_name").alias("nation"))


@query(
    """SELECT row_number() OVER (ORDER BY school_name COLLATE cs, person, mailbox COLLATE "C") AS rank, person, mailbox AS email, school_name, nation AS address, 'https://zs' || school || '.example.org' AS website, strftime(first_seen, '%Y-%m-%d') AS collected_at
    FROM winners JOIN customers USING (school) WHERE school % 10 <> 0""",
    "fx_obs",
    f"{_ONE},\n{_CS}",
)
def export_contacts(spark, sf):
    """The flagship: conflict-free contacts of verified sites, joined with their school, ranked and projected."""
    best = C.best_by_confidence(read(spark, sf, "fx_obs"), first_seen="first_seen")
    schools = _schools(spark, sf).withColumn("website", F.when(F.col("school") % 10 != 0, F.concat(F.lit("https://zs"), "school", F.lit(".example.org"))))
    rows = export_rows(best, schools)
    return rows.select("rank", "person", F.col("mailbox").alias("email"), "school_name", F.col("nation").alias("address"), "website", F.date_format("first_seen", "yyyy-MM-dd").alias("collected_at"))


@query("""SELECT k, row_number() OVER (ORDER BY last_name COLLATE cs, first_name COLLATE cs, k) AS rank FROM fx_person""", "fx_person")
def export_ranked(spark, sf):
    """Czech order of names; the rank makes it comparable. Sorted in parallel; only the offsets of ranges are put together."""
    return dictionary_rank(read(spark, sf, "fx_person"))


def dictionary_rank(rows):
    from ..operators.delivery import ranked

    return ranked(rows, [F.expr("last_name COLLATE cs"), F.expr("first_name COLLATE cs"), F.col("k")]).select("k", "rank")




_CODES = r"""met AS (SELECT o.*, s.key, s.name, s.type, s.scope, s.address, s.website, s.address_source_url, lower(regexp_replace(replace(trim(o.email), ' (at) ', '@'), '\s*@\s*', '@')) AS mail, trim(o.first_name) <> '' AND trim(o.last_name) <> '' AS named,
  list_filter(string_split_regex(lower(trim(o.first_name || ' ' || o.last_name)), '\s+'), lambda x: x <> '') AS tokens, string_split_regex(lower(o.published_name), '[^a-záčďéěíňóřšťúůýž0-9]+') AS shown,
  regexp_replace(lower(regexp_extract(o.source_url, '^https?://([^/]*)', 1)), '^www[.]', '') AS source_host, regexp_replace(lower(regexp_extract(s.website, '^https?://([^/]*)', 1)), '^www[.]', '') AS site_host
  FROM fx_reviewed o LEFT JOIN fx_reviewed_school s ON o.school_key = s.key),
judged AS (SELECT *, CASE WHEN key IS NULL THEN 'UNKNOWN_SCHOOL' ELSE concat_ws('; ',
  CASE WHEN name = '' OR address = '' OR type NOT IN ('ZŠ', 'SŠ', 'ZŠ+SŠ') THEN 'INCOMPLETE_SCHOOL' END,
  CASE WHEN scope <> 'Praha' OR NOT regexp_matches(address, '(?i)praha|prague') OR regexp_matches(address, '(?i)praha\s*-\s*(východ|západ)') THEN 'OUTSIDE_SCOPE' END,
  CASE WHEN NOT contains(site_host, '.') OR NOT regexp_matches(address_source_url, '^https?://') THEN 'INVALID_SCHOOL_SOURCE' END,
  CASE WHEN source_host = '' THEN 'INVALID_CONTACT_SOURCE' END,
  CASE WHEN source_host <> '' AND contains(site_host, '.') AND source_host <> site_host THEN 'NON_OFFICIAL_CONTACT_SOURCE' END,
  CASE WHEN NOT named THEN 'MISSING_NAME' END,
  CASE WHEN named AND regexp_matches(first_name || last_name, '[0-9]') THEN 'INVALID_NAME' END,
  CASE WHEN named AND list_has_any(tokens, ['google', 'classroom', 'microsoft', 'facebook', 'instagram', 'kontakt', 'kontakty', 'škola', 'school']) THEN 'NON_PERSON_NAME' END,
  CASE WHEN named AND NOT list_has_all(shown, tokens) THEN 'NAME_NOT_IN_EVIDENCE' END,
  CASE WHEN NOT regexp_matches(mail, '^[^@\s]+@[^@\s]+[.][a-z]{2,}$') THEN 'INVALID_EMAIL_SYNTAX' END,
  CASE WHEN mail <> replace(published_email, ' (at) ', '@') THEN 'EMAIL_NOT_PUBLISHED' END,
  CASE WHEN split_part(mail, '@', 1) IN ('info', 'office', 'skola', 'school', 'sekretariat', 'kancelar', 'podatelna') THEN 'GENERIC_MAILBOX' END,
  CASE WHEN alternate NOT IN ('', mail) THEN 'CONFLICTING_PUBLISHED_EMAILS' END,
  CASE WHEN NOT reviewed THEN 'SOURCE_REVIEW_REQUIRED' END,
  CASE WHEN valid_until IS NOT NULL AND (TRY_CAST(valid_until AS DATE) IS NULL OR valid_until < '2026-01-01') THEN 'EXPIRED_ASSOCIATION' END,
  CASE WHEN valid_from IS NOT NULL AND (TRY_CAST(valid_from AS DATE) IS NULL OR valid_from > '2026-01-01') THEN 'FUTURE_ASSOCIATION' END) END AS errors FROM met)"""


@query("SELECT k, errors FROM judged", "fx_reviewed fx_reviewed_school", _CODES)
def pilot_validate(spark, sf):
    """All codes over observations with every kind of fault."""
    obs = read(spark, sf, "fx_reviewed").withColumn("alternate_emails", F.filter(F.array("alternate"), lambda e: e != ""))
    met = obs.alias("o").join(read(spark, sf, "fx_reviewed_school").alias("s"), F.col("o.school_key") == F.col("s.key"), "left")
    return met.select("o.k", F.array_join(C.observation_errors(date=F.lit("2026-01-01")), "; ").alias("errors"))


@query(
    """SELECT (SELECT count(*) FROM fx_reviewed_school) AS schools, count(DISTINCT school) FILTER (persons = 1) AS schools_with_contacts, count_if(persons = 1) AS contacts, count(DISTINCT (school, person)) FILTER (persons = 1) AS pairs,
    CAST(coalesce(sum(n - 1) FILTER (persons = 1), 0) AS BIGINT) AS duplicates, CAST((SELECT count(*) FROM judged WHERE errors <> '') + coalesce(sum(n) FILTER (persons > 1), 0) AS BIGINT) AS review
    FROM (SELECT school_key AS school, mail, count(DISTINCT lower(first_name || '|' || last_name)) AS persons, min(lower(first_name || '|' || last_name)) AS person, count(*) AS n FROM judged WHERE errors = '' GROUP BY 1, 2)""",
    "fx_reviewed fx_reviewed_school",
    _CODES,
)
def pilot_summary(spark, sf):
    """Mailboxes of several persons go to review, the rest is counted."""
    obs = read(spark, sf, "fx_reviewed").withColumn("alternate_emails", F.filter(F.array("alternate"), lambda e: e != ""))
    schools = read(spark, sf, "fx_reviewed_school")
    good, bad = C.accept_reviewed(obs, schools, "2026-01-01")
    rows = good.select(F.col("school_key").alias("school"), F.lower("email").alias("mailbox"), F.lower(F.concat_ws("|", "first_name", "last_name")).alias("person"))
    keys = rows.groupBy("school", "mailbox").agg(F.count_distinct("person").alias("persons"), F.min("person").alias("person"), F.count(F.lit(1)).alias("n"))
    one = F.col("persons") == 1
    totals = keys.agg(
        F.count_distinct(F.when(one, F.col("school"))).alias("schools_with_contacts"), F.count_if(one).alias("contacts"), F.count_distinct(F.when(one, F.concat_ws("|", "school", "person"))).alias("pairs"),
        F.coalesce(F.sum(F.when(one, F.col("n") - 1)), F.lit(0)).alias("duplicates"), F.coalesce(F.sum(F.when(~one, F.col("n"))), F.lit(0)).alias("shared"),
    )
    counts = bad.agg(F.count(F.lit(1)).alias("rejected")).withColumn("_k", F.lit(1)).join(schools.agg(F.count(F.lit(1)).alias("schools")).withColumn("_k", F.lit(1)), "_k")
    return totals.withColumn("_k", F.lit(1)).join(counts, "_k").select("schools", "schools_with_contacts", "contacts", "pairs", "duplicates", (F.col("rejected") + F.col("shared")).alias("review"))


@query(
    """SELECT k, CASE WHEN k % 6 = 0 OR k % 10 = 0 THEN 'INCOMPLETE_RECORD' WHEN k % 4 <> 0 OR k % 5 <> 0 THEN 'NAME_EVIDENCE_MISMATCH' END AS reason FROM fx_person""",
    "fx_person",
)
def batch_gate(spark, sf):
    k = F.col("k")
    rows = read(spark, sf, "fx_person").select(
        "k", "first_name", "last_name", F.when(k % 6 == 0, "").otherwise("https://zs.example.org").alias("website"), F.lit("https://zs.example.org/k").alias("source"), F.lit("Jan Novak, ucitel").alias("evidence"),
        F.when(k % 10 == 0, "a..b@zs.cz").otherwise(F.concat("local", F.lit("@"), "host")).alias("email"),
    )
    return rows.select("k", C.batch_reason(F.col).alias("reason"))


_REVIEW = """review AS (SELECT l_suppkey % 20 AS school, CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE 'm' || (l_partkey % 30) || '@example.org' END AS email, CASE WHEN l_partkey % 3 = 0 THEN 'Jan' END AS name,
  CASE l_linenumber % 4 WHEN 0 THEN 'EMAIL_WITHOUT_PERSON' WHEN 1 THEN 'AMBIGUOUS_BLOCK' WHEN 2 THEN 'LINK_TEXT_CONFLICT' ELSE 'GENERAL_MAILBOX' END AS reason, 'https://example.org/' || (l_orderkey % 3) AS url FROM lineitem),
accepted AS (SELECT DISTINCT school, email FROM review WHERE school % 2 = 0 AND email IS NOT NULL)"""


@query(
    """SELECT school, coalesce(email, name, '') AS who, reason, url FROM review WHERE NOT (name IS NULL AND reason IN ('EMAIL_WITHOUT_PERSON', 'GENERAL_MAILBOX'))
    AND (email IS NULL OR reason LIKE '%CONFLICT%' OR (school, email) NOT IN (SELECT (school, email) FROM accepted)) GROUP BY ALL""",
    "",
    _REVIEW,
)
def review_prune(spark, sf):
    li = read(spark, sf, "lineitem")
    review = li.selectExpr(
        "l_suppkey % 20 AS school", "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE concat('m', l_partkey % 30, '@example.org') END AS email", "CASE WHEN l_partkey % 3 = 0 THEN 'Jan' END AS name",
        "CASE l_linenumber % 4 WHEN 0 THEN 'EMAIL_WITHOUT_PERSON' WHEN 1 THEN 'AMBIGUOUS_BLOCK' WHEN 2 THEN 'LINK_TEXT_CONFLICT' ELSE 'GENERAL_MAILBOX' END AS reason", "concat('https://example.org/', l_orderkey % 3) AS url", "l_orderkey AS pos",
    )
    accepted = review.filter("school % 2 = 0 AND email IS NOT NULL")
    return C.prune_review(review, accepted).select("school", F.coalesce("email", "name", F.lit("")).alias("who"), "reason", "url")




@query(
    """SELECT item_id, doc_id, n FROM (SELECT b.item_id, d.doc_id, count(*) AS n FROM (SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest(string_split_regex(strip_accents(lower(text)), '[^a-z0-9]+')) AS t FROM benchmark) WHERE length(t) >= 7) b
    JOIN (SELECT DISTINCT doc_id, t FROM (SELECT doc_id, unnest(string_split_regex(strip_accents(lower(text)), '[^a-z0-9]+')) AS t FROM documents) WHERE length(t) >= 7) d ON b.t = d.t GROUP BY 1, 2) WHERE n >= 2"""
)
def signal_sum(spark, sf):
    """Shared distinctive words of two texts, met by an equi-join on the words and summed."""
    from ..functions.text import fold

    def words(name, key):
        return read(spark, sf, name).select(key, F.explode(F.array_distinct(F.filter(F.split(fold(F.col("text")), "[^a-z0-9]+"), lambda t: F.length(t) >= 7))).alias("t"))

    met = words("documents", "doc_id").join(words("benchmark", "item_id"), "t")
    return met.groupBy("item_id", "doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")




def _candidates(spark, sf):
    """Pages beside organisations: (k, html, organisation columns)."""
    return read(spark, sf, "customer", spread=True).selectExpr(
        "c_custkey AS k", "concat('<p>IČO 70', c_custkey % 50, ' Dlouhá ', c_custkey % 40, ' info', c_custkey % 20, '@example.org Zvonice Alfa</p>') AS html",
        "concat('70', c_custkey % 70) AS ico", "cast(NULL AS STRING) AS red_izo", "array(concat('info', c_custkey % 30, '@example.org')) AS mails", "concat('Dlouhá ', c_custkey % 60) AS street", "CASE c_custkey % 3 WHEN 0 THEN 'Základní škola Zvonice Alfa' WHEN 1 THEN 'Škola Zvonice' ELSE 'Škola' END AS name",
    )


# the same signals over the numbers the pages are made of
_SIG = """sig AS (SELECT c_custkey AS k, contains('ico 70' || (c_custkey % 50) || ' dlouha ' || (c_custkey % 40) || ' info' || (c_custkey % 20) || '@example.org zvonice alfa', '70' || (c_custkey % 70)) AS ico,
  contains('info' || (c_custkey % 20) || '@example.org', 'info' || (c_custkey % 30) || '@example.org') AS mail, list_contains(['70' || (c_custkey % 50), '' || (c_custkey % 40), '' || (c_custkey % 20)], '' || (c_custkey % 60)) AS number,
  c_custkey % 3 = 0 AS name2, c_custkey % 3 = 1 AS name1, '70' || (c_custkey % 50) = '70' || (c_custkey % 70) AS ico_token FROM customer)"""
_SCORE = "CAST(CASE WHEN ico THEN 5 ELSE 0 END + CASE WHEN mail THEN 4 ELSE 0 END + 2 + CASE WHEN number THEN 1 ELSE 0 END + CASE WHEN name2 THEN 3 WHEN name1 THEN 1 ELSE 0 END AS BIGINT)"


@query(f"SELECT k, {_SCORE} AS score, CASE WHEN {_SCORE} >= 5 AND CAST(ico AS INT) + CAST(mail AS INT) + 1 + CAST(name2 AS INT) >= 2 THEN 'VERIFIED' ELSE 'UNKNOWN' END AS status FROM sig", "", _SIG)
def identity_score_classic(spark, sf):
    c = F.col
    v = I.classic_signals(c("html"), c("ico"), c("red_izo"), c("mails"), c("street"), c("name"))
    return _candidates(spark, sf).select("k", v.alias("v")).select("k", "v.score", "v.status")


@query(
    """SELECT k, concat_ws(' ', CASE WHEN ico_token THEN 'ico' END, CASE WHEN mail_eq THEN 'registryEmail' END, 'street', CASE WHEN name THEN 'name' END) AS signals, true AND (ico_token OR mail_eq OR name) AS ok FROM
    (SELECT k, ico_token, k % 20 = k % 30 AS mail_eq, k % 3 <> 2 AS name FROM sig)""",
    "",
    _SIG,
)
def identity_signals_batch(spark, sf):
    c = F.col
    mails = F.array(F.regexp_extract("html", "(info[0-9]+@example.org)", 1))
    s = I.batch_signals(c("html"), mails, c("ico"), c("red_izo"), c("mails"), c("street"), c("name"))
    return _candidates(spark, sf).select("k", s.alias("s")).select("k", F.array_join("s", " ").alias("signals"), I.identity_ok(F.col("s")).alias("ok"))


@query(
    """SELECT o_custkey AS school, arg_min(pos, (status <> 'VERIFIED', CASE WHEN status = 'VERIFIED' THEN 0 ELSE -score END, pos)) AS pos FROM (SELECT o_custkey, o_orderkey AS pos, CASE WHEN o_orderkey % 7 = 0 THEN 'VERIFIED' ELSE 'UNKNOWN' END AS status, o_orderkey % 13 AS score FROM orders) GROUP BY 1"""
)
def best_candidate(spark, sf):
    rows = read(spark, sf, "orders").selectExpr("o_custkey AS school", "o_orderkey AS pos", "CASE WHEN o_orderkey % 7 = 0 THEN 'VERIFIED' ELSE 'UNKNOWN' END AS status", "o_orderkey % 13 AS score")
    return I.best_candidate(rows, "school").select("school", "pos")


@query("SELECT url, arg_max(k, (taken, text)) AS k FROM (SELECT page_id AS k, split_part(url, '?', 1) AS url, 200 + 204 * CAST(page_id % 9 = 0 AS INT) AS status, lpad('' || (page_id * 7 % 100), 3, '0') AS taken, lpad('' || page_id, 9, '0') AS text FROM pages) WHERE status = 200 GROUP BY url")
def capture_index(spark, sf):
    rows = read(spark, sf, "pages").selectExpr("page_id AS k", "split_part(url, '?', 1) AS url", "CASE WHEN page_id % 9 = 0 THEN 404 ELSE 200 END AS status", "lpad(cast(page_id * 7 % 100 AS STRING), 3, '0') AS at", "lpad(cast(page_id AS STRING), 9, '0') AS text")
    return S.capture_index(rows).select("url", "k")


@query("SELECT page_id, CASE WHEN page_id % 9 = 0 THEN 'SOURCE_CAPTURE_MISSING:' || url END AS note FROM (SELECT page_id, page_id || url AS url FROM pages)")
def reparse_missing(spark, sf):
    pages = read(spark, sf, "pages").select("page_id", F.concat(F.col("page_id").cast("string"), "url").alias("url"), F.col("html").alias("text"))
    return S.with_captures(pages.select("page_id", "url"), pages.filter("page_id % 9 != 0")).select("page_id", "note")


@query("SELECT o_orderpriority AS value, dense_rank() OVER (ORDER BY p) - 1 AS code FROM (SELECT o_orderpriority, min(o_orderkey) AS p FROM orders GROUP BY 1)")
def delivery_dictionary(spark, sf):
    """Codes by first appearance; the dictionary is one row a value."""
    return dictionary(read(spark, sf, "orders"), "o_orderpriority", "o_orderkey").withColumnRenamed("o_orderpriority", "value")


@query(
    """SELECT user_id, count(*) AS n, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS kinds, bool_and(value >= 0) AS every, bool_or(value > 90) AS some, list_sort(list(event_type))[1] AS first_kind, list_sort(list(event_type))[-1] AS last_kind FROM events GROUP BY user_id"""
)
def array_toolkit(spark, sf):
    """N3, N5–N8."""
    rows = read(spark, sf, "events").groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("event_type", "value"))).alias("e"))
    kind = F.transform("e", lambda x: x["event_type"])
    return rows.select(
        "user_id", F.size("e").cast("long").alias("n"), F.array_join(F.array_sort(F.array_distinct(kind)), ",").alias("kinds"), F.forall("e", lambda x: x["value"] >= 0).alias("every"), F.exists("e", lambda x: x["value"] > 90).alias("some"),
        F.get(kind, F.lit(0)).alias("first_kind"), F.element_at(kind, -1).alias("last_kind"),
    )


@query("SELECT l_shipdate AS day, count(*) AS n FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS l_shipdate, l_suppkey FROM lineitem WHERE l_linestatus = 'O' EXCEPT SELECT CAST(l_shipdate AS DATE), l_suppkey FROM lineitem WHERE l_returnflag = 'R') GROUP BY 1")
def set_difference(spark, sf):
    """U2, U3."""
    li = read(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("day"), "l_suppkey", "l_returnflag", "l_linestatus")
    left, right = (x.select("day", "l_suppkey").distinct() for x in (li.filter("l_linestatus = 'O'"), li.filter("l_returnflag = 'R'")))
    return left.join(right, ["day", "l_suppkey"], "left_anti").groupBy("day").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT row_number() OVER (ORDER BY name COLLATE cs, last_name COLLATE cs, first_name COLLATE cs, k) AS rank, k, name FROM (SELECT k, first_name, last_name, (['Čtvrtá', 'Cihlářská', 'Chodovická', 'Hlavní', 'Šestá', 'Sadová', 'Žitná'])[CAST(k % 7 + 1 AS INT)] AS name FROM fx_person)", "fx_person")
def export_czech_order(spark, sf):
    """Schools, then people in Czech order (ch after h, č after c)."""
    from ..operators.delivery import czech, ranked

    names = F.array(*map(F.lit, ("Čtvrtá", "Cihlářská", "Chodovická", "Hlavní", "Šestá", "Sadová", "Žitná")))
    rows = read(spark, sf, "fx_person").withColumn("name", F.get(names, (F.col("k") % 7).cast("int")))
    return ranked(rows, [czech(F.col("name")), czech(F.col("last_name")), czech(F.col("first_name")), F.col("k")]).select("rank", "k", "name")


@query("SELECT school, mailbox FROM (SELECT school, mailbox, max(observed_at) AS last_observed_at FROM fx_obs GROUP BY 1, 2) WHERE last_observed_at > DATE '1998-10-01'", "fx_obs")
def ledger_newer(spark, sf):
    """What a ledger holds from after a capture of 1998-10-01; the job stops if there is any."""
    ledger = read(spark, sf, "fx_obs").groupBy("school", "mailbox").agg(F.max("observed_at").alias("last_observed_at"))
    return C.newer(ledger, F.lit("1998-10-01").cast("date")).select("school", "mailbox")
