"""Queries over scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import emails, text
from ..functions import registry as R
from ..operators import contacts as C
from ..sources.sinks import csv_lines
from .catalogue import query
from .fixtures import read

_N = "lower(trim(raw, ' '))"


@query(f"SELECT k, {_N} AS email FROM fx_email", "fx_email")
def email_normalize(spark, sf):
    return read(spark, sf, "fx_email").select("k", emails.normalize(F.col("raw")).alias("email"))


@query(rf"SELECT k, regexp_matches({_N}, '^[^\s@]+@[^\s@]+[.][^\s@]+$') AS ok FROM fx_email", "fx_email")
def email_valid_classic(spark, sf):
    return read(spark, sf, "fx_email").select("k", emails.valid(F.col("raw"), "classic").alias("ok"))


_TWO = "string_split(raw, '@')[1] AS a, string_split(raw, '@')[2] AS d"
_LOCAL = "length(raw) <= 254 AND len(string_split(raw, '@')) = 2 AND a <> '' AND length(a) <= 64 AND a NOT LIKE '.%' AND a NOT LIKE '%.' AND NOT contains(a, '..') AND contains(d, '.')"


@query(
    rf"""SELECT k, coalesce({_LOCAL} AND regexp_matches(raw, '^[!-~]*$') AND NOT regexp_matches(raw, '[<>",;:]') AND
    len(list_filter(string_split(d, '.'), lambda x: NOT regexp_matches(lower(x), '^[a-z0-9]([a-z0-9-]*[a-z0-9])?$'))) = 0, false) AS ok FROM (SELECT k, raw, {_TWO} FROM fx_email)""",
    "fx_email",
)
def email_valid_batch(spark, sf):
    return read(spark, sf, "fx_email").select("k", emails.valid(F.col("raw"), "batch").alias("ok"))


@query(
    rf"""SELECT k, coalesce({_LOCAL} AND regexp_matches(lower(a), '^[a-z0-9.!#$%&''*+/=?^_`{{|}}~-]+$') AND length(d) <= 253 AND
    len(list_filter(string_split(d, '.'), lambda x: length(x) > 63 OR NOT regexp_matches(lower(x), '^[a-z0-9]([a-z0-9-]*[a-z0-9])?$'))) = 0 AND regexp_matches(lower(string_split(d, '.')[-1]), '^[a-z]{{2,63}}$'), false) AS ok
    FROM (SELECT k, raw, {_TWO} FROM fx_email)""",
    "fx_email",
)
def email_valid_pilot(spark, sf):
    return read(spark, sf, "fx_email").select("k", emails.valid(F.col("raw"), "pilot").alias("ok"))


_AT = f"nullif(regexp_extract({_N}, '^(.+)@[^@]*$', 1), '')"
_HOST = f"regexp_replace(regexp_extract({_N}, '@([^@]*)$', 1), '^www[.]', '')"


@query(rf"SELECT k, {_AT} AS local_part, CASE WHEN {_AT} IS NOT NULL AND contains({_HOST}, '.') AND NOT regexp_matches({_HOST}, '\s') THEN {_HOST} END AS host FROM fx_email", "fx_email")
def email_local_domain(spark, sf):
    return read(spark, sf, "fx_email").select("k", emails.local_part(F.col("raw")).alias("local_part"), emails.domain(F.col("raw")).alias("host"))


@query(
    f"""SELECT k, coalesce({_AT} IN ('info','skola','school','office','sekretariat','sekretariát','kancelar','kancelář','recepce','kontakt','mail','email','podatelna','admin','webmaster','noreply','no-reply','support'), false) AS generic,
    coalesce(CASE WHEN {_AT} IS NOT NULL AND contains({_HOST}, '.') THEN {_HOST} END IN ('gmail.com','googlemail.com','seznam.cz','email.cz','post.cz','centrum.cz','atlas.cz','volny.cz','outlook.com','hotmail.com','live.com','icloud.com','me.com','yahoo.com','yahoo.co.uk','tiscali.cz','quick.cz'), false) AS freemail FROM fx_email""",
    "fx_email",
)
def email_generic_freemail(spark, sf):
    return read(spark, sf, "fx_email").select("k", emails.is_generic(F.col("raw"), "batch").alias("generic"), emails.is_freemail(emails.domain(F.col("raw")), "batch").alias("freemail"))


_DECODE = r"regexp_replace(regexp_replace({0}, '(?i)\s*(\[\s*(at|zavin[aá]č)\s*\]|\(\s*(at|zavin[aá]č)\s*\))\s*', '@', 'g'), '(?i)\s*(\[\s*(dot|tečka)\s*\]|\(\s*(dot|tečka)\s*\))\s*', '.', 'g')"


@query(f"SELECT k, {_DECODE.format('raw')} AS decoded FROM fx_hidden", "fx_hidden")
def email_deobfuscate(spark, sf):
    return read(spark, sf, "fx_hidden").select("k", emails.decode_published(F.col("raw")).alias("decoded"))


@query(
    rf"""SELECT k, lower(regexp_replace({_DECODE.format("replace(string_split(regexp_replace(trim(raw, ' '), '(?i)^mailto:', ''), '?')[1], '%40', '@')")}, '\s*@\s*', '@', 'g')) AS email,
    nullif(trim(replace(string_split(regexp_replace(raw, '(?i)^mailto:', ''), '?')[1], '%40', '@'), ' '), '') AS from_link FROM fx_hidden""",
    "fx_hidden",
)
def email_published_normalize(spark, sf):
    return read(spark, sf, "fx_hidden").select("k", emails.normalize_published(F.col("raw")).alias("email"), emails.from_mailto(F.col("raw")).alias("from_link"))


@query(r"""
SELECT doc_id, count(*) AS n, string_agg(email, ' ' ORDER BY pos) AS found FROM (
  SELECT doc_id, email, min(pos) AS pos FROM (
    SELECT doc_id, lower(trim(unnest(m), '.')) AS email, generate_subscripts(m, 1) AS pos FROM (
      SELECT doc_id, regexp_extract_all(text, '(?i)[A-Z0-9.!#$%&''*+/=?^_`{|}~-]+@[A-Z0-9.-]+[.][A-Z]{2,}') AS m FROM documents))
  WHERE NOT contains(string_split(email, '@')[1], '..') AND email NOT LIKE '.%' AND NOT regexp_matches(string_split(email, '@')[1], '[.]$|''') AND NOT contains(string_split(email, '@')[2], '..')
  GROUP BY 1, 2) GROUP BY 1""")
def email_extract_documents(spark, sf):
    # a native look for the sign first: most texts hold none
    docs = read(spark, sf, "documents").filter(F.lower("text").rlike("@|at\\s*[\\])]|zavin"))
    found = docs.select("doc_id", emails.extract(F.col("text")).alias("e")).filter(F.size("e") > 0)
    return found.select("doc_id", F.size("e").cast("long").alias("n"), F.array_join("e", " ").alias("found"))


_FOLD = "strip_accents(lower({0}))"
_F, _L = "regexp_replace(strip_accents(lower(first_name)), '[^a-z]', '', 'g')", "regexp_replace(strip_accents(lower(last_name)), '[^a-z]', '', 'g')"


@query(
    f"""SELECT k, CASE local WHEN l THEN 0 WHEN f || '.' || l THEN 1 WHEN f[1] || l THEN 2 WHEN f[1] || '.' || l THEN 3 WHEN l || '.' || f THEN 4 WHEN f || l THEN 5 WHEN l || f[1] THEN 6 END AS code
    FROM (SELECT k, local, {_F} AS f, {_L} AS l FROM fx_person)""",
    "fx_person",
)
def email_pattern_code(spark, sf):
    return read(spark, sf, "fx_person").select("k", emails.pattern_code(F.col("first_name"), F.col("last_name"), F.col("local")).cast("int").alias("code"))


@query(r"SELECT doc_id, sha256(regexp_replace(strip_accents(lower(text)), '\s+', ' ', 'g')) AS digest FROM documents")
def text_fold(spark, sf):
    return read(spark, sf, "documents").select("doc_id", F.sha2(F.regexp_replace(text.fold(F.col("text")), r"\s+", " "), 256).alias("digest"))


@query("SELECT doc_id, sha256(trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', '-', 'g'), '-')) AS slug, sha256(trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', ' ', 'g'), ' ')) AS key FROM documents")
def text_slug(spark, sf):
    return read(spark, sf, "documents").select("doc_id", F.sha2(text.slug(F.col("text")), 256).alias("slug"), F.sha2(text.comparison_key(F.col("text")), 256).alias("key"))


@query(r"""SELECT page_id, sha256(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(strip_accents(lower(html)), '&nbsp;|&#160;', ' ', 'g'),
  '(?s)<script\b[^>]*>.*?</script>', ' ', 'g'), '(?s)<style\b[^>]*>.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '[^a-z0-9@.]+', ' ', 'g'), ' ')) AS digest FROM pages""")
def html_to_text(spark, sf):
    return read(spark, sf, "pages").select("page_id", F.sha2(text.html_text(F.col("html")), 256).alias("digest"))


_BEFORE = "prof|doc|Mgr|MgA|Ing|BcA|Bc|PhDr|RNDr|JUDr|PaedDr|ThDr|MUDr|MVDr|DiS|Dis|M[.]A|Ph[.]D"
_AFTER = r"Ing[.]?|Mgr[.]?|Bc[.]?|PhDr[.]?|RNDr[.]?|JUDr[.]?|MBA|Ph[.]?D[.]?|CSc[.]?|DiS[.]?|MSc[.]?|LLM|Dr[.]?|ak[.]?\s*mal[.]?|ml[.]?|st[.]?"
_BARE = rf"trim(regexp_replace(regexp_replace(trim(regexp_replace(raw, '\s+', ' ', 'g'), ' '), '(?i)^(({_BEFORE})([.]\s*|\s+))+', ''), '(?i)((,?\s+({_AFTER}))+$|\s*\([^)]*\)\s*$)', '', 'g'), ' ')"


@query(rf"SELECT k, {_BARE} AS bare, trim(regexp_replace(raw, '(?i)^((Mgr|Bc|Ing|PhDr|RNDr|JUDr|PaedDr|ThDr|MUDr|MVDr|doc|prof)[.]?\s+)+', ''), ' ') AS classic FROM fx_names", "fx_names")
def name_strip_titles(spark, sf):
    return read(spark, sf, "fx_names").select("k", text.strip_titles(F.col("raw")).alias("bare"), text.strip_titles(F.col("raw"), "classic").alias("classic"))


@query(r"SELECT k, regexp_replace(raw, '([a-záčďéěíňóřšťúůýž])([A-ZÁČĎÉĚÍŇÓŘŠŤÚŮÝŽ])', '\1 \2', 'g') AS apart FROM fx_context", "fx_context")
def name_boundaries(spark, sf):
    return read(spark, sf, "fx_context").select("k", text.boundaries(F.col("raw")).alias("apart"))


_ROLE = r"""CASE WHEN regexp_matches(lower(raw), 'ředitelka?') THEN 'ředitel/ředitelka' WHEN regexp_matches(lower(raw), 'zástup(ce|kyně)') THEN 'zástupce/zástupkyně' WHEN regexp_matches(lower(raw), 'ict\s+koordinátor') THEN 'ICT koordinátor/koordinátorka'
  WHEN regexp_matches(lower(raw), 'koordinátor(ka)?\s+ict') THEN 'ICT koordinátor/koordinátorka' WHEN regexp_matches(lower(raw), 'učitelka?') THEN 'učitel/učitelka' WHEN regexp_matches(lower(raw), 'pedagog') THEN 'pedagog'
  WHEN regexp_matches(lower(raw), 'sekretářka?') THEN 'sekretář/sekretářka' WHEN regexp_matches(lower(raw), 'ekonomka?') THEN 'ekonom/ekonomka' WHEN regexp_matches(lower(raw), 'hospodářka?') THEN 'hospodář/hospodářka'
  WHEN regexp_matches(lower(raw), 'výchovn(ý|á)\s+porad(ce|kyně)') THEN 'výchovný poradce/poradkyně' WHEN regexp_matches(lower(raw), 'metodik(čka)?\s+prevence') THEN 'metodik/metodička prevence'
  WHEN regexp_matches(lower(raw), 'školní\s+psycholog') THEN 'školní psycholog/psycholožka' WHEN regexp_matches(lower(raw), 'asistent') THEN 'asistent/asistentka' END"""


@query(f"SELECT k, {_ROLE} AS role FROM fx_context", "fx_context")
def role_first_match(spark, sf):
    return read(spark, sf, "fx_context").select("k", text.first_role(F.col("raw")).alias("role"))


@query(
    r"""SELECT k, coalesce(array_to_string(list_transform(list_filter(list_zip(m, range(1, len(m) + 1)), lambda x: list_position(m, x[1]) = x[2]), lambda x: x[1]), '; '), '') AS roles FROM (SELECT k, regexp_extract_all(raw,
    '(?i)ředitel(?:ka)?|zástup(?:ce|kyně)|třídní učitel(?:ka)?|učitel(?:ka)?|vychovatel(?:ka)?|asistent(?:ka)? pedagoga|psycholog(?:ka|žka)?|speciální pedagog|sociální pedagog|koordinátor(?:ka)?|metodik(?:čka)?|ekonom(?:ka)?|hospodář(?:ka)?|vedoucí[^\n]{0,45}|sekretář(?:ka)?') AS m FROM fx_context)""",
    "fx_context",
)
def role_all_matches(spark, sf):
    return read(spark, sf, "fx_context").select("k", text.all_roles(F.col("raw")).alias("roles"))


@query(
    f"""SELECT k, kind, least(80 + CASE WHEN kind = 'MAILTO' THEN 8 ELSE 0 END + CASE WHEN {_ROLE} IS NOT NULL THEN 6 ELSE 0 END + CASE WHEN regexp_matches(raw, '(?i)(^|[^A-Za-z0-9_])(Mgr|Bc|Ing|PhDr|RNDr|JUDr|PaedDr|ThDr|MUDr|MVDr|doc|prof)[.]') THEN 4 ELSE 0 END, 98) / 100.0::DOUBLE AS confidence
    FROM fx_context, (VALUES ('MAILTO'), ('TEXT')) AS kinds(kind)""",
    "fx_context",
)
def confidence_score(spark, sf):
    rows = read(spark, sf, "fx_context").withColumn("kind", F.explode(F.array(F.lit("MAILTO"), F.lit("TEXT"))))
    return rows.select("k", "kind", text.confidence(F.col("kind"), text.first_role(F.col("raw")), text.has_title(F.col("raw"))).alias("confidence"))


@query("SELECT doc_id, sha256(text) AS digest FROM documents")
def content_hash(spark, sf):
    return read(spark, sf, "documents").select("doc_id", text.sha256(F.col("text")).alias("digest"))


def _cell(c: str, guard: str = "", always: bool = False) -> str:
    v = f"coalesce({c}, '')"
    v = f"(CASE WHEN {guard.format(v)} THEN '''' || {v} ELSE {v} END)" if guard else v
    q = f"""'"' || replace({v}, '"', '""') || '"'"""
    return q if always else f"CASE WHEN regexp_matches({v}, '[;\"\\r\\n]') THEN {q} ELSE {v} END"


@query(f"SELECT k, {_cell('value')} AS cell FROM fx_cell", "fx_cell")
def csv_lines_classic(spark, sf):
    return read(spark, sf, "fx_cell").select("k", csv_lines(None, ["value"], "classic").alias("cell"))


_G1, _G2 = r"regexp_matches({0}, '^\s*[=+@-]')", r"(regexp_matches({0}, '^\s*[=+@-]') OR regexp_matches({0}, '^[\t\r\n]'))"


@query(f"SELECT k, {_cell('value', _G1)} AS batch, {_cell('value', _G2, True)} AS pilot FROM fx_cell", "fx_cell")
def csv_lines_guarded(spark, sf):
    return read(spark, sf, "fx_cell").select("k", csv_lines(None, ["value"], "batch").alias("batch"), csv_lines(None, ["value"], "pilot").alias("pilot"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS utc_day, strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Prague', '%Y-%m-%d') AS prague_day FROM events")
def prague_date(spark, sf):
    rows = read(spark, sf, "events")
    return rows.select("event_id", text.utc_date(F.col("ts")).alias("utc_day"), text.prague_date(F.col("ts")).alias("prague_day"))


@query("SELECT k, coalesce(regexp_matches(value, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') AND try_cast(value AS DATE) IS NOT NULL, false) AS ok FROM fx_dates", "fx_dates")
def valid_date(spark, sf):
    return read(spark, sf, "fx_dates").select("k", text.valid_date(F.col("value")).alias("ok"))


_OKD = "(regexp_matches({0}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') AND try_cast({0} AS DATE) IS NOT NULL)"


@query(
    f"""SELECT k, coalesce(until <> '' AND (NOT {_OKD.format("until")} OR until < '2026-01-01'), false) AS ended, coalesce(since <> '' AND (NOT {_OKD.format("since")} OR since > '2026-01-01'), false) AS unbegun FROM fx_valid""",
    "fx_valid",
)
def validity_interval(spark, sf):
    day = F.lit("2026-01-01")
    return read(spark, sf, "fx_valid").select("k", C.ended(F.col("until"), day).alias("ended"), C.unbegun(F.col("since"), day).alias("unbegun"))


_STREET = "nullif(concat_ws(' ', coalesce(nullif(trim(street), ''), nullif(trim(district), '')), coalesce(house || '/' || orientation || coalesce(suffix, ''), orientation || coalesce(suffix, ''), house)), '')"
_POST = "CASE WHEN regexp_matches(replace(postal, ' ', ''), '^[0-9]{5}$') THEN substr(replace(postal, ' ', ''), 1, 3) || ' ' || substr(replace(postal, ' ', ''), 4, 2) ELSE postal END"


@query(f"SELECT k, {_STREET} AS line, nullif(concat_ws(', ', {_STREET}, nullif(concat_ws(' ', {_POST}, city), '')), '') AS address FROM fx_address", "fx_address")
def address_format(spark, sf):
    a = F.col
    line = R.street(a("street"), a("district"), a("house"), a("orientation"), a("suffix"))
    return read(spark, sf, "fx_address").select("k", line.alias("line"), R.full_address(line, R.postal_code(a("postal")), a("city")).alias("address"))


@query(f"SELECT k, {_POST} AS postal FROM fx_address", "fx_address")
def postal_code(spark, sf):
    return read(spark, sf, "fx_address").select("k", R.postal_code(F.col("postal")).alias("postal"))


@query("SELECT school, CASE WHEN school_type IN ('PRIMARY', 'SECONDARY', 'PRIMARY_AND_SECONDARY') THEN school_type ELSE 'OTHER' END AS stored, CASE WHEN school_type = 'OTHER' THEN 'PRIMARY' ELSE school_type END AS read_back FROM fx_school", "fx_school")
def school_type_map(spark, sf):
    kind = F.col("school_type")
    return read(spark, sf, "fx_school").select("school", R.database_type(kind).alias("stored"), R.registry_type(kind).alias("read_back"))
