"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_tokens
from .chat import PART, format_conversations, loss_text, parse_conversation, text_part
from .langid import learn_prototypes, predict_languages
from .licenses import scan_licenses
from .media import media_columns
from .mixing import fair_schedule
from .quality import fit_quality, quality_scores
from .sharding import shard_documents
from .simhash import simhash_components
from .toxicity import fit_toxicity, score_toxicity


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_read(spark, sf_dir, "documents"), 24).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(_read(spark, sf_dir, "documents"), keep_media=True)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_read(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op4_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair_schedule(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(tricky).alias("text"))
    turns = rows.unionByName(extra)
    formatted = format_conversations(turns.withColumn("parts", F.array(text_part(F.col("text"))).cast(f"array<{PART}>")))
    read = formatted.withColumns({"back": parse_conversation(F.col("formatted")), "loss": loss_text(F.col("formatted"), F.col("loss_spans"))})
    said = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, _read(spark, sf_dir, "labels")))


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe_tokens(_read(spark, sf_dir, "documents"), vocabulary_path(), decoded=True)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return predict_languages(docs, learn_prototypes(docs))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return quality_scores(docs, fit_quality(docs, _read(spark, sf_dir, "labels")))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_read(spark, sf_dir, "documents")).select("doc_id", "license", "dice", F.size("matches").cast("long").alias("n_matches"), "matches")


QUERIES = {f.__name__: f for f in (op1_feistel_shards, op2_media_columns, op3_simhash, op4_fair_mix, op5_chat_format, op6_toxicity, op7_bpe_round_trip, op8_language_id, op9_quality_rules, op10_license_scan)}

_MIX_SQL = r"""
WITH slim AS (
  SELECT row_number() OVER () AS n, doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(md5(text), 'null')) AS digest
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM slim GROUP BY source),
placed AS (
  SELECT *, row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) AS place FROM sources),
weighed AS (
  SELECT *, [3, 1, 2][CAST((place - 1) % 3 + 1 AS INT)] AS weight FROM placed),
levels AS (
  SELECT *,
    3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) OVER (ORDER BY CAST(source_size AS DOUBLE) / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS unspent,
    2 * sum(weight) OVER (ORDER BY CAST(source_size AS DOUBLE) / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM weighed),
level AS (
  SELECT unspent, weights FROM levels WHERE weight * unspent <= 2 * source_size * weights
  ORDER BY CAST(source_size AS DOUBLE) / weight, place LIMIT 1),
targets AS (
  SELECT l.source, l.source_size, l.place,
    least(CAST(2 * l.source_size AS DOUBLE), CAST(CAST(l.weight * v.unspent AS BIGINT) AS DOUBLE) / CAST(CAST(v.weights AS BIGINT) AS DOUBLE)) AS target
  FROM levels l, level v),
queued AS (
  SELECT s.*, t.source_size, t.target, t.place,
    coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY digest, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM slim s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
served AS (
  SELECT n, place, copy * source_size + start AS begins, size, target,
    CAST(copy * source_size + start + size AS DOUBLE) / target AS finish
  FROM queued, range(2) c(copy) WHERE size > 0 AND copy * source_size + start < target),
stream AS (
  SELECT n, least(size, ceil(target) - begins) AS words,
    coalesce(sum(least(size, ceil(target) - begins)) OVER (ORDER BY finish, place, begins ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM served),
taken AS (
  SELECT n, sum(least(words, b.budget - before)) AS taken
  FROM stream, (SELECT CAST(floor(sum(source_size) * 3 / 2) AS BIGINT) AS budget FROM sources) b
  WHERE before < b.budget GROUP BY n)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM queued LEFT JOIN taken USING (n)
"""

_CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length(role || text) + length(regexp_replace(role || text, '[^\\<\[\]]', '', 'g')) + 11 AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

ORACLE_SQL = {"op4_fair_mix": _MIX_SQL, "op5_chat_format": _CHAT_SQL}
