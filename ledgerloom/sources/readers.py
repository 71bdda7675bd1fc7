"""Captured inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.contacts import keep_last
from ..operators.registry import PAYLOAD

CAPTURE = "url string, status int, text string, at string"
SCAN = "parserVersion int, school struct<externalRegistryId:string,name:string,addressFull:string>, website string, contacts array<struct<firstName:string,lastName:string,email:string,role:string,sourceUrl:string,evidenceText:string,observedAt:string>>, review array<struct<email:string,name:string,reason:string,url:string>>, notes array<string>, pages array<struct<url:string,observedAt:string,contacts:int,names:int>>, remainingRelevantPages int"
REVIEWED = "schemaVersion int, collectionDate string, collectionMethod string, schools array<struct<key:string,name:string,type:string,scope:string,address:string,website:string,addressSourceUrl:string>>, observations array<struct<schoolKey:string,firstName:string,lastName:string,email:string,publishedName:string,publishedEmail:string,role:string,sourceUrl:string,reviewed:boolean,alternateEmails:array<string>,validFrom:string,validUntil:string>>, unresolved array<struct<schoolKey:string,name:string,reason:string>>"


def registry_payload(spark: SparkSession, path: str) -> DataFrame:
    """A registry snapshot file as one parsed row; the schema is fixed, never inferred."""
    return spark.read.text(path, wholetext=True).select(F.from_json("value", PAYLOAD).alias("p"))


def checkpoints(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of <digits>.json scan records with their file id; the key also comes from the content."""
    rows = spark.read.schema(SCAN).option("multiLine", True).json(folder).withColumn("file", F.col("_metadata.file_name"))
    return rows.filter(F.col("file").rlike("^[0-9]+[.]json$")).withColumn("file_id", F.regexp_extract("file", "^([0-9]+)", 1)).drop("file")


def captures(spark: SparkSession, folder: str) -> DataFrame:
    """Gzipped page captures by final URL, status 200 only, the last one of each."""
    rows = spark.read.schema(CAPTURE).option("multiLine", True).option("pathGlobFilter", "*.json.gz").json(folder)
    return capture_index(rows)


def capture_index(rows: DataFrame) -> DataFrame:
    return keep_last(rows.filter("status = 200 and url is not null"), ["url"], ["at", "text"])


def rendered_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Rendered pages named by the digest of their URL."""
    rows = spark.read.option("pathGlobFilter", "*.{html,html.gz}").text(folder, wholetext=True).withColumn("file", F.col("_metadata.file_name"))
    return rows.select(F.regexp_extract("file", "^([0-9a-f]{64})", 1).alias("url_digest"), F.col("value").alias("html")).filter("url_digest != ''")


PROFILES = "expected int, names array<string>, exhausted boolean, observations array<struct<idx:int,status:string,cardName:string,publishedName:string,publishedEmails:array<string>,text:string,observedAt:string>>"


def profile_captures(spark: SparkSession, folder: str) -> DataFrame:
    """Gzipped profile captures named by the digest of their URL: url_digest and the capture's columns."""
    rows = spark.read.schema(PROFILES).option("multiLine", True).option("pathGlobFilter", "*.profiles.json.gz").json(folder).withColumn("file", F.col("_metadata.file_name"))
    return rows.withColumn("url_digest", F.regexp_extract("file", "^([0-9a-f]{64})", 1)).filter("url_digest != ''").drop("file")


def snapshot(spark: SparkSession, path: str) -> DataFrame:
    """A registry snapshot file as (file, sha256, payload): the digest is that of the file's bytes."""
    rows = spark.read.format("binaryFile").load(path)
    return rows.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.sha2("content", 256).alias("sha256"), F.decode("content", "UTF-8").alias("payload"))


def reviewed_capture(spark: SparkSession, path: str) -> DataFrame:
    """The reviewed capture as one row; another version or method is an error."""
    row = spark.read.schema(REVIEWED).option("multiLine", True).option("mode", "FAILFAST").json(path)
    ok = (F.col("schemaVersion") == 1) & F.col("collectionDate").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & (F.col("collectionMethod") == "ASSISTED_PUBLIC_WEB_REVIEW") & F.col("schools").isNotNull() & F.col("observations").isNotNull()
    if row.filter(~F.coalesce(ok, F.lit(False))).count() or row.isEmpty():
        raise ValueError("not a reviewed capture")
    return row


def with_captures(pages: DataFrame, index: DataFrame) -> DataFrame:
    """Pages with their captured text and a note for those that have none."""
    met = pages.join(index.select("url", F.col("text").alias("captured"), F.lit(True).alias("_hit")), "url", "left")
    return met.withColumn("note", F.when(F.col("_hit").isNull(), F.concat(F.lit("SOURCE_CAPTURE_MISSING:"), F.col("url")))).drop("_hit")


def existing(current: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """S3: the rows whose key is among the ids."""
    return current.join(ids.select(key).distinct(), key, "left_semi")


def unresolved(schools: DataFrame, n: int | None = None) -> DataFrame:
    """Schools of unknown website by name; all of them unless n is given."""
    rows = schools.filter((F.col("website_status") == "UNKNOWN") & F.col("school_type").isin("PRIMARY", "SECONDARY", "PRIMARY_AND_SECONDARY")).orderBy("name", "school")
    return rows.limit(n) if n else rows


def crawlable(schools: DataFrame, region: str | None = None, n: int | None = None) -> DataFrame:
    """Schools with a verified website by name, of a region if one is given."""
    rows = schools.filter((F.col("website_status") == "VERIFIED") & F.col("website").isNotNull() & F.col("school_type").isin("PRIMARY", "SECONDARY", "PRIMARY_AND_SECONDARY"))
    rows = rows.filter(F.col("region") == region) if region else rows
    return rows.orderBy("name", "school").limit(n) if n else rows.orderBy("name", "school")


def assert_one_city(rows: DataFrame, city: str) -> DataFrame:
    """Every row is of the city, else an error."""
    if not rows.filter(~F.coalesce(F.col("city") == city, F.lit(False))).isEmpty():
        raise ValueError(f"rows outside {city}")
    return rows
