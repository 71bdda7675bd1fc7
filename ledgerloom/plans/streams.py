"""Queries over streams: the final state of a run over files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..sources.session import shared_folder
from ..streaming import ledger as T
from .catalogue import query
from .fixtures import FIXTURES, read


def _source(spark, sf, table):
    """The table's folder or file as a stream of files."""
    schema = spark.read.parquet(f"{sf}/{table}.parquet").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).option("pathGlobFilter", f"{table}.parquet").parquet(sf) if not _is_folder(spark, f"{sf}/{table}.parquet") else T.file_stream(spark, f"{sf}/{table}.parquet", schema)


def _is_folder(spark, path):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


@query("SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS sightings FROM events GROUP BY user_id")
def stream_first_last_seen(spark, sf):
    root = f"{shared_folder(spark)}/seen-{uuid.uuid4().hex}"
    agg = T.first_last_seen(_source(spark, sf, "events"), "user_id", "ts")
    empty = T.first_last_seen(read(spark, sf, "events").limit(0), "user_id", "ts")
    sink = T.SeenSink(root, empty, "user_id")
    T.run_once(agg, sink, f"{root}-checkpoint", "update")
    return sink.read(spark).select("user_id", "first_seen", "last_seen", "sightings")


@query(
    "SELECT school, mailbox, min(person) AS person, min(observed_at) AS collected_at, CASE WHEN count(DISTINCT person) > 1 THEN 'REVIEW_REQUIRED' ELSE 'SOURCE_CONFIRMED' END AS status FROM fx_obs GROUP BY 1, 2",
    "fx_obs",
)
def stream_ledger(spark, sf):
    root = f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}"
    obs = _source(spark, sf, "lineitem").selectExpr(*FIXTURES["fx_obs"].exprs)
    empty = spark.createDataFrame([], "school bigint, mailbox string, person bigint, collected_at date, last_observed_at date, suppressed boolean, status string, reason string")
    sink = T.LedgerSink(root, empty)
    T.run_once(obs, sink, f"{root}-checkpoint")
    return sink.read(spark).select("school", "mailbox", "person", "collected_at", "status")


@query("SELECT user_id, event_type, count(*) AS first_of_day FROM (SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events) GROUP BY 1, 2")
def stream_unique(spark, sf):
    """Of repeated keys one row each, state bounded by the watermark: events of a user, kind and day."""
    root = f"{shared_folder(spark)}/unique-{uuid.uuid4().hex}"
    rows = _source(spark, sf, "events").selectExpr("user_id", "event_type", "cast(ts AS DATE) AS day", "cast(ts AS TIMESTAMP) AS ts")
    once = T.unique_in_window(rows, ["user_id", "event_type", "day"], "ts", "400 days").select("user_id", "event_type", "day")
    once.writeStream.format("parquet").outputMode("append").option("path", root).option("checkpointLocation", f"{root}-checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(root).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("first_of_day"))
