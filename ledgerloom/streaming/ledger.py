"""Streams (X1–X4, X6): captured files in, ledger and first/last seen out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.contacts import merge_ledger


def file_stream(spark: SparkSession, folder: str, schema, files_per_batch: int = 100) -> DataFrame:
    """New Parquet files of a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def first_last_seen(stream: DataFrame, key: str, time: str) -> DataFrame:
    """First and last time of each key; state is one row a key."""
    return stream.groupBy(key).agg(F.min(time).alias("first_seen"), F.max(time).alias("last_seen"), F.count(F.lit(1)).alias("sightings"))


def unique_in_window(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """Repeated keys dropped, state bounded by the watermark."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


BUCKETS, KEPT = 64, 2  # parts of a table, and versions of a part that stay


class KeyedSink:
    """Each micro-batch merges into a table that is kept in parts by a hash of its keys.

    A batch reads and writes the parts that its keys fall in, under its own number:
    ``<root>/v=<number>/_b=<part>``. A part's latest version stands; one that is run
    again after a failure reads what was there before it and replaces its own
    half-written version only. Older versions go once KEPT newer ones stand.
    """

    def __init__(self, root: str, empty: DataFrame, keys: list[str], merge, buckets: int = BUCKETS):
        self.root, self.empty, self.keys, self.merge, self.buckets = root, empty, keys, merge, buckets

    def _versions(self, spark: SparkSession) -> dict[int, list[int]]:
        """The versions of every part, oldest first; half-written ones, without a mark of success, are none."""
        at = spark._jvm.org.apache.hadoop.fs.Path
        fs = at(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        found: dict[int, list[int]] = {}
        for v in fs.listStatus(at(self.root)) if fs.exists(at(self.root)) else []:
            name = v.getPath().getName()
            if name.startswith("v=") and fs.exists(at(f"{self.root}/{name}/_SUCCESS")):
                for b in fs.listStatus(v.getPath()):
                    if b.getPath().getName().startswith("_b="):
                        found.setdefault(int(b.getPath().getName()[3:]), []).append(int(name[2:]))
        return {b: sorted(v) for b, v in found.items()}

    def _path(self, version: int, part: int) -> str:
        return f"{self.root}/v={version:08d}/_b={part}"

    def read(self, spark: SparkSession, before: int | None = None, parts: set[int] | None = None) -> DataFrame:
        """The latest version of all parts (or of some, or the latest before a batch)."""
        latest = {b: [v for v in vs if before is None or v < before] for b, vs in self._versions(spark).items() if parts is None or b in parts}
        paths = [self._path(vs[-1], b) for b, vs in sorted(latest.items()) if vs]
        return spark.read.schema(self.empty.schema).parquet(*paths) if paths else self.empty

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        part = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        touched = {r[0] for r in batch.select(part).distinct().collect()}  # at most a number for each part
        merged = self.merge(batch, self.read(spark, number, touched)).select(*self.empty.columns)
        merged.withColumn("_b", part).repartition("_b").write.mode("overwrite").partitionBy("_b").parquet(f"{self.root}/v={number:08d}")
        self.prune(spark, number)

    def prune(self, spark: SparkSession, number: int) -> None:
        at = spark._jvm.org.apache.hadoop.fs.Path
        fs = at(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        for part, versions in self._versions(spark).items():
            for v in [v for v in versions if v <= number][: -KEPT]:
                fs.delete(at(self._path(v, part)), True)


def LedgerSink(root: str, empty: DataFrame) -> KeyedSink:  # noqa: N802
    """The ledger by school and mailbox."""
    return KeyedSink(root, empty, ["school", "mailbox"], merge_ledger)


def SeenSink(root: str, empty: DataFrame, key: str) -> KeyedSink:  # noqa: N802
    """Rows of a stream in update mode; a key's new row replaces the old one."""
    return KeyedSink(root, empty, [key], lambda new, old: old.join(new.select(key), key, "left_anti").select(*new.columns).unionByName(new))


def run_once(stream: DataFrame, sink: KeyedSink, checkpoint: str, mode: str = "append") -> None:
    """Everything there is, then stop; the checkpoint resumes."""
    stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
