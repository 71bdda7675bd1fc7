"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import io
import os
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java form of the word pattern used by the contracts: anything but space, \t, \n, \v, \f, \r.
WORD_RE = r"[^\x20\x09-\x0D]+"

_PREPARED: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Ship this package to Python workers and bound the Arrow batches.

    Batches are bounded by rows and bytes, so very long texts do not pile up in
    a worker.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    app = spark.sparkContext.applicationId
    if app not in _PREPARED:
        root = Path(__file__).resolve().parents[1]
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, f"{root.name}/{p.relative_to(root)}")
        path = os.path.join(tempfile.mkdtemp(), f"{root.name}.zip")
        Path(path).write_bytes(buf.getvalue())
        spark.sparkContext.addPyFile(path)  # served by the driver, fetched by each executor
        _PREPARED.add(app)


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through a reliable checkpoint in the cluster's shared folder.

    ``spark.checkpoint.dir`` names that folder; where it is unset a local master
    (tests) uses a temporary folder, and any other master is an error.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="ckpt-"))
    return df.checkpoint()


def lean_checkpoint(df: DataFrame) -> DataFrame:
    """A checkpoint for steps of many rounds: what no step refers to any more is deleted first.

    Spark deletes shuffle files and old checkpoints only as the driver collects
    its garbage, which a driver with little to do may put off to the end.
    """
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return checkpoint(df)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def texts(col: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    if pa.types.is_string(col.type) or pa.types.is_large_string(col.type):
        col = col.cast(pa.binary() if pa.types.is_string(col.type) else pa.large_binary())
    return col.to_pylist()


def words(data: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``; exactly the characters that bytes.split() splits at."""
    return data.split()


def crc32_col(text) -> F.Column:
    return F.coalesce(F.crc32(F.coalesce(text, F.lit(""))), F.lit(0).cast("long"))


def row_key(*cols) -> F.Column:
    """A digest of the given values that tells nulls from empty strings and is never null."""
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("~")) for c in cols]))
