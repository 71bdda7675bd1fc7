"""Sessions: shipping this package to Python workers, settings for local runs."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make the package importable by Python workers on other machines, once an application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    path = os.path.join(tempfile.mkdtemp(), f"{root.name}-core.zip")
    Path(path).write_bytes(buf.getvalue())
    spark.sparkContext.addPyFile(path)  # served by the driver, fetched by each executor
    _SHIPPED.add(app)


def local_session(cores: int = 8, partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tasks(spark: SparkSession) -> int:
    """How many tasks rows are dealt to where Spark would choose few: four for each core, spark.sql.shuffle.partitions at least."""
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where it is unset a local master (tests) takes a temporary one, any other is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return folder or tempfile.mkdtemp(prefix="ledgerloom-")


def checkpoint(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
