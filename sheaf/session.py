"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution picks partition counts, join sides and skew splits from the
# sizes it measures, so none of them is fixed here for a cluster. Extraction is heavy on
# the CPU and light on bytes, so small shuffles are merged less eagerly. Bodies can be large,
# so a batch for Python holds few of them. Recording the call site of every Column call makes
# long field lists slow to build and is switched off.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "sheaf", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):  # driver and executor are one process
            builder = builder.config("spark.driver.memory", "8g")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _own_dir() -> str:
    """One scratch folder per process for local masters, gone with the process."""
    path = tempfile.mkdtemp(prefix="sheaf-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    Only a local master may go without that setting; on a cluster a folder of one
    machine would be lost with it, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        base = _own_dir()
    return os.path.join(base, f"{label}-{uuid.uuid4().hex}")


def settle(df: DataFrame) -> DataFrame:
    """A side result, written to the shared folder and read back.

    It is computed once, survives the loss of an executor, and has a known size: a small one
    is broadcast by Spark's own size test, so the large side of the next join stays where it
    lies; one that is not small is joined by shuffle as usual.
    """
    path = shared_dir(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
