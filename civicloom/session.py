"""Session settings and durable cut points."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

#: Settings every civicloom job wants.  Nothing here depends on the data size:
#: AQE sizes shuffle partitions, splits skewed join partitions and turns a
#: sort-merge join into a broadcast join only after it has measured the side.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Recording the Python call site of every expression costs more than planning it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A single-JVM session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("civicloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master may
    fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="civicloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return os.path.join(shared_folder(spark), f"civicloom-{label}-{uuid.uuid4().hex}")


def stored(df: DataFrame, label: str = "stored") -> DataFrame:
    """``df`` written to shared storage once and read again; lineage ends there.

    Unlike a checkpoint it is computed a single time, and later reads take the columns they need.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_with(df: DataFrame, aggregate: Column, label: str = "stored") -> tuple[DataFrame, object]:
    """``stored``, and an aggregate over the rows that is taken while they are written."""
    seen = Observation()
    out = stored(df.observe(seen, aggregate.alias("value")), label)
    return out, seen.get["value"]


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on shared storage and cut its lineage.

    Losing an executor afterwards costs a re-read, never a recomputation, and
    every later reference sees the same rows in the same partitions.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
