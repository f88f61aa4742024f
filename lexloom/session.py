"""Spark session settings the engine relies on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that change results or plans; everything that depends on the size of
# the cluster (memory, cores, shuffle partitions) stays with the deployment.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows handed to a Python worker at once: its memory must not depend on the length of texts.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the engine's settings to an existing session."""
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "lexloom", cores: int | str = "*", **conf: str) -> SparkSession:
    """Single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        # Call-site capture on every column call slows the building of long expressions.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", conf.pop("driver_memory", "12g"))
    )
    for key, value in {**ENGINE_CONF, "spark.sql.shuffle.partitions": "8", **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: as the cluster names it, else beside the tables of the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/intermediate"


def scratch_path(spark: SparkSession, name: str) -> str:
    """New path in the shared folder; what is written there goes when the session ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate once into the shared folder and read it back.

    For results with several consumers: they survive lost executors and are not
    computed again per consumer.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
