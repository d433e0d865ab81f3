"""Session defaults, table access and scratch storage."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lectern")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def importable(spark: SparkSession) -> None:
    """Lets Python workers find this package where the driver found it, if it isn't installed."""
    root = str(Path(__file__).resolve().parent.parent)
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One of the Parquet tables below ``base``."""
    importable(spark)
    return spark.read.parquet(f"{base}/{name}.parquet")


def balanced(df: DataFrame) -> DataFrame:
    """``df`` as it is where the scan gives every core work; a table of fewer splits is spread first, for work that costs more than the shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    Only a local master may do without that setting; it gets a temporary
    folder. A cluster without it is an error, as a folder of one machine
    could not be read by the others.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="lectern-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the JVM has ended before; the folder's owner cleans up
        pass


def materialize(df: DataFrame, what: str = "part") -> DataFrame:
    """Writes ``df`` to the shared folder and returns the written table.

    This cuts the lineage, survives the loss of executors, and lets a costly
    result be read more than once. The files go when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)
