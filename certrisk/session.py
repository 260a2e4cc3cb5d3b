"""Session defaults, the shared work folder, and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", memory: str = "16g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("certrisk")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    path = tempfile.mkdtemp(prefix="certrisk-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/certrisk/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as parquet and read it back.

    A staged table cuts the lineage, survives the loss of executors, can be read
    one column at a time, and has a known size, so that Catalyst and the
    size checks below can rely on it.
    """
    spark = df.sparkSession
    path = path or new_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
