"""JSON and JSON-lines records, read with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jsonl(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    """One document per file, possibly over many lines."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def write_jsonl(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: str | None = None,
) -> None:
    writer = df.write.mode(mode).option("ignoreNullFields", False)
    (writer.partitionBy(partition_by) if partition_by else writer).json(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """For one-row results such as a metrics report."""
    df.coalesce(1).write.mode(mode).option("ignoreNullFields", False).json(path)


def write_parsed(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parsed captures, one directory per class; rows are told apart by ``path``."""
    df.write.mode(mode).partitionBy("label").parquet(path)


def read_parsed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
