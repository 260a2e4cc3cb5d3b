"""Scoring of captures as they arrive in a directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from certrisk.config import DEFAULT, RiskConfig
from certrisk.operators.ensemble import add_verdict
from certrisk.operators.features import add_features
from certrisk.operators.parse import parse
from certrisk.operators.prompting import cache_key
from certrisk.operators.rules import add_rules
from certrisk.sources.captures import TASKS_PER_CORE, with_content_columns

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def stream_captures(
    spark: SparkSession, directory: str, files_per_trigger: int = 10_000,
) -> DataFrame:
    files = (spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
             .option("recursiveFileLookup", True)
             .option("maxFilesPerTrigger", files_per_trigger).load(directory))
    return with_content_columns(files, keep=("modificationTime",))


def listed_by_cores(spark: SparkSession) -> None:
    """Let a listing of many paths, in this session from now on, be a few tasks for each core.

    A batch of a stream lists the paths it is given again, by default with a task for each of up to 10,000.
    """
    key, most = "spark.sql.sources.parallelPartitionDiscovery.parallelism", TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    if int(spark.conf.get(key)) > most:
        spark.conf.set(key, str(most))


def stream_detections(
    raw: DataFrame, frequencies: DataFrame | None = None, config: RiskConfig = DEFAULT,
    once_within: str | None = None,
) -> DataFrame:
    """The batch columns on a stream; the issuer table is a static join.

    Without ``once_within`` nothing is kept between rows. With it, of captures of one certificate (same subject, issuer
    and dates) whose files are at most that long apart, such as "7 days", the first is answered and no other, also after a
    restart: a key is kept as state until the watermark passes it. Captures without any of these fields are told apart
    by path. The text is gone by then, so the shuffle by key carries finished detections alone.
    """
    rows = parse(raw)
    if once_within is None:
        rows = add_features(rows.drop("modificationTime"), frequencies, config, keep_text=False)
        return add_verdict(add_rules(rows, config=config), config)
    named = (F.size("subject") > 0) | (F.size("issuer") > 0)
    rows = rows.withColumn("cache_key", F.when(named, cache_key()).otherwise(F.col("path")))
    rows = add_rules(add_features(rows, frequencies, config, keep_text=False), config=config)
    found = add_verdict(rows, config, ("cache_key", "modificationTime"))
    return (found.withWatermark("modificationTime", once_within)
            .dropDuplicatesWithinWatermark(["cache_key"]).drop("cache_key", "modificationTime"))


def watch_directory(
    spark: SparkSession, directory: str, output_dir: str, checkpoint_dir: str,
    frequencies: DataFrame | None = None, config: RiskConfig = DEFAULT, once: bool = False,
    once_within: str | None = None, files_per_trigger: int = 10_000,
) -> StreamingQuery:
    """Append detections as JSON lines; ``once`` handles what is there and stops.

    The sink writes a batch once, however often it is tried. ``once_within``: see ``stream_detections``.
    """
    listed_by_cores(spark)
    found = stream_detections(stream_captures(spark, directory, files_per_trigger), frequencies, config, once_within)
    writer = (found.writeStream.format("json").outputMode("append")
              .option("ignoreNullFields", False)
              .option("path", output_dir).option("checkpointLocation", checkpoint_dir))
    return (writer.trigger(availableNow=True) if once
            else writer.trigger(processingTime="30 seconds")).start()
