"""The five jobs: preprocess, train, evaluate, infer, batch_infer."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from certrisk.config import DEFAULT, RiskConfig
from certrisk.functions.redact import redact_certificates
from certrisk.operators import metrics
from certrisk.operators.ensemble import add_verdict, count_at_threshold
from certrisk.operators.features import add_features
from certrisk.operators.issuers import fit_issuer_frequencies, frequencies_of, with_issuer_key
from certrisk.operators.lookup import broadcast_if_small, is_small
from certrisk.operators.model import CertificateModel
from certrisk.operators.model import train as fit_model
from certrisk.operators.parse import parse
from certrisk.operators.prompting import add_llm
from certrisk.operators.rules import Rule, add_rules
from certrisk.session import staged
from certrisk.sources.captures import (
    ERROR, CaptureFiles, capture_dataset, capture_directory, list_all, load_single_file, read_all, together, unread,
    with_content_columns)
from certrisk.sources.records import read_parsed, write_json, write_jsonl, write_parsed

PARSED, ISSUERS, QUARANTINE = "certificates", "issuers", "quarantine"
CONTENTS, FILES = "contents", "files"
FILE_ROWS = ("path string, length bigint, modificationTime timestamp, label string, content_hash string, "
             "run string")


def quarantine(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable captures, and those whose content could not be read."""
    bad = F.col("file_type") == ERROR
    return raw.filter(~bad), raw.filter(bad)


def new_captures(raw: DataFrame, parsed: DataFrame) -> DataFrame:
    """Captures whose bytes were not parsed before (``parsed`` holds ``content_hash``).

    Hashes alone are compared: each distinct hash of ``raw`` once, however many copies there are. The rows are then chosen by
    the hashes found to be known, which are sent to the tasks if they are few.
    """
    hashed = with_content_hash(raw)
    distinct = hashed.select("content_hash").distinct()
    known = staged(distinct.join(parsed.select("content_hash"), "content_hash", "left_semi"), "known-hashes")
    return hashed.join(broadcast_if_small(known), "content_hash", "left_anti")


def with_content_hash(raw: DataFrame) -> DataFrame:
    data = F.coalesce(F.col("content"), F.col("text").cast("binary"))
    return raw.withColumn("content_hash", F.sha2(data, 256))


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def preprocess_new(
    spark: SparkSession, input_dir: str, output_dir: str, config: RiskConfig = DEFAULT,
) -> DataFrame:
    """Parse what a growing folder holds beyond earlier runs, and return the run's counts of files and contents.

    Two tables grow: ``files`` has a row per file with its content's hash, ``contents`` a parsed row per distinct content.
    Files whose path, length and time are known are dropped by the listing alone and never opened. The others are read
    once, hashed and parsed where they are read; a content that an earlier run or an earlier path of
    this run holds is not stored again, which compares distinct hashes and shuffles no content. A run first writes its contents, then its
    files: one that dies between leaves contents that the next run finds again by hash.
    """
    files_path, contents_path = f"{output_dir}/{FILES}", f"{output_dir}/{CONTENTS}"
    known = _stored(spark, files_path, FILE_ROWS)
    run = uuid.uuid4().hex
    found, listings, parts = [], [], []
    for chosen in capture_dataset(spark, input_dir, seed=config.seed):
        listing = chosen.files(spark).select("path", "length", "modificationTime", F.lit(chosen.label).alias("label"))
        fresh = staged(listing.join(known.select("path", "length", "modificationTime"),
                                    ["path", "length", "modificationTime"], "left_anti"), "new-files")
        n, first = fresh.filter(F.col("length") <= config.max_capture_bytes).agg(F.count("*"), F.min("modificationTime")).first()
        listings.append(fresh)
        if not n:
            continue
        files = chosen.files(spark).filter((F.col("modificationTime") >= F.lit(first)) & (F.col("length") <= config.max_capture_bytes))
        # Known files are older as a rule; those that are not are left out by path.
        late = staged(known.filter(F.col("modificationTime") >= F.lit(first)).select("path", "length", "modificationTime"), "late-files")
        files = files.join(broadcast_if_small(late), ["path", "length", "modificationTime"], "left_anti")
        parts.append(with_content_columns(files.select("path", "content"), chosen.label))
    if parts:
        raw, _ = quarantine(together(parts))
        hashed = staged(redact_certificates(parse(with_content_hash(raw)), config.redact_pii), "parsed")
        copies = hashed.select("content_hash", "path").groupBy("content_hash").agg(F.min("path").alias("path"))
        before = _stored(spark, contents_path, "content_hash string")
        stored = staged(copies.join(before.select("content_hash"), "content_hash", "left_anti").select("path"), "new-contents")
        again = staged(hashed.select("path").join(stored, "path", "left_anti"), "known-contents")
        # As a rule few of a run's files are copies, so that it is they that the tasks are told.
        new = (hashed.join(F.broadcast(stored), "path", "left_semi") if stored.count() < again.count() and is_small(stored)
               else hashed.join(broadcast_if_small(again), "path", "left_anti"))
        new.withColumn("run", F.lit(run)).write.mode("append").parquet(contents_path)
        listed = together(listings).join(hashed.select("path", "content_hash"), "path")
        listed.withColumn("run", F.lit(run)).write.mode("append").parquet(files_path)
        bad = unread(together(listings).select("path", "length", "label"), hashed, config.max_capture_bytes)
        write_jsonl(bad.select("path", "file_name", "label", "length", "reason"), f"{output_dir}/{QUARANTINE}")
    own = F.col("run") == run
    return _stored(spark, files_path, FILE_ROWS).filter(own).agg(F.count("*").alias("new_files")).crossJoin(
        _stored(spark, contents_path, "run string").filter(own).agg(F.count("*").alias("new_contents")))


def content_features(spark: SparkSession, output_dir: str, config: RiskConfig = DEFAULT) -> DataFrame:
    """Features of every content of all runs, with ``n_files``; issuers are as common as the files that name them."""
    contents = spark.read.parquet(f"{output_dir}/{CONTENTS}")
    copies = spark.read.schema(FILE_ROWS).parquet(f"{output_dir}/{FILES}").groupBy("content_hash").agg(F.count("*").alias("n_files"))
    # Narrow on both sides, one row per hash.
    counted = with_issuer_key(contents.select("content_hash", "issuer")).select("content_hash", "issuer_key").join(copies, "content_hash")
    issuers = frequencies_of(staged(counted.groupBy("issuer_key").agg(F.sum("n_files").alias("issuer_n")), "issuer-counts"))
    rows = add_features(contents, issuers, config, keep_text=False)
    return rows.join(copies, "content_hash")


def preprocess(
    spark: SparkSession, input_dir: str, output_dir: str, sample_size: int | None = None,
    config: RiskConfig = DEFAULT,
) -> DataFrame:
    """Parse ``benign/`` and ``phishing/``, fit the issuer table, write both and the features.

    Files that are too long or cannot be read are listed, with the reason, beside them.
    Returns the number of certificates per class.
    """
    chosen = capture_dataset(spark, input_dir, sample_size, seed=config.seed)
    raw, _ = quarantine(read_all(spark, chosen, config.max_capture_bytes))
    # The issuer table needs every row before the first feature row can be finished.
    parsed = staged(redact_certificates(parse(raw), config.redact_pii), "parsed")
    bad = unread(list_all(spark, chosen), parsed, config.max_capture_bytes)
    write_jsonl(bad.select("path", "file_name", "label", "length", "reason"), f"{output_dir}/{QUARANTINE}")
    frequencies = fit_issuer_frequencies(parsed, f"{output_dir}/{ISSUERS}")
    write_parsed(add_features(parsed, frequencies, config), f"{output_dir}/{PARSED}")
    return read_parsed(spark, f"{output_dir}/{PARSED}").groupBy("label").agg(
        F.count("*").alias("certificates"))


def labelled(df: DataFrame) -> DataFrame:
    return df.withColumn("y_true", metrics.label_code(F.col("label")))


def train(
    spark: SparkSession, input_dir: str, model_dir: str, config: RiskConfig = DEFAULT,
) -> CertificateModel:
    """Fit on everything ``preprocess`` wrote and save the model with its issuer table."""
    rows = labelled(read_parsed(spark, f"{input_dir}/{PARSED}"))
    model = fit_model(rows, spark.read.parquet(f"{input_dir}/{ISSUERS}"), config)
    model.save(model_dir)
    return model


def evaluate(
    spark: SparkSession, model_dir: str, test_dir: str, output_dir: str,
) -> DataFrame:
    """Metrics of a saved model on preprocessed captures, written as one JSON row."""
    model = CertificateModel.load(spark, model_dir)
    predicted = model.predict(labelled(read_parsed(spark, f"{test_dir}/{PARSED}")))
    rows = staged(metrics.scored(
        predicted, F.col("y_true"), F.col("ml_label"), F.col("ml.score")), "scored")
    report = metrics.calculate_metrics(rows)
    write_json(report, f"{output_dir}/evaluation_report")
    return report


def detect(
    raw: DataFrame, model: CertificateModel | None = None,
    scorer: Callable[[str], str] | None = None, frequencies: DataFrame | None = None,
    rules: list[Rule] | None = None, responses_path: str | None = None,
    config: RiskConfig = DEFAULT, keep: tuple[str, ...] = (),
) -> DataFrame:
    """Raw captures to detections. Classifier and language model are used when given.

    ``keep`` names further columns of ``raw`` to carry along.
    """
    if frequencies is None and model is not None:
        frequencies = model.frequencies
    parsed = redact_certificates(parse(raw), config.redact_pii)
    if scorer is not None:
        # Asked once per distinct certificate, which needs a pass of its own.
        parsed = staged(parsed, "parsed")
    rows = add_features(parsed, frequencies, config, keep_text=model is not None)
    rows = add_rules(rows, rules, config)
    if model is not None:
        rows = model.predict(rows).drop("raw_text", "pem")
    if scorer is not None:
        rows = add_llm(rows, scorer, responses_path, config=config, source=parsed)
    return add_verdict(rows, config, keep)


def infer(spark: SparkSession, path: str, **options) -> DataFrame:
    """Detection of one file."""
    return detect(load_single_file(spark, path), **options)


def batch_infer(
    spark: SparkSession, input_dir: str, output_dir: str, threshold: float = 0.5,
    only_hits: bool = False, **options,
) -> DataFrame:
    """Score a directory into JSON lines and return the two counts.

    Captures that could not be read go to ``status=error`` beside ``status=ok``, scored by the rules alone.
    ``only_hits`` writes the detections at or above the threshold alone.
    """
    chosen: CaptureFiles = capture_directory(spark, input_dir)
    config = options.get("config", DEFAULT)
    raw, _ = quarantine(chosen.read(spark, config.max_capture_bytes))
    out = f"{output_dir}/detections"
    found = detect(raw, **options).withColumn("status", F.lit("ok"))
    if only_hits:
        found = staged(found, "detections")
        write_jsonl(found.filter(F.col("final_score") >= threshold), out, partition_by="status")
    else:
        write_jsonl(found, out, partition_by="status")
        found = spark.read.schema("path string, final_score double, status string").json(out).filter("status = 'ok'")
    counts = staged(count_at_threshold(found, threshold), "counts")
    listing = chosen.listing(spark)
    # Paths are compared only where some are missing.
    if listing.count() > counts.first()["processed"]:
        bad = unread(listing, found, config.max_capture_bytes).drop("length", "reason")
        failed = detect(bad, rules=options.get("rules"), config=config).withColumn("status", F.lit(ERROR))
        write_jsonl(failed, out, "append", partition_by="status")
    return counts
