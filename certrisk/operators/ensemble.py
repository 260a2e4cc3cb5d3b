"""Rules, classifier and language model combined into one verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certrisk.config import DEFAULT, RiskConfig

ML_TYPE = "struct<score:double,model:string>"
LLM_TYPE = (
    "struct<label:string,confidence:double,reasoning:string,red_flags:array<string>,"
    "benign_signals:array<string>,model:string,raw_response:string,error:string,"
    "parse_error:boolean>")
MAX_REASONS = 10
MAX_FLAGS = 3


def llm_score(llm: Column) -> Column:
    """Confidence for a phishing label, its complement for benign, else one half."""
    confidence = F.coalesce(llm["confidence"], F.lit(0.5))
    return (F.when(llm["label"] == "phishing", confidence)
            .when(llm["label"] == "benign", 1.0 - confidence).otherwise(F.lit(0.5)))


def final_score(rules: Column, ml: Column, llm: Column, config: RiskConfig = DEFAULT) -> Column:
    """Weighted sum; a missing scorer counts as one half and keeps its weight."""
    return (config.weight_rules * F.coalesce(rules["score"], F.lit(0.0))
            + config.weight_ml * F.coalesce(ml["score"], F.lit(0.5))
            + config.weight_llm * llm_score(llm))


def verdict_label(score: Column, config: RiskConfig = DEFAULT) -> Column:
    return F.when(score >= config.phishing_threshold, "phishing").otherwise("benign")


def verdict_confidence(score: Column, config: RiskConfig = DEFAULT) -> Column:
    sure = (score >= config.high_confidence) | (score <= config.low_confidence)
    return F.when(sure, "high").otherwise("medium")


def combined_reasons(rules: Column, ml: Column, llm: Column) -> Column:
    """At most ten reasons: all rules, the first rule in detail, classifier, model."""
    confidence = F.coalesce(llm["confidence"], F.lit(0.0))
    is_phishing, is_benign = llm["label"] == "phishing", llm["label"] == "benign"
    flags = F.when(is_phishing, F.slice(llm["red_flags"], 1, MAX_FLAGS))
    listed = F.concat(
        F.transform(rules["triggered_rules"], lambda n: F.concat(F.lit("[RULE] "), n)),
        F.array_compact(F.array(
            F.concat(F.lit("[RULE] "), F.get(rules["reasons"], F.lit(0))),
            F.when(ml["score"] > 0.7, F.format_string("[ML] High ML model confidence: %.2f", ml["score"])),
            F.when(is_phishing, F.format_string(
                "[LLM] Classified as phishing (confidence: %.2f)", confidence))
            .when(is_benign, F.format_string(
                "[LLM] Classified as benign (confidence: %.2f)", confidence)))),
        F.coalesce(F.transform(flags, lambda x: F.concat(F.lit("[LLM] "), x)),
                   F.array().cast("array<string>")))
    return F.slice(listed, 1, MAX_REASONS)


def add_verdict(df: DataFrame, config: RiskConfig = DEFAULT, keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested detections from ``rules`` and, where present, ``ml`` and ``llm`` structs.

    Missing ``ml`` / ``llm`` columns, and NULL values in them, mean "not scored".
    """
    for name, kind in (("ml", ML_TYPE), ("llm", LLM_TYPE)):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    rules, ml, llm = F.col("rules"), F.col("ml"), F.col("llm")
    df = df.withColumn("final_score", final_score(rules, ml, llm, config))
    score = F.col("final_score")
    methods = F.struct(
        F.struct(rules["score"].alias("score"), rules["triggered_rules"].alias("triggered_rules"),
                 rules["reasons"].alias("reasons")).alias("rules"),
        F.when(ml.isNotNull(), F.struct(
            F.coalesce(ml["score"], F.lit(0.5)).alias("score"),
            F.coalesce(ml["model"], F.lit("unknown")).alias("model"))).alias("ml"),
        F.when(llm.isNotNull(), F.struct(
            llm_score(llm).alias("score"),
            F.coalesce(llm["confidence"], F.lit(0.5)).alias("confidence"),
            F.coalesce(llm["model"], F.lit("unknown")).alias("model"),
            F.coalesce(llm["reasoning"], F.lit("")).alias("reasoning"),
            llm["red_flags"].alias("red_flags"),
            llm["benign_signals"].alias("benign_signals"))).alias("llm"))
    cn = F.lit("CN")
    details = F.struct(
        F.coalesce(F.try_element_at("subject", cn), F.lit("")).alias("subject_cn"),
        F.coalesce(F.try_element_at("issuer", cn), F.lit("")).alias("issuer"),
        F.col("validity_days"),
        F.col("san").alias("san_entries"))
    return df.select(
        "path", "file_name", F.col("label").alias("true_label"),
        verdict_label(score, config).alias("label"), "final_score",
        verdict_confidence(score, config).alias("confidence"),
        methods.alias("method_scores"),
        combined_reasons(rules, ml, llm).alias("combined_reasons"),
        details.alias("certificate_details"), *keep)


def count_at_threshold(detections: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Processed certificates and those at or above a score."""
    hit = F.col("final_score") >= threshold
    return detections.agg(
        F.count("*").alias("processed"), F.count(F.when(hit, 1)).alias("at_threshold"))
