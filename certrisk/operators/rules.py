"""Weighted rules over the features."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from certrisk import constants as k
from certrisk.config import DEFAULT, RiskConfig


@dataclass(frozen=True)
class Rule:
    """``condition`` and ``reason`` take the features column."""

    name: str
    weight: float
    condition: Callable[[Column], Column]
    reason: Callable[[Column], Column]
    description: str = ""


#: The features the default rules read, beside ``issuer_frequency``.
RULE_FEATURES = (
    "validity_days", "pubkey_bits", "sig_is_sha1", "sig_is_md5", "subject_has_punycode", "san_has_punycode",
    "subject_has_homoglyphs", "is_brand_typosquatting", "is_self_signed", "has_url", "suspicious_keyword_count",
    "chain_length", "has_san", "max_brand_similarity")


def default_rules(config: RiskConfig = DEFAULT) -> list[Rule]:
    conditions = {
        "short_validity_period": lambda f: (f["validity_days"] > 0)
        & (f["validity_days"] < config.min_validity_days),
        "long_validity_period": lambda f: f["validity_days"] > config.max_validity_days,
        "weak_public_key": lambda f: (f["pubkey_bits"] > 0)
        & (f["pubkey_bits"] < config.min_pubkey_bits),
        "weak_signature_algorithm": lambda f: (f["sig_is_sha1"] == 1) | (f["sig_is_md5"] == 1),
        "punycode_domain": lambda f: (f["subject_has_punycode"] == 1) | (f["san_has_punycode"] == 1),
        "homoglyph_characters": lambda f: f["subject_has_homoglyphs"] == 1,
        "brand_typosquatting": lambda f: f["is_brand_typosquatting"] == 1,
        "self_signed": lambda f: f["is_self_signed"] == 1,
        # Without a fitted table every issuer counts as common.
        "rare_issuer_short_validity": lambda f:
        (F.coalesce(f["issuer_frequency"], F.lit(1.0)) < config.rare_issuer)
        & (f["validity_days"] < 90),
        "url_in_certificate": lambda f: f["has_url"] == 1,
        "suspicious_keywords": lambda f: f["suspicious_keyword_count"] >= 2,
        "missing_chain": lambda f: f["chain_length"] == 0,
        "no_san": lambda f: f["has_san"] == 0,
    }
    details = {
        "short_validity_period": lambda f: [f["validity_days"]],
        "long_validity_period": lambda f: [f["validity_days"]],
        "weak_public_key": lambda f: [f["pubkey_bits"], F.lit(config.min_pubkey_bits)],
        "weak_signature_algorithm": lambda f: [
            F.when(f["sig_is_sha1"] == 1, "SHA1").otherwise("MD5")],
        "brand_typosquatting": lambda f: [f["max_brand_similarity"]],
        "suspicious_keywords": lambda f: [f["suspicious_keyword_count"]],
    }

    def reason(name: str, form: str) -> Callable[[Column], Column]:
        values = details.get(name)
        return lambda f: F.format_string(form, *values(f)) if values else F.lit(form)

    return [Rule(name, weight, conditions[name], reason(name, form), description)
            for name, weight, form, description in k.RULE_TABLE]


def add_rules(
    df: DataFrame, rules: list[Rule] | None = None, config: RiskConfig = DEFAULT,
) -> DataFrame:
    """Add a ``rules`` struct (``score, triggered_rules, reasons, rule_count``) to rows with ``features``.

    The score is the mean weight of the rules that fired, times 1.2 up to 1 when
    three or more did. Weights are added in rule order.
    """
    rules = default_rules(config) if rules is None else rules
    features = F.col("features")
    # Conditions first and on their own: with each read once, Catalyst sees through
    # the features struct and drops the features no rule looks at.
    flags = [f"_rule_{i}" for i in range(len(rules))]
    df = df.withColumns({
        flag: F.coalesce(rule.condition(features), F.lit(False)) for flag, rule in zip(flags, rules)})
    total, count = F.lit(0.0), F.lit(0)
    names, reasons = [], []
    for flag, rule in zip(flags, rules):
        total = total + F.when(F.col(flag), rule.weight).otherwise(0.0)
        count = count + F.col(flag).cast("int")
        names.append(F.when(F.col(flag), rule.name))
        reasons.append(F.when(F.col(flag), rule.reason(features)))
    df = df.withColumns({"_total": total, "_count": count})
    mean = F.col("_total") / F.nullif(F.col("_count"), F.lit(0))
    score = F.when(F.col("_count") >= 3, F.least(F.lit(1.0), mean * 1.2)).otherwise(mean)
    return df.withColumn("rules", F.struct(
        F.coalesce(score, F.lit(0.0)).alias("score"),
        F.array_compact(F.array(*names)).alias("triggered_rules"),
        F.array_compact(F.array(*reasons)).alias("reasons"),
        F.col("_count").alias("rule_count"))).drop(*flags, "_total", "_count")


def rule_catalogue(spark: SparkSession, rules: list[Rule] | None = None) -> DataFrame:
    rows = [(i + 1, r.name, r.weight, r.description)
            for i, r in enumerate(rules if rules is not None else default_rules())]
    return spark.createDataFrame(rows, "position int, rule string, weight double, description string")


def rule_hits(df: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """How often each rule of the catalogue fired, rules that never did included."""
    hits = (df.select(F.explode("rules.triggered_rules").alias("rule"))
            .groupBy("rule").agg(F.count("*").alias("hits")))
    # The catalogue is as long as the rule list, and so is the aggregate.
    return (rule_catalogue(df.sparkSession, rules).join(F.broadcast(hits), "rule", "left")
            .select("position", "rule", "weight", "description",
                    F.coalesce("hits", F.lit(0)).cast("bigint").alias("hits")))
