"""Document quality from the document itself and from where it stands.

A logistic model of simple text statistics gives each document evidence (a log likelihood ratio). Sites
give a prior: the rates of good documents of a host and of a path on it are beta variables around the
rate one level up, whose strength is estimated from how much the rates differ (empirical Bayes, by
moments). Sparse hosts and paths thus stay near the global rate. Both are combined by Bayes' rule:
the log odds of the path's rate, without the document itself, plus the evidence.

Sums by path are made before the shuffle, those by host from the sums by path; the table of paths meets the
documents by ``operators.lookup``, which broadcasts it only when small and splits hot paths otherwise. The
model is fitted on at most ``most_labelled`` labelled documents, drawn by hash; all else uses all rows.

Defined results: a null or empty text has all statistics zero; null hosts and paths are a host and a
path of their own; rows of one ``doc_id`` are judged each on its own, several labels of one ``doc_id`` count
as the lowest; without labels, or with labels of one value, evidence is zero and the rate is that value
or a half; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certrisk.llm.quality_rules import STATISTICS, with_statistics
from certrisk.operators.lookup import lookup
from certrisk.session import staged

FEATURES = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "any_symbol": "cast(n_symbols > 0 as double)",
    "capitals": "n_capitals / greatest(word_chars, 1)",
    "marks": "n_marks / greatest(n_words, 1)",
    "duplicate_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeated_words": "n_repeat_words / greatest(n_words, 1)",
    "word_length": "least(word_chars / greatest(n_words, 1), 50) / 10",
    "size": "ln(1 + n_words) / 10",
}


def site_parts(url: Column) -> tuple[Column, Column]:
    """Host, without a leading ``www.``, and host with the first part of the path."""
    host = F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("HOST"))), r"^www\.", "")
    first = F.regexp_extract(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), "^/([^/]*)", 1)
    return host, F.concat_ws("/", host, first)


def with_features(docs: DataFrame, host: Column, path: Column) -> DataFrame:
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    narrow = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(host.cast("string"), F.lit("")).alias("host"),
        F.coalesce(path.cast("string"), F.lit("")).alias("path"), body.alias("text"),
        (F.length(body) - F.length(F.regexp_replace(body, "[A-Z]+", ""))).alias("n_capitals"),
        (F.length(body) - F.length(F.regexp_replace(body, "!+", ""))).alias("n_marks"))
    counted = with_statistics(narrow).select("doc_id", "host", "path", "n_capitals", "n_marks", *STATISTICS)
    return counted.select("doc_id", "host", "path", *[F.expr(f"cast({e} as double)").alias(n) for n, e in FEATURES.items()])


@dataclass(frozen=True)
class Evidence:
    weights: tuple[float, ...]
    bias: float
    rate: float

    def log_odds(self) -> Column:
        total = F.lit(self.bias)
        for name, w in zip(FEATURES, self.weights):
            total = total + F.lit(w) * F.col(name)
        return total


def fit_evidence(labelled: DataFrame, most_labelled: int = 20_000, ridge: float = 1.0) -> Evidence:
    """Newton steps on a bounded sample of ``labelled`` (features and ``good``, 0 or 1)."""
    rows = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labelled).select(*FEATURES, "good").toPandas()
    y = rows["good"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return Evidence((0.0,) * len(FEATURES), 0.0, float(y[0]) if len(y) else 0.5)
    x = np.column_stack([rows[list(FEATURES)].to_numpy(float), np.ones(len(y))])
    w, penalty = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step * min(1, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return Evidence(tuple(w[:-1].tolist()), float(w[-1]), float(y.mean()))


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def strength(between: float, within: float) -> float:
    """How many documents a beta prior is worth, from the variance of rates around it."""
    if between <= 0:
        return 1e6
    return float(min(1e6, max(1.0, within / between - 1)))


def site_rates(paths: DataFrame) -> tuple[DataFrame, float]:
    """``path_key, n, good, host_rate, path_rate`` from sums by path, and the strength of a path's prior."""
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("good").alias("hg"), F.count("*").alias("parts"))
    hosts = staged(hosts, "hosts")
    count, n, good, squares = hosts.agg(F.count("*"), F.sum("hn"), F.sum("hg"), F.sum(F.col("hn").cast("double") ** 2)).first()
    rate = (good or 0.0) / (n or 1)
    spread = hosts.agg(F.sum(F.col("hn") * (F.col("hg") / F.col("hn") - F.lit(rate)) ** 2)).first()[0] or 0.0
    within = max(rate * (1 - rate), 1e-9)
    free = (n or 1) - (squares or 0.0) / (n or 1)
    k_host = strength((spread - (count - 1) * within) / free if free > 0 else 0.0, within)
    rated = hosts.select(F.col("host").alias("_host"), "parts", "hn", (
        (F.lit(k_host * rate) + F.col("hg")) / (F.lit(k_host) + F.col("hn"))).alias("host_rate"))
    joined = staged(paths.join(rated, F.col("host") == F.col("_host")).drop("_host"), "paths")
    inner = F.col("host_rate") * (1 - F.col("host_rate"))
    spread, expected, free, weighed = joined.agg(
        F.sum(F.col("n") * (F.col("good") / F.col("n") - F.col("host_rate")) ** 2),
        F.sum(inner * (1 - 1 / F.col("parts"))), F.sum(F.col("n") - F.col("n").cast("double") ** 2 / F.col("hn")),
        F.sum(inner * F.col("n")) / F.sum("n")).first()
    k_path = strength((spread - expected) / free if free and free > 0 else 0.0, max(weighed or 0.0, 1e-9))
    path_rate = (F.lit(k_path) * F.col("host_rate") + F.col("good")) / (F.lit(k_path) + F.col("n"))
    return joined.select("path_key", "n", "good", "host_rate", path_rate.alias("path_rate")), k_path


def classify(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, good: str = "quality = 1",
    most_labelled: int = 20_000, cutoff: float = 0.5,
) -> DataFrame:
    """``doc_id, host, path, evidence, host_rate, path_rate, posterior, kept`` of every row."""
    rows = staged(with_features(docs, host, path), "quality-features")
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        F.min(F.expr(good).cast("int")).alias("good"))
    labelled = rows.join(known, F.col("doc_id") == F.col("_id"), "left").drop("_id")
    model = fit_evidence(labelled.filter("good IS NOT NULL"), most_labelled)
    alone = model.log_odds() if any(model.weights) else F.lit(np.log(max(model.rate, 1e-6) / max(1 - model.rate, 1e-6)).item())
    scored = labelled.select(
        "doc_id", "host", "path", F.concat_ws("\x00", "host", "path").alias("path_key"), alone.alias("log_odds"), "good")
    scored = scored.withColumn("share", F.coalesce(F.col("good").cast("double"), 1 / (1 + F.exp(-F.col("log_odds")))))
    paths = scored.groupBy("host", "path_key").agg(F.count("*").alias("n"), F.sum("share").alias("good"))
    rates, k_path = site_rates(paths)
    rates = staged(rates.withColumnRenamed("good", "path_good"), "path-rates")
    joined = lookup(scored, rates, "path_key", "n", "doc_id")
    base = float(np.log(max(model.rate, 1e-6) / max(1 - model.rate, 1e-6)))
    # The document's own share is taken out of its path's rate.
    others = (F.lit(k_path) * F.col("host_rate") + F.col("path_good") - F.col("share")) / (F.lit(k_path) + F.col("n") - 1)
    evidence = F.col("log_odds") - F.lit(base)
    posterior = 1 / (1 + F.exp(-(_logit(others) + evidence)))
    return joined.select("doc_id", "host", "path", evidence.alias("evidence"), "host_rate", "path_rate",
                         posterior.alias("posterior"), (posterior >= cutoff).alias("kept"))
