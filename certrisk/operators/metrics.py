"""Exact classification metrics of scored rows (``y_true, y_pred, score``).

Every metric is one aggregate, and rows without a true label are left out. The
ranking metrics work on one row per distinct score, cut into ranges that are
summed on their own, so that no task ever sees all scores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from certrisk import constants as k
from certrisk.session import staged

#: Distinct scores of a range, and most ranges of a curve.
RANGE_SCORES, MOST_RANGES = 20_000, 2_000


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return _share(2 * tp, 2 * tp + fp + fn)


def scored(df: DataFrame, y_true: Column, y_pred: Column, score: Column, *keep: str) -> DataFrame:
    return df.select(*keep, y_true.cast("int").alias("y_true"), y_pred.cast("int").alias("y_pred"),
                     score.cast("double").alias("score"))


def label_code(label: Column) -> Column:
    """1 for phishing, 0 for benign, NULL for anything else."""
    return F.when(label == "phishing", 1).when(label == "benign", 0)


def confusion(df: DataFrame, *by: str) -> DataFrame:
    def count(t: int, p: int) -> Column:
        return F.count(F.when((F.col("y_true") == t) & (F.col("y_pred") == p), 1))

    return df.filter("y_true IS NOT NULL").groupBy(*by).agg(
        count(0, 0).alias("true_negatives"), count(0, 1).alias("false_positives"),
        count(1, 0).alias("false_negatives"), count(1, 1).alias("true_positives"))


def rates(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and the rest from confusion counts."""
    tn, fp = F.col("true_negatives"), F.col("false_positives")
    fn, tp = F.col("false_negatives"), F.col("true_positives")
    return counts.withColumns({
        "accuracy": _share(tn + tp, tn + fp + fn + tp),
        "precision": _share(tp, tp + fp),
        "recall": _share(tp, tp + fn),
        "f1_score": _f1(tp, fp, fn),
        "false_positive_rate": _share(fp, fp + tn),
        "false_negative_rate": _share(fn, fn + tp),
        "total_samples": tn + fp + fn + tp,
        "positive_samples": tp + fn,
        "negative_samples": tn + fp})


def basic_metrics(df: DataFrame, *by: str) -> DataFrame:
    return rates(confusion(df, *by))


def class_report(df: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted averages."""
    tn, fp = F.col("true_negatives"), F.col("false_positives")
    fn, tp = F.col("false_negatives"), F.col("true_positives")
    p0, r0, f0, n0 = _share(tn, tn + fn), _share(tn, tn + fp), _f1(tn, fn, fp), tn + fp
    p1, r1, f1, n1 = _share(tp, tp + fp), _share(tp, tp + fn), _f1(tp, fp, fn), tp + fn

    def line(name: str, values: list[Column], support: Column) -> Column:
        return F.struct(F.lit(name).alias("class"), *[
            v.alias(n) for n, v in zip(("precision", "recall", "f1_score"), values)],
            support.alias("support"))

    both = list(zip((p0, r0, f0), (p1, r1, f1)))
    lines = F.array(
        line("0", [p0, r0, f0], n0), line("1", [p1, r1, f1], n1),
        line("macro avg", [(a + b) / 2 for a, b in both], n0 + n1),
        line("weighted avg", [_share(a * n0 + b * n1, n0 + n1) for a, b in both], n0 + n1))
    return confusion(df).select(F.inline(lines))


def score_curve(df: DataFrame, *by: str) -> DataFrame:
    """One row per distinct score with running counts from the highest score down:
    ``score, pos, neg, tp, fp``."""
    y = F.col("y_true")
    grouped = staged(
        df.filter(y.isNotNull() & F.col("score").isNotNull()).groupBy(*by, "score").agg(
            F.sum(y.cast("bigint")).alias("pos"), F.sum((1 - y).cast("bigint")).alias("neg")),
        "scores")
    ranges = min(MOST_RANGES, 1 + grouped.count() // RANGE_SCORES)
    steps = [i / ranges for i in range(1, ranges)]
    cuts = (grouped.agg(F.percentile_approx("score", steps)).first()[0] or []) if steps else []
    bounds = F.array(*[F.lit(c) for c in sorted(set(cuts))]).cast("array<double>")
    ranged = grouped.withColumn(
        "_range", F.size(F.filter(bounds, lambda c: c > F.col("score"))))
    # One row per range and group.
    totals = ranged.groupBy(*by, "_range").agg(
        F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_range",
        F.coalesce(F.sum("_p").over(before), F.lit(0)).alias("_p"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"))
    inside = Window.partitionBy(*by, "_range").orderBy(F.desc("score")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return ranged.join(F.broadcast(offsets), [*by, "_range"]).select(
        *by, "score", "pos", "neg",
        (F.col("_p") + F.sum("pos").over(inside)).alias("tp"),
        (F.col("_n") + F.sum("neg").over(inside)).alias("fp"))


def ranking_metrics(df: DataFrame, *by: str) -> DataFrame:
    """ROC AUC (ties count half) and average precision (step sum); 0 for a single class."""
    p, n = F.sum("pos"), F.sum("neg")
    pos, neg, tp, fp = (F.col(c) for c in ("pos", "neg", "tp", "fp"))
    # In doubles: the product of two counts leaves the range of a bigint.
    below = F.sum(neg.cast("double") * (tp - pos) + neg.cast("double") * pos / 2)
    steps = F.sum(tp / (tp + fp) * pos)
    both = (p > 0) & (n > 0)
    return score_curve(df, *by).groupBy(*by).agg(
        F.when(both, below / p.cast("double") / n).otherwise(0.0).alias("roc_auc"),
        F.when(both, steps / p).otherwise(0.0).alias("pr_auc"))


def threshold_sweep(
    df: DataFrame, thresholds: tuple[float, ...] = k.SWEEP_THRESHOLDS,
) -> DataFrame:
    """Metrics of ``score >= t`` for every t, in a single pass over the rows."""
    y, score = F.col("y_true"), F.col("score")
    sums = [F.count(F.when(y == 1, 1)).alias("p"), F.count("*").alias("n")]
    for i, t in enumerate(thresholds):
        sums += [F.count(F.when((score >= t) & (y == 1), 1)).alias(f"tp{i}"),
                 F.count(F.when((score >= t) & (y == 0), 1)).alias(f"fp{i}")]
    lines = []
    for i, t in enumerate(thresholds):
        tp, fp = F.col(f"tp{i}"), F.col(f"fp{i}")
        fn = F.col("p") - tp
        lines.append(F.struct(
            F.lit(t).alias("threshold"), _share(tp, tp + fp).alias("precision"),
            _share(tp, F.col("p")).alias("recall"), _f1(tp, fp, fn).alias("f1"),
            _share(F.col("n") - fp - fn, F.col("n")).alias("accuracy")))
    return df.filter(y.isNotNull()).agg(*sums).select(F.inline(F.array(*lines)))


def report_summary(df: DataFrame) -> DataFrame:
    """The four main metrics as percentages."""
    return basic_metrics(df).select(*[
        F.format_string("%.2f%%", 100 * F.col(c)).alias(c)
        for c in ("accuracy", "precision", "recall", "f1_score")])


def calculate_metrics(df: DataFrame) -> DataFrame:
    """One row with all metrics, the confusion matrix and the class report."""
    ranking = ranking_metrics(df).select(F.struct("roc_auc", "pr_auc")).scalar()
    report = class_report(df).agg(F.collect_list(F.struct(
        "class", "precision", "recall", "f1_score", "support"))).scalar()
    return (basic_metrics(df)
            .withColumn("_r", ranking)
            .withColumn("classification_report", report)
            .withColumn("confusion_matrix", F.array(
                F.array("true_negatives", "false_positives"),
                F.array("false_negatives", "true_positives")))
            .withColumns({"roc_auc": F.col("_r.roc_auc"), "pr_auc": F.col("_r.pr_auc")})
            .drop("_r"))


def compare_methods(
    df: DataFrame, scores: dict[str, Column], threshold: float = 0.5,
) -> DataFrame:
    """Metrics of several scores of the same rows (rules, classifier, model, ensemble).

    Rows without a score are counted as ``unscored`` and left out of the metrics; a method that scored nothing keeps its line.
    """
    methods = F.array(*[
        F.struct(F.lit(name).alias("method"), c.cast("double").alias("score"))
        for name, c in scores.items()])
    long = df.select("y_true", F.inline(methods)).withColumn(
        "y_pred", (F.col("score") >= threshold).cast("int"))
    ranking = ranking_metrics(long, "method")
    unscored = long.filter("y_true IS NOT NULL").groupBy("method").agg(
        F.count(F.when(F.col("score").isNull(), 1)).alias("unscored"))
    # One row per method on either side.
    return (basic_metrics(long, "method").join(F.broadcast(unscored), "method").join(F.broadcast(ranking), "method", "left")
            .fillna(0.0, ["roc_auc", "pr_auc"]))


def weight_search(
    df: DataFrame, rules: Column, ml: Column, llm: Column, step: float = 0.1,
    threshold: float = 0.5,
) -> DataFrame:
    """F1 of every weight triple that adds up to one, on rows with ``y_true``.

    Rows with the same scores and label are counted first, so the grid is laid out over distinct scores
    and not over rows. Each of these adds its count to its grid points before the second shuffle, which carries
    one row per point and task.
    """
    n = round(1 / step)
    tuples = df.filter("y_true IS NOT NULL").groupBy(
        "y_true", rules.alias("_r"), ml.alias("_m"), llm.alias("_l")).agg(F.count("*").alias("_count"))
    # Few bytes and much work: not to be drawn together into one task.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tuples = tuples.repartition(tasks, "_r", "_m", "_l", "y_true")
    rows = tuples.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(n)))).withColumn(
        "_j", F.explode(F.sequence(F.lit(0), F.lit(n) - F.col("_i")))).withColumns({
            "w_rules": F.col("_i") / n, "w_ml": F.col("_j") / n, "w_llm": (n - F.col("_i") - F.col("_j")) / n})
    score = F.col("w_rules") * F.col("_r") + F.col("w_ml") * F.col("_m") + F.col("w_llm") * F.col("_l")
    # The score at 12 digits against the threshold.
    hit = score >= threshold - 5e-13

    def count(t: int, p: Column) -> Column:
        return F.coalesce(F.sum(F.when((F.col("y_true") == t) & p, F.col("_count"))), F.lit(0))

    return rates(rows.groupBy("w_rules", "w_ml", "w_llm").agg(
        count(0, ~hit).alias("true_negatives"), count(0, hit).alias("false_positives"),
        count(1, ~hit).alias("false_negatives"), count(1, hit).alias("true_positives")))
