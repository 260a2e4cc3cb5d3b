import random

import pytest
from pyspark.sql import functions as F

from certrisk.operators import metrics as mt

SCHEMA = "y_true int, y_pred int, score double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute(rows):
    """ROC AUC by pairs and average precision by definition."""
    pos = [s for y, _, s in rows if y == 1]
    neg = [s for y, _, s in rows if y == 0]
    if not pos or not neg:
        return 0.0, 0.0
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    ap, recall = 0.0, 0.0
    for t in sorted({s for _, _, s in rows}, reverse=True):
        tp, n = sum(s >= t for s in pos), sum(s >= t for _, _, s in rows)
        ap += (tp / len(pos) - recall) * tp / n
        recall = tp / len(pos)
    return auc, ap


def random_rows(n, digits, seed=1):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        y = int(rng.random() < 0.4)
        s = round(min(1.0, max(0.0, rng.gauss(0.4 + 0.2 * y, 0.2))), digits)
        rows.append((y, int(s >= 0.5), s))
    return rows


@pytest.mark.parametrize("rows", [
    random_rows(500, 1), random_rows(800, 6), [(1, 1, 0.5), (0, 1, 0.5)], [(1, 1, 0.5)], [(0, 0, 0.1), (0, 1, 0.9)],
    [(1, 1, 0.9), (0, 0, 0.1)]])
def test_ranking(spark, rows):
    got = mt.ranking_metrics(frame(spark, rows)).first()
    auc, ap = brute(rows)
    assert abs(got.roc_auc - auc) < 1e-12 and abs(got.pr_auc - ap) < 1e-12


def test_ranking_with_crowded_scores(spark):
    """Most scores in a tiny range, and one score holding a third of all rows."""
    rng = random.Random(3)
    rows = [(int(rng.random() < 0.5), 0, 0.5 + rng.random() * 1e-9) for _ in range(1500)] + [(i % 2, 0, 0.7) for i in range(750)]
    got = mt.ranking_metrics(frame(spark, rows)).first()
    auc, ap = brute(rows)
    assert abs(got.roc_auc - auc) < 1e-12 and abs(got.pr_auc - ap) < 1e-12


def test_row_order_does_not_matter(spark):
    rows = random_rows(300, 2)
    a = mt.calculate_metrics(frame(spark, rows)).first()
    b = mt.calculate_metrics(frame(spark, rows[::-1])).first()
    assert a == b


def test_all_metrics(spark):
    rows = [(1, 1, 0.9), (1, 0, 0.4), (0, 0, 0.2), (0, 1, 0.6), (0, 0, 0.1), (None, 1, 0.9)]
    m = mt.calculate_metrics(frame(spark, rows)).first()
    assert m.confusion_matrix == [[2, 1], [1, 1]]
    assert (m.accuracy, m.precision, m.recall, m.f1_score) == (0.6, 0.5, 0.5, 0.5)
    assert (m.false_positive_rate, m.false_negative_rate) == (1 / 3, 0.5)
    assert (m.total_samples, m.positive_samples, m.negative_samples) == (5, 2, 3)
    report = {r["class"]: r for r in m.classification_report}
    assert report["0"].precision == 2 / 3 and report["0"].support == 3
    assert abs(report["macro avg"].f1_score - (2 / 3 + 0.5) / 2) < 1e-12
    assert abs(report["weighted avg"].recall - 0.6) < 1e-12
    assert mt.report_summary(frame(spark, rows)).first().accuracy == "60.00%"


def test_nothing_predicted(spark):
    m = mt.basic_metrics(frame(spark, [(0, 0, 0.1), (0, 0, 0.2)])).first()
    assert (m.accuracy, m.precision, m.recall, m.f1_score, m.false_negative_rate) == (1.0, 0.0, 0.0, 0.0, 0.0)
    assert mt.basic_metrics(frame(spark, []).filter("false")).first().total_samples == 0


def test_sweep_includes_the_threshold_itself(spark):
    rows = [(1, 1, 0.5), (0, 1, 0.5), (1, 1, 0.7)]
    got = {r.threshold: r for r in mt.threshold_sweep(frame(spark, rows)).collect()}
    assert len(got) == 9 and got[0.5].recall == 1.0 and got[0.6].recall == 0.5
    assert got[0.9] .f1 == 0.0 and got[0.5].accuracy == 2 / 3


def test_methods_and_weights(spark):
    df = spark.createDataFrame([(1, 0.9, 0.2, 0.6), (0, 0.8, 0.1, 0.4), (0, 0.1, 0.3, 0.5)], "y_true int, r double, m double, l double")
    got = {r.method: r for r in mt.compare_methods(df, {"r": F.col("r"), "l": F.col("l")}).collect()}
    assert got["r"].accuracy == 2 / 3 and got["r"].roc_auc == 1.0 and got["l"].roc_auc == 1.0
    grid = mt.weight_search(df, F.col("r"), F.col("m"), F.col("l"), step=0.25)
    assert grid.count() == 15
    assert {r.f1_score for r in grid.filter("w_rules = 1").collect()} == {2 / 3}


def test_methods_without_scores_keep_their_line(spark):
    df = spark.createDataFrame([(1, 0.9, None, None), (0, 0.2, None, 0.1), (1, 0.4, None, None)], "y_true int, r double, m double, l double")
    got = {r.method: r for r in mt.compare_methods(df, {"r": F.col("r"), "m": F.col("m"), "l": F.col("l")}).collect()}
    assert (got["r"].unscored, got["m"].unscored, got["l"].unscored) == (0, 3, 2)
    assert got["m"].total_samples == 0 and got["m"].roc_auc == 0.0 and got["l"].total_samples == 1


def test_weights_are_tried_on_distinct_scores(spark):
    """However many rows share their scores, the grid is laid out once for each distinct score."""
    rng = random.Random(2)
    rows = [(rng.randint(0, 1), rng.randint(0, 4) / 4, rng.randint(0, 4) / 4, rng.randint(0, 4) / 4) for _ in range(20_000)]
    df = spark.createDataFrame(rows, "y int, r double, m double, l double").withColumnRenamed("y", "y_true")
    got = {(round(x.w_rules, 2), round(x.w_ml, 2)): x for x in mt.weight_search(df, F.col("r"), F.col("m"), F.col("l"), 0.1).collect()}
    for (a, b), x in got.items():
        hits = [(y, round(x.w_rules * r + x.w_ml * m + x.w_llm * v, 12) >= 0.5) for y, r, m, v in rows]
        assert x.true_positives == sum(y == 1 and h for y, h in hits) and x.false_positives == sum(y == 0 and h for y, h in hits)
    plan = mt.weight_search(df, F.col("r"), F.col("m"), F.col("l"), 0.1)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("count(1)")  # the grid is above the count


def test_label_codes(spark):
    df = spark.createDataFrame([("phishing",), ("benign",), ("unknown",)], "label string")
    assert [r[0] for r in df.select(mt.label_code(F.col("label"))).collect()] == [1, 0, None]
