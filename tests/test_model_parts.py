"""Vocabulary, weights and the logistic solver against brute force and MLlib."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from certrisk.config import RiskConfig
from certrisk.operators import vocabulary as vc
from certrisk.operators.logistic import fit_logistic
from certrisk.operators.model import CertificateModel, train, with_terms
from certrisk.operators.ranking import first_rows
from certrisk.plans import jobs
from test_jobs import corpus, fitted  # noqa: F401


@pytest.mark.parametrize("most", [1, 7, 100, 5_000])
def test_first_rows(spark, most):
    rng = np.random.default_rng(most)
    rows = [(f"t{i:04d}", int(n)) for i, n in enumerate(np.minimum(rng.zipf(1.6, 3_000), 1 << 40))]
    df = spark.createDataFrame(rows, "term string, n long").repartition(6)
    got = [(r.term, r.n, r.position) for r in first_rows(df, most, "n", "term").orderBy("position").collect()]
    want = sorted(rows, key=lambda r: (-r[1], r[0]))[:most]
    assert got == [(t, n, k) for k, (t, n) in enumerate(want)]


TEXTS = ["a b a c", "b c d", "", "c c c e", "a b", "e", "f g", "g f"]


def term_rows(spark):
    return spark.createDataFrame([(i, t.split()) for i, t in enumerate(TEXTS)] + [(99, None)], "k long, terms array<string>")


def by_hand(most, least=1, greatest=1.0):
    n, tf, df = len(TEXTS) + 1, Counter(), Counter()
    for t in TEXTS:
        tf.update(t.split())
        df.update(set(t.split()))
    fit = [t for t in tf if least <= df[t] <= greatest * n]
    chosen = sorted(fit, key=lambda t: (-tf[t], t))[:most]
    return chosen, {t: math.log((1 + n) / (1 + df[t])) + 1 for t in chosen}


@pytest.mark.parametrize("most, least, greatest", [(3, 1, 1.0), (5, 2, 1.0), (100, 2, 0.3), (4, 1, 1.0)])
def test_vocabulary_and_weights(spark, most, least, greatest):
    rows = term_rows(spark)
    words = vc.vocabulary(vc.term_stats(rows, "terms"), rows.count(), most, least, greatest)
    chosen, idf = by_hand(most, least, greatest)
    assert [(r.term, round(r.idf, 12)) for r in words.orderBy("position").collect()] == [(t, round(idf[t], 12)) for t in chosen]
    want = {}
    for k, text in enumerate(TEXTS):
        w = {t: n * idf[t] for t, n in Counter(text.split()).items() if t in idf}
        norm = math.sqrt(sum(x * x for x in w.values()))
        want |= {(k, t): round(x / norm, 12) for t, x in w.items()}
    got = vc.tfidf_weights(rows, "k", "terms", words).collect()
    assert {(r.k, r.term): round(r.weight, 12) for r in got} == want and len(got) == len(want)


def test_empty_vocabulary(spark):
    rows = term_rows(spark).filter("k = 2")
    words = vc.vocabulary(vc.term_stats(rows, "terms"), 1, 5)
    assert words.count() == 0 and vc.tfidf_weights(rows, "k", "terms", words).count() == 0


def test_vectors_hold_the_same_weights(spark, fitted):  # noqa: F811
    """What the pipeline puts into its vectors is what the table form says."""
    out, model = fitted
    from certrisk.operators.model import model_input
    rows = model_input(jobs.labelled(jobs.read_parsed(spark, str(out / "data" / jobs.PARSED))), "path")
    vectors = PipelineModel(model.pipeline.stages[:7]).transform(rows).select("path", F.unwrap_udt("x_tfidf").alias("v"))
    got = {(r.path, model.vocabulary[r.i]): round(r.x, 9) for r in vectors.select(
        "path", F.inline(F.arrays_zip(F.col("v.indices").alias("i"), F.col("v.values").alias("x")))).collect()}
    terms = with_terms(rows)
    words = vc.vocabulary(vc.term_stats(terms, "x_terms"), rows.count(), 5000, 2.0, 0.9)
    assert [r.term for r in words.orderBy("position").collect()] == model.vocabulary
    assert got == {(r.path, r.term): round(r.weight, 9) for r in vc.tfidf_weights(terms, "path", "x_terms", words).collect()}


def labelled_points(rows=400, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(rows, 3))
    y = (x @ [1.5, -2.0, 0.0] + rng.normal(size=rows) > 0.8).astype(int)
    return [(int(a), *map(float, b)) for a, b in zip(y, x)]


@pytest.mark.parametrize("penalty", [1.0, 25.0])
def test_logistic_equals_mllib(spark, penalty):
    own = labelled_points()
    df = spark.createDataFrame(own, "y int, a double, b double, c double").repartition(5)
    found = fit_logistic(df, ["a", "b", "c"], "y", penalty)
    assert found.converged and found.steps < 15
    n, ones = len(own), sum(r[0] for r in own)
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="v").transform(
        df.withColumn("w", F.when(F.col("y") == 1, n / 2 / ones).otherwise(n / 2 / (n - ones))))
    theirs = LogisticRegression(featuresCol="v", labelCol="y", weightCol="w", maxIter=1000, tol=1e-12, regParam=penalty / n,
                                elasticNetParam=0.0, standardization=False).fit(vectors)
    assert np.allclose(found.coefficients, theirs.coefficients.toArray(), atol=1e-6)
    assert abs(found.intercept - theirs.intercept) < 1e-6
    p = {r.a: r.p for r in df.withColumn("p", found.probability()).collect()}
    q = {r.a: r.probability[1] for r in theirs.transform(vectors).collect()}
    assert max(abs(p[k] - q[k]) for k in p) < 1e-6


def test_logistic_on_separable_and_odd_rows(spark):
    rows = [(int(k > 10), float(k) * 1e3, None if k % 2 else 1.0) for k in range(21)]
    found = fit_logistic(spark.createDataFrame(rows, "y int, a double, b double"), ["a", "b"], "y")
    x = np.array([[1, r[1], r[2] or 0] for r in rows])
    y = np.array([r[0] for r in rows])
    w = np.array([found.intercept, *found.coefficients])
    c = np.where(y == 1, 21 / 20, 21 / 22)
    gradient = x.T @ (c * (0.5 * (1 + np.tanh(x @ w / 2)) - y)) + [0, *found.coefficients]
    assert found.converged and np.abs(gradient).max() < 1e-4
    with pytest.raises(ValueError, match="both classes"):
        fit_logistic(spark.createDataFrame([(1, 1.0)], "y int, a double"), ["a"], "y")


def test_numbers_model(spark, fitted, tmp_path):  # noqa: F811
    """Fits without text, scores like any other model, and survives saving."""
    out, _ = fitted
    rows = jobs.labelled(jobs.read_parsed(spark, str(out / "data" / jobs.PARSED)))
    model = train(rows, rows.limit(0).select(F.lit("").alias("issuer_key"), F.lit(1).alias("issuer_n"), F.lit(0.0).alias("issuer_frequency")),
                  RiskConfig(model_type="numbers"))
    assert model.predict(rows).filter("ml_label = y_true").count() == 30
    model.save(str(tmp_path / "m"))
    loaded = CertificateModel.load(spark, str(tmp_path / "m"))
    assert loaded.model_type == "numbers" and loaded.vocabulary == []
    a, b = ({r.path: tuple(r.probability) for r in m.predict_proba(rows).collect()} for m in (model, loaded))
    assert a == b and all(abs(sum(p) - 1) < 1e-12 for p in a.values())


ODD_WORDS = [["b", "a"] * 6, ["a", "b", "c"] * 3, ["c"], [], None, ["a"] * 5, ["rare", "a", "b"], ["a", "b", "c", "d", "rare"]]


def grams_by_hand(lists, shortest, longest):
    tf, df = Counter(), Counter()
    for words in lists:
        words = words or []
        own = [" ".join(words[i:i + n]) for n in range(shortest, longest + 1) for i in range(len(words) - n + 1)]
        tf.update(own)
        df.update(set(own))
    return {t: (tf[t], df[t]) for t in tf}


@pytest.mark.parametrize("slice_terms", [1, 7, 1 << 20])
def test_grams_are_counted_by_batch(spark, monkeypatch, slice_terms):
    """Neither rows nor slices lend words to each other's terms."""
    lists = pa.array(ODD_WORDS, pa.list_(pa.string()))
    monkeypatch.setattr(vc, "SLICE_TERMS", slice_terms)
    got = Counter()
    for _, piece in vc._slices(lists):
        for terms, term, row in vc.grams(piece, 1, 3, None, False):
            got.update(terms.take(pa.array(term)).to_pylist())
            assert len(term) == len(row)
    assert got == {t: n for t, (n, _) in grams_by_hand(ODD_WORDS, 1, 3).items()}


def test_gram_stats(spark):
    rows = spark.createDataFrame([(w,) for w in ODD_WORDS * 2], "w array<string>").repartition(3)
    got = {r.term: (r.occurrences, r.documents) for r in vc.gram_stats(rows, "w", 3).collect()}
    assert got == grams_by_hand(ODD_WORDS * 2, 1, 3)


@pytest.mark.parametrize("most, least, greatest", [(1, 1, 1.0), (4, 2, 0.9), (6, 2, 0.3), (1000, 1, 1.0), (1000, 3, 1.0)])
def test_pruned_vocabulary_is_the_whole_one(spark, most, least, greatest):
    """Terms left uncounted are none of the chosen, also where all terms are chosen or the commonest words are not."""
    rng = np.random.default_rng(5)
    lists = ODD_WORDS + [[f"w{min(int(x), 40)}" for x in rng.zipf(1.4, 30)] for _ in range(40)]
    rows = spark.createDataFrame([(k, w) for k, w in enumerate(lists)], "k int, w array<string>")
    words = vc.gram_vocabulary(rows, "w", len(lists), most, least, greatest)
    counted = grams_by_hand(lists, 1, 3)
    fit = [t for t, (_, df) in counted.items() if least <= df <= greatest * len(lists)]
    chosen = sorted(fit, key=lambda t: (-counted[t][0], t))[:most]
    assert [r.term for r in words.orderBy("position").collect()] == chosen
    idf = {t: math.log((1 + len(lists)) / (1 + counted[t][1])) + 1 for t in chosen}
    want = {}
    for k, own in enumerate(lists):
        w = {t: n * idf[t] for t, (n, _) in grams_by_hand([own], 1, 3).items() if t in idf}
        want |= {(k, t): round(x / math.sqrt(sum(y * y for y in w.values())), 12) for t, x in w.items()}
    got = vc.tfidf_weights(rows, "k", "w", words, 3).collect()
    assert {(r.k, r.term): round(r.weight, 12) for r in got} == want and len(got) == len(want)


def test_terms_that_cannot_be_chosen_are_not_counted(spark):
    """Of words that all occur once beside a few common ones, no n-gram is counted."""
    rows = spark.createDataFrame([([f"x{k}-{i}" for i in range(50)] + ["a", "b"] * 4,) for k in range(20)], "w array<string>")
    kept = vc.bitmap(spark.createDataFrame([("a",), ("b",)], "term string"))
    got = {r.term: r.occurrences for r in vc.gram_stats(rows, "w", 2, 2, kept).collect()}
    assert got["a b"] == 80 and got["b a"] == 60 and len(got) < 10  # a word may share a bit with one that is kept


def test_bitmap_has_every_term(spark):
    terms = [f"t{k}" for k in range(3_000)] + ["", "ß", "日本"]
    kept = vc.bitmap(spark.createDataFrame([(t,) for t in terms], "term string"))
    assert kept[vc._places(pa.array(terms))].all() and kept.sum() <= len(terms) and len(kept) == vc.KEPT_BITS
