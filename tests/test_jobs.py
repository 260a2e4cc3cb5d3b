import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from certrisk.config import RiskConfig
from certrisk.operators.model import CertificateModel, numeric_scaling, train
from certrisk.operators.similar import similar_top_k
from certrisk.plans import jobs
from certrisk.streaming.watch import watch_directory

DUMP = """CONNECTED(00000003)
Certificate chain
 0 s:CN = {cn}
subject=C = US, O = Org {i}, CN = {cn}
issuer=C = US, CN = {ca}
notBefore=Jan  1 00:00:00 2024 GMT
notAfter=Mar {day} 00:00:00 2024 GMT
{extra}
"""


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    for label, extra in (("benign", "plain handshake words"), ("phishing", "https://x.example verify your account")):
        (root / label).mkdir()
        for i in range(15):
            (root / label / f"c{i}").write_text(DUMP.format(
                cn=f"{label}{i}.example", ca="R3" if label == "benign" else "Odd", i=i, day=10 + i, extra=extra))
    return root


@pytest.fixture(scope="module")
def fitted(spark, corpus, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    counts = jobs.preprocess(spark, str(corpus), str(out / "data"))
    assert {r.label: r.certificates for r in counts.collect()} == {"benign": 15, "phishing": 15}
    model = jobs.train(spark, str(out / "data"), str(out / "model"), RiskConfig(max_iter=30))
    return out, model


def test_same_file_names_stay_apart(spark, fitted):
    rows = jobs.read_parsed(spark, str(fitted[0] / "data" / jobs.PARSED))
    assert rows.count() == 30 and rows.select("file_name").distinct().count() == 15
    assert rows.filter("label = 'benign'").select("features.issuer_frequency").distinct().first()[0] == 0.5
    plan = rows.filter("label = 'benign'").select("path")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(label" in plan


def test_evaluate(spark, fitted):
    out, _ = fitted
    report = jobs.evaluate(spark, str(out / "model"), str(out / "data"), str(out / "report")).first()
    assert report.accuracy == 1.0 and report.roc_auc == 1.0 and report.total_samples == 30
    saved = spark.read.json(str(out / "report" / "evaluation_report")).first()
    assert saved.confusion_matrix == [[15, 0], [0, 15]]


def test_model_survives_saving(spark, fitted):
    out, model = fitted
    rows = jobs.read_parsed(spark, str(out / "data" / jobs.PARSED))
    loaded = CertificateModel.load(spark, str(out / "model"))
    assert loaded.model_type == "logistic" and loaded.vocabulary == model.vocabulary
    a = {r.path: r.ml.score for r in model.predict(rows).collect()}
    b = {r.path: r.ml.score for r in loaded.predict(rows).collect()}
    assert a == b and len(a) == 30
    p = loaded.predict_proba(rows).select("probability").first()[0]
    assert abs(sum(p) - 1) < 1e-9


def test_vocabulary(fitted):
    """Terms of one document alone and of nearly all documents are left out."""
    words = set(fitted[1].vocabulary)
    assert {"verify", "verify your", "verify your account", "plain handshake"} <= words
    assert "benign3" not in words and "connected" not in words


def test_numeric_scaling(spark):
    from certrisk.operators.model import NUMERIC
    df = spark.createDataFrame([(1.0,), (2.0,)], "v double").select(
        F.col("v").alias(NUMERIC[0]), *[F.lit(3.0).alias(x) for x in NUMERIC[1:]])
    rows = numeric_scaling(df).transform(df).orderBy(NUMERIC[0]).select(f"z_{NUMERIC[0]}", f"z_{NUMERIC[1]}").collect()
    assert [tuple(r) for r in rows] == [(-1.0, 0.0), (1.0, 0.0)]


def test_logistic_solution_is_the_penalised_one(spark, fitted):
    """At the optimum the gradient of sum(weighted loss) + |w|^2 / 2 vanishes."""
    out, _ = fitted
    rows = jobs.labelled(jobs.read_parsed(spark, str(out / "data" / jobs.PARSED)))
    model = train(rows, config=RiskConfig(max_iter=500))
    x = model.pipeline.transform(__import__("certrisk.operators.model", fromlist=["x"]).model_input(rows, "y_true"))
    data = x.select("features_vector", "y_true", "probability").collect()
    m = np.array([r[0].toArray() for r in data])
    residual = np.array([r[2][1] - r[1] for r in data])  # classes are balanced, weights are 1
    w = model.pipeline.stages[-1].coefficients.toArray()
    assert np.abs(m.T @ residual + w).max() < 1e-3


def test_boosted_trees_and_errors(spark, fitted):
    out, _ = fitted
    rows = jobs.labelled(jobs.read_parsed(spark, str(out / "data" / jobs.PARSED)))
    model = train(rows, config=RiskConfig(model_type="xgboost"))
    assert model.predict(rows).filter("ml_label = y_true").count() == 30
    with pytest.raises(ValueError, match="unknown model type"):
        train(rows, config=RiskConfig(model_type="forest"))
    with pytest.raises(ValueError, match="both classes"):
        train(rows.filter("y_true = 1"))


def test_batch_infer_with_everything(spark, fitted, corpus, tmp_path):
    out, model = fitted
    counts = jobs.batch_infer(
        spark, str(corpus), str(tmp_path / "all"), 0.5, model=model,
        scorer=lambda p: json.dumps({"label": "phishing" if "verify" in p.rsplit("certificate:", 1)[-1] else "benign", "confidence": 0.9}),
        responses_path=str(tmp_path / "answers"))
    assert tuple(counts.first()) == (30, 15)
    rows = spark.read.json(str(tmp_path / "all" / "detections"))
    assert rows.filter("label = true_label").count() == 30
    assert {"rules", "ml", "llm"} == set(rows.select("method_scores.*").columns)


def test_batch_infer_hits_only(spark, corpus, tmp_path):
    counts = jobs.batch_infer(spark, str(corpus), str(tmp_path), 0.5, only_hits=True).first()
    assert counts.processed == 30
    assert spark.read.json(str(tmp_path / "detections")).count() == counts.at_threshold


def test_infer_one_file(spark, corpus):
    row = jobs.infer(spark, str(corpus / "phishing" / "c3")).first()
    assert row.certificate_details.subject_cn == "phishing3.example" and row.true_label == "phishing"
    assert 0.375 <= row.final_score <= 0.625 and row.confidence == "medium"


def test_quarantine(spark):
    df = spark.createDataFrame([("a", "error"), ("b", "pem")], "path string, file_type string")
    good, bad = jobs.quarantine(df)
    assert [r.path for r in good.collect()] == ["b"] and [r.path for r in bad.collect()] == ["a"]


def test_redaction_reaches_the_table(spark, corpus, tmp_path):
    extra = tmp_path / "in" / "benign"
    extra.mkdir(parents=True)
    (extra / "c").write_text("subject=CN = me@mail.example\n10.0.0.1\n")
    jobs.preprocess(spark, str(tmp_path / "in"), str(tmp_path / "out"), config=RiskConfig(redact_pii=True))
    row = jobs.read_parsed(spark, str(tmp_path / "out" / jobs.PARSED)).first()
    assert row.subject["CN"] == "[REDACTED_EMAIL]" and "10.0.0.1" not in row.raw_text


def test_new_captures(spark):
    old = jobs.with_content_hash(spark.createDataFrame([("a", None)], "text string, content binary"))
    raw = spark.createDataFrame([("p", "a", None), ("q", "b", None), ("r", None, bytearray(b"a"))], "path string, text string, content binary")
    assert [r.path for r in jobs.new_captures(raw, old).collect()] == ["q"]


def test_stream_picks_up_new_files_only(spark, corpus, fitted, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i in range(3):
        (source / f"a{i}").write_text((corpus / "phishing" / f"c{i}").read_text())
    args = (spark, str(source), str(tmp_path / "found"), str(tmp_path / "progress"), fitted[1].frequencies)
    watch_directory(*args, once=True).awaitTermination()
    assert spark.read.json(str(tmp_path / "found")).count() == 3
    (source / "b").write_text("issuer=CN = x\n")
    watch_directory(*args, once=True).awaitTermination()
    found = spark.read.json(str(tmp_path / "found"))
    assert found.count() == 4 and found.select("file_name").distinct().count() == 4


def test_similar_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    m = rng.normal(size=(300, 8))
    m[10] = m[20]
    m[30] = 0
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "vec_id long, v array<double>").repartition(7)
    queries = df.filter("vec_id % 40 = 0 or vec_id = 30").withColumnRenamed("vec_id", "q")
    n = np.linalg.norm(m, axis=1)
    sims = m @ m.T / np.where(np.outer(n, n) == 0, 1, np.outer(n, n))
    for block in (3, 1024):
        rows = similar_top_k(df, queries, "vec_id", "q", "v", 4, block).orderBy("q", "rank").collect()
        assert len(rows) == 4 * queries.count()
        for r in rows:
            order = sorted(range(300), key=lambda i: (-round(sims[r.q][i], 12), i))
            assert abs(r.similarity - sims[r.q][order[r["rank"] - 1]]) < 1e-9


def test_similar_in_one_plan(spark):
    """Very many queries make no longer a plan, also when they are too many to send to every task."""
    rng = np.random.default_rng(9)
    own = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(500, 4)))]
    df = spark.createDataFrame([*own, (900, None)], "id long, v array<double>").repartition(3)
    queries = spark.range(100_000).select(F.col("id").alias("q"), F.array(*[
        (F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 500 - 1) for i in range(4)]).alias("v"))
    few = similar_top_k(df, queries.limit(10), "id", "q", "v", 2)
    many = similar_top_k(df, queries, "id", "q", "v", 2)
    size = [len(x._jdf.queryExecution().optimizedPlan().toString().splitlines()) for x in (few, many)]
    assert size[1] <= size[0] + 2
    assert many.count() == 200_000
    some = queries.filter("q % 500 = 0")
    for limit in (1 << 30, 0):
        got = similar_top_k(df, some.union(spark.createDataFrame([(-1, None)], "q long, v array<double>")), "id", "q", "v", 2, 64, limit)
        assert got.count() == 400 and got.filter("q = -1 or id = 900").count() == 0
        best = {(r.q, r["rank"]): r.id for r in got.collect()}
        for r in some.collect():
            sims = sorted((-round(float(np.dot(r.v, v) / np.linalg.norm(r.v) / np.linalg.norm(v)), 12), i) for i, v in own)
            assert [best[r.q, 1], best[r.q, 2]] == [sims[0][1], sims[1][1]]


def test_incremental_runs(spark, corpus, tmp_path, monkeypatch):
    """Only new contents are parsed; a run that dies between its two tables is made good by the next."""
    root, out = tmp_path / "in", str(tmp_path / "out")
    (root / "benign").mkdir(parents=True)

    def add(name, text):
        (root / "benign" / name).write_text(text)

    def run(**options):
        return tuple(jobs.preprocess_new(spark, str(root), out, **options).first())

    for i in range(4):
        add(f"a{i}", f"subject=CN = host{i}\nissuer=CN = x\n")
    add("copy", "subject=CN = host0\nissuer=CN = x\n")
    assert run() == (5, 4) and run() == (0, 0)
    add("b", "subject=CN = host9\nissuer=CN = y\n")
    add("copy2", "subject=CN = host1\nissuer=CN = x\n")
    add("long", "x" * 2_000)
    small = RiskConfig(max_capture_bytes=1_000)
    assert run(config=small) == (2, 1)
    assert [r.reason for r in spark.read.json(f"{out}/{jobs.QUARANTINE}").collect()] == ["longer than 1000 bytes"]
    add("a3", "subject=CN = changed now\nissuer=CN = y\n")
    written = jobs.staged
    monkeypatch.setattr(jobs, "together", lambda parts: (_ for _ in ()).throw(KeyboardInterrupt) if "path" in parts[0].columns and "length" in parts[0].columns else parts[0])
    with pytest.raises(KeyboardInterrupt):
        run(config=small)
    monkeypatch.undo()
    assert written is jobs.staged
    assert run(config=small) == (1, 0)
    rows = {r.cn: (r.n, r.f) for r in jobs.content_features(spark, out).select(
        F.col("subject")["CN"].alias("cn"), F.col("n_files").alias("n"), F.col("features.issuer_frequency").alias("f")).collect()}
    assert rows == {"host0": (2, 0.75), "host1": (2, 0.75), "host2": (1, 0.75), "host3": (1, 0.75), "host9": (1, 0.25), "changed now": (1, 0.25)}


def test_stream_answers_each_certificate_once(spark, corpus, tmp_path):
    source = tmp_path / "in"
    source.mkdir()

    def add(name, i):
        (source / name).write_text((corpus / "phishing" / f"c{i}").read_text())

    def go():
        watch_directory(spark, str(source), str(tmp_path / "found"), str(tmp_path / "progress"), once=True, once_within="1 day",
                        files_per_trigger=2).awaitTermination()
        return spark.read.json(str(tmp_path / "found")).count()

    for i in range(3):
        add(f"a{i}", i)
        add(f"same{i}", i)
    assert go() == 3
    add("again", 1)
    add("new", 7)
    assert go() == 4
    for k in range(2):
        (source / f"nameless{k}").write_text("nothing to tell")
    assert go() == 6


def test_stream_lists_its_files_in_few_tasks(spark, tmp_path):
    source, key = tmp_path / "in", "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    source.mkdir()
    for i in range(40):  # from 33 paths on, a batch lists them in a job
        (source / f"c{i}").write_text(f"subject=CN = host{i}\n")
    spark.conf.unset(key)
    watch_directory(spark, str(source), str(tmp_path / "found"), str(tmp_path / "progress"), once=True).awaitTermination()
    assert spark.read.json(str(tmp_path / "found")).count() == 40
    assert int(spark.conf.get(key)) <= 2 * spark.sparkContext.defaultParallelism
