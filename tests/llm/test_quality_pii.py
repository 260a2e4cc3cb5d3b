"""Quality rules and classifier, personal data, fingerprints, licences, and the pipeline."""

import math
import random
import re
from collections import Counter

import numpy as np
from cases import COLUMNS, corpus, empty, table
from pyspark.sql import functions as F

import corpus_pipeline
from certrisk.llm import pii
from certrisk.llm.licenses import licences
from certrisk.llm.piecewise import compared_with_next, edit_distances, fingerprint_column, of_texts, written
from certrisk.llm.quality_classifier import classify, site_parts
from certrisk.llm.quality_rules import fit_cutoffs, judged, kept_documents, permitted, with_statistics
from certrisk.llm.tagger import TAGS, new_tagger

LABELS = "doc_id long, quality int, toxic int"


def test_statistics(spark):
    for r in with_statistics(table(spark)).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        lines = [x for x in (r.text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        count = Counter(windows)
        covered = {i + d for i, w in enumerate(windows) if count[w] > 1 for d in range(3)}
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", r.text or "")), len(lines) - len(set(lines)), len(covered))


def test_binomial_bound(spark):
    def exact(n, rate, level):
        below, k = 0.0, -1
        for i in range(n + 1):
            below += math.comb(n, i) * rate ** i * (1 - rate) ** (n - i)
            if below > level:
                return k
            k = i
        return k

    for n in (0, 1, 50, 400, 900):
        got = spark.range(1).select(permitted(F.lit(n).cast("long"), 0.02, F.lit(1e-3)).alias("k")).first()["k"]
        assert got == exact(n, 0.02, 1e-3)


def test_cutoffs_hold_the_rate(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["alpha", "beta", "gamma", "delta", "eta", "zeta"] + [f"w{k}" for k in range(500)], k=80)) + (
        " ###" * 40 if i % 5 == 0 else ""), "en", "s", 1) for i in range(3000)]
    labels = spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(3000)], LABELS)
    docs = spark.createDataFrame(rows, COLUMNS)
    verdicts = judged(docs, labels, alpha=0.08)
    out = verdicts.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    assert {r.quality: r.kept for r in out}[1] > 0.92 and {r.quality: r.kept for r in out}[0] < 0.05
    cutoffs = fit_cutoffs(verdicts, labels).filter("cutoff IS NOT NULL").collect()
    assert cutoffs and all(c.n_rejected <= c.n_permitted for c in cutoffs)
    assert kept_documents(docs, labels, alpha=0.08).count() == verdicts.filter("kept").count()


def test_rules_edge_cases(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0)], LABELS)
    out = judged(table(spark), labels)
    assert out.count() == len(corpus()) and out.filter("kept IS NULL").count() == 0
    assert judged(empty(spark), labels).count() == 0
    assert kept_documents(table(spark), labels).columns == table(spark).columns


def test_classifier(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        bad = i % 3 == 0
        text = " ".join(rng.choices(["alpha", "beta", "gamma"], k=60)) + (" $$$ ***" * 20 if bad else "")
        rows.append((i, text, "en", "bad.org" if bad else "good.org", 1))
        if i % 2:
            labels.append((i, int(not bad), 0))
    rows.append((9999, None, None, "rare.org", 0))
    out = classify(spark.createDataFrame(rows, COLUMNS), spark.createDataFrame(labels, LABELS), F.col("source"), F.concat_ws("/", "source", "lang"))
    found = {r.doc_id: r for r in out.collect()}
    assert len(found) == 601
    assert all(found[i].kept == bool(i % 3) for i in range(600))
    rate = 2 / 3
    assert abs(found[9999].host_rate - rate) < abs(found[0].host_rate - rate)  # a sparse host stays near the rate
    none = spark.createDataFrame([], LABELS)
    assert classify(table(spark), none, F.col("source"), F.col("lang")).count() == len(corpus())
    assert classify(empty(spark), none, F.col("source"), F.col("lang")).count() == 0


def test_site_parts(spark):
    host, path = site_parts(F.col("u"))
    rows = [tuple(r) for r in spark.createDataFrame([("http://www.A.org/x/y?q=1",), ("nonsense",), (None,)], "u string").select(host, path).collect()]
    assert rows[0] == ("a.org", "a.org/x")


def test_patterns():
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    rng = random.Random(3)
    for _ in range(4000):
        t = "".join(rng.choices(["a", "1", "4111111111111111", ".", "@", "_", "-", "+", " ", "%", "2", "(", "\n"], k=rng.randint(0, 25)))
        want = [("email", *m.span()) for m in email.finditer(t)]
        want += [("ip", *m.span()) for m in ip.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
        want += [("card", *m.span()) for m in card.finditer(t)
                 if 16 <= len(re.findall("[0-9]", m.group())) <= 19 and pii.luhn(re.sub("[^0-9]", "", m.group()))]
        want += [("phone", *m.span()) for m in phone.finditer(t) if 8 <= len(re.findall("[0-9]", m.group())) <= 15]
        assert pii.pattern_spans(t) == want, t


def test_gradient():
    rng = np.random.default_rng(0)
    model = new_tagger(6, 4)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    rows, tags = rng.integers(1, 99, (2, 6)), np.array([[0, 1, 2, 0, 3, 4], [5, 6, 6, 0, 0, TAGS - 2]])
    grad = {k: np.zeros_like(v) for k, v in model.p.items()}
    model.loss(rows, tags, grad)
    for name, index in (("w", (1, 2, 3)), ("u", (0, 1, 5)), ("b", (1, 4)), ("out", (2, 3)), ("move", (1, 2)), ("embed", (rows[0, 0], 1))):
        kept, sides = model.p[name][index], []
        for d in (1e-5, -1e-5):
            model.p[name][index] = kept + d
            sides.append(model.loss(rows, tags, {k: np.zeros_like(v) for k, v in model.p.items()}))
        model.p[name][index] = kept
        assert abs(grad[name][index] - (sides[0] - sides[1]) / 2e-5) < 1e-5


def test_personal_data(spark):
    prose = [r[1] for r in corpus() if r[1]]
    tagger = pii.train(pii.labelled_windows(prose))
    right = found = there = 0
    for text, spans in pii.labelled_windows(prose, 200, 99):
        got, want = set(pii.tagged_spans(tagger, [text])[0]), set(spans)
        right, found, there = right + len(got & want), found + len(got), there + len(want)
    assert right / found > 0.85 and right / there > 0.6
    key = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"
    added = {
        f'the text of a line token = "{key}" and more of it': [("secret", 28, 68)],
        f"the text of a line TOKEN = '{key}' and more of it": [("secret", 28, 68)],
        "please write to anna.berg at mailhouse dot org about the line": [("address", 16, 46)],
        "one line said the same as the other at the polka dot dress here": [],
        'the name = "line" and the place of it': [],
        'x = "' + "ab12" * 5_000 + '"': [],  # longer than any key
    }
    assert pii.tagged_spans(tagger, list(added)) == list(added.values())
    rows = corpus() + [(3000, "é write to a.b@c.example.org or +49 30 1234567, card 4111 1111 1111 1111", "en", "s", 1),
                       (3001, "no 1234567812345678 here", "en", "s", 1), (3002, "x" * 50_000 + " 10.0.0.1", "en", "s", 1),
                       (3003, "some lines of text before\nwhich nobody reads token = \"" + key + '" after', "en", "s", 1)]
    out = {r.doc_id: r for r in pii.with_spans(table(spark, rows), tagger).collect()}
    assert [tuple(s) for s in out[3003].pii] == [("secret", 54, 94, "tagger")]
    kinds = [(s.kind, s.source) for s in out[3000].pii]
    assert kinds == [("email", "pattern"), ("card", "pattern"), ("phone", "pattern")]
    assert not out[3001].pii and not out[1000].pii
    assert [(s.start, s.end) for s in out[3002].pii] == [(50_001, 50_009)]
    masked = {r.doc_id: r.text for r in pii.redacted(table(spark, rows), tagger).collect()}
    assert masked[3000] == "é write to <EMAIL> or <PHONE>, card <CARD>" and masked[1000] is None
    assert pii.redacted(empty(spark), tagger).count() == 0


def test_sampled_texts(spark):
    """Bounded in rows and characters, the same on each run, copies drawn once."""
    rows = [(i % 500, f"text {i % 500} " * (1 + i % 40), "en", "s", 1) for i in range(4000)] + [(None, None, None, None, None)] * 50
    rows += [(None, "é" * 30_000, "en", "s", 1)] * 500
    docs = table(spark, rows)
    drawn = pii.sampled_texts(docs, 60, 100)
    whole = {r[1] for r in rows if r[1]}
    assert 30 <= len(drawn) <= 60 and all(1 <= len(x) <= 100 for x in drawn)
    assert all(any(x in w for w in whole) for x in drawn)
    assert drawn == pii.sampled_texts(docs.repartition(7), 60, 100)
    assert pii.sampled_texts(empty(spark), 60, 100) == [] and len(pii.sampled_texts(table(spark, rows[:3]), 60, 100)) == 3


def test_fingerprints(spark):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    rng = random.Random(2)
    pairs = [tuple("".join(rng.choices("ABCD/9", k=rng.randint(0, 64))).encode() for _ in range(2)) for _ in range(120)]
    assert list(edit_distances(pairs)) == [distance(a, b) for a, b in pairs]
    rows = corpus()
    order = sorted(rows, key=lambda r: (-1 if r[0] is None else r[0]))
    out = compared_with_next(table(spark, rows, 5)).collect()
    assert len(out) == len(rows)
    got = {(r.doc_id, r.edited, r.fingerprint) for r in out}
    for k, r in enumerate(order):
        text, nxt = r[1] or "", order[(k + 1) % len(order)][1] or ""
        n = len(text) // 4
        assert (r[0], text[:len(text) - n] + nxt[:n], written(of_texts([text])[0])) in got
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    long = [r for r in out if r.n_chars > 800 and len(r.fingerprint) > 40]
    assert sum(r.near_edited > 0.5 for r in long) > 0.9 * len(long)
    assert compared_with_next(empty(spark)).count() == 0
    assert fingerprint_column(table(spark)).filter("fingerprint IS NULL").count() == 0


def test_licences(spark):
    rows = corpus() + [(4000, "some prose\n* RELEASED under the MIT license\nmore", "en", "s", 1),
                       (4001, "Licensed under CC BY-NC 4.0.", "en", "s", 1), (4002, "Licensed under the moon, version 2.", "en", "s", 1)]
    out = {r.doc_id: r for r in licences(table(spark, rows)).collect()}
    assert (out[4000].licences, out[4000].places, out[4000].best_score) == ("MIT", "2:MIT", 1.0)
    assert out[4001].licences == "CC-BY-NC-4.0" and not out[4002].n_matches and not out[1000].n_matches
    assert licences(table(spark, rows)).count() == len(rows) and licences(empty(spark)).count() == 0


def test_pipeline(spark, tmp_path):
    rng = random.Random(6)
    word = [f"word{k}" for k in range(900)]
    texts = [" ".join(rng.choices(word, k=150)) for _ in range(30)]
    passage = " ".join(rng.choices(word, k=60))
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    rows += [(100, texts[0] + " end", "en", "s", 1), (101, texts[1], "en", "s", 1), (102, "too short", "en", "s", 9), (103, None, None, None, None)]
    rows += [(110 + k, f"{' '.join(rng.choices(word, k=100))}\n{passage}\nmail me@example.org now", "en", "s", 1) for k in range(3)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(30)], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append(docs)
    assert all(d.columns == ["doc_id", "text", "lang", "source", "n_chars"] for d in kept[:-1])
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in kept]
    assert ids[0] == set(range(30)) | {100, 101, 110, 111, 112}
    assert ids[1] == ids[2] == ids[3] == ids[4] == set(range(30)) | {110, 111, 112}
    with_passage = [r.doc_id for r in kept[2].collect() if passage in r.text]
    assert with_passage == [110]
    final = {r.doc_id: r for r in kept[3].collect()}
    assert "<EMAIL>" in final[110].text and all(r.n_chars == len(r.text) for r in final.values())
