"""Mixing, fill-in-the-middle and whitening against brute force."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from cases import COLUMNS, corpus, empty, table
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from certrisk.llm import middle
from certrisk.llm.mixing import mixture, taken, targets
from certrisk.llm.queries import op11_whitening
from certrisk.llm.whitening import scatter, whitened

# --- mixing


def shared(sizes, weights=(5, 2, 1), most=3):
    """Targets as fractions, by sharing again until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    held = set()
    while True:
        rest = sum(sizes.values()) - sum(most * sizes[s] for s in held)
        free = sum(weight[s] for s in names if s not in held)
        out = {s: Fraction(most * sizes[s]) if s in held else Fraction(rest * weight[s], free) for s in names}
        above = {s for s in names if out[s] > most * sizes[s]}
        if not above:
            return out
        held |= above


def by_hand(rows, seed=13):
    """``doc_id, source, size, source_size, target, copies`` sorted."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    total = Counter()
    for r, n in zip(rows, size):
        total[r[3]] += n
    target = shared(total)
    out = []
    for source in total:
        members = sorted((n, hashlib.md5(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), -1 if r[0] is None else r[0])
                         for r, n in zip(rows, size) if r[3] == source)
        each = target[source] / total[source] if total[source] else Fraction(3)
        offset = Fraction(int(hashlib.md5(f"{seed}:{source or ''}".encode()).hexdigest()[:5], 16), 1 << 20)
        for k, (n, _, doc_id) in enumerate(members):
            copies = math.floor(each * (k + 1) + offset) - math.floor(each * k + offset)
            out.append((doc_id, source or "", n, total[source], round(float(target[source]), 6), copies if n else -1))
    return sorted(out)


def plain(frame):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.source or "", r["size"], r.source_size, round(r.target, 6),
                   r.copies if r["size"] else -1) for r in frame.collect())


def sourced():
    rows = corpus()
    names = ["web", "web", "web", "Books", "été", "z", None]
    out = [(r[0], r[1], r[2], names[k % len(names)], r[4]) for k, r in enumerate(rows)]
    # Small sources that reach their limit, one after the other; one without words; one of a single long text.
    out += [(3000 + k, "a b c " * (k + 1), "en", f"small{k}", 1) for k in range(4)] + [(3100, None, None, "void", 0), (3101, "x " * 5_000, "en", "long", 1)]
    return out


@pytest.mark.parametrize("parts", [1, 5])
def test_taken(spark, parts):
    rows = sourced()
    got = plain(taken(table(spark, rows, parts)))
    assert got == by_hand(rows)
    assert all(r[5] <= 3 for r in got)


def test_hot_source_comes_near_its_target(spark):
    rows = [(k, "w " * (1 + k * k % 97), "en", "hot" if k % 3 else f"s{k % 30}", 1) for k in range(3_000)]
    took, target = Counter(), {}
    for r in taken(table(spark, rows, 6)).collect():
        took[r.source] += r.copies * r["size"]
        target[r.source] = r.target
    assert all(abs(took[s] - target[s]) <= 3 * 97 for s in target)


@settings(max_examples=10, deadline=None)
@given(st.dictionaries(st.text("abcé", min_size=1, max_size=3), st.integers(0, 10**6), min_size=1, max_size=12))
def test_targets(spark, sizes):
    got = targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"), (5, 2, 1), 3).collect()
    want = shared(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, Fraction(0))
    assert {r.source: round(r.target, 4) for r in got} == {s: round(float(t), 4) for s, t in want.items()}
    assert abs(sum(r.target for r in got) - sum(sizes.values())) < 1e-3
    for r in got:
        if sizes[r.source]:
            assert Fraction(int(r.up), int(r.down)) == want[r.source] / sizes[r.source]


def test_mixture(spark):
    rows = sourced()
    docs = table(spark, rows).withColumn("row", F.lit(1)).withColumn("doc", F.lit(2)).withColumn("size", F.lit(3)).withColumn("copies", F.lit(9))
    out = mixture(docs)
    assert out.columns == docs.columns
    got = Counter(-1 if r.doc_id is None else r.doc_id for r in out.filter("text rlike '[^ \\t-\\r]'").collect())
    want = Counter()
    for doc_id, _, n, _, _, copies in by_hand(rows):
        if n:
            want[doc_id] += copies
    assert got == +want


def test_mixing_nothing(spark):
    assert taken(empty(spark)).count() == 0 and mixture(empty(spark)).count() == 0


# --- fill-in-the-middle


def filled(doc_id, text, seed=7, rate=100, spm_rate=50):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(lines)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    p, q = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b, c = "".join(lines[:p]), "".join(lines[p:q]), "".join(lines[q:])
    if h[3] % 100 < spm_rate:
        return n, "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return n, "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lined():
    odd = ["\n", "\n\n\n", "a\n", "a\nb", "é\nü\n\n\nx", "has <M> inside\nand more", "<P", "a\r\nb\x0bc\x85d ", "<P>", "< P>\n<s>\nP>\n"]
    rows = corpus() + [(4000 + k, t, "en", "s", 1) for k, t in enumerate(odd)]
    rows += [(4100, "long line " * 50_000 + "\nend", "en", "s", 1), (4101, "short\n" * 60_000, "en", "s", 1)]
    return rows + [(None, None, None, None, None)] * 300 + [(4001, "\n\n\n", "en", "s", 1)] * 300


def known(rows):
    return [(-1 if r[0] is None else r[0], *filled(r[0], r[1]), r[1] or "") for r in rows]


@pytest.mark.parametrize("most", [64, middle.PIECE])
def test_digests(spark, most):
    rows = lined()
    got = sorted(((-1 if r.doc_id is None else r.doc_id, *r[1:]) for r in middle.digests(table(spark, rows, 5), most=most).collect()), key=str)
    assert got == sorted(((d, n, form, p, m, sha(out), sha(text)) for d, n, form, p, m, out, text in known(rows)), key=str)
    assert {g[2] for g in got} == {"plain", "psm", "spm"}


def test_transformed_and_restored(spark):
    rows = lined()
    out = middle.transformed(table(spark, rows), most=1_000).withColumn("back", middle.restored("output", "form"))
    got = sorted(((-1 if r.doc_id is None else r.doc_id, *r[1:]) for r in out.collect()), key=str)
    assert got == sorted(known(rows), key=str)


def test_rates(spark):
    rows = lined()
    out = middle.transformed(table(spark, rows), seed=3, rate=40, spm_rate=80).collect()
    assert sorted((str(r.doc_id), r.form, r.output) for r in out) == sorted((str(r[0]), *(filled(r[0], r[1], 3, 40, 80)[k] for k in (1, 4))) for r in rows)


def test_equal_rows_travel_as_one(spark):
    rows = spark.createDataFrame([(None, "same\ntext")] * 5_000, COLUMNS.split(",")[0] + ", text string").coalesce(1)
    assert middle.pieces(rows).count() < 100 and middle.digests(rows).count() == 5_000


def test_middle_of_nothing(spark):
    assert middle.digests(empty(spark)).count() == 0 and middle.transformed(empty(spark)).count() == 0


# --- whitening


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5), st.integers(1, 200), st.sampled_from([1, 2, 900, 1 << 33, 1 << 40]), st.integers(0, 10**6))
def test_scatter(size, rows, most, seed):
    x = np.random.default_rng(seed).integers(-most, most + 1, (rows, size))
    exact = x.astype(object)
    out = scatter(x)
    assert out[0, 0] == rows and list(out[0, 1:]) == list(exact.sum(0))
    assert (out[1:, 1:] == np.triu(exact.T @ exact)).all()


def vectors(rows=400, size=12, seed=4):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(rows, size)) @ rng.normal(size=(size, size)) * 0.1


def check(model_rows, kept, most, scale=1024, shift=100_000):
    """Compare with exact sums and a plain eigendecomposition; ``kept`` are (id, vector)."""
    x = [[math.floor(scale * c) + shift for c in v] for _, v in kept]
    n, size = len(x), len(x[0])
    sums = [sum(col) for col in zip(*x)]
    apart = np.array([[n * a - s for a, s in zip(row, sums)] for row in x], object)
    v = np.array([[float(Fraction(int(c), n**3)) for c in row] for row in apart.T @ apart])
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    want = apart.astype(float) / n @ axes / np.sqrt(values)
    by_id = defaultdict(list)
    for r in model_rows:
        by_id[r.vec_id].append(r)
    for k, (vec_id, _) in enumerate(kept):
        for r in by_id[vec_id]:
            assert int(r.deviation) == int((apart[k] * apart[k]).sum())
            got = np.array(r.whitened)
            sign = np.sign((np.array(by_id[kept[0][0]][0].whitened) * want[0]))
            assert np.allclose(got * sign, want[k], atol=1e-7)
    cov = want.T @ want / n
    return values, float(np.trace(v)), np.abs(cov - np.eye(len(cov))).max()


def test_whitened(spark):
    own = [(k, [float(c) for c in v]) for k, v in enumerate(vectors())]
    odd = [(9000, None), (9001, [None] + [0.0] * 11), (9002, [float("nan")] * 12), (9003, [float("inf")] + [0.0] * 11), (9004, []), (9005, [1.0] * 3)]
    again = [own[3], own[3]]
    frame = spark.createDataFrame(own + odd + again, "vec_id long, embedding array<double>").withColumn("n", F.lit(1)).withColumn("vector", F.lit("x"))
    out, model = whitened(frame.repartition(4))
    rows = out.collect()
    assert len(rows) == len(own) + 2 and {r.vec_id for r in rows} == {k for k, _ in own}
    values, trace, error = check(rows, own + again, 8)
    assert np.allclose(model.values, values, rtol=1e-9) and abs(model.trace / trace - 1) < 1e-12
    assert model.n == len(own) + 2 and model.identity_error < 1e-6 and error < 1e-6


def test_floats_and_fewer_dimensions_than_components(spark):
    own = [(k, [float(np.float32(c)) for c in v]) for k, v in enumerate(vectors(70, 3))]
    out, model = whitened(spark.createDataFrame(own, "vec_id long, embedding array<float>"))
    check(out.collect(), own, 8)
    assert len(model.values) == 3


def test_without_variance(spark):
    rows = [(k, [1.0, float(k), float(k)]) for k in range(20)] + [(None, [1.0, 3.0, 3.0])]
    out, model = whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    for r in out.collect():
        assert r.whitened[0] is not None and r.whitened[1:] == [None, None]
    assert model.identity_error < 1e-9
    out, model = whitened(spark.createDataFrame([(1, [0.5, 0.5])] * 3, "vec_id long, embedding array<double>"))
    assert [(int(r.deviation), r.whitened) for r in out.collect()] == [(0, [None, None])] * 3 and model.identity_error is None


def test_great_entries(spark):
    rows = [(k, [float(k % 7) * 1e8, 1.0 * (k % 3)]) for k in range(50)]
    out, _ = whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    x = [[1024 * int(c) + 100_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    assert {(r.vec_id, int(r.deviation)) for r in out.collect()} == {
        (k, sum((50 * a - s) ** 2 for a, s in zip(row, sums))) for k, row in enumerate(x)}


def test_whitening_nothing(spark):
    for rows in ([], [(1, None)]):
        out, model = whitened(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
        assert out.count() == 0 and model is None


def test_whitening_query(spark, tmp_path):
    spark.createDataFrame([(k, [float(c) for c in v]) for k, v in enumerate(vectors())], "vec_id long, embedding array<float>").write.parquet(
        f"{tmp_path}/embeddings.parquet")
    rows = op11_whitening(spark, str(tmp_path)).collect()
    assert len(rows) == 400 * 8 and {r.component for r in rows} == set(range(1, 9)) and {r.n for r in rows} == {400}
    w = np.zeros((400, 8))
    for r in rows:
        w[r.vec_id, r.component - 1] = r.whitened
    assert np.abs(w.T @ w / 400 - np.eye(8)).max() < 1e-4 and rows[0].identity_error < 1e-4
    shares = sorted({(r.component, r.explained) for r in rows})
    assert [s for _, s in shares] == sorted((s for _, s in shares), reverse=True) and 0 < sum(s for _, s in shares) <= 1
