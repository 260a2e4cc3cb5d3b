"""Substring, line and set duplicates against brute force."""

import functools
import hashlib
import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from cases import corpus, empty, table
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from certrisk.llm import line_dedup, set_join
from certrisk.llm.line_dedup import dedup_units
from certrisk.llm.passages import shared_windows, stretches
from certrisk.llm.quality_rules import kept_documents
from certrisk.llm.set_join import PartScheme, SetGroup, jaccard_components, one_of_each, rare_places
from certrisk.llm.suffix_dedup import dedup_substrings
from certrisk.llm.suffix_order import suffix_order


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40))
def test_suffix_order(symbols):
    assert list(suffix_order(np.array(symbols, np.int64))) == sorted(range(len(symbols)), key=lambda k: symbols[k:])


@pytest.mark.parametrize("most_kinds", [2_000, 1])
def test_substrings(spark, most_kinds):
    rows, length = corpus(), 100
    texts = [(r[1] or "").encode() for r in rows]
    counts = Counter(t[k:k + length] for t in texts for k in range(len(t) - length + 1))
    want = []
    for row, t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, int)
        for k in range(len(t) - length + 1):
            if counts[t[k:k + length]] > 1:
                gone[k] += 1
                gone[k + length] -= 1
        covered = np.cumsum(gone)[:-1] > 0
        spans = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~covered].tobytes()
        want.append((-1 if row[0] is None else row[0], len(t), spans, kept))
    out = dedup_substrings(table(spark, rows), length=length, gram=20, most_kinds=most_kinds).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, len(r.spans), bytes(r.kept)) for r in out) == sorted(want)


def test_substrings_report_short_passages(spark):
    """A passage of 50 short words has fewer bytes than a removed string, and is reported all the same."""
    rng = random.Random(8)
    prose = lambda n: " ".join(rng.choices([f"v{k}" for k in range(900)], k=n))
    passage, body = prose(60), prose(70)
    rows = [(1, f"{prose(20)} {passage} {prose(9)}", "en", "s", 1), (2, f"{prose(3)}\n{passage.upper()}", "en", "s", 1),
            (3, prose(90), "en", "s", 1), (4, None, "en", "s", 1), (None, "", "en", "s", 1), (5, f"{body} {body}", "en", "s", 1)]
    assert len(passage) < 400
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    out = dedup_substrings(table(spark, rows), passage_words=50)
    assert spark.conf.get(key) == before
    got = {r.doc_id: ([(p["first"], p["last"]) for p in r.passages], len(r.spans)) for r in out.collect()}
    assert got == {1: ([(20, 79)], 0), 2: ([(3, 62)], 0), 3: ([], 0), 4: ([], 0), None: ([], 0), 5: ([], 0)}
    assert "passages" not in dedup_substrings(table(spark, rows)).columns
    assert dedup_substrings(empty(spark), passage_words=50).count() == 0


def test_lines(spark):
    rows = corpus()
    out = dedup_units(table(spark, rows), min_words=4)
    assert "bucket" in out.columns
    seen, want = set(), []
    for row in sorted({(-1 if r[0] is None else r[0], r[1]) for r in rows if r[1] is not None}):
        kept = []
        pieces = row[1].split("\n")
        for k, line in enumerate(pieces):
            plain = re.sub(r"[\W_]+", " ", line.lower()).strip()
            if len(plain.split()) >= 4:
                if plain in seen:
                    continue
                seen.add(plain)
            kept.append(line + ("\n" if k < len(pieces) - 1 else ""))
        want.append((row[0], "".join(kept)))
    got = {(-1 if r.doc_id is None else r.doc_id, r.text) for r in out.collect() if r.text is not None}
    assert got == set(want) and out.count() == len(rows)
    for r in out.filter("size(removed) > 0").collect():
        assert all(s.start < s.end for s in r.removed)
    assert dedup_units(empty(spark)).count() == 0


@pytest.mark.parametrize("words, gram", [(12, 3), (50, 10)])
def test_shared_passages(spark, words, gram):
    rng = random.Random(4)
    prose = lambda n: " ".join(rng.choices([f"w{k}" for k in range(900)], k=n))
    passage, long, twice = prose(words + 1), prose(words * 4), prose(words)
    rows = corpus() + [
        (2001, f"{prose(20)} {passage} {prose(9)}", "en", "s", 1), (2002, f"{prose(3)}\n{passage.upper()}", "en", "s", 1),
        (2003, f"{prose(5)} {twice} x {twice} {prose(5)}", "en", "s", 1),  # repeats within itself alone
        (2004, long, "en", "s", 1), (2005, long.replace(" ", "  ") + " " + prose(4), "en", "s", 1),
        (2006, f"{long} {prose(7)} {long}", "en", "s", 1), (2007, prose(words - 1), "en", "s", 1)]
    rows += [(2010 + k, f"{prose(30)} {' '.join(passage.split()[:words - 1])} {prose(30)}", "en", "s", 1) for k in range(2)]
    texts = {(r[0], r[1]) for r in rows if r[1] is not None}
    holders = defaultdict(set)
    split = {t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t[1])) for t in texts}
    for t, w in split.items():
        for k in range(len(w) - words + 1):
            holders[tuple(w[k:k + words])].add(t)
    want = {}
    for t, w in split.items():
        covered = np.zeros(len(w) + 2, int)
        for k in range(len(w) - words + 1):
            if len(holders[tuple(w[k:k + words])]) > 1:
                covered[k + 1:k + 1 + words] = 1
        edge = np.diff(covered)
        want[t] = list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist()))
    out = dedup_units(table(spark, rows), min_words=10_000, passage_words=words)
    found = out.select("doc_id", "text", "passages").collect()
    assert len(found) == len(rows)
    assert {(r.doc_id, r.text): [(p["first"], p["last"]) for p in r.passages] for r in found if r.text is not None} == want
    assert want[next(t for t in texts if t[0] == 2001)] and not want[next(t for t in texts if t[0] == 2003)]
    assert all(r.passages == [] for r in found if r.text is None)
    assert shared_windows(table(spark, rows), words, gram).count() > 0
    assert dedup_units(empty(spark), passage_words=words).count() == 0


def test_stretches_follow_the_words():
    rng = np.random.default_rng(3)
    passage = rng.integers(0, 1 << 63, 600, dtype=np.uint64)

    def found(before, after):
        words = np.concatenate([rng.integers(0, 1 << 63, before, dtype=np.uint64), passage,
                                rng.integers(0, 1 << 63, after, dtype=np.uint64)])
        first, size, gram, kind = stretches(words, np.zeros(len(words), int), 50, 10)
        assert size.sum() == len(words) - 49 and len(first) < len(words) / 8
        return set(zip(gram.tolist(), kind.tolist()))

    # All stretches of the passage but those at its ends are the same, wherever it stands.
    assert len(found(40_000, 7) & found(3, 500)) >= len(found(0, 0)) - 4


def brute_components(rows, percent):
    sets = {}
    for i, (doc, text, *_) in enumerate(rows):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets[i] = frozenset(zip(w, w[1:], w[2:], w[3:])) if len(w) >= 4 else frozenset([tuple(w)] if w else [])
    home = {i: i for i in sets}

    def root(k):
        while home[k] != k:
            k = home[k]
        return k

    for i in sets:
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                home[root(i)] = root(j)
    least = defaultdict(list)
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[root(i)].append(row[0])
    return sorted((-1 if r[0] is None else r[0], len(sets[i]), min(least[root(i)], default=-1)) for i, r in enumerate(rows))


@pytest.mark.parametrize("percent, block", [(85, 400_000), (85, 300), (60, 200)])
def test_set_join(spark, percent, block):
    rows = corpus(seed=5)
    out = jaccard_components(table(spark, rows), percent=percent, block_shingles=block).collect()
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in out)
    assert got == brute_components(rows, percent)


def test_a_line_of_many_texts_makes_no_large_cluster(spark, monkeypatch):
    """Groups of near copies that begin with the same line are not compared group with group, and none of their links is lost."""
    rng = random.Random(11)

    def prose(n):
        return ["".join(rng.choices("abcdefgh", k=6)) for _ in range(n)]

    line, rows = prose(25), []
    for _ in range(30):
        base = prose(70)
        for _ in range(rng.randint(1, 4)):
            near = list(base)
            near[rng.randrange(70)] = "changed"
            rows.append((len(rows), " ".join(line + near), "en", "s", 1))
    weights, links = [], set_join.cluster_links

    def seen(sets, percent, block_shingles):
        weights.extend(r.w for r in sets.groupBy("cluster").agg(F.sum("n_shingles").alias("w")).collect())
        return links(sets, percent, block_shingles)

    monkeypatch.setattr(set_join, "cluster_links", seen)
    out = jaccard_components(table(spark, rows), block_shingles=600).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute_components(rows, 85)
    assert len(weights) > 10 and max(weights) <= 600


def test_linked_sets_share_a_rare_shingle():
    rng = np.random.default_rng(5)
    for percent in (60, 80, 85, 95):
        for _ in range(40):
            common = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
            sets = []
            for _ in range(8):
                base = np.concatenate([common, rng.integers(0, 1 << 63, int(rng.integers(1, 60)), dtype=np.uint64)])
                for _ in range(3):
                    near = base.copy()
                    near[rng.integers(0, len(near), int(rng.integers(0, 8)))] = rng.integers(0, 1 << 63, dtype=np.uint64)
                    sets.append(np.unique(near[int(rng.integers(0, 6)):]))
            flat, starts = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            _, back, counts = np.unique(flat, return_inverse=True, return_counts=True)
            place = rare_places(flat, counts[back], starts, percent)
            keys = [set(flat[place[(place >= a) & (place < b)]].tolist()) for a, b in zip(starts, starts[1:])]
            for i, a in enumerate(sets):
                for j, b in enumerate(sets[:i]):
                    both = len(np.intersect1d(a, b))
                    if 100 * both >= percent * (len(a) + len(b) - both):
                        assert keys[i] & keys[j]


def test_set_join_leaves_no_shuffles_behind(spark, monkeypatch):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, seen, write = spark.conf.get(key), [], set_join.staged

    def spied(df, name):
        seen.append(df.sparkSession.conf.get(key))
        return write(df, name)

    monkeypatch.setattr(set_join, "staged", spied)
    jaccard_components(table(spark, corpus(seed=5)))
    assert set(seen) == {"true"} and spark.conf.get(key) == before


def test_one_of_each(spark):
    rows = corpus(seed=5)
    kept = Counter(r.doc_id for r in one_of_each(table(spark, rows)).collect())
    want = {c for d, _, c in brute_components(rows, 85) if d == c}
    assert {-1 if k is None else k for k in kept} == want
    assert jaccard_components(empty(spark)).count() == 0


def test_names_the_operators_use_themselves(spark):
    """Callers may have columns of any name, those the operators add inside included."""
    names = ["u_id", "u_hash", "_id", "_hash", "_kept_id", "own", "own_", "unit_id", "unit_hash", "kept_id", "kept_hash", "digest", "n"]
    docs = table(spark, corpus(seed=5))
    for name in names:
        docs = docs.withColumn(name, F.lit(name))
    assert set(dedup_units(docs, min_words=4).columns) == set(docs.columns)
    assert dedup_units(docs, min_words=4).filter("u_id <> 'u_id' or unit_id <> 'unit_id'").count() == 0
    assert one_of_each(docs).columns == docs.columns and one_of_each(docs).count() == one_of_each(table(spark, corpus(seed=5))).count()
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    assert kept_documents(docs, labels).columns == docs.columns


def colliding(n=2048):
    """Two words of the same letters that all sums of powers modulo 2**64 take for one."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_colliding_words(spark):
    one, two = colliding()
    rows = [(1, f"x y {one} z", "en", "s", 1), (2, f"x y {two} z", "en", "s", 1), (3, f"x y {one} z", "en", "s", 1)]
    got = {r.doc_id: r.component_id for r in jaccard_components(table(spark, rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_linked_sets_share_as_many_parts_as_wanted():
    """Whatever the class of the larger set, both sides share at least what each of them asks for."""
    rng = np.random.default_rng(8)
    for percent in (60, 80, 85, 95):
        scheme = PartScheme(percent)
        for _ in range(300):
            n = int(rng.integers(1, 400))
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
            b = a.copy()
            for k in range(int(rng.integers(0, max(1, n // 8)))):
                b[k] = np.uint64(rng.integers(0, 2**63)) * np.uint64(2)
            b = np.unique(b[int(rng.integers(0, max(1, n // 10))):])
            both = len(np.intersect1d(a, b))
            if 100 * both >= percent * (len(a) + len(b) - both) and not np.array_equal(a, b):
                c = scheme.class_of(max(len(a), len(b)))
                (ka, needs_a), (kb, needs_b) = scheme.wanted(a), scheme.wanted(b)
                shared = np.intersect1d(ka, kb)
                n_shared = int((shared & np.uint64(127) == c).sum())
                assert n_shared >= dict(needs_a)[c] and n_shared >= dict(needs_b)[c]


def test_linked_sets_share_a_part():
    rng = np.random.default_rng(3)
    scheme = PartScheme(85)
    for _ in range(300):
        n = int(rng.integers(1, 120))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        b = a.copy()
        for k in range(int(rng.integers(0, max(1, n // 6)))):
            b[k] = np.uint64(rng.integers(0, 2**63)) * np.uint64(2)
        b = np.unique(b[int(rng.integers(0, max(1, n // 10))):])
        both = len(np.intersect1d(a, b))
        if 100 * both >= 85 * (len(a) + len(b) - both) and not np.array_equal(a, b):
            assert len(np.intersect1d(scheme.keys(a), scheme.keys(b)))


def test_set_group_connects_all_links():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**62, 60).astype(np.uint64)
    sets = []
    for _ in range(60):
        s = base.copy()
        s[rng.integers(0, 60, int(rng.integers(0, 14)))] = rng.integers(0, 2**62)
        sets.append(np.unique(s))
    group = SetGroup(sets, 85)
    group.links()
    for i in range(60):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                assert group.root(i) == group.root(j)


def test_digest_of_nothing():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


@pytest.mark.parametrize("words, gram", [(12, 4), (50, 10)])
def test_later_passages_are_cut(spark, words, gram, monkeypatch):
    """Of each window of words the first document keeps its own; the others lose it, inside lines and across them."""
    rng = random.Random(words)

    def prose(n):
        return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 6))) for _ in range(n))

    passage, long, twice = prose(words + 3), prose(words * 4), prose(words)
    other = long.split()[:words * 2] + prose(words).split() + long.split()[words * 2:]
    texts = [f"{prose(9)} {passage} {prose(4)}", f"{prose(5)}\n{passage.upper()} {prose(5)}", passage.replace(" ", "\n", 3), f"é {passage}ß",
             long, f"{prose(7)}  {long}", " ".join(other), " ".join(other[words:]), f"{twice} x {twice}", prose(words * 2),
             " ".join(passage.split()[:words - 1]), "", f"{prose(3)} {long} {passage}", long, " ".join(long.split()[5:])]
    rows = [(k, t, "en", "s", 1) for k, t in enumerate(texts)] + [(50, None, "en", "s", 1), (4, long, "en", "s", 1), (None, twice, "en", "s", 1)]
    met, want = set(), {}
    for doc_id, text in sorted({(r[0], r[1]) for r in rows if r[1] is not None}, key=lambda r: -1 if r[0] is None else r[0]):
        places = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        body = [text[a:b].translate({c: c + 32 for c in range(65, 91)}) for a, b in places]
        windows = [tuple(body[i:i + words]) for i in range(len(body) - words + 1)]
        covered = np.zeros(len(body), bool)
        for i, w in enumerate(windows):
            if w in met:
                covered[i:i + words] = True
        met |= set(windows)
        gone = np.zeros(len(text), bool)
        for i in np.flatnonzero(covered):  # words next to each other go with what is between them
            gone[places[i][0]:places[i + 1][0] if i + 1 < len(body) and covered[i + 1] else places[i][1]] = True
        want[doc_id, text] = "".join(c for c, g in zip(text, gone) if not g)
    shared = functools.partial(line_dedup.shared_passages, gram=gram)
    monkeypatch.setattr(line_dedup, "shared_passages", shared)
    docs = table(spark, rows)
    out = dedup_units(docs, min_words=10_000, passage_words=words, cut_passages=True)
    own = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = out.select("doc_id", "text", "removed").collect()
    assert {(r.doc_id, own[r.doc_id]): r.text for r in got if r.text is not None} == want and len(got) == len(rows)
    assert all(own[r.doc_id] is not None or r.text is None for r in got)
    assert any(len(t) < len(k[1]) for k, t in want.items())


def test_pipeline_cuts_passages_inside_lines(spark):
    rng = random.Random(8)
    passage = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(60))
    rows = [(k, f"start {k} {passage} {k} end", "en", "s", 1) for k in range(3)]
    out = corpus_pipeline.repeated_lines(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int"), "")
    assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {
        0: (rows[0][1], len(rows[0][1])), 1: ("start 1  1 end", 14), 2: ("start 2  2 end", 14)}
