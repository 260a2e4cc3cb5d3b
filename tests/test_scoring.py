import math
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from certrisk import constants as k
from certrisk.config import RiskConfig
from certrisk.functions import redact
from certrisk.functions.text import with_text_steps
from certrisk.operators import features as ft
from certrisk.operators.ensemble import LLM_TYPE, ML_TYPE, add_verdict, count_at_threshold
from certrisk.operators.issuers import add_issuer_frequency, fit_issuer_frequencies
from certrisk.operators.lookup import is_small, lookup
from certrisk.operators.rules import RULE_FEATURES, Rule, add_rules, default_rules, rule_catalogue, rule_hits
from certrisk.operators.sampling import sample_per_class, split_name
from certrisk.plans.queries import ruled_dumps
from certrisk.session import staged
from conftest import SF
from helpers import one, parsed, rows_of, value

TEXTS = ["", "a", "Abc 123 !?", "naïve café №5 ² Ⅷ Ⓐ", "日本語テキスト😀", "tab\tnbsp em x\x1c", "aaaa",
         "see https://a.b/c and http://d 10.0.0.1 1.2.3.4.5 é1.2.3.4 VERIFY verification Account"]


def python_counts(t):
    n = Counter(t)
    return (len(t), sum(c.isdigit() for c in t), sum(c.isupper() for c in t),
            sum(not c.isalnum() and not c.isspace() for c in t), sum(ord(c) > 127 for c in t),
            round(-sum(v / len(t) * math.log2(v / len(t)) for v in n.values()), 9))


def lexical_rows(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, raw_text string")
    columns = ft.lexical()
    names = ("text_length", "digit_count", "upper_count", "special_char_count", "non_ascii_count", "entropy")
    rows = with_text_steps(df, "raw_text").select("i", *[columns[n].alias(n) for n in names]).collect()
    return {r[0]: (*r[1:6], None if r[6] is None else round(r[6], 9)) for r in rows}


def test_lexical_counts_match_python(spark):
    got = lexical_rows(spark, TEXTS)
    assert got[0] == (None,) * 6
    for i, t in enumerate(TEXTS[1:], 1):
        assert got[i] == python_counts(t), t


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(max_codepoint=0x2FFF, blacklist_categories=("Cs", "Cn")), min_size=1),
                min_size=20, max_size=40))
def test_lexical_counts_on_any_text(spark, texts):
    got = lexical_rows(spark, texts)
    for i, t in enumerate(texts):
        assert got[i] == python_counts(t), repr(t)


def test_statistics(spark):
    df = spark.createDataFrame([(TEXTS[-1],)], "raw_text string")
    c = ft.statistical()
    row = with_text_steps(df, "raw_text").select(*[c[n].alias(n) for n in c]).first()
    # A letter glued to an address hides it; of five numbers the first four count.
    assert row.asDict() == {"url_count": 2, "has_url": 1, "suspicious_keyword_count": 3, "ip_count": 2}


def features(spark, **over):
    return one(ft.add_features(parsed(spark, **over)), "features")


@pytest.mark.parametrize("cn, similarity, squat, exact", [
    ("paypa1", 1 - 1 / 6, 1, []), ("paypal.com", 1.0, 0, ["paypal"]), ("paypa1.com", 0.0, 0, []),
    ("PayPal", 1.0, 0, ["paypal"]), ("stackoverfl0vv", 1 - 3 / 14, 1, []), ("applezoom", 1.0, 0, ["apple", "zoom"]),
    ("facebook", 1.0, 0, ["facebook"]), ("wikipedla.net", 0.0, 0, []), ("", 0.0, 0, []), ("zom", 0.75, 1, [])])
def test_brands(spark, cn, similarity, squat, exact):
    f = features(spark, subject={"CN": cn})
    assert abs(f.max_brand_similarity - similarity) < 1e-12
    assert (f.is_brand_typosquatting, f.brand_exact) == (squat, exact)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_brand_pruning_is_exact(spark):
    names = [b[:i] + x + b[i + d:] for b in k.BRANDS for i in range(0, len(b), 2) for x in ("", "x", "qq") for d in (0, 1, 3)]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = dict(df.select("n", ft.brand_similarity(F.col("n"), k.BRANDS)).collect())
    for n in names:
        best = max(1.0 if b in n else 1 - levenshtein(n, b) / max(len(n), len(b)) for b in k.BRANDS)
        assert got[n] == (best if best > 0.7 else 0.0), n


def test_identity(spark):
    f = features(spark, subject={"CN": "*.xn--a1.example"}, issuer={"O": "Let's Encrypt"}, san=["XN--b"])
    assert (f.subject_cn_has_wildcard, f.subject_has_punycode, f.san_has_punycode) == (1, 1, 1)
    assert f.subject_cn_digit_ratio == 1 / 16 and f.issuer_is_reputable == 0
    f = features(spark, subject={}, issuer={})
    assert (f.subject_cn_length, f.is_self_signed, f.issuer_is_reputable) == (0, 0, 0)
    assert features(spark, subject={"CN": "a", "O": "b"}, issuer={"O": "b", "CN": "a"}).is_self_signed == 1
    assert features(spark, subject={"CN": "pаypal"}).subject_has_homoglyphs == 1
    assert features(spark, subject={"CN": "ωx"}).subject_has_homoglyphs == 1


@pytest.mark.parametrize("days, bucket", [
    (-1, None), (0, None), (1, "very_short"), (6, "very_short"), (7, "short"), (29, "short"), (30, "medium"),
    (89, "medium"), (90, "standard"), (398, "standard"), (399, "long"), (None, None)])
def test_validity_buckets(spark, days, bucket):
    f = features(spark, validity_days=days).asDict()
    on = [b for b in ("very_short", "short", "medium", "standard", "long") if f[f"validity_{b}"]]
    assert on == ([bucket] if bucket else [])


def test_empty_text_leaves_text_features_unset(spark):
    f = features(spark, raw_text="")
    assert f.text_length is None and f.has_url is None and f.entropy is None


def test_issuer_frequency(spark):
    df = parsed(spark, issuer={"A": "1", "B": "2"}).union(parsed(spark, issuer={"B": "2", "A": "1"})).union(
        parsed(spark, issuer={"A": "1"})).union(parsed(spark, issuer={}))
    table = fit_issuer_frequencies(df)
    assert sorted(r.issuer_frequency for r in table.collect()) == [0.25, 0.25, 0.5]
    new = df.union(parsed(spark, issuer={"Z": "9"}))
    for limit in (100, 0):
        got = [r[0] for r in add_issuer_frequency(new, table, limit).select("issuer_frequency").collect()]
        assert sorted(got) == [0.0, 0.25, 0.25, 0.5, 0.5]
    assert one(add_issuer_frequency(parsed(spark), None), "issuer_frequency") is None


@pytest.mark.parametrize("many", ["unseen", "", None])
def test_lookup_with_a_hot_key_that_the_table_lacks(spark, many):
    """Nine of ten rows have one key, unknown to the table: no task gets much more than its share of them."""
    table = staged(spark.range(5_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), F.lit(1).alias("n"), F.col("id").alias("v")), "t")
    df = spark.range(40_000).select(
        F.col("id").cast("string").alias("path"), F.when(F.col("id") % 10 != 0, F.lit(many)).otherwise(F.concat(F.lit("k"), (F.col("id") % 7_000).cast("string"))).alias("key"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = lookup(staged(df, "probe"), table, "key", "n", "path", broadcast_rows=10)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 40_000 and max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]
        plain = df.join(table, "key", "left")
        assert got.groupBy("v").count().exceptAll(plain.groupBy("v").count()).count() == 0
        assert got.filter("v IS NULL").count() == plain.filter("v IS NULL").count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_wide_table_is_not_broadcast(spark):
    wide = staged(spark.range(100).select(F.col("id").cast("string").alias("key"), F.lit(1).alias("n"), F.lit("x" * 1_000).alias("v")), "t")
    assert is_small(wide) and not is_small(wide, size=50_000) and not is_small(wide, rows=99)


def test_lookup_beyond_the_broadcast_limit(spark):
    """Hot, cold and unknown keys give the same rows as a plain join."""
    df = spark.range(30_000).select(
        F.concat(F.lit("p"), "id").alias("path"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1000 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 17_000)).alias("key"))
    table = staged(df.filter("key IS NOT NULL AND key NOT LIKE 'k1%'").groupBy("key").agg(F.count("*").alias("n")), "t")
    assert table.filter("n >= 3").count() == 1
    got = lookup(df, table, "key", "n", "path", broadcast_rows=10).select("path", "key", "n")
    want = df.join(table, "key", "left").select("path", "key", "n")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.count() == 30_000


GOLDEN = [  # fields, issuer frequency, rule, reason
    (dict(validity_days=5), 1.0, "short_validity_period", "Validity period is only 5 days (suspicious, normal is 90-398 days)"),
    (dict(validity_days=399), 1.0, "long_validity_period", "Validity period is 399 days (exceeds CA/Browser Forum baseline of 398 days)"),
    (dict(pubkey_bits=2047), 1.0, "weak_public_key", "Weak public key: 2047 bits (minimum should be 2048)"),
    (dict(signature_algorithm="md5,SHA1"), 1.0, "weak_signature_algorithm", "Weak signature algorithm: SHA1 (deprecated, should use SHA-256 or stronger)"),
    (dict(signature_algorithm="MD5withRSA"), 1.0, "weak_signature_algorithm", "Weak signature algorithm: MD5 (deprecated, should use SHA-256 or stronger)"),
    (dict(san=["xn--x"]), 1.0, "punycode_domain", "Domain uses Punycode (xn--), potential homograph attack"),
    (dict(subject={"CN": "аb"}), 1.0, "homoglyph_characters", "Subject contains homoglyph characters (confusable Unicode)"),
    (dict(subject={"CN": "paypa1"}), 1.0, "brand_typosquatting", "Domain appears to typosquat a major brand (similarity: 0.83)"),
    (dict(issuer={"CN": "www.example.org"}), 1.0, "self_signed", "Certificate is self-signed (not from trusted CA)"),
    (dict(validity_days=89), 0.0001, "rare_issuer_short_validity", "Rare issuer combined with short validity period"),
    (dict(validity_days=None), 0.0001, "rare_issuer_short_validity", "Rare issuer combined with short validity period"),
    (dict(raw_text="http://x"), 1.0, "url_in_certificate", "Certificate contains URL (unusual, may be from phishing capture)"),
    (dict(raw_text="Verify ACCOUNT now"), 1.0, "suspicious_keywords", "Contains 2 suspicious keywords (verify, account, etc.)"),
    (dict(chain_length=0), 1.0, "missing_chain", "Certificate chain is missing or incomplete"),
    (dict(san=[]), 1.0, "no_san", "No Subject Alternative Names (unusual for modern certificates)"),
]
WEIGHTS = {name: w for name, w, *_ in k.RULE_TABLE}


def with_frequency(df, frequency):
    f = ft.add_features(df)
    return f.withColumn("features", F.col("features").withField("issuer_frequency", F.lit(frequency)))


@pytest.mark.parametrize("over, frequency, rule, reason", GOLDEN)
def test_single_rules(spark, over, frequency, rule, reason):
    row = one(add_rules(with_frequency(parsed(spark, **over), frequency)), "rules")
    assert (row.triggered_rules, row.reasons, row.rule_count) == ([rule], [reason], 1)
    assert row.score == WEIGHTS[rule]


@pytest.mark.parametrize("over", [
    {}, dict(validity_days=0), dict(validity_days=7), dict(validity_days=398), dict(pubkey_bits=0), dict(pubkey_bits=2048)])
def test_no_rule(spark, over):
    row = one(add_rules(with_frequency(parsed(spark, **over), 1.0)), "rules")
    assert tuple(row) == (0.0, [], [], 0)


def test_unfitted_issuer_is_not_rare(spark):
    assert one(add_rules(ft.add_features(parsed(spark, validity_days=89))), "rules").rule_count == 0


def test_rule_scores(spark):
    two = one(add_rules(with_frequency(parsed(spark, chain_length=0, san=[]), 1.0)), "rules")
    assert abs(two.score - 0.35) < 1e-12
    strong = dict(pubkey_bits=1024, signature_algorithm="sha1", subject={"CN": "paypa1"})
    assert one(add_rules(with_frequency(parsed(spark, **strong), 1.0)), "rules").score == 1.0
    most = one(add_rules(with_frequency(parsed(
        spark, validity_days=5, pubkey_bits=256, signature_algorithm="sha1", subject={"CN": "zооm xn--"},
        issuer={"CN": "zооm xn--"}, raw_text="http://x verify account", chain_length=0, san=[]), 0.0)), "rules")
    assert most.rule_count == 11 and most.score <= 1.0


def test_custom_rule_and_catalogue(spark):
    rules = [*default_rules(), Rule("wild", 0.2, lambda f: f["subject_cn_has_wildcard"] == 1, lambda f: F.lit("Wildcard"), "Has a wildcard")]
    rows = add_rules(with_frequency(parsed(spark, subject={"CN": "*.a"}), 1.0), rules)
    assert one(rows, "rules").triggered_rules == ["wild"]
    assert rule_catalogue(spark).count() == 13
    hits = {r.rule: r.hits for r in rule_hits(rows, rules).collect()}
    assert len(hits) == 14 and hits["wild"] == 1 and hits["no_san"] == 0


def verdict(spark, rule_score, ml=None, llm=None, **config):
    rules = F.struct(F.lit(rule_score).alias("score"), F.array(F.lit("a"), F.lit("b")).alias("triggered_rules"),
                     F.array(F.lit("why a"), F.lit("why b")).alias("reasons"), F.lit(2).alias("rule_count"))
    df = parsed(spark).withColumn("rules", rules)
    if ml is not None:
        df = df.withColumn("ml", F.struct(F.lit(ml).alias("score"), F.lit("logistic").alias("model")).cast(ML_TYPE))
    if llm is not None:
        label, confidence, flags = llm
        df = df.withColumn("llm", F.from_json(F.to_json(F.struct(
            F.lit(label).alias("label"), F.lit(confidence).alias("confidence"),
            F.array(*map(F.lit, flags)).alias("red_flags"))), LLM_TYPE))
    return add_verdict(df, RiskConfig(**config)).first()


def test_missing_scorers_count_as_half(spark):
    row = verdict(spark, 0.5)
    assert (row.final_score, row.label, row.confidence) == (0.5, "phishing", "medium")
    assert row.method_scores.ml is None and row.method_scores.llm is None
    assert row.combined_reasons == ["[RULE] a", "[RULE] b", "[RULE] why a"]
    assert row.certificate_details.subject_cn == "www.example.org"
    assert verdict(spark, 0.49).label == "benign"


def test_full_verdict(spark):
    row = verdict(spark, 1.0, 0.9, ("phishing", 0.9, ["x", "y", "z", "w"]))
    assert abs(row.final_score - (0.25 + 0.35 * 0.9 + 0.36)) < 1e-12 and row.confidence == "high"
    assert row.combined_reasons[3:] == [
        "[ML] High ML model confidence: 0.90", "[LLM] Classified as phishing (confidence: 0.90)",
        "[LLM] x", "[LLM] y", "[LLM] z"]
    row = verdict(spark, 0.0, 0.1, ("benign", 0.9, ["x"]))
    assert row.confidence == "high" and row.label == "benign" and row.true_label == "benign"
    assert row.combined_reasons[-1] == "[LLM] Classified as benign (confidence: 0.90)"
    assert row.method_scores.llm.confidence == 0.9
    assert verdict(spark, 0.0, 0.0, ("unknown", 0.9, [])).method_scores.llm.score == 0.5


@pytest.mark.parametrize("score, confidence", [(0.8, "high"), (0.79, "medium"), (0.3, "high"), (0.31, "medium")])
def test_confidence_edges(spark, score, confidence):
    weights = dict(weight_rules=1.0, weight_ml=0.0, weight_llm=0.0)
    assert verdict(spark, score, **weights).confidence == confidence


def test_weights_must_add_up():
    with pytest.raises(ValueError):
        RiskConfig(weight_rules=0.5)
    RiskConfig(weight_rules=0.255)


def test_count_at_threshold(spark):
    df = spark.createDataFrame([(0.4,), (0.5,), (0.9,)], "final_score double")
    assert tuple(count_at_threshold(df).first()) == (3, 2)


def test_redaction(spark):
    c = redact.redact_text(F.lit("10.0.0.1 mail a.b+c@d-e.example, 1.2.3 x@y"))
    once = value(spark, c)
    assert once == "[REDACTED_IP] mail [REDACTED_EMAIL], 1.2.3 x@y"
    assert value(spark, redact.redact_text(F.lit(once))) == once
    df = parsed(spark, subject={"CN": "me@a.example", "O": "10.0.0.1"}, raw_text="10.0.0.1")
    row = redact.redact_certificates(df).first()
    assert row.subject == {"CN": "[REDACTED_EMAIL]", "O": "10.0.0.1"} and row.raw_text == "[REDACTED_IP]"
    assert redact.redact_certificates(df, False).first().raw_text == "10.0.0.1"


def test_sample_equals_a_plain_rank(spark):
    import hashlib
    keys = [(f"p{i}", "hot" if i % 3 else f"c{i % 4}") for i in range(3000)] + [("q", None)]
    df = spark.createDataFrame(keys, "path string, label string")
    for n in (1, 37, 500):
        want = set()
        for label in {c for _, c in keys}:
            members = sorted((p for p, c in keys if c == label), key=lambda p: hashlib.md5(f"{p}#42".encode()).hexdigest())
            want |= set(members[:n])
        got = [r.path for r in sample_per_class(df, "label", "path", n).collect()]
        assert sorted(got) == sorted(want)


def test_split_shares(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("path"))
    n = {r[0]: r[1] / 20_000 for r in df.groupBy(split_name("path")).count().collect()}
    assert abs(n["train"] - 0.7) < 0.01 and abs(n["validation"] - 0.15) < 0.01


def test_a_scoring_plan_parses_once_and_counts_no_characters(spark):
    """The rules read few features; the text is parsed for these and for the issuer table together."""
    plan = ruled_dumps(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "CONNECTED(" not in plan and "entropy" not in plan


def test_fitted_features_are_those_of_a_table_fitted_before(spark):
    df = parsed(spark).withColumn("path", F.lit("p/1")).union(parsed(spark, issuer={"CN": "Other"})).union(
        parsed(spark, path="p/2", issuer={}, raw_text="", label=None))
    before = ft.add_features(df, fit_issuer_frequencies(df), keep_text=False)
    names = tuple(n for n in before.schema["features"].dataType.names if n != "issuer_frequency")
    assert rows_of(ft.add_fitted_features(df, ("label",), names).select("path", "label", "features")) == rows_of(
        before.select("path", "label", "features"))
    some = ft.add_fitted_features(df, ("label",), RULE_FEATURES)
    assert rows_of(add_rules(some).select("path", "rules")) == rows_of(add_rules(before).select("path", "rules"))
