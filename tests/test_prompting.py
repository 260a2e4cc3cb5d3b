import json

import pytest
from pyspark.sql import functions as F

from certrisk.operators import prompting
from certrisk.operators.prompting import (
    add_llm, ask_model, build_prompt, cache_key, cache_stats, clear_cache, distinct_certificates, parse_responses, summary)
from helpers import one, parsed

GOOD = {"label": "phishing", "confidence": 0.64, "reasoning": "The name swaps two letters of a bank",
        "red_flags": ["swapped letters"], "benign_signals": []}


def read(spark, text):
    df = spark.createDataFrame([(text,)], "raw_response string")
    return one(parse_responses(df), "llm")


@pytest.mark.parametrize("text, label, confidence, error", [
    (json.dumps(GOOD, indent=4), "phishing", 0.64, False),
    ("My view, fenced.\n```json\n" + json.dumps({**GOOD, "label": "benign"}) + "\n```\n", "benign", 0.64, False),
    ("```" + json.dumps(GOOD) + "```", "phishing", 0.64, False),
    ("I say " + json.dumps(GOOD) + " and no more", "phishing", 0.64, False),
    ('"label": "Benign", "confidence": 0.7, "reasoning": "cut of', "benign", 0.7, False),
    ('"label": "benign", "confidence": 1.2.3', "unknown", 0.5, True),
    ("no braces here, sorry", "unknown", 0.5, True),
    ("", "unknown", 0.5, True),
    (None, "unknown", 0.5, True),
    ('["phishing"]', "unknown", 0.5, True),
    ('"phishing"', "unknown", 0.5, True),
    ("{}", "unknown", 0.5, False),
    ('{"a": 1} {"label": "benign"}', "benign", 0.5, False),
    ('{"a": 1}, {"label": "benign"}', "benign", 0.5, False),
    ('{"label": "benign", "more": {"x": 1}} so far', "benign", 0.5, False),
    ('{"label": "phishing", "confidence": "0.9"}', "phishing", 0.9, False),
    ('{"label": "phishing", "confidence": "high"}', "phishing", 0.5, False),
    ('{"label": "phishing", "confidence": 7}', "phishing", 1.0, False),
    ('{"label": "phishing", "confidence": -1}', "phishing", 0.0, False),
    ('{"label": "phishing", "confidence": [1]}', "phishing", 0.5, False),
])
def test_responses(spark, text, label, confidence, error):
    got = read(spark, text)
    assert (got.label, got.confidence, got.parse_error) == (label, confidence, error)
    assert got.raw_response == text


def test_response_details(spark):
    got = read(spark, json.dumps(GOOD))
    assert (got.reasoning, got.red_flags, got.benign_signals) == (GOOD["reasoning"], GOOD["red_flags"], [])
    assert read(spark, "prose").reasoning == "Failed to parse LLM response"
    assert read(spark, '"label": "benign", "reasoning": "short"').reasoning == "short"


def test_prompt(spark):
    df = parsed(spark, subject={"CN": "example.com"}, raw_text="x" * 5000, pubkey_bits=None)
    text = one(df.select(build_prompt(summary()).alias("p")), "p")
    assert "phishing" in text and "benign" in text and "example.com" in text and "Already judged" in text
    shown = json.loads(text.split("certificate:\n")[-1].split("\n\nThe verdict")[0])
    assert len(shown) == 12 and len(shown["raw_text"]) == 2000 and shown["pubkey_bits"] is None
    assert "Already judged" not in one(df.select(build_prompt(summary(), include_context=False).alias("p")), "p")


def test_cache_key_ignores_key_order_and_text(spark):
    a = parsed(spark, issuer={"A": "1", "B": "2"}, raw_text="one")
    b = parsed(spark, issuer={"B": "2", "A": "1"}, raw_text="two")
    c = parsed(spark, issuer={"A": "1", "B": "2"}, not_before="2024")
    keys = [one(x.select(cache_key().alias("k")), "k") for x in (a, b, c)]
    assert keys[0] == keys[1] != keys[2]
    row = distinct_certificates(a.withColumn("path", F.lit("z")).union(b)).first()
    assert row.n_copies == 2 and row.cert.raw_text == "two"


def test_retries_and_neutral_result(spark, tmp_path):
    log = tmp_path / "calls"

    def flaky(prompt):
        with open(log, "a") as f:
            f.write("x")
        if len(log.read_text()) < 3:
            raise RuntimeError("busy")
        return json.dumps(GOOD)

    prompts = spark.createDataFrame([("k", "p")], "cache_key string, prompt string").coalesce(1)
    got = ask_model(prompts, flaky, "m", pause=0.0).first()
    assert (got.model, got.error) == ("m", None) and len(log.read_text()) == 3

    def broken(prompt):
        raise RuntimeError("down")

    row = one(add_llm(parsed(spark), broken, model="m", pause=0.0), "llm")
    assert (row.label, row.confidence, row.error) == ("unknown", 0.5, "down")
    assert row.reasoning == "API error after 3 attempts" and row.red_flags == []


def test_answers_are_stored_and_used_again(spark, tmp_path):
    path = str(tmp_path / "answers")
    log = tmp_path / "calls"

    def scorer(prompt):
        with open(log, "a") as f:
            f.write("x")
        return json.dumps(GOOD)

    a, b = parsed(spark), parsed(spark, subject={"CN": "other"})
    assert add_llm(a.union(a), scorer, path).count() == 2
    assert len(log.read_text()) == 1
    assert add_llm(a.union(b), scorer, path).select("llm.label").distinct().count() == 1
    assert len(log.read_text()) == 2 and cache_stats(spark, path) == {"size": 2, "failures": 0}
    clear_cache(spark, path)
    assert cache_stats(spark, path)["size"] == 0
    assert cache_stats(spark, path + "-none")["size"] == 0


def certificates(spark, n):
    rows = parsed(spark)
    return rows.crossJoin(spark.range(n)).withColumn("subject", F.create_map(F.lit("CN"), F.concat(F.lit("c"), F.col("id").cast("string")))).drop("id")


def counting(log, answer=lambda prompt: json.dumps(GOOD)):
    def scorer(prompt):
        with open(log, "a") as f:
            f.write(json.loads(prompt.split("certificate:\n")[-1].split("\n\nThe verdict")[0])["subject"]["CN"] + "\n")
        return answer(prompt)
    return scorer


def test_a_job_that_dies_between_waves_asks_nothing_twice(spark, tmp_path, monkeypatch):
    rows, path, log = certificates(spark, 60), str(tmp_path / "answers"), tmp_path / "calls"
    whole, asked = prompting.ask_model, []

    def dies(*args, **options):
        if len(asked) == 2:
            raise KeyboardInterrupt
        asked.append(1)
        return whole(*args, **options)

    monkeypatch.setattr(prompting, "ask_model", dies)
    with pytest.raises(KeyboardInterrupt):
        add_llm(rows, counting(log), path, wave_rows=12)
    done = log.read_text().split()
    assert 0 < len(done) < 60 and cache_stats(spark, path)["size"] == len(done)
    monkeypatch.setattr(prompting, "ask_model", whole)
    assert add_llm(rows, counting(log), path, wave_rows=12).filter("llm.label = 'phishing'").count() == 60
    assert sorted(log.read_text().split()) == sorted(f"c{i}" for i in range(60))
    assert add_llm(rows, counting(log), path).count() == 60 and len(log.read_text().split()) == 60


def test_repeated_stored_answers_give_one_verdict(spark, tmp_path):
    rows, path = certificates(spark, 3), str(tmp_path / "answers")
    keys = [r.k for r in rows.orderBy("subject.CN").select(cache_key().alias("k")).collect()]
    good, other = json.dumps(GOOD), json.dumps({**GOOD, "label": "benign"})
    stored = [(keys[0], "a", good, None)] * 3 + [(keys[0], "b", other, None), (keys[1], "a", None, "down"), (keys[1], "a", good, None), (keys[2], None, None, "down")]
    spark.createDataFrame(stored, prompting.RESPONSES).write.parquet(path)
    log = tmp_path / "calls"
    for _ in range(2):
        got = sorted((r.subject["CN"], r.llm.label, r.llm.error) for r in add_llm(rows, counting(log), path).collect())
        assert got == [("c0", "benign", None), ("c1", "phishing", None), ("c2", "unknown", "down")] and not log.exists()
    got = {r.subject["CN"]: r.llm.label for r in add_llm(rows, counting(log), path, retry_failed=True).collect()}
    assert got["c2"] == "phishing" and log.read_text().split() == ["c2"]
    assert cache_stats(spark, path) == {"size": 3, "failures": 0}


def test_no_scorer_means_no_verdict(spark):
    assert one(add_llm(parsed(spark), None), "llm") is None
    assert prompting.LLM_TYPE.startswith("struct<label")
