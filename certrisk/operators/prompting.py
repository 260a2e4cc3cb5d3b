"""Language-model scoring as a table: prompts, one answer per distinct certificate, verdicts.

The model itself is a function given by the caller. It sees each distinct
certificate once, its answers are stored, and later runs ask only for new ones.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from certrisk.config import DEFAULT, RiskConfig
from certrisk.functions.names import sorted_entries
from certrisk.operators.ensemble import LLM_TYPE
from certrisk.operators.lookup import lookup
from certrisk.session import new_path, staged

SUMMARY_FIELDS = (
    "file_name", "subject", "issuer", "san", "not_before", "not_after", "validity_days",
    "pubkey_type", "pubkey_bits", "signature_algorithm", "chain_length", "raw_text")

SYSTEM_TEXT = """You review TLS certificates for signs of phishing and decide for each one \
whether it is phishing or benign.

Weigh at least these points: look-alike spellings, foreign letters or brand names in subject \
and alternative names; a lifetime under 7 or over 398 days; issuers that are unknown or do not \
fit the subject; RSA keys under 2048 bits and SHA-1 or MD5 signatures; a missing chain; links, \
odd paths or other leftovers of a page capture in the raw text.

Answer with one JSON object and nothing around it:
{"label": "phishing" or "benign", "confidence": number from 0 to 1, "reasoning": string, \
"red_flags": [strings], "benign_signals": [strings]}"""

EXAMPLES = (
    ({"file_name": "library_site", "subject": {"CN": "www.citylibrary.example", "O": "City Library"},
      "issuer": {"CN": "DigiCert TLS CA", "O": "DigiCert Inc"},
      "san": ["www.citylibrary.example", "citylibrary.example"],
      "not_before": "2024-03-01T00:00:00+00:00", "not_after": "2024-05-30T00:00:00+00:00",
      "validity_days": 90, "pubkey_type": "RSA", "pubkey_bits": 2048,
      "signature_algorithm": "sha256WithRSAEncryption", "chain_length": 3,
      "raw_text": "Certificate chain ..."},
     {"label": "benign", "confidence": 0.95,
      "reasoning": "A known issuer, matching names, a usual lifetime and a full chain.",
      "red_flags": [],
      "benign_signals": ["known issuer", "90-day lifetime", "names match the owner"]}),
    ({"file_name": "capture_0417", "subject": {"CN": "paypa1-login.example"},
      "issuer": {"CN": "paypa1-login.example"}, "san": [],
      "not_before": "2024-03-01T00:00:00+00:00", "not_after": "2024-03-05T00:00:00+00:00",
      "validity_days": 4, "pubkey_type": "RSA", "pubkey_bits": 1024,
      "signature_algorithm": "sha1WithRSAEncryption", "chain_length": 0,
      "raw_text": "https://paypa1-login.example/verify-account ..."},
     {"label": "phishing", "confidence": 0.93,
      "reasoning": "The name imitates a payment brand, the certificate signs itself and lives "
                   "four days, and the capture holds a link asking to verify an account.",
      "red_flags": ["look-alike of a payment brand", "self-signed", "four-day lifetime"],
      "benign_signals": []}),
)

# How an answer may be wrapped, and its fields when it is no JSON.
FENCED = r"(?s)```(?:json)?\s*(\{.*?\})\s*```"
BRACED = r'\{[^{}]*"label"[^{}]*\}'
LABEL_FIELD = r'(?i)"label"\s*:\s*"(phishing|benign)"'
CONFIDENCE_FIELD = r'"confidence"\s*:\s*([0-9.]+)'
REASONING_FIELD = r'"reasoning"\s*:\s*"([^"]+)"'
UNPARSED = "Failed to parse LLM response"


def summary(source: Callable[[str], Column] = F.col, max_chars: int = 2000) -> Column:
    """The twelve fields a prompt shows, the text cut to its first ``max_chars`` characters."""
    fields = [source(n).alias(n) for n in SUMMARY_FIELDS if n != "raw_text"]
    text = F.substring(F.coalesce(source("raw_text"), F.lit("")), 1, max_chars)
    return F.struct(*fields, text.alias("raw_text"))


def build_prompt(
    cert: Column, include_context: bool = True, system_text: str = SYSTEM_TEXT,
    examples: tuple = EXAMPLES,
) -> Column:
    """Prompt of a summary struct: instructions, examples when wanted, the certificate."""
    shown = ""
    if include_context:
        shown = "\n\nAlready judged:" + "".join(
            f"\n\n{json.dumps(a)}\n=> {json.dumps(b)}" for a, b in examples)
    return F.concat(
        F.lit(f"{system_text}{shown}\n\nNow judge this certificate:\n"),
        F.to_json(cert, {"ignoreNullFields": "false"}),
        F.lit("\n\nThe verdict as JSON, nothing else:"))


def cache_key() -> Column:
    """Equal for certificates with the same subject, issuer and dates."""
    return F.md5(F.to_json(F.struct(
        sorted_entries(F.col("subject")).alias("subject"),
        sorted_entries(F.col("issuer")).alias("issuer"),
        F.col("not_before"), F.col("not_after")), {"ignoreNullFields": "false"}))


def parse_responses(df: DataFrame, response: str = "raw_response") -> DataFrame:
    """Add an ``llm`` struct read from model answers.

    Tried in turn: the whole answer as JSON, JSON in a code fence, the first
    object with a label, and single fields by pattern.
    """
    t = F.col(response)
    kept = df.columns
    # Parsed as the one element of a list: the parser itself overlooks what follows a value.
    df = df.withColumns({
        f"_{name}": F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))) for name, text in (
            ("whole", t),
            ("fenced", F.nullif(F.regexp_extract(t, FENCED, 1), F.lit(""))),
            ("braced", F.nullif(F.regexp_extract(t, BRACED, 0), F.lit(""))))})
    df = df.withColumns({
        "_label": F.nullif(F.lower(F.regexp_extract(t, LABEL_FIELD, 1)), F.lit("")),
        "_number": F.nullif(F.regexp_extract(t, CONFIDENCE_FIELD, 1), F.lit("")),
        "_why": F.nullif(F.regexp_extract(t, REASONING_FIELD, 1), F.lit(""))})
    df = df.withColumn("_json", F.coalesce(*[
        F.when(F.try_variant_get(c, "$[1]", "variant").isNull(), F.try_variant_get(c, "$[0]", "variant"))
        for c in ("_whole", "_fenced", "_braced")]))
    df = df.withColumn("_bad_number", F.col("_number").isNotNull()
                       & F.col("_number").try_cast("double").isNull())
    v = F.col("_json")
    is_json = v.isNotNull()
    is_object = F.coalesce(F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), F.lit(False))
    usable = ~F.col("_bad_number")

    def words(path: str) -> Column:
        return F.coalesce(F.when(is_object, F.try_variant_get(v, path, "array<string>")),
                          F.array().cast("array<string>"))

    label = F.coalesce(
        F.when(is_object, F.try_variant_get(v, "$.label", "string")),
        F.when(~is_json & usable, F.col("_label")), F.lit("unknown"))
    number = F.coalesce(
        F.when(is_object, F.try_variant_get(v, "$.confidence", "double")),
        F.when(~is_json, F.col("_number").try_cast("double")), F.lit(0.5))
    reasoning = F.coalesce(
        F.when(is_object, F.coalesce(F.try_variant_get(v, "$.reasoning", "string"), F.lit(""))),
        F.when(~is_json & usable, F.col("_why")), F.lit(UNPARSED))
    struct = F.struct(
        label.alias("label"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), number)).alias("confidence"),
        reasoning.alias("reasoning"),
        words("$.red_flags").alias("red_flags"),
        words("$.benign_signals").alias("benign_signals"),
        (F.col("model") if "model" in kept else F.lit(None).cast("string")).alias("model"),
        t.alias("raw_response"),
        (F.col("error") if "error" in kept else F.lit(None).cast("string")).alias("error"),
        (~is_object & (label == "unknown")).alias("parse_error"))
    return df.withColumn("llm", struct).select(*kept, "llm")


def distinct_certificates(df: DataFrame, config: RiskConfig = DEFAULT) -> DataFrame:
    """``cache_key, cert, n_copies``: of equal certificates the one with the first path.

    Copies are folded before the shuffle, however many there are of one key.
    """
    keyed = df.select(cache_key().alias("cache_key"), "path",
                      summary(max_chars=config.prompt_chars).alias("cert"))
    return keyed.groupBy("cache_key").agg(
        F.min_by("cert", "path").alias("cert"), F.count("*").alias("n_copies"))


def ask_model(
    prompts: DataFrame, scorer: Callable[[str], str], model: str = "unknown",
    config: RiskConfig = DEFAULT, pause: float = 1.0, concurrency: int | None = None,
) -> DataFrame:
    """``cache_key, prompt`` to ``cache_key, model, raw_response, error``.

    A failed call is tried again after 1, 2, 4 ... times ``pause`` seconds; the
    last failure becomes the row's ``error``. ``concurrency`` bounds the number
    of tasks calling the model at once.
    """
    retries = config.max_retries

    def answer(prompt: str) -> tuple[str | None, str | None]:
        for attempt in range(retries):
            try:
                return scorer(prompt), None
            except Exception as problem:  # noqa: BLE001 - any failure of the caller's model
                if attempt == retries - 1:
                    return None, str(problem)
                time.sleep(pause * 2 ** attempt)
        return None, "no attempt allowed"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = [answer(p) for p in batch["prompt"]]
            yield pd.DataFrame({
                "cache_key": batch["cache_key"], "model": model,
                "raw_response": [a for a, _ in answers], "error": [e for _, e in answers]})

    if concurrency is not None:
        prompts = prompts.repartition(concurrency, "cache_key")
    return prompts.mapInPandas(
        run, "cache_key string, model string, raw_response string, error string")


def neutral_where_failed(df: DataFrame, config: RiskConfig = DEFAULT) -> DataFrame:
    """Replace the verdict of rows with an ``error`` by the neutral one."""
    neutral = F.struct(
        F.lit("unknown").alias("label"), F.lit(0.5).alias("confidence"),
        F.lit(f"API error after {config.max_retries} attempts").alias("reasoning"),
        F.array().cast("array<string>").alias("red_flags"),
        F.array().cast("array<string>").alias("benign_signals"),
        F.lit(None).cast("string").alias("model"), F.lit(None).cast("string").alias("raw_response"),
        F.col("error"), F.lit(False).alias("parse_error")).cast(LLM_TYPE)
    return df.withColumn("llm", F.when(F.col("error").isNotNull(), neutral).otherwise(F.col("llm")))


RESPONSES = "cache_key string, model string, raw_response string, error string"


def stored_answers(spark: SparkSession, path: str) -> DataFrame:
    """Answers kept under ``path``; none if there is nothing yet."""
    try:
        return spark.read.schema(RESPONSES).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], RESPONSES)
        raise


def one_per_key(answers: DataFrame) -> DataFrame:
    """Of several answers to one key a successful one, the same in every run; copies are folded before the shuffle."""
    best = F.min(F.struct(F.col("error").isNotNull().alias("failed"), "raw_response", "model", "error"))
    return answers.groupBy("cache_key").agg(best.alias("_a")).select("cache_key", "_a.model", "_a.raw_response", "_a.error")


def ask_in_waves(
    distinct: DataFrame, scorer: Callable[[str], str], path: str, model: str = "unknown",
    include_context: bool = True, config: RiskConfig = DEFAULT, pause: float = 1.0, concurrency: int | None = None,
    wave_rows: int = 10_000, retry_failed: bool = False,
) -> int:
    """Answer every key of ``distinct`` (``cache_key, cert``, staged) that has none under ``path``, and return the number of waves.

    Keys are dealt to waves of about ``wave_rows`` by hash, and the answers of a wave are committed before the next is asked. A job
    that dies and is run again asks only for keys without a committed answer, so at most one wave is paid for twice.
    ``retry_failed`` asks again where only failures are kept.
    """
    spark = distinct.sparkSession
    known = stored_answers(spark, path)
    if retry_failed:
        known = known.filter("error IS NULL")
    todo = staged(distinct.join(known.select("cache_key"), "cache_key", "left_anti"), "unanswered")
    waves = -(-todo.count() // wave_rows)
    wave = F.pmod(F.xxhash64("cache_key"), F.lit(waves))
    for k in range(waves):
        prompts = todo.filter(wave == k).select(
            "cache_key", build_prompt(F.col("cert"), include_context).alias("prompt"))
        ask_model(prompts, scorer, model, config, pause, concurrency).write.mode("append").parquet(path)
    return waves


def add_llm(
    df: DataFrame, scorer: Callable[[str], str] | None, responses_path: str | None = None,
    model: str = "unknown", include_context: bool = True, config: RiskConfig = DEFAULT,
    pause: float = 1.0, concurrency: int | None = None, source: DataFrame | None = None,
    wave_rows: int = 10_000, retry_failed: bool = False,
) -> DataFrame:
    """Add the ``llm`` verdict; without a scorer it is NULL.

    ``source`` holds the same certificates with the fields a prompt shows, so that ``df``
    itself need not carry the capture text. Answers found under ``responses_path`` are used again, failures included, and
    new ones are added there, wave by wave; without it they go to the shared work folder, so that a stage that is run again
    reads them and does not ask.
    """
    if scorer is None:
        return df.withColumn("llm", F.lit(None).cast(LLM_TYPE))
    spark = df.sparkSession
    distinct = staged(distinct_certificates(df if source is None else source, config), "distinct-certificates")
    path = responses_path or new_path(spark, "answers")
    ask_in_waves(distinct, scorer, path, model, include_context, config, pause, concurrency, wave_rows, retry_failed)
    # Of all that was ever answered, only what this table asks about is parsed.
    own = stored_answers(spark, path).join(distinct.select("cache_key"), "cache_key", "left_semi")
    parsed = neutral_where_failed(parse_responses(one_per_key(own)), config).select("cache_key", "llm")
    table = staged(
        distinct.select("cache_key", "n_copies").join(parsed, "cache_key"), "verdicts")
    keyed = df.withColumn("cache_key", cache_key())
    return lookup(keyed, table, "cache_key", "n_copies", "path").drop("cache_key", "n_copies")


def cache_stats(spark: SparkSession, responses_path: str) -> dict[str, int]:
    """Distinct keys with an answer, and those of them that only failed."""
    row = one_per_key(stored_answers(spark, responses_path)).agg(F.count("*"), F.count("error")).first()
    return {"size": row[0], "failures": row[1]}


def clear_cache(spark: SparkSession, responses_path: str) -> None:
    spark.createDataFrame([], RESPONSES).write.mode("overwrite").parquet(responses_path)
