"""Queries of the correctness gate, one or more per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from certrisk.config import RiskConfig
from certrisk.functions import redact
from certrisk.functions.names import sorted_entries
from certrisk.functions.text import strip_accents, with_text_steps
from certrisk.operators import features as ft
from certrisk.operators import metrics as mt
from certrisk.operators import prompting
from certrisk.operators.ensemble import LLM_TYPE, ML_TYPE, add_verdict, count_at_threshold, llm_score
from certrisk.operators.issuers import add_issuer_frequency, fit_issuer_frequencies
from certrisk.operators.logistic import LogisticFit, fit_logistic
from certrisk.operators.model import numeric_scaling, train, with_words
from certrisk.operators.parse import parse
from certrisk.operators.rules import RULE_FEATURES, add_rules, rule_hits
from certrisk.operators.sampling import sample_per_class, split_name
from certrisk.operators.similar import similar_top_k
from certrisk.operators.vocabulary import gram_stats, gram_vocabulary, term_stats, tfidf_weights as weigh
from certrisk.plans import jobs
from certrisk.session import new_path, staged
from certrisk.sources.captures import file_type, load_dataset
from certrisk.sources.derived import cert_ders, cert_dumps, properties, spoil, spread, table, write_files
from certrisk.sources.records import read_jsonl
from certrisk.streaming.watch import watch_directory

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(c: Column | str) -> Column:
    return F.round(c, 6)


def joined(c: Column | str) -> Column:
    return F.array_join(c, "|")


def documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents").select("doc_id", "text"), "doc_id")


def parsed_dumps(spark: SparkSession, d: str) -> DataFrame:
    return parse(cert_dumps(spark, d), decode=False)


#: What verdicts and the queries below read beside the rules.
VERDICT_COLUMNS = ("path", "file_name", "label", "subject", "issuer", "san", "validity_days", "k")


def ruled_dumps(spark: SparkSession, d: str) -> DataFrame:
    return add_rules(ft.add_fitted_features(parsed_dumps(spark, d), VERDICT_COLUMNS, RULE_FEATURES))


def with_stand_in_scores(df: DataFrame) -> DataFrame:
    """Classifier and model results made from the row key, NULL for some rows."""
    k = F.col("k")
    ml = F.when(k % 3 != 0, F.struct(
        ((k % 11) / 10).alias("score"), F.lit("logistic").alias("model")).cast(ML_TYPE))
    flags = F.array(F.lit("flag one"), F.lit("flag two"), F.lit("flag three"), F.lit("flag four"))
    llm = F.when(k % 4 != 3, F.struct(
        F.when(k % 4 == 0, "phishing").when(k % 4 == 1, "benign").otherwise("unknown").alias("label"),
        ((k % 7) / 8).alias("confidence"), F.lit("because").alias("reasoning"),
        flags.alias("red_flags"), F.array(F.lit("chain")).alias("benign_signals"),
        F.lit("stand-in").alias("model"), F.lit(None).cast("string").alias("raw_response"),
        F.lit(None).cast("string").alias("error"), F.lit(False).alias("parse_error")).cast(LLM_TYPE))
    return df.withColumn("ml", ml).withColumn("llm", llm)


def scored_dumps(spark: SparkSession, d: str) -> DataFrame:
    return with_stand_in_scores(ruled_dumps(spark, d))


def verdicts(spark: SparkSession, d: str) -> DataFrame:
    return add_verdict(scored_dumps(spark, d)).withColumn(
        "k", F.substring_index("path", "/", -1).cast("bigint"))


# --- flagship


@query
def verdict_summary(spark: SparkSession, d: str) -> DataFrame:
    """How many captures look like phishing by rules alone, and how sure are we?"""
    return add_verdict(ruled_dumps(spark, d)).groupBy("label", "confidence").agg(
        F.count("*").alias("captures"), r6(F.avg("final_score")).alias("avg_score"))


# --- sources


@query
def sniff_type(spark: SparkSession, d: str) -> DataFrame:
    dumps = cert_dumps(spark, d).select(F.lit("dump").alias("origin"), F.col("k").alias("id"), "text")
    pages = table(spark, d, "pages").select(F.lit("page"), "page_id", "html")
    docs = table(spark, d, "documents").select(F.lit("document"), "doc_id", "text")
    everything = dumps.union(pages).union(docs)
    return everything.select("origin", "id", file_type(F.col("text").cast("binary")).alias("file_type"))


@query
def sniff_der(spark: SparkSession, d: str) -> DataFrame:
    ders = cert_ders(spark, d)
    return ders.select("k", file_type(F.col("der")).alias("file_type"))


def supplier_dumps(spark: SparkSession, d: str) -> DataFrame:
    """One short capture per supplier, for the file-based queries."""
    s, n = table(spark, d, "supplier"), table(spark, d, "nation")
    key = F.col("s_suppkey")
    text = F.concat(
        F.lit("CONNECTED(00000003)\nCertificate chain\n 0 s:x\nsubject=C = "), F.col("n_name"),
        F.lit(", O = "), F.col("s_name"), F.lit(", CN = supplier"), key.cast("string"),
        F.lit(".example\nissuer=CN = CA "), (key % 3).cast("string"),
        F.lit("\nnotBefore=Jan  1 00:00:00 2024 GMT\nnotAfter=Jan "),
        F.lpad((key % 20 + 2).cast("string"), 2, " "), F.lit(" 00:00:00 2024 GMT"),
        F.when(key % 5 == 0, F.lit("\nhttps://login.example/verify")).otherwise(""))
    label = F.when(key % 2 == 0, "benign").otherwise("phishing")
    return s.join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey")).select(
        key.alias("k"), label.alias("label"), text.alias("text"))


def file_tasks(spark: SparkSession, d: str) -> int:
    """Tasks to write a file per supplier with, as a task writes its files one after the other."""
    return max(spark.sparkContext.defaultParallelism, table(spark, d, "supplier").count() // 1000)


def supplier_files(spark: SparkSession, d: str) -> str:
    """Write the supplier captures as one file each below benign/ and phishing/."""
    root = new_path(spark, "captures")
    write_files(supplier_dumps(spark, d).repartition(file_tasks(spark, d), "k"), root)
    return root


@query
def binary_source(spark: SparkSession, d: str) -> DataFrame:
    raw = load_dataset(spark, supplier_files(spark, d))
    return raw.select(
        "label", "file_type", F.regexp_extract("text", r"CN = (supplier\d+)", 1).alias("name"),
        F.length("text").cast("bigint").alias("n_chars"))


@query
def jobs_preprocess(spark: SparkSession, d: str) -> DataFrame:
    out = new_path(spark, "preprocessed")
    jobs.preprocess(spark, supplier_files(spark, d), out)
    rows = jobs.read_parsed(spark, f"{out}/{jobs.PARSED}")
    return rows.select(
        F.col("subject")["CN"].alias("cn"), "label", "validity_days",
        F.col("features.has_url").alias("has_url"),
        r6("features.issuer_frequency").alias("issuer_frequency"))


#: Captures above this length, which are those with a link, count as too long here.
SHORT = RiskConfig(max_capture_bytes=215)


def spoiled_files(spark: SparkSession, d: str) -> str:
    """The supplier captures, of which every seventh no longer fits its checksum."""
    root = supplier_files(spark, d)
    spoil(spark, root, F.regexp_extract("text", r"CN = supplier(\d+)", 1).cast("long") % 7 == 3)
    return root


@query
def unreadable_files(spark: SparkSession, d: str) -> DataFrame:
    """What became of every file of a folder with captures that are too long or cannot be read."""
    out = new_path(spark, "preprocessed")
    jobs.preprocess(spark, spoiled_files(spark, d), out, config=SHORT)
    good = jobs.read_parsed(spark, f"{out}/{jobs.PARSED}").select(
        "label", F.lit("parsed").alias("outcome"), F.col("subject")["CN"].alias("cn"))
    bad = read_jsonl(spark, f"{out}/{jobs.QUARANTINE}", "label string, reason string").select(
        "label", F.col("reason").alias("outcome"), F.lit("").alias("cn"))
    return good.union(bad).groupBy("label", "outcome", "cn").agg(F.count("*").alias("files"))


@query
def infer_with_errors(spark: SparkSession, d: str) -> DataFrame:
    """Detections of the same folder: bad files are counted as errors and leave the others alone."""
    out = new_path(spark, "inferred")
    jobs.batch_infer(spark, spoiled_files(spark, d), out, config=SHORT)
    found = spark.read.schema("certificate_details struct<subject_cn:string>, status string, final_score double").json(
        f"{out}/detections")
    cn = F.when(F.col("status") == "ok", F.col("certificate_details.subject_cn")).otherwise("")
    return found.groupBy("status", cn.alias("cn")).agg(
        F.count("*").alias("files"), r6(F.avg("final_score")).alias("final_score"))


@query
def jobs_batch_infer(spark: SparkSession, d: str) -> DataFrame:
    out = new_path(spark, "inferred")
    jobs.batch_infer(spark, supplier_files(spark, d), out)
    found = spark.read.schema(
        "certificate_details struct<subject_cn:string>, label string, final_score double, "
        "confidence string").json(f"{out}/detections")
    return found.select(F.col("certificate_details.subject_cn").alias("cn"), "label",
                        r6("final_score").alias("final_score"), "confidence")


@query
def watch_captures(spark: SparkSession, d: str) -> DataFrame:
    """The same detections by a stream that handles what is there and stops."""
    out = new_path(spark, "watched")
    watch_directory(spark, supplier_files(spark, d), f"{out}/detections", f"{out}/progress",
                    once=True).awaitTermination()
    found = spark.read.schema(
        "certificate_details struct<subject_cn:string>, label string, final_score double"
    ).json(f"{out}/detections")
    return found.select(F.col("certificate_details.subject_cn").alias("cn"), "label",
                        r6("final_score").alias("final_score"))


@query
def incremental_captures(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose bytes are new compared with those of the first source."""
    docs = table(spark, d, "documents")
    known = jobs.with_content_hash(
        docs.filter("source = 'src0'").select(F.lit(None).cast("binary").alias("content"), "text"))
    raw = docs.select("doc_id", "source", F.lit(None).cast("binary").alias("content"), "text")
    return jobs.new_captures(raw, known.select("content_hash")).groupBy("source").agg(
        F.count("*").alias("new_documents"))


def grow(spark: SparkSession, d: str, root: str, chosen: Column, name: str) -> None:
    """One more file below benign/ or phishing/ for each chosen supplier."""
    write_files(supplier_dumps(spark, d).filter(chosen).repartition(file_tasks(spark, d), "k"), root, name)


@query
def incremental_preprocess(spark: SparkSession, d: str) -> DataFrame:
    """Three runs over a folder: some captures, then others and copies of the first, then nothing new."""
    root, out = new_path(spark, "growing"), new_path(spark, "incremental")
    counts = []
    for run, parts in enumerate(([F.col("k") % 3 != 0], [F.col("k") % 3 == 0, F.col("k") % 5 == 1], [])):
        for i, chosen in enumerate(parts):
            grow(spark, d, root, chosen, f"run{run}-{i}")
        counts.append(staged(jobs.preprocess_new(spark, root, out).withColumn("run", F.lit(run)), "run-counts"))
    return counts[0].union(counts[1]).union(counts[2]).select(F.col("run").cast("bigint").alias("run"), "new_files", "new_contents")


@query
def incremental_features(spark: SparkSession, d: str) -> DataFrame:
    """Features after two runs are those of one run over everything, copies counted."""
    root, out = new_path(spark, "growing"), new_path(spark, "incremental")
    for run, chosen in enumerate((F.col("k") % 3 != 0, (F.col("k") % 3 == 0) | (F.col("k") % 5 == 1))):
        grow(spark, d, root, chosen, f"run{run}")
        jobs.preprocess_new(spark, root, out)
    rows = jobs.content_features(spark, out)
    return rows.select(F.col("subject")["CN"].alias("cn"), "label", "n_files", F.col("features.has_url").alias("has_url"),
                       r6("features.issuer_frequency").alias("issuer_frequency"))


@query
def watch_captures_once(spark: SparkSession, d: str) -> DataFrame:
    """A stream, stopped and started again, that is given every capture twice and some a third time."""
    root, out = new_path(spark, "growing"), new_path(spark, "watched")
    for run, chosen in enumerate((F.lit(True), F.lit(True), F.col("k") % 2 == 0)):
        grow(spark, d, root, chosen, f"run{run}")
        watch_directory(spark, root, f"{out}/detections", f"{out}/progress", once=True, once_within="7 days").awaitTermination()
    found = spark.read.schema(
        "certificate_details struct<subject_cn:string>, label string, final_score double").json(f"{out}/detections")
    return found.select(F.col("certificate_details.subject_cn").alias("cn"), "label",
                        r6("final_score").alias("final_score"))


# --- sampling


@query
def sample_labels(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "labels").select("doc_id", F.col("toxic").cast("bigint").alias("toxic"))
    return sample_per_class(rows, "toxic", "doc_id", 40)


@query
def hash_split(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", split_name("doc_id").alias("split"))


# --- parsing


@query
def parse_text_fields(spark: SparkSession, d: str) -> DataFrame:
    p = parsed_dumps(spark, d)
    return p.select(
        "k", "file_name", "label", F.col("subject")["CN"].alias("cn"),
        F.col("issuer")["CN"].alias("issuer_cn"), F.col("pubkey_bits").cast("bigint").alias("bits"),
        "pubkey_type", "signature_algorithm", F.col("chain_length").cast("bigint").alias("chain"),
        F.size("parse_warnings").cast("bigint").alias("warnings"))


@query
def parse_dn(spark: SparkSession, d: str) -> DataFrame:
    p = parsed_dumps(spark, d)
    return p.select("k", F.inline(sorted_entries(F.col("subject"))))


@query
def validity_days(spark: SparkSession, d: str) -> DataFrame:
    p = parsed_dumps(spark, d)
    return p.select(
        "k", F.col("validity_days").cast("bigint").alias("days"),
        F.unix_seconds("not_before_ts").alias("starts"), F.unix_seconds("not_after_ts").alias("ends"))


@query
def handshake(spark: SparkSession, d: str) -> DataFrame:
    return parsed_dumps(spark, d).select("k", "handshake.*")


def _der_fields(p: DataFrame) -> DataFrame:
    return p.select(
        F.col("path").cast("bigint").alias("k"), F.try_element_at("subject", F.lit("CN")).alias("cn"),
        F.col("subject")["O"].alias("org"), F.col("subject")["C"].alias("country"),
        F.col("issuer")["CN"].alias("issuer_cn"), joined("san").alias("san"), "not_before", "not_after",
        F.col("validity_days").cast("bigint").alias("days"), "pubkey_type",
        F.col("pubkey_bits").cast("bigint").alias("bits"), "signature_algorithm",
        F.col("chain_length").cast("bigint").alias("chain"),
        F.size("parse_warnings").cast("bigint").alias("warnings"))


@query
def x509_decode(spark: SparkSession, d: str) -> DataFrame:
    raw = cert_ders(spark, d).select(
        F.col("k").cast("string").alias("path"), F.lit("cert.der").alias("file_name"), "label",
        file_type(F.col("der")).alias("file_type"), F.lit(None).cast("string").alias("text"),
        F.col("der").alias("content"))
    return _der_fields(parse(raw))


@query
def pem_decode(spark: SparkSession, d: str) -> DataFrame:
    """The same certificates as PEM, every second one with an issuer block behind it."""
    block = F.concat(F.lit("-----BEGIN CERTIFICATE-----\n"), F.base64("der"),
                     F.lit("\n-----END CERTIFICATE-----\n"))
    text = F.when(F.col("k") % 2 == 0, F.concat(block, block)).otherwise(block)
    raw = cert_ders(spark, d).withColumn("text", text).select(
        F.col("k").cast("string").alias("path"), F.lit("cert.pem").alias("file_name"), "label",
        file_type(F.col("text").cast("binary")).alias("file_type"), "text")
    return _der_fields(parse(raw))


# --- features


@query
def structural(spark: SparkSession, d: str) -> DataFrame:
    return parsed_dumps(spark, d).select(
        "k", *[c.cast("bigint").alias(n) for n, c in ft.structural().items()])


@query
def temporal(spark: SparkSession, d: str) -> DataFrame:
    return parsed_dumps(spark, d).select(
        "k", *[c.cast("bigint").alias(n) for n, c in ft.temporal().items()])


@query
def lexical(spark: SparkSession, d: str) -> DataFrame:
    columns = ft.lexical()
    return with_text_steps(documents(spark, d), "text").select("doc_id", *[
        (r6(c) if n.endswith("ratio") else c.cast("bigint")).alias(n)
        for n, c in columns.items() if n != "entropy"])


@query
def entropy(spark: SparkSession, d: str) -> DataFrame:
    rows = with_text_steps(documents(spark, d), "text")
    return rows.select("doc_id", r6(ft.lexical()["entropy"]).alias("entropy"))


@query
def keywords_urls_ips(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).select(F.lit("document").alias("origin"), F.col("doc_id").alias("id"), "text")
    urls = table(spark, d, "pages").select(F.lit("url"), "page_id", "url")
    rows = with_text_steps(docs.union(urls), "text")
    return rows.select("origin", "id", *[
        c.cast("bigint").alias(n) for n, c in ft.statistical().items()])


@query
def identity(spark: SparkSession, d: str) -> DataFrame:
    rows = ft.add_helpers(parsed_dumps(spark, d))
    columns = ft.identity()
    return rows.select("k", *[
        (joined(c) if n == "brand_exact" else r6(c) if n in (
            "subject_cn_digit_ratio", "max_brand_similarity") else c.cast("bigint")).alias(n)
        for n, c in columns.items()])


@query
def host_brand_distance(spark: SparkSession, d: str) -> DataFrame:
    """Nearest brand of the first label of every page's host, whatever the distance."""
    rows = table(spark, d, "pages").select(
        "page_id", F.lower(F.regexp_extract("url", r"https?://([^./]+)", 1)).alias("name"))
    brands = F.array(*map(F.lit, RiskConfig().brands))
    best = F.array_max(F.transform(brands, lambda b: F.struct(
        (1 - F.levenshtein("name", b) / F.greatest(F.length("name"), F.length(b))).alias("s"),
        b.alias("b"))))
    return rows.withColumn("_best", best).select(
        "page_id", "name", F.col("_best.b").alias("brand"), r6("_best.s").alias("similarity"))


@query
def issuer_frequency(spark: SparkSession, d: str) -> DataFrame:
    parsed = parsed_dumps(spark, d)
    rows = add_issuer_frequency(parsed, fit_issuer_frequencies(parsed))
    return rows.select("k", r6("issuer_frequency").alias("issuer_frequency"))


# --- rules and ensemble


@query
def rules_score(spark: SparkSession, d: str) -> DataFrame:
    return ruled_dumps(spark, d).select(
        "k", r6("rules.score").alias("score"), joined("rules.triggered_rules").alias("triggered"),
        F.col("rules.rule_count").cast("bigint").alias("rule_count"))


@query
def rule_reasons(spark: SparkSession, d: str) -> DataFrame:
    return ruled_dumps(spark, d).select("k", joined("rules.reasons").alias("reasons"))


@query
def rule_hit_counts(spark: SparkSession, d: str) -> DataFrame:
    return rule_hits(ruled_dumps(spark, d)).select(
        F.col("position").cast("bigint").alias("position"), "rule", "weight", "hits")


@query
def ensemble(spark: SparkSession, d: str) -> DataFrame:
    v = verdicts(spark, d)
    return v.select(
        "k", r6("final_score").alias("final_score"), "label", "confidence",
        r6("method_scores.rules.score").alias("rules"), r6("method_scores.ml.score").alias("ml"),
        r6("method_scores.llm.score").alias("llm"), F.col("certificate_details.subject_cn").alias("subject_cn"),
        F.col("certificate_details.issuer").alias("issuer"),
        F.size("certificate_details.san_entries").cast("bigint").alias("sans"))


@query
def ensemble_reasons(spark: SparkSession, d: str) -> DataFrame:
    return verdicts(spark, d).select("k", joined("combined_reasons").alias("reasons"))


@query
def threshold_counts(spark: SparkSession, d: str) -> DataFrame:
    return count_at_threshold(verdicts(spark, d), 0.6)


# --- redaction


@query
def redact_text(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).select(
        "doc_id", F.md5(redact.redact_text(F.col("text"))).alias("text_md5"))


@query
def redact_certificates(spark: SparkSession, d: str) -> DataFrame:
    rows = redact.redact_certificates(parsed_dumps(spark, d))

    def count(mask: str) -> Column:
        return F.regexp_count("raw_text", F.lit(rf"\[{mask}\]")).cast("bigint")

    return rows.select("k", count("REDACTED_IP").alias("ips"), count("REDACTED_EMAIL").alias("emails"),
                       F.col("subject")["O"].alias("org"))


# --- metrics


def labelled_documents(spark: SparkSession, d: str) -> DataFrame:
    """Quality label against a score made of the text length, with many ties."""
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    rows = table(spark, d, "labels").join(docs, "doc_id")
    score = F.round(F.least(F.col("n_chars") / 4000, F.lit(1.0)), 2)
    return mt.scored(rows, F.col("quality"), score >= 0.25, score, "doc_id")


@query
def confusion(spark: SparkSession, d: str) -> DataFrame:
    return mt.confusion(labelled_documents(spark, d))


@query
def basic_metrics(spark: SparkSession, d: str) -> DataFrame:
    m = mt.basic_metrics(labelled_documents(spark, d))
    return m.select(*[r6(c).alias(c) for c in (
        "accuracy", "precision", "recall", "f1_score", "false_positive_rate",
        "false_negative_rate")], "total_samples", "positive_samples", "negative_samples")


@query
def class_report(spark: SparkSession, d: str) -> DataFrame:
    return mt.class_report(labelled_documents(spark, d)).select(
        "class", r6("precision").alias("precision"), r6("recall").alias("recall"),
        r6("f1_score").alias("f1_score"), "support")


@query
def ranking_metrics(spark: SparkSession, d: str) -> DataFrame:
    return mt.ranking_metrics(labelled_documents(spark, d)).select(
        r6("roc_auc").alias("roc_auc"), r6("pr_auc").alias("pr_auc"))


@query
def threshold_sweep(spark: SparkSession, d: str) -> DataFrame:
    return mt.threshold_sweep(labelled_documents(spark, d)).select(
        "threshold", *[r6(c).alias(c) for c in ("precision", "recall", "f1", "accuracy")])


@query
def report_summary(spark: SparkSession, d: str) -> DataFrame:
    return mt.report_summary(labelled_documents(spark, d))


def method_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = scored_dumps(spark, d).select(
        "k", mt.label_code(F.col("label")).alias("y_true"), F.col("rules.score").alias("rules"),
        F.coalesce("ml.score", F.lit(0.5)).alias("ml"), llm_score(F.col("llm")).alias("llm"))
    # Read several times below.
    return staged(rows, "method-scores")


@query
def method_comparison(spark: SparkSession, d: str) -> DataFrame:
    rows = method_rows(spark, d)
    final = F.round(0.25 * F.col("rules") + 0.35 * F.col("ml") + 0.4 * F.col("llm"), 9)
    m = mt.compare_methods(rows, {
        "rules": F.round("rules", 9), "ml": F.col("ml"), "llm": F.col("llm"), "ensemble": final})
    return m.select("method", *[r6(c).alias(c) for c in (
        "accuracy", "precision", "recall", "f1_score", "roc_auc", "pr_auc")])


@query
def weight_search_fine(spark: SparkSession, d: str) -> DataFrame:
    """The best weights of a grid of hundredths: 5,151 points."""
    m = mt.weight_search(method_rows(spark, d), F.col("rules"), F.col("ml"), F.col("llm"), 0.01)
    best = m.groupBy(r6("f1_score").alias("f1_score"), r6("accuracy").alias("accuracy")).agg(F.count("*").alias("points"))
    return best.orderBy(F.desc("f1_score"), F.desc("accuracy")).limit(20)


@query
def weight_search(spark: SparkSession, d: str) -> DataFrame:
    m = mt.weight_search(
        method_rows(spark, d), F.col("rules"), F.col("ml"), F.col("llm"))
    return m.select(*[F.round(w, 1).alias(w) for w in ("w_rules", "w_ml", "w_llm")],
                    r6("f1_score").alias("f1_score"), r6("accuracy").alias("accuracy"))


# --- prompts and answers


@query
def prompt_build(spark: SparkSession, d: str) -> DataFrame:
    p = parsed_dumps(spark, d).withColumn("prompt", prompting.build_prompt(prompting.summary()))
    shown = F.regexp_extract("prompt", r"(?s)certificate:\n(.*)\n\nThe verdict as JSON, nothing else:$", 1)

    def field(path: str) -> Column:
        return F.get_json_object("shown", path)

    return p.withColumn("shown", shown).select(
        "k", field("$.subject.CN").alias("cn"), field("$.issuer.CN").alias("issuer_cn"),
        field("$.validity_days").cast("bigint").alias("days"),
        field("$.pubkey_bits").cast("bigint").alias("bits"), field("$.file_name").alias("file_name"),
        F.contains("prompt", F.lit("Already judged:")).alias("has_examples"))


def answers(spark: SparkSession, d: str) -> DataFrame:
    """Model answers of seven shapes, made around the conversation texts."""
    c = table(spark, d, "conversations")
    kind = (F.col("conv_id") + F.col("turn")) % 7
    label = F.when(F.col("turn") % 2 == 0, "phishing").otherwise("benign")
    confidence = F.round((F.col("conv_id") % 100) / 100, 2)
    whole = F.to_json(F.struct(
        label.alias("label"), confidence.alias("confidence"), F.col("text").alias("reasoning"),
        F.array(F.lit("one"), F.lit("two")).alias("red_flags"),
        F.array().cast("array<string>").alias("benign_signals")))
    loud = F.to_json(F.struct(label.alias("label"), F.lit("1.7").alias("confidence")))
    fields = F.concat(
        F.lit('{"label": "'), label, F.lit('", "confidence": '), confidence.cast("string"),
        F.lit(', "reasoning": "plain words", "red_flags": ['))
    return c.select("conv_id", "turn", "text", F.when(kind == 0, whole)
                    .when(kind == 1, F.concat(F.lit("Here it is:\n```json\n"), whole, F.lit("\n```\n")))
                    .when(kind == 2, F.concat(F.lit("I think "), whole, F.lit(" is right.")))
                    .when(kind == 3, fields)
                    .when(kind == 4, F.col("text"))
                    .when(kind == 5, loud)
                    .otherwise(F.lit('["phishing"]')).alias("raw_response"))


@query
def response_parse(spark: SparkSession, d: str) -> DataFrame:
    rows = prompting.parse_responses(answers(spark, d))
    return rows.select(
        "conv_id", "turn", F.col("llm.label").alias("label"), r6("llm.confidence").alias("confidence"),
        F.md5("llm.reasoning").alias("reasoning_md5"), F.size("llm.red_flags").cast("bigint").alias("flags"),
        F.col("llm.parse_error").alias("parse_error"))


def repeated_certificates(spark: SparkSession, d: str) -> DataFrame:
    """Certificates of which many are equal: one per order, told apart by few fields."""
    rows = properties(spark, d)
    text = F.lit(None).cast("string")
    return rows.select(
        "k", F.col("k").cast("string").alias("path"), F.lit("f").alias("file_name"),
        F.create_map(F.lit("CN"), F.col("ca"), F.lit("C"), F.col("n_name")).alias("subject"),
        F.create_map(F.lit("CN"), F.col("ca")).alias("issuer"),
        F.array().cast("array<string>").alias("san"),
        F.year("o_orderdate").cast("string").alias("not_before"), text.alias("not_after"),
        F.lit(None).cast("int").alias("validity_days"), text.alias("pubkey_type"),
        F.lit(None).cast("int").alias("pubkey_bits"), text.alias("signature_algorithm"),
        F.lit(0).alias("chain_length"), F.lit("").alias("raw_text"))


@query
def response_dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = prompting.distinct_certificates(repeated_certificates(spark, d))
    return rows.select(
        F.col("cert.subject")["CN"].alias("cn"), F.col("cert.subject")["C"].alias("country"),
        F.col("cert.not_before").alias("year"), "n_copies")


def stand_in_model(prompt: str) -> str:
    shown = prompt.rsplit("certificate:\n", 1)[-1]
    label = "benign" if "DigiCert" in shown else "phishing"
    return f'{{"label": "{label}", "confidence": 0.75, "reasoning": "", "red_flags": []}}'


@query
def response_scoring(spark: SparkSession, d: str) -> DataFrame:
    """A stand-in model asked once per distinct certificate, its verdict on every copy."""
    rows = prompting.add_llm(repeated_certificates(spark, d), stand_in_model, model="stand-in")
    return rows.select("k", F.col("llm.label").alias("label"), F.col("llm.model").alias("model"),
                       r6(llm_score(F.col("llm"))).alias("score"))


@query
def response_resume(spark: SparkSession, d: str) -> DataFrame:
    """Answers kept by earlier runs, some twice and some failed, are used; only the other keys are asked, in waves."""
    path = new_path(spark, "answers")
    rows = repeated_certificates(spark, d)
    keys = prompting.distinct_certificates(rows).select("cache_key", F.col("cert.subject")["C"].alias("country"))
    kept = keys.filter(F.col("country") < "K").select(
        "cache_key", F.lit("earlier").alias("model"),
        F.when(F.col("country") >= "E", F.lit('{"label": "benign", "confidence": 0.5}')).alias("raw_response"),
        F.when(F.col("country") < "E", F.lit("down")).alias("error"))
    again = keys.filter(F.col("country") < "B").select(
        "cache_key", F.lit("later").alias("model"), F.lit('{"label": "phishing", "confidence": 1}').alias("raw_response"),
        F.lit(None).cast("string").alias("error"))
    kept.union(kept).union(again).write.parquet(path)
    found = prompting.add_llm(rows, stand_in_model, path, model="stand-in", wave_rows=200)
    return found.select("k", F.col("llm.label").alias("label"), F.col("llm.model").alias("model"),
                        F.col("llm.error").alias("error"), r6(llm_score(F.col("llm"))).alias("score"))


# --- classifier and retrieval


def document_terms(spark: SparkSession, d: str) -> DataFrame:
    return with_words(documents(spark, d).select(
        "doc_id", strip_accents(F.lower("text")).alias("x_text")))


@query
def term_counts(spark: SparkSession, d: str) -> DataFrame:
    return term_stats(document_terms(spark, d), "x_words")


@query
def ngram_stats(spark: SparkSession, d: str) -> DataFrame:
    """Vocabulary candidates by n-gram length: terms of two or more documents."""
    rows = gram_stats(document_terms(spark, d), "x_words", 3).filter("documents >= 2")
    return rows.groupBy(F.size(F.split("term", " ")).cast("bigint").alias("words")).agg(
        F.count("*").alias("terms"), F.sum("occurrences").alias("occurrences"),
        F.max("documents").alias("max_documents"))


@query
def top_terms(spark: SparkSession, d: str) -> DataFrame:
    """The 300 terms most frequent in documents of one to three words, where many are equally frequent."""
    rows = document_terms(spark, d)
    n = table(spark, d, "documents").count()
    return gram_vocabulary(rows, "x_words", n, 300, 2.0, 0.9).select(
        F.col("position").cast("bigint").alias("position"), "term", "occurrences", "documents", r6("idf").alias("idf"))


@query
def tfidf_weights(spark: SparkSession, d: str) -> DataFrame:
    """Weight of every vocabulary term in every document that holds it."""
    rows = document_terms(spark, d)
    words = gram_vocabulary(rows, "x_words", table(spark, d, "documents").count(), 300, 2.0, 0.9)
    return weigh(rows, "doc_id", "x_words", words, 3).select("doc_id", "term", "n", r6("weight").alias("weight"))


#: Numbers of the small model, which the SQL knows without parsing.
FITTED = ("validity_days", "pubkey_bits", "chain_length", "subject_has_punycode", "max_brand_similarity",
          "is_self_signed", "has_url", "suspicious_keyword_count", "issuer_frequency")


def numbered_dumps(spark: SparkSession, d: str) -> DataFrame:
    """``k, y`` and the scaled numbers of every capture, staged."""
    rows = ft.add_fitted_features(parsed_dumps(spark, d), ("label", "k"), FITTED).select(
        "k", F.when(F.col("label") == "phishing", 1).otherwise(0).alias("y"),
        *[F.coalesce(F.col(f"features.{n}"), F.lit(0)).cast("double").alias(n) for n in FITTED])
    rows = staged(rows, "numbers")
    return staged(numeric_scaling(rows, FITTED).transform(rows).select(
        "k", "y", *[F.col(f"z_{n}").alias(n) for n in FITTED]), "scaled-numbers")


def fitted_dumps(spark: SparkSession, d: str) -> tuple[DataFrame, LogisticFit]:
    rows = numbered_dumps(spark, d)
    return rows, fit_logistic(rows, list(FITTED), "y")


@query
def scaled_numbers(spark: SparkSession, d: str) -> DataFrame:
    return numbered_dumps(spark, d).select("k", *[r6(n).alias(n) for n in FITTED])


@query
def logistic_fit(spark: SparkSession, d: str) -> DataFrame:
    """Intercept and coefficients of the balanced, penalised model at its optimum."""
    rows, found = fitted_dumps(spark, d)
    names = F.array(F.lit("intercept"), *map(F.lit, found.columns))
    weights = F.array(*[F.lit(w) for w in (found.intercept, *found.coefficients)])
    total = rows.agg(F.count("*").alias("samples"), F.sum("y").alias("positive_samples"))
    return total.select(F.inline(F.arrays_zip(names.alias("feature"), weights.alias("coefficient"))),
                        "samples", "positive_samples").withColumn("coefficient", r6("coefficient"))


@query
def predicted_labels(spark: SparkSession, d: str) -> DataFrame:
    rows, found = fitted_dumps(spark, d)
    return rows.withColumn("p", found.probability()).select(
        "k", r6("p").alias("probability"), (F.col("p") > 0.5).cast("bigint").alias("label"))


@query
def train_and_evaluate(spark: SparkSession, d: str) -> DataFrame:
    """Classifier on labelled documents; its metrics on the rows it was fitted on."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    none = F.lit(None).cast("string")
    empty_map = F.create_map().cast("map<string,string>")
    empty = F.array().cast("array<string>")
    raw = table(spark, d, "labels").join(docs, "doc_id").select(
        F.col("doc_id").cast("string").alias("path"), F.lit("doc").alias("file_name"),
        F.lit("unknown").alias("label"), none.alias("pem"), empty_map.alias("subject"),
        empty_map.alias("issuer"), empty.alias("san"), F.lit(None).cast("int").alias("validity_days"),
        none.alias("pubkey_type"), F.lit(None).cast("int").alias("pubkey_bits"),
        none.alias("signature_algorithm"), F.col("text").alias("raw_text"), F.lit(0).alias("chain_length"),
        empty.alias("parse_warnings"), F.col("toxic").alias("y_true"))
    rows = staged(ft.add_features(raw), "training-rows")
    model = train(rows)
    predicted = staged(mt.scored(
        model.predict(rows), F.col("y_true"), F.col("ml_label"), F.col("ml.score")), "predicted")
    return mt.calculate_metrics(predicted).select(
        "total_samples", "positive_samples", r6("accuracy").alias("accuracy"),
        r6("roc_auc").alias("roc_auc"), r6("pr_auc").alias("pr_auc"))


@query
def similar_vectors(spark: SparkSession, d: str) -> DataFrame:
    """The five stored vectors nearest to the mean of each class."""
    e = table(spark, d, "embeddings")
    means = (e.select("label", F.posexplode("embedding").alias("i", "x"))
             .groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
             .groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("c"))
             .select("label", F.transform("c", lambda s: s["m"]).alias("embedding")))
    top = similar_top_k(e, means, "vec_id", "label", "embedding", 5)
    return top.select("label", F.col("rank").cast("bigint").alias("rank"), "vec_id",
                      F.round("similarity", 5).alias("similarity"))
