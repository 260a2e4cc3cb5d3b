"""Time the headline queries: one JSON line on standard output.

Every query is run to the end on whole tables (noop sink). A short warm-up at the
smallest scale loads the JVM and the Python workers first; nothing is cached.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from certrisk.plans.queries import QUERIES  # noqa: E402
from certrisk.session import local_session  # noqa: E402

HEADLINE = (
    "verdict_summary", "parse_text_fields", "x509_decode", "lexical", "entropy", "identity",
    "issuer_frequency", "rules_score", "ensemble", "redact_text", "ranking_metrics",
    "threshold_sweep", "method_comparison", "sample_labels", "response_scoring", "response_parse",
    "ngram_stats", "similar_vectors", "sniff_type", "jobs_batch_infer")
WARM_UP = "/root/testdata/sf0.001"


def run(spark, name: str, sf_dir: str) -> float:
    start = time.time()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.time() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    if os.path.isdir(WARM_UP):
        for name in ("verdict_summary", "x509_decode"):
            run(spark, name, WARM_UP)
    times = {}
    for name in HEADLINE:
        times[name] = round(run(spark, name, sf_dir), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    captures = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cores": spark.sparkContext.defaultParallelism, "captures": captures,
        "captures_per_second": {
            "parse": round(captures / times["parse_text_fields"]),
            "x509": round(captures / times["x509_decode"]),
            "parse_features_rules_verdict": round(captures / times["verdict_summary"])},
    }), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
