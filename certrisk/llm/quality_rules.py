"""Quality rules whose cutoffs are chosen on labelled documents with a risk bound.

A rule rejects a document whose score is above the cutoff of its stratum. For every
stratum, rule and point of a fixed grid, the good documents that the point would reject are
counted. The point is safe when a binomial variable with the permitted rate would show so few
rejections with a probability of at most ``delta`` divided by the number of tests (all strata,
rules and points: Bonferroni). Each rule gets an equal share of the permitted rate
``alpha``, and its lowest safe point is the cutoff. So with probability ``1 - delta``, in every
stratum at once, at most ``alpha`` of the good documents are rejected. A stratum with too few
labels gets no cutoffs and rejects nothing.

DataFrame functions only. Scores and counts are kept per document; texts are not shuffled.

Defined results: a null or empty text has no words and fails the base rules; a null
stratum is a stratum of its own; rows with equal ``doc_id`` are judged each on its own;
several labels of one ``doc_id`` count once, as the lowest; an empty table gives no rows.
Further columns of the tables are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from certrisk.llm.common import unused
from certrisk.session import staged

WHITE = " \t\n\x0b\x0c\r"
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """Reject above a cutoff of ``score``; ``grid`` holds the cutoffs that are tried."""

    name: str
    score: str
    grid: tuple[float, ...]


def shares(low: float, points: int) -> tuple[float, ...]:
    """Geometric grid from ``low`` to 1."""
    return tuple(round(low ** (1 - i / (points - 1)), 6) for i in range(points))


RULES = (
    Rule("symbols", "n_symbols / nullif(word_chars, 0)", shares(0.002, 16)),
    Rule("duplicate_lines", "n_dup_lines / nullif(n_lines, 0)", shares(0.02, 16)),
    Rule("repeated_words", "n_repeat_words / nullif(n_words, 0)", shares(0.02, 16)),
    Rule("long_words", "word_chars / nullif(n_words, 0)",
         tuple(float(x) for x in (6, 7, 8, 9, 10, 12, 14, 16, 20, 25, 30, 40, 60, 80, 100, 200))),
)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts named in ``STATISTICS`` (long)."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    trimmed = F.btrim(body, F.lit(WHITE))
    no_words = F.array().cast("array<string>")
    solid = F.length(body)
    df = docs.withColumn("_words", F.when(trimmed == "", no_words).otherwise(
        F.split(trimmed, "[\\x20\\x09-\\x0D]+")))
    df = df.withColumn("_lines", F.filter(F.split(body, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    words = F.col("_words")
    # A window's hash stands for its three words.
    df = df.withColumn("_windows", F.when(F.size(words) < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
                    lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))))
    df = df.withColumn("_sorted", F.sort_array("_windows"))
    ordered = F.col("_sorted")
    repeats = F.exists(F.transform(ordered, lambda h, i: (i > 0) & (h == F.get(ordered, i - 1))), lambda x: x)
    # Only texts with a repeated window pay for sorting places along with the hashes.
    placed = F.when(repeats, F.sort_array(F.transform(
        "_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.withColumn("_placed", placed)
    pairs = F.col("_placed")
    twice = F.filter(
        F.transform(pairs, lambda p, k: F.struct(p["i"].alias("i"), (
            ((k > 0) & (F.get(pairs, k - 1)["h"] == p["h"]))
            | F.coalesce(F.get(pairs, k + 1)["h"] == p["h"], F.lit(False))).alias("twice"))),
        lambda p: p["twice"])
    covered = F.array_distinct(F.flatten(F.transform(
        twice, lambda p: F.array(p["i"], p["i"] + 1, p["i"] + 2))))
    return df.withColumns({
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": (solid - F.length(F.regexp_replace(body, "[#*$%&|<>]+", ""))).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.coalesce(F.size(covered), F.lit(0)).cast("long"),
    }).drop("_words", "_lines", "_windows", "_sorted", "_placed")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def permitted(n: Column, rate: float, level: Column) -> Column:
    """Largest number of rejections among ``n`` that the exact binomial test takes as
    proof of a rate below ``rate`` at ``level``; -1 when none is."""
    odds = F.lit(rate / (1 - rate))
    zero = F.struct((n * F.log(F.lit(1 - rate))).alias("log_term"), F.lit(0.0).alias("below"),
                    F.lit(-1).cast("long").alias("k"))

    def step(s: Column, i: Column) -> Column:
        below = s["below"] + F.exp(s["log_term"])
        following = s["log_term"] + F.log(F.greatest((n - i) / (i + 1), F.lit(1e-300))) + F.log(odds)
        return F.struct(following.alias("log_term"), below.alias("below"),
                        F.when(below <= level, i).otherwise(s["k"]).alias("k"))

    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.ceil(n * rate)), zero, step, lambda s: s["k"])


def fit_cutoffs(
    statistics: DataFrame, labels: DataFrame, stratum: str = "stratum", rules: tuple[Rule, ...] = RULES,
    alpha: float = 0.04, delta: float = 0.05, good: str = "quality = 1",
) -> DataFrame:
    """``stratum, rule, n_good, n_rejected, n_permitted, cutoff``: one row per stratum and rule.

    ``statistics`` has ``doc_id``, the stratum and ``STATISTICS``; ``labels`` has ``doc_id``
    and what ``good`` reads. ``cutoff`` is null where no point is safe.
    """
    good_ids = (labels.filter("doc_id IS NOT NULL").groupBy("doc_id")
                .agg(F.min(F.expr(good).cast("int")).alias("_good")).filter("_good = 1").select("doc_id"))
    scores = statistics.filter(~base_failed()).select(
        "doc_id", F.col(stratum).alias("stratum"), *[F.expr(r.score).alias(r.name) for r in rules])
    held = scores.join(good_ids, "doc_id", "left_semi")

    def points_below(rule: Rule) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, rule.grid)), lambda c: c < F.col(rule.name)))

    above = F.inline(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), points_below(r).alias("points")) for r in rules]))
    # As many rows as strata, rules and points.
    counts = staged(held.select("stratum", above).groupBy("stratum", "rule", "points").agg(
        F.count("*").alias("n")), "rule-counts")
    strata = counts.select("stratum").distinct().count()
    tests = max(1, strata) * sum(len(r.grid) for r in rules)
    totals = counts.groupBy("stratum", "rule").agg(F.sum("n").alias("n_good")).withColumn(
        "n_permitted", permitted(F.col("n_good"), alpha / len(rules), F.lit(delta / tests)))
    grid = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(i).alias("point"), F.lit(c).alias("at"))
        for r in rules for i, c in enumerate(r.grid)])
    tried = (totals.select("*", F.explode(F.filter(grid, lambda p: p["rule"] == F.col("rule"))).alias("p"))
             .select("stratum", "rule", "n_good", "n_permitted", "p.point", "p.at"))
    hits = counts.select(F.col("stratum").alias("_s"), F.col("rule").alias("_r"), "points", "n")
    rejected = (tried.join(hits, F.col("stratum").eqNullSafe(F.col("_s")) & (F.col("rule") == F.col("_r"))
                           & (F.col("points") > F.col("point")), "left")
                .groupBy("stratum", "rule", "n_good", "n_permitted", "at")
                .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rejected")))
    first = F.row_number().over(Window.partitionBy("stratum", "rule").orderBy(
        F.col("n_rejected") > F.col("n_permitted"), "at"))
    safe = F.col("n_rejected") <= F.col("n_permitted")
    return rejected.withColumn("_first", first).filter("_first = 1").select(
        "stratum", "rule", "n_good", "n_rejected", "n_permitted", F.when(safe, F.col("at")).alias("cutoff"))


def with_verdict(
    statistics: DataFrame, cutoffs: DataFrame, stratum: str = "stratum", rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Add ``base_failed``, ``rejected_by`` (rule names) and ``kept``."""
    # One row per stratum; a stratum exists only with labelled documents, and few are.
    wide = cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(
        F.struct("rule", "cutoff"))).alias("_cutoffs")).withColumnRenamed("stratum", "_stratum")
    out = statistics.join(F.broadcast(wide), F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    broken = F.filter(F.array(*[
        F.when(F.expr(r.score) > F.col("_cutoffs")[r.name], F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    return out.withColumns({"base_failed": base_failed(), "rejected_by": broken}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)).drop("_stratum", "_cutoffs")


def judged(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", rules: tuple[Rule, ...] = RULES,
    alpha: float = 0.04, delta: float = 0.05,
) -> DataFrame:
    """One row per document: ``doc_id, text_hash, stratum``, the counts, the failed rules and ``kept``."""
    narrow = with_statistics(docs.select(
        "doc_id", F.col(stratum).cast("string").alias("stratum"), "text")).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), "stratum", *STATISTICS)
    statistics = staged(narrow, "rule-statistics")
    cutoffs = staged(fit_cutoffs(statistics, labels, rules=rules, alpha=alpha, delta=delta), "rule-cutoffs")
    return with_verdict(statistics, cutoffs, rules=rules)


def kept_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    kept_id, kept_hash = unused(docs, "kept_id"), unused(docs, "kept_hash")
    kept = judged(docs, labels, **options).filter("kept").select(
        F.col("doc_id").alias(kept_id), F.col("text_hash").alias(kept_hash)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.xxhash64("text") == F.col(kept_hash))
    return docs.join(kept, same, "left_semi")
