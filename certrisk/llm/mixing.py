"""Mixing sources to target weights by systematic sampling.

Every source gets a target number of words: its share by weight of all words, but never more than
``most`` times what it has; what is cut off is shared out again by weight. A document's expected
copies are its source's target over its source's words. Within a source, documents are put in order
of size (ties by a seeded hash), expected copies are summed along that order, one random offset is
added, and a document is taken once for each whole number that its stretch of the sum crosses. Neighbours
are of like size, so the words taken miss the target by no more than about one of the largest documents.

All expected copies of a source are equal, so the prefix sum is a rank times a fraction. It is kept
as whole numbers (decimals of 38 digits), so no rounding moves a crossing and reruns agree. Ranks come
from one shuffle by ranges of (source, size, hash, row), a unique key, which also splits a source that holds
most of the rows; each range then needs only the number of its source's rows in ranges before it.

Defined results: a null text has no words and size 0; a source without words has target 0 and a document
without words takes 0; a null source is a source of its own, after all others; a null ``doc_id`` stays null;
repeated rows are documents of their own; an empty table gives no rows; other columns
are carried by ``mixture`` and ignored elsewhere, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certrisk.operators.lookup import broadcast_if_small
from certrisk.operators.ranking import numbered
from certrisk.session import staged

WORD = r"[^\x20\x09-\x0D]+"
#: Steps of the random offset, a power of 16.
STEPS = 1 << 20


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """``source, source_size, target, up, down``: the target of each source, and expected copies as a fraction.

    ``sizes`` holds ``source, source_size`` once per source. A source whose share passes its limit stops there and the
    rest is shared again, until none does; each round is one aggregate, of which only totals reach the driver.
    """
    placed, shifts = numbered(sizes.withColumn("none", F.lit(0)), "none",
                              [F.col("source").asc_nulls_last()], ["source", "source_size"])
    number = (F.col("place") + F.col("shift")) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (number + 1).cast("int"))
    table = staged(placed.join(broadcast_if_small(shifts), ["none", "part"]).select(
        "source", F.col("source_size").cast("decimal(38,0)").alias("size"), weight.cast("decimal(38,0)").alias("weight")), "sources")
    limit = F.col("size") * most
    held, shared, sharers = F.lit(False), None, None
    total = table.agg(F.sum("size")).first()[0] or 0
    stopped = -1
    while True:
        n, words, left = table.agg(
            F.count(F.when(held, 1)), F.sum(F.when(held, limit)), F.sum(F.when(~held, F.col("weight")))).first()
        shared, sharers = int(total) - int(words or 0), int(left or 0)
        if n == stopped or not sharers:
            break
        stopped = n
        held = limit * F.lit(Decimal(sharers)) < F.col("weight") * F.lit(Decimal(shared))
    up = F.when(held, F.lit(Decimal(most))).otherwise(F.col("weight") * F.lit(Decimal(shared)))
    down = F.when(held, F.lit(Decimal(1))).otherwise(F.greatest(F.col("size"), F.lit(Decimal(1))) * F.lit(Decimal(max(1, sharers))))
    target = F.when(held | (F.col("size") == 0), limit.cast("double")).otherwise(
        (F.col("weight") * F.lit(Decimal(shared))).cast("double") / float(max(1, sharers)))
    return staged(table.select("source", F.col("size").cast("long").alias("source_size"), target.alias("target"),
                               up.cast("decimal(38,0)").alias("up"), down.cast("decimal(38,0)").alias("down")), "targets")


def _sized(docs: DataFrame, source: str, doc_id: str, text: str) -> DataFrame:
    """``source, doc_id, size, row``, staged, so that a row keeps its number."""
    return staged(docs.select(F.col(source).cast("string").alias("source"), F.col(doc_id).alias("doc_id"),
                              n_words(text).alias("size"), F.monotonically_increasing_id().alias("row")), "sized")


def _taken(rows: DataFrame, weights: Sequence[int], most: int, seed: int) -> DataFrame:
    shares = targets(staged(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes"), weights, most)
    mark = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    placed, shifts = numbered(rows, "source", [F.col("size"), mark, F.col("doc_id"), F.col("row")], ["doc_id", "size", "row"])
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("of", F.lit("")))), 1, 5), 16, 10)
    same_source = F.col("source").eqNullSafe(F.col("of"))
    # One row per source and range, so at most as many as there are sources and ranges together.
    bounds = shifts.withColumnsRenamed({"source": "of", "part": "of_part"}).join(
        broadcast_if_small(shares), same_source).drop("source").withColumn("offset", offset.cast("decimal(38,0)"))
    bounds = broadcast_if_small(staged(bounds, "source-bounds"))

    def crossed(number: str) -> Column:
        """Whole numbers up to the prefix sum of the first ``number`` documents, offset included."""
        return F.expr(f"(CAST({number} AS DECIMAL(38,0)) * up * {STEPS} + offset * down) div (down * {STEPS})")

    counted = placed.join(bounds, same_source & (F.col("part") == F.col("of_part"))).withColumn("number", F.col("place") + F.col("shift"))
    return counted.select("doc_id", "source", "size", "source_size", "target", "row",
                          (crossed("number + 1") - crossed("number")).alias("copies"))


def taken(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3, seed: int = 13,
    source: str = "source", doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` of every document.

    ``weights`` go to the sources in code point order, null last, and repeat. No document is taken more than
    ``most`` times, rounded up.
    """
    return _taken(_sized(docs, source, doc_id, text), weights, most, seed).drop("row")


def mixture(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3, seed: int = 13,
    source: str = "source", doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The mix itself: every taken document with all its columns, once per copy.

    Texts are staged once with their row number, and shuffled once when the copies are joined to them.
    """
    kept = staged(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "mixed-documents")
    rows = kept.select(F.col(f"doc.`{source}`").cast("string").alias("source"), F.col(f"doc.`{doc_id}`").alias("doc_id"),
                       n_words(f"doc.`{text}`").alias("size"), "row")
    copies = _taken(rows, weights, most, seed).filter("copies > 0").select("row", "copies")
    return kept.join(copies, "row").select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("doc.*")
