"""Ranks and top-k over whole tables, exact, without sorting a table or a large group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from certrisk.operators.lookup import broadcast_if_small
from certrisk.session import staged


def numbered(rows: DataFrame, by: str, order: list[Column], keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """Number rows within ``by`` along ``order``, in two parts to be added up.

    Returns the rows with ``part`` (their range of the order) and ``place``, and for each (``by``, ``part``) the
    ``shift`` that, added to ``place``, gives the number from 0. One shuffle by ranges of (``by``, ``order``); ``order``
    must end with a unique column, so that a group holding most of the rows is split over many ranges.
    """
    group = F.col(by).asc_nulls_last()
    placed = staged(
        rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("place", 33)).select(by, *keep, "part", "place"), "numbered")
    counts = placed.groupBy(by, "part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = F.sum("n").over(Window.partitionBy(by).orderBy("part")) - F.col("n")
    return placed, staged(counts.select(by, "part", (before - F.col("first")).alias("shift")), "number-shifts")


def first_rows(rows: DataFrame, most: int, amount: str, tie: str) -> DataFrame:
    """The ``most`` rows of greatest ``amount`` (a positive whole number), ties by ``tie``, with ``position`` from 0.

    Rows are counted by the binary length of their amount, at most 64 counts, which names the length that holds the
    last row wanted; only rows of that length or a greater one are put in order. ``tie`` is unique.
    """
    length = F.length(F.bin(F.col(amount)))
    counts = sorted(((r["_l"], r["n"]) for r in rows.groupBy(length.alias("_l")).agg(F.count("*").alias("n")).collect()), reverse=True)
    least, reached = 1, 0
    for bits, n in counts:
        least, reached = bits, reached + n
        if reached >= most:
            break
    near = rows.filter(F.col(amount) >= F.lit(1 << (least - 1))).withColumn("_all", F.lit(0))
    placed, shifts = numbered(near, "_all", [F.col(amount).desc(), F.col(tie)], rows.columns)
    at = F.col("place") + F.col("shift")
    return placed.join(broadcast_if_small(shifts), ["_all", "part"]).withColumn("position", at).filter(
        F.col("position") < most).select(*rows.columns, "position")
