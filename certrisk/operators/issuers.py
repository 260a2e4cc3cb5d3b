"""How common an issuer is in the training corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certrisk.functions.names import map_key
from certrisk.operators.lookup import BROADCAST_ROWS, lookup
from certrisk.session import staged


def with_issuer_key(df: DataFrame) -> DataFrame:
    return df.withColumn("issuer_key", map_key(F.col("issuer")))


def fit_issuer_frequencies(df: DataFrame, path: str | None = None) -> DataFrame:
    """``issuer_key, issuer_n, issuer_frequency``, staged (or written to ``path``).

    Counting is partially done before the shuffle, so a common issuer costs one
    row per task. Self-signed certificates make the table grow with the corpus.
    """
    return fit_keyed(with_issuer_key(df.select("issuer")), path)


def fit_keyed(df: DataFrame, path: str | None = None) -> DataFrame:
    """The issuer table of rows with ``issuer_key``."""
    counts = staged(df.groupBy("issuer_key").agg(F.count("*").alias("issuer_n")), "issuer-counts")
    return frequencies_of(counts, path)


def frequencies_of(counts: DataFrame, path: str | None = None) -> DataFrame:
    """The issuer table of staged counts ``issuer_key, issuer_n``."""
    total = counts.agg(F.sum("issuer_n")).first()[0]
    return staged(
        counts.withColumn("issuer_frequency", F.col("issuer_n") / F.lit(total or 1)),
        "issuer-frequency", path)


def add_issuer_frequency(
    df: DataFrame, frequencies: DataFrame | None, broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add ``issuer_frequency``: 0 for an unseen issuer, NULL when nothing was fitted."""
    if frequencies is None:
        return df.withColumn("issuer_frequency", F.lit(None).cast("double"))
    return add_keyed(with_issuer_key(df), frequencies, broadcast_rows)


def add_keyed(df: DataFrame, frequencies: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add ``issuer_frequency`` to rows with ``issuer_key``, which goes."""
    table = frequencies.select("issuer_key", "issuer_n", "issuer_frequency")
    joined = lookup(df, table, "issuer_key", "issuer_n", "path", broadcast_rows)
    return joined.drop("issuer_key", "issuer_n").withColumn(
        "issuer_frequency", F.coalesce("issuer_frequency", F.lit(0.0)))
