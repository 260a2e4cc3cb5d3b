"""Left joins to tables with one row per key, safe against size and skew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certrisk.session import staged

#: A table is sent to all tasks only if it stays below both.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 64 << 20
#: A key is hot if it has at least this share of the rows; so there are at most 10,000 hot keys.
HOT_SHARE = 1e-4
#: Keys the sketch of frequent keys tells apart; it errs by a share of about two over this.
TRACKED = 1 << 16


def is_small(table: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a staged table may be broadcast: rows counted first, then bytes of the values as text."""
    if table.count() > rows:
        return False
    return (table.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0] or 0) <= size


def broadcast_if_small(table: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring. Meant for staged tables, where that is cheap."""
    return F.broadcast(table) if is_small(table, rows, size) else table


def frequent_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """``key`` of at least about a ``share`` of the rows, by a sketch: one aggregate, no row leaves its task."""
    top = df.select(F.col(key).alias("_key")).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(_key, {int(1 / share)}, {TRACKED})").alias("top"))
    return top.select("n", F.inline("top")).filter((F.col("count") >= F.col("n") * share) & F.col("item").isNotNull()).select(
        F.col("item").alias(key))


def lookup(
    df: DataFrame, table: DataFrame, key: str, weight: str, spread_by: str,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add the columns of ``table`` to the rows of ``df`` with the same ``key``, a string.

    ``table`` is staged and holds one row per key; ``weight`` counts the rows of
    each key where the table was made. A small table is broadcast. Beyond that, only hot keys are: those with at least one in
    10,000 rows of ``df``, whether ``table`` holds them or not, found by a sketch in a pass over the key alone, and
    those with as large a share of the weights. The others are joined by shuffle. Rows with a hot key, served by the broadcast,
    and rows without a key go through that shuffle under a key made of ``spread_by``, a column with many values, so they
    spread evenly and match nothing.
    """
    values = [c for c in table.columns if c != key]
    if is_small(table, broadcast_rows):
        return df.join(F.broadcast(table), key, "left")
    total = table.agg(F.sum(weight)).first()[0]
    hot_keys = frequent_keys(df, key).union(table.filter(F.col(weight) >= total * HOT_SHARE).select(key)).distinct()
    hot = staged(hot_keys.join(table, key, "left").select(
        F.col(key), F.struct(*values).alias("_hot"), F.lit(True).alias("_is_hot")), "hot-keys")
    rows = df.join(F.broadcast(hot), key, "left")
    spread = F.concat(F.lit("\x00"), F.xxhash64(spread_by).cast("string"))
    rows = rows.withColumn("_join_key", F.when(F.col(key).isNull() | F.col("_is_hot"), spread).otherwise(F.col(key)))
    cold = table.select(F.col(key).alias("_cold_key"), F.struct(*values).alias("_cold"))
    rows = rows.join(cold, F.col("_join_key") == F.col("_cold_key"), "left")
    picked = F.coalesce("_hot", "_cold")
    return rows.select(*df.columns, *[picked[v].alias(v) for v in values])
