"""Exact, reproducible samples and splits by hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from certrisk.config import DEFAULT
from certrisk.operators.lookup import broadcast_if_small
from certrisk.session import staged


def _digest(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}")))


def sample_per_class(df: DataFrame, by: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """The ``n`` rows of each class with the smallest hash of ``key``.

    A plain rank per class would sort a whole class in one task. Here the hashes
    are counted by their first four digits, which tells for each class the digit
    group holding the n-th row. Groups before it are taken as they are; only rows of that group,
    about one in 65,536, are ranked.
    """
    if n <= 0:
        return df.limit(0)
    rows = df.withColumn("_h", _digest(key, seed)).withColumn("_g", F.substring("_h", 1, 4))
    groups = rows.groupBy(by, "_g").agg(F.count("*").alias("_n"))
    running = F.sum("_n").over(Window.partitionBy(by).orderBy("_g"))
    cut = (groups.withColumn("_sum", running)
           .filter((F.col("_sum") >= n) & (F.col("_sum") - F.col("_n") < n))
           .select(F.col(by).alias("_by"), F.col("_g").alias("_cut"),
                   (n - (F.col("_sum") - F.col("_n"))).alias("_left")))
    cut = broadcast_if_small(staged(cut, "sample-cut"))
    joined = rows.join(cut, F.col(by).eqNullSafe(F.col("_by")), "left")
    before = joined.filter(F.col("_cut").isNull() | (F.col("_g") < F.col("_cut")))
    rank = F.row_number().over(Window.partitionBy(by, "_g").orderBy("_h", key))
    last = joined.filter(F.col("_g") == F.col("_cut")).withColumn("_rank", rank).filter(F.col("_rank") <= F.col("_left"))
    return before.select(*df.columns).unionByName(last.select(*df.columns))


def hash_unit(key: str, seed: int = 42) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone."""
    return F.conv(F.substring(_digest(key, seed), 1, 8), 16, 10).cast("double") / float(2**32)


def split_name(
    key: str, train: float = DEFAULT.train_fraction, validation: float = DEFAULT.validation_fraction,
    seed: int = DEFAULT.seed,
) -> Column:
    unit = hash_unit(key, seed)
    return (F.when(unit < train, "train")
            .when(unit < train + validation, "validation").otherwise("test"))
