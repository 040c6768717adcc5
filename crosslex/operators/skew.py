"""Joins that stay balanced when a few keys hold much of the rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot above 1/HOT_SHARE of the rows, so there are at most that many.
HOT_SHARE = 256
#: Parts that a hot key is split into.
SALTS = 64
#: Below this many rows a key is never hot.
MIN_ROWS = 1_000_000


def hot_keys(df: DataFrame, keys: list[str], share: int = HOT_SHARE,
             min_rows: int = MIN_ROWS) -> DataFrame:
    """Keys with more than 1/``share`` of the rows: at most ``share`` rows.

    The counts are exact, so every evaluation finds the same keys.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.where((F.col("_n") >= min_rows) & (F.col("_n") * share > total)).select(*keys)


def salted_join(big: DataFrame, other: DataFrame, keys: list[str], spread: Column,
                how: str = "inner", salts: int = SALTS, share: int = HOT_SHARE,
                min_rows: int = MIN_ROWS) -> DataFrame:
    """Equi-join in which the hot keys of ``big`` are spread over ``salts`` tasks.

    ``spread`` tells rows of one key in ``big`` apart. The rows of ``other`` are
    repeated for hot keys only. The list of hot keys is broadcast: by its
    definition it has at most ``share`` rows.
    """
    hot = F.broadcast(hot_keys(big, keys, share, min_rows).withColumn("_hot", F.lit(True)))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    left = big.join(hot, keys, "left").withColumn("_salt", F.coalesce(salt, F.lit(0))).drop("_hot")
    all_salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
    right = other.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.coalesce(all_salts, F.array(F.lit(0))))
    ).drop("_hot")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
