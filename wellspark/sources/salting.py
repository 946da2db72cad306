"""Placing rows for bucketed tables whose key may be hot.

A table bucketed by its key has all rows of one key in one bucket, which one task
reads. Here a table is bucketed by ``place`` instead: the key itself for an ordinary key, so
that it meets tables bucketed by that key without a shuffle, and for a key with more
than ``above`` rows one of several hashes, which spread it over the buckets. ``salted``
tells the two apart (a partition column: either kind is read alone).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACE, SALTED = "place", "salted"
BROADCAST_KEYS = 1_000_000    # hot keys that may be broadcast: a few MB


def hot_keys(df: DataFrame, key: str, above: int) -> DataFrame:
    """(key, n) of the keys with more than ``above`` rows: no more than rows / above of them."""
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > above))


def with_place(df: DataFrame, key: str, above: int, spread_by: Column) -> DataFrame:
    """``df`` plus ``place`` and ``salted``; a hot key gets a place per ``above`` rows, dealt by ``spread_by``."""
    hot = hot_keys(df, key, above).select(F.col(key).alias("__hot"), F.ceil(F.col("n") / F.lit(above)).alias("__places"))
    if hot.count() <= BROADCAST_KEYS:
        hot = F.broadcast(hot)
    spread = F.pmod(F.xxhash64(spread_by), F.col("__places"))
    salted = F.col("__hot").isNotNull()
    return (df.join(hot, df[key] == F.col("__hot"), "left")
            .withColumn(PLACE, F.when(salted, F.xxhash64(F.col("__hot"), spread)).otherwise(F.col(key)))
            .withColumn(SALTED, salted).drop("__hot", "__places"))
