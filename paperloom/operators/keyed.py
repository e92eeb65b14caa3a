"""Results per key when a few keys hold most rows.

Everything is an algebraic aggregate: each task folds its rows into one state per key (a bounded hash table that spills),
and only those states are shuffled. A key with a third of all rows costs its reducer one row per map task.

Defined results: rows with a null key form no group of their own but count in totals; ties in a sample are broken by the
id; repeated rows of an id count in row counts and once in samples; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def per_key(df: DataFrame, key: Column, aggregates: dict[str, Column], name: str = "key") -> DataFrame:
    """Algebraic aggregates per key; partial aggregation runs before the shuffle."""
    return df.withColumn("__k", key).where(F.col("__k").isNotNull()).groupBy(F.col("__k").alias(name)).agg(*(v.alias(k) for k, v in aggregates.items()))


def heavy_keys(df: DataFrame, key: Column, share: float, name: str = "key") -> DataFrame:
    """Keys that stand in at least ``share`` of all rows, null keys counted among all rows.

    One scan: the total is the sum of the counts per key, whose exchange it reuses.
    """
    counts = df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows").alias("n")).scalar()
    return counts.where(F.col(name).isNotNull() & (F.col("rows") >= F.lit(share) * total))


def distinct_per_key(df: DataFrame, key: Column, item: Column, name: str = "key") -> DataFrame:
    """Exact number of distinct items per key: de-duplicated on (key, item), which no hot key unbalances."""
    pairs = df.select(key.alias(name), item.alias("__item")).where(F.col(name).isNotNull() & F.col("__item").isNotNull()).distinct()
    return pairs.groupBy(name).agg(F.count(F.lit(1)).alias("items"))


def sample_per_key(df: DataFrame, key: Column, item: Column, k: int, seed: int = 0, name: str = "key") -> DataFrame:
    """The ``k`` items of each key with the least hash of (item, seed).

    The rank limit is applied in each task before the shuffle as well, so a task sends at most ``k`` rows of a key.
    """
    pairs = df.select(key.alias(name), item.alias("item")).where(F.col(name).isNotNull() & F.col("item").isNotNull()).distinct()
    hashed = pairs.withColumn("__h", F.md5(F.concat_ws(":", F.col("item"), F.lit(str(seed)))))
    w = Window.partitionBy(name).orderBy("__h", "item")
    return hashed.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k).select(name, "item", "place")
