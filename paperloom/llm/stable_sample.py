"""Samples that stay the same over runs, layouts and growth: consistent weighted Poisson sampling.

A record is selected when its hash, a number in [0, 1) made of its id and the seed alone, lies below weight x constant.
The constant depends on the configuration and never on the data, and a record's weight is the greatest it ever had, so a
record's inclusion probability never falls and no selected record leaves.

Defined results: records without an id are never sampled; repeated deliveries of an id count once, with their greatest
weight; a null weight is the least; a configuration without seed gives no sample; empty tables give none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import store, stored

#: Matching records of weight one among which a configuration's count is expected.
POPULATION = 1000
#: Weight of a record: 1, and up to 1 more with its citations.
MOST_CITED = 100


def unit_hash(item: Column, seed: Column) -> Column:
    """52 bits of the digest of ``item:seed`` as a number in [0, 1)."""
    digest = F.md5(F.concat(item, F.lit(":"), seed.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def citation_weight(cited: Column) -> Column:
    return 1.0 + F.least(F.greatest(F.coalesce(cited, F.lit(0)), F.lit(0)), F.lit(MOST_CITED)) / F.lit(float(MOST_CITED))


def running_weights(deliveries: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """State of (config_id, work_id, weight), the greatest weight so far; ``state`` is that of earlier deliveries."""
    rows = deliveries if state is None else state.select(*deliveries.columns).unionByName(deliveries)
    constant = [F.first(c).alias(c) for c in ("seed", "rate")]
    return rows.groupBy("config_id", "work_id").agg(F.max("weight").alias("weight"), *constant)


def update(deliveries: DataFrame, path: str) -> DataFrame:
    """Fold deliveries into the weights stored under ``path``; the new state, stored there as well.

    Maxima fold in any order, so deliveries may come late, twice or in pieces; what was selected once stays selected, even
    where later snapshots no longer hold what gave a record its weight.
    """
    return store(running_weights(deliveries, stored(deliveries.sparkSession, path)), path)


def select(state: DataFrame) -> DataFrame:
    """The sample that the state gives."""
    hashed = state.withColumn("u", unit_hash(F.col("work_id"), F.col("seed")))
    return hashed.where(F.col("u") < F.col("weight") * F.col("rate")).select("config_id", "work_id", "weight")


def matching(works: DataFrame, configs: DataFrame, work_id: Column) -> DataFrame:
    """Deliveries that match a configuration with a seed: dates, type, language, abstract and the four topic names.

    The join is on the lower-cased topic path; Catalyst broadcasts the configurations if their size allows.
    """
    names = ["primary_topic.domain", "primary_topic.field", "primary_topic.subfield", "primary_topic"]
    left = works.select(
        work_id.alias("work_id"), "publication_date", "type", "language", F.col("cited_by_count").alias("cited"),
        *(F.lower(F.col(f"{n}.display_name")).alias(f"n{i}") for i, n in enumerate(names)),
    ).where(F.col("work_id").isNotNull() & works["abstract_inverted_index"].isNotNull())
    right = configs.where(F.col("sample_seed").isNotNull()).select(
        "config_id", F.col("sample_seed").alias("seed"), (F.col("count") / F.lit(float(POPULATION))).alias("rate"),
        F.to_date("from_publication_date").alias("since"), F.to_date("to_publication_date").alias("until"), "work_type", F.col("language").alias("wanted"),
        *(F.lower(F.col(c)).alias(f"m{i}") for i, c in enumerate(("domain", "field", "subfield", "topic"))),
    )
    on = (F.col("type") == F.col("work_type")) & (F.col("language") == F.col("wanted"))
    for i in range(4):
        on &= F.col(f"n{i}") == F.col(f"m{i}")
    joined = left.join(right, on).where((F.col("publication_date") >= F.col("since")) & (F.col("until").isNull() | (F.col("publication_date") <= F.col("until"))))
    return joined.select("config_id", "work_id", citation_weight(F.col("cited")).alias("weight"), "seed", "rate")
