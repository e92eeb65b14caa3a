"""Seeded samples: hash order, more candidates than asked for, and acceptance until enough are found.

The order is that of md5(id:seed), ties by id: the same for any layout. The candidates of one configuration are a top-k
(TakeOrderedAndProject), those of many topics a rank limit applied in every task before the shuffle (WindowGroupLimit).
Windows run over candidates only, at most ``count`` x ``OVERSAMPLE`` per key.

Defined results: works without an id take no part; repeated rows of an id are candidates each; an empty table gives no
candidates; a count of 0 accepts none.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OVERSAMPLE = 5
MOST_SEED = 2_147_483_647


def generate_seed() -> int:
    return secrets.randbelow(MOST_SEED)


def hash_key(item: Column, seed: int | Column) -> Column:
    return F.md5(F.concat(item, F.lit(":"), (F.lit(str(seed)) if isinstance(seed, int) else seed.cast("string"))))


_PATHS = (("domain", "primary_topic.domain"), ("field", "primary_topic.field"), ("subfield", "primary_topic.subfield"), ("topic", "primary_topic"))


def matching(works: DataFrame, config) -> DataFrame:
    """Works of a configuration's dates, type, language and topic path that have an id and an abstract."""
    keep = (F.col("publication_date") >= F.lit(config.from_publication_date).cast("date")) & (F.col("type") == config.work_type) & (F.col("language") == config.language)
    if config.to_publication_date:
        keep &= F.col("publication_date") <= F.lit(config.to_publication_date).cast("date")
    keep &= F.col("abstract_inverted_index").isNotNull() & F.col("id").isNotNull()
    for level, path in _PATHS:
        keep &= F.lower(F.col(f"{path}.display_name")) == F.lower(F.lit(getattr(config, level)))
    return works.where(keep)


def matching_all(works: DataFrame, configs: DataFrame) -> DataFrame:
    """The same of many configurations at once, a row per work and configuration; their columns are named ``c_...`` but for
    config_id. They are joined by topic path, type and language; Catalyst broadcasts them if their size allows."""
    named = configs.withColumnsRenamed({c: f"c_{c}" for c in configs.columns if c != "config_id"})
    on = (F.col("type") == F.col("c_work_type")) & (F.col("language") == F.col("c_language"))
    for level, path in _PATHS:
        on &= F.lower(F.col(f"{path}.display_name")) == F.lower(F.col(f"c_{level}"))
    until = F.to_date("c_to_publication_date")
    dated = (F.col("publication_date") >= F.to_date("c_from_publication_date")) & (until.isNull() | (F.col("publication_date") <= until))
    works = works.drop(*(c for c in works.columns if c in named.columns))  # extra columns of a name that a configuration has
    return works.join(named, on).where(dated & F.col("abstract_inverted_index").isNotNull() & F.col("id").isNotNull())


def candidates(works: DataFrame, count: int, seed: int, *, most: int | None = None) -> DataFrame:
    """The first works in hash order, ``OVERSAMPLE`` times as many as asked for."""
    size = max(count, OVERSAMPLE * count) if most is None else min(most, max(count, OVERSAMPLE * count))
    return works.withColumn("sample_key", hash_key(F.col("id"), seed)).orderBy("sample_key", "id").limit(size)


def candidates_per_key(works: DataFrame, key: str, count: int | Column, seed: int | Column, *, most: int | None = None, order: tuple[str, ...] = ("id",)) -> DataFrame:
    """The same for every key at once, in one job. ``count`` and ``seed`` may differ by row; ``most`` is the greatest count,
    which the plan then applies in every task before the shuffle. ``order`` breaks ties of the hash."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy("sample_key", *order))
    limit = OVERSAMPLE * (count if isinstance(count, int) else most) if isinstance(count, int) or most is not None else None
    ranked = works.withColumn("sample_key", hash_key(F.col("id"), seed)).withColumn("sample_rank", rank)
    ranked = ranked if limit is None else ranked.where(F.col("sample_rank") <= limit)
    return ranked if isinstance(count, int) else ranked.where(F.col("sample_rank") <= OVERSAMPLE * count)


def accept(parsed: DataFrame, count: int | Column, *, by: tuple[str, ...] = (), order: tuple[str, ...] = ("sample_key", "id")) -> DataFrame:
    """Candidates up to the one with which ``count`` are accepted, with ``ok`` and the running number accepted."""
    ok = (F.size("skip_reasons") == 0).cast("int")
    keys = [F.col(c) for c in by] or [F.lit(0)]
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = parsed.withColumn("ok", ok).withColumn("n_accepted", F.sum("ok").over(w))
    return run.where(F.col("n_accepted") - F.col("ok") < count)


def sample_stats(seen: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Seen, accepted and skipped candidates."""
    return seen.groupBy(*by).agg(F.count(F.lit(1)).alias("sampled_seen"), F.sum("ok").alias("written"), F.sum(1 - F.col("ok")).alias("skipped"))
