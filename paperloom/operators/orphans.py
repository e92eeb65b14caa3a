"""References to records that do not exist, kept as signed counts per key.

Every change is a signed delta. Of a source: +1 for each reference that a delivery gains, -1 for each that a later one drops
or that goes with the source's deletion. Of a record: +1 when it comes to be there, -1 when it is withdrawn. Deltas of a key
fold into one state row by sums and a maximum, so they are merged map-side and batches are folded on as they come. A key is
an orphan now while its references are positive and its existence is zero.

What a delta is depends on what was there before, so a second table keeps the last event of each source: its references and
whether it is there. Events that come late, older than what is known of their source, change nothing that has been replaced
since, but their references count as mentioned.

Defined results: references of a source without a key are counted and never replaced; a null reference or one without a key counts for nothing; a reference that a delivery gives twice counts
once; an empty table gives an empty state; a deletion on the day of the last delivery withdraws the record, and deliveries
of one source on one day count as one with the references of all; events without a date come before all others; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import settle, store, stored

#: References of a key that a task meets at a time in the join with the orphan keys.
SALTED = 100_000


def deliveries(records: DataFrame, key: Column, at: Column, targets: Column) -> DataFrame:
    """Events of records delivered, with the keys that they refer to."""
    refs = F.array_distinct(F.array_compact(F.coalesce(targets, F.array().cast("array<string>"))))
    return records.select(key.alias("key"), at.cast("date").alias("at"), F.lit(True).alias("present"), refs.alias("refs"))


def deletions(records: DataFrame, key: Column, at: Column) -> DataFrame:
    """Events of records withdrawn."""
    return records.select(key.alias("key"), at.cast("date").alias("at"), F.lit(False).alias("present"), F.array().cast("array<string>").alias("refs")).where(F.col("key").isNotNull())


def _change(key: Column, refs: Column | int, mentions: int, existence: Column | int) -> Column:
    number = lambda x: (F.lit(x) if isinstance(x, int) else x).cast("bigint")
    return F.struct(key.alias("key"), number(refs).alias("refs"), number(mentions).alias("mentions"), number(existence).alias("existence"))


def mentions(keys: DataFrame, key: Column) -> DataFrame:
    """Deltas of references whose sources are never delivered again."""
    return keys.where(key.isNotNull()).select(_change(key, 1, 1, 0).alias("d")).select("d.*")


def _days(events: DataFrame, known: DataFrame | None) -> DataFrame:
    """One row per day and kind of each source: the references of all, those known before, and whether anything is new."""
    rows = events.where(F.col("key").isNotNull()).select("key", "at", "present", "refs", F.lit(True).alias("new"))
    if known is not None:
        rows = rows.unionByName(known.select("key", "at", "present", "refs", F.lit(False).alias("new")))
    old = F.max(F.when(~F.col("new"), F.col("refs")))
    return rows.groupBy("key", "at", "present").agg(F.array_distinct(F.flatten(F.collect_list("refs"))).alias("refs"), old.alias("old"), F.max("new").alias("new"))


def deltas(events: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Rows (key, refs, mentions, existence): signed changes by ``events``, given the last events ``known`` before them.

    A window over the events of one source, which are as many as its deliveries, gives each what stood before it.
    """
    none = F.array().cast("array<string>")
    by = Window.partitionBy("key").orderBy(F.col("at").asc_nulls_first(), F.col("present").desc())
    later = F.max(F.col("old").isNotNull()).over(by.rowsBetween(1, Window.unboundedFollowing))
    rows = _days(events, known).select(
        "key", "new", "present", "refs", F.coalesce(later, F.lit(False)).alias("late"),
        F.when(F.col("old").isNotNull(), F.col("present")).otherwise(F.coalesce(F.lag("present").over(by), F.lit(False))).alias("was"),
        F.coalesce("old", F.lag("refs").over(by), none).alias("had"),
    ).where("new")
    # Of late events, older than what was known of their source before, only the mention remains.
    exists = F.when(F.col("late") | (F.col("present") == F.col("was")), 0).when(F.col("present"), 1).otherwise(-1)
    gained = F.transform(F.array_except("refs", "had"), lambda t: _change(t, F.when(F.col("late"), 0).otherwise(1), 1, 0))
    lost = F.transform(F.when(F.col("late"), none).otherwise(F.array_except("had", "refs")), lambda t: _change(t, -1, 0, 0))
    signed = rows.select(F.explode(F.concat(F.array(_change(F.col("key"), 0, 0, exists)), gained, lost)).alias("d")).select("d.*")
    nameless = events.where(F.col("key").isNull()).select(F.explode("refs").alias("key"))  # sources that nothing can replace
    return signed.unionByName(mentions(nameless, F.col("key")))


def fold(*parts: DataFrame) -> DataFrame:
    """Merge states and delta batches into one state row per key, map-side combined."""
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.groupBy("key").agg(*(F.sum(c).alias(c) for c in ("refs", "mentions", "existence")))


def last_events(events: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The last event of every source: what later deltas start from."""
    order = F.struct(F.coalesce("at", F.lit("0001-01-01").cast("date")), ~F.col("present"))
    return _days(events, known).groupBy("key").agg(F.max_by(F.struct("at", "present", "refs"), order).alias("e")).select("key", "e.*")


def update(events: DataFrame, path: str) -> DataFrame:
    """Fold a batch of events into the state stored under ``path``; the new state, stored there as well.

    Counts and last events are one table, so a version holds both or isn't there, and a batch that broke off is run again.
    """
    before = stored(events.sparkSession, path)
    batch = settle(events, "events")
    known = None if before is None else before.where("kind = 'source'").select("key", "at", "present", F.col("targets").alias("refs"))
    counts = fold(deltas(batch, known)) if before is None else fold(state_of(before), deltas(batch, known))
    sources = last_events(batch, known).withColumnRenamed("refs", "targets").withColumn("kind", F.lit("source"))
    rows = counts.withColumn("kind", F.lit("count")).unionByName(sources, allowMissingColumns=True)
    return state_of(store(rows, path))


def state_of(version: DataFrame) -> DataFrame:
    """The counts of a stored version."""
    return version.where("kind = 'count'").select("key", "refs", "mentions", "existence")


def missing() -> Column:
    """Whether a record is not, or no longer, there."""
    return F.col("existence") <= 0


def orphan_keys(state: DataFrame) -> DataFrame:
    """Keys with positive references and zero existence: the current report."""
    return state.where((F.col("refs") > 0) & missing()).select("key", "refs")


def orphan_references(references: DataFrame, state: DataFrame, key: str, spread_by: str, salted: int = SALTED) -> DataFrame:
    """The rows of ``references``, current or replaced since, whose ``key`` isn't there.

    The missing keys are few against the references. Each is repeated as often as its mentions ask for, so a key that holds
    a third of all references is joined by as many tasks as that takes. The salt is a function of ``spread_by``, thus the
    same in every run.
    """
    salts = F.least(F.lit(1 << 20), F.ceil(F.col("mentions") / F.lit(salted))).cast("int")
    keys = state.where((F.col("mentions") > 0) & missing()).select(F.col("key").alias("__key"), salts.alias("__n"))
    hot = keys.where("__n > 1")
    each = keys.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__n") - 1))).drop("__n")
    spread = references.join(hot.withColumnRenamed("__key", "__hot"), references[key] == F.col("__hot"), "left").drop("__hot")
    spread = spread.withColumn("__s", F.coalesce(F.pmod(F.xxhash64(spread_by), F.col("__n")), F.lit(0)).cast("int")).drop("__n")
    return spread.join(each, (spread[key] == F.col("__key")) & (F.col("__s") == F.col("__salt")), "left_semi").drop("__s")
