"""Works that others refer to, and earlier works on the same topic.

Defined results: null and blank references don't count; a reference given twice counts once; a work delivered several
times is found once; parents without references have zero counts; dates compare as dates, null dates match nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def reference_ids(refs: Column) -> Column:
    """References that aren't blank, each once, in order."""
    return F.array_distinct(F.filter(refs, lambda x: x.isNotNull() & (F.trim(x) != "")))


def lookup(parents: DataFrame, refs: Column, key: Column, parsed: DataFrame) -> DataFrame:
    """(parent, ref_id, found, skip_reasons): one row per reference of each parent; ``parsed`` has id and skip_reasons.

    Parents may have several rows. The join is on the reference; whoever cites most has rows on all tasks, and AQE splits a work that most cite.
    """
    asked = parents.select(key.alias("parent"), F.explode(reference_ids(refs)).alias("ref_id")).where(F.col("parent").isNotNull()).distinct()
    return asked.join(parsed.select(F.col("id").alias("ref_id"), "skip_reasons", F.lit(True).alias("there")), "ref_id", "left").select("parent", "ref_id", F.coalesce("there", F.lit(False)).alias("found"), "skip_reasons")


def lookup_stats(rows: DataFrame) -> DataFrame:
    """Requested, found, accepted, skipped and missing references of each parent."""
    good = F.col("found") & (F.size(F.coalesce("skip_reasons", F.array())) == 0)
    return rows.groupBy("parent").agg(
        F.count(F.lit(1)).alias("requested"), F.count_if("found").alias("n_found"), F.count_if(good).alias("accepted"), F.count_if(F.col("found") & ~good).alias("skipped"),
        F.greatest(F.count(F.lit(1)) - F.count_if("found"), F.lit(0)).alias("missing"),
    )


def window_start(published: Column) -> Column:
    """January 1 of the fifth year before."""
    return F.make_date(F.year(published) - 5, F.lit(1), F.lit(1))


def earlier_works(parents: DataFrame, works: DataFrame) -> DataFrame:
    """Works of each parent's topic from five years before up to its date, itself left out.

    ``parents``: parent, topic_id, published; ``works``: id, topic_id, published and more. An equi join on the topic with
    the dates as a condition; topics are hot, so AQE's skew join splits them.
    """
    left = parents.select("parent", "topic_id", F.col("published").alias("until"), window_start(F.col("published")).alias("since"))
    return works.join(left, "topic_id").where((F.col("published") >= F.col("since")) & (F.col("published") <= F.col("until")) & (F.col("id") != F.col("parent"))).drop("since", "until")


def earlier_counts(parents: DataFrame, works: DataFrame) -> DataFrame:
    """(parent, topic_id, n, first, last) of the same works, counted and dated without pairing them.

    Works are counted per topic and day, thus map-side; running sums over a topic's days and years, whose number the calendar
    bounds, give each parent its count by two equi joins: up to its day, less what came before its first year. No join is on
    the topic alone, so a topic with a third of all works is spread over its days. A work has one date per topic here, the
    least; parents without earlier works have no row.
    """
    rows = works.where(F.col("topic_id").isNotNull() & F.col("id").isNotNull()).groupBy("id", "topic_id").agg(F.min("published").alias("published")).where(F.col("published").isNotNull())
    asked = parents.select("parent", "topic_id", "published", F.year(window_start(F.col("published"))).alias("year")).where(F.col("topic_id").isNotNull() & F.col("published").isNotNull()).distinct()
    days = rows.groupBy("topic_id", F.col("published").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    days = days.unionByName(asked.select("topic_id", F.col("published").alias("day"), F.lit(0).cast("bigint").alias("n"))).groupBy("topic_id", "day").agg(F.sum("n").alias("n"))
    by_day = Window.partitionBy("topic_id").orderBy("day")
    there = F.when(F.col("n") > 0, F.col("day"))
    run = days.select(
        "topic_id", "day", F.col("n").alias("on_day"), F.sum("n").over(by_day).alias("upto"),
        F.max(there).over(by_day.rowsBetween(Window.unboundedPreceding, -1)).alias("before_day"),
    )
    years = days.groupBy("topic_id", F.year("day").alias("year")).agg(F.sum("n").alias("n"), F.min(there).alias("first"))
    years = years.unionByName(asked.select("topic_id", "year", F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("date").alias("first"))).groupBy("topic_id", "year").agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    by_year = Window.partitionBy("topic_id").orderBy("year")
    since = years.select("topic_id", "year", (F.sum("n").over(by_year) - F.col("n")).alias("before"), F.min("first").over(by_year.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("since"))
    own = rows.select(F.col("id").alias("parent"), "topic_id", F.col("published").alias("own"))
    met = asked.join(run.withColumnRenamed("day", "published"), ["topic_id", "published"]).join(since, ["topic_id", "year"]).join(own, ["parent", "topic_id"], "left")
    mine = F.coalesce((F.col("own") <= F.col("published")) & (F.year("own") >= F.col("year")), F.lit(False)).cast("int")
    alone = (F.col("on_day") - F.coalesce((F.col("own") == F.col("published")).cast("int"), F.lit(0))) <= 0  # on the parent's day but for itself
    met = met.withColumn("n", F.col("upto") - F.col("before") - mine)
    first = F.when((F.col("since") == F.col("published")) & alone, F.lit(None).cast("date")).otherwise(F.col("since"))
    last = F.when(alone, F.col("before_day")).otherwise(F.col("published"))
    return met.where(F.col("n") > 0).select("parent", "topic_id", "n", first.alias("first"), last.alias("last"))
