"""A mix of sources with target shares: capped water-filling, then seeded whole and fractional repetitions.

Each source gets its share of the budget until its texts are used as often as allowed; what it can't give goes to the
others in proportion to their shares, again and again until no source is over its limit. A source's amount is a number
of whole passes over its texts and a part of one more; that part is the texts with the least hash, up to the tokens due.

Defined results: texts without a source or of a source without share are left out; null and empty texts have 0 tokens and
take part with their source's passes; a listed source without texts gives nothing and its share goes to the others; a
null or negative share is 0, a null limit is 1; with limits too low for the budget every source is at its limit and the
mix is smaller; ties in the hash are broken by the id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import settle

#: Bits of the hash that number its ranges within a source; only one range is ever put in order.
HASH_BITS, RANGE_BITS = 52, 16


def water_fill(sizes: dict[str, int], shares: dict[str, float], limits: dict[str, int], budget: float) -> dict[str, float]:
    """Amounts per source: in proportion to the shares, none above size x limit, the rest shared out until it fits."""
    capacity = {s: sizes.get(s, 0) * max(0, limits[s]) for s in shares}
    open_ = {s for s in shares if shares[s] > 0 and capacity[s] > 0}
    given: dict[str, float] = dict.fromkeys(shares, 0.0)
    left = float(budget)
    while open_:
        total = sum(shares[s] for s in open_)
        full = {s for s in open_ if left * (shares[s] / total) >= capacity[s]}
        if not full:
            given |= {s: left * (shares[s] / total) for s in open_}
            break
        given |= {s: float(capacity[s]) for s in full}
        left -= sum(capacity[s] for s in full)
        open_ -= full
    return given


def hash_place(item: Column, seed: int) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws(":", item.cast("string"), F.lit(str(seed)))), 1, 13), 16, 10).cast("bigint")


def mix(sized: DataFrame, weights: DataFrame, *, item: str, seed: int, budget: float | None = None) -> tuple[DataFrame, DataFrame]:
    """Repetitions of every item that takes part, and a report per listed source.

    ``sized`` has the columns item, source and n_tokens. Only the listed sources come to the driver: one row each of a
    table that is itself the configuration. ``budget`` is in tokens; by default one pass over all listed sources.
    """
    spark = sized.sparkSession
    listed = weights.groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")).where(F.col("source").isNotNull())
    facts = sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("items"))
    plan = {r.source: r for r in listed.join(facts, "source", "left").collect()}
    shares = {s: max(0.0, r.target_share or 0.0) for s, r in plan.items()}
    limits = {s: 1 if r.max_repeats is None else r.max_repeats for s, r in plan.items()}
    sizes = {s: r.tokens or 0 for s, r in plan.items()}
    amounts = water_fill(sizes, shares, limits, sum(sizes.values()) if budget is None else budget)
    rows = [(s, shares[s], limits[s], sizes[s], amounts[s], int(amounts[s] // sizes[s]) if sizes[s] else 0) for s in plan]
    rows = [(*r, r[4] - r[5] * r[3]) for r in rows]
    schema = "source string, target_share double, max_repeats int, tokens bigint, amount double, passes int, rest double"
    planned = spark.createDataFrame(rows, schema)

    # One range per source holds the end of its last, partial pass: found by counts, then put in order on its own.
    w = Window.partitionBy("source").orderBy("range")
    ranged = sized.withColumn("h", hash_place(F.col(item), seed)).withColumn("range", F.shiftright("h", HASH_BITS - RANGE_BITS).cast("int"))
    ends = (
        ranged.groupBy("source", "range").agg(F.sum("n_tokens").alias("n"))
        .withColumn("before", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n"))
        .join(planned.select("source", "rest"), "source").where(F.col("before") <= F.col("rest"))
        .groupBy("source").agg(F.max(F.struct("range", "before")).alias("end")).select("source", F.col("end.range").alias("end"), F.col("end.before").alias("before"))
    )
    due = F.broadcast(planned.where(F.col("amount") > 0).select("source", "passes", "rest").join(ends, "source", "left"))  # as many rows as listed sources
    due_rows = ranged.join(due, "source")
    edge = due_rows.where(F.col("range") == F.col("end"))
    inner = Window.partitionBy("source").orderBy("h", item).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = edge.withColumn("upto", F.col("before") + F.sum("n_tokens").over(inner)).withColumn("more", (F.col("upto") <= F.col("rest")).cast("int"))
    others = due_rows.where(~F.coalesce(F.col("range") == F.col("end"), F.lit(False))).withColumn("more", F.coalesce((F.col("range") < F.col("end")).cast("int"), F.lit(0)))
    columns = [item, "source", "n_tokens", (F.col("passes") + F.col("more")).cast("int").alias("repeats")]
    mixed = edge.select(*columns).unionByName(others.select(*columns)).where(F.col("repeats") > 0)
    return mixed, planned


def report(mixed: DataFrame, planned: DataFrame) -> DataFrame:
    """Target and actual share of every listed source."""
    total = mixed.agg(F.coalesce(F.sum(F.col("n_tokens") * F.col("repeats")), F.lit(0)).alias("t")).scalar()
    used = mixed.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("used"), F.max("repeats").alias("most_repeats"))
    joined = planned.join(used, "source", "left")
    return joined.select(
        "source", "target_share", "max_repeats", "tokens", F.coalesce("used", F.lit(0)).alias("used_tokens"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
        (F.coalesce("used", F.lit(0)) / F.greatest(total, F.lit(1))).alias("actual_share"),
    )


def mixed_documents(documents: DataFrame, weights: DataFrame, count: callable, seed: int = 7, budget: float | None = None) -> tuple[DataFrame, DataFrame]:
    """``mix`` for documents (doc_id, source, text); tokens are counted once and kept in the shared folder."""
    sized = settle(count(documents.select("doc_id", "source", "text").where(F.col("source").isNotNull())), "mix-sizes")
    return mix(sized, weights, item="doc_id", seed=seed, budget=budget)
