"""Near-duplicates by a prefix filter over a frequency order, in place of PartEnum.

A record is the set of its word shingles. PartEnum, which partitions the domain by a hash and enumerates subsets of the
parts as signatures, doesn't serve a threshold as low as 0.6 on texts of common phrases (README has the figures): small
parts hold a single common shingle, shared by a large share of all records, and large ones need thousands of subsets. So
the domain is ordered from rare to common, and a set's signatures are the single shingles of its rarer part: if two sets of
sizes a and b have a Jaccard similarity of t, they share ceil(t/(1+t) (a+b)) shingles, so the rarer parts of both, of
a - ceil(ta) + 1 and b - ceil(tb) + 1 shingles, meet. No pair is lost.

Pairs that meet are tested by exact bounds before any set is moved: the sizes, and a bit per shingle folded by exclusive
or into 256 bits, whose distance never exceeds that of the sets. What remains is compared set against set.

Defined results: a null name has no words, a null text too; records with fewer words than asked for take no part and are
groups of their own; equal sets are one class, compared once; ties in rarity are broken by the shingle's hash; letters
and digits of all scripts are words; very long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import discard, settle

#: Counters of shingle frequency: a fixed number, whatever the data's size, so what is broadcast is 256 KB.
COUNTERS = 1 << 18
WORD = r"[\p{L}\p{N}]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def shingles(row: Column, size: int) -> Column:
    """Hashes of the distinct runs of ``size`` words."""
    starts = F.sequence(F.lit(1), F.size(row) - F.lit(size - 1))
    runs = F.transform(starts, lambda i: F.xxhash64(*(F.element_at(row, i + F.lit(k)) for k in range(size))))
    return F.when(F.size(row) >= size, F.array_distinct(runs)).otherwise(F.array().cast("array<bigint>"))


def classes(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (id, rep) and one row (rep, n, shingles) per distinct set of shingles, from rows (id, shingles).

    Only hashes of the sets are shuffled to find equal ones. The sets lose the other members by an anti join with those
    alone, which Catalyst broadcasts where its size allows.
    """
    ordered = records.select("id", F.array_sort("shingles").alias("s")).select("id", "s", F.xxhash64("s").alias("h1"), F.hash("s").alias("h2"), F.size("s").alias("n"))
    ordered = settle(ordered, "shingles")
    reps = ordered.groupBy("h1", "h2", "n").agg(F.min("id").alias("rep"))
    members = settle(ordered.select("id", "h1", "h2", "n").join(reps, ["h1", "h2", "n"]).select("id", "rep", "n"), "members")
    others = settle(members.where(F.col("id") != F.col("rep")).select(F.col("id").alias("other")), "others")
    sets = ordered.join(others, ordered["id"] == others["other"], "left_anti")
    return members, sets.select(F.col("id").alias("rep"), "n", F.col("s").alias("shingles"))


def rarity(sets: DataFrame) -> np.ndarray:
    """How common the shingles of each counter are, on a scale of 0 to 255; counted over all sets, map-side first."""
    at = sets.select(F.explode("shingles").alias("x")).groupBy(F.pmod("x", F.lit(COUNTERS)).cast("int").alias("at"))
    rows = at.agg(F.count(F.lit(1)).alias("n")).toArrow()  # at most COUNTERS rows
    scale = np.zeros(COUNTERS, np.uint8)
    scale[rows["at"].to_numpy()] = np.minimum(255, 8 * np.log2(rows["n"].to_numpy() + 1)).astype(np.uint8)
    return scale


def signatures(sets: DataFrame, scale: np.ndarray, threshold: Fraction) -> DataFrame:
    """Rows (sig, rep, n, b0..b3): the shingles of each set's rarer part, with its size and folded bits."""
    shared = sets.sparkSession.sparkContext.broadcast(scale)
    up, down = threshold.numerator, threshold.denominator
    fields = {"sig": pa.int64(), "rep": pa.int64(), "n": pa.int32()} | {f"b{i}": pa.int64() for i in range(4)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        for batch in batches:
            lists = batch.column("shingles")
            sizes = np.asarray(lists.value_lengths()).astype(np.int64)
            x = np.asarray(lists.flatten())
            owner = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((x, common[x % COUNTERS], owner))
            place = np.arange(len(x)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            rare = sizes + (-sizes * up) // down + 1  # n - ceil(t n) + 1
            take = order[place < np.repeat(rare, sizes)]
            bit = (x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(56)).astype(np.int64)
            odd = np.bincount(owner * 256 + bit, minlength=len(sizes) * 256).astype(np.uint8) & 1
            bits = np.packbits(odd.reshape(len(sizes), 256), axis=1).view(np.int64)
            o = owner[take]
            columns = [x[take], np.asarray(batch.column("rep"))[o], sizes[o].astype(np.int32), *(bits[o, i] for i in range(4))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, fields.values(), strict=True)], list(fields))

    schema = "sig bigint, rep bigint, n int, b0 bigint, b1 bigint, b2 bigint, b3 bigint"
    return sets.where(F.col("n") > 0).mapInArrow(run, schema)


def similar_pairs(sets: DataFrame, threshold: Fraction) -> DataFrame:
    """Pairs (a, b, common, n_a, n_b) of representatives whose sets are at least ``threshold`` alike, a < b."""
    t = threshold
    rows = signatures(sets, rarity(sets), t)
    a = rows.select("sig", *(F.col(c).alias(f"a_{c}") for c in rows.columns[1:]))
    b = rows.select("sig", *(F.col(c).alias(f"b_{c}") for c in rows.columns[1:]))
    apart = sum((F.bit_count(F.col(f"a_b{i}").bitwiseXOR(F.col(f"b_b{i}"))) for i in range(1, 4)), F.bit_count(F.col("a_b0").bitwiseXOR(F.col("b_b0"))))
    up, down = F.lit(t.numerator), F.lit(t.denominator)
    allowed = (F.col("a_n") + F.col("b_n")) * F.lit(t.denominator - t.numerator)  # apart <= (1-t)/(1+t) (a+b)
    near = (F.col("a_n") * down >= F.col("b_n") * up) & (F.col("b_n") * down >= F.col("a_n") * up) & (apart * F.lit(t.denominator + t.numerator) <= allowed)
    met = a.join(b, (a["sig"] == b["sig"]) & (F.col("a_rep") < F.col("b_rep")) & near).select(F.col("a_rep").alias("a"), F.col("b_rep").alias("b")).distinct()
    met = settle(met, "met")
    sets = _among(sets, met.select(F.explode(F.array("a", "b")).alias("rep")))
    left = sets.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    both = met.join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("s_a", "s_b")))
    return both.where(F.col("common") * down >= (F.col("n_a") + F.col("n_b") - F.col("common")) * up).select("a", "b", "common", "n_a", "n_b")


#: Bits per set in a pair of the filter by which sets in no pair are left where they are; its most words of 64 bits (8 MB),
#: beyond which it lets more of the others through, but loses none.
FILTER_BITS, MOST_FILTER = 16, 1 << 20


def _among(sets: DataFrame, reps: DataFrame) -> DataFrame:
    """The sets whose ``rep`` may be among ``reps``: all that are, and few others; narrow."""
    size = min(MOST_FILTER, max(64, 1 << (FILTER_BITS * reps.count() // 64).bit_length()))
    h = F.xxhash64("rep")
    bits = reps.select(F.pmod(F.shiftright(h, 6), F.lit(size)).cast("int").alias("word"), F.expr("shiftleft(1L, cast(pmod(xxhash64(rep), 64) AS int))").alias("bit"))
    rows = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most ``size`` rows
    table = np.zeros(size, np.int64)
    table[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    shared = sets.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.asarray(batch.column("h"))
            kept = (shared.value[(h >> 6) % len(shared.value)] >> (h % 64)) & 1 == 1
            yield batch.filter(pa.array(kept)).select(["rep", "n", "shingles"])

    return sets.withColumn("h", h).mapInArrow(run, "rep bigint, n int, shingles array<bigint>")


def expand(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """All pairs (id_a, id_b) of records: of similar classes, and within a class."""
    x, y = members.select(F.col("rep").alias("a"), F.col("id").alias("x")), members.select(F.col("rep").alias("b"), F.col("id").alias("y"))
    across = pairs.select("a", "b").join(x, "a").join(y, "b")
    within = x.join(y, (F.col("a") == F.col("b")) & (F.col("x") < F.col("y")))
    return across.select("x", "y").unionByName(within.select("x", "y")).select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))


def components(edges: DataFrame) -> DataFrame:
    """(id, group): the least id each node of the edges (a, b) is connected with.

    Large-star and small-star steps in turn, each one shuffle, until no edge changes; the number of rounds grows with the
    logarithm of the longest chain. Each round's edges are written to the shared folder and the last ones removed.
    """
    now = settle(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(F.col("u") != F.col("v")).distinct(), "edges")
    while True:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select("u", "v", "m")
        linked = small.select("u", F.col("m").alias("v")).unionByName(small.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")))
        after = settle(linked.where(F.col("u") != F.col("v")).distinct(), "edges")
        signature = F.struct(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")))
        same = now.agg(signature).first()[0] == after.agg(signature).first()[0]
        discard(now)
        now = after
        if same:
            break
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("group")).unionByName(roots.select(F.col("v").alias("id"), F.col("v").alias("group")))
