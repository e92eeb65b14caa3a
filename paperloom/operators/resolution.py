"""The work of a scraped article among candidates: weighted score, best with tie-breaks, reasons where there is none.

Candidates are the works that a search by title words ranks first, and all that have an equal venue (normal form) and a title
whose likeness may suffice. Without the venue a score stays below the limit, so no work that reaches it is missed: lengths,
counts of letters and the longest common subsequence bound the likeness from above. Normal forms are made once per title and
venue, before all joins; likeness only is Python, over Arrow. The best is an aggregate (``max_by``), not a sort of a group.

Defined results: an article without a title after cleaning is unresolved as such; one none of whose words any work has, and
without works of its venue, has no candidates; a score below the limit is a low-confidence match; ties go to the more cited,
then to the lesser id; repeated candidates count once; null years and venues add nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.letters import BAG, bag_udf, common_udf
from ..functions.names import LEAST_CONFIDENCE, TITLE_WEIGHT, VENUE_WEIGHT, YEAR_WEIGHT, main_title_udf, normal_title_udf, ratio_udf

#: Words in at most this part of all titles lead to candidates; so does an article's rarest word in any case.
RARE_WORD = 0.001
#: Fixed value: works that a search for a title gives.
SEARCHED = 10
#: Works of one venue that a task meets at a time.
SALTED = 1000


def left_forms(articles: DataFrame) -> DataFrame:
    """Articles (article_id, title, journal, year) with normal forms of title, part before the colon, and journal."""
    if "t" in articles.columns:
        return articles
    head = F.nullif(normal_title_udf(main_title_udf("title")), F.lit(""))
    return articles.select("article_id", "title", "journal", F.col("year").cast("string").alias("year"), normal_title_udf("title").alias("t"), head.alias("head"), normal_title_udf("journal").alias("v"))


def right_forms(works: DataFrame) -> DataFrame:
    """Works (id, title, venue, published and maybe cited) with normal forms of title and venue."""
    if "t" in works.columns:
        return works
    return works.select("id", "title", normal_title_udf("title").alias("t"), normal_title_udf("venue").alias("v"), F.substring("published", 1, 4).alias("dated"), *(c for c in ("cited",) if c in works.columns))


def score(title: Column, left: dict[str, Column], right: dict[str, Column]) -> Column:
    """Title, venue and year, weighted; ``title`` is the likeness of the normal forms."""
    alike = F.when(left["head"] == right["t"], F.lit(1.0)).otherwise(title) * TITLE_WEIGHT
    venue = F.when((left["v"] == right["v"]) & (right["v"] != ""), F.lit(VENUE_WEIGHT)).otherwise(F.lit(0.0))
    dated = F.when(left["year"] == right["dated"], F.lit(YEAR_WEIGHT)).otherwise(F.lit(0.0))
    return F.least(F.lit(1.0), alike + venue + dated)


def searched(articles: DataFrame, works: DataFrame, most: int = SEARCHED) -> DataFrame:
    """(article_id, id) of the works that share the most of each title's weight in words, at most ``most``, ties by id.

    Words weigh log(N/df). Rare words lead to works, and each title's rarest word, so every title that shares a word with
    any work has candidates.
    """
    split = lambda df, key: df.select(key, F.explode(F.array_distinct(F.split("t", " "))).alias("word")).where(F.length("word") > 1)
    left, right = split(left_forms(articles), "article_id"), split(right_forms(works), "id")
    total = F.lit(works.agg(F.count(F.lit(1)).alias("n")).scalar()).cast("double")
    df = right.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    by = Window.partitionBy("article_id")  # the words of one title
    known = left.join(df, "word").withColumn("least", F.min("df").over(by)).where((F.col("df") <= F.col("least")) | (F.col("df") <= F.lit(RARE_WORD) * total))
    shared = known.select("article_id", "word", F.log((total + 1) / F.col("df")).alias("w")).join(right, "word").groupBy("article_id", "id").agg(F.sum("w").alias("w"))
    ranked = shared.withColumn("place", F.row_number().over(Window.partitionBy("article_id").orderBy(F.col("w").desc(), "id")))
    return ranked.where(F.col("place") <= most).select("article_id", "id")


def candidates(articles: DataFrame, works: DataFrame, least: float = LEAST_CONFIDENCE) -> DataFrame:
    """(article_id, id) pairs that a search finds or that may reach the least confidence."""
    return searched(articles, works).unionByName(of_venue(articles, works, least)).distinct()


def of_venue(articles: DataFrame, works: DataFrame, least: float = LEAST_CONFIDENCE) -> DataFrame:
    """(article_id, id) of all pairs that reach ``least``, and of some that don't: an equi join on venues, hot ones salted."""
    if least <= TITLE_WEIGHT + YEAR_WEIGHT:
        raise ValueError("below this, works of other venues could match")
    bags = [f"b{i}" for i in range(BAG)]
    tasks = articles.sparkSession.sparkContext.defaultParallelism * 4
    bagged = lambda df: df.where((F.col("v") != "") & (F.col("t") != "")).withColumn("bag", bag_udf("t"))
    right = bagged(right_forms(works)).select("id", "v", "dated", F.col("t").alias("found"), F.length("t").alias("m"), F.col("bag.rest").alias("rest_r"), *(F.col(f"bag.{b}").alias(f"{b}_r") for b in bags))
    left = bagged(left_forms(articles)).select("article_id", "v", "year", F.col("t").alias("wanted"), "head", F.length("t").alias("n"), "bag.rest", *(f"bag.{b}" for b in bags))
    salts = right.groupBy("v").agg(F.ceil(F.count(F.lit(1)) / F.lit(SALTED)).cast("int").alias("salts"))
    left = left.join(salts, "v").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    right = right.join(salts, "v").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int")).drop("salts")
    dated = F.when(F.col("dated") == F.col("year"), F.lit(YEAR_WEIGHT)).otherwise(F.lit(0.0))
    # Letters that a likeness of at least what is needed has in common; a little less, for rounding.
    needed = (F.lit(least - VENUE_WEIGHT - 1e-9) - dated) / F.lit(TITLE_WEIGHT) * (F.col("n") + F.col("m")) / 2
    shared = reduce(lambda x, y: x + y, (F.bit_count(F.col(b).bitwiseAND(F.col(f"{b}_r"))) for b in bags)) + F.least("rest", "rest_r")
    headed = F.coalesce(F.col("head") == F.col("found"), F.lit(False))
    met = left.repartition(tasks, "v", "salt").join(right.repartition(tasks, "v", "salt"), ["v", "salt"])
    near = met.where(headed | ((F.least("n", "m") >= needed) & (shared >= needed))).select("article_id", "id", "wanted", "found", needed.alias("needed"), headed.alias("headed"))
    # Not as an "or" of the same condition: Catalyst would merge both filters and run Python before the first.
    most = F.greatest(common_udf("wanted", "found").cast("double"), F.when(F.col("headed"), F.col("needed")).otherwise(F.lit(0.0)))
    return near.where(most >= F.col("needed")).select("article_id", "id")


def scored(articles: DataFrame, works: DataFrame, pairs: DataFrame) -> DataFrame:
    """(article_id, id, cited, score) of every pair."""
    left, right = left_forms(articles), right_forms(works)
    sides = [{c: F.col(f"{side}_{c}") for c in ("t", "v", "head", "year", "dated")} for side in ("l", "r")]
    l, r = left.select("article_id", *(F.col(c).alias(f"l_{c}") for c in ("t", "head", "v", "year"))), right.select("id", "cited", *(F.col(c).alias(f"r_{c}") for c in ("t", "v", "dated")))  # noqa: E741
    joined = pairs.join(l, "article_id").join(r, "id").repartition(pairs.sparkSession.sparkContext.defaultParallelism * 4)  # pairs are small rows of much work
    return joined.withColumn("score", score(ratio_udf("l_t", "r_t"), *sides)).select("article_id", "id", "cited", "score")


_RANK = lambda: F.struct("score", F.coalesce("cited", F.lit(-1)).alias("cited"), (-F.xxhash64("id")).alias("tie"))


def resolve(articles: DataFrame, works: DataFrame, pairs: DataFrame, least: float = LEAST_CONFIDENCE) -> DataFrame:
    """(article_id, status, confidence, work_id, reason, n_candidates), one row per article.

    ``articles``: article_id, title (cleaned), journal, year; ``works``: id, title, venue, published, cited.
    """
    return verdicts(articles, scored(articles, works, pairs), least)


def verdicts(articles: DataFrame, rows: DataFrame, least: float = LEAST_CONFIDENCE) -> DataFrame:
    """The same from scored pairs."""
    best = rows.groupBy("article_id").agg(F.max("score").alias("score"), F.max_by("id", _RANK()).alias("work"), F.count(F.lit(1)).alias("n"))
    out = articles.select("article_id", "title").join(best, "article_id", "left")
    titled = F.coalesce(F.trim("title") != "", F.lit(False))
    sure = F.coalesce(F.col("score") >= least, F.lit(False)) & titled
    reason = F.when(~titled, F.lit("empty_cleaned_scholar_title")).when(F.col("work").isNull(), F.lit("no_candidates")).when(~sure, F.lit("low_confidence_match"))
    return out.select(
        "article_id", F.when(sure, F.lit("resolved")).otherwise(F.lit("unresolved")).alias("status"), F.round(F.coalesce("score", F.lit(0.0)), 4).alias("confidence"),
        F.when(sure, F.col("work")).alias("work_id"), reason.alias("reason"), F.coalesce("n", F.lit(0)).alias("n_candidates"),
    )


def candidate_lists(rows: DataFrame, most: int = SEARCHED) -> DataFrame:
    """(article_id, id, confidence, place): each article's candidates from the best on, ``most`` of them."""
    by = Window.partitionBy("article_id").orderBy(F.col("score").desc(), F.coalesce("cited", F.lit(-1)).desc(), F.xxhash64("id"))
    ranked = rows.withColumn("place", F.row_number().over(by)).where(F.col("place") <= most)
    return ranked.select("article_id", "id", F.round("score", 4).alias("confidence"), "place")
