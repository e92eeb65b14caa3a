"""Queries of the training-data operators, with SQL where it can express them."""

from __future__ import annotations

import uuid
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import WORK_PATTERN, work_key
from ..runtime import settle, shared_folder
from ..sources.tables import table
from . import encode, language, linkage, mixture, near_duplicates, sentences, stable_sample


def _wkey(c: str) -> str:
    return f"(CASE WHEN regexp_extract({c}, '{WORK_PATTERN}', 1) <> '' THEN 'W' || regexp_extract({c}, '{WORK_PATTERN}', 1) END)"


# ---------------------------------------------------------------- matching without keys


def p1_links(spark: SparkSession, d: str) -> DataFrame:
    """The work of every Scholar article that has one, with confidence."""
    works, key = table(spark, d, "works"), work_key(F.col("id")).alias("work_id")
    one = works.select(key, "display_name", "publication_date").where(F.col("work_id").isNotNull()).groupBy("work_id")
    one = one.agg(F.max("display_name").alias("title"), F.year(F.min("publication_date")).alias("year"))
    places = F.concat(F.array("primary_location"), F.coalesce("locations", F.array().cast(works.schema["locations"].dataType)))
    named = F.flatten(F.transform(places, lambda p: F.array(p["source"]["display_name"], p["raw_source_name"])))
    venues = works.select(key, F.explode(F.array_distinct(named)).alias("venue"))
    venues = venues.unionByName(table(spark, d, "papers").select(work_key(F.col("work_id")).alias("work_id"), F.col("publication_venue").alias("venue")))
    return linkage.link(table(spark, d, "scholar_articles"), one, venues)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Scholar articles that denote the same publication as a work."""
    return p1_links(spark, d).select("article_id", "work_id")


# ---------------------------------------------------------------- stable samples


def p3_sample(spark: SparkSession, d: str) -> DataFrame:
    """The sample of every configuration with a seed, from weights stored in the shared folder (here of one run)."""
    matching = stable_sample.matching(table(spark, d, "works"), table(spark, d, "fetch_configs"), work_key(F.col("id")))
    return stable_sample.select(stable_sample.update(matching, f"{shared_folder(spark)}/weights-{uuid.uuid4().hex}"))


P3_SAMPLE = f"""
WITH w AS (SELECT {_wkey('id')} AS work_id, * EXCLUDE (id) FROM works WHERE abstract_inverted_index IS NOT NULL),
m AS (SELECT c.config_id, w.work_id, c.sample_seed AS seed, c.count / 1000.0::DOUBLE AS rate,
  1.0::DOUBLE + least(greatest(coalesce(w.cited_by_count, 0), 0), 100) / 100.0::DOUBLE AS weight
  FROM w JOIN fetch_configs c ON w.type = c.work_type AND w.language = c.language
    AND lower(w.primary_topic.domain.display_name) = lower(c.domain) AND lower(w.primary_topic.field.display_name) = lower(c.field)
    AND lower(w.primary_topic.subfield.display_name) = lower(c.subfield) AND lower(w.primary_topic.display_name) = lower(c.topic)
  WHERE w.work_id IS NOT NULL AND c.sample_seed IS NOT NULL AND w.publication_date >= CAST(c.from_publication_date AS DATE)
    AND (c.to_publication_date IS NULL OR w.publication_date <= CAST(c.to_publication_date AS DATE))),
s AS (SELECT config_id, work_id, any_value(seed) AS seed, any_value(rate) AS rate, max(weight) AS weight FROM m GROUP BY 1, 2)
SELECT config_id, work_id, weight FROM s
WHERE CAST('0x' || substr(md5(work_id || ':' || CAST(seed AS VARCHAR)), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE < weight * rate"""

# ---------------------------------------------------------------- languages


def _papers(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, language.Model]:
    """Papers with the key of their work, the languages of works, and a model adapted to the papers."""
    samples = language.labelled_samples(table(spark, d, "language_samples"))
    papers = table(spark, d, "papers").select("paper_id", work_key(F.col("work_id")).alias("key"), "abstract")
    works = table(spark, d, "works").select(work_key(F.col("id")).alias("key"), "language")
    # A bounded sample of labelled papers, the same in every run; all papers are then classified.
    some = papers.where(F.col("abstract").isNotNull()).select("paper_id", "key", F.substring("abstract", 1, 5 * language.SAMPLE_CHARS).alias("text"))
    some = some.orderBy(F.xxhash64("paper_id"), "paper_id").limit(language.ADAPT_TEXTS)  # bounded in rows and in each row
    named = works.join(F.broadcast(some), "key").groupBy("paper_id").agg(F.max(language.label_code(F.col("language"))).alias("code"), F.max("text").alias("text"))
    labelled = [(r.code, r.text) for r in named.where(F.col("code").isNotNull()).orderBy(F.xxhash64("paper_id"), "paper_id").collect()]  # at most ADAPT_TEXTS
    return papers, works, language.adapt(language.fit(samples, calibrated=False), samples, labelled)


def _identified(spark: SparkSession, d: str) -> DataFrame:
    """Languages of every paper's abstract, next to the label of its work."""
    papers, works, model = _papers(spark, d)
    labels = works.groupBy("key").agg(F.max("language").alias("label"))
    return language.identify(papers, "abstract", ["paper_id", "key"], model).join(labels, "key", "left")


def p6_languages(spark: SparkSession, d: str) -> DataFrame:
    """Every language of every abstract with its confidence, set against the label of the work; ``und`` is none known."""
    return _identified(spark, d).select("paper_id", "lang", "confidence", "n_sentences", "label", (language.label_code(F.col("label")) == F.col("lang")).alias("agrees"))


def p6_segments(spark: SparkSession, d: str) -> DataFrame:
    """Every segment of every abstract in one language: its place, the language and the confidence."""
    papers, _, model = _papers(spark, d)
    return language.segments(papers.select("paper_id", "abstract"), "abstract", ["paper_id"], model)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Languages of abstracts whose label is missing or wrong, or that hold several."""
    known = _identified(spark, d).where(F.col("lang") != language.UNKNOWN)
    several = known.groupBy("paper_id", "label").agg(F.collect_set("lang").alias("langs"))  # no more than there are models
    agrees = F.coalesce(language.label_code(F.col("label")) == F.col("langs")[0], F.lit(False))
    return several.where((F.size("langs") > 1) | ~agrees).select("paper_id", F.explode("langs").alias("lang"))


# ---------------------------------------------------------------- near-duplicates

#: What counts as near for papers: shared runs of three words, with at least twenty words in the abstract.
NEAR, RUN, LEAST_WORDS = Fraction(3, 5), 3, 20


def _paper_sets(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    works = table(spark, d, "works").select(work_key(F.col("id")).alias("key"), "display_name").groupBy("key").agg(F.max("display_name").alias("name"))
    papers = table(spark, d, "papers").select("paper_id", work_key(F.col("work_id")).alias("key"), "abstract")
    papers = papers.where(F.size(near_duplicates.words(F.col("abstract"))) >= LEAST_WORDS)  # texts are shuffled, not their words: they take less
    row = F.concat(F.coalesce(near_duplicates.words(F.col("name")), F.array()), near_duplicates.words(F.col("abstract")))
    named = papers.join(works, "key", "left").select(F.col("paper_id").alias("id"), row.alias("row"))
    members, sets = near_duplicates.classes(named.select("id", near_duplicates.shingles(F.col("row"), RUN).alias("shingles")))
    return members, sets, near_duplicates.similar_pairs(sets, NEAR)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of papers whose names and abstracts are nearly the same."""
    members, _, pairs = _paper_sets(spark, d)
    return near_duplicates.expand(pairs, members).select(F.col("id_a").alias("paper_a"), F.col("id_b").alias("paper_b"))


def p7_groups(spark: SparkSession, d: str) -> DataFrame:
    """Every paper with its group, the class of equal texts it belongs to and that class's links to others."""
    members, _, pairs = _paper_sets(spark, d)
    pairs = settle(pairs, "pairs")
    groups = near_duplicates.components(pairs)
    links = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).groupBy("rep").agg(F.count(F.lit(1)).alias("links"))
    known = members.join(groups.withColumnRenamed("id", "rep"), "rep", "left").join(links, "rep", "left")
    every = table(spark, d, "papers").select(F.col("paper_id").alias("id")).join(known, "id", "left")
    rep = F.coalesce("rep", "id")
    return every.select(F.col("id").alias("paper_id"), F.coalesce("group", rep).alias("group_id"), rep.alias("class_id"), F.coalesce("links", F.lit(0)).alias("n_links"))


P7_FOUND = f"""
WITH w AS (SELECT {_wkey('id')} AS key, max(display_name) AS name FROM works GROUP BY 1),
p AS (SELECT paper_id, {_wkey('work_id')} AS key, regexp_extract_all(lower(abstract), '[\\pL\\pN]+') AS own FROM papers),
r AS (SELECT paper_id, list_concat(coalesce(regexp_extract_all(lower(name), '[\\pL\\pN]+'), []), own) AS ws FROM p LEFT JOIN w USING (key) WHERE len(own) >= 20),
i AS (SELECT paper_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM r),
s AS (SELECT DISTINCT paper_id, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM i),
n AS (SELECT paper_id, count(*) AS n FROM s GROUP BY 1),
j AS (SELECT x.paper_id AS paper_a, y.paper_id AS paper_b, count(*) AS k FROM s x JOIN s y ON x.a = y.a AND x.b = y.b AND x.c = y.c AND x.paper_id < y.paper_id GROUP BY 1, 2)
SELECT paper_a, paper_b FROM j JOIN n na ON na.paper_id = paper_a JOIN n nb ON nb.paper_id = paper_b WHERE 5 * k >= 3 * (na.n + nb.n - k)"""

#: Classes of equal sets, links between classes, and the least paper that a class is linked with by any chain.
P7_GROUPS = P7_FOUND.replace("WITH w AS", "WITH RECURSIVE w AS").rpartition("SELECT paper_a")[0].rstrip().replace(
    "j AS (SELECT x.paper_id", "c AS (SELECT paper_id, md5(string_agg(a || ' ' || b || ' ' || c, '|' ORDER BY a, b, c)) AS m FROM s GROUP BY 1),\nk AS (SELECT paper_id, min(paper_id) OVER (PARTITION BY m) AS rep FROM c),\nj AS (SELECT x.paper_id"
) + """,
e AS (SELECT paper_a AS a, paper_b AS b FROM j JOIN n na ON na.paper_id = paper_a JOIN n nb ON nb.paper_id = paper_b WHERE 5 * k >= 3 * (na.n + nb.n - k) AND paper_a IN (SELECT rep FROM k) AND paper_b IN (SELECT rep FROM k)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT DISTINCT a AS x, a AS y FROM both_ways UNION SELECT r.x, t.b FROM reach r JOIN both_ways t ON r.y = t.a),
g AS (SELECT x AS rep, min(y) AS grp FROM reach GROUP BY 1),
l AS (SELECT a AS rep, count(*) AS links FROM both_ways GROUP BY 1)
SELECT paper_id, coalesce(grp, rep, paper_id) AS group_id, coalesce(rep, paper_id) AS class_id, coalesce(links, 0) AS n_links FROM papers LEFT JOIN k USING (paper_id) LEFT JOIN g USING (rep) LEFT JOIN l USING (rep)"""

# ---------------------------------------------------------------- token ids


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document."""
    return encode.encode_texts(table(spark, d, "documents").select("doc_id", "text"), "text")


# ---------------------------------------------------------------- mixing


def _mixed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return mixture.mixed_documents(table(spark, d, "documents"), table(spark, d, "source_weights"), lambda df: encode.count_tokens(df, "text"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """How often every document that takes part is used."""
    return _mixed(spark, d)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual shares of the mix."""
    return mixture.report(*_mixed(spark, d))


# ---------------------------------------------------------------- sentences


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """The end of every sentence of every document."""
    return sentences.sentence_ends(table(spark, d, "documents"), "text", ["doc_id"])


QUERIES = {f.__name__: f for f in (p1_found, p1_links, p3_sample, p6_found, p6_languages, p6_segments, p7_found, p7_groups, p8_ids, p9_mix, p9_shares, p10_found)}
SQL = {"p3_sample": P3_SAMPLE, "p7_found": P7_FOUND, "p7_groups": P7_GROUPS}
