"""Queries of the general data-pipeline operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import TOPIC_PATTERN, VISIBLE, WORK_PATTERN, has_text, topic_key, work_key
from ..operators import keyed, nested, orphans
from ..sources.tables import table

#: A topic is hot from this share of all rows on.
HOT_SHARE = 0.05
SAMPLE = 5

# ---------------------------------------------------------------- references to missing records


def _work_events(spark: SparkSession, d: str) -> DataFrame:
    works, deleted = table(spark, d, "works"), table(spark, d, "deleted_works")
    delivered = orphans.deliveries(works, work_key(F.col("id")), F.col("updated_date"), F.transform("referenced_works", work_key))
    return delivered.unionByName(orphans.deletions(deleted, work_key(F.col("work_id")), F.col("deleted_date")))


def _work_state(spark: SparkSession, d: str, *others: DataFrame) -> DataFrame:
    return orphans.fold(orphans.deltas(_work_events(spark, d)), *others)


def _references(spark: SparkSession, d: str) -> DataFrame:
    return (
        table(spark, d, "works")
        .select(F.date_format("updated_date", "yyyy-MM").alias("period"), work_key(F.col("id")).alias("work_id"), F.explode("referenced_works").alias("r"))
        .select("period", "work_id", work_key(F.col("r")).alias("ref_id"))
        .where(F.col("ref_id").isNotNull())
    )


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """References of works to works that are not, or no longer, there."""
    found = orphans.orphan_references(_references(spark, d), _work_state(spark, d), "ref_id", "work_id")
    return found.distinct()


def p2_current(spark: SparkSession, d: str) -> DataFrame:
    """Missing works that works refer to now, after all deliveries and deletions, and how many do."""
    return orphans.orphan_keys(_work_state(spark, d)).select(F.col("key").alias("ref_id"), F.col("refs").alias("n_references"))


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphan references per table and month: works by delivery, papers by publication, documents by arrival."""
    papers = table(spark, d, "papers").select(
        F.lit("papers").alias("table"), F.substring("publication_date", 1, 7).alias("period"), F.col("paper_id").cast("string").alias("source_id"), work_key(F.col("work_id")).alias("ref_id")
    )
    documents = table(spark, d, "documents").select(
        F.lit("documents").alias("table"), F.date_format("added_at", "yyyy-MM").alias("period"), F.col("doc_id").cast("string").alias("source_id"), work_key(F.col("work_id")).alias("ref_id")
    )
    works = _references(spark, d).select(F.lit("works").alias("table"), "period", F.col("work_id").alias("source_id"), "ref_id")
    others = papers.unionByName(documents).where(F.col("ref_id").isNotNull())
    state = _work_state(spark, d, orphans.mentions(others, F.col("ref_id")))
    found = orphans.orphan_references(works.unionByName(others), state, "ref_id", "source_id").distinct()
    by_ref = found.groupBy("table", "period", "ref_id").agg(F.count(F.lit(1)).alias("n"))
    return by_ref.groupBy("table", "period").agg(F.sum("n").alias("n_references"), F.count(F.lit(1)).alias("n_missing"))


def _wkey(c: str) -> str:
    return f"(CASE WHEN regexp_extract({c}, '{WORK_PATTERN}', 1) <> '' THEN 'W' || regexp_extract({c}, '{WORK_PATTERN}', 1) END)"


def _tkey(c: str) -> str:
    return f"(CASE WHEN regexp_extract({c}, '{TOPIC_PATTERN}', 1) <> '' THEN 'T' || regexp_extract({c}, '{TOPIC_PATTERN}', 1) END)"


_P2 = f"""
WITH present AS (SELECT {_wkey('id')} AS k, max(updated_date) AS last FROM works GROUP BY 1),
gone AS (SELECT {_wkey('work_id')} AS k, max(deleted_date) AS at FROM deleted_works GROUP BY 1),
alive AS (SELECT p.k FROM present p LEFT JOIN gone g ON p.k = g.k WHERE p.k IS NOT NULL AND (g.at IS NULL OR p.last > g.at)),
entries AS (SELECT strftime(updated_date, '%Y-%m') AS period, {_wkey('id')} AS work_id, unnest(referenced_works) AS r FROM works),
refs AS (SELECT period, work_id, {_wkey('r')} AS ref_id FROM entries)"""

P2_FOUND = _P2 + """
SELECT DISTINCT period, work_id, ref_id FROM refs WHERE ref_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM alive WHERE alive.k = ref_id)"""

P2_CURRENT = _P2 + f""",
last AS (SELECT {_wkey('id')} AS k, max(updated_date) AS at FROM works GROUP BY 1),
held AS (SELECT w.rid, w.k, unnest(w.referenced_works) AS r FROM (SELECT row_number() OVER () AS rid, {_wkey('id')} AS k, * FROM works) w LEFT JOIN last l ON w.k = l.k LEFT JOIN gone g ON w.k = g.k
  WHERE w.k IS NULL OR (w.updated_date = l.at AND (g.at IS NULL OR l.at > g.at))),
held_keys AS (SELECT DISTINCT coalesce(k, CAST(rid AS VARCHAR)) AS source, {_wkey('r')} AS ref_id FROM held)
SELECT ref_id, count(*) AS n_references FROM held_keys WHERE ref_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM alive WHERE alive.k = ref_id) GROUP BY 1"""

P2_REPORT = _P2 + f""",
every AS (SELECT 'works' AS "table", period, work_id AS source_id, ref_id FROM refs
  UNION ALL SELECT 'papers', substr(publication_date, 1, 7), CAST(paper_id AS VARCHAR), {_wkey('work_id')} FROM papers
  UNION ALL SELECT 'documents', strftime(added_at, '%Y-%m'), CAST(doc_id AS VARCHAR), {_wkey('work_id')} FROM documents),
found AS (SELECT DISTINCT * FROM every WHERE ref_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM alive WHERE alive.k = ref_id))
SELECT "table", period, count(*) AS n_references, count(DISTINCT ref_id) AS n_missing FROM found GROUP BY 1, 2"""

# ---------------------------------------------------------------- hot keys

_TOPIC = lambda: topic_key(F.col("primary_topic.id"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Topics that stand in at least a twentieth of all rows."""
    return keyed.heavy_keys(table(spark, d, "works"), _TOPIC(), HOT_SHARE, "topic_id").select("topic_id")


def p4_topics(spark: SparkSession, d: str) -> DataFrame:
    """Counts, date ranges and sums of every topic."""
    return keyed.per_key(
        table(spark, d, "works"),
        _TOPIC(),
        {
            "n_rows": F.count(F.lit(1)),
            "n_abstracts": F.count("abstract_inverted_index"),
            "first_publication": F.min("publication_date").cast("string"),
            "last_publication": F.max("publication_date").cast("string"),
            "first_delivery": F.min("updated_date").cast("string"),
            "last_delivery": F.max("updated_date").cast("string"),
            "citations": F.sum(F.col("cited_by_count").cast("bigint")),
        },
        "topic_id",
    )


def p4_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Exact number of works of every topic, however often each was delivered."""
    return keyed.distinct_per_key(table(spark, d, "works"), _TOPIC(), work_key(F.col("id")), "topic_id").withColumnRenamed("items", "n_works")


def p4_sample(spark: SparkSession, d: str) -> DataFrame:
    """A reproducible sample of works of every topic."""
    return keyed.sample_per_key(table(spark, d, "works"), _TOPIC(), work_key(F.col("id")), SAMPLE, 42, "topic_id").withColumnRenamed("item", "work_id")


P4_FOUND = f"SELECT topic_id FROM (SELECT {_tkey('primary_topic.id')} AS topic_id, count(*) AS n FROM works GROUP BY 1) WHERE topic_id IS NOT NULL AND n >= {HOT_SHARE} * (SELECT count(*) FROM works)"
P4_TOPICS = f"""
SELECT * FROM (SELECT {_tkey('primary_topic.id')} AS topic_id, count(*) AS n_rows, count(abstract_inverted_index) AS n_abstracts,
  CAST(min(publication_date) AS VARCHAR) AS first_publication, CAST(max(publication_date) AS VARCHAR) AS last_publication,
  CAST(min(updated_date) AS VARCHAR) AS first_delivery, CAST(max(updated_date) AS VARCHAR) AS last_delivery,
  CAST(sum(cited_by_count) AS BIGINT) AS citations FROM works GROUP BY 1) WHERE topic_id IS NOT NULL"""
P4_DISTINCT = f"SELECT * FROM (SELECT {_tkey('primary_topic.id')} AS topic_id, count(DISTINCT {_wkey('id')}) AS n_works FROM works GROUP BY 1) WHERE topic_id IS NOT NULL AND n_works > 0"
P4_SAMPLE = f"""
WITH pairs AS (SELECT DISTINCT {_tkey('primary_topic.id')} AS topic_id, {_wkey('id')} AS work_id FROM works),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY topic_id ORDER BY md5(work_id || ':42'), work_id) AS INTEGER) AS place FROM pairs WHERE topic_id IS NOT NULL AND work_id IS NOT NULL)
SELECT topic_id, work_id, place FROM ranked WHERE place <= {SAMPLE}"""

# ---------------------------------------------------------------- nested records

_PLACE = {"name": "source.display_name", "raw_name": "raw_source_name"}
_NODE = {"id": "id", "name": "display_name"}
#: Child tables of a work; "primary" and "elements" together are the locations.
SPECS = {
    "primary": ("primary_location", _PLACE),
    "elements": ("locations[]", _PLACE),
    "topic": ("primary_topic", _NODE | {"score": "score"}),
    "subfield": ("primary_topic.subfield", _NODE),
    "field": ("primary_topic.field", _NODE),
    "domain": ("primary_topic.domain", _NODE),
}
_PARENT = {"location": "work", "topic": "work", "subfield": "topic", "field": "subfield", "domain": "field"}


def works_children(spark: SparkSession, d: str) -> DataFrame:
    """Linked child rows of every row of works: its id and date, the child's table, parent table and place."""
    records = table(spark, d, "works").select(
        work_key(F.col("id")).alias("work_id"), "updated_date", F.to_json(F.struct("primary_location", "locations", "primary_topic"), {"ignoreNullFields": "false"}).alias("json")
    )
    rows = nested.flatten_json(records, "json", ["work_id", "updated_date"], SPECS)
    child = F.when(F.col("child").isin("primary", "elements"), "location").otherwise(F.col("child"))
    return rows.withColumn("child", child)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Children of works that hold a name or an id, with their place."""
    rows = works_children(spark, d)
    named = F.when(F.col("child") == "location", has_text(F.col("name")) | has_text(F.col("raw_name"))).otherwise(has_text(F.col("id")) | has_text(F.col("name")))
    return rows.where(named & F.col("work_id").isNotNull()).select("work_id", "child", "pos").distinct()


def p5_locations(spark: SparkSession, d: str) -> DataFrame:
    """The flat table of locations, one row per delivery and place."""
    rows = works_children(spark, d).where(F.col("child") == "location")
    return rows.select("work_id", F.col("updated_date").cast("string").alias("delivered"), "pos", "name", "raw_name")


def p5_topics(spark: SparkSession, d: str) -> DataFrame:
    """The flat tables of topics, subfields, fields and domains, each row with its parent table."""
    rows = works_children(spark, d).where(F.col("child") != "location")
    parents = F.create_map(*(F.lit(x) for pair in _PARENT.items() for x in pair))
    return rows.select("work_id", F.col("updated_date").cast("string").alias("delivered"), "child", parents[F.col("child")].alias("parent"), "id", "name")


_TEXT = lambda c: f"coalesce(regexp_matches({c}, '{VISIBLE}'), false)"
P5_FOUND = f"""
WITH place AS (
  SELECT {_wkey('id')} AS work_id, 'location' AS child, 0 AS pos, primary_location AS l FROM works
  UNION ALL SELECT {_wkey('id')}, 'location', i, locations[i] FROM (SELECT id, locations, unnest(range(1, len(locations) + 1)) AS i FROM works)),
node AS (
  SELECT {_wkey('id')} AS work_id, 'topic' AS child, primary_topic.id AS id, primary_topic.display_name AS name FROM works
  UNION ALL SELECT {_wkey('id')}, 'subfield', primary_topic.subfield.id, primary_topic.subfield.display_name FROM works
  UNION ALL SELECT {_wkey('id')}, 'field', primary_topic.field.id, primary_topic.field.display_name FROM works
  UNION ALL SELECT {_wkey('id')}, 'domain', primary_topic.domain.id, primary_topic.domain.display_name FROM works)
SELECT DISTINCT work_id, child, CAST(pos AS INTEGER) AS pos FROM place
  WHERE work_id IS NOT NULL AND ({_TEXT('l.source.display_name')} OR {_TEXT('l.raw_source_name')})
UNION ALL SELECT DISTINCT work_id, child, CAST(0 AS INTEGER) FROM node WHERE work_id IS NOT NULL AND ({_TEXT('id')} OR {_TEXT('name')})"""
P5_LOCATIONS = f"""
SELECT {_wkey('id')} AS work_id, CAST(updated_date AS VARCHAR) AS delivered, CAST(0 AS INTEGER) AS pos, primary_location.source.display_name AS name, primary_location.raw_source_name AS raw_name
  FROM works WHERE primary_location IS NOT NULL
UNION ALL SELECT {_wkey('id')}, CAST(updated_date AS VARCHAR), CAST(i AS INTEGER), locations[i].source.display_name, locations[i].raw_source_name
  FROM (SELECT id, updated_date, locations, unnest(range(1, len(locations) + 1)) AS i FROM works) WHERE locations[i] IS NOT NULL"""
P5_TOPICS = " UNION ALL ".join(
    f"SELECT {_wkey('id')} AS work_id, CAST(updated_date AS VARCHAR) AS delivered, '{child}' AS child, '{_PARENT[child]}' AS parent, {path}.id AS id, {path}.display_name AS name FROM works WHERE {path} IS NOT NULL"
    for child, path in [("topic", "primary_topic"), *((c, f"primary_topic.{c}") for c in ("subfield", "field", "domain"))]
)

QUERIES = {f.__name__: f for f in (p2_found, p2_current, p2_report, p4_found, p4_topics, p4_distinct, p4_sample, p5_found, p5_locations, p5_topics)}
SQL = {
    "p2_found": P2_FOUND, "p2_current": P2_CURRENT, "p2_report": P2_REPORT, "p4_found": P4_FOUND, "p4_topics": P4_TOPICS, "p4_distinct": P4_DISTINCT, "p4_sample": P4_SAMPLE,
    "p5_found": P5_FOUND, "p5_locations": P5_LOCATIONS, "p5_topics": P5_TOPICS,
}
