"""Queries over a snapshot in both layouts, written and built in the shared folder once per state of the works table."""

from __future__ import annotations

import functools
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import files
from ..functions.ids import segment_after_slash, work_key
from ..runtime import shared_folder
from ..sinks import write_json
from ..sources import snapshot
from ..sources.tables import table
from ..streaming import builder


def of_works(schema: str):
    """No works make no snapshot: the query then has no rows."""

    def wrap(query):
        @functools.wraps(query)
        def run(spark: SparkSession, d: str) -> DataFrame:
            return spark.createDataFrame([], schema) if table(spark, d, "works").isEmpty() else query(spark, d)

        return run

    return wrap


def delivered(spark: SparkSession, d: str) -> str:
    """The works table as a snapshot by month of delivery, with its manifest; its path."""
    works = table(spark, d, "works")
    facts = works.agg(F.count(F.lit(1)).alias("n"), F.max("updated_date").cast("string").alias("date")).first()
    path = f"{shared_folder(spark)}/snapshot-{hashlib.sha256(f'{d} {facts.n} {facts.date}'.encode()).hexdigest()[:16]}"
    if not files.exists(f"{path}/manifest.json"):  # written last
        rows = works.select(*snapshot.WORKS.fieldNames(), F.date_trunc("month", "updated_date").cast("date").alias("updated_date"))
        rows.hint("rebalance", "updated_date").write.mode("overwrite").partitionBy("updated_date").parquet(path)
        write_json(f"{path}/manifest.json", {"date": facts.date or "none", "format": "parquet", "entity": "works", "record_count": facts.n})
    return path


def built(spark: SparkSession, d: str) -> str:
    """Its topic partitions and index; a build that is done is kept."""
    source = delivered(spark, d)
    builder.build(spark, source, f"{source}-built")
    return f"{source}-built"


@of_works("type string, language string, n bigint, last string")
def deliveries(spark: SparkSession, d: str) -> DataFrame:
    """Works delivered by type and language, from the snapshot by date."""
    path = delivered(spark, d)
    snapshot.inventory(path)
    return snapshot.read_updates(spark, path).groupBy("type", "language").agg(F.count(F.lit(1)).alias("n"), F.max("publication_date").cast("string").alias("last"))


@of_works("topic_id string, n bigint, first string, last string")
def topic_partitions(spark: SparkSession, d: str) -> DataFrame:
    """Works of every topic partition."""
    data = spark.read.parquet(f"{built(spark, d)}/data")
    return data.groupBy(F.col("topic_id").cast("string").alias("topic_id")).agg(F.count(F.lit(1)).alias("n"), F.min("publication_date").cast("string").alias("first"), F.max("publication_date").cast("string").alias("last"))


@of_works("topic_id string, id string, published string")
def hottest_topic(spark: SparkSession, d: str) -> DataFrame:
    """All works of the topic with the most, read from its partition alone."""
    path = built(spark, d)
    top = spark.read.parquet(f"{path}/data").groupBy("topic_id").count().orderBy(F.col("count").desc(), "topic_id").first()
    return snapshot.read_topic(spark, path, top.topic_id).select("topic_id", "id", F.col("publication_date").cast("string").alias("published"))


@of_works("id string, topic_id string")
def indexed_topics(spark: SparkSession, d: str) -> DataFrame:
    """Topics of the works whose number is divisible by 20, found by the index."""
    ids = table(spark, d, "works").where(F.pmod(F.substring(work_key(F.col("id")), 2, 18).cast("bigint"), F.lit(20)) == 0)
    return snapshot.lookup_topics(spark, built(spark, d), ids).select("id", F.nullif("topic_id", F.lit("")).alias("topic_id"))


@of_works("layout string, record_count bigint, topic_count bigint")
def build_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Rows and topics that the finished build counts."""
    manifest = snapshot.validate(built(spark, d))
    return spark.createDataFrame([(manifest["layout"], manifest["record_count"], manifest["topic_count"])], "layout string, record_count bigint, topic_count bigint")


@of_works("topic_id string, year int, n bigint")
def staged_rows(spark: SparkSession, d: str) -> DataFrame:
    """What the builder stages: works with id, abstract and topic, by topic and year."""
    rows = builder.staged(snapshot.read_updates(spark, delivered(spark, d)))
    return rows.groupBy("topic_id", F.year("publication_date").alias("year")).agg(F.count(F.lit(1)).alias("n"))


_TOPIC = "regexp_extract(primary_topic.id, '([^/]+)$', 1)"
_KEPT = "id IS NOT NULL AND abstract_inverted_index IS NOT NULL AND primary_topic.id IS NOT NULL"
SQL = {
    "deliveries": "SELECT type, language, count(*) AS n, CAST(max(publication_date) AS VARCHAR) AS last FROM works GROUP BY 1, 2",
    "staged_rows": f"SELECT {_TOPIC} AS topic_id, CAST(year(publication_date) AS INTEGER) AS year, count(*) AS n FROM works WHERE {_KEPT} GROUP BY 1, 2",
    "topic_partitions": f"SELECT nullif({_TOPIC}, '') AS topic_id, count(*) AS n, CAST(min(publication_date) AS VARCHAR) AS first, CAST(max(publication_date) AS VARCHAR) AS last FROM works WHERE {_KEPT} GROUP BY 1",
    "hottest_topic": f"WITH w AS (SELECT {_TOPIC} AS topic_id, id, CAST(publication_date AS VARCHAR) AS published FROM works WHERE {_KEPT}) SELECT * FROM w WHERE topic_id = (SELECT topic_id FROM w WHERE topic_id <> '' GROUP BY 1 ORDER BY count(*) DESC, topic_id LIMIT 1)",
    "indexed_topics": f"SELECT id, nullif({_TOPIC}, '') AS topic_id FROM works WHERE {_KEPT} AND CAST(regexp_extract(id, '(?:^|[^0-9A-Za-z])[Ww]([0-9]+)(?:[^0-9A-Za-z]|$)', 1) AS BIGINT) % 20 = 0",
    "build_manifest": f"SELECT 'primary_topic' AS layout, count(*) AS record_count, count(DISTINCT nullif({_TOPIC}, '')) AS topic_count FROM works WHERE {_KEPT}",
}
QUERIES = {f.__name__: f for f in (deliveries, staged_rows, topic_partitions, hottest_topic, indexed_topics, build_manifest)}
