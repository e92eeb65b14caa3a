"""The topic hierarchy: lookup of exact paths, levels of a work, distinct topics.

Defined results: names are compared case-folded for one lookup and lower-cased in plans; no
match or several is an error for a single lookup and no row in a join; missing levels are null in the lenient form.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ids import last_segment
from ..functions.names import safe_path_name

LEVELS = ("domain", "field", "subfield", "topic")


class TopicError(LookupError):
    """No topic of a path, or several."""


@F.pandas_udf(T.StringType())
def folded(names: pd.Series) -> pd.Series:
    return names.str.casefold()


def find_topic(catalog: DataFrame, config) -> dict:
    """The only topic of the configuration's path, as ``{level: {id, display_name}}``.

    Names are folded in Arrow batches, where Spark's lower case wouldn't do; only topics of the path come to the driver, and
    of these no more than tell that there are several.
    """
    on = F.lit(True)
    for level in LEVELS:
        on &= folded(F.col("display_name" if level == "topic" else f"{level}.display_name")) == F.lit(getattr(config, level).casefold())
    found = catalog.where(on).dropDuplicates(["id"]).limit(2).collect()
    if len(found) != 1:
        raise TopicError(f"{'several' if found else 'no'} topics have the path {' > '.join(getattr(config, level) for level in LEVELS)}")
    row = found[0]
    return {level: {"id": row[level]["id"], "display_name": row[level]["display_name"]} for level in LEVELS[:3]} | {"topic": {"id": row["id"], "display_name": row["display_name"]}}


def find_field(catalog: DataFrame, name: str) -> str:
    """Id of the only field of that name."""
    ids = [r.id for r in catalog.where(F.lower("field.display_name") == F.lit(name.lower())).select(F.col("field.id").alias("id")).distinct().limit(2).collect()]
    if len(ids) != 1:
        raise TopicError(f"{len(ids)} fields are named {name}")
    return ids[0]


def configs_with_topics(configs: DataFrame, catalog: DataFrame) -> DataFrame:
    """Configurations joined to their topic where it is the only one of its path."""
    names = [F.lower(F.col(f"{level}.display_name")).alias(f"n_{level}") for level in LEVELS[:3]] + [F.lower("display_name").alias("n_topic")]
    paths = catalog.select(F.col("id").alias("topic_id"), *names).distinct()
    paths = paths.groupBy(*(f"n_{level}" for level in LEVELS)).agg(F.min("topic_id").alias("topic_id"), F.count(F.lit(1)).alias("n_topics")).where(F.col("n_topics") == 1)
    configs = configs.drop("topic_id", "n_topics", *(f"n_{level}" for level in LEVELS))  # extra columns of the result's names
    on = [F.lower(configs[level]) == paths[f"n_{level}"] for level in LEVELS]
    return configs.join(paths, on).drop("n_topics", *(f"n_{level}" for level in LEVELS))


def hierarchy(topic: Column, *, strict: bool) -> Column:
    """The four levels of a primary topic. Strict: an error where a level is missing; else nulls, or null without an id."""
    level = lambda c: F.struct(c["id"].alias("id"), c["display_name"].alias("display_name"))
    out = F.struct(*(level(topic[x]).alias(x) for x in LEVELS[:3]), level(topic).alias("topic"))
    if strict:
        there = F.lit(True)
        for c in (*(topic[x] for x in LEVELS[:3]), topic):
            there &= c["id"].isNotNull() & c["display_name"].isNotNull()
        return F.when(there, out).otherwise(F.raise_error(F.lit("a topic level has no id or name")))
    return F.when(topic["id"].isNotNull(), out)


def distinct_topics(works: DataFrame, key: Column) -> DataFrame:
    """Every topic of the works once, without its score; of several spellings the least one."""
    return works.where(key.isNotNull()).groupBy(key.alias("topic_id")).agg(F.min(F.struct("primary_topic.display_name", "primary_topic.id", "primary_topic.subfield", "primary_topic.field", "primary_topic.domain")).alias("topic")).select("topic_id", "topic.*")


def sorted_topics(catalog: DataFrame) -> DataFrame:
    """By subfield and name, lower-cased."""
    return catalog.orderBy(F.lower("subfield.display_name"), F.lower("display_name"), "id")


def valid_topic() -> Column:
    """A topic whose own and upper names are all there."""
    return F.col("id").isNotNull() & F.col("display_name").isNotNull() & F.col("subfield.display_name").isNotNull() & F.col("field.display_name").isNotNull() & F.col("domain.display_name").isNotNull()


def output_paths(catalog: DataFrame) -> DataFrame:
    """``path``: subfield and name as parts of a path; where two are equal, all but the first by id carry their id."""
    parts = catalog.withColumn("folder", safe_path_name(F.col("subfield.display_name"))).withColumn("name", safe_path_name(F.col("display_name")))
    numbered = parts.withColumn("n", F.row_number().over(Window.partitionBy("folder", "name").orderBy("id")))
    name = F.when(F.col("n") > 1, F.concat("name", F.lit(" ("), safe_path_name(last_segment(F.col("id"))), F.lit(")"))).otherwise(F.col("name"))
    return numbered.withColumn("path", F.concat("folder", F.lit("/"), name)).drop("folder", "name", "n")
