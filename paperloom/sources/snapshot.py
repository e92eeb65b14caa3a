"""Snapshots of works: by update date as delivered, or by topic as built here; checked before they are read."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import files
from ..functions.ids import bucket_of
from ..sinks import ID_BUCKETS


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S = T.StringType()
_NODE = _struct(id=_S, display_name=_S)
_PLACE = _struct(source=_struct(display_name=_S), raw_source_name=_S)
#: The columns that are kept of a work.
WORKS = _struct(
    id=_S, doi=_S, display_name=_S, abstract_inverted_index=_S, publication_date=T.DateType(), language=_S, type=_S,
    primary_topic=_struct(id=_S, display_name=_S, score=T.FloatType(), subfield=_NODE, field=_NODE, domain=_NODE),
    primary_location=_PLACE, locations=T.ArrayType(_PLACE), referenced_works=T.ArrayType(_S), cited_by_count=T.IntegerType(),
)
TOPIC = _struct(id=_S, display_name=_S, subfield=_NODE, field=_NODE, domain=_NODE)
LAYOUTS = ("updated_date", "primary_topic")


class SnapshotError(ValueError):
    """A snapshot that can't be used."""


def validate(path: str | Path) -> dict:
    """The manifest of a snapshot of works in Parquet, with its layout filled in."""
    if not files.is_folder(path):
        raise SnapshotError(f"{path} is no folder")
    try:
        manifest = json.loads(files.read_text(f"{path}/manifest.json"))
    except (OSError, ValueError) as e:
        raise SnapshotError(f"no readable manifest in {path}: {e}") from e
    if not isinstance(manifest, dict):
        raise SnapshotError("a manifest must be a JSON object")
    whole = lambda x: isinstance(x, int) and not isinstance(x, bool) and x >= 0
    checks = [
        (manifest.get("format") == "parquet", "format must be parquet"), (manifest.get("entity") == "works", "entity must be works"),
        (isinstance(manifest.get("date"), str) and manifest["date"].strip() != "", "date is missing"), (whole(manifest.get("record_count")), "record_count must be a whole number"),
        (manifest.get("layout", LAYOUTS[0]) in LAYOUTS, f"layout must be one of {', '.join(LAYOUTS)}"),
    ]
    for holds, message in checks:
        if not holds:
            raise SnapshotError(message)
    return {"layout": LAYOUTS[0]} | manifest


def inventory(path: str | Path) -> list[str]:
    """The snapshot's files in order; their number must be that of the manifest's list, if it has one."""
    found = files.names(path, "updated_date=*/*.parquet")
    listed = validate(path).get("files")
    if not found:
        raise SnapshotError("the snapshot has no files")
    if isinstance(listed, list) and len(listed) != len(found):
        raise SnapshotError(f"the manifest lists {len(listed)} files, {len(found)} are there")
    return found


def read_updates(spark: SparkSession, path: str | Path) -> DataFrame:
    """All deliveries; the folder's date is no column of a work."""
    return spark.read.schema(WORKS).parquet(*[f"{path}/{folder}" for folder in files.names(path, "updated_date=*")])


def read_topic(spark: SparkSession, path: str | Path, topic_id: str) -> DataFrame:
    """The works of one topic: the predicate on the partition column keeps Spark from the others' files."""
    if not topic_id or any(c in topic_id for c in "/\\") or topic_id in (".", ".."):
        raise SnapshotError(f"{topic_id!r} is no topic id")
    works = spark.read.schema(T.StructType([*WORKS.fields, T.StructField("topic_id", T.StringType())])).parquet(f"{path}/data")
    found = works.where(F.col("topic_id") == topic_id)
    if found.isEmpty():
        raise SnapshotError(f"topic {topic_id} has no works")
    return found


def read_catalog(spark: SparkSession, path: str | Path) -> DataFrame:
    topics = json.loads(files.read_text(f"{path}/topics.json"))["topics"]
    return spark.createDataFrame(topics, TOPIC)


def lookup_topics(spark: SparkSession, path: str | Path, ids: DataFrame, buckets: int = ID_BUCKETS) -> DataFrame:
    """(id, topic_id) of works by the index: joined on bucket and id, so only the buckets asked for are read."""
    index = spark.read.parquet(f"{path}/work-id-index")
    asked = ids.select("id").distinct().withColumn("id_bucket", bucket_of(F.col("id"), buckets))
    return index.join(asked, ["id_bucket", "id"]).select("id", "topic_id")
