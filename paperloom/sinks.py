"""Bounded results as JSON documents, large ones as partitioned Parquet."""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import datetime, timezone
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import files
from .functions.ids import bucket_of

#: Buckets by topic while staging, and of the index by id.
TOPIC_BUCKETS, ID_BUCKETS = 64, 4096


def write_json(path: str | Path, payload: Any) -> None:
    files.write_text(path, json.dumps(payload, indent=2, ensure_ascii=False) + "\n")


def write_json_atomic(path: str | Path, payload: Any) -> None:
    """With keys in order: what is compared later."""
    files.write_text(path, json.dumps(payload, indent=2, ensure_ascii=False, sort_keys=True) + "\n")


def now() -> str:
    return datetime.now(timezone.utc).isoformat()


def sample_document(papers: list[dict], config, hierarchy: dict | None, query: dict, source: str = "works snapshot") -> dict:
    """The document of one sample: a count of papers that the configuration bounds, and how they were found."""
    return {"metadata": {"generated_at": now(), "source": source, "config": config.public(), "resolved_topic_hierarchy": hierarchy, "query": query}, "papers": papers}


def write_sample(path: str | Path, papers: DataFrame, config, hierarchy: dict | None, query: dict) -> dict:
    document = sample_document([row.asDict(recursive=True) for row in papers.toLocalIterator()], config, hierarchy, query)
    write_json(path, document)
    return document


def write_parents(out: str | Path, parents: dict[str, dict], slugs: dict[str, str], *lists: Iterable[tuple[str, list[dict]]]) -> None:
    """A folder for each parent with its record, earlier papers and references. ``lists`` give (key, papers) of one parent
    after the other, so one parent's papers are in memory at a time; ``slugs`` name the keys' folders."""
    for slug, record in parents.items():
        write_json(Path(out) / slug / f"{slug}.json", record)
    for kind, given in zip(("papers_before", "references"), lists, strict=True):
        missing = dict(slugs)
        for key, papers in given:
            slug = missing.pop(key)
            write_json(Path(out) / slug / f"{kind}_{slug}.json", papers)
        for slug in missing.values():
            write_json(Path(out) / slug / f"{kind}_{slug}.json", [])


def write_topic_partitions(works: DataFrame, path: str, topic_id: str = "topic_id", *, compression: str = "zstd", mode: str = "overwrite") -> None:
    """One folder per topic, rows by date and id. Only the topics that ``works`` has are overwritten.

    Partitions are rebalanced by topic: adaptive execution splits those of hot topics by their size, so none is one task's.
    """
    rows = works.hint("rebalance", topic_id).sortWithinPartitions(topic_id, "publication_date", "id")
    rows.write.mode(mode).option("compression", compression).option("partitionOverwriteMode", "dynamic").partitionBy(topic_id).parquet(path)


def write_id_index(works: DataFrame, path: str, *, buckets: int = ID_BUCKETS, compression: str = "zstd") -> None:
    """(id, topic_id) in folders by a hash of the id."""
    rows = works.select("id", "topic_id").withColumn("id_bucket", bucket_of(F.col("id"), buckets))
    rows.repartition("id_bucket").sortWithinPartitions("id_bucket", "id").write.mode("overwrite").option("compression", compression).partitionBy("id_bucket").parquet(path)
