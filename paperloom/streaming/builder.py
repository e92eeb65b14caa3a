"""A resumable build of the topic-partitioned snapshot, as a file-source stream with its checkpoint.

Staging is a stream over the deliveries, a few files per micro-batch, run until all are read. Each micro-batch overwrites
its own folder, so a batch that is run again after a crash leaves no row twice; what was read lies in the checkpoint.
Compaction goes bucket by bucket, a few at once: what a bucket's topics hold is overwritten as a whole, then a marker is
written, then the staged input is removed, so a build that broke off goes on with the buckets that have no marker. The index
is one job. The settings of a build are kept as a fingerprint, and a build isn't resumed with others.
"""

from __future__ import annotations

import hashlib
import json
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import files
from ..functions.ids import bucket_of, segment_after_slash
from ..operators.topics import distinct_topics
from ..sinks import ID_BUCKETS, TOPIC_BUCKETS, write_id_index, write_json_atomic, write_topic_partitions
from ..sources.snapshot import WORKS, inventory, validate

PHASES = ("staging", "compacting", "indexing", "complete")


class BuildError(RuntimeError):
    """A build that can't go on."""


def staged(works: DataFrame, buckets: int = TOPIC_BUCKETS) -> DataFrame:
    """Works with id, abstract and topic, with the topic's short id and bucket."""
    topic = segment_after_slash(F.col("primary_topic.id"))
    kept = works.where(F.col("id").isNotNull() & F.col("abstract_inverted_index").isNotNull() & F.col("primary_topic.id").isNotNull())
    return kept.select(*WORKS.fieldNames(), topic.alias("topic_id"), bucket_of(topic, buckets).alias("topic_bucket"))


def fingerprint(source: str | Path, settings: dict[str, Any]) -> dict[str, Any]:
    """What a build depends on: the source's date and files, and the settings."""
    found = inventory(source)
    return {"source_date": validate(source)["date"], "n_files": len(found), "files_digest": hashlib.sha256("\n".join(found).encode()).hexdigest()} | settings


def differences(a: dict, b: dict) -> list[str]:
    return sorted(k for k in {*a, *b} if a.get(k) != b.get(k))


def prepare(out: str | Path, wanted: dict) -> dict:
    """The state to go on from. A finished build of the same date is kept; another's folder or settings are an error."""
    path = f"{out}/_build/state.json"
    if files.exists(path):
        state = json.loads(files.read_text(path))
        if diff := differences(state["fingerprint"], wanted):
            raise BuildError(f"the build in {out} was begun with other settings: {', '.join(diff)}")
        return state
    if files.names(out, "*"):
        raise BuildError(f"{out} holds other files")
    state = {"phase": PHASES[0], "fingerprint": wanted}
    write_json_atomic(path, state)
    return state


def build(
    spark: SparkSession, source: str | Path, output: str | Path, *, files_per_batch: int = 32, compression: str = "zstd", topic_buckets: int = TOPIC_BUCKETS, id_buckets: int = ID_BUCKETS,
    buckets_at_once: int = 8, stop_after: str | None = None,
) -> dict:
    """Build, or go on building, the partitions of a snapshot; the manifest of the finished data set."""
    settings = {"files_per_batch": files_per_batch, "compression": compression, "topic_buckets": topic_buckets, "id_buckets": id_buckets}
    state = prepare(output, fingerprint(source, settings))
    work = f"{output}/_build"

    def done(phase: str) -> None:
        state["phase"] = phase
        write_json_atomic(f"{work}/state.json", state)

    if state["phase"] == "staging":
        stage(spark, source, work, files_per_batch, compression, topic_buckets)
        done("compacting")
        if stop_after == "staging":
            return state
    if state["phase"] == "compacting":
        compact(spark, output, compression, buckets_at_once)
        done("indexing")
        if stop_after == "compacting":
            return state
    if state["phase"] == "indexing":
        write_id_index(spark.read.parquet(f"{output}/data"), f"{output}/work-id-index", buckets=id_buckets, compression=compression)
        state["manifest"] = finalize(spark, output, state["fingerprint"])
        done("complete")
    return state["manifest"]


def completed(work: str) -> dict[int, int]:
    """Rows of the buckets that are compacted."""
    return {int(n.removeprefix("compacted/").removesuffix(".json")): json.loads(files.read_text(f"{work}/{n}"))["rows"] for n in files.names(work, "compacted/*.json")}


def buckets(work: str) -> list[int]:
    """All buckets that are staged or compacted."""
    staged_ = {int(n.rsplit("=", 1)[-1]) for n in files.names(work, "staged/batch=*/topic_bucket=*")}
    return sorted(staged_ | set(completed(work)))


def compact(spark: SparkSession, out: str | Path, compression: str, at_once: int) -> None:
    """Topic partitions of all buckets without a marker; their staged input is removed."""
    work = f"{out}/_build"
    known = completed(work)
    for bucket in known:  # a build may have broken off between marker and removal
        _remove_staged(work, bucket)
    waiting = [b for b in buckets(work) if b not in known]
    if not waiting and not known:
        raise BuildError("staging left no works")
    for start in range(0, len(waiting), at_once):
        some = waiting[start : start + at_once]
        rows = spark.read.parquet(f"{work}/staged").where(F.col("topic_bucket").isin(some))
        counts = {r.topic_bucket: r["count"] for r in rows.groupBy("topic_bucket").count().collect()}  # at_once rows
        write_topic_partitions(rows.drop("batch", "topic_bucket"), f"{out}/data", compression=compression)
        for bucket in some:
            write_json_atomic(f"{work}/compacted/{bucket}.json", {"topic_bucket": bucket, "rows": counts[bucket]})
            _remove_staged(work, bucket)


def _remove_staged(work: str, bucket: int) -> None:
    for name in files.names(work, f"staged/batch=*/topic_bucket={bucket}"):
        files.remove(f"{work}/{name}")


def stage(spark: SparkSession, source: str | Path, work: str, files_per_batch: int, compression: str, buckets: int) -> None:
    stream = spark.readStream.schema(WORKS).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(str(source))

    def write(batch: DataFrame, number: int) -> None:
        rows = staged(batch, buckets).hint("rebalance", "topic_bucket")  # adaptive execution splits the bucket of a hot topic by its size
        rows.write.mode("overwrite").option("compression", compression).partitionBy("topic_bucket").parquet(f"{work}/staged/batch={number}")

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()


def finalize(spark: SparkSession, out: str | Path, made_from: dict) -> dict:
    """Catalog and manifest; the numbers of rows compacted, in the partitions and in the index must be equal."""
    data = spark.read.parquet(f"{out}/data")
    counts = {"compacted": sum(completed(f"{out}/_build").values())} | {name: spark.read.parquet(f"{out}/{path}").count() for name, path in (("data", "data"), ("index", "work-id-index"))}
    if len(set(counts.values())) != 1:
        raise BuildError(f"row counts differ: {counts}")
    topics = distinct_topics(data, F.col("topic_id"))
    entries = [{k: v for k, v in r.asDict(recursive=True).items() if k != "topic_id"} for r in topics.orderBy("topic_id").collect()]  # one row per topic of a catalog
    write_json_atomic(f"{out}/topics.json", {"topics": entries})
    manifest = {
        "format": "parquet", "entity": "works", "layout": "primary_topic", "date": made_from["source_date"], "record_count": counts["data"], "topic_count": len(entries),
        "hash": {"function": "xxhash64", "engine": f"spark {spark.version}", "id_buckets": made_from["id_buckets"], "topic_buckets": made_from["topic_buckets"]},
    }
    write_json_atomic(f"{out}/manifest.json", manifest)
    return manifest
