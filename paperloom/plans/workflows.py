"""Whole runs: a sample of a snapshot, samples of all topics, and Scholar articles with what surrounds their works.

Each run is a few jobs over all topics or articles at once. What fails for one of them is a status of its row, not an
error of the job. Only results that a configuration bounds come to the driver.
"""

from __future__ import annotations

import itertools
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import names
from ..functions.ids import work_key
from ..operators import papers, references, resolution, sampling, topics
from ..runtime import settle
from ..sinks import now, write_json, write_parents, write_sample
from ..sources import snapshot
from ..sources.config import FetchConfig

#: Papers per topic and per parent unless told otherwise.
PER_TOPIC = 2000


def sample_snapshot(spark: SparkSession, path: str | Path, config: FetchConfig, *, seed: callable = sampling.generate_seed) -> dict:
    """Sample a snapshot in either layout and write the configuration's document."""
    manifest = snapshot.validate(path)
    if manifest["layout"] == "primary_topic":
        found = topics.find_topic(snapshot.read_catalog(spark, path), config)
        works = snapshot.read_topic(spark, path, found["topic"]["id"].rstrip("/").rsplit("/", 1)[-1])
    else:
        works = snapshot.read_updates(spark, path)
    used = config.sample_seed if config.sample_seed is not None else seed()
    matching = sampling.matching(works, config)
    total = matching.count()  # a scan of its own: a window over all rows would bring them into one task
    if not total:
        raise LookupError("no work matches the configuration")
    first = settle(sampling.candidates(matching, config.count, used), "candidates")
    english = config.require_english_text and config.language == "en"
    parsed = papers.parse_papers(first, list(config.fields), list(config.required_fields), english=english, clean=config.require_clean_text, keep=("id", "sample_key", "primary_topic"))
    seen = settle(sampling.accept(parsed, config.count), "seen")
    stats = sampling.sample_stats(seen).first()
    level = seen.orderBy("sample_key", "id").select(topics.hierarchy(F.col("primary_topic"), strict=True).alias("h")).first().h.asDict(recursive=True)
    query = {
        "requested": config.count, "sample_size": sampling.OVERSAMPLE * config.count, "configured_seed": config.sample_seed, "effective_seed": used, "total_matching": total,
        "written": stats.written, "skipped": stats.skipped, "sampled_seen": stats.sampled_seen, "selected_columns": papers.selected_columns(list(config.fields)),
        "skip_reasons": {r.reason: r.n for r in papers.skip_histogram(seen).collect()},
    }
    return write_sample(config.output_path, seen.where("ok = 1").orderBy("sample_key", "id").select(*config.fields), config, level, query)


def topic_batch(works: DataFrame, catalog: DataFrame, out: str | Path, *, count: int = PER_TOPIC, seed: int = 0, existing: DataFrame | None = None) -> tuple[DataFrame, dict[str, Any]]:
    """Papers of every topic under ``out/topic_id=...``, a status per topic, and the batch's manifest, also written beside.

    ``works`` has topic_id; ``catalog``: topic_id, display_name, subfield. Topics in ``existing`` are left as they are.
    """
    wanted = catalog if existing is None else catalog.join(existing.select("topic_id"), "topic_id", "left_anti")
    mine = works.join(wanted.select("topic_id").distinct(), "topic_id", "left_semi")
    first = sampling.candidates_per_key(mine, "topic_id", count, seed)
    parsed = papers.parse_papers(first, list(papers.COLUMNS), ["title", "abstract"], english=True, clean=True, keep=("id", "topic_id", "sample_key"))
    seen = settle(sampling.accept(parsed, count, by=("topic_id",)), "seen")
    seen.where("ok = 1").drop("ok", "n_accepted", "skip_reasons").repartition("topic_id").write.mode("overwrite").partitionBy("topic_id").parquet(str(out))
    stats = sampling.sample_stats(seen, ("topic_id",))
    kept = (existing.select("topic_id") if existing is not None else catalog.select("topic_id").limit(0)).distinct().withColumn("kept", F.lit(True))
    joined = catalog.join(stats, "topic_id", "left").join(kept, "topic_id", "left")
    written = F.coalesce("written", F.lit(0))
    status = F.when(F.col("kept"), "skipped_existing").when(written >= count, "written").when(written > 0, "partial").otherwise("error")
    statuses = settle(joined.select("topic_id", "display_name", "subfield", status.alias("status"), written.alias("written"), F.coalesce("skipped", F.lit(0)).alias("skipped")), "statuses")
    totals = statuses.agg(F.count(F.lit(1)).alias("topics"), F.countDistinct("subfield.id").alias("subfields"), F.sum("written").alias("papers"), F.sum("skipped").alias("skipped")).first().asDict()
    manifest = totals | {"statuses": {r.status: r["count"] for r in statuses.groupBy("status").count().collect()}, "papers_per_topic": count, "seed": seed}
    statuses.write.mode("overwrite").parquet(f"{out}/_statuses")
    write_json(f"{out}/_manifest.json", manifest | {"generated_at": now()})
    return statuses, manifest


def numbered_slugs(titles: DataFrame, key: str) -> DataFrame:
    """``slug`` of every row's title; of equal ones all but the first by ``key`` are numbered from 2 on."""
    base = titles.withColumn("slug", names.slug_column(F.col("title")))
    n = F.row_number().over(Window.partitionBy("slug").orderBy(key))  # parents of one title
    ending = F.concat(F.lit("-"), F.col("n").cast("string"))
    return base.withColumn("n", n).withColumn("slug", F.when(F.col("n") > 1, F.concat(F.left("slug", F.lit(names.SLUG_LENGTH) - F.length(ending)), ending)).otherwise(F.col("slug"))).drop("n")


def scholar_run(articles: DataFrame, works: DataFrame, out: str | Path, *, count: int = PER_TOPIC, seed: int = 0, folders: bool = False) -> tuple[DataFrame, dict[str, Any]]:
    """The work of every article, its references and a sample of earlier works on its topic, in tables under ``out``.

    ``articles``: article_id, journal, title, year; ``works``: rows of a snapshot with topic_id. Returns a status per
    article and the manifest. With ``folders``, for as few parents as are scraped, each has a folder of documents as well.
    """
    cleaned = settle(resolution.left_forms(articles.select("article_id", "journal", "year", F.coalesce(names.scraped_title_udf("title"), F.lit("")).alias("title"))), "cleaned")
    by = Window.partitionBy("key").orderBy(F.col("cited_by_count").desc_nulls_last(), "id")  # the deliveries of one work
    one = settle(works.withColumn("key", work_key(F.col("id"))).where(F.col("key").isNotNull()).withColumn("n", F.row_number().over(by)).where("n = 1").drop("n"), "works")
    known = one.where(F.col("display_name").isNotNull())
    catalog = settle(resolution.right_forms(known.select(F.col("key").alias("id"), F.col("display_name").alias("title"), papers.first_venue().alias("venue"), F.col("publication_date").cast("string").alias("published"), F.col("cited_by_count").alias("cited"))), "titles")
    scored = settle(resolution.scored(cleaned, catalog, resolution.candidates(cleaned, catalog)), "scored")
    matches = settle(resolution.verdicts(cleaned, scored), "matches")
    judge = lambda required: papers.parse_papers(one, list(papers.COLUMNS), required, english=True, clean=True, keep=("key",)).withColumnRenamed("key", "id")
    facts = one.select(F.col("key").alias("work_id"), "doi", "type", "primary_topic", "topic_id", "referenced_works", F.col("publication_date").alias("published"))
    parents = matches.where("status = 'resolved'").join(judge(["title"]).withColumnRenamed("id", "work_id"), "work_id").join(facts, "work_id")
    reason = F.when(F.size("skip_reasons") > 0, "missing_required_parent_fields").when(F.col("primary_topic.id").isNull(), "missing_primary_topic")
    record = settle(parents.withColumn("why", reason).join(cleaned.select("article_id", "journal", F.col("title").alias("matched_scholar_title")), "article_id"), "parents")
    good = settle(numbered_slugs(record.where(F.col("why").isNull()), "article_id"), "good")
    good.drop("why", "skip_reasons", "referenced_works").write.mode("overwrite").parquet(f"{out}/parents")
    parsed = settle(judge(["title", "abstract"]), "parsed")
    refs = F.transform("referenced_works", work_key)
    rows = settle(references.lookup(good, refs, F.col("work_id"), parsed), "references")
    rows.where(F.col("found") & (F.size("skip_reasons") == 0)).select("parent", "ref_id").join(parsed.drop("skip_reasons").withColumnRenamed("id", "ref_id"), "ref_id").write.mode("overwrite").parquet(f"{out}/references")
    dated = one.where((F.col("type") == "article") & (F.col("language") == "en") & F.col("abstract_inverted_index").isNotNull()).select(F.col("key").alias("id"), "topic_id", F.col("publication_date").alias("published"))
    before = references.earlier_works(good.select(F.col("work_id").alias("parent"), "topic_id", "published").dropDuplicates(["parent"]), dated)
    drawn = sampling.candidates_per_key(before.select("parent", "id"), "parent", count, seed).select("parent", "id", "sample_key")
    seen = settle(sampling.accept(drawn.join(parsed, "id"), count, by=("parent",)), "seen")
    seen.where("ok = 1").drop("ok", "n_accepted", "skip_reasons").write.mode("overwrite").parquet(f"{out}/papers_before")
    lists = resolution.candidate_lists(scored).join(matches.where("status = 'unresolved'").select("article_id"), "article_id", "left_semi")
    lists.write.mode("overwrite").parquet(f"{out}/candidates")
    late = record.select("article_id", "why").join(good.select("article_id", "slug"), "article_id", "left")
    statuses = matches.join(late, "article_id", "left").select(
        "article_id", F.when(F.col("why").isNotNull(), F.lit("unresolved")).otherwise(F.col("status")).alias("status"), F.coalesce("why", "reason").alias("reason"), "confidence", "work_id", "slug"
    )
    statuses = settle(statuses, "statuses")
    counts = {r.status: r["count"] for r in statuses.groupBy("status").count().collect()}
    totals = references.lookup_stats(rows).agg(*(F.sum(c).alias(n) for c, n in (("requested", "requested"), ("n_found", "found"), ("accepted", "accepted"), ("skipped", "skipped"), ("missing", "missing")))).first().asDict()
    manifest = {"articles": sum(counts.values()), "statuses": counts, "references": totals, "papers_per_parent": count, "seed": seed}
    write_json(f"{out}/manifest.json", manifest | {"generated_at": now()})
    if folders:
        _folders(spark=one.sparkSession, out=out, good=good)
    return statuses, manifest


def _folders(spark: SparkSession, out: str | Path, good: DataFrame) -> None:
    """A folder of documents for each parent, from the tables; one parent's papers are in memory at a time."""
    columns = list(papers.COLUMNS)
    rows = good.collect()  # as few as are scraped
    keyed = good.select("article_id", F.col("work_id").alias("parent"))

    def lists(name: str, order: str):
        given = spark.read.parquet(f"{out}/{name}").join(keyed, "parent").orderBy("article_id", order).select("article_id", *columns).toLocalIterator()
        return ((key, [{c: r[c] for c in columns} for r in group]) for key, group in itertools.groupby(given, key=lambda r: r.article_id))

    records = {r.slug: {c: r[c] for c in columns} | {"work_id": r.work_id, "doi": r.doi, "type": r.type, "matched_scholar_title": r.matched_scholar_title, "journal": r.journal, "primary_topic": r.primary_topic.asDict(recursive=True), "match_confidence": r.confidence} for r in rows}
    write_parents(out, records, {r.article_id: r.slug for r in rows}, lists("papers_before", "sample_key"), lists("references", "ref_id"))
