"""Whole runs over a catalog's REST interface: one sample, samples of all topics of a field, Scholar articles.

Requests are rows of tables and are sent by tasks, all samples of a run in the same waves of pages; answers are settled and
judged like a snapshot's rows. What a run asks for is bounded by configurations, a catalog or two times five times twenty
scraped articles, so lists of samples are kept on the driver, their papers aren't.

Defined results: pages count as seen up to the one that fills a sample; results that aren't objects are skipped; a sample
that fails is an error of its own where a run has several.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable
from dataclasses import dataclass, replace
from pathlib import Path
from typing import Any
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import names
from ..functions.ids import last_segment
from ..operators import papers, references, resolution, sampling, topics
from ..runtime import settle
from ..sinks import now, sample_document, write_json, write_parents
from ..sources import rest
from ..sources.config import FetchConfig, make_config
from ..sources.snapshot import TOPIC, WORKS
from .workflows import PER_TOPIC

#: Topics and references to a request, results of a search by name.
TOPIC_PAGE, REFERENCE_PAGE, NAME_RESULTS = 200, 100, 25
FIELDS = list(papers.COLUMNS)
Fetcher = Callable[[str, dict], dict]


@dataclass(frozen=True)
class Ask:
    """One sample: its name, configuration, topic and seed."""

    key: str
    config: FetchConfig
    topic_id: str
    seed: int

    @property
    def size(self) -> int:
        return rest.sample_size(self.config.count)

    @property
    def last_page(self) -> int:
        return -(-self.size // self.config.per_page)

    def params(self, page: int) -> dict[str, str]:
        c = self.config
        own = {"filter": rest.work_filters(c, self.topic_id), "sample": self.size, "seed": self.seed, "page": page, "per_page": c.per_page, "select": rest.select_list(list(c.fields))}
        return {k: str(v) for k, v in (own | ({"api_key": c.api_key} if c.api_key else {})).items()}


def works_of(answers: DataFrame) -> DataFrame:
    """Works of answers in a snapshot's columns, with key, page and place; an abstract's index is kept as its JSON text."""
    rows = answers.where(F.col("record").isNotNull())
    return rows.select("key", "page", "ord", F.from_json("record", WORKS).alias("w")).select("key", "page", "ord", "w.*")


def sample(spark: SparkSession, asks: list[Ask], url: str, fetcher: Fetcher, *, errors: bool = False) -> tuple[DataFrame, dict[str, dict]]:
    """Candidates of every sample up to the one that fills it, with ``ok``; and what is to be said of each.

    All must have the same fields and checks. The first wave asks for as many pages as could do, each further one for twice
    as many of the samples that aren't filled.
    """
    one = asks[0].config
    english, count = one.require_english_text and one.language == "en", F.col("count")
    counts = spark.createDataFrame([(a.key, a.config.count) for a in asks], "key string, count int")
    judged, facts, pending, done, wave = None, {}, list(asks), dict.fromkeys((a.key for a in asks), 0), None
    while pending:
        pages = {a.key: range(done[a.key] + 1, min(a.last_page, done[a.key] + (wave or -(-a.config.count // a.config.per_page))) + 1) for a in pending}
        wave = 2 * max(len(p) for p in pages.values())
        requests = spark.createDataFrame([(a.key, p, a.params(p)) for a in pending for p in pages[a.key]], "key string, page int, params map<string, string>")
        answers = settle(rest.ask(requests, f"{url}/works", fetcher, errors=errors), "answers")
        parsed = papers.parse_papers(works_of(answers), list(one.fields), list(one.required_fields), english=english, clean=one.require_clean_text, keep=("key", "page", "ord"))
        parsed = settle(parsed, "parsed")
        judged = parsed if judged is None else judged.unionByName(parsed)
        for r in answers.groupBy("key").agg(F.max("total").alias("total"), F.max("error").alias("error"), F.max(F.col("record").isNull()).alias("ended")).collect():
            before = facts.get(r.key, {})
            facts[r.key] = {"total": r.total if r.total is not None else before.get("total"), "error": r.error, "ended": r.ended}
        filled = {r.key: r.n for r in judged.groupBy("key").agg(F.count_if(F.size("skip_reasons") == 0).alias("n")).collect()}
        done |= {k: p[-1] for k, p in pages.items()}
        pending = [a for a in pending if filled.get(a.key, 0) < a.config.count and done[a.key] < a.last_page and not facts[a.key]["ended"]]
    seen = settle(sampling.accept(judged.join(counts, "key"), count, by=("key",), order=("page", "ord")), "seen")
    ends = seen.groupBy("key").agg(F.sum("ok").alias("written"), F.sum(1 - F.col("ok")).alias("skipped"), F.max("page").alias("page"))
    rows = judged.groupBy("key", "page").agg(F.count(F.lit(1)).alias("n")).join(ends.withColumnRenamed("page", "stop"), "key").where(F.col("page") <= F.col("stop"))
    for r in rows.groupBy("key").agg(F.sum("n").alias("n"), F.first("written").alias("written"), F.first("skipped").alias("skipped")).collect():
        facts[r.key] |= {"sampled_seen": r.n, "written": r.written, "skipped": r.skipped}
    return seen, {a.key: _query(a, facts[a.key]) for a in asks}


def _query(a: Ask, facts: dict) -> dict[str, Any]:
    p = a.params(1)
    out = {"requested": a.config.count, "sample_size": a.size, "configured_sample_seed": a.config.sample_seed, "effective_sample_seed": a.seed}
    out |= {k: facts.get(k, 0) for k in ("written", "skipped", "sampled_seen")} | {"total_matching": facts.get("total"), "filters": p["filter"], "select": p["select"]}
    return out | ({"error": facts["error"]} if facts.get("error") else {})


def _papers(seen: DataFrame, fields: list[str]):
    """(key, papers) of every sample in turn; one sample's papers are in memory at a time."""
    rows = seen.where("ok = 1").orderBy("key", "page", "ord").select("key", *fields).toLocalIterator()
    for key, group in itertools.groupby(rows, key=lambda r: r.key):
        yield key, [{f: r[f] for f in fields} for r in group]


def find_topic(spark: SparkSession, config: FetchConfig, url: str, fetcher: Fetcher) -> dict:
    """The only topic of a configuration's path among those that a search for its name gives."""
    params = {"search": config.topic, "per_page": NAME_RESULTS} | ({"api_key": config.api_key} if config.api_key else {})
    return topics.find_topic(catalog_of(spark, rest.results_of(fetcher(f"{url}/topics", params))), config)


def find_field(spark: SparkSession, name: str, url: str, fetcher: Fetcher, api_key: str | None = None) -> str:
    params = {"search": name, "per_page": NAME_RESULTS, "select": "id,display_name"} | ({"api_key": api_key} if api_key else {})
    rows = [(r["id"], {"id": r["id"], "display_name": r["display_name"]}) for r in rest.results_of(fetcher(f"{url}/fields", params)) if isinstance(r, dict) and isinstance(r.get("id"), str) and isinstance(r.get("display_name"), str)]
    return topics.find_field(spark.createDataFrame(rows, "id string, field struct<id string, display_name string>"), name)


def catalog_of(spark: SparkSession, results: list) -> DataFrame:
    records = spark.createDataFrame([(json.dumps(r),) for r in results], "record string")
    return records.select(F.from_json("record", TOPIC).alias("t")).select("t.*").where(F.col("id").isNotNull())


def sample_catalog(spark: SparkSession, config: FetchConfig, url: str, *, fetcher: Fetcher = rest.fetch, seed: Callable[[], int] = sampling.generate_seed) -> dict:
    """Sample a catalog and write the configuration's document."""
    level = find_topic(spark, config, url, fetcher)
    a = Ask("sample", config, level["topic"]["id"], config.sample_seed if config.sample_seed is not None else seed())
    seen, queries = sample(spark, [a], url, fetcher)
    found = dict(_papers(seen, list(config.fields))).get("sample", [])
    document = sample_document(found, config, level, queries["sample"], source="catalog")
    write_json(config.output_path, document)
    return document


def discover_topics(spark: SparkSession, field_id: str, url: str, *, fetcher: Fetcher = rest.fetch, api_key: str | None = None) -> DataFrame:
    """All topics of a field in order of subfield and name; one without id or name at any level is an error."""
    params = {"filter": f"field.id:{field_id}", "per_page": TOPIC_PAGE, "select": "id,display_name,domain,field,subfield"} | ({"api_key": api_key} if api_key else {})
    results = [r for page in rest.cursor_pages(f"{url}/topics", params, fetcher) for r in page]
    catalog = settle(catalog_of(spark, results), "catalog")
    if catalog.where(topics.valid_topic()).count() != len(results):
        raise rest.CatalogError("a topic lacks an id or a name")
    return topics.sorted_topics(catalog)


def topic_batch(spark: SparkSession, field_id: str, out: str | Path, url: str, *, since: str = "2005-01-01", count: int = PER_TOPIC, seed: int | None = None, overwrite: bool = False, fetcher: Fetcher = rest.fetch, api_key: str | None = None, new_seed: Callable[[], int] = sampling.generate_seed) -> dict:
    """A document per topic of a field under ``out/subfield/topic.json``, and the batch's manifest."""
    out = Path(out)
    rows = discover_topics(spark, field_id, url, fetcher=fetcher, api_key=api_key).transform(topics.output_paths).transform(topics.sorted_topics).collect()  # a catalog
    entries: dict[str, dict] = {}
    asks, levels = [], {}
    for r in rows:
        path = out / f"{r.path}.json"
        level = {k: {"id": r[k].id, "display_name": r[k].display_name} for k in topics.LEVELS[:3]} | {"topic": {"id": r.id, "display_name": r.display_name}}
        entries[r.id] = {"status": "error", "subfield": r.subfield.display_name, "topic": r.display_name, "topic_id": r.id, "output_path": str(path), "requested": count, "written": 0, "skipped": 0}
        if path.exists() and not overwrite:
            entries[r.id] |= {"status": "skipped_existing"} | _existing(path)
            continue
        config = make_config({
            "count": count, "from_publication_date": since, "to_publication_date": None, "work_type": "article", "language": "en", "domain": r.domain.display_name, "field": r.field.display_name, "subfield": r.subfield.display_name,
            "topic": r.display_name, "field_match": "primary", "sample_seed": seed, "required_fields": ["title", "abstract"], "fields": FIELDS, "output_path": str(path), "per_page": rest.MOST_PAGE,
        }, api_key=api_key)
        asks.append(Ask(r.id, config, r.id, seed if seed is not None else new_seed()))
        levels[r.id] = level
    if asks:
        seen, queries = sample(spark, asks, url, fetcher, errors=True)
        by_key = {a.key: a.config for a in asks}
        for key, found in itertools.chain(_papers(seen, FIELDS), ((a.key, []) for a in asks if not queries[a.key]["written"] and "error" not in queries[a.key])):
            write_json(by_key[key].output_path, sample_document(found, by_key[key], levels[key], queries[key], source="catalog"))
        for key, q in queries.items():
            status = {"status": "error", "error": q["error"]} if "error" in q else {"status": "written" if q["written"] >= count else "partial", "written": q["written"], "skipped": q["skipped"]}
            entries[key] |= status
    field = {"domain": rows[0].domain.display_name, "field": rows[0].field.display_name} if rows else {}
    metadata = {"generated_at": now(), "source": "catalog", **field, "field_id": field_id, "from_publication_date": since, "to_publication_date": None, "work_type": "article", "language": "en", "requested_per_topic": count, "topic_count": len(rows), "subfield_count": len({r.subfield.display_name for r in rows}), "output_root": str(out), "overwrite": overwrite}
    manifest = {"metadata": metadata, "topics": list(entries.values())}
    write_json(out / "manifest.json", manifest)
    return manifest


def _existing(path: Path) -> dict[str, int]:
    try:
        document = json.loads(path.read_text(encoding="utf-8"))
        skipped = document.get("metadata", {}).get("query", {}).get("skipped")
        return {"written": len(document.get("papers") or []), "skipped": skipped if isinstance(skipped, int) else 0}
    except (OSError, ValueError, AttributeError, TypeError):
        return {"written": 0, "skipped": 0}


# ---------------------------------------------------------------- Scholar articles


def search(spark: SparkSession, cleaned: DataFrame, url: str, fetcher: Fetcher, api_key: str | None = None) -> DataFrame:
    """Works (key, ...) that searches for each article's title, and for what stands before its colon, give: SEARCHED each."""
    found = cleaned.where(F.col("title") != "").select(F.col("article_id").cast("string").alias("key"), F.posexplode(names.search_titles(F.col("title"))).alias("page", "search"))
    fixed = {"filter": "language:en", "per_page": str(resolution.SEARCHED), "select": f"doi,type,{rest.select_list(FIELDS, ('id', 'primary_topic', 'referenced_works', 'cited_by_count'))}"} | ({"api_key": api_key} if api_key else {})
    params = F.map_concat(F.create_map(F.lit("search"), "search"), F.create_map(*(F.lit(x) for pair in fixed.items() for x in pair)))
    return works_of(settle(rest.ask(found.select("key", "page", params.alias("params")), f"{url}/works", fetcher), "searched"))


def lookup(spark: SparkSession, parents: DataFrame, url: str, fetcher: Fetcher, api_key: str | None = None) -> DataFrame:
    """Works (key, ...) that the rows (key, referenced_works) refer to, REFERENCE_PAGE to a request."""
    ids = parents.select("key", F.explode(references.reference_ids(F.col("referenced_works"))).alias("id")).distinct()
    numbered = ids.withColumn("page", F.floor((F.row_number().over(Window.partitionBy("key").orderBy("id")) - 1) / REFERENCE_PAGE).cast("int"))
    batches = numbered.groupBy("key", "page").agg(F.array_sort(F.collect_list(last_segment(F.col("id")))).alias("ids"))  # REFERENCE_PAGE at most
    name = (urlsplit(url).hostname or "").rpartition(".")[0].rpartition(".")[2] or "ids"  # the interface's own name is the key that it filters ids by
    fixed = {"select": rest.select_list(FIELDS, ("id",))} | ({"api_key": api_key} if api_key else {})
    params = F.map_concat(F.create_map(F.lit("filter"), F.concat(F.lit(f"{name}:"), F.array_join("ids", "|")), F.lit("per_page"), F.size("ids").cast("string")), F.create_map(*(F.lit(x) for pair in fixed.items() for x in pair)))
    return works_of(settle(rest.ask(batches.select("key", "page", params.alias("params")), f"{url}/works", fetcher), "looked-up"))


def scholar_run(spark: SparkSession, articles: DataFrame, out: str | Path, url: str, *, method: str = "fixture", failures: tuple[str, ...] = (), count: int = PER_TOPIC, seed: int | None = None, per_page: int = rest.MOST_PAGE, fetcher: Fetcher = rest.fetch, api_key: str | None = None, new_seed: Callable[[], int] = sampling.generate_seed) -> dict:
    """The work of every scraped article, its references and a sample of earlier works on its topic: a folder for each, and
    the manifest. ``articles``: journal, h5_index, h5_median, ord, title, year, as many as are scraped at most."""
    numbered = settle(articles.withColumn("article_id", F.xxhash64("journal", "ord")), "articles")
    cleaned = settle(numbered.select("article_id", "journal", "year", F.coalesce(names.scraped_title_udf("title"), F.lit("")).alias("title")), "cleaned")
    works = settle(search(spark, cleaned, url, fetcher, api_key).where(F.col("id").isNotNull()), "works")
    one = settle(works.groupBy("id").agg(F.min_by(F.struct(*(c for c in WORKS.fieldNames() if c != "id")), F.struct("page", "ord", "key")).alias("w")).select("id", "w.*"), "one")
    titled = one.where(F.col("display_name").isNotNull()).select("id", F.col("display_name").alias("title"), papers.first_venue().alias("venue"), F.col("publication_date").cast("string").alias("published"), F.col("cited_by_count").alias("cited"))
    pairs = works.select(F.col("key").cast("bigint").alias("article_id"), "id").distinct()
    scored = settle(resolution.scored(cleaned, titled, pairs), "scored")
    matches = settle(resolution.verdicts(cleaned, scored), "matches")
    lists: dict[int, list] = {}
    for r in resolution.candidate_lists(scored, most=2 * resolution.SEARCHED).join(titled, "id").orderBy("article_id", "place").collect():  # twice SEARCHED of each article
        lists.setdefault(r.article_id, []).append({"id": r.id, "title": r.title, "publication_date": r.published, "publication_venue": r.venue, "confidence": r.confidence, "cited_by_count": r.cited})
    judge = lambda df, required, keep: papers.parse_papers(df, FIELDS, required, english=True, clean=True, keep=keep)
    parents = judge(one, ["title"], ("id", "doi", "type", "primary_topic", "referenced_works")).withColumnRenamed("id", "work_id")
    found = matches.where("status = 'resolved'").join(parents, "work_id").join(cleaned.select("article_id", "journal", F.col("title").alias("matched_scholar_title")), "article_id")
    why = F.when(F.size("skip_reasons") > 0, "missing_required_parent_fields").when(F.col("primary_topic.id").isNull(), "missing_primary_topic")
    found = settle(found.withColumn("why", why).withColumn("hierarchy", topics.hierarchy(F.col("primary_topic"), strict=False)).withColumn("key", F.col("article_id").cast("string")), "found")
    good = found.where(F.col("why").isNull())
    cited = settle(judge(lookup(spark, good, url, fetcher, api_key), ["title", "abstract"], ("key", "page", "ord", "id")), "cited")
    rows = good.collect()  # as many as were scraped at most
    asks, queries, seen = [_before(r, count, seed, per_page, api_key, new_seed) for r in rows if r.publication_date], {}, None
    if asks:
        seen, queries = sample(spark, asks, url, fetcher, errors=True)
    asked = {r.key: len(references_of(r)) for r in rows}
    stats = {k: {"requested": n, "found": 0, "accepted": 0, "skipped": 0, "skip_reasons": {}, "missing": n} for k, n in asked.items()}
    for r in cited.groupBy("key").agg(F.count(F.lit(1)).alias("found"), F.count_if(F.size("skip_reasons") == 0).alias("accepted")).collect():
        stats[r.key] |= {"found": r.found, "accepted": r.accepted, "skipped": r.found - r.accepted, "missing": max(0, asked[r.key] - r.found)}
    for r in papers.skip_histogram(cited, ("key",)).collect():
        stats[r.key]["skip_reasons"][r.reason] = r.n
    order = {r.article_id: (r.journal, r.ord, r.title, r.year) for r in numbered.orderBy("ord").collect()}
    first = {j: i for i, j in enumerate(dict.fromkeys(r.journal for r in articles.collect()))}
    facts = {r.article_id: r for r in rows}
    bad = {r.article_id: r.why for r in found.where(F.col("why").isNotNull()).select("article_id", "why").collect()}
    verdict = {r.article_id: r for r in matches.join(cleaned.select("article_id", F.col("title").alias("cleaned")), "article_id").collect()}
    used: set[str] = set()
    entries, slugs = [], {}
    for i in sorted(order, key=lambda i: (first[order[i][0]], order[i][1])):
        journal, _, raw, year = order[i]
        v = verdict[i]
        entry = {"journal": journal, "scholar_title": v.cleaned or raw, "raw_scholar_title": raw if raw != v.cleaned else None, "scholar_year": year, "status": "unresolved" if i in bad else v.status, "match_confidence": v.confidence, "reason": bad.get(i, v.reason), "candidates": lists.get(i, []) if v.cleaned else []}
        if i in facts:
            r = facts[i]
            slugs[r.key] = names.slug(r.title, used)
            entry |= {"work_id": r.work_id, "doi": r.doi, "parent_title": r.title, "publication_date": r.publication_date, "publication_venue": r.publication_venue, "primary_topic": r.hierarchy.topic.asDict(), "output_folder": str(Path(out) / slugs[r.key])}
            entry |= {"sample_stats": queries.get(r.key, {"error": "the parent has no publication date", "requested": count, "written": 0}), "reference_stats": stats[r.key]}
        entries.append(entry)
    samples = _papers(seen, FIELDS) if seen is not None else iter(())
    refs = cited.where(F.size("skip_reasons") == 0).orderBy("key", "page", "ord").select("key", *FIELDS).toLocalIterator()
    write_parents(out, {slugs[r.key]: _parent(r) for r in rows}, slugs, samples, ((k, [{f: x[f] for f in FIELDS} for x in g]) for k, g in itertools.groupby(refs, key=lambda x: x.key)))
    heads = [{"name": j, **{c: r[c] for c in ("h5_index", "h5_median")}, "articles": [{"title": t, "year": y} for jj, _, t, y in order.values() if jj == j]} for j, r in {r.journal: r for r in articles.collect()}.items()]
    manifest = {"generated_at": now(), "scholar_source_method": method, "scrape_failures": list(failures), "journals": heads, "papers": entries, "unresolved": [e for e in entries if e["status"] == "unresolved"]}
    write_json(Path(out) / "manifest.json", manifest)
    return manifest


def references_of(row) -> set[str]:
    return {x for x in row.referenced_works or () if isinstance(x, str) and x.strip()}


def _parent(r) -> dict[str, Any]:
    return {f: r[f] for f in FIELDS} | {"work_id": r.work_id, "doi": r.doi, "type": r.type, "matched_scholar_title": r.matched_scholar_title, "journal": r.journal, "primary_topic": r.primary_topic.asDict(recursive=True), "match_confidence": r.confidence}


def _before(r, count: int, seed: int | None, per_page: int, api_key: str | None, new_seed: Callable[[], int]) -> Ask:
    """The sample of works of a parent's topic from January 1 of the fifth year before up to its date."""
    level = r.hierarchy.asDict(recursive=True)
    named = {k: level[k]["display_name"] or "unknown" for k in topics.LEVELS}
    config = make_config({
        "count": count, "from_publication_date": f"{int(r.publication_date[:4]) - 5:04d}-01-01", "to_publication_date": r.publication_date, "work_type": "article", "language": "en", **named, "field_match": "primary",
        "sample_seed": seed, "required_fields": ["title", "abstract"], "fields": FIELDS, "output_path": "-", "per_page": per_page,
    }, api_key=api_key)
    return Ask(r.key, replace(config, output_path=""), level["topic"]["id"], seed if seed is not None else new_seed())
