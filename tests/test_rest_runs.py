import json

import pytest
from test_operators import config

from paperloom.plans import rest_runs
from paperloom.sources import rest

URL = "https://api.library.example"
LEVEL = {"id": "https://x/1", "display_name": "N"}


def catalog(log=None, broken=()):
    """A fetching function that answers like a catalog of 60 works on two topics."""
    node, calls = LEVEL, log

    def topic(k):
        return {"id": f"https://x/T{k}", "display_name": "Twin" if k < 2 else f"topic {k}", "domain": node, "field": node, "subfield": node}

    def work(i, **more):
        place = {"source": {"display_name": "Journal of Things" if i % 2 else None}, "raw_source_name": "Raw"}
        base = {"id": f"https://x/W{i}", "doi": f"d{i}", "type": "article", "display_name": f"Finding number {i} of many", "abstract_inverted_index": {"Some": [0], "words": [1]} if i % 4 else None, "publication_date": f"2020-01-{i % 28 + 1:02d}", "primary_location": place, "locations": [place], "primary_topic": topic(0) | {"score": 0.5}, "referenced_works": [f"https://x/W{i - 1}", f"https://x/W{i - 1}", "https://x/W999", " "], "cited_by_count": i}
        return base | more

    def fetcher(url, params):
        if calls is not None:
            calls.append((url, dict(params)))
        part, size = url.rsplit("/", 1)[-1], int(params.get("per_page", 25))
        if part == "fields":
            return {"results": [{"id": "f27", "display_name": "Medicine"}, {"id": "f28", "display_name": "Medicine of old"}]}
        if part == "topics":
            if "cursor" in params:
                return {"results": [topic(k) for k in ((3, 1) if params["cursor"] == "*" else (0,))], "meta": {"next_cursor": "more" if params["cursor"] == "*" else None}}
            return {"results": [topic(k) for k in (2, 3)]}
        if "search" in params:
            n = int(params["search"].split()[2]) if params["search"].startswith("Finding") else None
            return {"results": [work(k) for k in (n, n + 1)] if n else []}
        if params["filter"].startswith("library:"):
            return {"results": [work(int(x[1:])) for x in params["filter"][8:].split("|") if x != "W999"]}
        if any(f"primary_topic.id:{t}" in params["filter"] for t in broken):
            raise rest.CatalogError("HTTP 500")
        page = int(params["page"])
        rows = [work(i) for i in range((page - 1) * size, min(60, page * size))]
        return {"results": [*rows[:1], "no object", *rows[1:]] if page == 1 else rows, "meta": {"count": 60}}

    return fetcher


def test_sample_catalog(spark, tmp_path):
    out = tmp_path / "s.json"
    c = config(domain="n", field="N", subfield="n", topic="Topic 2", count=12, per_page=10, output_path=str(out), sample_seed=None)
    document = rest_runs.sample_catalog(spark, c, URL, fetcher=catalog(), seed=lambda: 5)
    query = document["metadata"]["query"]
    # Every fourth work has no abstract, one result is no object: pages 1 and 2 give 7 + 8, the twelfth is W15.
    assert [p["title"] for p in document["papers"]] == [f"Finding number {i} of many" for i in range(16) if i % 4] and document["papers"][0]["publication_venue"] == "Journal of Things"
    assert query["written"] == 12 and query["skipped"] == 5 and query["sampled_seen"] == 21 and query["total_matching"] == 60 and query["effective_sample_seed"] == 5 and query["sample_size"] == 60
    assert document["metadata"]["resolved_topic_hierarchy"]["topic"]["id"] == "https://x/T2" and json.loads(out.read_text()) == document
    short = rest_runs.sample_catalog(spark, config(domain="n", field="N", subfield="n", topic="Topic 2", count=50, per_page=10, output_path=str(out), sample_seed=1), URL, fetcher=catalog())
    assert short["metadata"]["query"]["written"] == 45 and short["metadata"]["query"]["sampled_seen"] == 61
    with pytest.raises(LookupError):
        rest_runs.sample_catalog(spark, config(topic="nothing"), URL, fetcher=catalog())
    assert rest_runs.find_field(spark, "medicine", URL, catalog()) == "f27"


def test_topic_batch(spark, tmp_path):
    kept = tmp_path / "N" / "topic 3.json"
    kept.parent.mkdir()
    kept.write_text(json.dumps({"papers": [1, 2], "metadata": {"query": {"skipped": 4}}}))
    manifest = rest_runs.topic_batch(spark, "27", tmp_path, URL, count=3, seed=9, fetcher=catalog(broken=("T1",)))
    got = {t["topic_id"]: (t["status"], t["written"], t["skipped"], t["output_path"].rsplit("/", 2)[-1]) for t in manifest["topics"]}
    assert got == {"https://x/T3": ("skipped_existing", 2, 4, "topic 3.json"), "https://x/T0": ("written", 3, 2, "Twin.json"), "https://x/T1": ("error", 0, 0, "Twin (T1).json")}
    assert [t["topic"] for t in manifest["topics"]] == ["topic 3", "Twin", "Twin"] and manifest["metadata"]["topic_count"] == 3 and manifest["metadata"]["subfield_count"] == 1
    assert json.loads((tmp_path / "manifest.json").read_text()) == manifest and len(json.loads((tmp_path / "N" / "Twin.json").read_text())["papers"]) == 3 and not (tmp_path / "N" / "Twin (T1).json").exists()
    again = rest_runs.topic_batch(spark, "27", tmp_path, URL, count=100, seed=9, overwrite=True, fetcher=catalog())
    assert {t["status"] for t in again["topics"]} == {"partial"} and {t["written"] for t in again["topics"]} == {45}


def test_scholar_run(spark, tmp_path):
    rows = [("Journal of Things", 9, 12, 0, "Finding number 7 of many AB Smith, C Jones", 2020), ("Journal of Things", 9, 12, 1, "Title / Author", None), ("Journal of Things", 9, 12, 2, "Nothing alike", 2020), ("Other", None, None, 0, "Finding number 21 of many", 2020), ("Other", None, None, 1, "Finding number 7 of many", 2020)]
    articles = spark.createDataFrame(rows, "journal string, h5_index int, h5_median int, ord int, title string, year int")
    manifest = rest_runs.scholar_run(spark, articles, tmp_path, URL, count=4, seed=3, per_page=5, fetcher=catalog(), failures=("HTTP 429",))
    entries = manifest["papers"]
    assert [(e["journal"], e["status"], e["reason"], e.get("work_id")) for e in entries] == [
        ("Journal of Things", "resolved", None, "https://x/W7"), ("Journal of Things", "unresolved", "empty_cleaned_scholar_title", None), ("Journal of Things", "unresolved", "no_candidates", None),
        ("Other", "unresolved", "low_confidence_match", None), ("Other", "unresolved", "low_confidence_match", None),
    ]
    first = entries[0]
    assert first["match_confidence"] == 1.0 and first["scholar_title"] == "Finding number 7 of many" and [c["confidence"] for c in first["candidates"]] == sorted((c["confidence"] for c in first["candidates"]), reverse=True)
    assert first["reference_stats"] == {"requested": 2, "found": 1, "accepted": 1, "skipped": 0, "skip_reasons": {}, "missing": 1} and first["sample_stats"]["written"] == 4
    folder = tmp_path / "finding-number-7-of-many"
    assert sorted(p.name for p in folder.iterdir()) == ["finding-number-7-of-many.json", "papers_before_finding-number-7-of-many.json", "references_finding-number-7-of-many.json"]
    assert len(json.loads((folder / "papers_before_finding-number-7-of-many.json").read_text())) == 4 and json.loads((folder / "finding-number-7-of-many.json").read_text())["match_confidence"] == 1.0
    assert manifest["scrape_failures"] == ["HTTP 429"] and len(manifest["unresolved"]) == 4 and manifest["journals"][0]["h5_index"] == 9


def test_parents_of_equal_titles(spark, tmp_path):
    rows = [("Journal of Things", 1, 2, i, "Finding number 7 of many", 2020) for i in range(2)]
    manifest = rest_runs.scholar_run(spark, spark.createDataFrame(rows, "journal string, h5_index int, h5_median int, ord int, title string, year int"), tmp_path, URL, count=1, seed=3, fetcher=catalog())
    assert [e["output_folder"].rsplit("/", 1)[-1] for e in manifest["papers"]] == ["finding-number-7-of-many", "finding-number-7-of-many-2"]


def test_waits():
    assert [rest.asked_wait(e) for e in (http("2.5"), http("-1"), http("Thu, 01 Jan"), http(None))] == [2.5, 0.0, None, None]


def http(asked):
    from email.message import Message
    from urllib.error import HTTPError

    headers = Message()
    if asked:
        headers["Retry-After"] = asked
    return HTTPError("u", 429, "m", headers, None)
