import json
from email.message import Message
from urllib.error import HTTPError, URLError

import pytest
from pyspark.sql import functions as F
from test_operators import config, frame, work

from paperloom import cli, files, runtime, sinks
from paperloom.functions import names
from paperloom.plans import workflows
from paperloom.sources import rest, scholar, snapshot
from paperloom.streaming import builder


def http(code, **headers):
    message = Message()
    for k, v in headers.items():
        message[k.replace("_", "-")] = v
    return HTTPError("u", code, "m", message, None)


def test_retries():
    waits, answers = [], [http(429, Retry_After="7"), URLError("down"), {"ok": 1}]

    def once(url, params):
        got = answers.pop(0)
        if isinstance(got, Exception):
            raise got
        return got

    assert rest.fetch("u", {}, once=once, sleep=waits.append) == {"ok": 1} and waits == [7.0, 10.0]
    answers[:] = [http(404)]
    with pytest.raises(rest.CatalogError, match="404"):
        rest.fetch("u", {"api_key": "secret"}, once=once, sleep=waits.append)
    answers[:] = [http(503, Retry_After="61")]
    with pytest.raises(rest.CatalogError, match="wait"):
        rest.fetch("u", {}, once=once, sleep=waits.append)
    answers[:] = [URLError("x")] * 7
    with pytest.raises(rest.CatalogError):
        rest.fetch("u", {}, once=once, sleep=waits.append)
    assert "secret" not in rest.shown_url("u", {"api_key": "secret", "a": None}) and "REDACTED" in rest.shown_url("u", {"api_key": "secret"})
    assert rest.work_filters(config(), "https://x/T1/") == "from_publication_date:2024-01-01,type:article,language:en,has_abstract:true,primary_topic.id:T1,to_publication_date:2024-12-31"
    assert rest.sample_size(10) == 50 and rest.sample_size(9000) == 10_000


def test_pages():
    calls = []

    def fetcher(url, params):
        calls.append(params)
        if "cursor" in params:
            return {"results": [{"c": params["cursor"]}], "meta": {"next_cursor": "2" if params["cursor"] == "*" else None}}
        return {"results": [{"page": params["page"]}]}

    paged = rest.CatalogReader({"url": "u", "sample": "250", "per_page": "100", "param.seed": "1"}, fetcher)
    rows = [r for p in paged.partitions() for r in paged.read(p)]
    assert [json.loads(r[1])["page"] for r in rows] == [1, 2, 3] and calls[0] == {"seed": "1", "per_page": 100, "page": 1, "sample": 250}
    cursor = rest.CatalogReader({"url": "u"}, fetcher)
    assert [json.loads(r[1])["c"] for p in cursor.partitions() for r in cursor.read(p)] == ["*", "2"]
    with pytest.raises(rest.CatalogError):
        list(rest.CatalogReader({"url": "u"}, lambda u, p: {}).read(rest.Page(None)))


def test_source_registers(spark):
    spark.dataSource.register(rest.CatalogSource)
    assert spark.read.format("catalog").option("url", "u").load().columns == ["page", "record"]


PAGE = "<table><tr><th>Publication</th></tr><tr><td>1.</td><td>Alpha Letters</td><td><a href='/a'>120</a></td><td>200</td></tr><tr><td>Other</td><td>99</td></tr></table>"
CORE = "<table><tr><td>Title / Author</td></tr><tr><td><a href='x'>First paper</a></td><td>10</td><td>2021</td></tr><tr><td></td><td>Second</td><td>1999</td></tr></table>"


def test_scholar(spark, tmp_path):
    pages = spark.createDataFrame([(PAGE,)], "html string")
    assert [tuple(r) for r in scholar.top_journals(pages, "html", ["Alpha Letters", "Beta"]).collect()] == [("Alpha Letters", 120, 200, "/a")]
    got = scholar.core_articles(spark.createDataFrame([(CORE,)], "html string"), "html").collect()
    assert [(r.title, r.year) for r in got] == [("First paper", 2021), ("Second", 1999)]
    fixture = tmp_path / "f.json"
    fixture.write_text(json.dumps({"journals": [{"name": "J", "h5_index": "12", "articles": [{"title": "A", "year": "2020"}, "B"]}, {"name": "K", "papers": ["C"] * 30}]}))
    rows = scholar.read_json_fixture(spark, str(fixture)).collect()
    assert len(rows) == 22 and tuple(rows[0]) == ("J", 12, None, 0, "A", 2020)
    fixture.write_text('{"journals": [{"name": "J", "articles": [{"year": 1}]}]}')
    with pytest.raises(scholar.ScholarError):
        scholar.read_json_fixture(spark, str(fixture))
    table = tmp_path / "f.csv"
    table.write_text("journal_name,paper_title,year,h5_index\nB,t1,2001,5\nA,t2,x,\nB,t3,,9\n,t4,1,1\n")
    with pytest.raises(scholar.ScholarError):
        scholar.read_csv_fixture(spark, str(table))
    table.write_text("journal_name,paper_title,year,h5_index\nB,t1,2001,5\nA,t2,x,\nB,t3,,9\n")
    assert [(r.journal, r.h5_index, r.ord, r.title, r.year) for r in scholar.read_csv_fixture(spark, str(table)).collect()] == [("B", 5, 0, "t1", 2001), ("B", 5, 1, "t3", None), ("A", None, 0, "t2", None)]
    boom = lambda: (_ for _ in ()).throw(OSError("no net"))
    assert scholar.load(boom, lambda: 1) == (1, "fixture") and scholar.load(lambda: 2, None) == (2, "scrape")
    with pytest.raises(OSError):
        scholar.load(boom, None)


def test_scrape(spark):
    journals = "".join(f"<tr><td>{i}.</td><td>{n} (online)</td><td><a href='/c/{i}'>{120 + i}</a></td><td>200</td></tr>" for i, n in enumerate(names.VENUES))
    core = "<table><tr><th>Title / Author</th></tr>" + "".join(f"<tr><td>A finding of note number {i}A Smith, B Jones</td><td></td><td>{'' if i == 3 else 2000 + i}</td></tr>" for i in range(25)) + "</table>"
    pages = {"http://x/top": f"<table>{journals}</table>"} | {f"http://x/c/{i}": core for i in range(5)}
    rows = scholar.scrape(spark, "http://x/top", pages.__getitem__).collect()
    assert len(rows) == 100 and tuple(rows[3]) == (names.VENUES[0], 120, 200, 3, "A finding of note number 3", None) and rows[4].year == 2004
    for broken in ({"http://x/top": "<table></table>"}, {"http://x/c/2": "<table></table>"}):
        with pytest.raises(scholar.ScholarError, match="only"):
            scholar.scrape(spark, "http://x/top", (pages | broken).__getitem__)
    got, how = scholar.load(lambda: scholar.scrape(spark, "http://x/top", lambda at: ""), lambda: "given")
    assert (got, how) == ("given", "fixture")


def make_snapshot(spark, root, n=24):
    topics = [{"id": f"https://x/T{k}", "display_name": f"Topic{k}", "score": 0.1, "subfield": {"id": "s", "display_name": "S"}, "field": {"id": "f", "display_name": "F"}, "domain": {"id": "d", "display_name": "D"}} for k in range(3)]
    for part in range(3):
        rows = [work(i, primary_topic=topics[i % 3]) for i in range(part, n, 3)] + [work(900 + part, primary_topic=None)]
        frame(spark, rows).coalesce(1).write.parquet(str(root / f"updated_date=2026-01-0{part + 1}"))
    (root / "manifest.json").write_text(json.dumps({"date": "2026-01-03", "format": "parquet", "entity": "works", "record_count": n + 3}))


def test_snapshot_and_build(spark, tmp_path, monkeypatch):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    make_snapshot(spark, source)
    assert len(snapshot.inventory(source)) == 3 and snapshot.read_updates(spark, source).count() == 27
    state = builder.build(spark, source, out, files_per_batch=1, topic_buckets=4, id_buckets=8, stop_after="staging")
    assert state["phase"] == "compacting"
    with pytest.raises(builder.BuildError, match="files_per_batch"):
        builder.build(spark, source, out, files_per_batch=2, topic_buckets=4, id_buckets=8)
    work_ = str(out / "_build")
    every = builder.buckets(work_)
    real, done = builder.write_topic_partitions, []

    def breaks(*a, **k):
        if len(done) == 1:
            raise OSError("lost")
        real(*a, **k)
        done.append(1)

    monkeypatch.setattr(builder, "write_topic_partitions", breaks)
    with pytest.raises(OSError, match="lost"):
        builder.build(spark, source, out, files_per_batch=1, topic_buckets=4, id_buckets=8, buckets_at_once=1)
    assert len(builder.completed(work_)) == 1 and builder.buckets(work_) == every and len(every) > 1
    monkeypatch.setattr(builder, "write_topic_partitions", real)
    manifest = builder.build(spark, source, out, files_per_batch=1, topic_buckets=4, id_buckets=8, buckets_at_once=1)
    assert not list((out / "_build" / "staged").glob("batch=*/topic_bucket=*")) and sum(builder.completed(work_).values()) == 24
    assert manifest["record_count"] == 24 and manifest["topic_count"] == 3
    assert builder.build(spark, source, out, files_per_batch=1, topic_buckets=4, id_buckets=8) == manifest
    assert snapshot.validate(out)["layout"] == "primary_topic"
    assert snapshot.read_topic(spark, out, "T1").count() == 8
    for bad in ("T9", "../x", ""):
        with pytest.raises(snapshot.SnapshotError):
            snapshot.read_topic(spark, out, bad)
    wanted = spark.createDataFrame([("https://x/W4",), ("https://x/W999",)], "id string")
    assert [tuple(r) for r in snapshot.lookup_topics(spark, out, wanted, 8).collect()] == [("https://x/W4", "T1")]
    full = tmp_path / "full"
    full.mkdir()
    (full / "x").write_text("")
    with pytest.raises(builder.BuildError, match="other files"):
        builder.build(spark, source, full)
    c = config(domain="D", field="F", subfield="S", topic="topic1", count=3, output_path=str(tmp_path / "s.json"))
    both = [workflows.sample_snapshot(spark, p, c) for p in (source, out)]
    assert both[0]["papers"] == both[1]["papers"] and len(both[0]["papers"]) == 3
    assert both[0]["metadata"]["query"]["total_matching"] == 8 and "api_key" not in (tmp_path / "s.json").read_text()
    catalog = snapshot.read_catalog(spark, out).withColumn("topic_id", F.regexp_extract("id", "(T[0-9]+)$", 1))
    statuses, totals = workflows.topic_batch(spark.read.parquet(str(out / "data")), catalog, str(tmp_path / "batch"), count=5, existing=catalog.where("topic_id = 'T0'"))
    assert {r.topic_id: r.status for r in statuses.collect()} == {"T0": "skipped_existing", "T1": "written", "T2": "written"} and totals["papers"] == 10
    articles = spark.createDataFrame([(1, "Raw & Co", "Paper 7", 2024), (2, "Raw & Co", "", 2024)], "article_id int, journal string, title string, year int")
    statuses, manifest = workflows.scholar_run(articles, spark.read.parquet(str(out / "data")), str(tmp_path / "scholar"), count=4)
    assert {r.article_id: (r.status, r.work_id, r.slug) for r in statuses.collect()} == {1: ("resolved", "W7", "paper-7"), 2: ("unresolved", None, None)}
    assert manifest["references"] == {"requested": 1, "found": 1, "accepted": 1, "skipped": 0, "missing": 0} and spark.read.parquet(str(tmp_path / "scholar/papers_before")).count() == 2


@pytest.mark.parametrize("change", [{"format": "json"}, {"entity": "x"}, {"record_count": "1"}, {"layout": "z"}, {"date": ""}, None])
def test_snapshot_rejects(tmp_path, change):
    good = {"date": "d", "format": "parquet", "entity": "works", "record_count": 1}
    (tmp_path / "manifest.json").write_text("nope" if change is None else json.dumps(good | change))
    with pytest.raises(snapshot.SnapshotError):
        snapshot.validate(tmp_path)


def test_files_through_hadoop(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "_local", lambda path: None)
    at = f"file://{tmp_path}/x"
    assert not files.exists(at) and not files.is_folder(at)
    files.write_text(f"{at}/a=1/m.json", "é")
    files.write_text(f"{at}/a=1/m.json", "ü")
    assert files.read_text(f"{at}/a=1/m.json") == "ü" and files.names(at, "a=*/*.json") == ["a=1/m.json"] and files.is_folder(at)
    files.remove(at)
    assert files.names(at, "*") == [] and not files.exists(at)


def test_ship(spark, monkeypatch):
    import zipfile

    sent = []
    monkeypatch.setattr(type(spark.sparkContext), "addPyFile", lambda self, path: sent.append(path))
    runtime.ship(spark)
    with zipfile.ZipFile(sent[0].removeprefix("file:")) as archive:
        assert {"paperloom/__init__.py", "paperloom/operators/keyed.py"} <= set(archive.namelist())


def test_cli_runs(spark, tmp_path, monkeypatch, capsys):
    from test_rest_runs import URL, catalog

    monkeypatch.setattr(cli, "session", lambda args: spark)
    source = tmp_path / "in"
    source.mkdir()
    make_snapshot(spark, source)
    out, fixture = str(tmp_path / "out"), tmp_path / "f.json"
    fixture.write_text(json.dumps([{"name": "Raw & Co", "articles": [{"title": "Paper 7", "year": 2024}, "Paper 7"]}]))
    c = tmp_path / "c.json"
    c.write_text(json.dumps(config(domain="D", field="F", subfield="S", topic="topic1", count=3, output_path=str(tmp_path / "s.json")).public()))
    runs = [
        ["build", str(source), out, "--files-per-batch", "2"], ["sample", "--config", str(c), "--snapshot", out, "--count", "2"], ["topics", "--snapshot", out, str(tmp_path / "t"), "--count", "2"],
        ["scholar", str(tmp_path / "a"), "--fixture", str(fixture), "--snapshot", out, "--count", "3"], ["scholar", str(tmp_path / "b"), "--scrape", "http://x", "--fixture", str(fixture), "--url", URL, "--count", "1"],
        ["topics", "--url", URL, "--field-name", "Medicine", str(tmp_path / "u"), "--count", "2", "--seed", "1"],
    ]
    for run in runs:
        assert cli.main(run, fetcher=catalog(), fetch_page=lambda url: "") == 0, capsys.readouterr().err
    folders = [p.name for p in sorted((tmp_path / "a").glob("paper-7*"))]
    assert folders == ["paper-7", "paper-7-2"] and (tmp_path / "a/paper-7-2/papers_before_paper-7-2.json").exists()
    assert json.loads((tmp_path / "b/manifest.json").read_text())["scrape_failures"] and json.loads((tmp_path / "t/_manifest.json").read_text())["papers"] > 0


def test_sinks_and_cli(tmp_path, capsys):
    sinks.write_json_atomic(tmp_path / "a" / "x.json", {"é": 1})
    assert json.loads((tmp_path / "a" / "x.json").read_text()) == {"é": 1} and not (tmp_path / "a" / "x.json.tmp").exists()
    assert cli.parser().parse_args(["build", "a", "b"]).files_per_batch == 32
    for wrong in (["sample", "--config", str(tmp_path / "none"), "--snapshot", "x"], ["sample", "--config", "c"], ["topics", "--snapshot", "x", "y", "--count", "0"], ["scholar", "x", "--snapshot", "y"], ["scholar", "x", "--url", "u", "--fixture", "f", "--per-page", "101"]):
        assert cli.main(wrong) == 1 and "error" in capsys.readouterr().err
