import datetime as dt
import json
import os
import random
from difflib import SequenceMatcher

import pytest
from conftest import SMALL, needs_data
from pyspark.sql import functions as F

from paperloom.functions import names
from paperloom.operators import keyed, nested, orphans, papers, references, resolution, sampling, topics
from paperloom.plans import reference
from paperloom.sources.config import ConfigError, api_key, make_config
from paperloom.sources.snapshot import WORKS

D = dt.date


def day(n):
    return D(2024, 1, n)


def test_orphans(spark):
    works = spark.createDataFrame([("A", ["B", "C", "X", "X", None], day(1)), ("B", None, day(2)), ("C", ["A"], day(3)), ("C", ["B"], day(9)), (None, ["Q"], day(4))], "id string, refs array<string>, at date")
    gone = spark.createDataFrame([("B", day(2)), ("C", day(5)), ("C", day(4)), ("Z", day(1))], "id string, at date")
    events = orphans.deliveries(works, F.col("id"), F.col("at"), F.col("refs")).unionByName(orphans.deletions(gone, F.col("id"), F.col("at")))
    state = orphans.fold(orphans.deltas(events))
    assert {r.key: r.refs for r in orphans.orphan_keys(state).collect()} == {"B": 2, "X": 1, "Q": 1}  # deleted on the day, never there; C came back
    named = events.where("key is not null")
    assert sorted(orphans.fold(orphans.deltas(named.repartition(5).union(named))).collect()) == sorted(state.where("key <> 'Q'").collect())  # repeated rows
    refs = works.select("id", F.explode("refs").alias("r")).where("r is not null")
    assert {(r.id, r.r) for r in orphans.orphan_references(refs, state, "r", "id", salted=1).collect()} == {("A", "B"), ("A", "X"), ("C", "B"), (None, "Q")}
    assert orphans.orphan_keys(orphans.fold(orphans.deltas(events.limit(0)))).count() == 0


def test_signed_deltas(spark):
    one = lambda rows: spark.createDataFrame(rows, "id string, at date, present boolean, refs array<string>").withColumnRenamed("id", "key")
    first = one([("A", day(1), True, ["X", "Y"]), ("B", day(1), True, ["X"])])
    then = one([("A", day(5), True, ["Y", "Z"]), ("B", day(6), False, [])])
    got = {(r.key, r.refs, r.existence) for r in orphans.deltas(then, orphans.last_events(first)).where("refs <> 0 OR existence <> 0").collect()}
    assert got == {("X", -1, 0), ("Z", 1, 0), ("B", 0, -1)}
    assert orphans.deltas(then, orphans.last_events(first)).where("key = 'X' AND refs = -1").count() == 2  # dropped by A, gone with B
    late = one([("A", day(3), True, ["L"]), ("B", day(2), True, ["M"])])
    state = orphans.fold(orphans.deltas(first), orphans.deltas(then, orphans.last_events(first)), orphans.deltas(late, orphans.last_events(then, orphans.last_events(first))))
    assert {r.key: (r.refs, r.mentions > 0, r.existence) for r in state.collect()} == {"A": (0, False, 1), "B": (0, False, 0), "X": (0, True, 0), "Y": (1, True, 0), "Z": (1, True, 0), "L": (0, True, 0), "M": (0, True, 0)}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_orphans_batch_by_batch_equal_all_at_once(spark, tmp_path, seed):
    rng = random.Random(seed)
    keys = [f"W{i}" for i in range(12)]
    rows = [(rng.choice(keys), day(rng.randint(1, 20)), rng.random() < 0.8, rng.sample(keys + ["X", "Y"], rng.randint(0, 4))) for _ in range(80)]
    rows = sorted(((k, at, there, refs if there else []) for k, at, there, refs in rows), key=lambda r: r[1])
    frame_ = lambda part: spark.createDataFrame(part, "key string, at date, present boolean, refs array<string>")
    cuts = sorted(rng.sample(range(1, 80), 3))
    for a, b in zip([0, *cuts], [*cuts, 80], strict=True):  # batches part within days, too
        state = orphans.update(frame_(rows[a:b]), str(tmp_path / "state"))
    whole = orphans.fold(orphans.deltas(frame_(rows)))
    assert {r.key: (r.refs, r.existence) for r in state.collect()} == {r.key: (r.refs, r.existence) for r in whole.collect()}
    assert sorted(orphans.orphan_keys(state).collect()) == sorted(orphans.orphan_keys(whole).collect())
    now = {}
    for key, at, there, refs in rows:
        before = now.get(key)
        if before and before[0] == at and before[1] == there:
            refs = [*before[2], *refs]
        if not (before and before[0] == at and there and not before[1]):  # a deletion on the day counts as the later event
            now[key] = (at, there, refs)
    want = {k: sum(k in set(refs) for _, there, refs in now.values() if there) for k in keys + ["X", "Y"]}
    got = {r.key: r.refs for r in state.collect()}
    assert all(got.get(k, 0) == n for k, n in want.items())


def test_keyed(spark):
    rows = [("hot", f"i{n % 40}") for n in range(60)] + [("b", "x"), ("c", None), (None, "y")]
    df = spark.createDataFrame(rows, "k string, item string").repartition(5)
    assert {r.key: r.rows for r in keyed.heavy_keys(df, F.col("k"), 0.3).collect()} == {"hot": 60}
    assert {r.key: r.n for r in keyed.per_key(df, F.col("k"), {"n": F.count("*")}).collect()} == {"hot": 60, "b": 1, "c": 1}
    assert {r.key: r["items"] for r in keyed.distinct_per_key(df, F.col("k"), F.col("item")).collect()} == {"hot": 40, "b": 1}
    a = sorted(keyed.sample_per_key(df, F.col("k"), F.col("item"), 3, 1).collect())
    assert a == sorted(keyed.sample_per_key(df.repartition(2).union(df), F.col("k"), F.col("item"), 3, 1).collect()) and len(a) == 4
    assert keyed.heavy_keys(df.limit(0), F.col("k"), 0.1).count() == 0


SPECS = {"root": ("", {"x": "x"}), "one": ("p", {"name": "s.n", "raw": "r"}), "many": ("l[]", {"name": "s.n", "raw": "r"}), "deep": ("l[].q[]", {"x": "x"})}
RECORDS = [
    {"x": 1, "p": {"s": {"n": 'a "q" \\ b'}, "r": None}, "l": [None, {"s": None, "r": "é\n"}, {"s": {"n": ""}, "q": [{"x": 1.5}, {"x": True}]}]},
    {"p": None, "l": []}, {}, {"p": {}, "l": [{"s": {"n": "[]{},:"}}]}, {"p": "scalar", "l": [1, [2], {"r": {"z": 1}}]},
]


def plain(record, at):
    """The same rows from parsed JSON."""
    def get(o, path):
        for k in path.split("."):
            o = o.get(k) if isinstance(o, dict) else None
        return None if o is None or isinstance(o, (dict, list)) else o if isinstance(o, str) else json.dumps(o)

    out = [(at, "root", 0, {"x": get(record, "x")})]
    if isinstance(record.get("p"), dict):
        out.append((at, "one", 0, {"name": get(record["p"], "s.n"), "raw": get(record["p"], "r")}))
    for i, e in enumerate(record.get("l") or [], 1):
        if isinstance(e, dict):
            out.append((at, "many", i, {"name": get(e, "s.n"), "raw": get(e, "r")}))
            out += [(at, "deep", j, {"x": get(q, "x")}) for j, q in enumerate(e.get("q") or [], 1)]
    return out


@pytest.mark.parametrize("style", [{}, {"indent": 1}, {"ensure_ascii": False}])
def test_nested(spark, style):
    texts = [json.dumps(r, **style) for r in RECORDS] + [None, "", '{"x": "open', '{"l": [1}', '}{', "[1, 2"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, j string").withColumn("child", F.lit("clash")).coalesce(1)
    got = nested.flatten_json(df, "j", ["k"], SPECS).collect()
    fields = ["x", "name", "raw"]
    want = [(k, c, p, tuple(v.get(f) for f in fields)) for i, r in enumerate(RECORDS) for k, c, p, v in plain(r, i)]
    assert sorted(map(str, want)) == sorted(str((r.k, r.child, r.pos, tuple(r[f] for f in fields))) for r in got)
    assert nested.flatten_json(df.limit(0), "j", ["k"], SPECS).count() == 0


NODE = {"id": "i", "display_name": "N"}
TOPIC = {"id": "https://x/T1", "display_name": "Topic", "score": 0.5, "subfield": NODE, "field": NODE, "domain": NODE}
PLACE = {"source": {"display_name": " "}, "raw_source_name": "Raw &amp; Co"}


def work(i, **more):
    base = {
        "id": f"https://x/W{i}", "doi": None, "display_name": f"Paper {i}", "abstract_inverted_index": '{"A":[0],"paper":[1]}', "publication_date": D(2024, 1, 1) + dt.timedelta(days=i), "language": "en", "type": "article",
        "primary_topic": TOPIC, "primary_location": PLACE, "locations": [PLACE], "referenced_works": [f"https://x/W{i - 1}"] if i else [], "cited_by_count": 100 - i,
    }
    return base | more


def frame(spark, rows):
    return spark.createDataFrame(rows, WORKS)


def config(**more):
    base = {
        "count": 5, "from_publication_date": "2024-01-01", "to_publication_date": "2024-12-31", "work_type": "article", "language": "en", "domain": "n", "field": "N", "subfield": "N", "topic": "TOPIC", "field_match": "primary",
        "sample_seed": 7, "required_fields": ["title", "abstract"], "fields": ["title", "abstract", "publication_date", "publication_venue"], "output_path": "out.json", "per_page": 10, "require_english_text": True, "require_clean_text": True,
    }
    return make_config(base | more)


def test_parse(spark):
    rows = [work(0), work(1, display_name=" "), work(2, abstract_inverted_index="not-json"), work(3, abstract_inverted_index=None, display_name="한국어"), work(4, primary_location=None, locations=[None, {"source": {"display_name": "V<i>1</i>"}, "raw_source_name": None}]), work(5, locations=None, primary_location=None, publication_date=None)]
    got = {r.id[-1]: r for r in papers.parse_papers(frame(spark, rows), list(papers.COLUMNS), ["title", "abstract"], english=True, clean=True).collect()}
    assert got["0"].skip_reasons == [] and got["0"].publication_venue == "Raw & Co" and got["0"].publication_date == "2024-01-01" and got["0"].abstract == "A paper"
    assert got["1"].skip_reasons == ["missing_title"] and got["2"].skip_reasons == ["malformed_abstract_json"]
    assert got["3"].skip_reasons == ["missing_abstract", "non_english_title"]
    assert got["4"].publication_venue == "V 1" and got["5"].publication_venue is None and got["5"].publication_date is None
    assert {r.reason: r.n for r in papers.skip_histogram(papers.parse_papers(frame(spark, rows), ["title"], ["title"])).collect()} == {"missing_title": 1}


def test_sampling(spark):
    works = frame(spark, [work(i, display_name=None if i % 3 == 0 else f"Paper {i}") for i in range(60)])
    c = config()
    assert sampling.matching(works, c).count() == 60 and sampling.matching(works, config(language="de")).count() == 0
    a = [r.id for r in sampling.candidates(works, 5, 7).collect()]
    assert a == [r.id for r in sampling.candidates(works.repartition(7), 5, 7).collect()] and len(a) == 25
    assert a != [r.id for r in sampling.candidates(works, 5, 8).collect()]
    parsed = papers.parse_papers(sampling.candidates(works, 5, 7), ["title", "abstract"], ["title", "abstract"], keep=("id", "sample_key"))
    seen = sampling.accept(parsed, 5).orderBy("sample_key", "id").collect()
    ok = ["W" + x.rsplit("W")[-1] for x in a if int(x.rsplit("W")[-1]) % 3][:5]
    assert ["W" + r.id.rsplit("W")[-1] for r in seen if r.ok] == ok and seen[-1].ok == 1
    assert 0 <= sampling.generate_seed() < sampling.MOST_SEED
    per = sampling.candidates_per_key(works.withColumn("t", F.pmod("cited_by_count", F.lit(2))), "t", 2, 7)
    assert {r.t: r["count"] for r in per.groupBy("t").count().collect()} == {0: 10, 1: 10}


def test_config(monkeypatch, tmp_path):
    for bad in ({"count": 0}, {"count": True}, {"count": 20_000}, {"from_publication_date": "2024"}, {"fields": []}, {"fields": ["x"]}, {"required_fields": ["doi"]}, {"fields": ["title"]}, {"per_page": 101}, {"field_match": "any"}, {"sample_seed": "1"}, {"topic": " "}, {"require_clean_text": 1}):
        with pytest.raises(ConfigError):
            config(**bad)
    assert config(required_fields=["publication_date", "publication_venue"]).required_fields == ("publication_date", "publication_venue")
    plain = {k: v for k, v in config().public().items() if not k.startswith("require_")}
    for language, english in (("en", True), ("de", False)):
        made = make_config(plain | {"language": language})
        assert (made.require_english_text, made.require_clean_text) == (english, True)
    for key in ("to_publication_date", "sample_seed"):
        with pytest.raises(ConfigError, match=key):
            make_config({k: v for k, v in config().public().items() if k != key})
    assert "api_key" not in config().public()
    env = tmp_path / ".env"
    env.write_text("K= 'file' \n")
    assert api_key("K", env) == "file"
    monkeypatch.setenv("K", " ")
    assert api_key("K", env) is None


def test_topics(spark):
    catalog = spark.createDataFrame([("T1", "Topic", NODE, NODE, NODE), ("T2", "Straße", NODE, NODE, NODE), ("T3", "Twice", NODE, NODE, NODE), ("T4", "twice", NODE, NODE, NODE)], "id string, display_name string, subfield struct<id string, display_name string>, field struct<id string, display_name string>, domain struct<id string, display_name string>")
    assert topics.find_topic(catalog, config())["topic"]["id"] == "T1"
    assert topics.find_topic(catalog, config(topic="STRASSE"))["topic"]["id"] == "T2"
    for name in ("none", "Twice"):
        with pytest.raises(topics.TopicError):
            topics.find_topic(catalog, config(topic=name))
    assert topics.find_field(catalog, "n") == "i"
    works = frame(spark, [work(1), work(2, primary_topic=None), work(3, primary_topic=TOPIC | {"field": None})])
    got = [r.h for r in works.orderBy("id").select(topics.hierarchy(F.col("primary_topic"), strict=False).alias("h")).collect()]
    assert got[1] is None and got[2].field.id is None
    with pytest.raises(Exception, match="topic level"):
        works.select(topics.hierarchy(F.col("primary_topic"), strict=True).alias("h")).collect()


def test_resolution(spark):
    articles = spark.createDataFrame([(1, "Deep thing: a study", "J One", 2020), (2, "", "J One", 2020), (3, "Nothing alike here", "J", None), (4, "Nearly alike zebra title", "J One", 2019)], "article_id int, title string, journal string, year int")
    works = spark.createDataFrame([("W1", "Deep thing", "J One", "2020-05-01", 3), ("W2", "Deep thing", "J One", "2020-06-01", 9), ("W3", "Zebra", "Other", None, None), ("W4", None, None, None, 1)], "id string, title string, venue string, published string, cited int")
    got = {r.article_id: r for r in resolution.resolve(articles, works, resolution.candidates(articles, works)).collect()}
    assert got[1].status == "resolved" and got[1].work_id == "W2" and got[1].confidence == 1.0
    assert [got[i].reason for i in (2, 3, 4)] == ["empty_cleaned_scholar_title", "no_candidates", "low_confidence_match"]


def test_resolution_without_a_rare_word(spark):
    # Every word of the article but a misspelt one stands in more than 20 titles.
    works = [(f"W{i}", f"Effects of {w} on muscle tone at night in older adults", "J One", "2020-05-01", i) for i, w in enumerate(f"z{a}o{b}binol" for a in "bcdfg" for b in "klmnp")]
    works += [("W90", "Effects of zbokbinol on muscle tone at night in older adults", "J Two", "2020-05-01", 99), ("W91", "Muscle tone", "J One", None, 1), ("W92", None, "J One", None, 1), ("W93", "Muscle tone", None, None, 1)]
    articles = [(1, "Effects of zbokbinoll on muscle tone at night in older adults", "J. One", 2020), (2, "Muscle tone: effects of zbobkinol on older adults", "J One", 2021), (3, "Tone of muscle in adults", "J One", None), (4, None, "J One", 2020), (5, "Muscle tone", None, 2020)]
    a = spark.createDataFrame(articles, "article_id int, title string, journal string, year int")
    w = spark.createDataFrame(works, "id string, title string, venue string, published string, cited int")
    got = {r.article_id: (r.status, r.work_id) for r in resolution.resolve(a, w, resolution.candidates(a, w)).collect()}
    assert got == {1: ("resolved", "W0"), 2: ("resolved", "W91"), 3: ("unresolved", None), 4: ("unresolved", None), 5: ("unresolved", None)}
    with pytest.raises(ValueError):
        resolution.candidates(a, w, least=0.8)


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01"), reason="no test data")
def test_resolution_equals_brute_force(spark):
    d = "/root/testdata/sf0.01"
    articles, one = reference.scholar_titles(spark, d), reference.one_title(spark, d)
    every = articles.select("article_id", names.normal_title_udf("journal").alias("v")).join(one.select("id", names.normal_title_udf("venue").alias("v")), "v").select("article_id", "id")  # the rest scores 0.83 at most
    want = {r.article_id: r for r in resolution.resolve(articles, one, every).where("status = 'resolved'").collect()}
    got = {r.article_id: r for r in reference.resolved_articles(spark, d).where("status = 'resolved'").collect()}
    assert len(want) > 50 and {k: (r.work_id, r.confidence) for k, r in got.items()} == {k: (r.work_id, r.confidence) for k, r in want.items()}


@pytest.mark.parametrize("letters", ["abcdef ", "aé漢 b"])
def test_bounds_of_likeness(letters):
    rng = random.Random(5)
    one = lambda: "".join(rng.choice(letters) for _ in range(rng.choice([1, 5, 63, 64, 65, 128, 130, rng.randint(1, 200)])))
    a, b = [one() for _ in range(150)], [one() for _ in range(150)]
    (x, p), (y, q) = names.bags(a), names.bags(b)
    letters_shared = [sum((int(i) & int(j) & (1 << 64) - 1).bit_count() for i, j in zip(u, v, strict=True)) + min(m, n) for u, v, m, n in zip(x, y, p, q, strict=True)]
    blocks = [sum(m.size for m in SequenceMatcher(None, s, t).get_matching_blocks()) for s, t in zip(a, b, strict=True)]
    assert all(m <= c <= s for m, c, s in zip(blocks, names.common(a, b), letters_shared, strict=True))


def test_references(spark):
    parents = spark.createDataFrame([("P", ["A", "A", " ", None, "B"]), ("Q", None)], "p string, refs array<string>")
    parsed = spark.createDataFrame([("A", []), ("C", ["x"])], "id string, skip_reasons array<string>")
    rows = references.lookup(parents, F.col("refs"), F.col("p"), parsed)
    assert references.lookup_stats(rows).first().asDict() == {"parent": "P", "requested": 2, "n_found": 1, "accepted": 1, "skipped": 0, "missing": 1}
    works = spark.createDataFrame([("A", "T", D(2015, 1, 1)), ("B", "T", D(2014, 12, 31)), ("C", "T", D(2020, 2, 29)), ("D", "U", D(2019, 1, 1)), ("E", "T", None)], "id string, topic_id string, published date")
    parent = spark.createDataFrame([("C", "T", D(2020, 2, 29))], "parent string, topic_id string, published date")
    assert [r.id for r in references.earlier_works(parent, works).collect()] == ["A"]


@needs_data
def test_queries_equal_sql(spark):
    import __spark_entry__ as entry
    from oracle import compare, views

    from paperloom.plans import general, reference

    con, sql = views(SMALL), general.SQL | reference.SQL
    for name, query in (reference.QUERIES | general.QUERIES).items():
        got = query(spark, SMALL).toPandas()
        if name in sql:
            assert compare(got, con.execute(sql[name]).df()) == "", name
    assert set(entry.oracle_sql()) <= set(entry.queries())
