"""Operators against brute force: earlier works by running sums, configurations by row, searches by words."""

import datetime as dt
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_operators import frame, work

from paperloom.operators import papers, references, resolution, sampling, topics

D = dt.date


@pytest.mark.parametrize("seed", [1, 2])
def test_earlier_counts(spark, seed):
    rng = random.Random(seed)
    day = lambda: D(rng.randint(1998, 2012), rng.choice([1, 1, 7, 12]), rng.choice([1, 1, 15, 31]))
    rows = [(f"W{i}", "hot" if rng.random() < 0.6 else rng.choice("abc"), day()) for i in range(300)] + [("W900", None, D(2001, 1, 1)), ("W901", "a", None), (None, "a", D(2001, 1, 1))]
    rows += rows[:20]  # delivered again
    works = spark.createDataFrame(rows, "id string, topic_id string, published date")
    parents = works.where(F.col("id").isNotNull()).select(F.col("id").alias("parent"), "topic_id", "published").union(spark.createDataFrame([("P1", "hot", D(2005, 3, 3)), ("P2", "none", D(2005, 3, 3)), ("P3", "a", None)], "parent string, topic_id string, published date"))
    got = {(r.parent, r.topic_id): (r.n, r["first"], r["last"]) for r in references.earlier_counts(parents, works).collect()}
    slow = references.earlier_works(parents.dropDuplicates(), works.where(F.col("id").isNotNull()).dropDuplicates()).groupBy("parent", "topic_id").agg(F.count("*").alias("n"), F.min("published").alias("first"), F.max("published").alias("last"))
    assert got == {(r.parent, r.topic_id): (r.n, r["first"], r["last"]) for r in slow.collect()} and len(got) > 200
    assert references.earlier_counts(parents.limit(0), works).count() == 0 and references.earlier_counts(parents, works.limit(0)).count() == 0


CONFIGS = "config_id int, count int, from_publication_date string, to_publication_date string, work_type string, language string, domain string, field string, subfield string, topic string, sample_seed bigint, required_fields array<string>, fields array<string>, require_english_text boolean, require_clean_text boolean"


def test_configurations_by_row(spark):
    base = ["2024-01-01", None, "article", "en", "n", "N", "n", "TOPIC", 7]
    configs = spark.createDataFrame([(1, 2, *base, ["title"], ["title"], True, True), (2, 9, *base, ["title", "abstract"], ["title", "abstract"], False, True), (3, 9, *base, [], ["abstract", "publication_venue"], True, False), (4, 9, *base[:3], "de", *base[4:], [], ["title"], None, None)], CONFIGS)
    works = frame(spark, [work(1), work(2, display_name="Работа"), work(3, abstract_inverted_index='{"\\\\\\\\documentclass{a}":[0],"b":[1]}'), work(4, display_name=None), work(5, abstract_inverted_index="broken"), work(6, abstract_inverted_index=None)])
    matched = sampling.matching_all(works, configs)
    assert Counter(r.config_id for r in matched.collect()) == {1: 5, 2: 5, 3: 5}
    ranked = sampling.candidates_per_key(matched, "config_id", F.col("c_count"), F.col("c_sample_seed"), most=9)
    flags = ("config_id", "c_count", "c_required_fields", "c_fields", "c_require_english_text", "c_require_clean_text", "sample_rank", "id")
    parsed = papers.parse_papers(ranked, list(papers.COLUMNS), F.col("c_required_fields"), english=F.col("c_require_english_text"), clean=F.col("c_require_clean_text"), keep=flags, wanted=F.col("c_fields"))
    got = {(r.config_id, int(r.id[11:])): (r.title, r.abstract is not None, r.publication_date, r.publication_venue, r.skip_reasons) for r in parsed.collect()}
    assert {i: got[1, i][4] for i in range(1, 6)} == {1: [], 2: ["non_english_title"], 3: [], 4: ["missing_title"], 5: []} and not any(got[1, i][1] for i in range(1, 6))
    assert {i: got[2, i][4] for i in range(1, 6)} == {1: [], 2: [], 3: ["unclean_abstract"], 4: ["missing_title"], 5: ["malformed_abstract_json"]}
    assert {i: got[3, i][4] for i in range(1, 6)} == {1: [], 2: [], 3: [], 4: [], 5: ["malformed_abstract_json"]} and got[3, 1] == (None, True, None, "Raw & Co", [])
    seen = sampling.sample_stats(sampling.accept(parsed, F.col("c_count"), by=("config_id",), order=("sample_rank",)), ("config_id",))
    assert {r.config_id: (r.written, r.skipped) for r in seen.collect()}[2] == (2, 3) and {r.config_id: r.written for r in seen.collect()}[1] == 2
    assert sampling.matching_all(works.limit(0), configs).count() == 0 and sampling.matching_all(works, configs.limit(0)).count() == 0


def test_search(spark):
    rng = random.Random(3)
    words = [f"word{i}" for i in range(40)] + ["common"] * 20
    works = [(f"W{i}", " ".join(rng.sample(words, 6)), "V", "2020", i) for i in range(400)] + [("W900", None, None, None, None), ("W901", "", "V", "2020", 1)]
    articles = [(i, " ".join(rng.sample(words, 5)), "V", 2020) for i in range(20)] + [(50, "unknown words only", "V", 1), (51, "", None, None), (52, None, None, None)]
    a = spark.createDataFrame(articles, "article_id int, title string, journal string, year int")
    w = spark.createDataFrame(works, "id string, title string, venue string, published string, cited int")
    got = {}
    for r in resolution.searched(a, w, 3).collect():
        got.setdefault(r.article_id, set()).add(r.id)
    sets = {i: {x for x in (t or "").split() if len(x) > 1} for i, t, *_ in works}
    df = Counter(x for s in sets.values() for x in s)
    for i, title, *_ in articles:
        mine = {x for x in (title or "").split() if df[x]}
        least = min((df[x] for x in mine), default=0)
        use = {x: math.log((len(works) + 1) / df[x]) for x in mine if df[x] <= max(least, resolution.RARE_WORD * len(works))}
        scores = sorted(((-sum(use[x] for x in s & set(use)), k) for k, s in sets.items() if s & set(use)))[:3]
        assert got.get(i, set()) == {k for _, k in scores}
    scored = resolution.scored(a, w, resolution.searched(a, w).unionByName(resolution.searched(a, w)).distinct())
    lists = resolution.candidate_lists(scored, 4).collect()
    by = {}
    for r in sorted(lists, key=lambda r: (r.article_id, r.place)):
        by.setdefault(r.article_id, []).append(r.confidence)
    assert all(x == sorted(x, reverse=True) and len(x) <= 4 for x in by.values()) and 50 not in by
    assert resolution.candidates(a.limit(0), w).count() == 0 and resolution.resolve(a, w.limit(0), resolution.candidates(a, w.limit(0))).where("status = 'resolved'").count() == 0


def test_paths(spark):
    rows = [("x/T1", "A//b\\c. .", "S/1"), ("x/T2", "A/b\\c. ", "S/1"), ("x/T3", "...", "S"), ("x/T4", " a\x01\tb ", "S")]
    catalog = spark.createDataFrame([(i, n, {"id": "s", "display_name": s}) for i, n, s in rows], "id string, display_name string, subfield struct<id string, display_name string>")
    got = {r.id: r.path for r in topics.output_paths(catalog).collect()}
    assert got == {"x/T1": "S_1/A_b_c. ", "x/T2": "S_1/A_b_c", "x/T3": "S/unnamed", "x/T4": "S/a b"}
