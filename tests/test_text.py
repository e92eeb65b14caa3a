import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperloom.functions import names, text
from paperloom.functions.abstracts import reconstruct
from paperloom.functions.ids import has_text, last_segment, segment_after_slash, topic_key, work_key


@pytest.mark.parametrize(
    ("raw", "want", "malformed"),
    [
        ('{"a":[0],"b":[1]}', "a b", False), ('{"a":[0,2],"b":[1]}', "a b a", False), ('{"a":[0],"b":[0]}', "b", False), ('{"a":[0],"b":[2]}', None, False), ('{"a":[-1]}', None, False),
        ('{"a":[1.5]}', None, False), ("not-json", None, True), ("[]", None, True), ("null", None, True), ("{}", None, False), (None, None, False), ('{"a":[true],"b":[0]}', "b a", False), ('{"a":3}', None, False), ('{"a":["0"]}', None, False),
        ("", None, True), ("[" * 100000, None, True),
    ],
)
def test_reconstruct(raw, want, malformed):
    assert reconstruct(raw) == (want, malformed)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters=" "), min_size=1, max_size=5), min_size=1, max_size=40))
def test_reconstruct_inverts(words):
    import json

    index = {}
    for i, w in enumerate(words):
        index.setdefault(w, []).append(i)
    assert reconstruct(json.dumps(index))[0] == " ".join(words)


def test_clean():
    raw = pa.array(["a<br/>b  <p>c</p>", "&lt;p&gt;x", "A &amp;amp; B", None, "", "  ", "2 < 3"])
    assert text.without_markup(text.unescape(raw)).to_pylist() == ["a b c", "x", "A &amp; B", None, "", "", "2 < 3"]


def test_judges(spark):
    rows = [("Plain English words",), ("한국어 제목입니다",), ("Здравствуй мир",), ("1234",), ("café naïve",), (None,), ("",)]
    got = [r.e for r in spark.createDataFrame(rows, "t string").select(text.looks_english(F.col("t")).alias("e")).collect()]
    assert got == [True, False, False, False, True, None, False]
    rows = [("fine",), ("\\documentclass{a}",), ("<i>" * 6,), ("\\alpha " * 13,), ("x <br> " * 6,)]
    got = [r.e for r in spark.createDataFrame(rows, "t string").select(text.looks_clean(F.col("t"), F.lower("t")).alias("e")).collect()]
    assert got == [True, False, False, False, False]


def test_ids(spark):
    forms = ["https://x.example/W12", "w12", " W12 ", "x:W12", "https://x.example/works/W12/", "https://x.example/W12?view=full", "W", "n/a", "", None, "XW12", "W12a"]
    got = [r.k for r in spark.createDataFrame([(f,) for f in forms], "t string").select(work_key(F.col("t")).alias("k")).collect()]
    assert got == ["W12"] * 6 + [None] * 6
    row = spark.createDataFrame([("https://x/T1/", " ", "a")], "t string, b string, c string").select(last_segment(F.col("t")), segment_after_slash(F.col("t")), topic_key(F.col("t")), has_text(F.col("b")), has_text(F.col("c"))).first()
    assert tuple(row) == ("T1", "", "T1", False, True)


#: Pairs of a scraped title and what is left of it.
SCRAPED = [
    ("Clinical Characteristics of an Illness in TownW Guan, Z Ni, Y Hu, W LiangGreat Journal of Medicine 382 (18), 1708-1720", "Clinical Characteristics of an Illness in Town"),
    ("Ferric turns 10: Emerging mechanisms and applicationsBR StockwellCell 185 (14), 2401-2421", "Ferric turns 10: Emerging mechanisms and applications"),
    ("Hallmarks of things: An expanding universeC López-Otín", "Hallmarks of things: An expanding universe"),
    ("Persistent Symptoms After Acute ILLNESS-19A Carfì", "Persistent Symptoms After Acute ILLNESS-19"),
    ("A signature predicts severity and survivalDM Del Valle", "A signature predicts severity and survival"),
    ("Attributes and predictors of long COV", "Attributes and predictors of long COVID"),
    ("Title / Author", ""), ("", ""), (None, ""),
]


@pytest.mark.parametrize(("raw", "want"), SCRAPED)
def test_scraped_title(raw, want):
    assert names.scraped_title(raw, ("Cell",)) == want


def test_titles_and_slugs(spark):
    assert names.normal_title("The <i>Best</i> of: a Test_case") == "best of test case"
    assert names.likeness("", "x") == 0 and names.title_score("Main: Sub", "main") == 1.0 and names.title_score(None, "x") == 0
    used = set()
    assert [names.slug(t, used) for t in ("A Title!", "Title", "???", "???")] == ["title", "title-2", "paper", "paper-2"]
    assert len(names.slug("x" * 200)) == 80
    row = spark.createDataFrame([("a/b\\c\x01 d. ", "...", "Main: Sub", "Über 1999")], "a string, b string, c string, d string").select(
        names.safe_path_name(F.col("a")), names.safe_path_name(F.col("b")), names.search_titles(F.col("c")), names.first_year(F.col("d")), names.slug_column(F.col("c"))
    ).first()
    assert tuple(row) == ("a_b_c d", "unnamed", ["Main: Sub", "Main"], 1999, "main-sub")
