import itertools
import random
from fractions import Fraction

import pytest
from conftest import SMALL, needs_data
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperloom.llm import encode, language, linkage, mixture, near_duplicates, queries, sentences, stable_sample
from paperloom.sources.tables import table

# ---------------------------------------------------------------- token ids


@pytest.fixture(scope="module")
def small_bpe():
    return encode.ByteBpe(encode.vocabulary(), long=50, leaf=16, window=2)


@settings(max_examples=80, deadline=None)
@given(st.one_of(st.text(max_size=400), st.text("ab", min_size=100, max_size=400), st.text("the \n", max_size=300), st.text("ナミ한абв ", max_size=300)))
def test_tree_equals_whole(text):
    bpe = encode.ByteBpe.__new__(encode.ByteBpe)
    bpe.__dict__ |= encode.encoder(encode.vocabulary()).__dict__ | {"long": 50, "leaf": 16, "window": 2}
    assert bpe.encode(text) == bpe.encoding.encode_ordinary(text)


def test_encode_column(spark, small_bpe):
    rows = [(1, None, 9), (2, "", 9), (3, "<|endoftext|> hi", 9), (4, "x" * 9000, 9), (4, "x" * 9000, 9)]
    got = encode.encode_texts(spark.createDataFrame(rows, "doc_id int, text string, n int"), "text").collect()
    assert [r.ids for r in got[:2]] == [[], []] and 50256 not in got[2].ids and got[3].ids == got[4].ids == small_bpe.encode("x" * 9000)
    assert [r.n_tokens for r in encode.count_tokens(spark.createDataFrame(rows, "doc_id int, text string, n int"), "text").collect()] == [len(r.ids) for r in got]
    assert encode.encode_texts(spark.createDataFrame([], "doc_id int, text string"), "text").count() == 0
    clash = spark.createDataFrame([(1, "hi", "old")], "doc_id int, text string, ids string")
    assert encode.encode_texts(clash, "text").first().ids == small_bpe.encode("hi")


def test_trees_at_production_parameters(monkeypatch):
    bpe, trees = encode.ByteBpe(encode.vocabulary()), []
    real = bpe.tree
    monkeypatch.setattr(bpe, "tree", lambda piece: trees.append(len(piece)) or real(piece))
    for text in ["これはとても長い名前をもつ酵素についての報告です。", "x" * 40, " " * 40 + "y", "語" * 7000 + " " + "ab" * 9000, "é" * 17 + "!" * 500]:
        before = len(trees)
        assert bpe.encode(text) == bpe.encoding.encode_ordinary(text) and len(trees) > before and min(trees) > encode.LEAF
    trees.clear()
    assert bpe.encode("Short words only, 12 of them.") and not trees


# ---------------------------------------------------------------- stable samples


def test_stable_sample(spark):
    def rows(n, weight):
        return spark.createDataFrame([(1, f"W{i}", weight, 7, 0.2) for i in range(n)], "config_id int, work_id string, weight double, seed bigint, rate double")

    state = stable_sample.running_weights(rows(400, 1.0))
    first = {r.work_id for r in stable_sample.select(state).collect()}
    assert first == {r.work_id for r in stable_sample.select(stable_sample.running_weights(rows(400, 1.0).repartition(7))).collect()} and 50 < len(first) < 110
    later = stable_sample.running_weights(rows(600, 0.5).union(rows(10, 2.0)), state)
    assert first <= {r.work_id for r in stable_sample.select(later).collect()}
    assert stable_sample.select(stable_sample.running_weights(rows(400, 1.0).limit(0))).count() == 0


def test_stored_weights(spark, tmp_path):
    def rows(pairs):
        return spark.createDataFrame([(1, w, x, 7, 0.2) for w, x in pairs], "config_id int, work_id string, weight double, seed bigint, rate double")

    first = stable_sample.update(rows([(f"W{i}", 2.0) for i in range(300)]), str(tmp_path / "w"))
    before = {r.work_id for r in stable_sample.select(first).collect()}
    (tmp_path / "w" / "00000001").mkdir()  # a run that broke off
    later = stable_sample.update(rows([(f"W{i}", 1.0) for i in range(100)] + [(f"W{i}", 1.0) for i in range(900, 950)]), str(tmp_path / "w"))  # a snapshot that lacks most, with lower weights
    after = {r.work_id for r in stable_sample.select(later).collect()}
    assert before <= after and later.count() == 350 and len(before) > 50


# ---------------------------------------------------------------- mixing


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1000), st.one_of(st.just(0.0), st.floats(1e-9, 1)), st.integers(0, 5)), min_size=1, max_size=8), st.floats(0, 5000))
def test_water_fill(sources, budget):
    sizes, shares, limits = ({str(i): s[k] for i, s in enumerate(sources)} for k in range(3))
    got = mixture.water_fill(sizes, shares, limits, budget)
    usable = sum(sizes[s] * limits[s] for s in sizes if shares[s] > 0)
    assert all(got[s] <= sizes[s] * limits[s] + 1e-6 for s in got) and sum(got.values()) <= budget + 1e-6
    assert sum(got.values()) == pytest.approx(min(budget, usable))
    free = [got[s] / shares[s] for s in got if shares[s] > 0 and 0 < got[s] < sizes[s] * limits[s] - 1e-6]
    assert not free or max(free) == pytest.approx(min(free))


def test_mix(spark):
    docs = [(i, "abc"[i % 3], 10) for i in range(300)] + [(900, None, 10), (901, "unlisted", 10), (902, "a", 0)]
    sized = spark.createDataFrame(docs, "doc_id bigint, source string, n_tokens bigint")
    weights = spark.createDataFrame([("a", 0.6, 1), ("b", 0.2, 9), ("c", 0.2, None), ("empty", 0.5, 3), (None, 0.5, 1)], "source string, target_share double, max_repeats int")
    mixed, planned = mixture.mix(sized, weights, item="doc_id", seed=1)
    rows = sorted(mixed.collect())
    used = {s: sum(r.n_tokens * r.repeats for r in rows if r.source == s) for s in "abc"}
    assert used["a"] == 1000 and used["c"] == 1000 and abs(used["b"] - 1000) <= 10 and {r.source for r in rows} == set("abc")
    again = mixture.mix(sized.repartition(5), weights, item="doc_id", seed=1)[0]
    assert rows == sorted(again.collect())
    part, planned = mixture.mix(sized, weights, item="doc_id", seed=1, budget=500.0)
    report = {r.source: r for r in mixture.report(part, planned).collect()}
    assert report["a"].used_tokens == pytest.approx(300, abs=10) and report["empty"].used_tokens == 0
    assert mixture.mix(sized.limit(0), weights, item="doc_id", seed=1)[0].count() == 0


# ---------------------------------------------------------------- languages


@needs_data
def test_language_held_out(spark):
    rows = language.labelled_samples(table(spark, SMALL, "language_samples"))
    model = language.fit([r for i, r in enumerate(rows) if i % 4])
    reader = language.Reader(model)
    held = [r for i, r in enumerate(rows) if not i % 4]
    right = sum(bool(a) and a[0][0] == lang for (lang, _), a in zip(held, reader.read([t for _, t in held]), strict=True))
    assert right >= 0.95 * len(held)
    by = dict(held)
    mixed = f"{by['en']} {by['ru']} {by['ja']}"
    assert {a[0] for a in reader.read([mixed])[0]} == {"en", "ru", "ja"}
    assert reader.read([None, "", "(1)", "<br/>", "…"]) == [[]] * 5
    assert reader.read([by["de"] * 200])[0][0][0] == "de"
    texts = spark.createDataFrame([(1, by["fr"], "x"), (2, None, "y")], "k int, text string, lang_label string")
    assert [(r.k, r.lang) for r in language.identify(texts, "text", ["k"], model).collect()] == [(1, "fr")]


#: Languages and letters that no model is trained on.
FOREIGN = [
    "De onderzoekers vergeleken de behandeling met een placebo in een groep van volwassen patiënten. Het verschil was klein maar duidelijk.",
    "Tutkijat vertasivat hoitoa lumelääkkeeseen aikuisilla potilailla. Ero ryhmien välillä oli pieni mutta selvä.",
    "Οι ερευνητές συνέκριναν τη θεραπεία με εικονικό φάρμακο σε ενήλικες ασθενείς. Η διαφορά ήταν μικρή αλλά σαφής.",
    "Badacze porównali leczenie z placebo u dorosłych pacjentów. Różnica między grupami była mała, ale wyraźna.",
    "xqzv wrtk plmn bvcx zzqk jhgf dswq mnbv lkjp oiuy trew qasd zxcv bnmk",
]


@needs_data
def test_rejection_and_segments(spark):
    papers, _, model = queries._papers(spark, SMALL.replace("sf0.001", "sf0.01"))  # a tenth of that has too few labelled papers for narrow limits
    reader = language.Reader(model)
    assert [[x[0] for x in found] for found in reader.read(FOREIGN)] == [[language.UNKNOWN]] * len(FOREIGN)
    rows = language.labelled_samples(table(spark, SMALL, "language_samples"))
    assert sum(found[0][0] != lang for (lang, _), found in zip(rows, reader.read([t for _, t in rows]), strict=True)) <= 2
    by = dict(rows)
    text = f"<p>{by['en']} {by['en']}</p>\n{by['ru']} Or. {by['ja']}"
    found = reader.segments([text, None, " "])
    assert [x[2] for x in found[0]] == ["en", "ru", "ja"] and found[1:] == [[], []]
    (a, b, _, _), (c, d, _, sure), (e, f, _, _) = found[0]
    assert text[a:b].startswith(by["en"][:10]) and text[c:d].startswith(by["ru"]) and text[e:f] in by["ja"] and f <= len(text) and 0.5 < sure <= 1
    segments = language.segments(papers.select("paper_id", "abstract"), "abstract", ["paper_id"], model)
    langs = segments.groupBy("paper_id").agg(F.collect_set("lang").alias("langs"))
    whole = language.identify(papers.select("paper_id", "abstract"), "abstract", ["paper_id"], model).groupBy("paper_id").agg(F.collect_set("lang").alias("all"))
    assert langs.join(whole, "paper_id", "full").where("langs IS NULL OR all IS NULL OR NOT array_sort(langs) = array_sort(all)").count() == 0


def test_probabilities_sum_to_one():
    model = language.fit([("en", "the cat sat on the mat"), ("en", "a dog ran"), ("de", "der Hund lief"), ("de", "die Katze")])
    prob, back, base, langs = language._train({"en": ["the", "cat", "sat"], "de": ["der", "hund"]}, 50)
    import numpy as np

    i = langs.index("en")
    seen = [g for g in prob if g[:-1] == "\x02t" and len(g) == 3]
    assert model.langs == ["de", "en"] and 0 < sum(np.exp(prob[g][i]) for g in seen) <= 1 + 1e-9


def test_labels(spark):
    raw = ["EN", "en-US", "eng", "English", "pt_BR", "", " ", None, "und", "n/a"]
    got = [r.c for r in spark.createDataFrame([(x,) for x in raw], "t string").select(language.label_code(F.col("t")).alias("c")).collect()]
    assert got == ["en", "en", "en", "en", "pt", None, None, None, "und", "n"]


# ---------------------------------------------------------------- near-duplicates


def brute(sets, t):
    out = set()
    for (a, x), (b, y) in itertools.combinations(sorted(sets.items()), 2):
        if x and y and Fraction(len(x & y), len(x | y)) >= t:
            out.add((a, b))
    return out


@pytest.mark.parametrize(("size", "threshold"), [(3, Fraction(3, 5)), (5, Fraction(4, 5)), (1, Fraction(9, 10))])
def test_near_duplicates(spark, size, threshold):
    rng = random.Random(size)
    base = [[rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 3) for _ in range(rng.randint(20, 60))] for _ in range(20)]
    rows = []
    for words in base:
        for _ in range(5):
            copy = words[:]
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = rng.choice(["edit", "x", "common"])
            rows.append((len(rows), " ".join(copy)))
    rows += [(900, rows[0][1]), (901, rows[0][1]), (902, ""), (903, None), (904, "one")]
    df = spark.createDataFrame(rows, "id bigint, text string")
    sets = {i: {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} for i, t in rows for w in [(t or "").split()]}
    records = df.select("id", near_duplicates.shingles(F.coalesce(near_duplicates.words(F.col("text")), F.array().cast("array<string>")), size).alias("shingles"))
    members, reps = near_duplicates.classes(records.where(F.size("shingles") > 0))
    pairs = near_duplicates.similar_pairs(reps, threshold)
    got = {(r.id_a, r.id_b) for r in near_duplicates.expand(pairs, members).collect()}
    assert got == brute(sets, threshold) and len(got) > 10


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (50, 3), (50, 3)]
    got = {r.id: r.group for r in near_duplicates.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in [*range(41), 50]) and got[100] == got[101] == 100
    assert near_duplicates.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 4000), st.sampled_from([16, 64, 512]))
def test_an_opening_mark_any_distance_away(far, chunk):
    text = "Er fragte: „" + "wort " * far + "ja…“? Danach ging er. Ende kam."
    assert sentences.ends([text], chunk)[0] == [text.index("?") + 1, text.index("er. E") + 3, len(text)]
    text = "„Ende.“ " + "Wort. " * far + "He said “No. Never.” twice. Then."
    assert len(sentences.ends([text], chunk)[0]) == 3 + far


def test_long_texts_are_composed_of_chunks():
    text = "Am Abend des 3. Mai kam Dr. Braun (sie lief. Schnell!) an. „Gut. Ja.“ sagte sie. 東京です。はい。 " * 20_000  # megabytes
    assert sentences.ends([text])[0] == sentences.ends([text], len(text))[0]
    assert sentences._word_before("x " + "y" * 5000 + "  12", 5004) == "y" * 5000


# ---------------------------------------------------------------- linkage


def test_titles():
    assert linkage.bare_title("A good title of things - Journal of X, 4 (2), 10-20 AB Smith, C Jones") == ("A good title of things", False)
    assert linkage.bare_title("A good title of thingsAB Smith, C Jones, ...")[0] == "A good title of things"
    assert linkage.bare_title("A good title of th…") == ("A good title of th", True) and linkage.bare_title(None) == ("", False)
    right = "Effects of zorbin on muscle tone at night: evidence from clinics"
    good = [right.upper(), "Effects of zorbin on muscle tone at night", "Effects of zobrin on muscle tone at night: evidence from clinics", "Effects of zorbin on muscle tone at ni…", "Effects of zorbin on tone at night: evidence from clinics", right + " AB Smith, C Jones", "Evidence from clinics: Effects of zorbin on muscle tone at night"]
    bad = ["Reply to '" + right + "'", right + " - corrigendum", "Effects of glumab on muscle tone at night: evidence from clinics", "Another thing entirely about nothing", "", None, right + ": ten years later"]
    assert min(linkage.likeness(good, [right] * len(good))) >= linkage.ALIKE
    assert max(linkage.likeness(bad, [right] * len(bad))) < linkage.ALIKE
    assert linkage.same_venue(linkage.venue_key("J. Appl. Bone & Joint Care"), linkage.venue_key("Journal of Applied Bone and Joint Care, Vol. 3")) > 0.8


def test_edit_distances():
    def slow(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return min(row)

    rng = random.Random(3)
    a = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(50)]
    b = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 12))) for _ in range(50)]
    whole, _, broken = linkage.best_prefix(a, b)
    assert whole.tolist() == [slow(x, y) for x, y in zip(a, b, strict=True)] and broken.tolist() == [slow(y, x) for x, y in zip(a, b, strict=True)]


def test_link(spark):
    works = [(f"W{i}", f"Effects of {n} on muscle tone at night: evidence from clinics", y) for i, (n, y) in enumerate([("zorbinol", 2020), ("zorbinol", 2010), ("glumabix", 2019), ("trestane", 2018), ("plonkase", None)])] + [("W9", None, 2020), ("W10", "Reply to comments on: Effects of trestane on muscle tone at night", 2018)]
    venues = [("W0", "Journal of Things"), ("W1", "Letters"), ("W2", "J. Things"), ("W2", None)]
    articles = [(1, "effects of zorbinol on muscle tone at night", "Journal of Things", 2021), (2, "Effects of zorbniol on muscle tone at night: evidence from clinics", "Letters", None), (3, "Reply to 'Effects of glumabix on muscle tone at night'", "J", 2019), (4, None, None, None), (5, "", "J", 1), (6, "Effects of trestane on muscle tone at night: evidence from clinics", "J", 2012), (7, "effects of zorbinol on muscle tone at night", "Journal of Things", 2021), (8, "Effects of plonkase on muscle tone at night: evidence from clinics", None, 2001)]
    got = linkage.link(
        spark.createDataFrame(articles, "article_id bigint, title string, journal string, year int"), spark.createDataFrame(works, "work_id string, title string, year int"), spark.createDataFrame(venues, "work_id string, venue string")
    ).collect()
    assert {r.article_id: r.work_id for r in got} == {1: "W0", 2: "W1", 7: "W0", 8: "W4"} and all(0.8 <= r.confidence <= 1 for r in got)


def test_no_table_is_broadcast(spark):
    # The tables grow with the input and their rows take many times their files' size, so the driver must not build them.
    def runs():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        found = spark._jsparkSession.sharedState().statusStore().executionsList()
        return {(x := found.apply(i)).executionId(): x.physicalPlanDescription() for i in range(found.size())}

    before = runs()
    test_link(spark)
    plans = [plan for k, plan in runs().items() if k not in before]
    assert sum("SortMergeJoin" in p for p in plans) >= 5 and not any("BroadcastExchange" in p for p in plans)


def graph(spark, left, rights):
    rows = spark.createDataFrame(list(enumerate(rights)), "right bigint, title string")
    return {r.right for r in linkage.edges(spark.createDataFrame([(0, left)], "left bigint, title string"), rows).collect()}


def test_edges_with_words_that_no_work_has(spark):
    rights = [f"Effects of {a}o{b}binol on muscle tone at night" for a in "bcdfghjk" for b in "klmnprtv"]
    assert 0 in graph(spark, "Effects of xbokibnlo on muscle tone at night", rights)


def test_light_edges_stay(spark):
    # The second work shares every word, the first one only two of four, the others misspelt.
    rights = ["Aglumabix trseatne plnkosae zorbinol in adults", "Zorbinol plonkase trestane aglumabix", *(f"Case {i} in adults" for i in range(100))]
    rights += [rights[0].replace("adults", "mice").replace("zorbinol ", "").replace("aglumabix ", ""), "Trestane", "Plonkase"]
    assert graph(spark, "Aglumabix trestane plonkase zorbinol in adults", rights) >= {0, 1}


# ---------------------------------------------------------------- sentences


def cut(text, **more):
    out, start = [], 0
    for end in sentences.ends([text], **more)[0]:
        out.append(text[start:end].strip())
        start = end
    return out


@pytest.mark.parametrize(
    "parts",
    [
        ["Dr. J. K. Smith et al. (2008) came at 9 a.m. on day 5.", "It rose 3.5 percent, e.g. in Sec. 1.2, cf. Table 6."], ["“We ask,” she said, “not now.”", "Is it so?", "Yes!"], ['One wrote, "It is not enough. We need more," and all agreed.', "The end."],
        ["The effect held.[8]", "mRNA was absent (see p. 4) there."], ["The signal rose ... and fell.", "6 were lost."], ["Title of a text", "1. Background", "- first item", "- second item", "Cut off he"], ["Im 2. Abschnitt folgt d. h. alles.", "„Ist es so?“, fragte er."],
        ["« Est-ce vrai ? » demandait-il.", "Oui !"], ["«¿Ha bajado?», preguntó ella.", "¡No!", "¿Por qué?"], ["费用上升了13.0%。", "“真的吗？”一位读者问道。", "“太早了。”", "结束"], ["ある者は「足りない。必要だ。」と述べた。", "「早すぎた。」", "なぜか？"], ["한 심사자는 \"부족하다. 필요하다.\"라고 썼다.", "끝났다."],
        ["ดร. เอทบทวนทั้งหมด 19 รายแล้ว", "ผลนี้ชี้ว่าดี"], ["यह अच्छा है।", "डॉ. ओ ने देखा!"], ["راجع د. كورديز الحالة.", "لماذا؟", "نعم."], ["Sites in the U.K. and U.S. arms.", "Use v2.1 of data.x.example/sets now."], ["(Two were counted.)", "It was St. Paul."],
    ],
)
def test_sentences(parts):
    blocks = [i for i, p in enumerate(parts) if p[0] == "-" or p.startswith("1. ") or p.startswith("Title")]
    text = "".join(p + ("\n\n" if i in blocks or i + 1 in blocks else "" if "\u3000" <= max(p) < "\uac00" else " ") for i, p in enumerate(parts)).rstrip()
    text = text.replace("item\n\n- ", "item\n- ")
    assert cut(text) == parts


def test_sentence_edges(spark):
    assert sentences.ends([None, "", " \n ", "12 (3)", "...", "no end", "A.  \r\n\r\nB"]) == [[], [], [], [], [], [6], [2, 9]]
    rows = spark.createDataFrame([(1, "One. Two.", "a"), (1, "One. Two.", "a"), (2, None, "b")], "doc_id int, text string, end_pos_note string")
    assert [(r.doc_id, r.end_pos) for r in sentences.sentence_ends(rows, "text", ["doc_id"]).collect()] == [(1, 4), (1, 9)] * 2


@settings(max_examples=60, deadline=None)
@given(st.text("aB1 .!?\"'“”()[]\n。？「」…,-", max_size=200), st.integers(1, 20))
def test_chunks_make_no_difference(text, chunk):
    assert sentences.ends([text, "x"], chunk=chunk) == sentences.ends([text, "x"])


# ---------------------------------------------------------------- queries


@needs_data
def test_queries(spark):
    from oracle import compare, views

    con = views(SMALL)
    for name, query in queries.QUERIES.items():
        got = query(spark, SMALL).toPandas()
        if name in queries.SQL:
            assert compare(got, con.execute(queries.SQL[name]).df()) == "", name
        elif name.endswith("_found"):
            assert len(got) and not got.duplicated().any(), name


