"""Queries of the sampling engine's own operators over the whole works table, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import names, text
from ..functions.ids import last_segment, segment_after_slash, topic_key, work_key
from ..operators import papers, references, resolution, sampling, topics
from ..runtime import settle
from ..sources.tables import table
from .general import _tkey, _wkey

#: Papers per topic, and the seed of queries over all topics.
PER_TOPIC, SEED = 2000, 20240101
_DAY = lambda c="updated_date": F.col(c).cast("string")


def works(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "works")


# ---------------------------------------------------------------- filters, counts and samples of configurations


def _matched(spark: SparkSession, d: str) -> DataFrame:
    return sampling.matching_all(works(spark, d), table(spark, d, "fetch_configs"))


def total_matching(spark: SparkSession, d: str) -> DataFrame:
    """Matching works of every configuration: an aggregate of its own, not a window over all rows."""
    return _matched(spark, d).groupBy("config_id").agg(F.count(F.lit(1)).alias("total_matching"))


def _ranked(spark: SparkSession, d: str) -> DataFrame:
    most = table(spark, d, "fetch_configs").agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    seed = F.coalesce(F.col("c_sample_seed"), F.lit(SEED))
    return sampling.candidates_per_key(_matched(spark, d), "config_id", F.col("c_count"), seed, most=most, order=("id", "updated_date"))


def config_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Candidates of every configuration in hash order."""
    return _ranked(spark, d).select("config_id", "id", "sample_rank")


def _seen(spark: SparkSession, d: str) -> DataFrame:
    """Candidates up to the one that fills each configuration, judged as it asks."""
    keep = ("config_id", "c_count", "c_required_fields", "c_fields", "c_language", "c_require_english_text", "c_require_clean_text", "id", "sample_rank")
    english = F.coalesce("c_require_english_text", F.col("c_language") == "en") & (F.col("c_language") == "en")
    clean = F.coalesce("c_require_clean_text", F.lit(True))
    parsed = papers.parse_papers(_ranked(spark, d), list(papers.COLUMNS), F.col("c_required_fields"), english=english, clean=clean, keep=keep, wanted=F.col("c_fields"))
    return sampling.accept(parsed, F.col("c_count"), by=("config_id",), order=("sample_rank",))


def config_papers(spark: SparkSession, d: str) -> DataFrame:
    """Accepted papers of every configuration, with the fields and by the checks it asks for."""
    return _seen(spark, d).where("ok = 1").select("config_id", "id", "title", "abstract", "publication_date", "publication_venue")


def config_stats(spark: SparkSession, d: str) -> DataFrame:
    """Seen, written and skipped candidates of every configuration, up to the one that fills it."""
    return sampling.sample_stats(_seen(spark, d), ("config_id",))


def _per_topic(spark: SparkSession, d: str) -> DataFrame:
    """The first candidates of every topic, one delivery of each work: the last, of equal ones that of the greater text."""
    rows = works(spark, d).withColumn("topic_id", topic_key(F.col("primary_topic.id"))).where(F.col("id").isNotNull() & F.col("topic_id").isNotNull())
    fields = ("display_name", "abstract_inverted_index", "publication_date", "primary_location", "locations")
    one = rows.groupBy("id", "topic_id").agg(F.max_by(F.struct(*fields), F.struct("updated_date", "abstract_inverted_index", F.to_json(F.struct("primary_location", "locations")))).alias("w")).select("id", "topic_id", "w.*")
    return sampling.candidates_per_key(one, "topic_id", PER_TOPIC, SEED)


def topic_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The first candidates of every topic in one job."""
    rows = works(spark, d).where(F.col("id").isNotNull()).select("id", topic_key(F.col("primary_topic.id")).alias("topic_id")).where(F.col("topic_id").isNotNull()).distinct()
    return sampling.candidates_per_key(rows, "topic_id", PER_TOPIC, SEED).select("topic_id", "id", "sample_rank")


def topic_stats(spark: SparkSession, d: str) -> DataFrame:
    """Seen, written and skipped candidates of every topic, up to the one that fills it."""
    parsed = papers.parse_papers(_per_topic(spark, d), list(papers.COLUMNS), ["title", "abstract"], english=True, clean=True, keep=("id", "topic_id", "sample_key"))
    return sampling.sample_stats(sampling.accept(parsed, PER_TOPIC, by=("topic_id",)), ("topic_id",))


# ---------------------------------------------------------------- text


def titles(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned titles, and whether they are English."""
    rows = works(spark, d).where(F.col("display_name").isNotNull()).select("id", _DAY().alias("delivered"), F.col("display_name").alias("title"))
    rows = text.clean_columns(rows, ["title"])
    return rows.select("id", "delivered", "title", text.looks_english(F.col("title")).alias("english"), text.contains_cjk(F.col("title")).alias("cjk"))


def abstracts(spark: SparkSession, d: str) -> DataFrame:
    """Abstracts from their inverted indexes; malformed where the text is no JSON object."""
    given = works(spark, d).where(F.col("abstract_inverted_index").isNotNull()).select("id", _DAY().alias("delivered"), F.col("abstract_inverted_index").alias("abstract"))
    return text.clean_columns(given, [], [], ["abstract"]).select("id", "delivered", F.md5("abstract").alias("digest"), F.col("abstract_malformed").alias("malformed"))


def clean_abstracts(spark: SparkSession, d: str) -> DataFrame:
    """Whether the abstracts of papers are English and, once cleaned, free of LaTeX and further mark-up."""
    rows = table(spark, d, "papers").where(F.col("abstract").isNotNull()).select("paper_id", "abstract")
    rows = text.clean_columns(rows, ["abstract"], ["abstract"])
    return rows.select("paper_id", text.looks_clean(F.col("abstract"), F.col("abstract_decoded")).alias("clean"), text.looks_english(F.col("abstract")).alias("english"), F.md5("abstract").alias("digest"))


def venues(spark: SparkSession, d: str) -> DataFrame:
    """The venue of every work."""
    return text.clean_columns(works(spark, d).select("id", _DAY().alias("delivered"), papers.first_venue().alias("venue")), ["venue"])


def skip_reasons(spark: SparkSession, d: str) -> DataFrame:
    """How often each reason to skip a work holds, over all works and all fields."""
    return papers.skip_histogram(papers.parse_papers(works(spark, d), list(papers.COLUMNS), ["title", "abstract"], english=True, clean=True))


def ids(spark: SparkSession, d: str) -> DataFrame:
    """Short forms of work and topic ids, and the year and dates that follow from a work's."""
    return works(spark, d).select(
        "id", _DAY().alias("delivered"), last_segment(F.col("id")).alias("short_id"), segment_after_slash(F.col("primary_topic.id")).alias("topic_id"),
        F.col("publication_date").cast("string").alias("published"), references.window_start(F.col("publication_date")).cast("string").alias("since"),
    )


def topic_paths(spark: SparkSession, d: str) -> DataFrame:
    """File names of the catalog's topics; where two share a name, all but the first carry their id."""
    return topics.output_paths(table(spark, d, "topics")).select("id", names.slug_column(F.col("display_name")).alias("slug"), "path")


# ---------------------------------------------------------------- joins


def config_topics(spark: SparkSession, d: str) -> DataFrame:
    """The only topic of every configuration's path."""
    return topics.configs_with_topics(table(spark, d, "fetch_configs"), table(spark, d, "topics")).select("config_id", "topic_id")


def catalog(spark: SparkSession, d: str) -> DataFrame:
    """Topics that works name, each once with its name and upper levels."""
    rows = topics.distinct_topics(works(spark, d), topic_key(F.col("primary_topic.id")))
    return rows.select("topic_id", "display_name", "id", *(F.col(f"{level}.{part}").alias(f"{level}_{part}") for level in topics.LEVELS[:3] for part in ("id", "display_name")))


def reference_stats(spark: SparkSession, d: str) -> DataFrame:
    """Requested, found, accepted, skipped and missing references of every work, over all its deliveries.

    A work is accepted if one of its deliveries is: title and abstract there, English and clean.
    """
    keyed = works(spark, d).withColumn("key", work_key(F.col("id")))
    parsed = papers.parse_papers(keyed.where(F.col("key").isNotNull()), list(papers.COLUMNS), ["title", "abstract"], english=True, clean=True, keep=("key",))
    known = parsed.groupBy(F.col("key").alias("id")).agg(F.min_by("skip_reasons", F.size("skip_reasons")).alias("skip_reasons"))
    return references.lookup_stats(references.lookup(keyed, F.transform("referenced_works", work_key), F.col("key"), known)).withColumnRenamed("n_found", "found")


def _topic_dates(spark: SparkSession, d: str) -> DataFrame:
    rows = works(spark, d).select(work_key(F.col("id")).alias("id"), topic_key(F.col("primary_topic.id")).alias("topic_id"), F.col("publication_date").alias("published"))
    return rows.where(F.col("id").isNotNull() & F.col("topic_id").isNotNull() & F.col("published").isNotNull()).distinct()


def earlier_works(spark: SparkSession, d: str) -> DataFrame:
    """For every work whose number is divisible by 20: the earlier works of its topic among all, counted and dated."""
    rows = _topic_dates(spark, d)
    parents = rows.where(F.pmod(F.substring("id", 2, 18).cast("bigint"), F.lit(20)) == 0).select(F.col("id").alias("parent"), "topic_id", "published")
    found = references.earlier_counts(parents, rows)
    return found.select("parent", "topic_id", "n", F.col("first").cast("string").alias("first"), F.col("last").cast("string").alias("last"))


def journals(spark: SparkSession, d: str) -> DataFrame:
    """Scholar articles by journal: how many, which came first, and its h5 values."""
    rows = table(spark, d, "scholar_articles").where(F.col("journal").isNotNull())
    return rows.groupBy("journal").agg(F.count(F.lit(1)).alias("n"), F.min("article_id").alias("first"), F.min_by("h5_index", "article_id").alias("h5_index"), F.min_by("h5_median", "article_id").alias("h5_median"))


def scholar_titles(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "scholar_articles")
    return raw.select("article_id", "journal", "year", F.coalesce(names.scraped_title_udf("title"), F.lit("")).alias("title"))


def one_title(spark: SparkSession, d: str) -> DataFrame:
    """One row per work of a title: id, title, venue, published, cited."""
    one = works(spark, d).withColumn("k", work_key(F.col("id"))).where(F.col("k").isNotNull() & F.col("display_name").isNotNull()).groupBy("k")
    return one.agg(F.max("display_name").alias("title"), F.min(papers.first_venue()).alias("venue"), F.min("publication_date").cast("string").alias("published"), F.max("cited_by_count").alias("cited")).withColumnRenamed("k", "id")


def _scored(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Articles, and their candidates with scores; normal forms are made once."""
    articles, one = settle(resolution.left_forms(scholar_titles(spark, d)), "articles"), settle(resolution.right_forms(one_title(spark, d)), "titles")
    return articles, resolution.scored(articles, one, resolution.candidates(articles, one))


def resolved_articles(spark: SparkSession, d: str) -> DataFrame:
    """The work of every Scholar article by the weighted score of title, venue and year."""
    return resolution.verdicts(*_scored(spark, d))


def resolution_counts(spark: SparkSession, d: str) -> DataFrame:
    """Resolved and unresolved articles by reason."""
    return resolved_articles(spark, d).groupBy("status", "reason").agg(F.count(F.lit(1)).alias("n"))


def article_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The best candidates of every Scholar article, from the greatest confidence on."""
    return resolution.candidate_lists(_scored(spark, d)[1])


# ---------------------------------------------------------------- SQL


def _unescaped(c: str) -> str:
    return f"replace(replace(replace(replace(replace({c}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')"


def _cleaned(c: str) -> str:
    bare = f"regexp_replace({c}, '(?i)</?[a-z][^>]*>', ' ', 'g')"
    return f"trim(regexp_replace({bare}, '[\\s\\x0b\\x1c-\\x1f\\x85\\pZ]+', ' ', 'g'))"


_S = "[^\\s\\x0b\\x1c-\\x1f\\x85\\pZ]"
_CJK = "[\\x{3040}-\\x{30ff}\\x{3400}-\\x{4dbf}\\x{4e00}-\\x{9fff}\\x{ac00}-\\x{d7af}]"


def _english(c: str) -> str:
    letters, latin = f"length(regexp_replace({c}, '[^\\pL]', '', 'g'))", f"length(regexp_replace({c}, '[^A-Za-z\\x{{c0}}-\\x{{d6}}\\x{{d8}}-\\x{{f6}}\\x{{f8}}-\\x{{24f}}\\x{{1e00}}-\\x{{1eff}}]', '', 'g'))"
    return f"(NOT regexp_matches({c}, '{_CJK}') AND {letters} > 0 AND {latin} / greatest({letters}, 1) >= 0.85)"


def _clean(c: str) -> str:
    low = f"lower({_unescaped(c)})"
    marks = " AND ".join(f"NOT contains({low}, '{m}')" for m in text.LATEX_MARKS)
    return f"({marks} AND len(regexp_extract_all({low}, '<br>')) <= 5 AND len(regexp_extract_all({low}, '<[a-z][^>]*>')) <= 5 AND len(regexp_extract_all({c}, '\\\\[a-zA-Z]+')) <= 12)"


_MATCHED = """
matched AS (SELECT c.config_id, c.count AS want, coalesce(c.sample_seed, 20240101) AS seed, c.fields AS c_fields, c.required_fields AS c_required, c.language = 'en' AND coalesce(c.require_english_text, true) AS c_english, coalesce(c.require_clean_text, true) AS c_clean, w.* FROM works w JOIN fetch_configs c
  ON w.type = c.work_type AND w.language = c.language
  AND lower(w.primary_topic.domain.display_name) = lower(c.domain) AND lower(w.primary_topic.field.display_name) = lower(c.field)
  AND lower(w.primary_topic.subfield.display_name) = lower(c.subfield) AND lower(w.primary_topic.display_name) = lower(c.topic)
  WHERE w.publication_date >= CAST(c.from_publication_date AS DATE) AND (c.to_publication_date IS NULL OR w.publication_date <= CAST(c.to_publication_date AS DATE))
    AND w.abstract_inverted_index IS NOT NULL AND w.id IS NOT NULL),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY config_id ORDER BY md5(id || ':' || CAST(seed AS VARCHAR)), id, updated_date) AS INTEGER) AS sample_rank FROM matched),
cand AS (SELECT * FROM ranked WHERE sample_rank <= 5 * want)"""


def _abstract_ctes(source: str) -> str:
    """abs: (k, text) of the rows of ``source``, which has a number k, and whether the JSON is malformed."""
    return f"""
obj AS (SELECT k, TRY_CAST(CAST(j AS JSON) AS MAP(VARCHAR, BIGINT[])) AS m FROM (SELECT k, abstract_inverted_index AS j FROM {source} WHERE json_valid(abstract_inverted_index)) WHERE json_type(CAST(j AS JSON)) = 'OBJECT'),
ent AS (SELECT k, generate_subscripts(map_entries(m), 1) AS o, unnest(map_entries(m)) AS e FROM obj),
pos AS (SELECT k, o, e.key AS w, unnest(e.value) AS p FROM ent),
one AS (SELECT k, p, max_by(w, o) AS w FROM pos GROUP BY 1, 2),
abs AS (SELECT k, string_agg(w, ' ' ORDER BY p) AS text FROM one GROUP BY 1 HAVING min(p) = 0 AND max(p) = count(*) - 1)"""


_VENUE = f"""coalesce(
  CASE WHEN regexp_matches(primary_location.source.display_name, '{_S}') THEN primary_location.source.display_name WHEN regexp_matches(primary_location.raw_source_name, '{_S}') THEN primary_location.raw_source_name END,
  list_filter(list_transform(locations, lambda l: CASE WHEN regexp_matches(l.source.display_name, '{_S}') THEN l.source.display_name WHEN regexp_matches(l.raw_source_name, '{_S}') THEN l.raw_source_name END), lambda v: v IS NOT NULL)[1])"""


_EACH = "['title', 'abstract', 'publication_date', 'publication_venue'] AS c_fields, ['title', 'abstract'] AS c_required, true AS c_english, true AS c_clean"


def _parsed_sql(source: str) -> str:
    """parsed: all of ``source``, which has c_fields, c_required, c_english and c_clean, with cleaned fields and reasons."""
    asked = lambda f, x: f"CASE WHEN list_contains(c_fields, '{f}') THEN {x} END"
    missing = ", ".join(f"CASE WHEN list_contains(c_fields, '{f}') AND list_contains(c_required, '{f}') AND coalesce({c}, '') = '' THEN 'missing_{f}' END" for f, c in (("title", "title"), ("abstract", "abstract"), ("publication_date", "published"), ("publication_venue", "venue")))
    return f"""
numbered AS (SELECT *, row_number() OVER () AS k FROM {source}),{_abstract_ctes("numbered")},
fields AS (SELECT n.*, {asked('title', f"CASE WHEN regexp_matches(display_name, '{_S}') THEN {_cleaned(_unescaped('display_name'))} END")} AS title, {asked('abstract', _cleaned(_unescaped('a.text')))} AS abstract,
  {asked('publication_date', "CAST(publication_date AS VARCHAR)")} AS published, {asked('publication_venue', _cleaned(_unescaped(_VENUE)))} AS venue,
  (list_contains(c_fields, 'abstract') AND abstract_inverted_index IS NOT NULL AND NOT (json_valid(abstract_inverted_index) AND coalesce(json_type(TRY_CAST(abstract_inverted_index AS JSON)) = 'OBJECT', false))) AS malformed
  FROM numbered n LEFT JOIN abs a USING (k)),
parsed AS (SELECT *, CASE WHEN malformed THEN ['malformed_abstract_json'] ELSE list_filter([{missing},
  CASE WHEN c_english AND title <> '' AND NOT {_english('title')} THEN 'non_english_title' END, CASE WHEN c_english AND abstract <> '' AND NOT {_english('abstract')} THEN 'non_english_abstract' END,
  CASE WHEN c_clean AND abstract <> '' AND NOT {_clean('abstract')} THEN 'unclean_abstract' END], lambda x: x IS NOT NULL) END AS reasons FROM fields)"""


_RUN = """run AS (SELECT *, CASE WHEN len(reasons) = 0 THEN 1 ELSE 0 END AS ok FROM parsed),
seen AS (SELECT * FROM (SELECT *, sum(ok) OVER (PARTITION BY config_id ORDER BY sample_rank ROWS UNBOUNDED PRECEDING) AS n FROM run) WHERE n - ok < want)"""

SQL = {
    "total_matching": f"WITH {_MATCHED} SELECT config_id, count(*) AS total_matching FROM matched GROUP BY 1",
    "config_candidates": f"WITH {_MATCHED} SELECT config_id, id, sample_rank FROM cand",
    "config_papers": f"WITH {_MATCHED}, {_parsed_sql('cand')}, {_RUN} SELECT config_id, id, title, abstract, published AS publication_date, venue AS publication_venue FROM seen WHERE ok = 1",
    "config_stats": f"WITH {_MATCHED}, {_parsed_sql('cand')}, {_RUN} SELECT config_id, count(*) AS sampled_seen, CAST(sum(ok) AS BIGINT) AS written, CAST(sum(1 - ok) AS BIGINT) AS skipped FROM seen GROUP BY 1",
    "topic_candidates": f"""WITH r AS (SELECT DISTINCT id, {_tkey('primary_topic.id')} AS topic_id FROM works WHERE id IS NOT NULL)
SELECT topic_id, id, sample_rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY topic_id ORDER BY md5(id || ':{SEED}'), id) AS INTEGER) AS sample_rank FROM r WHERE topic_id IS NOT NULL) WHERE sample_rank <= {5 * PER_TOPIC}""",
    "titles": f"""SELECT id, delivered, title, {_english('title')} AS english, regexp_matches(title, '{_CJK}') AS cjk FROM (SELECT id, CAST(updated_date AS VARCHAR) AS delivered, {_cleaned(_unescaped('display_name'))} AS title FROM works WHERE display_name IS NOT NULL)""",
    "abstracts": f"""WITH numbered AS (SELECT *, row_number() OVER () AS k FROM works), {_abstract_ctes('numbered')}
SELECT id, CAST(updated_date AS VARCHAR) AS delivered, md5(text) AS digest, NOT (json_valid(abstract_inverted_index) AND coalesce(json_type(TRY_CAST(abstract_inverted_index AS JSON)) = 'OBJECT', false)) AS malformed FROM numbered LEFT JOIN abs USING (k) WHERE abstract_inverted_index IS NOT NULL""",
    "clean_abstracts": f"SELECT paper_id, {_clean('a')} AS clean, {_english('a')} AS english, md5(a) AS digest FROM (SELECT paper_id, {_cleaned(_unescaped('abstract'))} AS a FROM papers WHERE abstract IS NOT NULL)",
    "venues": f"SELECT id, CAST(updated_date AS VARCHAR) AS delivered, {_cleaned(_unescaped(_VENUE))} AS venue FROM works",
    "topic_stats": f"""WITH t AS (SELECT *, {_tkey('primary_topic.id')} AS topic_id, 2000 AS want, row_number() OVER (PARTITION BY id, {_tkey('primary_topic.id')} ORDER BY updated_date DESC, abstract_inverted_index DESC NULLS LAST) AS delivery FROM works WHERE id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY md5(id || ':{SEED}'), id) AS sample_rank, topic_id AS config_id, {_EACH} FROM t WHERE topic_id IS NOT NULL AND delivery = 1),
cand AS (SELECT * FROM o WHERE sample_rank <= 5 * {PER_TOPIC}), {_parsed_sql('cand')}, {_RUN}
SELECT topic_id, count(*) AS sampled_seen, CAST(sum(ok) AS BIGINT) AS written, CAST(sum(1 - ok) AS BIGINT) AS skipped FROM seen GROUP BY 1""",
    "skip_reasons": f"WITH every AS (SELECT *, {_EACH} FROM works), {_parsed_sql('every')} SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM parsed) GROUP BY 1",
    "ids": """SELECT id, CAST(updated_date AS VARCHAR) AS delivered, regexp_extract(regexp_replace(trim(id), '/+$', ''), '([^/]+)$', 1) AS short_id, regexp_extract(primary_topic.id, '([^/]+)$', 1) AS topic_id,
CAST(publication_date AS VARCHAR) AS published, CAST(make_date(CAST(year(publication_date) - 5 AS BIGINT), 1, 1) AS VARCHAR) AS since FROM works""",
    "topic_paths": f"""WITH b AS (SELECT id, subfield.display_name AS sub, regexp_replace(trim(regexp_replace(regexp_replace(display_name, '[/\\\\]+', '_', 'g'), '\\s+', ' ', 'g')), '\\.+$', '') AS name,
  trim(regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(lower(display_name), '[^a-z0-9]+', ' ', 'g'), '\\b(the|an|a)\\b', ' ', 'g'), ' +', ' ', 'g')), ' ', '-', 'g'), '-') AS slug FROM topics),
n AS (SELECT *, row_number() OVER (PARTITION BY sub, name ORDER BY id) AS n FROM b)
SELECT id, trim(substr(slug, 1, 80), '-') AS slug, sub || '/' || CASE WHEN n > 1 THEN name || ' (' || {_tkey('id')} || ')' ELSE name END AS path FROM n""",
    "config_topics": """WITH p AS (SELECT lower(domain.display_name) AS d, lower(field.display_name) AS f, lower(subfield.display_name) AS s, lower(display_name) AS t, min(id) AS topic_id FROM topics GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT id) = 1)
SELECT config_id, topic_id FROM fetch_configs c JOIN p ON lower(c.domain) = d AND lower(c.field) = f AND lower(c.subfield) = s AND lower(c.topic) = t""",
    "catalog": f"""WITH t AS (SELECT {_tkey('primary_topic.id')} AS topic_id, primary_topic AS p FROM works)
SELECT topic_id, p.display_name AS display_name, p.id AS id, p.domain.id AS domain_id, p.domain.display_name AS domain_display_name, p.field.id AS field_id, p.field.display_name AS field_display_name, p.subfield.id AS subfield_id, p.subfield.display_name AS subfield_display_name
FROM (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY p.display_name NULLS FIRST, p.id NULLS FIRST, {', '.join(f"p.{x} IS NOT NULL, p.{x}.id NULLS FIRST, p.{x}.display_name NULLS FIRST" for x in ('subfield', 'field', 'domain'))}) AS n FROM t WHERE topic_id IS NOT NULL) WHERE n = 1""",
    "reference_stats": f"""WITH e AS (SELECT {_wkey('id')} AS parent, unnest(referenced_works) AS r FROM works), q AS (SELECT DISTINCT parent, {_wkey('r')} AS ref FROM e),
every AS (SELECT *, {_EACH} FROM works), {_parsed_sql('every')},
g AS (SELECT {_wkey('id')} AS ref, min(len(reasons)) AS least FROM parsed GROUP BY 1)
SELECT parent, count(*) AS requested, count(least) AS found, count(*) FILTER (least = 0) AS accepted, count(*) FILTER (least > 0) AS skipped, count(*) - count(least) AS missing FROM q LEFT JOIN g USING (ref) WHERE parent IS NOT NULL AND q.ref IS NOT NULL GROUP BY 1""",
    "earlier_works": f"""WITH r AS (SELECT DISTINCT {_wkey('id')} AS id, {_tkey('primary_topic.id')} AS topic_id, publication_date AS p FROM works WHERE publication_date IS NOT NULL)
SELECT a.id AS parent, a.topic_id, count(*) AS n, CAST(min(b.p) AS VARCHAR) AS first, CAST(max(b.p) AS VARCHAR) AS last FROM r a JOIN r b ON a.topic_id = b.topic_id AND b.p <= a.p AND b.p >= make_date(CAST(year(a.p) - 5 AS BIGINT), 1, 1) AND a.id <> b.id
WHERE CAST(substr(a.id, 2) AS BIGINT) % 20 = 0 GROUP BY 1, 2""",
    "journals": "SELECT journal, count(*) AS n, min(article_id) AS first, arg_min_null(h5_index, article_id) AS h5_index, arg_min_null(h5_median, article_id) AS h5_median FROM scholar_articles WHERE journal IS NOT NULL GROUP BY 1",
}

QUERIES = {f.__name__: f for f in (total_matching, config_candidates, config_papers, config_stats, topic_candidates, topic_stats, titles, abstracts, clean_abstracts, venues, skip_reasons, ids, topic_paths, config_topics, catalog, reference_stats, earlier_works, journals, resolved_articles, resolution_counts, article_candidates)}
