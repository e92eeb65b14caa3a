"""Scraped journals and articles: HTML tables, JSON and CSV fixtures, with the fixture only where scraping fails.

Result rows: journal, h5_index, h5_median, ord, title, year. Defined results: at most MOST_JOURNALS journals and
MOST_ARTICLES articles of each, in the order given; scraping that finds fewer is an error, as is an article without a title
or journal in a fixture; a number that is none is null.
"""

from __future__ import annotations

from collections.abc import Callable
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import HEADER, VENUES, first_year, scraped_title_udf

MOST_JOURNALS, MOST_ARTICLES = 5, 20
ARTICLES = "journal string, h5_index int, h5_median int, ord int, title string, year int"
#: What else stands at the head of a table of articles.
HEADERS = (HEADER, "title", "article")


class ScholarError(ValueError):
    """A page or fixture that can't be used."""


class _Rows(HTMLParser):
    """Rows of table cells: text and first link."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list[dict]] = []
        self.cell: dict | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th"):
            self.cell = {"text": "", "href": None}
            (self.rows or self.rows.append([]) or self.rows)[-1].append(self.cell)
        elif tag == "a" and self.cell is not None:
            self.cell["href"] = dict(attrs).get("href") or self.cell["href"]

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th", "tr"):
            self.cell = None

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell["text"] += data


def rows_of(page: str | None) -> list[list[dict]]:
    parser = _Rows()
    parser.feed(page or "")
    return [[c | {"text": " ".join(c["text"].split())} for c in row] for row in parser.rows if row]


@F.pandas_udf(T.ArrayType(T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("href", T.StringType())]))))
def table_rows(pages: pd.Series) -> pd.Series:
    """The table rows of each page."""
    return pages.map(rows_of)


def top_journals(pages: DataFrame, html: str, names: tuple[str, ...] = VENUES) -> DataFrame:
    """(journal, h5_index, h5_median, href) of the rows that name one of the journals; the first two numbers count."""
    rows = pages.select(F.posexplode(table_rows(F.col(html))).alias("at", "row"))
    text = F.array_join(F.transform("row", lambda c: c["text"]), " ")
    named = F.get(F.filter(F.array(*(F.lit(n) for n in names)), lambda n: F.contains(text, n)), F.lit(0))
    numbers = F.regexp_extract_all(text, F.lit(r"\b([0-9]{2,4})\b"), F.lit(1))
    links = F.filter(F.transform("row", lambda c: c["href"]), lambda h: h.isNotNull())
    found = rows.select("at", named.alias("journal"), F.get(numbers, F.lit(0)).cast("int").alias("h5_index"), F.get(numbers, F.lit(1)).cast("int").alias("h5_median"), F.get(links, F.lit(0)).alias("href"))
    return found.where(F.col("journal").isNotNull()).orderBy("at").limit(MOST_JOURNALS).drop("at")


def core_articles(pages: DataFrame, html: str, limit: int = MOST_ARTICLES) -> DataFrame:
    """(ord, title, year): the first cell with text, cleaned, and the first year in the others, if there is one."""
    rows = pages.select(F.posexplode(table_rows(F.col(html))).alias("ord", "row"))
    cells = F.filter(F.transform("row", lambda c: c["text"]), lambda t: t != "")
    rows = rows.select("ord", F.get(cells, F.lit(0)).alias("raw"), first_year(F.array_join(F.slice(cells, F.lit(2), F.greatest(F.size(cells), F.lit(1))), " ")).alias("year"))
    found = rows.select("ord", scraped_title_udf("raw").alias("title"), "year").where(F.col("title") != "")
    return found.where(~F.lower("title").isin(*HEADERS)).orderBy("ord").limit(limit)


def scrape(spark: SparkSession, url: str, fetch_page: Callable[[str], str], names: tuple[str, ...] = VENUES, journals: int = MOST_JOURNALS, articles: int = MOST_ARTICLES) -> DataFrame:
    """The articles of the top journals, from the page at ``url`` and the pages it links to: no more than ``journals``."""
    page = lambda at: spark.createDataFrame([(fetch_page(at),)], "html string")
    top = top_journals(page(url), "html", names).collect()  # at most MOST_JOURNALS rows
    if len(top) < journals:
        raise ScholarError(f"only {len(top)} journals at {url}")
    rows = []
    for j in top[:journals]:
        found = core_articles(page(urljoin(url, j.href)), "html", articles).collect() if j.href else []
        if j.href and len(found) < articles:
            raise ScholarError(f"only {len(found)} articles of {j.journal}")
        rows += [(j.journal, j.h5_index, j.h5_median, i, r.title, r.year) for i, r in enumerate(found)]
    return spark.createDataFrame(rows, ARTICLES)


def _whole(c: Column) -> Column:
    return F.when(F.trim(c).rlike("^[+-]?[0-9]{1,9}$"), F.trim(c).cast("int"))


_JOURNAL = "name string, h5_index string, h5_median string, articles array<string>, papers array<string>"


def read_json_fixture(spark: SparkSession, path: str) -> DataFrame:
    """``{"journals": [...]}`` or a bare list; articles under ``articles`` or ``papers``, as objects or titles."""
    text = spark.read.text(path, wholetext=True).select(F.trim("value").alias("v"))
    journals = F.coalesce(F.from_json("v", "struct<journals array<string>>")["journals"], F.when(F.startswith("v", F.lit("[")), F.from_json("v", "array<string>")))
    listed = text.select(journals.alias("js")).select(F.posexplode_outer(F.slice("js", 1, MOST_JOURNALS)).alias("place", "j"))
    each = listed.select("place", F.from_json("j", _JOURNAL).alias("j")).select("place", "j.*")
    papers = each.select("place", F.trim("name").alias("journal"), _whole(F.col("h5_index")).alias("h5_index"), _whole(F.col("h5_median")).alias("h5_median"), F.posexplode_outer(F.slice(F.coalesce("articles", "papers"), 1, MOST_ARTICLES)).alias("ord", "a"))
    # An article is an object or its title.
    parsed = F.when(F.startswith("a", F.lit("{")), F.from_json("a", "title string, year string")).otherwise(F.struct(F.col("a").alias("title"), F.lit(None).cast("string").alias("year")))
    rows = papers.select("place", "journal", "h5_index", "h5_median", "ord", parsed.alias("p")).select("*", F.trim("p.title").alias("title"), _whole(F.col("p.year")).alias("year"))
    if rows.where((F.coalesce("journal", F.lit("")) == "") | (F.col("ord").isNotNull() & (F.coalesce("title", F.lit("")) == ""))).limit(1).count():
        raise ScholarError(f"{path} must list journals with a name, and articles with a title")
    return rows.where(F.col("ord").isNotNull()).orderBy("place", "ord").select(*(c.split()[0] for c in ARTICLES.split(", ")))


def read_csv_fixture(spark: SparkSession, path: str) -> DataFrame:
    """One row per article; column names have aliases; journals in the order of their first row, which gives their h5."""
    raw = spark.read.csv(path, header=True)
    names = {c.strip().lower(): c for c in raw.columns}

    def first(*aliases: str) -> Column:
        found = [F.nullif(F.trim(F.col(f"`{names[a]}`")), F.lit("")) for a in aliases if a in names]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    rows = raw.withColumn("line", F.monotonically_increasing_id()).select(
        "line", first("journal", "journal_name", "name").alias("journal"), first("title", "paper_title").alias("title"), _whole(first("year")).alias("year"),
        _whole(first("h5_index")).alias("h5_index"), _whole(first("h5_median")).alias("h5_median"),
    )
    if rows.where(F.col("journal").isNull() | F.col("title").isNull()).limit(1).count():
        raise ScholarError(f"{path} has rows without journal or title")
    grouped = rows.groupBy("journal").agg(
        F.min("line").alias("first"), F.min_by("h5_index", "line").alias("h5_index"), F.min_by("h5_median", "line").alias("h5_median"), F.array_sort(F.collect_list(F.struct("line", "title", "year"))).alias("articles")
    )
    top = grouped.orderBy("first").limit(MOST_JOURNALS)
    return top.select("journal", "h5_index", "h5_median", F.posexplode(F.slice("articles", 1, MOST_ARTICLES)).alias("ord", "a")).select("journal", "h5_index", "h5_median", "ord", F.col("a.title").alias("title"), F.col("a.year").alias("year"))


def read_fixture(spark: SparkSession, path: str) -> DataFrame:
    return (read_csv_fixture if path.lower().endswith(".csv") else read_json_fixture)(spark, path)


def load(scrape: Callable[[], DataFrame], fixture: Callable[[], DataFrame] | None) -> tuple[DataFrame, str]:
    """The scraped input, or the fixture where scraping fails and there is one; and which it was."""
    try:
        return scrape(), "scrape"
    except Exception:
        if fixture is None:
            raise
        return fixture(), "fixture"
