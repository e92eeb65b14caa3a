"""Papers from works: the wanted fields, and the reasons why a work is skipped.

Defined results: null, blank or damaged fields give null, and a reason where the field is required; several reasons may
hold; repeated rows are parsed each; extra columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_columns, has_visible, looks_clean, looks_english

#: Output fields and the columns that each is made from.
COLUMNS = {
    "title": ["display_name"],
    "abstract": ["abstract_inverted_index"],
    "publication_date": ["publication_date"],
    "publication_venue": ["primary_location", "locations"],
}
MALFORMED = "malformed_abstract_json"


def selected_columns(fields: list[str], always: tuple[str, ...] = ("id", "primary_topic")) -> list[str]:
    """Columns that the fields need, each once, in order."""
    return list(dict.fromkeys([*always, *(c for f in fields for c in COLUMNS[f])]))


def location_venue(location: Column) -> Column:
    """The source's name or else the raw one, whichever isn't blank; uncleaned."""
    source, raw = location["source"]["display_name"], location["raw_source_name"]
    return F.when(has_visible(source), source).when(has_visible(raw), raw)


def first_venue() -> Column:
    """The first location that names a venue, the primary one before the others; uncleaned."""
    named = F.filter(F.transform(F.col("locations"), location_venue), lambda v: v.isNotNull())
    return F.coalesce(location_venue(F.col("primary_location")), F.get(named, F.lit(0)))


def parse_papers(
    works: DataFrame, fields: list[str], required: list[str] | Column, *, english: bool | Column = False, clean: bool | Column = False, keep: tuple[str, ...] = ("id",), wanted: Column | None = None
) -> DataFrame:
    """``keep``, the fields, and ``skip_reasons``; a work is accepted where that is empty.

    What is required, and whether text must be English and clean, may differ by row: columns then say so, and ``wanted``
    names the fields of each row; others are null and give no reason. These columns must be among ``keep``.
    """
    flag = lambda x: F.coalesce(x, F.lit(False)) if isinstance(x, Column) else F.lit(bool(x))
    asked = lambda f: F.lit(True) if wanted is None else flag(F.array_contains(wanted, f))
    needed = lambda f: (flag(F.array_contains(required, f)) if isinstance(required, Column) else F.lit(f in required)) & asked(f)
    raw = {"title": F.col("display_name"), "abstract": F.col("abstract_inverted_index"), "publication_date": F.col("publication_date").cast("string"), "publication_venue": first_venue()}
    made = works.select(*keep, *((raw[f] if wanted is None else F.when(asked(f), raw[f])).alias(f) for f in fields))
    given = ["abstract"] if "abstract" in fields else []
    judged = clean if isinstance(clean, Column) or clean else None
    parts = clean_columns(made, [f for f in fields if f != "publication_date"], given if judged is not None else [], given)
    broken = F.col("abstract_malformed") if given else F.lit(False)
    filled = {f: F.when(F.col(f) != "", F.col(f)).alias(f) for f in fields}
    reasons = [F.when(needed(f) & (F.coalesce(F.col(f), F.lit("")) == ""), F.lit(f"missing_{f}")) for f in COLUMNS if f in fields and (isinstance(required, Column) or f in required)]
    if isinstance(english, Column) or english:
        reasons += [F.when(flag(english) & (F.col(f) != "") & ~looks_english(F.col(f)), F.lit(f"non_english_{f}")) for f in ("title", "abstract") if f in fields]
    if judged is not None and given:
        reasons.append(F.when(flag(clean) & (F.col("abstract") != "") & ~looks_clean(F.col("abstract"), F.col("abstract_decoded")), F.lit("unclean_abstract")))
    found = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    return parts.select(*keep, *filled.values(), F.when(F.coalesce(broken, F.lit(False)), F.array(F.lit(MALFORMED))).otherwise(found).alias("skip_reasons"))


def skip_histogram(parsed: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """How often each reason holds; a row may count for several."""
    return parsed.select(*by, F.explode("skip_reasons").alias("reason")).groupBy(*by, "reason").agg(F.count(F.lit(1)).alias("n"))

