"""Cleaning and judging of noisy text.

Judging is column expressions in the JVM. Cleaning is one stage of Arrow kernels, since the JVM decodes no character
references; only texts that hold an ampersand become Python strings. Null in, null out; an empty text stays empty; texts of any length are read whole.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import spread
from .abstracts import reconstruct_batch

#: Marks of a LaTeX source, and how much mark-up an abstract may hold.
LATEX_MARKS = ("\\documentclass", "\\begin{document}", "\\end{document}", "\\usepackage", "\\newtheorem", "\\pagestyle", "\\fancyhead", "\\fancyfoot")
MOST_BREAKS, MOST_TAGS, MOST_COMMANDS = 5, 5, 12
#: Letter ranges of scripts that aren't Latin, of Latin letters, and the share of the latter in English.
CJK = "[\\u3040-\\u30ff\\u3400-\\u4dbf\\u4e00-\\u9fff\\uac00-\\ud7af]"
LATIN = "[A-Za-z\\u00c0-\\u024f\\u1e00-\\u1eff]"
ENGLISH_SHARE = 0.85


#: Any white space, in the syntax of Arrow's regular expressions.
_SPACES = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\pZ]+"


def unescape(texts: pa.Array) -> pa.Array:
    """Character references decoded once; only texts with an ampersand become Python strings."""
    marked = np.flatnonzero(np.asarray(pc.fill_null(pc.match_substring(texts, "&"), False)))
    if not len(marked):
        return texts
    mask = np.zeros(len(texts), bool)
    mask[marked] = True
    decoded = [html.unescape(texts[int(i)].as_py()).encode("utf-8", "replace").decode() for i in marked]
    return pc.replace_with_mask(texts, pa.array(mask), pa.array(decoded, texts.type))


def without_markup(texts: pa.Array) -> pa.Array:
    """Tags become spaces, white space is collapsed and trimmed."""
    bare = pc.replace_substring_regex(texts, "(?i)</?[a-z][^>]*>", " ")
    return pc.replace_substring_regex(pc.replace_substring_regex(bare, _SPACES, " "), "^ | $", "")


def clean_columns(df: DataFrame, columns: list[str], decoded: list[str] | None = None, inverted: list[str] | None = None) -> DataFrame:
    """``df`` with the columns cleaned, and NAME_decoded for those of ``decoded``: cleaned, decoded again, lower case.

    Columns of ``inverted`` hold inverted indexes, are made into abstracts first, and get NAME_malformed.

    One narrow stage in Arrow's kernels; it also keeps what made the columns from being computed more than once.
    """
    again, indexes = decoded or [], inverted or []
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join([f"`{c}` {k}" for c, k in kinds.items()] + [f"`{c}_malformed` boolean" for c in indexes] + [f"`{c}_decoded` string" for c in again])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {c: batch.column(c) for c in kinds}
            for c in indexes:
                out[c], out[f"{c}_malformed"] = reconstruct_batch(out[c])
            for c in columns:
                out[c] = without_markup(unescape(out[c]))
            for c in again:
                out[f"{c}_decoded"] = pc.utf8_lower(unescape(out[c]))
            yield pa.RecordBatch.from_pydict(out)

    return spread(df).mapInArrow(run, schema)


def has_visible(text: Column) -> Column:
    """True where something but white space is left; null counts as nothing."""
    return F.coalesce(text.rlike("(?U)\\S"), F.lit(False))


def contains_cjk(text: Column) -> Column:
    return text.rlike(CJK)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def looks_english(text: Column) -> Column:
    """Latin letters are nearly all letters, and there are some; none of a CJK script."""
    letters = F.regexp_count(text, F.lit("\\p{L}"))
    latin = F.regexp_count(text, F.lit("[A-Za-z\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u024f\\u1e00-\\u1eff]"))
    return ~contains_cjk(text) & let(letters, lambda n: (n > 0) & (latin / F.greatest(n, F.lit(1)) >= F.lit(ENGLISH_SHARE)))


def looks_clean(text: Column, decoded: Column) -> Column:
    """No LaTeX source, few tags and few commands. ``decoded``: the text with references decoded, in lower case."""
    marks = "|".join(re.escape(mark) for mark in LATEX_MARKS)
    few = (F.regexp_count(decoded, F.lit("<br>")) <= MOST_BREAKS) & (F.regexp_count(decoded, F.lit("<[a-z][^>]*>")) <= MOST_TAGS)
    return ~decoded.rlike(marks) & few & (F.regexp_count(text, F.lit(r"\\[a-zA-Z]+")) <= MOST_COMMANDS)
