"""Canonical ids of works and topics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed patterns, also used in the SQL of the oracle: a letter with digits that touches no other letter or digit.
WORK_PATTERN = r"(?:^|[^0-9A-Za-z])[Ww]([0-9]+)(?:[^0-9A-Za-z]|$)"
TOPIC_PATTERN = r"(?:^|[^0-9A-Za-z])[Tt]([0-9]+)(?:[^0-9A-Za-z]|$)"
#: A character that isn't white space, of any script.
VISIBLE = r"[^\s\pZ\x0b\x1c-\x1f\x85]"


def _key(col: Column, pattern: str, letter: str) -> Column:
    digits = F.regexp_extract(col, pattern, 1)
    return F.when(digits != "", F.concat(F.lit(letter), digits))


def work_key(col: Column) -> Column:
    """``W`` and the digits of a work id however it is written; null where there is none."""
    return _key(col, WORK_PATTERN, "W")


def topic_key(col: Column) -> Column:
    """``T`` and the digits of a topic id however it is written; null where there is none."""
    return _key(col, TOPIC_PATTERN, "T")


def has_text(col: Column) -> Column:
    """True where the string is neither null nor only white space."""
    return F.coalesce(col.rlike(VISIBLE), F.lit(False))


def last_segment(col: Column) -> Column:
    """What follows the last slash, trailing slashes dropped; null stays null."""
    return F.regexp_extract(F.regexp_replace(F.trim(col), "/+$", ""), r"([^/]+)$", 1)


def segment_after_slash(col: Column) -> Column:
    """What follows the last slash as it stands: a trailing slash gives the empty string."""
    return F.regexp_extract(col, r"([^/]+)$", 1)


def bucket_of(col: Column, buckets: int) -> Column:
    """A stable bucket number, never negative."""
    return F.pmod(F.xxhash64(col), F.lit(buckets)).cast("int")
