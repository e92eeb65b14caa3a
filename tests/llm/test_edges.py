import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import edges

from paperloom.llm import queries

pytestmark = pytest.mark.skipif(not os.path.exists(edges.SOURCE), reason="no test data")


def test_empty_tables(spark, tmp_path):
    assert set(edges.counts(spark, (queries,), edges.make("empty", tmp_path)).values()) == {0}


def test_null_and_repeated_rows_and_clashing_columns(spark, tmp_path):
    got = edges.counts(spark, (queries,), edges.make("odd", tmp_path))
    assert got.pop("p3_sample") >= 0 and all(got.values())  # so few works make an empty sample
