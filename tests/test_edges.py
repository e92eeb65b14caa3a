import os

import edges
import pytest

from paperloom.plans import built, general, reference

pytestmark = pytest.mark.skipif(not os.path.exists(edges.SOURCE), reason="no test data")


def test_empty_tables(spark, tmp_path):
    assert set(edges.counts(spark, (reference, built, general), edges.make("empty", tmp_path)).values()) == {0}


def test_null_and_repeated_rows_and_clashing_columns(spark, tmp_path):
    got = edges.counts(spark, (reference, built, general), edges.make("odd", tmp_path))
    whole = edges.counts(spark, (general,), edges.SOURCE)
    same = ("p2_found", "p2_current", "p4_distinct", "p4_sample", "p5_found")  # repeated rows count once
    assert all(got[name] == whole[name] for name in same) and all(got.values())
