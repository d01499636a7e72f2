"""Every registered query of the pose tables against its DuckDB oracle, and invariants that need none."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
import oracle

from posetables import queries as q

q.load()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(q.QUERIES))
def test_oracle(spark, con, name):
    assert not oracle.differences(q.QUERIES[name](spark, SF), con, q.ORACLE_SQL[name])


def test_pixel_counts_are_ordered(spark):
    bad = q.QUERIES["agg_annotate"](spark, SF).where("px_valid > px_visib OR (px_all > 0 AND px_visib > px_all) OR visib_fract < 0 OR visib_fract > 1")
    assert bad.count() == 0


def test_partials_merge_to_the_whole(spark):
    assert q.QUERIES["agg_incremental"](spark, SF).collect() == q.QUERIES["agg_dataset_stats"](spark, SF).collect()
