"""Queries against DuckDB on the smallest tables; set ALL_QUERIES=1 for every one of them."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from check import compare, oracle  # noqa: E402

SF = "/root/testdata/sf0.001"
SOME = ["gold_fact_change", "mart_indicator", "consolidate_targets", "block_history", "block_panel", "weighted_auc", "threshold_sweep",
        "risk_of_missing", "stratified_sample", "shuffle_within_group", "chi_square_wide", "quantile_bucket", "src_header_sentinel"]
NAMES = sorted(entry.oracle_sql()) if os.environ.get("ALL_QUERIES") else SOME

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables absent")


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]).startswith("ok")


def test_entry_has_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "change" in df.columns


def test_every_check_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
