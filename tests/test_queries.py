"""Registered queries against their SQL twins at the smallest scale, and rules on the registry."""

import os

import pytest

import __spark_entry__ as entry
from hydrolap.plans import registry
from tools.check import compare, connect

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "slice_region", "measures_by_level", "rollup_geo", "pivot_row_pct", "compare_periods", "selection_vs_context", "fact_load",
    "temporal_summary", "yoy_change", "coverage_gap_top", "recovery_verdict", "tukey_outliers", "quality_scorecard",
    "clean_records", "dedup_reject", "review_records", "load_new", "etl_rerun", "cause_summary", "cv_folds", "auc_rank",
    "feature_rank", "assign_centroid", "bigrams", "sentiment_bins", "scan_csv_text", "calendar_gap_days", "first_occurrence",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", SAMPLE)
def test_query(spark, con, name):
    assert compare(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 5


def test_only_learners_lack_a_twin():
    assert set(registry.QUERIES) - set(registry.ORACLES) == {"ml_tree", "ml_forest", "ml_logit", "ml_kmeans", "ml_silhouette"}
