"""A cross-section of the registered queries against their check SQL."""

import pytest

import __spark_entry__ as entry
import check_queries

SF_DIR = "/root/testdata/sf0.01"
SAMPLE = (
    "resample_1h", "resample_multi_tf", "qa_summary", "qa_gaps_fx", "merge_coverage", "dwm_previous",
    "killzone_avg_range", "sr_zones", "pivot_join_monthly", "asof_backward", "macd", "feature_matrix",
    "simulate_trades", "backtest_metrics", "cv_walk_forward", "seasonal_naive_cv", "drift_psi", "stream_resample",
)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_its_check(spark, name):
    ok, message, _ = check_queries.compare(spark, check_queries.connect(SF_DIR), name, SF_DIR)
    assert ok, message


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
