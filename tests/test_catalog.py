"""DuckDB oracle on the smallest driver tables, and the wide build's column count."""

import os

import duckdb
import pytest

from furrow.plans.registry import all_oracle_sql, all_queries
from tests.conftest import SF
from tools.check_oracle import TABLES, compare

FAST = ["group_stats", "group_quantiles", "describe", "interaction_exprs", "expression_library", "quantile_band",
        "round_digits", "missingness", "count_encode", "factorize", "target_encode_oof", "target_encode_full",
        "stratified_sample", "class_metrics", "gate", "column_drift", "sliding_p95", "monitor_stream",
        "density_curve", "cv_fold_scores", "cv_mean_probabilities", "class_weights", "features_round_trip",
        "submission_round_trip", "constant_columns", "read_checked_parquet", "stream_sliding_p95"]
#: All queries with SQL take some ten minutes on eight cores.
ORACLES = sorted(all_oracle_sql()) if os.environ.get("FURROW_ALL_ORACLES") else FAST


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_oracle(spark, con, name):
    got = all_queries()[name](spark, SF).toPandas()
    exp = con.sql(all_oracle_sql()[name]).df()
    exact, close, msg = compare(got, exp)
    assert close, msg


def test_every_query_registered_with_callable(spark):
    qs = all_queries()
    assert len(qs) >= 60
    assert set(all_oracle_sql()) <= set(qs)


def test_entry_runs(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
