"""Registered queries vs their DuckDB oracle text on the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as E
from tabularis.sources.tables import TABLES, table_path
from tools.check_oracle import compare

SF = "/root/testdata/sf0.001"
NAMES = [
    "sales_features", "sales_seasonal_naive_metrics", "sales_centered_trend", "sales_date_folds",
    "clean_summary", "dup_keep_last", "invalid_range_split", "missing_by_column", "multi_flag_stats",
    "roc_auc", "average_precision", "pr_curve", "threshold_sweep", "operating_point", "class_report", "confusion_norm",
    "split_random", "split_stratified", "cv_folds", "encode_ordinal", "impute_scale",
    "quantile_cuts", "histogram_bins", "corr_matrix", "strongest_sensor",
    "rec_item_means", "rec_popularity_topk", "rec_user_similarity",
    "annotation_quarantine", "annotation_class_hist", "validate_requests", "silhouette_exact", "ols_simple",
    "validate_batches", "label_files", "confusion_wide", "class_summary", "constant_column_check", "latency_summary",
    "csv_round_trip", "tab_round_trip", "pipe_round_trip", "json_documents", "request_files", "dataset_manifest", "image_catalogue",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    return c


def test_every_query_has_a_callable():
    qs, oracle = E.queries(), E.oracle_sql()
    assert set(oracle) <= set(qs)
    assert len(qs) >= 70


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and set(df.columns) >= {"mae", "rmse", "r2", "mape_percent", "wmape_percent"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    diff = compare(rows, df.columns, res.fetchall(), [d[0] for d in res.description])
    assert diff is None, diff


def test_stream_scoring_equals_batch(spark):
    """V5: the Structured Streaming path scores exactly what the batch path scores."""
    qs = E.queries()
    cols = ["request_id", "failure_probability", "machine_failure_alarm", "decision"]
    batch = {tuple(r) for r in qs["score_batch"](spark, SF).select(*cols).collect()}
    stream = {tuple(r) for r in qs["score_stream"](spark, SF).select(*cols).collect()}
    assert batch and batch == stream
