"""Driver contract: entry smoke test and Spark-vs-DuckDB agreement on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"product_line", "reorder_urgency", "recommended_order"} <= set(df.columns)
    assert all(r["recommended_order"] >= 0 for r in rows)


def test_registry_keys():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    assert len(sql) >= 55


def _norm(v):
    return repr(round(v, 9)) if isinstance(v, float) and not math.isnan(v) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", ["daily_panel", "quality_report", "lag_rows", "ma_calendar", "chrono_split",
                                  "baseline_seasonal", "compare_models", "recommend_orders", "temporal_errors",
                                  "walk_forward_ranges", "stock_p75", "one_hot_wide", "chrono_split_date",
                                  "filter_history_days", "stock_mean_train", "events_panel", "resolve_stock_column",
                                  "stock_duplicates", "split_ties", "fold_ties", "diagnostics", "correlated_pairs",
                                  "executive_summary", "ridge_coefficients", "ridge_cv", "correlated_slots",
                                  "one_hot_long", "split_gains", "row_positions", "residual_qq", "performance_tier"])
def test_oracle_agreement_small(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    duck.sql(f"CREATE OR REPLACE VIEW oracle AS {E.oracle_sql()[name]}")  # as the driver does
    rel = duck.sql("SELECT * FROM oracle")
    assert sorted(df.columns) == sorted(rel.columns)
    order = sorted(df.columns)
    s = sorted("|".join(_norm(r[c]) for c in order) for r in df.collect())
    idx = [rel.columns.index(c) for c in order]
    o = sorted("|".join(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert s == o
