import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.config import CostConfig
from shelfwise.operators import baselines as B
from shelfwise.operators import metrics as M
from shelfwise.operators.features import with_revenue


def _d(i):
    return dt.date(2020, 1, i)


def test_baselines_per_product(spark):  # F22 (per-product semantics)
    schema = "date date, store_id string, product_id string, category string, region string, quantity double"
    train = spark.createDataFrame([(_d(1), "S", "P0001", "A", "R", 5.0), (_d(2), "S", "P0001", "A", "R", 10.0),
                                   (_d(3), "S", "P0002", "B", "R", 15.0)], schema)
    test = spark.createDataFrame([(_d(4), "S", "P0001", "A", "R", 0.0), (_d(5), "S", "P0002", "B", "R", 0.0),
                                  (_d(6), "S", "P0003", "C", "R", 0.0)], schema)
    last = {r["product_id"]: r["prediction"] for r in B.baseline_last(train, test).collect()}
    mean = {r["product_id"]: r["prediction"] for r in B.baseline_mean(train, test).collect()}
    assert last == {"P0001": 10.0, "P0002": 15.0, "P0003": 15.0}  # unseen -> global last
    assert mean == {"P0001": 7.5, "P0002": 15.0, "P0003": 10.0}  # unseen -> global mean
    glob = {r["product_id"]: r["prediction"] for r in B.baseline_last(train, test, key=None).collect()}
    assert set(glob.values()) == {15.0}


def test_seasonal_baseline_fallbacks(spark):
    schema = "date date, store_id string, product_id string, category string, region string, quantity double"
    train = spark.createDataFrame([(_d(6), "S", "P", "A", "R", 1.0), (_d(7), "S", "P", "A", "R", 2.0),
                                   (_d(13), "S", "P", "A", "R", 3.0)], schema)  # Jan 6 & 13 are Mondays
    test = spark.createDataFrame([(_d(20), "S", "P", "A", "R", 0.0), (_d(21), "S", "P", "A", "R", 0.0),
                                  (_d(22), "S", "Q", "A", "R", 0.0)], schema)
    out = {r["date"]: r["prediction"] for r in B.baseline_seasonal(train, test).collect()}
    assert out == {_d(20): 3.0, _d(21): 2.0, _d(22): 3.0}


def test_revenue_products(spark):  # F23
    df = spark.createDataFrame([(5.0, 2), (10.0, 3), (15.0, 4)], "price double, quantity int")
    assert [r["revenue"] for r in with_revenue(df).collect()] == [10.0, 30.0, 60.0]


def test_revenue_metrics(spark):  # F25
    df = spark.createDataFrame([(100.0, 110.0), (200.0, 190.0), (300.0, 310.0)], "label double, prediction double")
    r = M.revenue_metrics(df).first()
    assert r["mae"] == pytest.approx(10) and r["rmse"] == pytest.approx(10)
    assert (r["total_revenue_true"], r["total_revenue_pred"]) == (600.0, 610.0)
    assert r["revenue_error_pct"] == pytest.approx(1.6667, abs=1e-4)


def test_economic_cost(spark):  # F26 (test comment says 50.5; the arithmetic gives 100.5)
    df = spark.createDataFrame([(10.0, 15.0), (20.0, 15.0), (30.0, 25.0)], "label double, prediction double")
    r = M.economic_cost(df, CostConfig()).first()
    assert (r["over_prediction_units"], r["under_prediction_units"]) == (5.0, 10.0)
    assert r["holding_cost"] == pytest.approx(0.5) and r["stockout_cost"] == pytest.approx(100.0)
    assert r["total_cost"] == pytest.approx(100.5)


def test_perfect_forecast(spark):  # F27
    df = spark.createDataFrame([(10.0, 10.0), (20.0, 20.0), (30.0, 30.0)], "label double, prediction double")
    r = M.economic_cost(df).first()
    a = M.accuracy(df).first()
    assert r["total_cost"] == 0 and a["mae"] == 0 and a["rmse"] == 0


def test_dimension_breakdown_drops_null_values(spark):
    rows = [("Sunny", "Summer", "N", 1.0, 2.0), ("Rainy", "Summer", None, 3.0, 3.0), (None, "Winter", "N", 5.0, 1.0)]
    df = spark.createDataFrame(rows, "weather_condition string, seasonality string, region string, label double, prediction double")
    out = {(r["dimension"], r["value"]): r for r in M.dimension_impact(df).collect()}
    assert out[("Overall", "All")]["mae"] == pytest.approx((1 + 0 + 4) / 3)
    assert ("Region", None) not in out and ("Weather Condition", None) not in out
    assert out[("Seasonality", "Summer")]["mean_actual"] == 2.0


def test_best_model_first_on_tie(spark):
    cmp = spark.createDataFrame([("b", 1.0, 1), ("a", 1.0, 0), ("c", 0.5, 2)], "model string, rmse double, model_order int")
    assert M.best_model(cmp).first()["model"] == "c"
    cmp2 = cmp.where("model != 'c'")
    assert M.best_model(cmp2).first()["model"] == "a"
    lb = M.leaderboard(cmp.union(spark.createDataFrame([("baseline_x", 0.1, 9)], cmp.schema)), 2).collect()
    assert [r["model"] for r in lb] == ["c", "a"] and lb[0]["is_best"] == 1


def test_performance_tier_and_temporal(spark):
    pp = spark.createDataFrame([(f"p{i}", float(i)) for i in range(10)], "product_key string, rmse double")
    tiers = [r["tier"] for r in M.performance_tier(pp).orderBy("rmse").collect()]
    assert tiers[0] == "green" and tiers[-1] == "red" and "orange" in tiers
    df = spark.createDataFrame([(dt.date(2024, 1, 6), 2.0, 1.0), (dt.date(2024, 1, 8), 4.0, 1.0)],
                               "date date, label double, prediction double")
    te = {(r["dimension"], r["value"]): r["n_samples"] for r in M.temporal_errors(df).collect()}
    assert te[("Day_of_Week", "Saturday")] == 1 and te[("Weekend_Status", "Weekend")] == 1
    assert te[("Quarter", "Q1")] == 2 and te[("Month", "January")] == 2


def test_correlated_pairs_guard_constant(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 1.0) for i in range(10)], "a double, b double, c double")
    out = M.correlated_pairs(df, ["a", "b", "c"]).collect()
    assert [(r["feature_a"], r["feature_b"]) for r in out] == [("a", "b")]
    st = {r["feature"]: r for r in M.scaler_stats(df, ["a"]).collect()}
    assert st["a"]["mean"] == 4.5 and st["a"]["std"] == pytest.approx((sum((i - 4.5) ** 2 for i in range(10)) / 10) ** 0.5)
