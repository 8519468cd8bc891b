import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import charts as C
from shelfwise.operators import metrics as M


def scored(spark):
    rows = [(dt.date(2020, 1, 1), "P1", "A", "Sunny", "R1", 10.0, 8.0),
            (dt.date(2020, 1, 1), "P2", "B", "Rainy", "R2", 20.0, 25.0),
            (dt.date(2020, 1, 2), "P1", "A", "Sunny", "R1", 5.0, -1.0)]
    return spark.createDataFrame(rows, "date date, product_id string, category string, weather_condition string, "
                                       "region string, label double, prediction double")


def test_sales_trend_and_filter(spark):
    panel = scored(spark).withColumnRenamed("label", "quantity")
    out = {(r["date"], r["product_line"]): r["quantity"] for r in C.sales_trend(panel).collect()}
    assert out[(dt.date(2020, 1, 1), "P1 (A)")] == 10.0 and len(out) == 3
    assert C.sales_trend(panel, "P2 (B)").count() == 1


def test_prediction_series_and_range(spark):
    s = {r["date"]: (r["actual"], r["predicted"]) for r in C.prediction_series(scored(spark)).collect()}
    assert s[dt.date(2020, 1, 1)] == (30.0, 33.0) and s[dt.date(2020, 1, 2)] == (5.0, 0.0)  # clipped
    r = C.prediction_range(scored(spark)).first()
    assert (r["min_value"], r["max_value"]) == (0.0, 25.0)


def test_residual_qq_grid(spark):
    rows = [(float(i), 0.0) for i in range(101)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    qq = C.residual_qq(df, points=3, exact=True).orderBy("p").collect()
    assert [r["p"] for r in qq] == [0.25, 0.5, 0.75]
    assert [r["sample_quantile"] for r in qq] == [25.0, 50.0, 75.0]
    assert qq[1]["theoretical_quantile"] == pytest.approx(0.0)
    approx = C.residual_qq(df, points=3, exact=False).orderBy("p").collect()
    assert [r["sample_quantile"] for r in approx] == [25.0, 50.0, 75.0]


def test_revenue_series_and_bins(spark):
    out = {(r["dimension"], r["value"]): r for r in C.revenue_series(scored(spark)).collect()}
    assert out[("Date", "2020-01-01")]["actual_revenue"] == 30.0
    assert out[("Weather Condition", "Sunny")]["predicted_revenue"] == 8.0
    assert ("Overall", "All") not in out
    bins = {r["bin"]: r["n"] for r in C.residual_bins(scored(spark), 10.0).collect()}
    assert bins == {0: 2, 2: 1}


def test_extremes_best_and_worst(spark):
    df = spark.createDataFrame([(f"p{i}", float(i % 4)) for i in range(8)], "value string, rmse double")
    ext = M.extremes(df, "rmse", 2, "value").collect()
    best = [r["value"] for r in ext if r["rank_side"] == "best"]
    worst = [r["value"] for r in ext if r["rank_side"] == "worst"]
    assert best == ["p0", "p4"] and worst == ["p3", "p7"]
    assert M.top_correlated(spark.createDataFrame([(1, 2, 0.9), (0, 3, 0.8), (0, 1, 0.95)], "i int, j int, abs_corr double"), 2) \
        .select(F.col("i"), F.col("j")).collect() == [(0, 1), (0, 3)]
