import datetime as dt

import pytest

from shelfwise.operators import features as FE
from shelfwise.operators.panel import daily_panel, filter_history


def series(spark, n=10, gaps=False):
    rows = []
    for i in range(n):
        d = dt.date(2020, 1, 1) + dt.timedelta(days=i * (2 if gaps and i >= 5 else 1) - (5 if gaps and i >= 5 else 0))
        rows.append((d, "S1", "P1", "C1", "R1", float(i)))
    return spark.createDataFrame(rows, "date date, store_id string, product_id string, category string, region string, quantity double")


def test_calendar_first_row(spark):  # F12
    df = FE.calendar_features(series(spark)).orderBy("date").first()
    assert (df["day_of_week"], df["month"], df["quarter"], df["day_of_month"], df["is_weekend"]) == (2, 1, 1, 1, 0)


def test_lags_and_moving_averages(spark):  # F13
    df = FE.moving_averages(FE.lag_features(series(spark), (1, 7)), (7,)).orderBy("date").collect()
    assert [r["lag_1"] for r in df] == [None] + [float(i) for i in range(9)]
    assert [r["lag_7"] for r in df] == [None] * 7 + [0.0, 1.0, 2.0]
    assert [r["ma_7"] for r in df] == [None] * 6 + [3.0, 4.0, 5.0, 6.0]


def test_strict_moving_average_excludes_today(spark):
    df = FE.moving_averages(series(spark), (7,), include_current=False).orderBy("date").collect()
    assert [r["ma_7"] for r in df] == [None] * 7 + [3.0, 4.0, 5.0]


def test_calendar_mode_differs_on_gaps(spark):
    s = series(spark, 10, gaps=True)  # days 0..4 then every other day
    rows = FE.lag_features(s, (1,), "calendar").orderBy("date").collect()
    assert rows[1]["lag_1"] == 0.0
    assert rows[6]["lag_1"] is None  # the previous calendar day has no row
    ma = FE.moving_averages(s, (3,), True, "calendar").orderBy("date").collect()
    assert ma[2]["ma_3"] == pytest.approx(1.0)
    assert ma[6]["ma_3"] == pytest.approx((5 + 6) / 3)  # day 6 has no row: counts as zero


def test_ma_equals_mean_of_rows_property(spark):
    s = series(spark, 40)
    rows = FE.moving_averages(s, (30,)).orderBy("date").collect()
    q = [r["quantity"] for r in rows]
    for i in range(29, 40):
        assert rows[i]["ma_30"] == pytest.approx(sum(q[i - 29:i + 1]) / 30)


def test_clean_and_clip(spark):
    df = spark.createDataFrame([(float("inf"), 2e7, None), (float("nan"), -3e7, 5.0)], "a double, b double, current_stock double")
    out = FE.clip_columns(FE.clean_numeric(df)).collect()
    assert [r["a"] for r in out] == [0.0, 0.0]
    assert [r["b"] for r in out] == [1e6, -1e6]


def test_feature_frame_excludes_leaky_quantity_for_revenue(spark):
    df = spark.createDataFrame([(1.0, 2.0, 2.0, 5.0)], "price double, quantity double, revenue double, lag_1 double")
    _, cols = FE.feature_frame(df, "revenue")
    assert "quantity" not in cols and "price" in cols
    _, cols2 = FE.feature_frame(df, "revenue", leaky=True)
    assert "quantity" in cols2


def test_history_filter(spark):  # F16
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), "P1", "A", 1) for i in range(30)]
    rows += [(dt.date(2020, 1, 1) + dt.timedelta(days=i), "P2", "B", 1) for i in range(20)]
    df = spark.createDataFrame(rows, "date date, product_id string, category string, quantity int")
    out = filter_history(df, 25)
    assert out.count() == 30 and {r["product_id"] for r in out.collect()} == {"P1"}


def test_daily_panel_mode_and_sums(spark):
    d = dt.date(2020, 1, 1)
    rows = [(d, "S", "P", "C", "R", 2.0, 10.0, "Sunny", "Summer"),
            (d, "S", "P", "C", "R", None, 20.0, "Rainy", "Summer"),
            (d, "S", "P", "C", "R", 3.0, None, "Rainy", "Winter"),
            (d, "S", "P", "C", "R", 1.0, 30.0, "Sunny", "Winter")]
    df = spark.createDataFrame(rows, "date date, store_id string, product_id string, category string, region string, "
                                     "units_sold double, price double, weather_condition string, seasonality string")
    r = daily_panel(df).first()
    assert r["quantity"] == 6.0 and r["price"] == 20.0
    assert r["weather_condition"] == "Rainy" and r["seasonality"] == "Summer"  # ties -> smallest


def test_history_distinct_days_strict(spark):
    rows = [(dt.date(2020, 1, 1 + i % 10), "P1", "A", f"S{i % 3}", 1) for i in range(30)]  # 30 rows, 10 days
    df = spark.createDataFrame(rows, "date date, product_id string, category string, store_id string, quantity int")
    assert filter_history(df, 25).count() == 30  # reference: rows
    assert filter_history(df, 25, count="distinct_days").count() == 0  # strict: days


def test_strict_and_calendar_variants_differ_only_as_documented(spark):
    import random
    rng = random.Random(11)
    rows = []
    for store in ("S1", "S2"):
        for i in range(45):
            rows.append((dt.date(2021, 3, 1) + dt.timedelta(days=i), store, "P", "C", "R", float(rng.randint(0, 20))))
    df = spark.createDataFrame(rows, "date date, store_id string, product_id string, category string, region string, quantity double")
    par = FE.moving_averages(df, (7,), True).withColumnRenamed("ma_7", "par")
    strict = FE.moving_averages(par, (7,), False).withColumnRenamed("ma_7", "strict")
    out = FE.lag_features(strict.withColumn("quantity_bak", strict["quantity"]).withColumn("quantity", strict["par"]), (1,))
    for r in out.collect():
        assert (r["strict"] is None and r["lag_1"] is None) or r["strict"] == pytest.approx(r["lag_1"])
    rows_lag = FE.lag_features(df, (1, 7), "rows").collect()
    cal_lag = {(r["date"], r["store_id"]): (r["lag_1"], r["lag_7"]) for r in FE.lag_features(df, (1, 7), "calendar").collect()}
    assert all(cal_lag[(r["date"], r["store_id"])] == (r["lag_1"], r["lag_7"]) for r in rows_lag)  # no gaps -> equal
