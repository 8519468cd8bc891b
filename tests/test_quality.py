import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import quality as Q
from shelfwise.operators.features import one_hot, numeric_features
from shelfwise.schema import REQUIRED_RAW_COLUMNS


def test_require_columns_empty_and_none(spark):  # F1
    with pytest.raises(ValueError, match="None or empty"):
        Q.require_columns(None)
    with pytest.raises(ValueError, match="None or empty"):
        Q.require_columns(spark.createDataFrame([], "a int"))


def test_require_columns_missing(spark):  # F2
    df = spark.createDataFrame([("2020-01-01", "A", 1)], "`Date` string, `Category` string, `Units Sold` int")
    with pytest.raises(ValueError, match="missing required columns"):
        Q.require_columns(df)


def test_require_columns_full(spark):  # F3
    cols = sorted(REQUIRED_RAW_COLUMNS)
    df = spark.createDataFrame([tuple("x" for _ in cols)] * 2, ", ".join(f"`{c}` string" for c in cols))
    Q.require_columns(df)


def _audit(df):
    return {r["risk"]: r for r in Q.audit_leakage(df).collect()}


def test_negative_inventory_flagged(spark):  # F4
    df = spark.createDataFrame([(-5, 5), (10, 10), (20, 15)], "inventory_level int, quantity int")
    a = _audit(df.withColumn("date", F.lit(dt.date(2020, 1, 1))))
    assert a["inventory_negative_values"]["triggered"] == 1


def test_negative_orders_flagged(spark):  # F5
    df = spark.createDataFrame([(-5, 5), (10, 10), (20, 15)], "units_ordered int, quantity int")
    a = _audit(df)
    assert a["units_ordered_negative_values"]["triggered"] == 1
    assert a["units_ordered_future_pattern"]["triggered"] == 0  # -5 < 5
    assert a["units_ordered_negative_values"]["recommendation"]


def test_next_day_correlation_flagged(spark):  # inventory(t) = quantity(t+1)
    q = [float((i * 7) % 11) for i in range(101)]
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), q[i + 1], q[i]) for i in range(100)]
    df = spark.createDataFrame(rows, "date date, inventory_level double, quantity double")
    a = _audit(df)
    assert a["inventory_temporal_correlation"]["triggered"] == 1
    assert a["inventory_temporal_correlation"]["measure"] == pytest.approx(1.0)


def test_zero_variance_correlation_is_null(spark):
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), 3.0, float(i)) for i in range(5)]
    a = _audit(spark.createDataFrame(rows, "date date, inventory_level double, quantity double"))
    assert a["inventory_temporal_correlation"]["measure"] is None
    assert a["inventory_temporal_correlation"]["triggered"] == 0


def test_parse_dates_errors(spark):  # F7, F8
    with pytest.raises(ValueError, match="Date column not found"):
        Q.parse_dates(spark.createDataFrame([(1,), (2,)], "units_sold int"))
    bad = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3)], "date_text string, units_sold int")
    with pytest.raises(ValueError, match="Failed to parse"):
        Q.parse_dates(bad)


def test_parse_dates_good_and_lenient(spark):  # F9
    df = spark.createDataFrame([("2020-01-01", 1), ("2020-01-02", 2), ("01/03/2020", 3)],
                               "date_text string, units_sold int")
    out = Q.parse_dates(df).orderBy("units_sold").collect()
    assert [r["date"] for r in out] == [dt.date(2020, 1, 1), dt.date(2020, 1, 2), dt.date(2020, 1, 3)]


def test_negatives_clamped(spark):  # F10
    df = spark.createDataFrame([("P1", "A", -5.0, 5.0, "2020-01-01"), ("P2", "B", 10.0, -2.0, "2020-01-02")],
                               "product_id string, category string, units_sold double, price double, date_text string")
    out = Q.clamp_negative(df).collect()
    assert all(r["units_sold"] >= 0 and r["price"] >= 0 for r in out)
    rep = {r["metric"]: r["value"] for r in Q.quality_report(df).collect()}
    assert rep["negative_units_fixed"] + rep["negative_price_fixed"] == 2


def test_duplicates_removed(spark):  # F11
    df = spark.createDataFrame([("P1", "A", 1.0, "2020-01-01")] * 2 + [("P2", "B", 2.0, "2020-01-01")],
                               "product_id string, category string, units_sold double, date_text string")
    assert Q.dedup(df).count() == 2
    rep = {r["metric"]: r["value"] for r in Q.quality_report(df).collect()}
    assert rep["duplicates_removed"] == 1


def test_fix_category_mode_tie_smallest_and_nulls(spark):
    rows = [("P1", "B"), ("P1", "A"), ("P1", None), ("P2", "C"), ("P2", "C"), ("P2", "D"), (None, "Z")]
    df = spark.createDataFrame(rows, "product_id string, category string")
    assert {r["product_id"] for r in Q.inconsistent_products(df).collect()} == {"P1", "P2"}
    fixed = Q.fix_category(df).collect()
    by = {}
    for r in fixed:
        by.setdefault(r["product_id"], set()).add(r["category"])
    assert by == {"P1": {"A"}, "P2": {"C"}, None: {"Z"}}


def test_coerce_and_impute(spark):
    df = spark.createDataFrame([("P1", "A", "3", "x"), ("P1", "A", "n/a", "2.5"), ("P1", None, None, "1")],
                               "product_id string, category string, units_sold string, price string")
    typed = Q.coerce_types(df)
    vals = sorted((r["units_sold"], r["price"]) for r in typed.collect() if r["category"])
    assert vals == [(0.0, 2.5), (3.0, 0.0)]
    assert Q.impute(typed).count() == 2
    miss = {r["column_name"]: r["n_missing"] for r in Q.missing_counts(df).collect()}
    assert miss["category"] == 1 and miss["units_sold"] == 1


def test_flags_and_numeric_defaults(spark):  # F14
    df = spark.createDataFrame([(1, 0), (0, 1), (0, 0)], "holiday int, promotion int")
    out = numeric_features(df).collect()
    assert [r["is_holiday"] for r in out] == [1, 0, 0]
    assert [r["is_promotion"] for r in out] == [0, 1, 0]
    assert out[0]["discount"] == 0.0 and out[0]["price"] == 0.0


def test_one_hot_names_and_single_hot(spark):  # F15
    df = spark.createDataFrame([("Sunny", "Summer", "North"), ("Rainy", "Winter", "South"),
                                ("Sunny", None, "North")], "weather_condition string, seasonality string, region string")
    out = one_hot(df, ["weather_condition", "seasonality", "region"])
    assert "weather_condition_Sunny" in out.columns and "region_North" in out.columns
    Q.require_key_features(out)
    rows = out.collect()
    assert sum(rows[0][c] for c in out.columns if c.startswith("weather_condition_")) == 1
    assert sum(rows[2][c] for c in out.columns if c.startswith("seasonality_")) == 0  # missing -> all zero
