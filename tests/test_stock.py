import datetime as dt
import os
import tempfile

import pytest

from shelfwise.operators import stock as ST
from shelfwise.sources.sinks import write_params

SCHEMA = "date date, store_id string, product_id string, category string, region string, quantity double"


def panel(spark):
    rows = [(dt.date(2020, 1, d), "S", "P1", "A", "R", float(q)) for d, q in [(1, 1), (2, 2), (3, 3), (4, 10)]]
    rows += [(dt.date(2020, 1, 1), "S", "P2", "B", "R", 0.04)]
    return spark.createDataFrame(rows, SCHEMA)


def test_detect_stock_column_priority():
    assert ST.detect_stock_column(["Date", " Inventory Level", "current_stock"]) == " Inventory Level"
    assert ST.detect_stock_column(["units_in_stock", "price"]) == "units_in_stock"
    assert ST.detect_stock_column(["price", "qty"]) is None


@pytest.mark.parametrize("method,expected", [("mean", 40.0), ("median", 25.0), ("p75", 48.0), ("p90", 79.0),
                                             ("unknown", 40.0)])
def test_estimate_stock_methods(spark, method, expected):
    out = {r["product_key"]: r["current_stock"] for r in ST.estimate_stock(panel(spark), 10.0, method).collect()}
    assert out["P1_A"] == expected
    assert out["P2_B"] == 1.0  # at least one unit


def test_estimate_stock_as_of(spark):
    out = {r["product_key"]: r["current_stock"] for r in
           ST.estimate_stock(panel(spark), 10.0, "mean", as_of=dt.date(2020, 1, 4)).collect()}
    assert out["P1_A"] == 20.0


def test_latest_stock_and_priority(spark):
    raw = spark.createDataFrame([(dt.date(2020, 1, 1), "S1", "P1", "A", "R", 5.0),
                                 (dt.date(2020, 1, 3), "S1", "P1", "A", "R", -2.0),
                                 (dt.date(2020, 1, 2), "S1", "P2", "B", "R", None)],
                                "date date, store_id string, product_id string, category string, region string, inventory_level double")
    latest = {r["product_key"]: r["current_stock"] for r in ST.latest_stock(raw, "inventory_level").collect()}
    assert latest == {"P1_A": 0.0, "P2_B": 0.0}
    p = panel(spark)
    by_col = ST.resolve_stock(p, raw).collect()
    assert {r["stock_source"] for r in by_col} == {"dataset column: inventory_level"}
    file_ok = spark.createDataFrame([("P1_A", 7.0)], "product_key string, current_stock double")
    res = {r["product_key"]: (r["current_stock"], r["stock_source"]) for r in
           ST.resolve_stock(p, raw.drop("inventory_level"), file_ok).collect()}
    assert res == {"P1_A": (7.0, "stock file"), "P2_B": (0.0, "stock file")}
    mismatch = spark.createDataFrame([("nope", 7.0)], "product_key string, current_stock double")
    est = ST.resolve_stock(p, None, mismatch).collect()
    assert all(r["stock_source"].startswith("estimated") for r in est)
    zeros = ST.resolve_stock(p, None, None, auto_estimate=False).collect()
    assert {r["current_stock"] for r in zeros} == {0.0} and len(zeros) == 2


def test_with_stock_and_per_product(spark):
    p = panel(spark)
    stock = spark.createDataFrame([("P1_A", 9.0)], "product_key string, current_stock double")
    out = ST.with_stock(p, stock)
    assert "product_key" not in out.columns
    vals = {r["product_id"]: r["current_stock"] for r in out.collect()}
    assert vals == {"P1": 9.0, "P2": 0.0}
    first = {r["product_key"]: r["current_stock"] for r in ST.stock_per_product(out).collect()}
    assert first == {"P1_A": 9.0, "P2_B": 0.0}


def test_write_params(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="shelfwise-params-"), "params")
    write_params(spark, {"random_forest": {"numTrees": 200, "maxDepth": 10}}, path)
    assert spark.read.json(path).first()["model"] == "random_forest"
