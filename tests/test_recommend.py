import pytest

from shelfwise.operators import recommend as R
from shelfwise.sources.files import stock_from_frame


def test_recommendations_reference_fixture(spark):  # F20
    preds = spark.createDataFrame([("P0001", "Groceries", -5.0), ("P0002", "Electronics", 10.0)],
                                  "product_id string, category string, prediction double")
    stock = stock_from_frame(spark.createDataFrame([("P0001", "Groceries", 5.0), ("P0002", "Electronics", 0.0)],
                                                   "product_id string, category string, current_stock double"))
    rec = {r["product_key"]: r for r in R.recommend_orders(preds, stock).collect()}
    p2, p1 = rec["P0002_Electronics"], rec["P0001_Groceries"]
    assert p2["recommended_order"] == 140 and p2["safety_stock"] == pytest.approx(12)
    assert p2["days_until_stockout"] == 0 and p2["reorder_urgency"] == "URGENT"
    assert p1["recommended_order"] == 0 and p1["days_until_stockout"] == 999 and p1["reorder_urgency"] == "POOR"
    assert p2["product_line"] == "P0002 (Electronics)"
    order = [r["product_key"] for r in R.sort_recommendations(R.recommend_orders(preds, stock)).collect()]
    assert order == ["P0002_Electronics", "P0001_Groceries"]


def test_nan_prediction_is_error(spark):
    preds = spark.createDataFrame([("P", "C", float("nan"))], "product_id string, category string, prediction double")
    with pytest.raises(Exception, match="1 predictions are NaN"):
        R.recommend_orders(preds, None).collect()
    assert R.recommend_orders(preds, None, validate=False).count() == 1


@pytest.mark.parametrize("stock,level", [(3.0, "URGENT"), (3.01, "NORMAL"), (7.0, "NORMAL"), (7.5, "LOW"),
                                         (14.0, "LOW"), (14.01, "POOR")])
def test_urgency_edges(spark, stock, level):
    df = spark.createDataFrame([(stock, 1.0)], "current_stock double, predicted_demand double")
    assert R.with_urgency(df).first()["reorder_urgency"] == level


def test_all_products_shape_and_summary(spark):
    preds = spark.createDataFrame([(2.0,), (4.0,)], "prediction double")
    rec = R.recommend_orders(preds, None)
    r = rec.first()
    assert r["product_line"] == "All Products" and r["predicted_demand"] == 3.0 and r["recommended_order"] == 42.0
    summ = {x["reorder_urgency"]: x for x in R.urgency_summary(rec).collect()}
    assert set(summ) == {"URGENT", "NORMAL", "LOW", "POOR"} and summ["URGENT"]["n_products"] == 1
    rep = R.final_report(rec).first()
    assert rep["Recommended Order Quantity"] == 42.0 and "Product Line" in rep.asDict()


def test_format_report_text(spark):
    rec = spark.createDataFrame([("P (C)", "POOR", 1234.4, 0.0, 999.0, 1234.5)],
                                "product_line string, reorder_urgency string, current_stock double, "
                                "recommended_order double, days_until_stockout double, predicted_demand double")
    r = R.format_report(rec).first()
    assert r["current_stock_text"] == "1,234 units" and r["days_text"] == "Sufficient"
    assert r["demand_money_text"] == "$1,234.50"


def test_order_and_urgency_match_plain_formulas(spark):
    """Randomised invariant: the column expressions equal a plain restatement."""
    import random
    rng = random.Random(3)
    rows = [(rng.choice([0.0, rng.uniform(0, 500)]), rng.choice([0.0, -1.0, rng.uniform(0.01, 60)]))
            for _ in range(300)]
    df = spark.createDataFrame(rows, "current_stock double, predicted_demand double")
    out = R.with_urgency(R.order_quantity(df)).collect()
    for r in out:
        s, d = r["current_stock"], r["predicted_demand"]
        days = s / d if d > 0 else 999.0
        lvl = ("POOR" if d <= 0 else "URGENT" if days <= 3 else "NORMAL" if days <= 7
               else "LOW" if days <= 14 else "POOR")
        assert r["reorder_urgency"] == lvl
        assert r["days_until_stockout"] == pytest.approx(days)
        assert r["recommended_order"] == pytest.approx(max(0.0, d * 14.0 - s))
        assert r["recommended_order"] >= 0


def test_report_rounds_halves_to_even(spark):  # P17, on values that doubles hold exactly
    values = [0.125, 0.375, 2.625, -0.125, 1.0, 7.0 / 3]
    rec = spark.createDataFrame([(str(k), v) for k, v in enumerate(values)], "product_line string, predicted_demand double")
    report = R.final_report(rec)
    name = dict(R.FINAL_COLUMNS)
    got = {r[name["product_line"]]: r[name["predicted_demand"]] for r in report.collect()}
    assert [got[str(k)] for k in range(len(values))] == [0.12, 0.38, 2.62, -0.12, 1.0, 2.33] == [round(v, 2) for v in values]
