import io
import json
import os
import tempfile
import zipfile

import numpy as np
import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from shelfwise.config import TrainingConfig
from shelfwise.operators import models as ML
from shelfwise.operators import metrics as M
from shelfwise.sources import files
from shelfwise.sources.sinks import load_model, save_model

HEADER = "Date,Store ID,Product ID,Category,Region,Units Sold,Price,Weather Condition,Seasonality\n"
ROWS = ["2022-01-01,S001,P0001,Groceries,North,10,5.5,Sunny,Winter\n",
        "2022-01-02,S001,P0001,Groceries,North,12,5.5,Rainy,Winter\n"]


def test_read_sales_csv_and_errors(spark):
    d = tempfile.mkdtemp(prefix="shelfwise-test-")
    p = os.path.join(d, "sales.csv")
    with open(p, "w") as fh:
        fh.write(HEADER + "".join(ROWS))
    df = files.read_sales(spark, p)
    assert "units_sold" in df.columns and "date_text" in df.columns and df.count() == 2
    bad = os.path.join(d, "bad.csv")
    with open(bad, "w") as fh:
        fh.write("Date,Units Sold\n2022-01-01,3\n")
    with pytest.raises(ValueError, match="missing required columns"):
        files.read_sales(spark, bad)
    with pytest.raises(ValueError):
        files.read_sales(spark, "")


def test_zip_member_rule_and_reader(spark):
    assert files.pick_csv_member(["a/b/long_name.csv", "x.csv", "readme.txt", "zz.csv"]) == "x.csv"
    assert files.pick_csv_member(["dir/a.csv", "dir/bb.csv"]) == "dir/a.csv"
    assert files.pick_csv_member(["notes.txt"]) is None
    d = tempfile.mkdtemp(prefix="shelfwise-zip-")
    for i in range(2):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as zf:
            zf.writestr("data/extra/other.csv", "x\n1\n")
            zf.writestr("sales.csv", HEADER + ROWS[i])
        with open(os.path.join(d, f"a{i}.zip"), "wb") as fh:
            fh.write(buf.getvalue())
    df = files.read_sales_zips(spark, os.path.join(d, "*.zip"))
    rows = sorted(r["units_sold"] for r in df.collect())
    assert rows == ["10", "12"]


def test_stock_file_layouts(spark):
    a = spark.createDataFrame([("P1", "C1", -3.0), ("P2", "C2", 7.0)], "product_id string, category string, current_stock double")
    out = {r["product_key"]: r["current_stock"] for r in files.stock_from_frame(a).collect()}
    assert out == {"P1_C1": 0.0, "P2_C2": 7.0}
    b = spark.createDataFrame([("Food", 4.0)], "product_line string, current_stock double")
    assert files.stock_from_frame(b).first()["product_key"] == "Food"
    with pytest.raises(ValueError):
        files.stock_from_frame(spark.createDataFrame([(1.0,)], "current_stock double"))


def test_scaler_fitted_on_train_only(spark):  # F21
    train = spark.createDataFrame([(float(i), 10.0 * i) for i in range(1, 6)], "feature1 double, feature2 double")
    test = spark.createDataFrame([(6.0, 60.0), (7.0, 70.0)], "feature1 double, feature2 double")
    st = {r["feature"]: r["mean"] for r in M.scaler_stats(train, ["feature1", "feature2"]).collect()}
    assert st == {"feature1": 3.0, "feature2": 30.0}
    prep = ML.fit_prep(train.withColumn("label", F.lit(0.0)), ["feature1", "feature2"], cat_cols=())
    tr = np.array([r[ML.FEATURES].toArray() for r in prep.transform(train).collect()])
    assert np.allclose(tr.mean(axis=0), 0.0)
    te = np.array([r[ML.FEATURES].toArray() for r in prep.transform(test).collect()])
    assert te[0][0] == pytest.approx((6 - 3) / np.std([1, 2, 3, 4, 5]))  # population std, train statistics


def _signal(spark, n=400, seed=7):
    rng = np.random.default_rng(seed)
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    y = 3.0 * x1 - 2.0 * x2 + 5.0 + rng.normal(scale=0.1, size=n) + 4.0 * (x1 > 0.5)
    rows = [(float(a), float(b), float(c)) for a, b, c in zip(x1, x2, y)]
    return spark.createDataFrame(rows, "x1 double, x2 double, label double"), x1, x2, y


def test_ridge_matches_closed_form(spark):
    df, x1, x2, y = _signal(spark)
    prep = ML.fit_prep(df, ["x1", "x2"], cat_cols=())
    p = prep.transform(df)
    model = ML.ridge(p, alpha=1.0).fit(p)
    X = np.column_stack([x1, x2])
    Xs = (X - X.mean(0)) / X.std(0)
    Xc, yc = Xs - Xs.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + 1.0 * np.eye(2), Xc.T @ yc)
    assert np.allclose(model.coefficients.toArray(), w, rtol=1e-6)


def test_trees_beat_mean_baseline_and_persist(spark):
    df, *_ = _signal(spark)
    tr, te = df.limit(300), df.subtract(df.limit(300))
    trained = ML.train_models(tr, ["x1", "x2"], ("random_forest", "gradient_boosting"), cat_cols=())
    mean = tr.agg(F.avg("label")).first()[0]
    base = M.accuracy(te.withColumn("prediction", F.lit(mean))).first()["rmse"]
    for name in ("random_forest", "gradient_boosting"):
        rmse = M.accuracy(ML.predict(trained, name, te)).first()["rmse"]
        assert rmse < base * 0.6
    imp = ML.feature_importance(trained, "random_forest", ["x1", "x2"], cat_cols=()).collect()
    assert imp[0]["feature"] == "x1"
    path = os.path.join(tempfile.mkdtemp(prefix="shelfwise-model-"), "rf")
    save_model(trained.pipeline("random_forest"), path)
    assert load_model(path).transform(te).count() == te.count()
    with pytest.raises(FileNotFoundError):
        load_model(path + "-missing")


def test_tuning_picks_best_setting(spark):
    import datetime as dt
    _, x1, x2, y = _signal(spark, 200)
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), float(a), float(b), float(c))
            for i, (a, b, c) in enumerate(zip(x1, x2, y))]
    df = spark.createDataFrame(rows, "date date, x1 double, x2 double, label double")
    trained, res = ML.tune(df, ["x1", "x2"], "random_forest", n_iter=2, n_splits=2, parallel=2, cat_cols=())
    best = min(res.collect(), key=lambda r: (r["mae"], r["setting"]))
    assert res.count() == 2 and json.loads(best["params"]) == trained.params["random_forest"]
    path = os.path.join(tempfile.mkdtemp(prefix="shelfwise-tuned-"), "rf")
    save_model(trained.pipeline("random_forest"), path)
    a, b = (m.collect() for m in (ML.predict(trained, "random_forest", df).select("prediction"),
                                  load_model(path).transform(df).select("prediction")))
    assert sorted(r[0] for r in a) == pytest.approx(sorted(r[0] for r in b))
    cfg = TrainingConfig(use_hyperparameter_tuning=True, tuning_n_iter=1, tuning_cv_splits=2)
    got = ML.train_models(df, ["x1", "x2"], ("linear_regression", "random_forest"), cfg, cat_cols=())
    assert set(got.params) == {"random_forest"}
    assert got.models["random_forest"].getNumTrees == got.params["random_forest"]["numTrees"]


def test_settings_are_sampled_without_repeats():
    grid = {"a": [1, 2, 3], "b": [True, False]}
    got = ML.sample_params(grid, 30)
    assert len(got) == 6 == len({tuple(sorted(p.items())) for p in got})


def test_one_hot_stays_sparse_and_wide_ridge_fits(spark):
    """More one-hot levels than the normal-equation solver takes; both solvers reach one minimum."""
    rows = [(f"p{i % 4500}", float(i % 7), float((i % 4500) % 10 + i % 7)) for i in range(9000)]
    df = spark.createDataFrame(rows, "product_id string, x double, label double")
    p = ML.fit_prep(df, ["x"], cat_cols=("product_id",)).transform(df)
    v = p.first()[ML.FEATURES]
    assert isinstance(v, SparseVector) and len(v) > 4500 and v.numNonzeros() <= 2
    model = ML.ridge(p).fit(p)
    assert model.transform(p).agg(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0] < 0.6


def test_ridge_solvers_agree(spark, monkeypatch):
    df, *_ = _signal(spark)
    p = ML.fit_prep(df, ["x1", "x2"], cat_cols=()).transform(df)
    normal = ML.ridge(p, 3.0).fit(p)
    monkeypatch.setattr(ML, "NORMAL_FEATURES", 1)
    other = ML.ridge(p, 3.0).fit(p)
    assert other.getSolver() == "l-bfgs"
    assert np.allclose(normal.coefficients.toArray(), other.coefficients.toArray(), rtol=1e-6)
    assert normal.intercept == pytest.approx(other.intercept, rel=1e-6)


def test_evaluate_predicts_once_and_recommends(spark):
    from shelfwise.plans.pipeline import evaluate
    df, *_ = _signal(spark, 120)
    tr, te = df.limit(100), df.subtract(df.limit(100))
    trained = ML.train_models(tr, ["x1", "x2"], ("linear_regression",), cat_cols=())
    out = evaluate(trained, "linear_regression", te, None)
    assert out["metrics"].first()["rmse"] < 2.0
    rec = out["recommendations"].first()
    assert rec["product_line"] == "All Products" and rec["recommended_order"] >= 0
    assert out["scored"].where(F.col("prediction") < 0).count() == 0


def test_csv_to_quality_report_and_panel(spark):
    from shelfwise.operators.panel import daily_panel
    from shelfwise.operators.quality import clean_sales, quality_report
    d = tempfile.mkdtemp(prefix="shelfwise-csv-")
    p = os.path.join(d, "sales.csv")
    with open(p, "w") as fh:
        fh.write(HEADER)
        fh.write("2022-01-01,S1,P1,Food,North,10,5.5,Sunny,Winter\n")
        fh.write("2022-01-01,S1,P1,Food,North,10,5.5,Sunny,Winter\n")      # duplicate
        fh.write("01/02/2022,S1,P1,Toys,North,-3,5.5,Rainy,Winter\n")      # US date, negative, other category
        fh.write("bad,S1,P1,Food,North,n/a,x,Sunny,Winter\n")               # bad date, bad numbers
        fh.write("2022-01-03,S1,,Food,North,4,5.5,Sunny,Winter\n")         # missing product
    raw = files.read_sales(spark, p)
    rep = {r["metric"]: r["value"] for r in quality_report(raw).collect()}
    assert rep["input_rows"] == 5 and rep["duplicates_removed"] == 1 and rep["bad_dates"] == 1
    assert rep["units_sold_converted"] == 1 and rep["price_converted"] == 1
    assert rep["missing_product_id"] == 1 and rep["inconsistent_products"] == 1
    assert rep["negative_units_fixed"] == 1
    panel = daily_panel(clean_sales(raw)).orderBy("date").collect()
    assert [(str(r["date"]), r["category"], r["quantity"]) for r in panel] == [
        ("2022-01-01", "Food", 10.0), ("2022-01-02", "Food", 0.0)]
