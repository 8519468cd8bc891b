"""Mergeable sums: ridge, its folds and correlations against numpy and MLlib."""

import datetime as dt
import os
import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from shelfwise.operators import gram as G
from shelfwise.operators import metrics as M
from shelfwise.operators import models as ML
from shelfwise.operators import splits as S


def table(n=600, seed=3):
    rng = np.random.default_rng(seed)
    df = pd.DataFrame({
        "date": [dt.date(2021, 1, 1) + dt.timedelta(days=i) for i in range(n)],
        "x1": rng.normal(1e5, 2.0, n), "x2": rng.exponential(3.0, n), "x3": np.full(n, 7.0),
        "a": rng.choice(["red", "green", "blue"], n), "b": rng.choice([f"k{i}" for i in range(9)], n)})
    df.loc[rng.random(n) < 0.1, "a"] = None
    df["label"] = 2 * (df.x1 - 1e5) - df.x2 + (df.a == "red") * 4 + rng.normal(0, 0.3, n)
    return df


def design(df, cats=("a", "b"), values=None):
    """Inputs one by one, as a dense matrix."""
    cols = [df.x1, df.x2, df.x3]
    for c in cats:
        cols += [(df[c] == v).astype(float) for v in (values or df)[c].dropna().sort_values().unique()]
    return np.column_stack(cols)


def closed_form(x, y, alpha=1.0):
    mean, sd = x.mean(0), x.std(0)
    sd = np.where(sd < 1e-9, 0, sd)
    z = np.where(sd > 0, (x - mean) / np.where(sd > 0, sd, 1), 0.0)
    w = np.linalg.solve(z.T @ z + alpha * np.eye(z.shape[1]), z.T @ (y - y.mean()))
    beta = np.where(sd > 0, w / np.where(sd > 0, sd, 1), 0.0)
    return beta, w, y.mean() - beta @ mean


NUMERIC = ["x1", "x2", "x3"]


def test_ridge_is_the_closed_form(spark):
    pdf = table()
    df = spark.createDataFrame(pdf).repartition(7)
    model = G.fit_ridge(df, NUMERIC, ["a", "b"], alpha=1.5)
    beta, w, b = closed_form(design(pdf), pdf.label.to_numpy(), 1.5)
    got = {(r["feature"], r["value"]): r for r in model.table.collect()}
    names = [(c, None) for c in NUMERIC] + [(c, v) for c in "ab" for v in sorted(pdf[c].dropna().unique())]
    assert set(got) == set(names)
    assert np.allclose([got[k]["coefficient"] for k in names], beta, rtol=1e-6, atol=1e-9)
    assert np.allclose([got[k]["standardised"] for k in names], w, rtol=1e-6, atol=1e-9)
    assert got["x3", None]["coefficient"] == 0.0 and model.intercept == pytest.approx(b, rel=1e-6)
    told = model.transform(df.orderBy("date")).toPandas().sort_values("date")["prediction"]
    assert np.allclose(told, design(pdf) @ beta + b, atol=1e-6)


def test_ridge_scores_unseen_and_missing_values(spark):
    df = spark.createDataFrame(table())
    model = G.fit_ridge(df, NUMERIC, ["a"])
    odd = spark.createDataFrame([(1e5, 1.0, 7.0, "new"), (1e5, 1.0, 7.0, None), (None, float("nan"), 7.0, "red")],
                                "x1 double, x2 double, x3 double, a string")
    rows = model.transform(odd).collect()
    assert len(rows) == 3 and rows[0]["prediction"] == pytest.approx(rows[1]["prediction"])
    assert all(np.isfinite(r["prediction"]) for r in rows)


def test_ridge_agrees_with_mllib(spark):
    df = spark.createDataFrame(table())
    one = G.fit_ridge(df, ["x2"], ["a", "b"]).transform(df).toPandas().sort_values("date")["prediction"]
    prep = ML.fit_prep(df, ["x2"], ["a", "b"])
    rows = prep.transform(df)
    other = ML.ridge(rows).fit(rows).transform(rows).toPandas().sort_values("date")["prediction"]
    assert np.allclose(one, other, atol=1e-4)


def test_ridge_is_saved_as_a_pipeline(spark):
    df = spark.createDataFrame(table())
    trained = ML.train_models(df, NUMERIC, ("linear_regression",), cat_cols=["a", "b"])
    assert trained.prep is None
    path = os.path.join(tempfile.mkdtemp(prefix="shelfwise-gram-"), "ridge")
    trained.pipeline("linear_regression").write().overwrite().save(path)
    again = PipelineModel.load(path).transform(df).toPandas().sort_values("date")["prediction"]
    here = ML.predict(trained, "linear_regression", df).toPandas().sort_values("date")["prediction"]
    assert np.allclose(again, here, atol=0)
    top = ML.feature_importance(trained, "linear_regression", NUMERIC, ["a", "b"], top=2).collect()
    assert [r["feature"] for r in top] == ["x2", "x1"] or top[0]["importance"] >= top[1]["importance"]


@pytest.mark.parametrize("kind", ["cv", "walk_forward"])
def test_folds_from_prefix_sums(spark, kind, monkeypatch):
    pdf = table(300)
    df = spark.createDataFrame(pdf).repartition(4)
    got = sorted(map(tuple, ML.validate(df, NUMERIC, ("linear_regression",), kind, 3, cat_cols=["a", "b"]).collect()))
    ranges = S.cv_ranges(300, 3) if kind == "cv" else S.walk_forward_ranges(300, 3)
    y = pdf.label.to_numpy()
    x = design(pdf)
    for (_, fold, mae, rmse), rg in zip(got, ranges, strict=True):
        beta, _, b = closed_form(x[: rg["train_end"]], y[: rg["train_end"]])
        e = y[rg["val_start"]: rg["val_end"]] - (x[rg["val_start"]: rg["val_end"]] @ beta + b)
        assert fold == rg["fold"]
        assert (mae, rmse) == pytest.approx((np.abs(e).mean(), np.sqrt((e * e).mean())), rel=1e-6)
    monkeypatch.setattr(ML, "GRAM_INPUTS", 0)  # every fold fitted by MLlib
    wide = sorted(map(tuple, ML.validate(df, ["x2"], ("linear_regression",), kind, 3, cat_cols=["a"]).collect()))
    monkeypatch.undo()
    near = sorted(map(tuple, ML.validate(df, ["x2"], ("linear_regression",), kind, 3, cat_cols=["a"]).collect()))
    assert [r[:2] for r in wide] == [r[:2] for r in near]
    assert np.allclose([r[2:] for r in wide], [r[2:] for r in near], rtol=1e-3)


def test_sums_are_the_same_however_they_are_merged(spark, monkeypatch):
    df = spark.createDataFrame(table()).repartition(3)
    base, codes, at = G.prepare(df, NUMERIC, ["a", "b"])
    whole = {(r["i"], r["j"]): r["s"] for r in G.moments(base, at).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    monkeypatch.setattr(G, "FLUSH", 10)
    try:
        parts = {(r["i"], r["j"]): r["s"] for r in G.moments(base.repartition(5), at).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert parts.keys() == whole.keys()
    assert all(parts[k] == pytest.approx(whole[k], rel=1e-9, abs=1e-6) for k in whole)


def test_correlations_of_a_thousand_slots(spark):
    rng = np.random.default_rng(11)
    n = 3000
    pdf = pd.DataFrame({c: rng.integers(0, 333, n) for c in "abc"})
    pdf["two"] = rng.choice(["yes", "no"], n)  # never together: correlation -1
    pdf["same"] = np.where(pdf.two == "yes", "y", "n")
    pdf["num"] = np.where(pdf.two == "yes", 10.0, 0.0) + rng.normal(0, 1, n)
    pdf["flat"] = 3.0
    cats = ["a", "b", "c", "two", "same"]
    df = spark.createDataFrame(pdf).withColumns({c: F.col(c).cast("string") for c in cats})
    got = {(r["feature_a"], r["feature_b"]): (r["i"], r["j"], r["abs_corr"])
           for r in G.correlated_slots(df, ["num", "flat"], cats, 0.7).collect()}
    names, cols = ["num", "flat"], [pdf.num, pdf.flat]
    for c in cats:
        for v in sorted(pdf[c].astype(str).unique()):
            names.append(f"{c}_{v}")
            cols.append((pdf[c].astype(str) == v).astype(float))
    assert len(names) > 1000
    with np.errstate(invalid="ignore", divide="ignore"):
        m = np.abs(np.corrcoef(np.column_stack(cols).T))
    want = {(names[i], names[j]): (i, j, m[i, j]) for i, j in zip(*np.where(np.triu(m, 1) > 0.7))}
    assert got.keys() == want.keys() and ("two_no", "two_yes") in got
    assert all(got[k][:2] == want[k][:2] and got[k][2] == pytest.approx(want[k][2], abs=1e-9) for k in want)


def test_correlations_of_nothing(spark):
    empty = spark.createDataFrame([], "x double, y double, c string")
    assert G.correlated_slots(empty, ["x", "y"], ["c"]).collect() == []
    one = spark.createDataFrame([(1.0, 2.0, "a")], "x double, y double, c string")
    assert M.correlated_pairs(one, ["x", "y"]).collect() == []
    with pytest.raises(ValueError):
        G.correlated_slots(one, ["x"], ["c"], threshold=0.0)
