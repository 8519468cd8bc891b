"""Staged scoring of tuning settings against fits of every setting on its own."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.config import TrainingConfig
from shelfwise.operators import models as ML
from shelfwise.operators import splits as S


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(3)
    x1, x2 = rng.normal(size=240), rng.normal(size=240)
    y = 3 * x1 - 2 * x2 + 4 * (x1 > 0.5) + rng.normal(scale=0.3, size=240)
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x1, x2, y))]
    return spark.createDataFrame(rows, "date date, x1 double, x2 double, label double").repartition(2).persist()


def fitted_alone(frame, kind, params):
    """Mean MAE over the folds of one setting, fitted as it is."""
    labelled, ranges = S.assign_folds(frame, "cv", 2)
    maes = []
    for i in range(len(ranges)):
        tr, va = S.fold_filter(labelled, i)
        prep = ML.fit_prep(tr, ["x1", "x2"], ())
        tr, va = prep.transform(tr), prep.transform(va)
        model = ML.make_estimator(kind, tr, TrainingConfig(random_state=42), params).fit(tr)
        maes.append(model.transform(va).agg(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0])
    return sum(maes) / len(maes)


def test_boosting_stages_are_the_smaller_fits(frame):
    grid = {"maxIter": [2, 4, 8], "maxDepth": [2], "stepSize": [0.3]}
    best, res = ML.search(frame, ["x1", "x2"], "gradient_boosting", n_iter=3, n_splits=2, cat_cols=(), grid=grid)
    got = {r["params"]: r["mae"] for r in res.collect()}
    alone = {s: fitted_alone(frame, "gradient_boosting", {"maxIter": s, "maxDepth": 2, "stepSize": 0.3}) for s in (2, 4, 8)}
    for text, mae in got.items():
        stage = next(s for s in alone if f'"maxIter": {s},' in text)
        assert mae == pytest.approx(alone[stage], rel=1e-9)
    assert best["maxIter"] == min(alone, key=alone.get)


def test_forest_chunks_choose_as_the_full_fits(frame):
    grid = {"numTrees": [4, 12], "maxDepth": [1, 6]}
    best, res = ML.search(frame, ["x1", "x2"], "random_forest", n_iter=4, n_splits=2, cat_cols=(), grid=grid)
    alone = {(t, d): fitted_alone(frame, "random_forest", {"numTrees": t, "maxDepth": d}) for t in (4, 12) for d in (1, 6)}
    assert res.count() == 4
    assert best["maxDepth"] == min(alone, key=alone.get)[1] == 6


def test_settings_share_fits(frame, monkeypatch):
    fits = []
    real = ML.make_estimator
    monkeypatch.setattr(ML, "make_estimator", lambda kind, *a, **k: fits.append(a[2]) or real(kind, *a, **k))
    grid = {"maxIter": [1, 2, 3], "maxDepth": [2]}
    ML.search(frame, ["x1", "x2"], "gradient_boosting", n_iter=3, n_splits=2, cat_cols=(), grid=grid)
    assert len(fits) == 2 and {f["maxIter"] for f in fits} == {3}  # a fit per fold
