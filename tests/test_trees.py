"""Trees from histograms against hand-made sums, MLlib's trees, and each other however the work is cut."""

import os
import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from shelfwise.operators import models as ML
from shelfwise.operators import trees as T
from shelfwise.sources.sinks import load_model, save_model


def table(n=3000, seed=1):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"id": np.arange(n), "few": rng.integers(0, 9, n).astype(float), "x": rng.normal(size=n),
                        "c": rng.choice(list("abcd"), n), "d": rng.choice([f"k{i}" for i in range(40)], n)})
    pdf["label"] = 100 + 3.0 * (pdf.few > 4) + 2 * pdf.x + 4.0 * (pdf.c == "b") - 6.0 * (pdf.d == "k7") + rng.normal(size=n) * .2
    pdf.loc[::50, "c"] = None
    return pdf


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame(table()).repartition(3, "id")
    return ML.fit_prep(df, ["few", "x"], ["c", "d"]).transform(df).persist()


def predictions(model, rows):
    return model.transform(rows).orderBy("id").toPandas()["prediction"].to_numpy()


def one_tree(rows, depth, **kw):
    return ML.gradient_boosting(n_estimators=1, max_depth=depth, **kw).fit(rows)


def test_one_tree_is_mllibs(rows):
    """Columns with few values are binned alike by both; one-hot slots are split as equal or not."""
    plain = rows.select("id", "few", "c", "d", "label")
    some = ML.fit_prep(plain, ["few"], ["c", "d"]).transform(plain)
    mine = one_tree(some, 4)
    theirs = DecisionTreeRegressor(featuresCol=ML.FEATURES, maxDepth=4, maxBins=32).fit(some)
    assert np.allclose(predictions(mine, some), predictions(theirs, some), atol=1e-9)
    assert np.allclose(mine.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=1e-9)


def test_forest_and_boosting_are_as_good_as_mllibs(rows):
    for mine, theirs in (
            (ML.random_forest(n_estimators=15, max_depth=6), RandomForestRegressor(numTrees=15, maxDepth=6, featureSubsetStrategy="all", seed=42)),
            (ML.gradient_boosting(n_estimators=8, max_depth=4), GBTRegressor(maxIter=8, maxDepth=4, stepSize=0.1, seed=42))):
        y = rows.orderBy("id").toPandas()["label"].to_numpy()
        a, b = (np.sqrt(np.mean((predictions(e.fit(rows), rows) - y) ** 2)) for e in (mine, theirs))
        assert a < 1.05 * b


def test_boosting_follows_its_residuals(rows, monkeypatch):
    """Trees are fitted to 2 (y - F), whether the residuals were written into the blocks or not."""
    a = ML.gradient_boosting(n_estimators=7, max_depth=3).fit(rows)
    assert a.weights == [1.0] + [0.1] * 6
    monkeypatch.setattr(T, "REFRESH", 2)
    b = ML.gradient_boosting(n_estimators=7, max_depth=3).fit(rows)
    assert np.allclose(predictions(a, rows), predictions(b, rows), atol=1e-9)
    errors = a.evaluateEachIteration(rows, "absolute")
    y = rows.orderBy("id").toPandas()["label"].to_numpy()
    assert len(errors) == 7 and errors == sorted(errors, reverse=True)
    assert errors[-1] == pytest.approx(np.abs(predictions(a, rows) - y).mean(), rel=1e-9)


def test_the_cut_of_the_work_changes_nothing(rows, monkeypatch):
    """More passes a level, and sums added up by a shuffle instead of the driver: the same trees."""
    blocks, at = _packed(rows)
    grown = [T.grow(blocks, at, [0, 1, 2], 5, 1, "all", 42, T._weights(1.0, True))]
    monkeypatch.setattr(T, "AT_ONCE", 0)
    grown.append(T.grow(blocks, at, [0, 1, 2], 5, 1, "all", 42, T._weights(1.0, True)))
    monkeypatch.setattr(T, "CELLS", 4 * int(at.bases[-1]))
    grown.append(T.grow(blocks, at, [0, 1, 2], 5, 1, "all", 42, T._weights(1.0, True)))
    trees = [[sorted(_splits(g[t])) for t in range(3)] for g in grown]
    assert trees[0] == trees[1] == trees[2] and trees[0][0] != trees[0][1]


def _packed(rows):
    T.ship_package(rows.sparkSession)
    at = T.fit_bins(rows, 2, tuple(rows.first()[T.SIZES]))
    return T.pack(rows, at), at


def _splits(tree):
    return [(tree.depth[i], tree.column[i], tree.low[i], tree.high[i], round(tree.gain[i], 6)) for i in range(len(tree.value)) if tree.slot[i] >= 0]


def test_a_task_sends_sums_not_rows(rows):
    """What a level's tasks hand on is bounded by open nodes and bins, for ten times the rows as well."""
    _, at = _packed(rows)
    tree = T.Grown()
    tree.add(0.0, 0)
    todo = T.Pass(at, [(0, tree.arrays(), np.array([0]), np.array([0]))], None, 42, [])
    many = rows.crossJoin(rows.sparkSession.range(10).select(F.col("id").alias("copy")))
    for df in (rows, many):
        got = T.pack(df, at).coalesce(1).mapInArrow(T._level_sums(todo), "tree int, node long, sums binary").collect()
        assert len(got) == 1 and len(got[0]["sums"]) <= 8 + 16 * int(at.bases[-1])


def test_poisson_weights():
    w = T._weights(1.0, True).astype(float)
    assert w.mean() == pytest.approx(1.0, abs=1e-3) and w.var() == pytest.approx(1.0, abs=1e-2)
    assert T._weights(1.0, False) is None and T._weights(0.8, False).mean() == pytest.approx(0.8, abs=1e-3)


def test_slots_asked():
    assert [T.slots_asked(s, 100, 10) for s in ("all", "sqrt", "log2", "onethird", "auto", "0.5", 0.25, "3")] == [100, 10, 7, 34, 34, 50, 25, 3]


def test_forest_is_kept_and_read_back(rows):
    model = ML.random_forest(n_estimators=3, max_depth=3, featureSubsetStrategy="sqrt", minInstancesPerNode=5).fit(rows)
    path = os.path.join(tempfile.mkdtemp(prefix="shelfwise-trees-"), "forest")
    save_model(PipelineModel(stages=[model]), path)
    assert np.allclose(predictions(load_model(path), rows), predictions(model, rows))


def test_odd_rows(spark, rows):
    """NULL and unseen categories have no slot; copies of one row have no split; no rows raise."""
    model = one_tree(rows, 3)
    odd = ML.fit_prep(rows.select("few", "x", "c", "d", "label"), ["few", "x"], ["c", "d"]).transform(
        spark.createDataFrame([(1.0, None, None, "new", 0.0)], "few double, x double, c string, d string, label double"))
    assert odd.first()[T.INPUTS] == [1.0, 0.0, -1.0, -1.0] and model.transform(odd).first()["prediction"] is not None
    same = spark.createDataFrame([(1.0, 5.0)] * 4, "x double, label double")
    prep = ML.fit_prep(same, ["x"], ())
    assert {r["prediction"] for r in one_tree(prep.transform(same), 3).transform(prep.transform(same)).collect()} == {5.0}
    with pytest.raises(ValueError, match="training rows"):
        one_tree(prep.transform(same).limit(0), 3)
