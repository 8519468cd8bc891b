"""MLlib models (M1-M5, M7, M8, M10) and time-ordered validation.

The preparation stages (sparse one-hot of the categoricals, assembler,
scaling) are fitted once on the training rows and shared by every
estimator; each trained model is saved as one ``PipelineModel``
(preparation + estimator). CrossValidator is not used: its folds are random,
ours are chronological.
"""

from __future__ import annotations

import json
import math
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import ElementwiseProduct, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.config import TrainingConfig
from shelfwise.operators import metrics as M
from shelfwise.operators import splits as S
from shelfwise.operators.baselines import BASELINES
from shelfwise.operators.ranking import CategoryCodes
from shelfwise.operators.gram import GRAM_INPUTS, GramRidge, fit_ridge, prepare, validate_ridge
from shelfwise.operators.trees import INPUTS, SIZES, TreeTrainer
from shelfwise.schema import CATEGORICAL

FEATURES = "features"
STEPS = ("numeric_raw", "numeric_scaled", "onehot_raw", "onehot_scaled", "joined", INPUTS, SIZES)  # beside FEATURES

#: The normal-equation solver's own limit on the number of features.
NORMAL_FEATURES = 4096


def fit_prep(train: DataFrame, numeric_cols: list[str], cat_cols=CATEGORICAL) -> PipelineModel:
    """M1: categoricals -> sparse one-hot (a distributed dictionary of train), numerics
    centred, everything divided by its population deviation on train.

    One-hot slots are scaled but not centred, so rows stay as sparse as their
    values are few; the intercept takes up what centring would have moved.
    MLlib's scaler uses the sample deviation; one factor makes it the population's.
    The trees read INPUTS, a row's numerics and codes, instead of the scaled slots.
    """
    cats, numeric = list(cat_cols), list(numeric_cols)
    codes = CategoryCodes.fitted(train, cats) if cats else None
    stages = [codes, codes.encoder()] if cats else []
    parts = []
    for cols, name, centre in ((numeric, "numeric", True), ([f"{c}_vec" for c in cats], "onehot", False)):
        if cols:
            stages += [VectorAssembler(inputCols=cols, outputCol=f"{name}_raw", handleInvalid="keep"),
                       StandardScaler(inputCol=f"{name}_raw", outputCol=f"{name}_scaled", withMean=centre, withStd=True)]
            parts.append(f"{name}_scaled")
    stages.append(VectorAssembler(inputCols=parts, outputCol="joined"))
    fitted = Pipeline(stages=stages).fit(train)
    n = train.count()
    width = sum(s.std.size for s in fitted.stages if hasattr(s, "std"))
    factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
    to_population = ElementwiseProduct(scalingVec=Vectors.dense([factor] * width), inputCol="joined", outputCol=FEATURES)
    return PipelineModel(stages=[*fitted.stages, to_population, _tree_inputs(numeric, codes)])


def _tree_inputs(numeric: list[str], codes: CategoryCodes | None) -> SQLTransformer:
    """INPUTS: numerics (missing: 0), then codes (-1: NULL or not among the training rows')."""
    number = "coalesce(if(isnan(`{0}`) or abs(`{0}`) = double('inf'), null, cast(`{0}` as double)), 0D)"
    parts = [number.format(c) for c in numeric]
    if codes:
        parts += [f"if({c}_idx < {n}, {c}_idx, -1D)" for c, n in zip(codes.cols, codes.sizes, strict=True)]
    sizes = ", ".join(str(n) for n in codes.sizes) if codes else ""
    return SQLTransformer(statement=f"SELECT *, array({', '.join(parts)}) AS {INPUTS}, "
                                    f"cast(array({sizes}) as array<int>) AS {SIZES} FROM __THIS__")


def prepared_rows(prep: PipelineModel, df: DataFrame, names) -> DataFrame:
    """What the named estimators read of the prepared rows, persisted."""
    cols = [INPUTS, SIZES] if all(family(n) in GRIDS for n in names) else [INPUTS, SIZES, FEATURES]
    return prep.transform(df).select(*cols, "label").persist(StorageLevel.MEMORY_AND_DISK)


def ridge(train: DataFrame, alpha: float = 1.0, use_ridge: bool = True) -> LinearRegression:
    """M2: L2 least squares with an unpenalised intercept, ``||y - Xw||^2 + alpha ||w||^2``.

    Up to NORMAL_FEATURES inputs one pass builds the Gram matrix; wider ones,
    which that solver refuses, are minimised by l-bfgs on the sparse rows. Both
    reach the same (unique) minimum. MLlib divides the label by its deviation
    (the population's in the first solver, the sample's in the second), so
    regParam = alpha * deviation / n.
    """
    width = len(train.select(FEATURES).first()[0])
    wide = width > NORMAL_FEATURES
    how = {"solver": "l-bfgs", "tol": 1e-10, "maxIter": 500} if wide else {"solver": "normal"}
    if not use_ridge:
        return LinearRegression(featuresCol=FEATURES, labelCol="label", regParam=0.0, **how)
    sd = F.stddev_samp("label") if wide else F.stddev_pop("label")
    st = train.agg(F.count(F.lit(1)).alias("n"), sd.alias("sd")).first()
    n, sd = int(st["n"]), float(st["sd"] or 0.0)
    reg = alpha * sd / n if n and sd > 0 else 0.0
    return LinearRegression(featuresCol=FEATURES, labelCol="label", regParam=reg, elasticNetParam=0.0,
                            standardization=False, **how)


def random_forest(n_estimators: int = 100, max_depth: int = 10, seed: int = 42, **kw) -> TreeTrainer:
    """M3: every feature considered at each split, as the reference's regressor."""
    params = dict(numTrees=n_estimators, maxDepth=max_depth, featureSubsetStrategy="all", seed=seed)
    return TreeTrainer("random_forest", **(params | kw))


def gradient_boosting(n_estimators: int = 100, learning_rate: float = 0.1, max_depth: int = 5,
                      seed: int = 42, **kw) -> TreeTrainer:
    """M4: squared-error boosting (binned splits: close to, not equal to, exact trees)."""
    params = dict(maxIter=n_estimators, stepSize=learning_rate, maxDepth=max_depth, seed=seed)
    return TreeTrainer("gradient_boosting", **(params | kw))


def family(name: str) -> str:
    """"random_forest_revenue" -> "random_forest"."""
    return name.removesuffix("_revenue")


def make_estimator(name: str, train: DataFrame, cfg: TrainingConfig = TrainingConfig(), params: dict | None = None):
    kind = family(name)
    if kind == "linear_regression":
        return ridge(train)
    if kind == "random_forest":
        return random_forest(seed=cfg.random_state, **(params or {}))
    if kind == "gradient_boosting":
        return gradient_boosting(seed=cfg.random_state, **(params or {}))
    raise ValueError(f"unknown model {name}")


@dataclass
class Trained:
    prep: PipelineModel | None  # None where only ridge models were fitted: these read the inputs themselves
    models: dict  # name -> fitted estimator model
    params: dict = field(default_factory=dict)  # name -> settings chosen by tuning

    def pipeline(self, name: str) -> PipelineModel:
        """One persistable PipelineModel per model (prep + estimator; a ridge alone)."""
        model = self.models[name]
        return PipelineModel(stages=([] if isinstance(model, GramRidge) else list(self.prep.stages)) + [model])


def linear_model(train: DataFrame, numeric_cols: list[str], cat_cols=CATEGORICAL, alpha: float = 1.0) -> GramRidge | None:
    """M2 solved from one pass of sums, for up to GRAM_INPUTS inputs; None beyond (``ridge`` on prepared rows)."""
    at = prepare(train, numeric_cols, cat_cols)
    return fit_ridge(train, numeric_cols, cat_cols, alpha, prepared=at) if at[2].width <= GRAM_INPUTS else None


def train_models(train: DataFrame, numeric_cols: list[str], names=("linear_regression", "random_forest",
                 "gradient_boosting"), cfg: TrainingConfig = TrainingConfig(), cat_cols=CATEGORICAL,
                 parallel: int = 1) -> Trained:
    """M7 / M8: fit the preparation once, then each estimator on the cached
    prepared frame (optionally several fits in parallel jobs). With
    ``cfg.use_hyperparameter_tuning`` the tree models take the settings that
    ``search`` finds on the training rows."""
    found = {}
    if cfg.use_hyperparameter_tuning:
        for name in names:
            if family(name) in GRIDS:
                found[name] = search(train, numeric_cols, family(name), cfg.tuning_n_iter, cfg.tuning_cv_splits,
                                     cfg.random_state, cat_cols=cat_cols)[0]
    linear = {n: linear_model(train, numeric_cols, cat_cols) for n in names if family(n) == "linear_regression"}
    models = {n: m for n, m in linear.items() if m is not None}
    rest = [n for n in names if n not in models]
    if not rest:
        return Trained(None, models, found)
    prep = fit_prep(train, numeric_cols, cat_cols)
    prepared = prepared_rows(prep, train, rest)

    def fit(name):
        return name, make_estimator(name, prepared, cfg, found.get(name)).fit(prepared)

    if parallel > 1:
        with ThreadPoolExecutor(parallel) as pool:
            models.update(pool.map(fit, rest))
    else:
        models.update(fit(n) for n in rest)
    prepared.unpersist()
    return Trained(prep, models, found)


def predict(trained: Trained, name: str, df: DataFrame, keep=None) -> DataFrame:
    """Score once; every input column is kept (no positional alignment needed)."""
    model = trained.models[name]
    if isinstance(model, GramRidge):
        return model.transform(df)
    out = model.transform(trained.prep.transform(df))
    drop = [c for c in out.columns if c.endswith("_idx") or c.endswith("_vec") or c in (*STEPS, FEATURES)]
    return out.drop(*drop)


def feature_names(trained: Trained, numeric_cols: list[str], cat_cols=CATEGORICAL) -> list[str]:
    """Names of the assembled vector slots (numeric, then one-hot levels)."""
    return list(numeric_cols) + (trained.prep.stages[0].slot_names() if cat_cols else [])


def feature_importance(trained: Trained, name: str, numeric_cols: list[str], cat_cols=CATEGORICAL,
                       top: int | None = 10) -> DataFrame:
    """Tree importances, or absolute coefficients for linear models."""
    model = trained.models[name]
    if isinstance(model, GramRidge):
        df = model.importance().select(F.lit(name).alias("model"), "feature", "importance")
        return df if top is None else df.orderBy(F.desc("importance"), "feature").limit(top)
    vals = (model.featureImportances.toArray() if hasattr(model, "featureImportances")
            else [abs(x) for x in model.coefficients.toArray()])
    names = feature_names(trained, numeric_cols, cat_cols)
    df = SparkSession.getActiveSession().createDataFrame([(name, n, float(v)) for n, v in zip(names, vals)],
                            "model string, feature string, importance double")
    if top is not None:
        df = df.orderBy(F.desc("importance"), "feature").limit(top)
    return df


# ------------------------------------------------------------------ validation


def _fold_metrics(model_name, i, scored):
    row = scored.agg(M.mae().alias("mae"), M.rmse().alias("rmse")).first()
    return (model_name, i, float(row["mae"]), float(row["rmse"]))


def validate(frame: DataFrame, numeric_cols: list[str], names=("linear_regression",), kind: str = "cv",
             n_splits: int = 5, test_size: float = 0.2, cfg: TrainingConfig = TrainingConfig(),
             cat_cols=CATEGORICAL) -> DataFrame:
    """T2 (``kind="cv"``, expanding folds) / T3 (``"walk_forward"``).

    Rows are labelled with their fold once (pure predicate, no sort); each fold
    refits the preparation (scaler per fold) and the estimator on ``fold <= i``
    and scores ``fold == i + 1`` with unclipped predictions. Ridge folds are
    solved from one pass of mergeable sums and scored in a second one (up to
    GRAM_INPUTS inputs). Names of baselines are validated alike, without a preparation.
    Returns (model, fold, mae, rmse).
    """
    labelled, ranges = S.assign_folds(frame, kind, n_splits, test_size)
    labelled = labelled.persist(StorageLevel.MEMORY_AND_DISK)
    fitted = [n for n in names if n not in BASELINES]
    rows = []
    if any(family(n) == "linear_regression" for n in fitted):
        at = prepare(labelled, numeric_cols, cat_cols)
        if at[2].width <= GRAM_INPUTS:
            errors = validate_ridge(len(ranges), at).collect()
            for n in [n for n in fitted if family(n) == "linear_regression"]:
                rows += [(n, r["fold"], r["mae"], r["rmse"]) for r in errors]
                fitted.remove(n)
    for i in range(len(ranges)):
        tr, va = S.fold_filter(labelled, i)
        for name in names:
            if name in BASELINES:
                rows.append(_fold_metrics(name, i, BASELINES[name](tr, va, "label")))
        if not fitted:
            continue
        prep = fit_prep(tr, numeric_cols, cat_cols)
        ptr = prepared_rows(prep, tr, fitted)
        pva = prep.transform(va).select(INPUTS, FEATURES, "label")
        for name in fitted:
            model = make_estimator(name, ptr, cfg).fit(ptr)
            rows.append(_fold_metrics(name, i, model.transform(pva)))
        ptr.unpersist()
    labelled.unpersist()
    return frame.sparkSession.createDataFrame(rows, "model string, fold int, mae double, rmse double")


# ------------------------------------------------------------------ tuning (M5)

# Search spaces of the reference (None depth -> deepest MLlib tree).
FOREST_GRID = {"numTrees": [100, 200, 300, 500], "maxDepth": [10, 15, 20, 25, 30],
               "minInstancesPerNode": [1, 2, 4],
               "featureSubsetStrategy": ["sqrt", "log2", "0.5", "0.7"]}
BOOSTING_GRID = {"maxIter": [100, 200, 300, 500], "stepSize": [0.01, 0.05, 0.1, 0.15, 0.2],
                 "maxDepth": [3, 5, 7, 9], "minInstancesPerNode": [1, 2, 4],
                 "subsamplingRate": [0.8, 0.9, 1.0]}


GRIDS = {"random_forest": FOREST_GRID, "gradient_boosting": BOOSTING_GRID}


def sample_params(grid: dict, n_iter: int, seed: int = 42) -> list[dict]:
    """``n_iter`` different settings of the grid (all of them if it has fewer)."""
    keys = sorted(grid)
    total = math.prod(len(grid[k]) for k in keys)
    out = []
    for code in random.Random(seed).sample(range(total), min(n_iter, total)):
        setting = {}
        for k in keys:
            code, at = divmod(code, len(grid[k]))
            setting[k] = grid[k][at]
        out.append(setting)
    return out


#: The setting that counts trees: a larger fit holds the smaller ones.
STAGES = {"random_forest": "numTrees", "gradient_boosting": "maxIter"}


def staged_mae(kind: str, base: dict, stages: list[int], train: DataFrame, held: DataFrame, seed: int) -> dict[int, float]:
    """MAE on ``held`` at several numbers of trees, from one fit of the largest.

    Boosting: trees are added one by one, so the error after each is read off one model. Forests: trees are
    independent, so the largest is fitted in chunks whose means are averaged.
    """
    if kind == "gradient_boosting":
        model = make_estimator(kind, train, TrainingConfig(random_state=seed), base | {"maxIter": max(stages)}).fit(train)
        errors = model.evaluateEachIteration(held, "absolute")
        return {s: float(errors[s - 1]) for s in stages}
    step = math.gcd(*stages)
    scored, told, out = held, F.lit(0.0), []
    for c in range(max(stages) // step):
        model = make_estimator(kind, train, TrainingConfig(random_state=seed + c), base | {"numTrees": step}).fit(train)
        scored = model.transform(scored).withColumnRenamed("prediction", f"_p{c}")
        told = told + F.col(f"_p{c}")
        out.append(F.avg(F.abs(F.col("label") - told / (c + 1))).alias(str(step * (c + 1))))
    row = scored.agg(*out).first()
    return {s: float(row[str(s)]) for s in stages}


def search(frame: DataFrame, numeric_cols: list[str], kind: str = "random_forest", n_iter: int = 30,
           n_splits: int = 3, seed: int = 42, parallel: int = 4, cat_cols=CATEGORICAL, grid: dict | None = None):
    """M5: sampled settings scored by mean MAE over chronological folds. Folds
    are prepared and cached once; settings that differ in the number of trees only
    are scored by one fit (``staged_mae``), the others by parallel Spark jobs from a
    thread pool.

    Returns (best params, results DataFrame(setting, params, mae)).
    """
    settings = sample_params(GRIDS[kind] if grid is None else grid, n_iter, seed)
    groups: dict[str, list[int]] = {}
    for k, p in enumerate(settings):
        groups.setdefault(json.dumps({a: v for a, v in p.items() if a != STAGES[kind]}, sort_keys=True), []).append(k)
    labelled, ranges = S.assign_folds(frame, "cv", n_splits)
    labelled = labelled.persist(StorageLevel.MEMORY_AND_DISK)
    folds = []
    for i in range(len(ranges)):
        tr, va = S.fold_filter(labelled, i)
        prep = fit_prep(tr, numeric_cols, cat_cols)
        folds.append((prepared_rows(prep, tr, [kind]), prepared_rows(prep, va, [kind])))

    def score(item):
        base, members = json.loads(item[0]), item[1]
        stages = sorted({settings[k][STAGES[kind]] for k in members})
        errors = [staged_mae(kind, base, stages, tr, va, seed) for tr, va in folds]
        return [(k, settings[k], sum(e[settings[k][STAGES[kind]]] for e in errors) / len(errors)) for k in members]

    with ThreadPoolExecutor(parallel) as pool:
        results = sorted((r for part in pool.map(score, groups.items()) for r in part), key=lambda r: r[0])
    for tr, va in folds:
        tr.unpersist(), va.unpersist()
    labelled.unpersist()
    best = min(results, key=lambda r: (r[2], r[0]))
    res = frame.sparkSession.createDataFrame([(k, json.dumps(p, sort_keys=True), m) for k, p, m in results],
                                             "setting int, params string, mae double")
    return best[1], res


def tune(frame: DataFrame, numeric_cols: list[str], kind: str = "random_forest", n_iter: int = 30,
         n_splits: int = 3, seed: int = 42, parallel: int = 4, cat_cols=CATEGORICAL):
    """M5 with refit: ``search``, then the best setting fitted on all rows.

    Returns (Trained with the model and its settings under ``kind``, results).
    """
    best, res = search(frame, numeric_cols, kind, n_iter, n_splits, seed, parallel, cat_cols)
    prep = fit_prep(frame, numeric_cols, cat_cols)
    prepared = prepared_rows(prep, frame, [kind])
    model = make_estimator(kind, prepared, TrainingConfig(random_state=seed), best).fit(prepared)
    prepared.unpersist()
    return Trained(prep, {kind: model}, {kind: best}), res
