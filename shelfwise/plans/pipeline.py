"""Composite plans (L1-L4): lazy transform chains with explicit reuse points.

Reuse points are persisted (MEMORY_AND_DISK) so the bounded driver round trips
of the split do not recompute the chain; ``checkpoint=True`` additionally cuts
lineage into the session's shared checkpoint folder for long runs.
"""

from __future__ import annotations

from dataclasses import asdict
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.config import ProjectConfig
from shelfwise.operators import baselines as B
from shelfwise.operators import charts as C
from shelfwise.operators import features as FE
from shelfwise.operators import metrics as M
from shelfwise.operators import recommend as R
from shelfwise.operators import splits as S
from shelfwise.operators import stock as ST
from shelfwise.operators.panel import daily_panel, filter_history, history_keys
from shelfwise.operators.quality import guard_dates, guard_not_empty, tidy_sales, typed_sales
from shelfwise.schema import DATE, QUANTITY
from shelfwise.session import cut_lineage
from shelfwise.sources.parts import in_part, parts_for, written
from shelfwise.sources.sinks import save_model, write_params, write_report
from shelfwise.sources.store import RunStore


def clean_panel(raw: DataFrame, min_days: int | None = None, *, count: str = "rows", columns=None,
                stored: bool = False) -> DataFrame:
    """Raw rows -> cleaning chain -> daily panel (-> history filter)."""
    rows = raw.count()
    return panel_of(typed_rows(raw, rows, stored), min_days, rows, count, columns)


def typed_rows(raw: DataFrame, rows: int, stored: bool = False) -> DataFrame:
    """``typed_sales``; rows for several parts are written once, as each part reads them, unless ``raw`` is a
    projection of a table that is ``stored``."""
    typed = typed_sales(raw)
    return typed if stored or parts_for(rows) == 1 else written(raw.sparkSession, "typed-sales", 1, lambda _: typed)


def panel_of(typed: DataFrame, min_days: int | None = None, rows: int | None = None, count: str = "rows",
             columns=None) -> DataFrame:
    """Rows of ``typed_sales`` -> daily panel (-> history filter), of which ``columns`` are kept (default: all).

    Large inputs (``rows``, counted if not given) are worked off in parts (``sources.parts``): equal rows, the
    rows of a panel row and the history of a product are always in one part.
    """
    n = parts_for(typed.count() if rows is None else rows)
    keys = [c for c in (DATE, "product_id") if c in typed.columns]
    if min_days is not None:
        keys = history_keys(typed) or keys

    def part(k: int) -> DataFrame:
        panel = daily_panel(tidy_sales(typed.where(in_part(k, n, *keys)) if n > 1 else typed))
        if min_days is not None:
            panel = filter_history(panel, min_days, count)
        return panel if columns is None else panel.select(*columns)
    return part(0) if n == 1 else written(typed.sparkSession, "panel", n, part)


def reuse(df: DataFrame, checkpoint: bool = False) -> DataFrame:
    return cut_lineage(df) if checkpoint else df.persist(StorageLevel.MEMORY_AND_DISK)


def split_frame(df: DataFrame, test_size: float = 0.2, boundary: str = "rows"):
    """(train, test) of a frame in chronological order."""
    return S.train_test(S.chrono_split(df, test_size, boundary))


def score_baseline(train: DataFrame, test: DataFrame, name: str = "baseline_seasonal_naive",
                   target: str = QUANTITY) -> DataFrame:
    scored = B.BASELINES[name](train, test, target)
    return scored.withColumn("label", F.col(target).cast("double"))


def score_all_baselines(train: DataFrame, test: DataFrame, target: str = QUANTITY) -> DataFrame:
    """Long (model, model_order, keys..., label, prediction) frame of every baseline."""
    parts = []
    for i, name in enumerate(B.BASELINES):
        s = score_baseline(train, test, name, target)
        parts.append(s.withColumns({"model": F.lit(name), "model_order": F.lit(i)}))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def flagship(raw: DataFrame, stock: DataFrame | None = None,
             cfg: ProjectConfig = ProjectConfig()) -> DataFrame:
    """"What should we order, how urgently?" without MLlib:
    clean -> panel -> chronological split -> weekday baseline -> stock -> orders."""
    pp = cfg.preprocessing
    panel = reuse(clean_panel(raw))
    train, test = split_frame(panel, pp.test_size)
    scored = score_baseline(train, test, "baseline_seasonal_naive")
    if stock is None:
        stock = ST.estimate_stock(panel, pp.days_of_coverage, pp.coverage_method)
    rec = R.recommend_orders(scored, stock, cfg.recommendation)
    return R.sort_recommendations(rec)


def preprocess(raw: DataFrame, cfg: ProjectConfig = ProjectConfig(), *, stock_file: DataFrame | None = None,
               mode: str = "rows", include_current: bool = True, one_hot_form: str = "vector",
               checkpoint: bool = False, hold=None):
    """L2: clean -> panel -> history filter -> features -> stock -> split.

    The default keeps categoricals as text for the sparse MLlib encoding
    (vocabulary fitted on training rows); ``one_hot_form="wide"`` reproduces
    the reference's wide columns for bounded vocabularies.
    ``hold(name, build)`` keeps a reuse point (default: ``reuse`` of what is built); where it already has
    one, nothing of ``raw`` is read for it.
    Returns (labelled features with ``is_train``, stock table)."""
    pp = cfg.preprocessing
    hold = hold or (lambda name, build: reuse(build(), checkpoint))
    seen: list[DataFrame] = []

    def typed() -> DataFrame:
        if not seen:
            seen.append(typed_rows(raw, raw.count()))
        return seen[0]

    panel = hold("panel", lambda: panel_of(typed(), pp.min_history_days))
    if panel.isEmpty():
        guard_dates(typed())
        guard_not_empty(panel, f"the panel of products with {pp.min_history_days} days of history or more")

    def features() -> DataFrame:
        feats = FE.build_features(panel, pp.lags, pp.moving_average_windows, mode=mode,
                                  include_current=include_current, one_hot_form=one_hot_form)
        return ST.with_stock(ST.with_product_key(feats), stock)

    stock = hold("stock", lambda: ST.resolve_stock(panel, typed(), stock_file, days_of_coverage=pp.days_of_coverage,
                                                   method=pp.coverage_method))
    labelled = S.chrono_split(hold("features", features), pp.test_size)
    return labelled, stock


def baseline_report(labelled: DataFrame, cfg: ProjectConfig = ProjectConfig()) -> DataFrame:
    train, test = S.train_test(labelled)
    return M.compare_models(score_all_baselines(train, test), cfg.costs)


# ---------------------------------------------------------------- L3 / L4

SCORED_COLS = ["date", "store_id", "product_id", "category", "region", "weather_condition",
               "seasonality", "label", "prediction"]


def evaluate(trained, name: str, test: DataFrame, stock: DataFrame | None,
             cfg: ProjectConfig = ProjectConfig()) -> dict[str, DataFrame]:
    """L3: predict once -> NaN guard -> clip -> metrics and recommendations."""
    from shelfwise.operators import models as ML
    from shelfwise.operators.quality import guard_no_nan
    scored = ML.predict(trained, name, test)
    guard_no_nan(scored)
    scored = M.clip_predictions(scored)
    return {"scored": scored, "metrics": M.accuracy(scored),
            "recommendations": R.recommend_orders(scored, stock, cfg.recommendation, validate=False)}


def run(raw: DataFrame, cfg: ProjectConfig = ProjectConfig(), *, stock_file: DataFrame | None = None,
        models=("linear_regression", "random_forest", "gradient_boosting"), cv_models=(),
        one_hot_form: str = "vector", out_dir: str | None = None,
        checkpoint: bool = False, resume: bool = False, sources=None) -> dict[str, DataFrame]:
    """L4: demand then revenue, end to end.

    preprocess -> train baselines + MLlib models -> compare (MAE, RMSE, cost)
    -> best model by RMSE (baselines included) -> recommendations, final
    report, summaries and breakdowns; then the revenue models and reports.
    Every prediction set is scored once and persisted; the reports and chart
    tables are aggregates over it. ``cfg.training.use_hyperparameter_tuning``
    searches the tree models' settings. With ``out_dir`` each report is written
    as CSV, the models under ``models/`` (as soon as they are trained) and tuned
    settings under ``params/``, what was persisted is given back, and the returned
    frames read the reports. With ``resume`` as well, the reuse points are tables
    under ``stages/`` named by a hash of the input files (those of the frames ``sources``,
    where ``raw`` itself is read from a table made anew) and the settings: a run
    repeated after a failure reads the stages that were whole and trains only the
    models whose predictions are not among them.
    """
    from shelfwise.operators import models as ML
    from shelfwise.schema import CATEGORICAL
    held: list[DataFrame] = []
    store = None
    if resume:
        if not out_dir:
            raise ValueError("resume needs an out_dir to keep its stages in")
        inputs = [*(sources or [raw]), *([] if stock_file is None else [stock_file])]
        store = RunStore(raw.sparkSession, out_dir, inputs, {
            "config": asdict(cfg), "models": models, "one_hot_form": one_hot_form, "cv_models": cv_models})

    def hold(name: str, build) -> DataFrame:
        if store:
            return store.table(name, build)
        held.append(reuse(build(), checkpoint))
        return held[-1]

    def keep(trained, names, target: str) -> None:
        if not out_dir:
            return
        for name in names:
            save_model(trained.pipeline(name), f"{out_dir}/models/{name}")
        if params := {name: trained.params[name] for name in names if name in trained.params}:
            write_params(raw.sparkSession, params, f"{out_dir}/params/{target}")
    labelled, stock = preprocess(raw, cfg, stock_file=stock_file, one_hot_form=one_hot_form, hold=hold)
    # wide columns are already numeric inputs; otherwise the models encode the text
    cats = CATEGORICAL if one_hot_form == "vector" else ()
    frame, cols = FE.feature_frame(labelled, QUANTITY)
    train, test = S.train_test(frame)

    def scored() -> DataFrame:
        parts = [score_all_baselines(train, test).select("model", "model_order", *SCORED_COLS)]
        if models:
            trained = ML.train_models(train, cols, models, cfg.training, cat_cols=cats)
            keep(trained, models, QUANTITY)
        for i, name in enumerate(models):
            parts.append(ML.predict(trained, name, test).select(
                F.lit(name).alias("model"), F.lit(10 + i).alias("model_order"), *SCORED_COLS))
        return M.clip_predictions(reduce(DataFrame.unionByName, parts))

    long = hold("scored", scored)
    cmp = hold("comparison", lambda: M.compare_models(long, cfg.costs))
    best_name = M.best_model(cmp).first()["model"]
    best = long.where(F.col("model") == best_name)
    rec = hold("orders", lambda: R.recommend_orders(best, stock, cfg.recommendation))
    out = {
        "model_comparison": cmp,
        "recommendations": R.sort_recommendations(rec),
        "final_report": R.final_report(R.sort_recommendations(rec)),
        "urgency_summary": R.urgency_summary(rec),
        "executive_summary": R.executive_summary(rec, M.best_model(cmp), cmp),
        "per_product": M.performance_tier(M.per_product(best)),
        "temporal_errors": M.temporal_errors(best),
        "dimension_impact": M.dimension_impact(best),
        "leaderboard": M.leaderboard(cmp),
        "diagnostics": M.diagnostics(best),
        "interpretation": M.interpretation(train, cols, cats=cats),
        "sales_trend": C.sales_trend(train),
        "prediction_series": C.prediction_series(best),
        "prediction_range": C.prediction_range(best),
        "residual_qq": C.residual_qq(best),
        "residual_bins": C.residual_bins(best),
        "order_chart": C.order_chart(rec),
    }
    if cv_models:
        folds = hold("folds", lambda: ML.validate(frame.drop("is_train"), cols, cv_models, "cv",
                                                  cfg.training.n_splits, cat_cols=cats))
        out["cv_folds"] = folds
        out["cv_summary"] = M.cv_summary(folds)
    if cfg.forecast_revenue:
        rframe, rcols = FE.feature_frame(labelled, "revenue")
        rtrain, rtest = S.train_test(rframe)
        rnames = tuple(f"{m}_revenue" for m in models)

        def revenue() -> DataFrame:
            parts = []
            if rnames:
                rtrained = ML.train_models(rtrain, rcols, rnames, cfg.training, cat_cols=cats)
                keep(rtrained, rnames, "revenue")
                for name in rnames:
                    parts.append(ML.predict(rtrained, name, rtest).select(
                        F.lit(name).alias("model"), *SCORED_COLS))
            else:
                parts.append(score_baseline(rtrain, rtest, "baseline_seasonal_naive", "revenue").select(
                    F.lit("baseline_seasonal_naive").alias("model"), *SCORED_COLS))
            return M.clip_predictions(reduce(DataFrame.unionByName, parts))

        rlong = hold("revenue_scored", revenue)
        rcmp = M.compare_models(rlong, None)
        rbest = M.best_model(rcmp).first()["model"]
        rsel = rlong.where(F.col("model") == rbest)
        out.update({"revenue_comparison": rcmp, "revenue_metrics": M.revenue_metrics(rsel),
                    "revenue_report": M.revenue_report(rsel), "revenue_impact": M.dimension_impact(rsel),
                    "revenue_series": C.revenue_series(rsel)})
    if out_dir:
        spark = raw.sparkSession
        for name, df in out.items():
            write_report(df, f"{out_dir}/{name}")
            out[name] = spark.read.schema(df.schema).option("header", True).csv(f"{out_dir}/{name}")
        for df in held:
            df.unpersist()
    return out
