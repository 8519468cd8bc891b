"""Named queries over the driver's tables (one per operator of the inventory).

Each query takes (spark, sf_dir), reads the whole binding and returns a
DataFrame whose doubles pass through ``stable_round`` so the DuckDB oracle
(``plans/oracle.py``) hashes to the same values. Jobs that run while a plan is
built: the size-checked small tables (modal categories, baseline lookups) and
the search for split boundaries.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.config import CostConfig, ProjectConfig, RecommendationConfig
from shelfwise.functions.numeric import stable_round
from shelfwise.operators import charts as C
from shelfwise.operators import features as FE
from shelfwise.operators import metrics as M
from shelfwise.operators import quality as Q
from shelfwise.operators import recommend as R
from shelfwise.operators import splits as S
from shelfwise.operators import stock as ST
from shelfwise.operators.panel import daily_panel
from shelfwise.plans import pipeline as P
from shelfwise.schema import CALENDAR, DATE, DIMS, NUMERIC_FEATURES, QUANTITY, REVENUE
from shelfwise.session import ensure_checkpoint_dir
from shelfwise.sources import tpch
from shelfwise.sources.files import stock_from_frame

CFG = ProjectConfig()
KEYS = list(DIMS)


def finish(df: DataFrame, digits: int = 4, overrides: dict[str, int] | None = None) -> DataFrame:
    """Round every double column (tie-free) for cross-engine comparison."""
    overrides = overrides or {}
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(stable_round(F.col(f"`{f.name}`"), overrides.get(f.name, digits)).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


# ------------------------------------------------------------------ building blocks


_CACHE: dict = {}


def _once(name, build, spark, sf):
    """Built once per application, table folder and name."""
    key = (name, sf, spark.sparkContext.applicationId)
    if key not in _CACHE:
        _CACHE[key] = build()
    return _CACHE[key]


def lines(spark, sf):
    return _once("lines", lambda: tpch.sales_lines(spark, sf), spark, sf)


def raw(spark, sf, product="brand"):
    return tpch.retail_raw(spark, sf, product, lines(spark, sf))


def dirty(spark, sf):
    return tpch.retail_raw_dirty(spark, sf, lines(spark, sf))


def panel(spark, sf):
    return _once("panel", lambda: P.clean_panel(raw(spark, sf), stored=True), spark, sf)


def kept_history(spark, sf, count="rows"):
    """Quantities of the products that have the required history, the part key being the product."""
    return P.clean_panel(raw(spark, sf, "part"), CFG.preprocessing.min_history_days, count=count,
                         columns=[*KEYS, QUANTITY], stored=True)


def stock_tbl(spark, sf):
    return stock_from_frame(tpch.stock_file(spark, sf))


def split_panel(spark, sf):
    """Panel labelled with ``is_train`` (the panel is persisted: the split makes
    bounded driver round trips over it)."""
    key = ("split", sf, spark.sparkContext.applicationId)
    if key not in _CACHE:
        _CACHE[key] = S.chrono_split(P.reuse(panel(spark, sf)), CFG.preprocessing.test_size)
    return _CACHE[key]


def train_test(spark, sf):
    return S.train_test(split_panel(spark, sf))


def scored(spark, sf, name="baseline_seasonal_naive", target=QUANTITY):
    tr, te = train_test(spark, sf)
    if target == REVENUE:
        tr, te = FE.with_revenue(tr), FE.with_revenue(te)
    return P.score_baseline(tr, te, name, target)


def features_split(spark, sf):
    """Engineered features (no one-hot) with the chronological split."""
    key = ("feat", sf, spark.sparkContext.applicationId)
    if key not in _CACHE:
        feats = FE.build_features(panel(spark, sf), one_hot_form="none")
        _CACHE[key] = S.chrono_split(P.reuse(feats), CFG.preprocessing.test_size)
    return _CACHE[key]


SCALED_FEATURES = ["price", "inventory_level", "units_ordered", "discount", "competitor_pricing",
                   "is_holiday", "is_promotion", "day_of_week", "month", "quarter",
                   "day_of_month", "is_weekend", "lag_1", "lag_7", "lag_30", "ma_7", "ma_30"]


# ------------------------------------------------------------------ cleaning (V*, P1)


def q_parse_date(spark, sf):
    d = dirty(spark, sf)
    out = d.select("date_text", FE.D.parse_date("date_text").alias("date")) \
        .groupBy("date_text", "date").agg(F.count(F.lit(1)).alias("n_rows"))
    return finish(out)


def q_leakage_audit(spark, sf):
    return finish(Q.audit_leakage(panel(spark, sf)))


def q_inconsistent_products(spark, sf):
    return finish(Q.inconsistent_products(Q.coerce_types(dirty(spark, sf))))


def _typed_dirty(spark, sf):
    d = dirty(spark, sf)
    return Q.coerce_types(d.withColumn(DATE, FE.D.parse_date("date_text")).drop("date_text"))


def q_fix_category(spark, sf):
    fixed = Q.fix_category(_typed_dirty(spark, sf))
    return finish(fixed.groupBy("product_id", "category").agg(F.count(F.lit(1)).alias("n_rows")))


def q_missing_counts(spark, sf):
    return finish(Q.missing_counts(dirty(spark, sf)))


def _per_product_rows(df):
    return df.groupBy("product_id", "category").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("units_sold").alias("sum_units"),
        F.min("units_sold").alias("min_units"), F.min("price").alias("min_price"))


def q_impute(spark, sf):
    out = Q.impute(Q.fix_category(_typed_dirty(spark, sf)))
    return finish(_per_product_rows(out))


def q_dedup(spark, sf):
    out = Q.dedup(Q.impute(Q.fix_category(_typed_dirty(spark, sf))))
    return finish(_per_product_rows(out))


def q_clamp_negative(spark, sf):
    out = Q.clamp_negative(Q.dedup(Q.impute(Q.fix_category(_typed_dirty(spark, sf)))))
    return finish(_per_product_rows(out))


def q_coerce_types(spark, sf):
    """Text defects and coerced totals in one aggregate pass (coercion is a
    projection of the same rows)."""
    d = dirty(spark, sf).select(F.col("units_sold").alias("units_text"), F.col("price").alias("price_text"))
    both = Q.coerce_types(d.withColumns({"units_sold": F.col("units_text"), "price": F.col("price_text")}))
    bad = lambda c: F.count_if(F.col(c).isNotNull() & F.expr(f"try_cast({c} as double)").isNull())
    out = both.agg(F.count(F.lit(1)).alias("n_rows"), bad("units_text").alias("units_bad_text"),
                   bad("price_text").alias("price_bad_text"), F.sum("units_sold").alias("sum_units"),
                   F.count("units_sold").alias("n_units"), F.sum("price").alias("sum_price"))
    return finish(out, overrides={"sum_price": 2})


def q_quality_report(spark, sf):
    return finish(Q.quality_report(dirty(spark, sf)))


# ------------------------------------------------------------------ panel, features


def q_daily_panel(spark, sf):
    return finish(panel(spark, sf))


def q_filter_history(spark, sf):
    return finish(kept_history(spark, sf))


def q_calendar_features(spark, sf):
    return finish(FE.calendar_features(panel(spark, sf)).select(*KEYS, *CALENDAR))


def q_numeric_features(spark, sf):
    out = FE.numeric_features(panel(spark, sf))
    return finish(out.select(*KEYS, "is_holiday", "is_promotion", *NUMERIC_FEATURES))


def q_revenue(spark, sf):
    return finish(FE.with_revenue(panel(spark, sf)).select(*KEYS, QUANTITY, "price", REVENUE))


def q_one_hot_wide(spark, sf):
    """The wide columns, listed as those set in each row, with the number of columns there are."""
    pnl = P.reuse(panel(spark, sf).select(*KEYS, "weather_condition", "seasonality"))  # read for the values and for the rows
    out = FE.one_hot(pnl)
    onehot = [c for c in out.columns if c not in pnl.columns]
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("value")) for c in onehot])
    rows = out.select(*KEYS, F.inline(F.filter(cells, lambda x: x["value"] != 0)))
    return finish(rows.withColumn("n_columns", F.lit(len(onehot))))


def q_clean_clip(spark, sf):
    feats = FE.build_features(panel(spark, sf), one_hot_form="none")
    return finish(feats)


def _history(spark, sf):
    return panel(spark, sf).select(*KEYS, QUANTITY)


def q_lag_rows(spark, sf):
    return finish(FE.lag_features(_history(spark, sf), (1, 7, 30), "rows"))


def q_lag_calendar(spark, sf):
    return finish(FE.lag_features(_history(spark, sf), (1, 7, 30), "calendar"))


def q_ma_rows(spark, sf):
    return finish(FE.moving_averages(_history(spark, sf), (7, 30), True, "rows"))


def q_ma_strict(spark, sf):
    return finish(FE.moving_averages(_history(spark, sf), (7, 30), False, "rows"))


def q_ma_calendar(spark, sf):
    return finish(FE.moving_averages(_history(spark, sf), (7, 30), True, "calendar"))


# ------------------------------------------------------------------ splits


def q_chrono_split(spark, sf):
    return finish(split_panel(spark, sf).select(*KEYS, "is_train"))


def q_cv_fold_ranges(spark, sf):
    return finish(S.fold_table(panel(spark, sf), "cv", CFG.training.n_splits))


def q_walk_forward_ranges(spark, sf):
    return finish(S.fold_table(panel(spark, sf), "walk_forward", CFG.training.n_splits,
                               CFG.preprocessing.test_size))


# ------------------------------------------------------------------ stock


def _stock_q(method):
    def q(spark, sf):
        return finish(ST.estimate_stock(panel(spark, sf), CFG.preprocessing.days_of_coverage, method))
    q.__name__ = f"q_stock_{method}"
    return q


def q_latest_stock(spark, sf):
    r = Q.coerce_types(raw(spark, sf))
    return finish(ST.latest_stock(Q.fix_category(r), "inventory_level"))


def q_resolve_stock(spark, sf):
    r = raw(spark, sf).drop("inventory_level")
    pnl = P.clean_panel(r, stored=True)
    return finish(ST.resolve_stock(pnl, r, stock_tbl(spark, sf)))


def q_resolve_stock_column(spark, sf):
    """A6 on raw text rows that carry a stock column: parsed, coerced and repaired once."""
    text = dirty(spark, sf)
    typed = P.typed_rows(text, text.count())
    return finish(ST.resolve_stock(P.panel_of(typed), typed, stock_tbl(spark, sf)))


def q_stock_duplicates(spark, sf):
    """S3 with repeated keys and bad text: one stock row per part, the last part key counts."""
    p = tpch.table(spark, sf, "part")
    text = F.when(F.col("p_partkey") % 7 == 0, F.lit("n/a")).otherwise((F.col("p_size") - 10).cast("string"))
    rows = p.select(F.col("p_brand").alias("product_id"), F.col("p_type").alias("category"),
                    text.alias("current_stock"), F.col("p_partkey"))
    return finish(stock_from_frame(rows, F.col("p_partkey")))


def _orders_by_day(spark, sf, day="o_orderdate"):
    """Rows with many equal keys: orders by date and priority."""
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return o.select(F.to_date(day).alias(DATE), F.col("o_orderpriority").alias("region"))


def q_split_ties(spark, sf):
    """T1 where keys repeat: how many of each key's rows are train and test."""
    got = S.chrono_split(_orders_by_day(spark, sf), CFG.preprocessing.test_size)
    return finish(got.groupBy(DATE, "region", "is_train").agg(F.count(F.lit(1)).alias("n_rows")))


def q_fold_ties(spark, sf):
    """T2 where keys repeat: how many of each key's rows fall into each fold."""
    got, _ = S.assign_folds(_orders_by_day(spark, sf), "cv", CFG.training.n_splits)
    return finish(got.groupBy(DATE, "region", "fold").agg(F.count(F.lit(1)).alias("n_rows")))


def q_row_positions(spark, sf):
    """O1 where keys repeat and dates are missing: the positions that each key's rows take."""
    rows = _orders_by_day(spark, sf, F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderdate")))
    got = S.row_positions(rows)
    return finish(got.groupBy(DATE, "region").agg(
        F.min("position").alias("first_position"), F.max("position").alias("last_position"),
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("position").alias("n_positions")))


def q_with_stock(spark, sf):
    out = ST.with_stock(panel(spark, sf), stock_tbl(spark, sf))
    return finish(out.select(*KEYS, "current_stock"))


def q_scaler_stats(spark, sf):
    tr, _ = S.train_test(features_split(spark, sf))
    return finish(M.scaler_stats(tr, SCALED_FEATURES))


# ------------------------------------------------------------------ baselines, metrics


def _baseline_q(name):
    def q(spark, sf):
        return finish(scored(spark, sf, name).select(*KEYS, "label", "prediction"))
    q.__name__ = f"q_{name}"
    return q


def _all_scored(spark, sf, target=QUANTITY):
    tr, te = train_test(spark, sf)
    return P.score_all_baselines(tr, te, target)


def q_accuracy(spark, sf):
    return finish(M.accuracy(M.clip_predictions(scored(spark, sf))))


def q_economic_cost(spark, sf):
    return finish(M.economic_cost(scored(spark, sf), CostConfig()), 2)


def q_compare_models(spark, sf):
    cmp = M.compare_models(_all_scored(spark, sf), CostConfig())
    return finish(cmp, overrides={"total_cost": 2, "holding_cost": 2, "stockout_cost": 2})


def q_best_model(spark, sf):
    return finish(M.best_model(M.compare_models(_all_scored(spark, sf), CostConfig())))


def q_per_product(spark, sf):
    return finish(M.per_product(scored(spark, sf)))


def q_performance_tier(spark, sf):
    return finish(M.performance_tier(M.per_product(scored(spark, sf))))


def q_dimension_impact(spark, sf):
    return finish(M.dimension_impact(scored(spark, sf)))


def q_temporal_errors(spark, sf):
    return finish(M.temporal_errors(scored(spark, sf)), overrides={"mean_pct_error": 2})


def q_revenue_metrics(spark, sf):
    out = M.revenue_metrics(scored(spark, sf, target=REVENUE))
    return finish(out, 2)


def q_revenue_report(spark, sf):
    return finish(M.revenue_report(scored(spark, sf, target=REVENUE)), 2)


def q_correlated_pairs(spark, sf):
    tr, _ = S.train_test(features_split(spark, sf))
    return finish(M.correlated_pairs(tr, SCALED_FEATURES, 0.7))


def q_data_profile(spark, sf):
    tr, _ = S.train_test(features_split(spark, sf))
    return finish(M.data_profile(tr, SCALED_FEATURES))


# ------------------------------------------------------------------ recommendations


def recommendations(spark, sf):
    return R.recommend_orders(scored(spark, sf), stock_tbl(spark, sf), RecommendationConfig())


def q_recommend_orders(spark, sf):
    return finish(recommendations(spark, sf))


def q_urgency_summary(spark, sf):
    return finish(R.urgency_summary(recommendations(spark, sf)))


def q_final_report(spark, sf):
    return finish(R.final_report(recommendations(spark, sf), rounder=stable_round))


def q_executive_summary(spark, sf):
    cmp = M.compare_models(_all_scored(spark, sf), CostConfig())
    out = R.executive_summary(recommendations(spark, sf), M.best_model(cmp), cmp)
    return finish(out, overrides={"total_cost": 2})


def q_format_report(spark, sf):
    rec = recommendations(spark, sf)
    rounded = rec.withColumns({c: stable_round(F.col(c), 2) for c in
                               ("current_stock", "recommended_order", "days_until_stockout",
                                "predicted_demand")})
    return finish(R.format_report(rounded))


def q_run_reports(spark, sf):
    """L4 for demand, without trained models: the comparison table that ``run`` emits, read back as written."""
    cfg = replace(CFG, forecast_revenue=False)
    out = P.run(raw(spark, sf), cfg, models=(), out_dir=f"{ensure_checkpoint_dir(spark)}/run-{uuid.uuid4().hex}", resume=True)
    return finish(out["model_comparison"], overrides={"total_cost": 2, "holding_cost": 2, "stockout_cost": 2})


def q_diagnostics(spark, sf):
    return finish(M.diagnostics(scored(spark, sf)))


# ------------------------------------------------------------------ chart data


def q_sales_trend(spark, sf):
    tr, _ = train_test(spark, sf)
    return finish(C.sales_trend(tr))


def q_prediction_series(spark, sf):
    return finish(C.prediction_series(scored(spark, sf)))


def q_residual_qq(spark, sf):
    return finish(C.residual_qq(scored(spark, sf)))


def q_revenue_series(spark, sf):
    return finish(C.revenue_series(scored(spark, sf, target=REVENUE)), 2)


def q_order_chart(spark, sf):
    return finish(C.order_chart(recommendations(spark, sf)))


def q_stock_per_product(spark, sf):
    return finish(ST.stock_per_product(ST.with_stock(panel(spark, sf), stock_tbl(spark, sf))))


def q_prediction_range(spark, sf):
    return finish(C.prediction_range(scored(spark, sf)))


def q_residual_bins(spark, sf):
    return finish(C.residual_bins(scored(spark, sf)))


def q_top_correlated(spark, sf):
    tr, _ = S.train_test(features_split(spark, sf))
    return finish(M.top_correlated(M.correlated_pairs(tr, SCALED_FEATURES, 0.7), 5))


def q_error_columns(spark, sf):
    s = M.with_errors(M.clip_predictions(scored(spark, sf)))
    return finish(s.select(*KEYS, "error", "abs_error", "pct_error"))


def q_filter_history_days(spark, sf):
    """D6 strict: history counted in distinct days."""
    return finish(kept_history(spark, sf, "distinct_days"))


def q_chrono_split_date(spark, sf):
    """D11 strict: the boundary date goes wholly to test."""
    return finish(S.chrono_split(P.reuse(panel(spark, sf)), CFG.preprocessing.test_size, boundary="date")
                  .select(*KEYS, "is_train"))


def q_stock_mean_train(spark, sf):
    """D12 strict: stock estimated from training rows only."""
    tr, _ = train_test(spark, sf)
    return finish(ST.estimate_stock(tr, CFG.preprocessing.days_of_coverage, "mean"))


def q_events_panel(spark, sf):
    """A1 on the dense second binding: daily events per type, mean value."""
    pnl = daily_panel(tpch.events_raw(spark, sf))
    return finish(pnl.select(*KEYS, QUANTITY, "price", "seasonality"))


def q_events_lags(spark, sf):
    """Second (dense) binding: one series per event type, daily counts."""
    pnl = daily_panel(tpch.events_raw(spark, sf))
    out = FE.moving_averages(FE.lag_features(pnl.select(*KEYS, QUANTITY), (1, 7), "rows"), (7,), True, "rows")
    return finish(out)


SQL_QUERIES = {
    "parse_date": q_parse_date,
    "calendar_features": q_calendar_features,
    "numeric_features": q_numeric_features,
    "revenue": q_revenue,
    "one_hot_wide": q_one_hot_wide,
    "clean_clip": q_clean_clip,
    "leakage_audit": q_leakage_audit,
    "inconsistent_products": q_inconsistent_products,
    "fix_category": q_fix_category,
    "missing_counts": q_missing_counts,
    "impute": q_impute,
    "dedup": q_dedup,
    "clamp_negative": q_clamp_negative,
    "coerce_types": q_coerce_types,
    "quality_report": q_quality_report,
    "daily_panel": q_daily_panel,
    "filter_history": q_filter_history,
    "lag_rows": q_lag_rows,
    "lag_calendar": q_lag_calendar,
    "ma_rows": q_ma_rows,
    "ma_strict": q_ma_strict,
    "ma_calendar": q_ma_calendar,
    "chrono_split": q_chrono_split,
    "cv_fold_ranges": q_cv_fold_ranges,
    "walk_forward_ranges": q_walk_forward_ranges,
    "stock_mean": _stock_q("mean"),
    "stock_median": _stock_q("median"),
    "stock_p75": _stock_q("p75"),
    "stock_p90": _stock_q("p90"),
    "latest_stock": q_latest_stock,
    "resolve_stock": q_resolve_stock,
    "resolve_stock_column": q_resolve_stock_column,
    "stock_duplicates": q_stock_duplicates,
    "split_ties": q_split_ties,
    "fold_ties": q_fold_ties,
    "row_positions": q_row_positions,
    "with_stock": q_with_stock,
    "scaler_stats": q_scaler_stats,
    "baseline_last": _baseline_q("baseline_last_value"),
    "baseline_mean": _baseline_q("baseline_mean"),
    "baseline_seasonal": _baseline_q("baseline_seasonal_naive"),
    "accuracy": q_accuracy,
    "economic_cost": q_economic_cost,
    "compare_models": q_compare_models,
    "best_model": q_best_model,
    "per_product": q_per_product,
    "performance_tier": q_performance_tier,
    "dimension_impact": q_dimension_impact,
    "temporal_errors": q_temporal_errors,
    "revenue_metrics": q_revenue_metrics,
    "revenue_report": q_revenue_report,
    "correlated_pairs": q_correlated_pairs,
    "data_profile": q_data_profile,
    "recommend_orders": q_recommend_orders,
    "urgency_summary": q_urgency_summary,
    "final_report": q_final_report,
    "executive_summary": q_executive_summary,
    "format_report": q_format_report,
    "run_reports": q_run_reports,
    "diagnostics": q_diagnostics,
    "sales_trend": q_sales_trend,
    "prediction_series": q_prediction_series,
    "residual_qq": q_residual_qq,
    "revenue_series": q_revenue_series,
    "order_chart": q_order_chart,
    "events_lags": q_events_lags,
    "events_panel": q_events_panel,
    "stock_per_product": q_stock_per_product,
    "prediction_range": q_prediction_range,
    "residual_bins": q_residual_bins,
    "top_correlated": q_top_correlated,
    "error_columns": q_error_columns,
    "filter_history_days": q_filter_history_days,
    "chrono_split_date": q_chrono_split_date,
    "stock_mean_train": q_stock_mean_train,
}
