"""Accuracy, cost and breakdown reports.

Scored frames carry ``label`` (actual) and ``prediction``. Breakdowns use
GROUPING SETS (one Expand + one partial/final aggregate) instead of one pass
per dimension.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.config import CostConfig
from shelfwise.functions import dates as D
from shelfwise.functions.keys import product_key, product_label
from shelfwise.functions.numeric import clip_prediction
from shelfwise.operators.gram import correlated_slots
from shelfwise.operators.quantiles import grouped_quantiles
from shelfwise.schema import DATE, PRODUCT_KEY, PRODUCT_LINE



class _Cols:
    """Lazily built column references (no SparkContext needed at import)."""

    @property
    def act(self) -> Column:
        return F.col("label")

    @property
    def pred(self) -> Column:
        return F.col("prediction")


_C = _Cols()


def clip_predictions(df: DataFrame) -> DataFrame:
    return df.withColumn("prediction", clip_prediction(_C.pred))


def with_errors(df: DataFrame) -> DataFrame:
    """error = actual - predicted; abs_error; pct_error = abs/(actual+1e-10)*100."""
    err = _C.act - _C.pred
    return df.withColumns({"error": err, "abs_error": F.abs(err),
                           "pct_error": F.abs(err) / (_C.act + F.lit(1e-10)) * F.lit(100.0)})


def mae(err: Column | None = None) -> Column:
    return F.avg(F.abs(_C.act - _C.pred if err is None else err))


def rmse(err: Column | None = None) -> Column:
    e = _C.act - _C.pred if err is None else err
    return F.sqrt(F.avg(e * e))


def accuracy(df: DataFrame, by=()) -> DataFrame:
    return df.groupBy(*by).agg(mae().alias("mae"), rmse().alias("rmse"))


def cost_columns(cfg: CostConfig = CostConfig()) -> list[Column]:
    pred = clip_prediction(_C.pred)
    over = F.coalesce(F.sum(F.greatest(pred - _C.act, F.lit(0.0))), F.lit(0.0))
    under = F.coalesce(F.sum(F.greatest(_C.act - pred, F.lit(0.0))), F.lit(0.0))
    holding = over * F.lit(cfg.holding_cost_per_unit_per_day)
    stockout = under * F.lit(cfg.stockout_cost_per_unit)
    return [(holding + stockout).alias("total_cost"), holding.alias("holding_cost"),
            stockout.alias("stockout_cost"), over.alias("over_prediction_units"),
            under.alias("under_prediction_units")]


def economic_cost(df: DataFrame, cfg: CostConfig = CostConfig(), by=()) -> DataFrame:
    """Over-forecast units x holding rate + under-forecast units x stockout rate."""
    return df.groupBy(*by).agg(*cost_columns(cfg))


def compare_models(scored_long: DataFrame, cfg: CostConfig | None = CostConfig()) -> DataFrame:
    """M9: one row per model from a long (model, label, prediction) frame;
    predictions are clipped at 0 first."""
    df = clip_predictions(scored_long)
    aggs = [mae().alias("mae"), rmse().alias("rmse")]
    if "model_order" in df.columns:
        aggs.append(F.min("model_order").alias("model_order"))
    if cfg is not None:
        aggs += cost_columns(cfg)[:3]
    return df.groupBy("model").agg(*aggs)


def best_model(cmp: DataFrame) -> DataFrame:
    """O3: argmin RMSE; ties -> first in model order (then name)."""
    tie = F.col("model_order") if "model_order" in cmp.columns else F.lit(0)
    order = F.struct(F.col("rmse"), tie, F.col("model"))
    return cmp.agg(F.min_by("model", order).alias("model"), F.min("rmse").alias("rmse"))


def leaderboard(cmp: DataFrame, k: int = 3) -> DataFrame:
    """Non-baseline models by RMSE, top k, best flagged."""
    ml = cmp.where(~F.col("model").startswith("baseline_"))
    top = ml.orderBy(F.col("rmse").asc_nulls_last(), "model").limit(k)
    best = F.min("rmse").over(Window.partitionBy())  # over the k rows kept
    return top.withColumn("is_best", (F.col("rmse") == best).cast("int"))


def per_product(scored: DataFrame, clip: bool = False) -> DataFrame:
    """MAE, RMSE, n per product key (unclipped by default, as the reference)."""
    df = clip_predictions(scored) if clip else scored
    df = df.withColumns({PRODUCT_KEY: product_key(df), PRODUCT_LINE: product_label(df)}) \
        if PRODUCT_KEY not in df.columns else df.withColumn(PRODUCT_LINE, product_label(df))
    return df.groupBy(PRODUCT_KEY).agg(F.min(PRODUCT_LINE).alias(PRODUCT_LINE), mae().alias("mae"),
                                       rmse().alias("rmse"), F.count(F.lit(1)).alias("n_samples"))


def performance_tier(pp: DataFrame) -> DataFrame:
    """Green below the 33rd RMSE percentile, orange below the 67th, else red.

    The thresholds are exact quantiles, a row of two numbers that the plan joins to
    every product; no job runs while it is built. Products without an RMSE are red.
    """
    q = grouped_quantiles(pp, (), "rmse", [0.33, 0.67])
    q = q.select(F.lit(1).alias("_one"), F.col("quantiles")[0].alias("_q33"), F.col("quantiles")[1].alias("_q67"))
    out = pp.withColumn("_one", F.lit(1)).join(F.broadcast(q), "_one", "left")  # one row
    return out.withColumn("tier", F.when(F.col("rmse") < F.col("_q33"), "green")
                          .when(F.col("rmse") < F.col("_q67"), "orange").otherwise("red")).drop("_one", "_q33", "_q67")


def _breakdown(df: DataFrame, dims: dict[str, Column], aggs: list[Column],
               overall: bool = True) -> DataFrame:
    """(dimension, value, aggs...) for the overall set plus each dimension,
    with GROUPING SETS; NULL dimension values are dropped as in pandas."""
    names = list(dims)
    base = df.withColumns({f"_d{i}": c.cast("string") for i, c in enumerate(dims.values())})
    cols = [f"_d{i}" for i in range(len(names))]
    sets = ([[]] if overall else []) + [[F.col(c)] for c in cols]
    g = base.groupingSets(sets, *cols).agg(*aggs, F.grouping_id().alias("_gid"))
    full = (1 << len(cols)) - 1
    dim = F.when(F.col("_gid") == full, F.lit("Overall"))
    val = F.when(F.col("_gid") == full, F.lit("All"))
    for i, name in enumerate(names):
        gid = full ^ (1 << (len(cols) - 1 - i))
        dim = dim.when(F.col("_gid") == gid, F.lit(name))
        val = val.when(F.col("_gid") == gid, F.col(cols[i]))
    out = g.withColumns({"dimension": dim, "value": val})
    return out.where(F.col("value").isNotNull()).drop("_gid", *cols)


def dimension_impact(scored: DataFrame) -> DataFrame:
    """A10: overall and per weather / season / region (clipped predictions)."""
    df = clip_predictions(scored)
    dims = {"Weather Condition": F.col("weather_condition"), "Seasonality": F.col("seasonality"),
            "Region": F.col("region")}
    aggs = [mae().alias("mae"), rmse().alias("rmse"), F.avg(_C.act).alias("mean_actual"),
            F.avg(_C.pred).alias("mean_predicted")]
    return _breakdown(df, {k: v for k, v in dims.items()}, aggs)


def temporal_errors(scored: DataFrame) -> DataFrame:
    """Overall, weekday name, weekend status, month name, quarter."""
    df = with_errors(clip_predictions(scored))
    d = F.col(DATE)
    dims = {"Day_of_Week": D.day_name(d), "Weekend_Status": D.weekend_label(d),
            "Month": D.month_name(d), "Quarter": D.quarter_label(d)}
    aggs = [mae().alias("mae"), rmse().alias("rmse"), F.avg("error").alias("mean_error"),
            F.stddev_samp("error").alias("std_error"), F.avg("pct_error").alias("mean_pct_error"),
            F.count(F.lit(1)).alias("n_samples")]
    return _breakdown(df, dims, aggs)


def revenue_metrics(scored: DataFrame) -> DataFrame:
    """MAE, RMSE, totals, |total error| % (0 when the true total <= 0)."""
    df = clip_predictions(scored)
    tt, tp = F.sum(_C.act), F.sum(_C.pred)
    pct = F.when(tt > 0, F.abs(tp - tt) / tt * F.lit(100.0)).otherwise(F.lit(0.0))
    return df.agg(mae().alias("mae"), rmse().alias("rmse"), tt.alias("total_revenue_true"),
                  tp.alias("total_revenue_pred"), pct.alias("revenue_error_pct"))


def revenue_report(scored: DataFrame) -> DataFrame:
    """Predicted revenue sum and count, overall and per weather/season/region."""
    df = clip_predictions(scored)
    dims = {"Weather Condition": F.col("weather_condition"), "Seasonality": F.col("seasonality"),
            "Region": F.col("region")}
    return _breakdown(df, dims, [F.sum(_C.pred).alias("predicted_revenue"),
                                 F.count(F.lit(1)).alias("count")])


def cv_summary(folds: DataFrame) -> DataFrame:
    """Mean and population std of fold MAE / RMSE per model."""
    return folds.groupBy("model").agg(
        F.avg("mae").alias("mae_mean"), F.stddev_pop("mae").alias("mae_std"),
        F.avg("rmse").alias("rmse_mean"), F.stddev_pop("rmse").alias("rmse_std"))


def scaler_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, mean, population std) in one aggregate pass."""
    one = df.agg(*[x for c in cols for x in (F.avg(c).alias(f"m_{c}"),
                                              F.stddev_pop(c).alias(f"s_{c}"))])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"m_{c}").alias("mean"),
                              F.col(f"s_{c}").alias("std")) for c in cols])
    return one.select(F.inline(rows))


def correlated_pairs(df: DataFrame, cols: list[str], threshold: float = 0.7) -> DataFrame:
    """|Pearson corr| > threshold over numeric feature pairs (i < j).

    Sums of products merged from one pass (``gram``), however many columns there
    are. A constant column has no correlation and is never above the threshold.
    """
    return correlated_slots(df, cols, (), threshold)


def top_correlated(pairs: DataFrame, k: int = 5) -> DataFrame:
    """First k pairs in column order."""
    return pairs.orderBy("i", "j").limit(k)


def data_profile(df: DataFrame, feature_cols: list[str]) -> DataFrame:
    """Sample count, feature count, samples per feature."""
    nf = len(feature_cols)
    n = F.count(F.lit(1))
    return df.agg(n.alias("n_samples"), F.lit(nf).alias("n_features"),
                  (n / F.lit(float(max(nf, 1)))).alias("samples_per_feature"))


def extremes(df: DataFrame, metric: str = "rmse", k: int = 5, label: str = "value") -> DataFrame:
    """K smallest and k largest rows by ``metric`` (ties by label)."""
    best = df.orderBy(F.col(metric).asc(), F.col(label).asc()).limit(k).withColumn("rank_side", F.lit("best"))
    worst = df.orderBy(F.col(metric).desc(), F.col(label).asc()).limit(k).withColumn("rank_side", F.lit("worst"))
    return best.unionByName(worst)


def diagnostics(scored: DataFrame, k: int = 5) -> DataFrame:
    """Overall errors, k best and worst products, best and worst weekday and
    condition, weekend split, stacked as (section, label, rmse, mae).

    The scored rows are read once, by one GROUPING SETS aggregate; the extremes
    are ranked within its small result.
    """
    df = scored.withColumns({PRODUCT_KEY: product_key(scored), PRODUCT_LINE: product_label(scored),
                             "_clipped": clip_prediction(_C.pred)})
    dims = {"product": F.col(PRODUCT_KEY), "day": D.day_name(F.col(DATE)), "weekend": D.weekend_label(F.col(DATE)),
            "Weather Condition": F.col("weather_condition"), "Seasonality": F.col("seasonality"),
            "Region": F.col("region")}
    err = _C.act - F.col("_clipped")
    # products are judged on unclipped predictions, as the reference does
    out = _breakdown(df, dims, [F.min(PRODUCT_LINE).alias("_line"), mae().alias("_mae"), rmse().alias("_rmse"),
                                mae(err).alias("mae"), rmse(err).alias("rmse")])
    product = F.col("dimension") == "product"
    out = out.select("dimension", F.when(product, F.col("_line")).otherwise(F.col("value")).alias("label"),
                     F.when(product, F.col("_rmse")).otherwise(F.col("rmse")).alias("rmse"),
                     F.when(product, F.col("_mae")).otherwise(F.col("mae")).alias("mae"))
    plain = out.where(F.col("dimension").isin("Overall", "weekend")).withColumn("section", F.lower("dimension"))
    parts = [plain]
    most = F.when(F.col("dimension") == "product", k).otherwise(1)
    for side, order in (("best", F.col("rmse").asc()), ("worst", F.col("rmse").desc())):
        rank = F.row_number().over(Window.partitionBy("dimension").orderBy(order, F.col("label").asc()))
        parts.append(out.where(~F.col("dimension").isin("Overall", "weekend")).withColumn("_rank", rank)
                     .where((F.col("_rank") <= k) & (F.col("_rank") <= most))
                     .withColumn("section", F.concat("dimension", F.lit(f"_{side}"))).drop("_rank"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("section", "label", "rmse", "mae")


def interpretation(df: DataFrame, cols: list[str], trees: int = 100, depth: int = 10,
                   threshold: float = 0.7, cats=()) -> DataFrame:
    """Rows, features, strongly correlated pairs, and the forest's parameter estimate trees * 2^depth.
    The values of ``cats`` count as features (one-hot slots)."""
    n_pairs = correlated_slots(df, cols, cats, threshold).agg(F.count(F.lit(1)).alias("n_correlated_pairs"))
    n = F.count(F.lit(1))
    slots = [F.count_distinct(c) for c in cats]
    n_features = reduce(add, slots, F.lit(len(cols))).cast("int")
    profile = df.agg(n.alias("n_samples"), n_features.alias("n_features"),
                     (n / F.greatest(n_features, F.lit(1)).cast("double")).alias("samples_per_feature"))
    return one_row(profile.withColumn("forest_parameter_estimate", F.lit(trees * 2 ** depth)), n_pairs)


def one_row(*parts: DataFrame) -> DataFrame:
    """One-row tables side by side (stacked with NULLs, then the greatest of each column)."""
    names = [c for p in parts for c in p.columns]
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in names])
