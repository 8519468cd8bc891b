"""Data behind the reference's charts (C1-C5); rendering is out of scope."""

from __future__ import annotations

import statistics

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.keys import product_label
from shelfwise.functions.numeric import clip_prediction
from shelfwise.operators.quantiles import grouped_quantiles
from shelfwise.schema import DATE, PRODUCT_LINE, QUANTITY


def sales_trend(panel: DataFrame, product: str | None = None) -> DataFrame:
    """Daily units per product label (optionally one product)."""
    df = panel.withColumn(PRODUCT_LINE, product_label(panel))
    if product is not None:
        df = df.where(F.col(PRODUCT_LINE) == product)
    return df.groupBy(DATE, PRODUCT_LINE).agg(F.sum(QUANTITY).alias(QUANTITY))


def prediction_series(scored: DataFrame) -> DataFrame:
    """Actual vs predicted totals per date."""
    pred = clip_prediction(F.col("prediction"))
    return scored.groupBy(DATE).agg(F.sum("label").alias("actual"), F.sum(pred).alias("predicted"))


def prediction_range(scored: DataFrame) -> DataFrame:
    pred = clip_prediction(F.col("prediction"))
    return scored.agg(F.least(F.min("label"), F.min(pred)).alias("min_value"),
                      F.greatest(F.max("label"), F.max(pred)).alias("max_value"))


def probability_grid(points: int = 99) -> list[tuple[float, float]]:
    """(p, standard normal quantile) for p = 1/(points+1) .. points/(points+1)."""
    nd = statistics.NormalDist()
    return [(i / (points + 1), nd.inv_cdf(i / (points + 1))) for i in range(1, points + 1)]


def residual_qq(scored: DataFrame, points: int = 99, exact: bool = True,
                accuracy: int = 100000) -> DataFrame:
    """Sample residual quantiles vs normal quantiles on a fixed grid.

    Exact by bucket refinement; ``exact=False`` takes the one-pass sketch of ``accuracy``.
    """
    grid = probability_grid(points)
    resid = scored.select((F.col("label") - clip_prediction(F.col("prediction"))).alias("residual"))
    if exact:
        one = grouped_quantiles(resid, (), "residual", [p for p, _ in grid])
    else:
        probs = F.array(*[F.lit(p) for p, _ in grid])
        one = resid.agg(F.percentile_approx("residual", probs, accuracy).alias("quantiles"))
    pairs = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(z).alias("theoretical_quantile")) for p, z in grid])
    rows = F.zip_with(pairs, "quantiles", lambda g, v: F.struct(
        g["p"].alias("p"), v.alias("sample_quantile"), g["theoretical_quantile"].alias("theoretical_quantile")))
    return one.select(F.inline(rows))


def residual_bins(scored: DataFrame, width: float = 50.0) -> DataFrame:
    """Residual vs predicted scatter reduced to fixed-width prediction bins."""
    pred = clip_prediction(F.col("prediction"))
    width = F.lit(float(width))
    return (scored.withColumn("_p", pred)
            .groupBy(F.floor(F.col("_p") / width).alias("bin"))
            .agg(F.avg("_p").alias("mean_predicted"), F.avg(F.col("label") - F.col("_p")).alias("mean_residual"),
                 F.count(F.lit(1)).alias("n")))


def revenue_series(scored: DataFrame) -> DataFrame:
    """Actual and predicted revenue by date, weather and region (long form)."""
    from shelfwise.operators.metrics import _breakdown
    df = scored.withColumn("prediction", clip_prediction(F.col("prediction")))
    dims = {"Date": F.col(DATE), "Weather Condition": F.col("weather_condition"),
            "Region": F.col("region")}
    aggs = [F.sum("label").alias("actual_revenue"), F.sum("prediction").alias("predicted_revenue")]
    return _breakdown(df, dims, aggs, overall=False)


def order_chart(rec: DataFrame) -> DataFrame:
    """C4: order quantity per product."""
    return rec.select(PRODUCT_LINE, "recommended_order")
