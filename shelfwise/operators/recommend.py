"""Order recommendations and planner reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.config import RecommendationConfig
from shelfwise.functions import formatting as fmt
from shelfwise.functions.keys import product_key, product_label
from shelfwise.functions.numeric import clip_prediction, half_even
from shelfwise.operators.metrics import one_row
from shelfwise.schema import PRODUCT_KEY, PRODUCT_LINE, STOCK

# Urgency levels in priority order and their day limits
# (days until stockout <= 3 URGENT, <= 7 NORMAL, <= 14 LOW, else POOR; no
# positive demand -> POOR with 999 days).
URGENCY_LEVELS = ("URGENT", "NORMAL", "LOW", "POOR")
URGENT_DAYS, NORMAL_DAYS, LOW_DAYS = 3.0, 7.0, 14.0
NO_DEMAND_DAYS = 999.0


def with_urgency(df: DataFrame, stock: str = STOCK, demand: str = "predicted_demand") -> DataFrame:
    """Days until stockout and urgency level."""
    pos = F.col(demand) > 0
    days = F.when(pos, F.col(stock) / F.col(demand)).otherwise(F.lit(NO_DEMAND_DAYS))
    level = (F.when(~pos, F.lit("POOR"))
             .when(days <= URGENT_DAYS, F.lit("URGENT"))
             .when(days <= NORMAL_DAYS, F.lit("NORMAL"))
             .when(days <= LOW_DAYS, F.lit("LOW"))
             .otherwise(F.lit("POOR")))
    return df.withColumns({"days_until_stockout": days, "reorder_urgency": level})


def order_quantity(df: DataFrame, cfg: RecommendationConfig = RecommendationConfig(),
                   demand: str = "predicted_demand", stock: str = STOCK) -> DataFrame:
    """Safety stock, target inventory, order = max(0, target - stock)."""
    d = F.col(demand)
    target = d * F.lit(cfg.target_days_of_coverage)
    return df.withColumns({
        "safety_stock": d * F.lit(cfg.safety_stock_multiplier),
        "target_inventory": target,
        "recommended_order": F.greatest(F.lit(0.0), target - F.col(stock)),
    })


def urgency_rank(c: Column | str = "reorder_urgency") -> Column:
    col = F.col(c) if isinstance(c, str) else c
    rank = F.lit(None).cast("int")
    expr = None
    for i, lvl in enumerate(URGENCY_LEVELS):
        expr = (F.when(col == lvl, F.lit(i)) if expr is None else expr.when(col == lvl, F.lit(i)))
    return expr.otherwise(rank)


def recommend_orders(scored: DataFrame, stock: DataFrame | None,
                     cfg: RecommendationConfig = RecommendationConfig(),
                     validate: bool = True) -> DataFrame:
    """Mean clipped prediction per product -> stock lookup -> order -> urgency.

    One partial aggregate by product key; the stock table (one row per product)
    is joined left with missing stock -> 0. Sorted only at the sink
    (``sort_recommendations``). NaN or NULL predictions are counted in the same
    aggregate and fail the query that reads the result.
    """
    df = scored.withColumns({PRODUCT_KEY: product_key(scored), PRODUCT_LINE: product_label(scored)})
    demand = df.groupBy(PRODUCT_KEY).agg(
        F.min(PRODUCT_LINE).alias(PRODUCT_LINE),
        F.avg(clip_prediction(F.col("prediction"))).alias("predicted_demand"),
        F.count_if(F.col("prediction").isNull() | F.isnan("prediction")).alias("_bad"))
    if validate:
        bad = F.raise_error(F.concat(F.col("_bad").cast("string"), F.lit(" predictions are NaN or NULL: "), F.col(PRODUCT_KEY)))
        demand = demand.withColumn("predicted_demand", F.when(F.col("_bad") > 0, bad.cast("double"))
                                   .otherwise(F.col("predicted_demand")))
    demand = demand.drop("_bad")
    if stock is not None:
        demand = demand.join(stock.select(PRODUCT_KEY, STOCK), PRODUCT_KEY, "left")
        demand = demand.withColumn(STOCK, F.coalesce(F.col(STOCK), F.lit(0.0)))
    else:
        demand = demand.withColumn(STOCK, F.lit(0.0))
    out = with_urgency(order_quantity(demand, cfg))
    return out.select(PRODUCT_LINE, PRODUCT_KEY, STOCK, "predicted_demand", "safety_stock",
                      "target_inventory", "recommended_order", "reorder_urgency",
                      "days_until_stockout")


def sort_recommendations(rec: DataFrame) -> DataFrame:
    """O2: URGENT -> POOR, ties by product key (deterministic)."""
    return rec.orderBy(urgency_rank(), F.col(PRODUCT_KEY))


# Final report headers in order.
FINAL_COLUMNS = (
    ("product_line", "Product Line"), ("reorder_urgency", "Reorder Urgency"),
    ("days_until_stockout", "Days Until Stockout"), ("current_stock", "Current Stock"),
    ("predicted_demand", "Predicted Daily Demand"), ("safety_stock", "Safety Stock Target"),
    ("target_inventory", "Target Inventory"), ("recommended_order", "Recommended Order Quantity"),
)
ROUNDED = ("current_stock", "predicted_demand", "safety_stock", "target_inventory",
           "recommended_order", "days_until_stockout")


def final_report(rec: DataFrame, rounder=half_even) -> DataFrame:
    """R2 (P17 + P18): 2-decimal rounding, fixed column order and headers."""
    cols = []
    for src, header in FINAL_COLUMNS:
        if src in rec.columns:
            c = rounder(F.col(src), 2) if src in ROUNDED else F.col(src)
            cols.append(c.alias(header))
    return rec.select(*cols)


def urgency_summary(rec: DataFrame, urgency: str = "reorder_urgency",
                    order: str = "recommended_order") -> DataFrame:
    """Products and order quantity per urgency level, all four levels
    present (one aggregate pass, unpivoted)."""
    aggs = []
    for lvl in URGENCY_LEVELS:
        hit = F.col(urgency) == lvl
        aggs += [F.count_if(hit).alias(f"n_{lvl}"),
                 F.coalesce(F.sum(F.when(hit, F.col(order))), F.lit(0.0)).alias(f"q_{lvl}")]
    one = rec.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(lvl).alias("reorder_urgency"), F.col(f"n_{lvl}").alias("n_products"),
                              F.col(f"q_{lvl}").alias("order_quantity")) for lvl in URGENCY_LEVELS])
    return one.select(F.inline(rows))


def executive_summary(rec: DataFrame, best: DataFrame, cmp: DataFrame) -> DataFrame:
    """One row: products, urgent products, total order, best model, its RMSE
    and cost; nothing is computed before the result is read."""
    b = best.select(F.col("model").alias("best_model"), F.col("rmse").alias("best_rmse"))
    if "total_cost" in cmp.columns:
        costs = cmp.select(F.col("model").alias("best_model"), "total_cost")
        b = b.join(F.broadcast(costs), "best_model", "left")  # a row per model
    else:
        b = b.withColumn("total_cost", F.lit(None).cast("double"))
    return one_row(rec.agg(
        F.count(F.lit(1)).alias("n_products"),
        F.count_if(F.col("reorder_urgency") == "URGENT").alias("urgent_products"),
        F.coalesce(F.sum("recommended_order"), F.lit(0.0)).alias("total_order_quantity")), b)


def format_report(rec: DataFrame) -> DataFrame:
    """P20: presentation text columns."""
    return rec.select(
        F.col(PRODUCT_LINE), F.col("reorder_urgency"),
        fmt.units_text(F.col(STOCK)).alias("current_stock_text"),
        fmt.units_text(F.col("recommended_order")).alias("order_text"),
        fmt.days_text(F.col("days_until_stockout")).alias("days_text"),
        fmt.money_text(F.col("predicted_demand")).alias("demand_money_text"),
    )
