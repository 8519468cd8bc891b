"""Daily panel (A1) and the minimum-history filter."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.schema import DATE, DIMS, OPTIONAL_NUMERIC, PRICE, QUANTITY, UNITS


def daily_panel(df: DataFrame) -> DataFrame:
    """One row per date x store x product x category x region.

    quantity = sum of units (0 when all missing), price and optional numerics
    averaged, weather/seasonality = modal value (ties -> smallest), holiday and
    promotion flags carried with ``max``. One hash aggregate with map-side
    partial aggregation: a hot key collapses to one row per partition before the
    shuffle. Rows with a NULL key (e.g. unparseable date) are dropped.
    """
    keys = [c for c in DIMS if c in df.columns]
    cols = set(df.columns)
    valid = df.where(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    aggs = [F.coalesce(F.sum(UNITS), F.lit(0.0)).alias(QUANTITY), F.avg(PRICE).alias(PRICE)]
    aggs += [F.avg(c).alias(c) for c in OPTIONAL_NUMERIC if c in cols]
    aggs += [F.max(c).alias(c) for c in ("holiday", "promotion") if c in cols]
    aggs += [F.mode(c, True).alias(c) for c in ("weather_condition", "seasonality") if c in cols]
    return valid.groupBy(*keys).agg(*aggs)


def history_keys(df: DataFrame) -> list[str]:
    cols = set(df.columns)
    if {"product_id", "category"} <= cols:
        return ["product_id", "category"]
    if "product_id" in cols:
        return ["product_id"]
    if "category" in cols:
        return ["category"]
    return []


def history_counts(df: DataFrame, count: str = "rows") -> DataFrame:
    """Rows (reference) or distinct days (strict) per product."""
    keys = history_keys(df)
    n = F.count(F.lit(1)) if count == "rows" else F.count_distinct(DATE)
    return df.groupBy(*keys).agg(n.alias("n_days"))


def filter_history(df: DataFrame, min_days: int = 30, count: str = "rows") -> DataFrame:
    """Keep products with at least ``min_days`` of history: a partial aggregate
    plus a semi join against the (one row per product) list of survivors."""
    keys = history_keys(df)
    if not keys:
        return df
    keep = history_counts(df, count).where(F.col("n_days") >= min_days).select(*keys)
    return df.join(keep, keys, "left_semi")
