"""Naive baselines (M6a-c, A20, J5), keyed per product with fallbacks.

Lookup tables are partial aggregates (one row per product or product x
weekday), written once; the fallback values come from the same table. It is
broadcast if counted to be at most LOOKUP_ROWS, so the test rows are not
shuffled on a few product keys; beyond that Spark joins and splits skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.keys import product_key
from shelfwise.schema import DATE, PRODUCT_KEY, QUANTITY, SERIES
from shelfwise.session import cut_lineage


def _order(df: DataFrame):
    """Total order of rows: date, then the series keys."""
    return F.struct(F.col(DATE), *[F.col(c) for c in SERIES if c in df.columns])


def _keyed(df: DataFrame, key: str | None) -> DataFrame:
    if key is None or key in df.columns:
        return df
    if key == PRODUCT_KEY:
        return df.withColumn(PRODUCT_KEY, product_key(df))
    raise ValueError(f"baseline key column '{key}' not found")


LOOKUP_ROWS = 500_000


def _lookup(train: DataFrame, by: list, aggs: list) -> tuple[DataFrame, bool]:
    """The table of ``aggs`` per ``by``, and whether it is small enough to broadcast."""
    t = cut_lineage(train.groupBy(*by).agg(*aggs))
    return t, t.count() <= LOOKUP_ROWS


def _join(df: DataFrame, lookup: DataFrame, small: bool, on: list[str]) -> DataFrame:
    return df.join(F.broadcast(lookup) if small else lookup, on, "left")


def _first(t: DataFrame, agg) -> float:
    v = t.agg(agg.alias("v")).first()["v"]
    return float(v) if v is not None else 0.0


def baseline_last(train: DataFrame, test: DataFrame, target: str = QUANTITY,
                  key: str | None = PRODUCT_KEY) -> DataFrame:
    """Last training value of the product, else the last training value overall."""
    train, test = _keyed(train, key), _keyed(test, key)
    by = [] if key is None else [key]
    order = _order(train)
    last, small = _lookup(train, by, [F.max_by(F.col(target).cast("double"), order).alias("_last"), F.max(order).alias("_at")])
    glob = _first(last, F.max_by("_last", "_at"))
    if key is None:
        return test.withColumn("prediction", F.lit(glob))
    out = _join(test, last.drop("_at"), small, by)
    return out.withColumn("prediction", F.coalesce("_last", F.lit(glob))).drop("_last")


def baseline_mean(train: DataFrame, test: DataFrame, target: str = QUANTITY,
                  key: str | None = PRODUCT_KEY) -> DataFrame:
    """Mean training value of the product, else the global training mean."""
    train, test = _keyed(train, key), _keyed(test, key)
    by, y = ([] if key is None else [key]), F.col(target).cast("double")
    means, small = _lookup(train, by, [F.sum(y).alias("_sum"), F.count(y).alias("_n")])
    glob = _first(means, F.try_divide(F.sum("_sum"), F.sum("_n")))
    if key is None:
        return test.withColumn("prediction", F.lit(glob))
    means = means.select(key, F.try_divide("_sum", "_n").alias("_mean"))
    out = _join(test, means, small, by)
    return out.withColumn("prediction", F.coalesce("_mean", F.lit(glob))).drop("_mean")


def baseline_seasonal(train: DataFrame, test: DataFrame, target: str = QUANTITY,
                      key: str | None = PRODUCT_KEY) -> DataFrame:
    """Most recent value of the product on the same weekday, else the product's
    last value, else the global last value."""
    train, test = _keyed(train, key), _keyed(test, key)
    if key is None:
        return baseline_last(train, test, target, None)
    order, dow = _order(train), F.weekday(F.col(DATE)).alias("_dow")
    season, small = _lookup(train, [F.col(key), dow], [
        F.max_by(F.col(target).cast("double"), order).alias("_season"), F.max(order).alias("_at")])
    last = season.groupBy(key).agg(F.max_by("_season", "_at").alias("_last"))
    glob = _first(season, F.max_by("_season", "_at"))
    out = _join(test.withColumn("_dow", F.weekday(F.col(DATE))), season.drop("_at"), small, [key, "_dow"])
    out = _join(out, last, small, [key])
    pred = F.coalesce("_season", "_last", F.lit(glob))
    return out.withColumn("prediction", pred).drop("_season", "_last", "_dow")


BASELINES = {
    "baseline_last_value": baseline_last,
    "baseline_mean": baseline_mean,
    "baseline_seasonal_naive": baseline_seasonal,
}
