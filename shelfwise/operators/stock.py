"""Stock sources and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.keys import product_key
from shelfwise.operators.quantiles import grouped_quantiles
from shelfwise.schema import DATE, PRODUCT_KEY, QUANTITY, STOCK, STOCK_KEYWORDS

COVERAGE_QUANTILES = {"median": 0.5, "p75": 0.75, "p90": 0.9}


def detect_stock_column(columns) -> str | None:
    """First keyword (priority order) contained in a lower/trimmed column name."""
    lowered = [(c, c.lower().strip()) for c in columns]
    for kw in STOCK_KEYWORDS:
        for original, low in lowered:
            if kw in low:
                return original
    return None


def with_product_key(df: DataFrame) -> DataFrame:
    return df if PRODUCT_KEY in df.columns else df.withColumn(PRODUCT_KEY, product_key(df))


def estimate_stock(panel: DataFrame, days_of_coverage: float = 10.0,
                   method: str = "mean", as_of=None) -> DataFrame:
    """(product_key, current_stock) = max(1, round_half_even(stat x days)).

    stat: mean | median | p75 | p90 (linear interpolation; unknown -> mean).
    Quantiles are exact (``grouped_quantiles``: no task holds a product's values);
    quantities are never NULL in a panel. ``as_of`` limits the history
    (strict mode: no test-period information).
    """
    df = with_product_key(panel)
    if as_of is not None:
        df = df.where(F.col(DATE) < F.lit(as_of))
    if method in COVERAGE_QUANTILES:
        stats = grouped_quantiles(df, [PRODUCT_KEY], QUANTITY, [COVERAGE_QUANTILES[method]])
        stats = stats.withColumn("stat", F.element_at("quantiles", 1))
    else:
        stats = df.groupBy(PRODUCT_KEY).agg(F.avg(QUANTITY).alias("stat"))
    est = F.greatest(F.lit(1.0), F.bround(F.col("stat") * F.lit(float(days_of_coverage)), 0))
    return stats.select(PRODUCT_KEY, est.alias(STOCK))


def latest_stock(raw: DataFrame, column: str) -> DataFrame:
    """Latest stock value per product of typed rows (latest date; ties by store,
    region, value), missing or unreadable -> 0, floor 0. ``max_by`` is a partial
    aggregate."""
    df = with_product_key(raw)
    value = F.expr(f"try_cast(`{column}` as double)")
    latest = F.max_by(value, F.struct(F.col(DATE), F.col("store_id"), F.col("region"), value))
    return (df.where(F.col(PRODUCT_KEY).isNotNull())
            .groupBy(PRODUCT_KEY)
            .agg(F.greatest(F.coalesce(latest, F.lit(0.0)), F.lit(0.0)).alias(STOCK)))


def stock_per_product(df: DataFrame) -> DataFrame:
    """First non-null stock per product (stock is constant per product)."""
    df = with_product_key(df)
    return df.groupBy(PRODUCT_KEY).agg(F.min(STOCK).alias(STOCK))


def with_stock(df: DataFrame, stock: DataFrame) -> DataFrame:
    """Attach stock by product key (missing -> 0); no-op when already present.

    The stock table has one row per product; AQE broadcasts it when its runtime
    size is under the broadcast threshold and shuffles otherwise.
    """
    if STOCK in df.columns:
        return df
    keyed = with_product_key(df)
    out = keyed.join(stock.select(PRODUCT_KEY, STOCK), PRODUCT_KEY, "left")
    out = out.withColumn(STOCK, F.coalesce(F.col(STOCK), F.lit(0.0)))
    return out if PRODUCT_KEY in df.columns else out.drop(PRODUCT_KEY)


def resolve_stock(panel: DataFrame, raw: DataFrame | None = None,
                  stock_file: DataFrame | None = None, *, days_of_coverage: float = 10.0,
                  method: str = "mean", auto_estimate: bool = True) -> DataFrame:
    """Stock source priority: raw stock column -> stock file -> estimate -> zeros.

    The choice is made at plan time from schemas (plus one bounded existence
    test for the file); the result is (product_key, current_stock, stock_source)
    covering every product of the panel. ``raw``: the rows of ``typed_sales``, so
    that dates, numbers and repaired categories agree with the panel's.
    """
    products = with_product_key(panel).select(PRODUCT_KEY).distinct()

    def cover(stock: DataFrame, label: str) -> DataFrame:
        joined = products.join(stock, PRODUCT_KEY, "left")
        return joined.select(PRODUCT_KEY, F.coalesce(F.col(STOCK), F.lit(0.0)).alias(STOCK),
                             F.lit(label).alias("stock_source"))

    if raw is not None:
        col = detect_stock_column([c for c in raw.columns if c != STOCK] + ([STOCK] if STOCK in raw.columns else []))
        if col:
            return cover(latest_stock(raw, col), f"dataset column: {col}")
    if stock_file is not None:
        matched = not products.join(stock_file, PRODUCT_KEY, "left_semi").isEmpty()
        if matched:
            return cover(stock_file, "stock file")
        if not auto_estimate:
            return cover(stock_file.limit(0), "stock file format mismatch (zeros)")
    if auto_estimate:
        return cover(estimate_stock(panel, days_of_coverage, method),
                     f"estimated ({method}, {days_of_coverage} days)")
    return cover(products.limit(0).withColumn(STOCK, F.lit(0.0)), "no stock data (zeros)")
