"""Validation and cleaning.

Pipeline order (coerce before clamping, see README): parse_date -> coerce_types
-> fix_category (together ``typed_sales``) -> impute -> dedup -> clamp_negative
(together ``tidy_sales``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.dates import parse_date
from shelfwise.schema import (DATE, DATE_TEXT, PRICE, QUANTITY, REQUIRED_RAW_COLUMNS,
                              SERIES, UNITS, normalise_name)
from shelfwise.session import cut_lineage

# ---------------------------------------------------------------- V1 / V11 / V12


def require_columns(df: DataFrame | None, cols=REQUIRED_RAW_COLUMNS) -> None:
    """Error on a missing/empty frame or missing columns (raw or snake names)."""
    if df is None or not df.columns or df.isEmpty():
        raise ValueError("sales rows: None or empty, nothing to check")
    have = {normalise_name(c) for c in df.columns}
    missing = sorted(c for c in cols if normalise_name(c) not in have)
    if missing:
        raise ValueError(f"sales rows: missing required columns {missing}; found {sorted(df.columns)}")


def guard_not_empty(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what}: no rows")
    return df


def guard_test_size(test_size: float) -> None:
    if not 0 < test_size < 1:
        raise ValueError(f"test_size {test_size} lies outside (0, 1)")


def guard_no_nan(df: DataFrame, col: str = "prediction") -> None:
    """NaN/NULL predictions are an error (one aggregate pass)."""
    bad = df.select(F.count_if(F.col(col).isNull() | F.isnan(col)).alias("n")).first()["n"]
    if bad:
        raise ValueError(f"{bad} predictions are NaN or NULL")


def require_key_features(df: DataFrame) -> None:
    """Engineered weather/seasonality/region features must exist (exact names)."""
    for prefix in ("weather_condition", "seasonality", "region"):
        if not any(c.startswith(prefix + "_") for c in df.columns):
            raise ValueError(f"no encoded {prefix} columns; is the raw column empty?")


# ---------------------------------------------------------------- V2 leakage audit

# Risk names and the advice attached to them.
RISK_ADVICE = {
    "inventory_negative_values": "Review feature temporal semantics: ensure all features are available at prediction time.",
    "inventory_temporal_correlation": "Consider excluding 'Inventory Level' if it represents end-of-day values, or transform to start-of-day values.",
    "units_ordered_negative_values": "Review feature temporal semantics: ensure all features are available at prediction time.",
    "units_ordered_future_pattern": "Consider excluding 'Units Ordered' if it represents future orders to be placed.",
}
CORRELATION_THRESHOLD = 0.7


def audit_leakage(panel: DataFrame, check_inventory: bool = True,
                  check_units_ordered: bool = True) -> DataFrame:
    """Long-form audit: (risk, triggered 0/1, measure, recommendation).

    Inventory(t) is paired with quantity(t+1) within each series (``lead``), one
    shuffle on the series keys; everything else is one global aggregate.
    """
    cols = set(panel.columns)
    checks: list[tuple[str, Column, Column]] = []
    df = panel
    if check_inventory and "inventory_level" in cols:
        inv = F.col("inventory_level")
        checks.append(("inventory_negative_values", F.min(inv) < 0, F.min(inv)))
        if QUANTITY in cols:
            keys = [c for c in SERIES if c in cols]
            w = Window.partitionBy(*keys).orderBy(DATE)
            df = df.withColumn("_next_q", F.lead(QUANTITY).over(w))
            x, y = F.col("inventory_level"), F.col("_next_q")
            both = F.col("_next_q").isNotNull() & inv.isNotNull()
            xs, ys = F.when(both, x), F.when(both, y)
            corr = F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))
            checks.append(("inventory_temporal_correlation",
                           F.coalesce(corr > CORRELATION_THRESHOLD, F.lit(False)), corr))
    if check_units_ordered and "units_ordered" in cols:
        uo = F.col("units_ordered")
        checks.append(("units_ordered_negative_values", F.min(uo) < 0, F.min(uo)))
        if QUANTITY in cols:
            every = F.min(F.coalesce(uo >= F.col(QUANTITY), F.lit(False)).cast("int"))
            checks.append(("units_ordered_future_pattern", every == 1, every.cast("double")))
    if not checks:
        schema = "risk string, triggered int, measure double, recommendation string"
        return panel.sparkSession.createDataFrame([], schema)
    aggs = []
    for i, (_, flag, measure) in enumerate(checks):
        aggs += [F.coalesce(flag, F.lit(False)).cast("int").alias(f"t{i}"),
                 measure.cast("double").alias(f"m{i}")]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(name).alias("risk"), F.col(f"t{i}").alias("triggered"),
                              F.col(f"m{i}").alias("measure"))
                     for i, (name, _, _) in enumerate(checks)])
    out = one.select(F.inline(rows))
    advice = F.create_map(*[x for k, v in RISK_ADVICE.items() for x in (F.lit(k), F.lit(v))])
    return out.withColumn("recommendation",
                          F.when(F.col("triggered") == 1, advice[F.col("risk")]))


# ---------------------------------------------------------------- V3 / V4


def category_pairs(df: DataFrame) -> DataFrame:
    """Rows per (product, category), NULLs excluded: a fixed-width hash
    aggregate combined map-side (a hot product collapses before the shuffle).
    Shared by V3 and V4, so one exchange serves both in a single plan."""
    return (df.where(F.col("product_id").isNotNull() & F.col("category").isNotNull())
            .groupBy("product_id", "category").agg(F.count(F.lit(1)).alias("_c")))


def inconsistent_products(df: DataFrame) -> DataFrame:
    """Products seen under more than one category (NULL products ignored)."""
    return (category_pairs(df).groupBy("product_id")
            .agg(F.count(F.lit(1)).alias("n_categories"))
            .where(F.col("n_categories") > 1))


def modal_category(pairs: DataFrame) -> DataFrame:
    """Most frequent category of each inconsistent product; ties -> smallest,
    chosen on the product x category table."""
    best = F.min_by("category", F.struct((-F.col("_c")).alias("neg"), F.col("category").alias("cat")))
    return (pairs.groupBy("product_id")
            .agg(best.alias("_modal"), F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > 1)
            .select("product_id", "_modal"))


MODAL_BROADCAST_ROWS = 1_000_000


def fix_category(df: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Rewrite every row of an inconsistent product to its modal category
    (including rows whose category was missing).

    The modal table (one row per inconsistent product) is computed first, by
    its own job, so that the rows' plan holds their source once and no exchange
    on the product; it is broadcast if counted to be at most
    MODAL_BROADCAST_ROWS, otherwise Spark joins (and splits skewed products).
    """
    modal = cut_lineage(modal_category(category_pairs(df) if pairs is None else pairs))
    n = modal.count()
    if not n:
        return df
    out = df.join(F.broadcast(modal) if n <= MODAL_BROADCAST_ROWS else modal, "product_id", "left")
    return out.withColumn("category", F.coalesce("_modal", "category")).select(*df.columns)


# ---------------------------------------------------------------- V5 - V9

CRITICAL = ("product_id", "category", UNITS)


def missing_counts(df: DataFrame) -> DataFrame:
    """(column_name, n_missing) for the critical columns, one aggregate pass."""
    cols = [c for c in CRITICAL if c in df.columns]
    cols += [c for c in (DATE_TEXT, DATE) if c in df.columns][:1]
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_missing")) for c in cols])
    return one.select(F.inline(rows))


def impute(df: DataFrame) -> DataFrame:
    """Missing units -> 0; rows without product or category are dropped."""
    out = df.withColumn(UNITS, F.coalesce(F.col(UNITS), F.lit(0.0))) if UNITS in df.columns else df
    subset = [c for c in ("product_id", "category") if c in df.columns]
    return out.dropna(subset=subset) if subset else out


def dedup(df: DataFrame) -> DataFrame:
    """Exact duplicate rows removed (NULLs compare equal)."""
    return df.dropDuplicates()


def clamp_negative(df: DataFrame, cols=(UNITS, PRICE)) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.when(F.col(c) < 0, F.lit(0.0)).otherwise(F.col(c)) for c in present})


def _to_number(c: str, dtype) -> Column:
    """Text -> double with unparseable text -> 0 (NULL stays NULL: V6 owns it)."""
    col = F.col(c)
    if isinstance(dtype, T.StringType):
        num = F.expr(f"try_cast(`{c}` as double)")
        return F.when(col.isNull(), F.lit(None).cast("double")).otherwise(F.coalesce(num, F.lit(0.0)))
    num = col.cast("double")
    return F.when(F.isnan(num) | (F.abs(num) == float("inf")), F.lit(None).cast("double")).otherwise(num)


def coerce_types(df: DataFrame) -> DataFrame:
    """Ids to text; units, price and optional numerics to double."""
    types = {f.name: f.dataType for f in df.schema.fields}
    changes = {c: F.col(c).cast("string") for c in ("product_id", "category", "store_id") if c in types}
    for c in (UNITS, PRICE, "inventory_level", "units_ordered", "demand_forecast",
              "discount", "competitor_pricing"):
        if c in types:
            changes[c] = _to_number(c, types[c])
    for c in ("holiday", "promotion"):
        if c in types:
            changes[c] = F.expr(f"try_cast(`{c}` as int)")
    return df.withColumns(changes)


def with_dates(df: DataFrame) -> DataFrame:
    """``date_text`` -> ``date``; text that is no date becomes NULL."""
    if DATE_TEXT in df.columns:
        return df.withColumn(DATE, parse_date(DATE_TEXT)).drop(DATE_TEXT)
    if DATE in df.columns:
        return df
    raise ValueError("Date column not found: sales rows need 'Date'")


def guard_dates(df: DataFrame) -> None:
    """Error if there are rows but none has a date (a bounded check)."""
    if not df.isEmpty() and df.where(F.col(DATE).isNotNull()).isEmpty():
        raise ValueError("Failed to parse any Date; the formats of functions.dates are accepted")


def parse_dates(df: DataFrame) -> DataFrame:
    """``with_dates``, and an error if no row's date parses."""
    out = with_dates(df)
    if DATE_TEXT in df.columns:
        guard_dates(out)
    return out


def typed_sales(df: DataFrame) -> DataFrame:
    """Raw rows with dates, types and repaired categories: what the panel, the
    stock column and the quality report all start from."""
    return fix_category(coerce_types(with_dates(df)))


def tidy_sales(df: DataFrame) -> DataFrame:
    """Typed rows imputed, deduplicated and clamped; rows without a date survive
    here and are dropped by the daily panel's key filter (as in the reference)."""
    return clamp_negative(dedup(impute(df)))


def clean_sales(df: DataFrame, check_dates: bool = True) -> DataFrame:
    """The full cleaning chain."""
    return tidy_sales(typed_sales(parse_dates(df) if check_dates else df))


# ---------------------------------------------------------------- V10


def quality_report(raw: DataFrame) -> DataFrame:
    """Long-form (metric, value) quality report over raw (text) rows, in two passes.

    One aggregate per (product, category) holds the input defects, from which
    their totals, the inconsistent products and the modal categories follow;
    the second pass groups the repaired rows to count duplicates and negatives.
    """
    typed = {f.name: f.dataType for f in raw.schema.fields}
    none = F.lit(0).cast("bigint")

    def bad_number(c):
        text = c in typed and isinstance(typed[c], T.StringType)
        return F.count_if(F.col(c).isNotNull() & F.expr(f"try_cast(`{c}` as double)").isNull()) if text else none

    def missing(c):
        return F.count_if(F.col(c).isNull()) if c in typed else none
    defects = {
        "input_rows": F.count(F.lit(1)),
        "missing_product_id": missing("product_id"),
        "missing_category": missing("category"),
        "missing_units_sold": missing(UNITS),
        "missing_date": F.count_if(F.col(DATE_TEXT if DATE_TEXT in typed else DATE).isNull()),
        "bad_dates": (F.count_if(F.col(DATE_TEXT).isNotNull() & parse_date(DATE_TEXT).isNull())
                      if DATE_TEXT in typed else none),
        "units_sold_converted": bad_number(UNITS),
        "price_converted": bad_number(PRICE),
    }
    ids = [F.col(c).cast("string").alias(c) for c in ("product_id", "category")]
    table = cut_lineage(raw.groupBy(*ids).agg(*[v.alias(k) for k, v in defects.items()]))
    pairs = (table.where(F.col("product_id").isNotNull() & F.col("category").isNotNull())
             .withColumnRenamed("input_rows", "_c").select("product_id", "category", "_c"))
    totals = table.agg(*[F.coalesce(F.sum(k), none).alias(k) for k in defects])
    incons = (pairs.groupBy("product_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
              .agg(F.count(F.lit(1)).alias("inconsistent_products")))

    kept = impute(fix_category(coerce_types(with_dates(raw)), pairs))
    groups = kept.groupBy(*kept.columns).agg(F.count(F.lit(1)).alias("_n"))

    def negatives(c):
        return F.count_if(F.col(c) < 0) if c in kept.columns else none
    rows = groups.agg(
        F.coalesce(F.sum(F.col("_n") - 1), none).alias("duplicates_removed"), F.count(F.lit(1)).alias("clean_rows"),
        negatives(UNITS).alias("negative_units_fixed"), negatives(PRICE).alias("negative_price_fixed"))

    def long(one: DataFrame) -> DataFrame:
        return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("bigint").alias("value"))
                                             for c in one.columns])))
    return long(totals).unionByName(long(incons)).unionByName(long(rows))
