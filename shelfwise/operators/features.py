"""Feature engineering (P2-P8, P12, W1, W2) as column expressions and windows.

All lag / moving-average windows share one specification
(partition by the series keys, order by day number), so Catalyst plans a single
exchange and a single sort for every history feature. A series holds at most one
row per day after ``daily_panel``, so window partitions are bounded by the
calendar span, whatever the raw skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions import dates as D
from shelfwise.functions.numeric import CLIP_BOUND, clip, fill_zero, finite_or_null
from shelfwise.schema import (CATEGORICAL, DATE, EXCLUDED_FROM_FEATURES, FLAG_COLUMNS,
                              NUMERIC_FEATURES, PRICE, QUANTITY, REVENUE, SERIES, STOCK, UNITS)


def calendar_features(df: DataFrame) -> DataFrame:
    d = F.col(DATE)
    return df.withColumns({
        "day_of_week": D.day_of_week(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "day_of_month": F.dayofmonth(d),
        "is_weekend": D.is_weekend(d),
    })


def flag_features(df: DataFrame) -> DataFrame:
    return df.withColumns({out: F.coalesce(F.col(src) == 1, F.lit(False)).cast("int")
                           for src, out in FLAG_COLUMNS.items() if src in df.columns})


def numeric_features(df: DataFrame) -> DataFrame:
    """Flags plus the five numeric features (absent -> 0.0)."""
    df = flag_features(df)
    return df.withColumns({c: F.lit(0.0) for c in NUMERIC_FEATURES if c not in df.columns})


def with_revenue(df: DataFrame) -> DataFrame:
    cols = set(df.columns)
    if PRICE in cols and QUANTITY in cols:
        return df.withColumn(REVENUE, F.col(PRICE) * F.col(QUANTITY))
    if PRICE in cols and UNITS in cols:
        return df.withColumns({REVENUE: F.col(PRICE) * F.col(UNITS), QUANTITY: F.col(UNITS)})
    out = df.withColumn(REVENUE, F.lit(0.0))
    if QUANTITY not in cols and UNITS in cols:
        out = out.withColumn(QUANTITY, F.col(UNITS))
    return out


def series_window(df: DataFrame) -> Window:
    """History window: per series, by day. A frame without series keys is one
    series, which holds a row per calendar day."""
    keys = [c for c in SERIES if c in df.columns]
    w = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return w.orderBy(D.day_number(F.col(DATE)))


def lag_features(df: DataFrame, lags=(1, 7, 30), mode: str = "rows") -> DataFrame:
    """``lag_n``: n rows back in the series (reference) or exactly n calendar days
    back (strict, NULL when that day has no row)."""
    w = series_window(df)
    q = F.col(QUANTITY)
    if mode == "rows":
        return df.withColumns({f"lag_{n}": F.lag(q, n).over(w) for n in lags})
    return df.withColumns({f"lag_{n}": F.first(q).over(w.rangeBetween(-n, -n)) for n in lags})


def moving_averages(df: DataFrame, windows=(7, 30), include_current: bool = True,
                    mode: str = "rows") -> DataFrame:
    """``ma_n`` = mean of the last n values, NULL until n values exist.

    rows mode: row frame (-(n-1), 0), or (-n, -1) when strict
    (``include_current=False``). calendar mode: the mean daily quantity over the
    n calendar days ending today (yesterday when strict), days without a row
    counting as zero; NULL until the series spans that many days.
    """
    w = series_window(df)
    q = F.col(QUANTITY)
    out = {}
    for n in windows:
        lo, hi = (-(n - 1), 0) if include_current else (-n, -1)
        if mode == "rows":
            frame = w.rowsBetween(lo, hi)
            out[f"ma_{n}"] = F.when(F.count(q).over(frame) == n, F.avg(q).over(frame))
        else:
            frame = w.rangeBetween(lo, hi)
            span = D.day_number(F.col(DATE)) - F.min(D.day_number(F.col(DATE))).over(
                w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
            need = n - 1 if include_current else n
            out[f"ma_{n}"] = F.when(span >= need,
                                    F.coalesce(F.sum(q).over(frame), F.lit(0.0)) / F.lit(float(n)))
    return df.withColumns(out)


# ------------------------------------------------------------------ one-hot


def vocabularies(df: DataFrame, cols) -> dict[str, list[str]]:
    """Sorted distinct values per column: one distinct over (column, value) pairs.

    The values become columns, so they come to the driver; a caller with large
    vocabularies takes ``one_hot_vector`` (sparse, fitted by MLlib).
    """
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return {}
    pair = lambda c: F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v"))
    pairs = df.select(F.inline(F.array(*[pair(c) for c in cols]))).where(F.col("v").isNotNull()).distinct().collect()
    return {c: sorted(r["v"] for r in pairs if r["c"] == c) for c in cols}


def one_hot(df: DataFrame, cols=CATEGORICAL, vocab: dict[str, list[str]] | None = None) -> DataFrame:
    """Wide one-hot: ``{col}_{value}`` int columns, alphabetical; NULL -> all 0."""
    cols = [c for c in cols if c in df.columns]
    vocab = vocab if vocab is not None else vocabularies(df, cols)
    new = {}
    for c in cols:
        for v in vocab.get(c, []):
            new[f"{c}_{v}"] = F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("int"), F.lit(0))
    return df.withColumns(new) if new else df


def one_hot_vector(cols=CATEGORICAL, suffix: str = "_vec"):
    """MLlib stages for the sparse form: alphabetical index, unseen/NULL -> all-zero."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    idx = [f"{c}_idx" for c in cols]
    return [StringIndexer(inputCols=list(cols), outputCols=idx, stringOrderType="alphabetAsc",
                          handleInvalid="keep"),
            OneHotEncoder(inputCols=idx, outputCols=[f"{c}{suffix}" for c in cols],
                          dropLast=True, handleInvalid="keep")]


# ------------------------------------------------------------------ P7 / P8 / P12

NUMERIC_TYPES = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType,
                 T.ByteType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def clean_numeric(df: DataFrame, cols=None) -> DataFrame:
    """+/-Inf and NaN -> NULL -> 0 (lag / MA warm-up included). Strings untouched."""
    cols = numeric_columns(df) if cols is None else cols
    out = {}
    for f in df.schema.fields:
        if f.name in cols:
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
                out[f.name] = fill_zero(F.col(f.name))
            else:
                out[f.name] = F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType))
    return df.withColumns(out)


def clip_columns(df: DataFrame, lo: float = -CLIP_BOUND, hi: float = CLIP_BOUND,
                 cols=None, exclude=(STOCK,)) -> DataFrame:
    cols = numeric_columns(df, exclude) if cols is None else cols
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: clip(F.col(c), lo, hi).cast(types[c]) for c in cols})


def build_features(panel: DataFrame, lags=(1, 7, 30), windows=(7, 30), *,
                   mode: str = "rows", include_current: bool = True,
                   one_hot_form: str = "wide", vocab=None) -> DataFrame:
    """L1: calendar -> numerics -> revenue -> lags -> MAs -> one-hot -> fill -> clip.

    ``one_hot_form``: "wide" (reference layout, a column per value),
    "vector" (categoricals kept as text; the sparse encoding is fitted by the
    model preparation on training rows), or "none". The caller chooses; sizes do not.
    """
    from shelfwise.operators.quality import require_key_features
    df = calendar_features(panel)
    df = numeric_features(df)
    df = with_revenue(df)
    df = lag_features(df, lags, mode)
    df = moving_averages(df, windows, include_current, mode)
    if one_hot_form == "wide":
        df = one_hot(df, CATEGORICAL, vocab)
    df = clean_numeric(df)
    df = clip_columns(df)
    if one_hot_form == "wide":
        require_key_features(df)
    elif one_hot_form == "vector":
        missing = [c for c in ("weather_condition", "seasonality", "region") if c not in df.columns]
        if missing:
            raise ValueError(f"key categorical features missing: {missing}")
    return df


def feature_columns(df: DataFrame, target: str = QUANTITY, leaky: bool = False) -> list[str]:
    """Model inputs: every numeric column except targets, ids, stock, forecast.

    With target ``revenue`` the ``quantity`` column is excluded (revenue is
    price x quantity) unless ``leaky=True`` reproduces the reference.
    """
    excluded = set(EXCLUDED_FROM_FEATURES) | {target, "label", "is_train", "fold", "prediction",
                                               "holiday", "promotion"}
    if target == REVENUE and leaky:
        excluded.discard(QUANTITY)
    return [c for c in numeric_columns(df) if c not in excluded]


def feature_frame(df: DataFrame, target: str = QUANTITY, leaky: bool = False):
    """Cleaned features plus ``label`` (target filled, clipped to [0, 1e6]).

    Returns (frame, feature column names); keys and dates stay on the frame.
    """
    if target not in df.columns:
        raise ValueError(f"no target column {target!r} among the features")
    feats = feature_columns(df, target, leaky)
    out = df.withColumns({c: clip(fill_zero(F.col(c).cast("double"))) for c in feats})
    label = clip(fill_zero(finite_or_null(F.col(target).cast("double"))), 0.0, CLIP_BOUND)
    return out.withColumn("label", label), feats

