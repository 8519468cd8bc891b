"""Product key and display label expressions, chosen from the schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def product_key(df: DataFrame) -> Column:
    """``{product}_{category}``; falls back to product, category, then "default".

    A legacy ``product_line`` column is accepted as the key when present.
    """
    cols = set(df.columns)
    if "product_id" in cols and "category" in cols:
        return F.concat_ws("_", F.col("product_id").cast("string"), F.col("category").cast("string"))
    if "product_line" in cols:
        return F.col("product_line").cast("string")
    if "product_id" in cols:
        return F.col("product_id").cast("string")
    if "category" in cols:
        return F.col("category").cast("string")
    return F.lit("default")


def product_label(df: DataFrame) -> Column:
    """``{product} ({category})`` display label with the same fallbacks."""
    cols = set(df.columns)
    if "product_id" in cols and "category" in cols:
        return F.concat(F.col("product_id"), F.lit(" ("), F.col("category"), F.lit(")"))
    if "product_line" in cols:
        return F.col("product_line").cast("string")
    if "product_id" in cols:
        return F.col("product_id").cast("string")
    if "category" in cols:
        return F.col("category").cast("string")
    return F.lit("All Products")
