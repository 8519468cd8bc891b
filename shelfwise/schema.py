"""Column vocabulary shared by all operators.

Raw files use human headers ("Units Sold"); on read they are normalised to
snake_case (``normalise_name``) so every operator works on one vocabulary.
"""

from __future__ import annotations

# The raw headers the reference requires.
REQUIRED_RAW_COLUMNS = frozenset({
    "Date", "Category", "Units Sold", "Store ID", "Product ID", "Region",
    "Price", "Weather Condition", "Seasonality",
})

DATE_TEXT = "date_text"      # raw, unparsed date string
DATE = "date"                # parsed DateType
SERIES = ("store_id", "product_id", "category", "region")
DIMS = (DATE,) + SERIES
QUANTITY = "quantity"
UNITS = "units_sold"
PRICE = "price"
REVENUE = "revenue"
STOCK = "current_stock"
PRODUCT_KEY = "product_key"
PRODUCT_LINE = "product_line"

# Optional numerics averaged in the daily panel, the five numeric
# model features, the binary flags, and the one-hot encoded categoricals
# (key features first).
OPTIONAL_NUMERIC = ("inventory_level", "units_ordered", "demand_forecast",
                    "discount", "competitor_pricing")
NUMERIC_FEATURES = ("inventory_level", "units_ordered", "price", "discount",
                    "competitor_pricing")
FLAG_COLUMNS = {"holiday": "is_holiday", "promotion": "is_promotion"}
KEY_CATEGORICAL = ("weather_condition", "seasonality", "region")
CATEGORICAL = KEY_CATEGORICAL + ("store_id", "product_id", "category")
CALENDAR = ("day_of_week", "month", "quarter", "day_of_month", "is_weekend")

# Columns never used as model inputs (targets, identifiers, stock,
# the precomputed forecast).
EXCLUDED_FROM_FEATURES = ("quantity", "revenue", "current_stock", "product_id",
                          "category", "store_id", "region", "weather_condition",
                          "seasonality", "demand_forecast")

# Stock-column keywords in priority order.
STOCK_KEYWORDS = ("inventory", "stock", "current_stock", "on_hand",
                  "quantity_on_hand", "units_in_stock", "available_stock")


def normalise_name(header: str) -> str:
    """"Units Sold" -> "units_sold"; the raw "Date" text becomes ``date_text``."""
    name = header.strip().lower().replace(" ", "_")
    return DATE_TEXT if name == "date" else name

