"""shelfwise: retail demand forecasting and replenishment on Spark DataFrames.

Every operator is a lazy ``DataFrame -> DataFrame`` transformation; actions only
happen for bounded driver-side values (row counts, split boundaries, small
vocabularies) and are called out where they occur.
"""

__all__ = ["config", "schema"]
