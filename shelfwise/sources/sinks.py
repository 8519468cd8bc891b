"""Sinks: engineered table (S4), reports (S5), models and parameters."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.sources.store import replace_table, settle


def write_features(df: DataFrame, path: str, fmt: str = "parquet", rows_per_file: int = 5_000_000,
                   replace: str = "table") -> None:
    """Persist the engineered table partitioned by month (restart point). Rows
    are dealt out by ranges of (date, series), so a month is spread over as many
    tasks as its rows fill, files are sorted, and date filters prune.

    ``replace="table"``: the whole table, written beside the old one and switched in when it is whole.
    ``replace="months"``: the months that ``df`` holds, put in place when the write commits; others stay.
    """
    keys = [c for c in ("date", "store_id", "product_id", "category", "region") if c in df.columns]
    out = df.withColumn("year_month", F.date_format("date", "yyyy-MM"))
    out = out.repartitionByRange(*keys).sortWithinPartitions("year_month", *keys)

    def write(to: str, **options) -> None:
        (out.write.mode("overwrite").options(**options).partitionBy("year_month")
         .option("maxRecordsPerFile", rows_per_file).format(fmt).save(to))

    if replace == "months":
        settle(df.sparkSession, path)
        write(path, partitionOverwriteMode="dynamic")
    elif replace == "table":
        replace_table(df.sparkSession, path, write)
    else:
        raise ValueError(f"replace is {replace!r}; it is 'table' or 'months'")


def write_report(df: DataFrame, path: str, fmt: str = "csv", single_file: bool = False) -> None:
    """Reports are aggregates; ``single_file`` only for tables of bounded size."""
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    try:
        return PipelineModel.load(path)
    except Exception as exc:  # the JVM raises on a missing path
        raise FileNotFoundError(f"Model not found: {path}") from exc


def write_params(spark: SparkSession, params: dict[str, dict], path: str) -> None:
    rows = [(name, json.dumps(p, sort_keys=True, default=str)) for name, p in params.items()]
    spark.createDataFrame(rows, "model string, params string").write.mode("overwrite").json(path)
