"""Command line: the end-to-end run (L4), demand then revenue, reports as CSV.

  python -m shelfwise --sales data/sales.csv --out results/
  python -m shelfwise --sales 'archives/*.zip' --format zip --stock current_stock.csv --out results/
  python -m shelfwise --tpch /root/testdata/sf0.01 --out /tmp/results --models linear_regression

Uses the session of the environment (spark-submit on a cluster); a local
session is created only when none is configured.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from shelfwise.config import PreprocessingConfig, ProjectConfig
from shelfwise.plans.pipeline import run
from shelfwise.session import ensure_checkpoint_dir


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="shelfwise")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--sales", help="sales file(s): CSV, Parquet or zipped CSV glob")
    src.add_argument("--tpch", help="directory of the TPC-H-like tables (test binding)")
    ap.add_argument("--format", default="csv", choices=["csv", "parquet", "zip"])
    ap.add_argument("--stock", help="stock CSV (product_line or Product ID + Category, current_stock)")
    ap.add_argument("--out", required=True, help="output folder for the reports")
    ap.add_argument("--models", default="linear_regression,random_forest,gradient_boosting")
    ap.add_argument("--cv", default="", help="models to cross-validate in time order (comma list)")
    ap.add_argument("--min-history-days", type=int, default=30)
    ap.add_argument("--checkpoint", action="store_true", help="cut lineage at reuse points")
    ap.add_argument("--resume", action="store_true", help="keep stages in the output folder and go on from those that are whole")
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName("shelfwise").getOrCreate()
    ensure_checkpoint_dir(spark)
    sources = None
    if a.tpch:
        from shelfwise.sources.tpch import retail_raw, retail_sources
        raw, sources = retail_raw(spark, a.tpch), retail_sources(spark, a.tpch)
    elif a.format == "zip":
        from shelfwise.sources.files import read_sales_zips
        raw = read_sales_zips(spark, a.sales)
    else:
        from shelfwise.sources.files import read_sales
        raw = read_sales(spark, a.sales, a.format)
    stock = None
    if a.stock:
        from shelfwise.sources.files import read_stock
        stock = read_stock(spark, a.stock)
    cfg = ProjectConfig(preprocessing=PreprocessingConfig(min_history_days=a.min_history_days))
    models = tuple(m for m in a.models.split(",") if m)
    cv = tuple(m for m in a.cv.split(",") if m)
    out = run(raw, cfg, stock_file=stock, models=models, cv_models=cv, out_dir=a.out,
              checkpoint=a.checkpoint, resume=a.resume, sources=sources)
    out["executive_summary"].show(truncate=False)
    out["urgency_summary"].show(truncate=False)


if __name__ == "__main__":
    main()
