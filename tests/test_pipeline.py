import os
import tempfile

from pyspark.sql import functions as F

from shelfwise.config import PreprocessingConfig, ProjectConfig
from shelfwise.plans import pipeline as P
from shelfwise.sources.files import stock_from_frame
from shelfwise.sources.sinks import write_features
from shelfwise.sources.tpch import retail_raw, stock_file
from tests.conftest import SF_SMALL


def test_preprocess_and_write(spark):
    cfg = ProjectConfig(preprocessing=PreprocessingConfig(min_history_days=5))
    labelled, stock = P.preprocess(retail_raw(spark, SF_SMALL), cfg, one_hot_form="wide")
    n = labelled.count()
    tr = labelled.where("is_train").count()
    assert tr == int(n * 0.8)
    assert {"lag_30", "ma_7", "current_stock", "weather_condition_1-URGENT"} <= set(labelled.columns)
    assert stock.where(F.col("current_stock") < 0).count() == 0
    path = os.path.join(tempfile.mkdtemp(prefix="shelfwise-feat-"), "features")
    write_features(labelled, path)
    assert spark.read.parquet(path).count() == n


def test_run_end_to_end(spark):
    cfg = ProjectConfig(preprocessing=PreprocessingConfig(min_history_days=5))
    raw = retail_raw(spark, SF_SMALL)
    default, _ = P.preprocess(raw, cfg)
    assert not any(c.startswith("weather_condition_") for c in default.columns)
    out = P.run(raw, cfg, stock_file=stock_from_frame(stock_file(spark, SF_SMALL)),
                models=("linear_regression",), cv_models=("linear_regression",),
                out_dir=tempfile.mkdtemp(prefix="shelfwise-run-"))
    cmp = {r["model"]: r for r in out["model_comparison"].collect()}
    assert set(cmp) == {"baseline_last_value", "baseline_mean", "baseline_seasonal_naive", "linear_regression"}
    rec = out["recommendations"].collect()
    assert rec and all(r["recommended_order"] >= 0 for r in rec)
    summ = out["executive_summary"].first()
    assert summ["n_products"] == len(rec)
    assert out["cv_summary"].count() == 1
    assert out["revenue_metrics"].first()["total_revenue_true"] > 0


def test_checkpoint_reuse_point(spark):
    from shelfwise.session import ensure_checkpoint_dir
    assert ensure_checkpoint_dir(spark)
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    cut = P.reuse(df, checkpoint=True)
    assert cut.agg(F.sum("x")).first()[0] == 9900
    assert "LogicalRDD" in cut._jdf.queryExecution().logical().toString()
