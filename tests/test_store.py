"""Replacing tables and resuming runs after a failure."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from shelfwise.config import PreprocessingConfig, ProjectConfig
from shelfwise.operators import recommend as R
from shelfwise.plans import pipeline as P
from shelfwise.sources import store as ST
from shelfwise.sources.files import read_sales
from shelfwise.sources.sinks import write_features

CFG = ProjectConfig(preprocessing=PreprocessingConfig(min_history_days=20))


def rows(spark, days, value):
    return spark.createDataFrame([(dt.date(2022, 1, 1) + dt.timedelta(days=i), f"S{i % 2}", float(value)) for i in range(days)],
                                 "date date, store_id string, x double")


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "features")
    write_features(rows(spark, 40, 1), path)
    broken = rows(spark, 40, 2).withColumn("x", F.when(F.col("date") == "2022-01-20", F.raise_error(F.lit("lost"))).otherwise(F.col("x")))
    for how in ("table", "months"):
        with pytest.raises(Exception, match="lost"):
            write_features(broken, path, replace=how)
        assert ST.read_table(spark, path).agg(F.sum("x"), F.count("*")).first()[:] == (40.0, 40)
    assert os.listdir(tmp_path) == ["features"]
    write_features(rows(spark, 10, 5), path)
    assert ST.read_table(spark, path).agg(F.sum("x"), F.count("*")).first()[:] == (50.0, 10)


def test_a_switch_that_was_cut_off_is_settled(spark, tmp_path):
    path = str(tmp_path / "t")
    write_features(rows(spark, 3, 1), path)
    os.rename(path, path + ".old")  # killed between the two renames
    assert ST.read_table(spark, path).count() == 3 and not os.path.exists(path + ".old")
    os.makedirs(path + ".old")  # killed before the old one was removed
    assert ST.read_table(spark, path).count() == 3 and not os.path.exists(path + ".old")


def test_months_are_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    write_features(rows(spark, 59, 1), path)  # January and February
    write_features(rows(spark, 31, 7), path, replace="months")
    got = {r["year_month"]: r["s"] for r in ST.read_table(spark, path).groupBy("year_month").agg(F.sum("x").alias("s")).collect()}
    assert got == {"2022-01": 217.0, "2022-02": 28.0}
    with pytest.raises(ValueError):
        write_features(rows(spark, 1, 1), path, replace="days")


HEADER = "Date,Store ID,Product ID,Category,Region,Units Sold,Price,Weather Condition,Seasonality\n"


def sales(tmp_path, extra=""):
    text = HEADER + "".join(
        f"{dt.date(2022, 1, 1) + dt.timedelta(days=i)},S1,P{k},Food,North,{5 + (i * k) % 7},{2 + k},{'Sunny' if i % 3 else 'Rainy'},Winter\n"
        for i in range(60) for k in (1, 2)) + extra
    path = tmp_path / "sales.csv"
    path.write_text(text)
    return str(path)


def test_a_failed_run_is_resumed(spark, tmp_path, monkeypatch):
    path, out = sales(tmp_path), str(tmp_path / "out")
    def run():
        got = P.run(read_sales(spark, path), CFG, models=(), out_dir=out, resume=True)
        return {n: sorted(map(str, got[n].collect())) for n in ("recommendations", "model_comparison", "revenue_comparison")}

    real, built = R.recommend_orders, []
    table = ST.RunStore.table
    monkeypatch.setattr(ST.RunStore, "table", lambda self, name, build: table(
        self, name, lambda: built.append(name) or build()))

    def fails(*a, **k):
        raise RuntimeError("driver lost")
    monkeypatch.setattr(P.R, "recommend_orders", fails)
    with pytest.raises(RuntimeError, match="driver lost"):
        run()
    assert built == ["panel", "stock", "features", "scored", "comparison", "orders"]
    monkeypatch.setattr(P.R, "recommend_orders", real)
    built.clear()
    monkeypatch.setattr(P, "typed_sales", fails)  # nothing reads the raw rows again
    first = run()
    assert built == ["orders", "revenue_scored"]
    built.clear()
    assert run() == first and built == []
    assert all(first.values())


def test_other_inputs_or_settings_are_other_stages(spark, tmp_path):
    path, out = sales(tmp_path), str(tmp_path / "out")
    keys = [ST.RunStore(spark, out, [read_sales(spark, path)], {"models": ()}).key for _ in range(2)]
    assert keys[0] == keys[1]
    assert ST.RunStore(spark, out, [read_sales(spark, path)], {"models": ("x",)}).key != keys[0]
    sales(tmp_path, "2022-05-01,S1,P1,Food,North,1,1,Sunny,Winter\n")
    assert ST.RunStore(spark, out, [read_sales(spark, path)], {"models": ()}).key != keys[0]
    with pytest.raises(ValueError, match="out_dir"):
        P.run(read_sales(spark, path), CFG, models=(), resume=True)
