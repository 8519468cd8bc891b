"""Exact quantiles, row numbers and dictionaries without a task that holds a whole group."""

import os
import random
import tempfile

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from shelfwise.operators import gram as G
from shelfwise.operators import models as ML
from shelfwise.operators import ranking as R
from shelfwise.operators.quantiles import grouped_quantiles

QS = [0.0, 0.1, 0.33, 0.5, 0.75, 0.9, 1.0]


def groups():
    rng = np.random.default_rng(2)
    return {
        "normal": rng.normal(0, 1, 500), "wide": 10.0 ** rng.uniform(-300, 300, 300) * rng.choice([-1, 1], 300),
        "ties": np.repeat([1.0, 2.0, 2.5], [400, 1, 3]), "one": np.array([-7.25]), "two": np.array([1.0, 2.0]),
        "close": 1e6 + np.arange(200) * 1e-9, "zeros": np.array([0.0, -0.0, 0.0, 1e-320]), None: rng.integers(-5, 5, 90) * 1.0}


def test_quantiles_equal_numpy(spark):
    rows = [(g, float(v)) for g, vs in groups().items() for v in vs]
    rows += [("normal", None), ("ties", float("nan")), ("only missing", None)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {r["g"]: r for r in grouped_quantiles(df, ["g"], "v", QS).collect()}
    assert set(got) == set(groups())
    for g, vs in groups().items():
        assert got[g]["n"] == len(vs)
        assert got[g]["quantiles"] == pytest.approx(list(np.quantile(vs, QS)), rel=1e-12, abs=1e-300)


def test_quantiles_of_all_rows_and_of_none(spark):
    df = spark.createDataFrame([(float(i % 50),) for i in range(1000)], "v double")
    row = grouped_quantiles(df, (), "v", [0.5, 0.999]).collect()
    assert len(row) == 1 and row[0]["quantiles"] == pytest.approx(list(np.quantile(np.arange(1000) % 50, [0.5, 0.999])))
    assert grouped_quantiles(df.limit(0), (), "v", [0.5]).collect() == []


def test_weighted_quantiles(spark):
    df = spark.createDataFrame([("a", 1.0, 3), ("a", 5.0, 2), ("a", 2.0, 1), ("a", 1.0, 1)], "g string, v double, w int")
    row = grouped_quantiles(df, ["g"], "v", [0.25, 0.5, 0.8], weight="w").first()
    assert row["n"] == 7 and row["quantiles"] == pytest.approx(list(np.quantile([1, 1, 1, 1, 2, 5, 5], [0.25, 0.5, 0.8])))


def test_quantiles_build_no_job_and_no_percentile(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("v"))
    plan = grouped_quantiles(df, (), "v", [0.5])._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan.lower()


def test_row_numbers_with_ties_and_nulls(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "x", "y"])) for _ in range(500)] + [(9, "hot")] * 700
    df = spark.createDataFrame(rows, "k int, s string").repartition(9)
    got = R.number_rows(df, ["k", "s"]).collect()
    assert sorted(r["position"] for r in got) == list(range(1200))
    order = [(r["k"] is not None, r["k"] or 0, r["s"] is not None, r["s"] or "") for r in sorted(got, key=lambda r: r["position"])]
    assert order == sorted(order)
    per = {}
    for r in R.number_rows(df, ["s"], ["k"], "n").collect():
        per.setdefault(r["k"], []).append(r["n"])
    assert all(sorted(v) == list(range(len(v))) for v in per.values()) and set(per) == {None, 1, 2, 3, 9}
    assert R.number_rows(df.limit(0), ["k"]).collect() == []


def test_a_hot_group_is_dealt_over_partitions(spark):
    df = spark.range(20_000).select(F.lit(1).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = R.number_rows(df, ["k"]).groupBy(F.spark_partition_id()).agg(
            F.count("*").alias("n"), F.min("position").alias("low"), F.max("position").alias("high")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r["n"] for r in got) == 20_000 and max(r["n"] for r in got) < 10_000
    assert (min(r["low"] for r in got), max(r["high"] for r in got)) == (0, 19_999)


def test_a_million_categories_encode(spark):
    n = 1_000_000
    df = spark.range(n, numPartitions=8).select(F.concat(F.lit("c"), F.col("id")).alias("c"))
    codes = R.CategoryCodes.fitted(df, ["c"])
    assert codes.sizes == [n] and codes.table.agg(F.count_distinct("code"), F.max("code")).first()[:] == (n, n - 1)
    row = codes.encoder().transform(codes.transform(df.limit(3))).first()
    assert row["c_vec"].size == n and row["c_vec"].numNonzeros() == 1


def test_many_categories_fit(spark):
    n = 5000
    df = spark.range(3 * n, numPartitions=4).select(
        F.concat(F.lit("c"), F.col("id") % n).alias("c"), (F.col("id") % 7).cast("double").alias("label"), F.rand(1).alias("x"))
    prep = ML.fit_prep(df, ["x"], ["c"])
    rows = prep.transform(df).select(ML.FEATURES, "label").persist()
    model = LinearRegression(featuresCol=ML.FEATURES, labelCol="label", regParam=0.1, maxIter=2, standardization=False).fit(rows)
    assert model.coefficients.size == n + 1
    rows.unpersist()
    assert G.prepare(df, ["x"], ["c"])[2].width == n + 1 > G.GRAM_INPUTS
    assert ML.linear_model(df, ["x"], ["c"]) is None


def test_encoding_survives_saving_and_odd_values(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0), (None, 3.0), ("a", 4.0)], "c string, x double").withColumn("d", F.lit(None).cast("string"))
    prep = ML.fit_prep(df, ["x"], ["c", "d"])
    path = os.path.join(tempfile.mkdtemp(prefix="shelfwise-codes-"), "prep")
    prep.write().save(path)
    again = PipelineModel.load(path)
    odd = spark.createDataFrame([("a", 1.0, "z"), ("new", 1.0, None), (None, 1.0, None), ("b", 1.0, None)], "c string, x double, d string")
    for p in (prep, again):
        vectors = {r["c"]: r["c_vec"].toArray().tolist() for r in p.transform(odd).collect()}
        assert vectors == {"a": [1.0, 0.0], "b": [0.0, 1.0], "new": [0.0, 0.0], None: [0.0, 0.0]}
    assert prep.stages[0].slot_names() == ["c_a", "c_b", "d_"]


def test_dictionary_codes(spark):
    df = spark.createDataFrame([("b", 2), ("a", 10), (None, 2), ("a", None)], "c string, d int")
    got = {(r["feature"], r["value"]): r["code"] for r in R.dictionary(df, ["c", "d"]).collect()}
    assert got == {("c", "a"): 0, ("c", "b"): 1, ("d", "10"): 0, ("d", "2"): 1}
    codes = R.dictionary(df, ["c"])
    new = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    assert {r["c"]: r["c_code"] for r in R.encode(new, ["c"], codes).collect()} == {"a": 0, "z": None, None: None}


def test_one_hot_long(spark):
    df = spark.createDataFrame([(1, "b", "u"), (2, "a", None)], "id int, c string, d string")
    got = sorted(map(tuple, R.one_hot_long(df, ["id"], ["c", "d"]).collect()))
    assert got == [(1, "c", "b", 1), (1, "d", "u", 0), (2, "c", "a", 0)]
