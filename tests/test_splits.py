import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import splits as S


def frame(spark, n=100, keys=("S", "P", "C", "R"), per_day=1):
    rows = []
    for i in range(n):
        d = dt.date(2020, 1, 1) + dt.timedelta(days=i // per_day)
        rows.append((d, f"S{i % per_day}", "P", "C", "R", float(i)))
    return spark.createDataFrame(rows, "date date, store_id string, product_id string, category string, region string, quantity double")


def test_split_80_20_ordered(spark):  # F17
    tr, te = S.train_test(S.chrono_split(frame(spark), 0.2))
    assert tr.count() == 80 and te.count() == 20
    assert tr.agg(F.max("date")).first()[0] <= te.agg(F.min("date")).first()[0]


def test_split_reversed_input(spark):  # F18
    df = frame(spark, 10).orderBy(F.desc("date"))
    tr, te = S.train_test(S.chrono_split(df, 0.2))
    assert (tr.count(), te.count()) == (8, 2)
    assert tr.agg(F.max("date")).first()[0] < te.agg(F.min("date")).first()[0]


def test_split_bad_size(spark):  # F19
    with pytest.raises(ValueError):
        S.chrono_split(frame(spark, 10), 1.5)


def test_boundary_inside_a_date_uses_key_order(spark):
    df = frame(spark, 30, per_day=3)  # 10 days x 3 stores
    lab = S.chrono_split(df, 0.3).collect()  # cut = int(30 * 0.7) = 21 -> day 7, stores S0..S2 all train
    assert sum(r["is_train"] for r in lab) == 21
    lab2 = S.chrono_split(df, 0.25).collect()  # cut = 22 -> day 7 S0 train, S1, S2 test
    day7 = {r["store_id"]: r["is_train"] for r in lab2 if r["date"] == dt.date(2020, 1, 8)}
    assert day7 == {"S0": True, "S1": False, "S2": False}
    assert S.chrono_split(df, 0.9).where("is_train").count() == int(30 * (1 - 0.9))  # double arithmetic


def test_split_unchanged_under_repartition(spark):
    df = frame(spark, 90, per_day=3)
    a = sorted(tuple(r) for r in S.chrono_split(df, 0.2).collect())
    b = sorted(tuple(r) for r in S.chrono_split(df.repartition(7), 0.2).collect())
    assert a == b


def test_cv_ranges_match_time_series_split():
    rng = S.cv_ranges(100, 5)
    assert [(r["train_end"], r["val_start"], r["val_end"]) for r in rng] == [
        (20, 20, 36), (36, 36, 52), (52, 52, 68), (68, 68, 84), (84, 84, 100)]
    with pytest.raises(ValueError):
        S.cv_ranges(4, 5)


def test_walk_forward_ranges():
    rng = S.walk_forward_ranges(100, 5, 0.2)  # m = 80, fold = 13
    assert [(r["train_end"], r["val_end"]) for r in rng] == [(13, 26), (26, 39), (39, 52), (52, 65), (65, 78)]


def test_assign_folds_counts(spark):
    df = frame(spark, 100, per_day=2)
    lab, ranges = S.assign_folds(df, "cv", 5)
    for i, r in enumerate(ranges):
        tr, va = S.fold_filter(lab, i)
        assert tr.count() == r["train_end"]
        assert va.count() == r["val_end"] - r["val_start"]


def test_fold_table_dates(spark):
    ft = S.fold_table(frame(spark, 100), "cv", 5).orderBy("fold").collect()
    assert ft[0]["val_first_date"] == dt.date(2020, 1, 21)
    assert ft[-1]["val_last_date"] == dt.date(2020, 4, 9)


def test_kth_row_of_a_date_equals_a_full_sort(spark):
    """Every rank of a date, whatever the ranges its tuples fall into."""
    rows = []
    for s in range(6):
        for p in range(5):
            for c in ("A", "B", None):
                rows.append((dt.date(2020, 1, 2), f"S{s}", f"P{p}", c, "R", 1.0))
    rows += [(dt.date(2020, 1, 1), "S0", "P0", "A", "R", 1.0), (dt.date(2020, 1, 3), "S0", "P0", "A", "R", 1.0)]
    df = spark.createDataFrame(rows, "date date, store_id string, product_id string, category string, region string, quantity double")
    day = sorted((r[1:5] for r in rows if r[0] == dt.date(2020, 1, 2)), key=lambda t: tuple((v is not None, v or "") for v in t))
    for k in (1, 7, 33, 90):
        assert S.kth_in_date(df, dt.date(2020, 1, 2), k).values == (dt.date(2020, 1, 2), *day[k - 1])
    assert sum(r["is_train"] for r in S.chrono_split(df, 0.5).collect()) == int(92 * 0.5)


SERIES_SCHEMA = "date date, store_id string, product_id string, category string, region string, quantity double"
ONE = (dt.date(2020, 1, 1), "S", "P", "C", "R", 1.0)
NULLS = (dt.date(2020, 1, 1), None, "P", "C", "R", 1.0)


@pytest.mark.parametrize("rows,train", [
    ([ONE] * 10, 8),
    ([NULLS] * 6 + [ONE] * 4, 8),
    ([(None, *ONE[1:])] * 3 + [ONE] * 7, 8),
    ([(*ONE[:5], float(i)) for i in range(10)], 8),
    ([ONE] * 3 + [(*ONE[:5], 2.0)] * 7, 8),
])
def test_split_of_tied_and_null_keys(spark, rows, train):
    got = S.chrono_split(spark.createDataFrame(rows, SERIES_SCHEMA).repartition(3), 0.2).collect()
    assert len(got) == len(rows) and sum(r["is_train"] for r in got) == train
    order = lambda r: tuple((v is not None, v or 0) for v in (r["date"], r["store_id"], r["quantity"]))
    assert max(order(r) for r in got if r["is_train"]) <= min(order(r) for r in got if not r["is_train"])
    assert sorted(map(str, (tuple(r)[:6] for r in got))) == sorted(map(str, rows))


def test_split_without_keys(spark):
    got = S.chrono_split(spark.createDataFrame([(dt.date(2020, 1, 1),)] * 5, "date date"), 0.4).collect()
    assert sum(r["is_train"] for r in got) == 3


def test_folds_of_tied_rows(spark):
    lab, ranges = S.assign_folds(spark.createDataFrame([ONE] * 12, SERIES_SCHEMA), "cv", 5)
    counts = [tuple(x.count() for x in S.fold_filter(lab, i)) for i in range(5)]
    assert counts == [(2, 2), (4, 2), (6, 2), (8, 2), (10, 2)] and lab.count() == 12


def test_strict_date_boundary_keeps_days_whole(spark):
    df = frame(spark, 30, per_day=3)
    lab = S.chrono_split(df, 0.25, boundary="date").collect()  # row cut falls inside day 8
    by_day = {}
    for r in lab:
        by_day.setdefault(r["date"], set()).add(r["is_train"])
    assert all(len(v) == 1 for v in by_day.values())
    assert sum(r["is_train"] for r in lab) == 21


@pytest.mark.parametrize("block", [7, 64])
def test_copies_of_a_large_tie_are_made_in_many_tasks(spark, monkeypatch, block):
    monkeypatch.setattr(S, "COPIES", block, raising=False)
    df = spark.range(1000).select(F.lit("a").alias("k"), F.lit(1).alias("v"))
    edges = [S.Boundary(("k", "v"), ("a", 1), n) for n in (301, 640)]
    got = (S.bucket(df, edges).withColumn("task", F.spark_partition_id()).groupBy("fold")
           .agg(F.count("*").alias("n"), F.collect_set("task").alias("tasks")).collect())
    assert {r["fold"]: r["n"] for r in got} == {0: 300, 1: 339, 2: 361}
    assert len({t for r in got for t in r["tasks"]}) > 1
