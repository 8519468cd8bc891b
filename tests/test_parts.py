"""Large inputs are worked off in parts: the same rows, and the shuffle files of one part at a time."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from shelfwise.plans import pipeline as P
from shelfwise.plans import queries as Q
from shelfwise.sources import parts, tpch

DAY = dt.datetime(2000, 1, 1)


@pytest.fixture
def tables(spark, tmp_path):
    """Keys repeat, are null or have no partner; two suppliers share a nation."""
    n = 240
    lines = [(None if i % 31 == 0 else i % 40, i % 12 if i % 29 else None, i % 5, i % 7, float(i % 9 + 1), float(i % 50), 0.01 * (i % 10),
              "R" if i % 4 else None, DAY + dt.timedelta(days=i % 40)) for i in range(n)]
    lines += lines[:60]
    data = {"lineitem": lines, "orders": [(k % 36, f"{k % 3}-P") for k in range(39)] + [(None, "none")],
            "part": [(k, f"B{k % 3}", f"T{k % 2}", k, 10.0 + k) for k in range(11)] + [(3, "B9", "T0", 1, 1.0), (None, "B", "T", 1, 1.0)],
            "supplier": [(k, k % 3) for k in range(4)], "nation": [(0, "N0", 0), (1, "N1", 1), (2, "N2", 1)],
            "region": [(0, "R0"), (1, "R1")]}
    for name, rows in data.items():
        spark.createDataFrame(rows, tpch.SCHEMAS[name]).repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def bag(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def shuffles(spark):
    """Numbers of the shuffles that have files on disk."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [f.getName() for f in (files.apply(i) for i in range(files.size()))]
    return {n.split("_")[1] for n in names if n.startswith("shuffle_")}


def few_left(spark, before, n=2):
    """At most ``n`` shuffles more than before; files are removed in the background."""
    end = time.time() + 30
    while len(left := shuffles(spark) - before) > n and time.time() < end:
        time.sleep(0.2)
    return len(left) <= n


def test_parts_are_bounded_in_rows_then_in_number():
    assert parts.parts_for(0) == parts.parts_for(parts.PART_ROWS) == 1
    assert parts.parts_for(parts.PART_ROWS + 1) == 2
    assert parts.parts_for(10 * parts.MAX_PARTS * parts.PART_ROWS) == parts.MAX_PARTS


def test_joined_rows_are_the_same_in_parts_and_leave_no_shuffle_files(spark, tables, monkeypatch):
    monkeypatch.setattr(tpch, "GEO_ROWS", 0)
    t = {name: tpch.table(spark, tables, name) for name in tpch.SCHEMAS if name != "events"}
    direct = (t["lineitem"].join(t["orders"], F.expr("l_orderkey = o_orderkey")).join(t["part"], F.expr("l_partkey = p_partkey"))
              .join(t["supplier"], F.expr("l_suppkey = s_suppkey")).join(t["nation"], F.expr("s_nationkey = n_nationkey"))
              .join(t["region"], F.expr("n_regionkey = r_regionkey")))
    for size, n in ((10 ** 6, 1), (100, 3)):
        monkeypatch.setattr(parts, "PART_ROWS", size)
        assert parts.parts_for(t["lineitem"].count()) == n
        before = shuffles(spark)
        got = tpch.sales_lines(spark, tables)
        assert few_left(spark, before)  # those of the two counts
        assert bag(got) == bag(direct.select(*got.columns)) and got.count() > 0
    assert spark.conf.get(parts.CLEANUP) == "false"


@pytest.mark.parametrize("how", [dict(), dict(min_days=5, count="distinct_days"),
                                 dict(min_days=20, columns=["date", "product_id", "quantity"])])
def test_panel_is_the_same_in_parts(spark, tables, monkeypatch, how):
    raw = tpch.retail_raw(spark, tables).cache()
    raw = raw.withColumn("category", F.when(F.col("date").isNotNull() & (F.dayofmonth("date") % 13 != 0), F.col("category")))
    whole = bag(P.clean_panel(raw, **how))
    monkeypatch.setattr(parts, "PART_ROWS", -(-raw.count() // 3))
    got = P.clean_panel(raw, **how, stored="columns" in how)
    assert bag(got) == whole and whole
    assert len({f.rsplit("/", 2)[1] for f in got.inputFiles()}) == 3


def test_history_query_holds_one_part_of_shuffles(spark, tables, monkeypatch):
    """The joins, the panel and the history filter of all rows lay on disk together."""
    monkeypatch.setattr(Q, "CFG", Q.replace(Q.CFG, preprocessing=Q.replace(Q.CFG.preprocessing, min_history_days=3)))
    rows = {}
    for size in (10 ** 6, 150):
        monkeypatch.setattr(parts, "PART_ROWS", size)
        for name in ("filter_history", "filter_history_days"):
            Q._CACHE.clear()
            before = shuffles(spark)
            rows.setdefault(name, []).append(bag(Q.SQL_QUERIES[name](spark, tables)))
            if size == 150:  # those of the three counts and of the category pairs
                assert few_left(spark, before, 5)
    Q._CACHE.clear()
    assert all(a == b and a for a, b in rows.values())
