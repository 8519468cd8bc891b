"""Chronological position without a global sort (W4, T1, T2/T3 ranges).

Row position is defined by the total order (date, store, product, category,
region, then the other columns). Instead of numbering every row (a global sort
through one partition), we:

1. count rows per date (partial aggregate; the result is bounded by the
   calendar span) and take a running sum over that small table;
2. for each boundary position, find the key tuple of the row there: the
   date's rows are counted per tuple, the tuples are range-partitioned, and only
   the one range that holds the position is ranked;
3. label every row with a pure predicate: ``(date, keys) >= boundary``.

Rows that agree in every column are interchangeable: if a boundary falls inside
such a group, its copies are counted and dealt out by number, in blocks of
COPIES that are spread over tasks. NULLs are values of the order (first), in
dates and keys alike.

Only the boundary tuples reach the driver. The labelled frame is a narrow
projection of the input: no shuffle of the data itself.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add, or_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.quality import guard_test_size
from shelfwise.operators.ranking import number_rows
from shelfwise.schema import DATE, SERIES

ATOMIC = (T.StringType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.BinaryType)
COPIES = 1 << 16


@dataclass(frozen=True)
class Boundary:
    """The row at a position: its values in ``cols``, and its number (from 1) among the equal rows."""
    cols: tuple[str, ...]
    values: tuple
    number: int = 1


def order_keys(df: DataFrame) -> list[str]:
    """Within-date order by the series keys; a frame without them is ordered by its other columns."""
    return [c for c in SERIES if c in df.columns] or all_keys(df)


def all_keys(df: DataFrame) -> list[str]:
    """The series keys, then every other atomic column by name."""
    keys = [c for c in SERIES if c in df.columns]
    return keys + sorted(f.name for f in df.schema.fields
                         if f.name != DATE and f.name not in keys and isinstance(f.dataType, ATOMIC))


def date_counts(df: DataFrame) -> DataFrame:
    """(date, n, before): rows per date and rows on earlier dates.

    The window runs over the per-date table only (one row per calendar day).
    """
    dc = df.groupBy(DATE).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy(DATE).rowsBetween(Window.unboundedPreceding, -1)
    return dc.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)))


def total_rows(dc: DataFrame) -> int:
    return int(dc.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])


def _covering(positions: list[int]) -> Column:
    """Date-table rows whose position range [before, before + n) holds any position."""
    return any_of([(F.col("before") <= F.lit(p)) & (F.lit(p) < F.col("before") + F.col("n"))
                   for p in positions])


def locate(df: DataFrame, dc: DataFrame, positions: list[int]) -> list[Boundary | None]:
    """For each 0-based position, the boundary of the row there (None past the end).

    One job over the (small) date table returns only the covering dates; the
    row inside each such date is found by ``kth_in_date``.
    """
    pos = sorted(set(p for p in positions if p >= 0))
    result: dict[int, Boundary | None] = {p: None for p in pos}
    if pos:
        for row in dc.where(_covering(pos)).collect():
            for p in pos:
                if row["before"] <= p < row["before"] + row["n"]:
                    result[p] = kth_in_date(df, row[DATE], p - row["before"] + 1)
    return [result.get(p) for p in positions]


def kth_in_date(df: DataFrame, d, k: int) -> Boundary:
    """The k-th (1-based) row of date ``d`` in key order, by the series keys and,
    where several rows share those, by all columns."""
    day = df.where(F.col(DATE).eqNullSafe(F.lit(d).cast(df.schema[DATE].dataType)))
    keys = order_keys(df)
    values, number, copies = _kth_tuple(day, keys, k)
    if copies > 1 and len(all_keys(df)) > len(keys):
        keys = all_keys(df)
        values, number, copies = _kth_tuple(day, keys, k)
    return Boundary((DATE, *keys), (d, *values), number if copies > 1 else 1)


def _kth_tuple(day: DataFrame, keys: list[str], k: int) -> tuple[tuple, int, int]:
    """Key tuple that holds rank ``k``, the rank inside its rows, and their count.

    Rows are counted per tuple (partial aggregate), the tuples dealt out by
    ranges, and the ranges' counts added up; only the range that holds the rank
    is walked, so no task sees more than one range.
    """
    if not keys:
        return (), k, day.count()
    counts = day.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    parts = int(day.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # persisted, so that both passes see the same ranges
    ranged = (counts.repartitionByRange(parts, *keys).withColumn("_range", F.spark_partition_id())
              .persist(StorageLevel.MEMORY_AND_DISK))
    before = 0
    for r in sorted(ranged.groupBy("_range").agg(F.sum("_n").alias("n")).collect(), key=lambda r: r["_range"]):
        if before + r["n"] >= k:
            break
        before += r["n"]
    w = Window.partitionBy("_range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row = (ranged.where(F.col("_range") == r["_range"]).withColumn("_upto", F.sum("_n").over(w))
           .where((F.col("_upto") >= k - before) & (F.col("_upto") - F.col("_n") < k - before)).first())
    ranged.unpersist()
    return tuple(row[c] for c in keys), k - before - (row["_upto"] - row["_n"]), row["_n"]


def _tuples(df: DataFrame, b: Boundary) -> tuple[Column, Column]:
    """A row's values and the boundary's as structs: these compare NULLs as values."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return (F.struct(*[F.col(c).alias(c) for c in b.cols]),
            F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(b.cols, b.values, strict=True)]))


def at_or_after(df: DataFrame, boundary: Boundary | None) -> Column:
    """Predicate: the row's tuple is past the boundary's, or equal where the boundary is its first copy."""
    if boundary is None:
        return F.lit(False)
    row, edge = _tuples(df, boundary)
    return row >= edge if boundary.number == 1 else row > edge


def _numbered(groups: DataFrame, cols: list[str]) -> DataFrame:
    """``cols`` and ``_copy``: one row per number from ``_first`` to ``_end``, made in blocks of COPIES."""
    tasks = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = lambda c: F.floor(F.col(c) / COPIES)
    spread = (groups.withColumn("_block", F.explode(F.sequence(block("_first"), block("_end"))))
              .repartition(tasks, "_block"))  # a given number, so that AQE doesn't join the blocks again
    start = F.col("_block") * COPIES
    return spread.select(*cols, F.explode(F.sequence(
        F.greatest("_first", start), F.least(F.col("_end"), start + (COPIES - 1)))).alias("_copy"))


def bucket(df: DataFrame, boundaries: list[Boundary | None], name: str = "fold") -> DataFrame:
    """Number of boundaries each row is at or past (0 .. len(boundaries))."""
    if not boundaries:
        return df.withColumn(name, F.lit(0))
    passed = reduce(add, [at_or_after(df, b).cast("int") for b in boundaries])
    inside: dict[tuple, list[int]] = {}
    for b in boundaries:
        if b is not None and b.number > 1:
            inside.setdefault((b.cols, b.values), []).append(b.number)
    if not inside:
        return df.withColumn(name, passed)
    # groups of equal rows with a boundary inside: count the copies, deal them out again by number
    equal = {key: (lambda row, edge: row == edge)(*_tuples(df, Boundary(*key))) for key in inside}
    out = df.where(~any_of(list(equal.values()))).withColumn(name, passed)
    for key, numbers in inside.items():
        extra = reduce(add, [(F.col("_copy") >= F.lit(n)).cast("int") for n in numbers])
        copies = (df.where(equal[key]).withColumn(name, passed).groupBy(*df.columns, name)
                  .agg(F.count(F.lit(1)).alias("_n"))
                  .withColumn("_end", F.sum("_n").over(Window.partitionBy(*key[0]).orderBy(F.xxhash64(*df.columns))))
                  .withColumn("_first", F.col("_end") - F.col("_n") + 1))
        copies = _numbered(copies, [*df.columns, name])
        out = out.unionByName(copies.withColumn(name, F.col(name) + extra).drop("_copy"))
    return out


def split_position(n: int, test_size: float) -> int:
    """First test position: int(n * (1 - test_size)) in double arithmetic."""
    return int(n * (1 - test_size))


def chrono_split(df: DataFrame, test_size: float = 0.2, boundary: str = "rows") -> DataFrame:
    """Adds ``is_train``; the first ``int(n*(1-test_size))`` rows in
    (date, keys) order are train. ``boundary="date"`` (strict) moves the whole
    boundary date to test so no day is split."""
    guard_test_size(test_size)
    b = boundary_row(df, test_size)
    if boundary == "date":
        return df.withColumn("is_train", ~at_or_after(df, Boundary(b.cols[:1], b.values[:1])))
    return bucket(df, [b], "is_train").withColumn("is_train", F.col("is_train") == 0)


def boundary_row(df: DataFrame, test_size: float) -> Boundary:
    """The first test row, found with one job on the date table (cut = floor(n *
    (1 - test_size)) evaluated in Spark, same double arithmetic as ``int``)
    plus the search inside that date."""
    dc = date_counts(df)
    total = F.sum("n").over(Window.partitionBy())
    cut = F.floor(total.cast("double") * F.lit(1 - test_size)).cast("long")
    rows = (dc.withColumns({"_cut": cut, "_total": total})
            .where(((F.col("before") <= F.col("_cut")) & (F.col("_cut") < F.col("before") + F.col("n")))
                   | (F.col("_cut") <= 0))
            .limit(1).collect())
    if not rows or rows[0]["_cut"] <= 0:
        raise ValueError(f"with a test share of {test_size} no row is left to train on")
    r = rows[0]
    return kth_in_date(df, r[DATE], r["_cut"] - r["before"] + 1)


def chronological(df: DataFrame) -> DataFrame:
    """O1: total chronological order for sinks (range-partitioned sort; the
    sampled bounds split a hot date because the keys make rows distinct)."""
    return df.orderBy(DATE, *order_keys(df))


def row_positions(df: DataFrame) -> DataFrame:
    """O1 as numbers: ``position`` of every row, from 0, in (date, keys) order, NULLs first. Rows that agree in
    the order stand next to each other in any order."""
    return number_rows(df, [DATE, *order_keys(df)])


def train_test(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (labelled.where(F.col("is_train")).drop("is_train"),
            labelled.where(~F.col("is_train")).drop("is_train"))


# ------------------------------------------------------------------ fold ranges


def cv_ranges(n: int, n_splits: int = 5) -> list[dict]:
    """Expanding time-series CV: fold = n // (k+1); fold i validates
    [n - (k-i)*fold, +fold) and trains on everything before."""
    if n_splits < 2:
        raise ValueError(f"n_splits must be 2 or more, got {n_splits}")
    if n <= n_splits:
        raise ValueError(f"{n} rows are too few for {n_splits} expanding folds")
    fold = n // (n_splits + 1)
    out = []
    for i in range(n_splits):
        start = n - (n_splits - i) * fold
        out.append({"fold": i, "train_start": 0, "train_end": start,
                    "val_start": start, "val_end": start + fold})
    return out


def walk_forward_ranges(n: int, n_splits: int = 5, test_size: float = 0.2) -> list[dict]:
    """Walk-forward: m = int(n*(1-test_size)), fold = m // (k+1), train
    [0, fold*(i+1)), test the next fold; the remainder is unused."""
    if n_splits < 2:
        raise ValueError(f"n_splits must be 2 or more to walk forward, got {n_splits}")
    m = split_position(n, test_size)
    if m <= n_splits:
        raise ValueError(f"{m} rows before the test part are too few for {n_splits} folds")
    fold = m // (n_splits + 1)
    out = []
    for i in range(n_splits):
        end = fold * (i + 1)
        if end >= m:
            break
        out.append({"fold": i, "train_start": 0, "train_end": end,
                    "val_start": end, "val_end": min(end + fold, m)})
    return out


def fold_table(df: DataFrame, kind: str = "cv", n_splits: int = 5,
               test_size: float = 0.2) -> DataFrame:
    """Fold ranges with their first/last validation dates (from the date table)."""
    dc = date_counts(df).cache()
    n = total_rows(dc)
    ranges = cv_ranges(n, n_splits) if kind == "cv" else walk_forward_ranges(n, n_splits, test_size)
    points = sorted({r["val_start"] for r in ranges} | {r["val_end"] - 1 for r in ranges})
    dates = {}
    for row in dc.where(_covering(points)).collect():
        for p in points:
            if row["before"] <= p < row["before"] + row["n"]:
                dates[p] = row[DATE]
    dc.unpersist()
    rows = [(r["fold"], r["train_start"], r["train_end"], r["val_start"], r["val_end"],
             dates[r["val_start"]], dates[r["val_end"] - 1]) for r in ranges]
    return df.sparkSession.createDataFrame(
        rows, "fold int, train_start long, train_end long, val_start long, val_end long, "
              "val_first_date date, val_last_date date")


def assign_folds(df: DataFrame, kind: str = "cv", n_splits: int = 5,
                 test_size: float = 0.2) -> tuple[DataFrame, list[dict]]:
    """Label rows with ``fold`` = number of fold boundaries at or before them.

    For range i: train = ``fold <= i``, validation = ``fold == i + 1``.
    """
    dc = date_counts(df).cache()
    n = total_rows(dc)
    ranges = cv_ranges(n, n_splits) if kind == "cv" else walk_forward_ranges(n, n_splits, test_size)
    cuts = [r["val_start"] for r in ranges] + [ranges[-1]["val_end"]]
    bounds = locate(df, dc, cuts)
    dc.unpersist()
    return bucket(df, bounds, "fold"), ranges


def fold_filter(labelled: DataFrame, i: int) -> tuple[DataFrame, DataFrame]:
    f = F.col("fold")
    return labelled.where(f <= i), labelled.where(f == i + 1)


def any_of(cols: list[Column]) -> Column:
    return reduce(or_, cols) if cols else F.lit(False)
