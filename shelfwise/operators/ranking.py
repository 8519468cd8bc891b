"""Exact row numbers (O1) and dense dictionaries (M1, P6) without a global window.

Rows are dealt out by ranges of the order and sorted within them; rows equal in
the whole order are told apart by a row id, so that a group of copies is dealt
out too. The ranges' counts, a small table, give each range's first number. The
ranged rows are checkpointed: numbers don't change when an executor is lost.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Model
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import cut_lineage


def number_rows(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), name: str = "position") -> DataFrame:
    """``df`` with ``name``, the row's number from 0 in ``order`` (NULLs first) among the rows of its ``by`` group.

    Rows that agree in the order are numbered in any order; NULLs in ``by`` are one group.
    """
    keys = [*by, *order]
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = (tied.repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie")
              .withColumn("_at", F.monotonically_increasing_id()))
    ranged = cut_lineage(ranged).withColumn("_part", F.shiftright("_at", 33))
    counts = ranged.groupBy(*by, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*[F.col(c).alias(f"_by_{k}") for k, c in enumerate(by)], F.col("_part").alias("_p"),
                           (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_off"))
    same = [F.col("_part") == F.col("_p")] + [F.col(c).eqNullSafe(F.col(f"_by_{k}")) for k, c in enumerate(by)]
    out = ranged.join(counts, reduce(lambda a, b: a & b, same)).withColumn(name, F.col("_at") + F.col("_off"))
    return out.select(*df.columns, name)


def dictionary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, value, code): the distinct values of each column with dense codes from 0 in their order.

    A distributed table, whatever the number of values; NULL is no value.
    """
    pair = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols]
    pairs = df.select(F.inline(F.array(*pair))).where(F.col("value").isNotNull()).distinct()
    return number_rows(pairs, ["value"], ["feature"], "code")


def encode(df: DataFrame, cols: Sequence[str], codes: DataFrame, suffix: str = "_code") -> DataFrame:
    """``df`` with the dictionary's code of each column (NULL for NULL and for values not in it)."""
    for c in cols:
        own = codes.where(F.col("feature") == c).select(F.col("value").alias("_value"), F.col("code").alias(f"{c}{suffix}"))
        df = df.join(own, F.col(c).cast("string") == F.col("_value"), "left").drop("_value")
    return df


def one_hot_long(df: DataFrame, keys: Sequence[str], cols: Sequence[str], codes: DataFrame | None = None) -> DataFrame:
    """P6 in long form: (keys..., feature, value, code), a row per set one-hot slot."""
    codes = dictionary(df, cols) if codes is None else codes
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols])
    long = df.select(*keys, F.inline(cells)).where(F.col("value").isNotNull())
    return long.join(codes, ["feature", "value"]).select(*keys, "feature", "value", "code")


class CategoryCodes(Model, MLWritable, MLReadable):
    """Pipeline stage: ``<column>_idx`` from a dictionary table, which stays distributed.

    NULLs and unseen values get the first index past the codes; an encoder that drops its last slot makes
    them all zero.
    """

    def __init__(self, cols: Sequence[str] = (), sizes: Sequence[int] = (), table: DataFrame | None = None) -> None:
        super().__init__()
        self.cols, self.sizes, self.table = list(cols), list(sizes), table

    @classmethod
    def fitted(cls, df: DataFrame, cols: Sequence[str]) -> CategoryCodes:
        table = cut_lineage(dictionary(df, cols))
        found = {r["feature"]: r["n"] for r in table.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
        return cls(cols, [found.get(c, 0) for c in cols], table)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = encode(dataset, self.cols, self.table, "_idx")
        return out.withColumns({f"{c}_idx": F.coalesce(F.col(f"{c}_idx"), F.lit(n)).cast("double")
                                for c, n in zip(self.cols, self.sizes, strict=True)})

    def encoder(self, suffix: str = "_vec"):
        """The fitted sparse encoder of the indices: a slot per code."""
        idx = [f"{c}_idx" for c in self.cols]
        last = self.table.sparkSession.range(1).select(*[F.lit(float(max(n - 1, 0))).alias(i) for i, n in zip(idx, self.sizes)])
        return OneHotEncoder(inputCols=idx, outputCols=[f"{c}{suffix}" for c in self.cols], dropLast=True,
                             handleInvalid="keep").fit(last)

    def slot_names(self) -> list[str]:
        """Names of the slots in their order, column_value; a column without values has one empty slot."""
        rows = self.table.orderBy("feature", "code").collect()
        return [n for c in self.cols for n in ([f"{c}_{r['value']}" for r in rows if r["feature"] == c] or [f"{c}_"])]

    def write(self) -> MLWriter:
        return _CodesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _CodesReader(cls)


class _CodesWriter(MLWriter):
    def __init__(self, model: CategoryCodes) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata={"cols": m.cols, "sizes": m.sizes})
        m.table.write.parquet(f"{path}/dictionary")


class _CodesReader(MLReader):
    def __init__(self, cls: type) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> CategoryCodes:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession, self.cls.__module__ + "." + self.cls.__name__)
        model = self.cls(meta["cols"], meta["sizes"], self.sparkSession.read.parquet(f"{path}/dictionary"))
        model._resetUid(meta["uid"])
        return model
