"""Exact grouped quantiles by bucket refinement.

``percentile`` keeps every distinct value of a group in one task. Here rows are
first counted per (group, value); the counts are dealt out by value, so a hot
group is spread. Then the bucket that holds a wanted rank is looked for, in two
steps of ever finer buckets, and only the distinct values of the last bucket are
ranked. Buckets are fixed steps of sign(v) * log(1 + |v|), which never decreases
with v: at most COARSE * 1420 in the first step and FINE / COARSE in the second,
whatever the rows, so no task walks more than that. The counts' shuffle is
shared by all steps; nothing runs while the plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COARSE = 64
FINE = 1 << 26


def _place(v: Column) -> Column:
    return F.signum(v) * F.log1p(F.abs(v))


def _on(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right, strict=True)])


def _holding(rows: DataFrame, part: list[str], order: str, rank: Column) -> DataFrame:
    """Rows of ``order`` (with counts ``_n``) within whose cumulated counts the rank lies; ``_rank`` starts anew there."""
    upto = F.sum("_n").over(Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (rows.withColumn("_upto", upto).withColumn("_rank", rank - (F.col("_upto") - F.col("_n")))
            .where((F.col("_rank") >= 0) & (F.col("_rank") < F.col("_n"))).drop("_upto"))


def grouped_quantiles(df: DataFrame, by: Sequence[str], value: str, quantiles: Sequence[float],
                      weight: str | None = None, few_groups: bool = False) -> DataFrame:
    """(by..., n, quantiles): per group the count and the array of its quantiles, linearly interpolated.

    NULL and NaN values don't count; a group without values has no row; NULL is a group like any other.
    ``weight``: a column of counts, for rows that stand for several. ``few_groups``: the caller bounds the
    number of groups (columns of a plan, say), so the wanted ranks, two a quantile and group, are broadcast
    and no group's values meet in one task; without ``by`` there is one group.
    """
    few_groups = few_groups or not by
    keys = [f"_g{k}" for k in range(len(by))] or ["_g0"]
    named = [F.col(c).alias(k) for c, k in zip(by, keys)] or [F.lit(0).alias("_g0")]
    v = F.col(value).cast("double")
    many = F.lit(1) if weight is None else F.col(weight)
    counts = (df.select(*named, v.alias("_v"), many.alias("_w")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
              .groupBy(*keys, "_v").agg(F.sum("_w").alias("_n")))
    counts = counts.withColumns({"_coarse": F.floor(_place(F.col("_v")) * COARSE), "_fine": F.floor(_place(F.col("_v")) * FINE)})

    coarse = counts.groupBy(*keys, "_coarse").agg(F.sum("_n").alias("_n"))
    coarse = coarse.withColumn("_total", F.sum("_n").over(Window.partitionBy(*keys)))
    wanted = []
    for k, q in enumerate(quantiles):
        pos = (F.col("_total") - 1).cast("double") * F.lit(float(q))
        wanted += [F.struct(F.lit(2 * k).alias("_k"), F.floor(pos).alias("_want")),
                   F.struct(F.lit(2 * k + 1).alias("_k"), F.ceil(pos).alias("_want"))]
    upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_coarse").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first = (coarse.withColumn("_upto", upto)
             .withColumn("_hit", F.filter(F.array(*wanted), lambda w: (w["_want"] < F.col("_upto")) & (
                 w["_want"] >= F.col("_upto") - F.col("_n"))))
             .select(*keys, "_coarse", "_total", (F.col("_upto") - F.col("_n")).alias("_before"), F.inline("_hit"))
             .withColumn("_rest", F.col("_want") - F.col("_before")))

    def within(found: DataFrame, bucket: str) -> DataFrame:
        """The distinct values in the buckets found, per wanted rank."""
        here = [*keys, bucket]
        other = [f"_o{c}" for c in here]
        right = found.select(*[F.col(c).alias(o) for c, o in zip(here, other)], "_k", "_rest", "_total")
        right = F.broadcast(right) if few_groups else right
        return counts.join(right, _on(here, other)).drop(*other)

    second = (within(first, "_coarse").groupBy(*keys, "_k", "_fine")
              .agg(F.sum("_n").alias("_n"), F.min("_rest").alias("_rest"), F.min("_total").alias("_total")))
    second = _holding(second, [*keys, "_k"], "_fine", F.col("_rest")).withColumn("_rest", F.col("_rank"))
    last = _holding(within(second, "_fine"), [*keys, "_k"], "_v", F.col("_rest"))

    values = F.map_from_entries(F.collect_list(F.struct("_k", "_v")))  # two a quantile
    picked = last.groupBy(*keys).agg(F.max("_total").alias("n"), values.alias("_at"))
    between = []
    for k, q in enumerate(quantiles):
        pos = (F.col("n") - 1).cast("double") * F.lit(float(q))
        low, high = F.col("_at")[2 * k], F.col("_at")[2 * k + 1]
        between.append(low + (high - low) * (pos - F.floor(pos)))
    return picked.select(*[F.col(k).alias(c) for c, k in zip(by, keys)], "n", F.array(*between).alias("quantiles"))
