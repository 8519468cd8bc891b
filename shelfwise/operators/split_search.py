"""Split search of regression trees on histograms.

Every input of every row is one cell (feature, value, label). Cells are counted
per (node, feature, value) by one aggregate that combines them on the map side,
then gathered into at most BINS bins a numeric feature: its distinct values if
they are that few, else bins of equal frequency between exact quantiles. A
categorical value is a one-hot slot: equal or not. All boundaries of all
features are then judged from at most BINS rows a feature, whatever the rows.
``grow_tree`` repeats this level by level: a pass over the rows per level.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.numeric import fill_zero
from shelfwise.operators.quantiles import grouped_quantiles

BINS = 32
ROOT = 1


def _cells(df: DataFrame, numeric: Sequence[str], cats: Sequence[str], label: str, node: Column) -> DataFrame:
    """(node, feature, slot, value, n, sy, syy): numerics with a NULL slot, categories with a NULL value."""
    null_text, null_number = F.lit(None).cast("string"), F.lit(None).cast("double")
    cells = [F.struct(F.lit(c).alias("feature"), null_text.alias("slot"), fill_zero(F.col(f"`{c}`").cast("double")).alias("value"))
             for c in numeric]
    cells += [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("slot"), null_number.alias("value")) for c in cats]
    y = F.col(label).cast("double")
    long = df.select(node.alias("node"), y.alias("y"), F.inline(F.array(*cells)))
    return (long.where(F.col("slot").isNotNull() | F.col("value").isNotNull()).groupBy("node", "feature", "slot", "value")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("sy"), F.sum(F.col("y") * F.col("y")).alias("syy")))


def _gain(n: Column, sy: Column, syy: Column, ln: Column, lsy: Column, lsyy: Column) -> Column:
    """Fall of the variance: of the node less those of both sides, weighted by their rows."""
    spread = lambda c, s, q: q - s * s / c
    return (spread(n, sy, syy) - spread(ln, lsy, lsyy) - spread(n - ln, sy - lsy, syy - lsyy)) / n


def split_gains(df: DataFrame, numeric: Sequence[str], cats: Sequence[str] = (), label: str = "label", bins: int = BINS,
                node: Column | None = None, min_rows: int = 1) -> DataFrame:
    """(node, feature, slot, threshold, gain, n_left, n): the best split of every input of every node.

    A numeric goes left if it is at most ``threshold`` (the middle between two bins); a category goes left if
    it is not ``slot`` (threshold 0.5). Equal gains: the smallest threshold. Inputs that can't be split with
    ``min_rows`` rows on both sides are left out. NULL categories are no slot, and always go left.
    """
    cells = _cells(df, numeric, cats, label, F.lit(ROOT) if node is None else node)
    parts = []
    here = ["node", "feature"]
    if numeric:
        numbers = cells.where(F.col("slot").isNull()).drop("slot")
        few = numbers.groupBy(*here).agg(F.count(F.lit(1)).alias("values"))
        cuts = grouped_quantiles(numbers, here, "value", [k / bins for k in range(1, bins)], weight="n", few_groups=True)
        # a row per open node and column, so a feature's cells stay dealt out by value
        told = F.broadcast(few.join(cuts.select(*here, "quantiles"), here))
        edge = F.coalesce(F.array_min(F.filter("quantiles", lambda t: t >= F.col("value"))), F.lit(float("inf")))
        binned = (numbers.join(told, here).withColumn("bin", F.when(F.col("values") <= bins, F.col("value")).otherwise(edge))
                  .groupBy(*here, "bin").agg(*[F.sum(c).alias(c) for c in ("n", "sy", "syy")],
                                             F.min("value").alias("low"), F.max("value").alias("high")))
        whole = Window.partitionBy(*here)  # at most ``bins`` rows
        upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        totals = {f"t_{c}": F.sum(c).over(whole) for c in ("n", "sy", "syy")}
        left = {f"l_{c}": F.sum(c).over(upto) for c in ("n", "sy", "syy")}
        sides = binned.withColumns(totals | left).withColumn("next", F.lead("low").over(whole.orderBy("bin")))
        sides = sides.where(F.col("next").isNotNull())
        parts.append(sides.select(*here, F.lit(None).cast("string").alias("slot"),
                                  ((F.col("high") + F.col("next")) / 2).alias("threshold"), "t_n", "t_sy", "t_syy",
                                  "l_n", "l_sy", "l_syy"))
    if cats:
        slots = cells.where(F.col("slot").isNotNull())
        total = (df.select((F.lit(ROOT) if node is None else node).alias("node"), F.col(label).cast("double").alias("y"))
                 .groupBy("node").agg(F.count(F.lit(1)).alias("t_n"), F.sum("y").alias("t_sy"),
                                      F.sum(F.col("y") * F.col("y")).alias("t_syy")))
        parts.append(slots.join(total, "node").select(
            *here, "slot", F.lit(0.5).alias("threshold"), "t_n", "t_sy", "t_syy", (F.col("t_n") - F.col("n")).alias("l_n"),
            (F.col("t_sy") - F.col("sy")).alias("l_sy"), (F.col("t_syy") - F.col("syy")).alias("l_syy")))
    sides = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    enough = (F.col("l_n") >= min_rows) & (F.col("t_n") - F.col("l_n") >= min_rows)
    gain = _gain(*[F.col(c) for c in ("t_n", "t_sy", "t_syy", "l_n", "l_sy", "l_syy")])
    best = F.max_by(F.struct("threshold", "gain", "l_n", "t_n", "t_sy", "l_sy"), F.struct("gain", -F.col("threshold")))
    return (sides.where(enough).withColumn("gain", gain).groupBy(*here, "slot").agg(best.alias("b"))
            .select(*here, "slot", "b.threshold", "b.gain", F.col("b.l_n").alias("n_left"), F.col("b.t_n").alias("n"),
                    (F.col("b.l_sy") / F.col("b.l_n")).alias("mean_left"),
                    ((F.col("b.t_sy") - F.col("b.l_sy")) / (F.col("b.t_n") - F.col("b.l_n"))).alias("mean_right")))


def input_name(feature: str = "feature", slot: str = "slot") -> Column:
    return F.when(F.col(slot).isNull(), F.col(feature)).otherwise(F.concat_ws("_", feature, slot))


@dataclass(frozen=True)
class Split:
    """A node's split; its children are 2 * node and 2 * node + 1."""
    node: int
    feature: str
    slot: str | None
    threshold: float
    gain: float
    n: int
    mean_left: float
    mean_right: float

    def goes_left(self) -> Column:
        if self.slot is None:
            return fill_zero(F.col(f"`{self.feature}`").cast("double")) <= F.lit(self.threshold)
        return ~F.coalesce(F.col(self.feature).cast("string") == F.lit(self.slot), F.lit(False))


@dataclass
class Tree:
    splits: dict[int, Split]
    mean: float

    def node(self) -> Column:
        """The leaf (its number) that a row comes to."""
        def at(k: int) -> Column:
            s = self.splits.get(k)
            return F.lit(k) if s is None else F.when(s.goes_left(), at(2 * k)).otherwise(at(2 * k + 1))
        return at(ROOT)

    def prediction(self) -> Column:
        def at(k: int, mean: float) -> Column:
            s = self.splits.get(k)
            if s is None:
                return F.lit(mean)
            return F.when(s.goes_left(), at(2 * k, s.mean_left)).otherwise(at(2 * k + 1, s.mean_right))
        return at(ROOT, self.mean)

    def importance(self) -> dict[str, float]:
        """Gains by input, weighted by the rows they were found on, adding up to 1."""
        found: dict[str, float] = {}
        for s in self.splits.values():
            name = s.feature if s.slot is None else f"{s.feature}_{s.slot}"
            found[name] = found.get(name, 0.0) + s.gain * s.n
        whole = sum(found.values())
        return {k: v / whole for k, v in found.items()} if whole else found


def grow_tree(df: DataFrame, numeric: Sequence[str], cats: Sequence[str] = (), label: str = "label", depth: int = 3,
              bins: int = BINS, min_rows: int = 1) -> Tree:
    """A regression tree, level by level; of a node's inputs the one of the greatest gain (ties: by name) splits it.

    The driver sees a row per node. Bins are those of the rows in the node.
    """
    mean = df.agg(F.avg(F.col(label).cast("double"))).first()[0]
    tree = Tree({}, float(mean or 0.0))
    for level in range(depth):
        node = tree.node()
        open_nodes = df.where(node >= 2 ** level) if level else df
        gains = split_gains(open_nodes, numeric, cats, label, bins, node, min_rows)
        order = Window.partitionBy("node").orderBy(F.desc("gain"), "feature", F.col("slot").asc_nulls_first())
        best = gains.where(F.col("gain") > 1e-12).withColumn("_place", F.row_number().over(order)).where("_place = 1").collect()
        if not best:
            break
        for b in best:
            tree.splits[b["node"]] = Split(b["node"], b["feature"], b["slot"], b["threshold"], b["gain"], b["n"],
                                           b["mean_left"], b["mean_right"])
    return tree
