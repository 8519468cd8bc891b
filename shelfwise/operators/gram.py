"""Mergeable second moments: ridge (M2), its validation (T2, T3, A16) and correlations (A17) from one pass.

An input is a numeric column or a value of a categorical column (a one-hot
slot, coded by a distributed dictionary). A task adds up, per fold, the sums of
products of its rows' inputs: numerics by a matrix product per batch, slots by
counting their codes and code pairs, so a row costs the pairs of its non-zero
inputs, however many slots there are. Tasks hand on sparse (fold, i, j, sum)
rows, which Spark adds up. As sums merge, the training part of every expanding
fold is a prefix of the folds' sums, and each fold's ridge is solved from them
without reading rows again.

Numerics are shifted by the first row's values before they are multiplied, so
that variances keep their digits where means are large.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.numeric import fill_zero
from shelfwise.operators.ranking import dictionary, encode
from shelfwise.session import cut_lineage, ship_package

#: Inputs up to which the folds' sums come to the driver to be solved (k folds x d^2 / 2 numbers).
GRAM_INPUTS = 1024
#: Sparse sums that a task keeps before it merges them, or hands them on.
FLUSH = 2_000_000


@dataclass(frozen=True)
class Inputs:
    """Numbering of the sums: 0 the constant, 1.. the numerics, then the label, then the slots."""
    numeric: tuple[str, ...]
    cats: tuple[str, ...]
    sizes: tuple[int, ...]  # values per categorical
    shift: tuple[float, ...]  # of the numerics and the label

    @property
    def label(self) -> int:
        return len(self.numeric) + 1

    @property
    def bases(self) -> list[int]:
        return [self.label + 1 + sum(self.sizes[:k]) for k in range(len(self.cats))]

    @property
    def width(self) -> int:
        """Inputs (without constant and label)."""
        return len(self.numeric) + sum(self.sizes)


#: Frame with codes, dictionary, numbering.
Prepared = tuple[DataFrame, DataFrame | None, Inputs]


def prepare(df: DataFrame, numeric: Sequence[str], cats: Sequence[str], label: str | None = "label",
            codes: DataFrame | None = None) -> Prepared:
    """The frame with codes, the dictionary, and the numbering of the inputs."""
    ship_package(df.sparkSession)
    cats = tuple(c for c in cats if c in df.columns)
    sizes: tuple[int, ...] = ()
    if cats:
        codes = cut_lineage(dictionary(df, cats)) if codes is None else codes
        found = {r["feature"]: r["n"] for r in codes.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
        sizes = tuple(found.get(c, 0) for c in cats)
        df = encode(df, cats, codes)
    first = df.select(*[fill_zero(F.col(f"`{c}`").cast("double")) for c in numeric], fill_zero(_label(label))).first()
    shift = tuple(float(v or 0.0) for v in first) if first else (0.0,) * (len(numeric) + 1)
    return df, codes, Inputs(tuple(numeric), cats, sizes, shift)


def _label(label: str | None) -> Column:
    return F.lit(0.0) if label is None else F.col(label).cast("double")


def _rows(df: DataFrame, at: Inputs, fold: Column, label: str | None) -> DataFrame:
    numbers = [fill_zero(F.col(f"`{c}`").cast("double")).alias(f"x{k}") for k, c in enumerate(at.numeric)]
    codes = [F.coalesce(F.col(f"{c}_code"), F.lit(-1)).cast("long").alias(f"c{k}") for k, c in enumerate(at.cats)]
    return df.select(fold.cast("int").alias("fold"), *numbers, fill_zero(_label(label)).alias("y"), *codes)


def _batch(batch: pa.RecordBatch, at: Inputs) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Folds, the dense part (constant, shifted numerics, shifted label), and the codes."""
    cols = [np.asarray(c) for c in batch.columns]
    p = len(at.numeric)
    dense = np.empty((batch.num_rows, p + 2))
    dense[:, 0] = 1.0
    for k in range(p + 1):
        dense[:, k + 1] = cols[k + 1] - at.shift[k]
    return cols[0], dense, [np.asarray(c, np.int64) for c in cols[p + 2:]]


def _sparse(dense: np.ndarray, codes: list[np.ndarray], at: Inputs) -> tuple[np.ndarray, np.ndarray]:
    """Keys i * total + j and sums of the products that have a slot in them."""
    total = at.label + 1 + sum(at.sizes)
    keys, sums = [], []
    for k, (a, base) in enumerate(zip(codes, at.bases, strict=True)):
        have = a >= 0
        values, where = np.unique(a[have], return_inverse=True)
        for i in range(dense.shape[1]):
            keys.append(np.int64(i) * total + base + values)
            sums.append(np.bincount(where, dense[have, i], len(values)))
        keys.append((base + values) * (total + 1))
        sums.append(np.bincount(where, minlength=len(values)).astype(float))
        for b, other in zip(codes[k + 1:], at.bases[k + 1:], strict=True):
            both = have & (b >= 0)
            pairs, n = np.unique((base + a[both]) * total + other + b[both], return_counts=True)
            keys.append(pairs)
            sums.append(n.astype(float))
    return (np.concatenate(keys), np.concatenate(sums)) if keys else (np.zeros(0, np.int64), np.zeros(0))


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(where, np.concatenate([s for _, s in parts]), len(keys))


def _sums(at: Inputs):
    total = at.label + 1 + sum(at.sizes)

    def rows(fold: int, keys: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), fold, np.int32)), pa.array(keys // total),
                                           pa.array(keys % total), pa.array(sums)], names=["fold", "i", "j", "s"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[int, np.ndarray] = {}
        held: dict[int, list] = {}
        size = 0
        for batch in batches:
            folds, dense, codes = _batch(batch, at)
            for f in np.unique(folds).tolist():
                mine = folds == f
                x = dense[mine]
                grams[f] = grams.get(f, 0.0) + x.T @ x
                if codes:
                    held.setdefault(f, []).append(_sparse(x, [c[mine] for c in codes], at))
                    size += len(held[f][-1][0])
            if size > FLUSH:
                held = {f: [_merge(parts)] for f, parts in held.items()}
                size = sum(len(parts[0][0]) for parts in held.values())
                if size > FLUSH // 2:  # merging no longer helps: hand them on
                    for f, parts in held.items():
                        yield rows(f, *parts[0])
                    held, size = {}, 0
        i, j = np.triu_indices(at.label + 1)
        for f, g in grams.items():
            yield rows(f, i.astype(np.int64) * total + j, g[i, j])
        for f, parts in held.items():
            yield rows(f, *_merge(parts))
    return run


def moments(df: DataFrame, at: Inputs, fold: Column | None = None, label: str | None = "label") -> DataFrame:
    """(fold, i, j, s): sums of products of the inputs i <= j over the fold's rows; absent means 0."""
    rows = _rows(df, at, F.lit(0) if fold is None else fold, label)
    return rows.mapInArrow(_sums(at), "fold int, i long, j long, s double").groupBy("fold", "i", "j").agg(F.sum("s").alias("s"))


# ------------------------------------------------------------------ ridge


@dataclass
class Fit:
    """Coefficients of the unshifted inputs (numerics, then slots) and of the standardised ones."""
    coefficients: np.ndarray
    standardised: np.ndarray
    intercept: float


def solve(gram: np.ndarray, at: Inputs, alpha: float = 1.0) -> Fit:
    """Ridge ``||y - b - Zw||^2 + alpha ||w||^2`` over inputs Z scaled by their population deviations.

    ``gram`` holds the sums of products, the constant first. An input without variance gets 0.
    """
    keep = [k for k in range(1, gram.shape[0]) if k != at.label]
    n, s = gram[0, 0], gram[0, keep]
    if n <= 0:
        return Fit(np.zeros(len(keep)), np.zeros(len(keep)), 0.0)
    cov = gram[np.ix_(keep, keep)] - np.outer(s, s) / n
    var = np.diag(cov) / n
    sd = np.sqrt(np.where(var > 1e-14 * np.diag(gram)[keep] / n, var, 0.0))
    on = sd > 0
    w = np.zeros(len(keep))
    with_y = gram[keep, at.label] - s * gram[0, at.label] / n
    scale = sd[on]
    a = cov[np.ix_(on, on)] / np.outer(scale, scale)
    w[on] = np.linalg.lstsq(a + alpha * np.eye(len(scale)), with_y[on] / scale, rcond=None)[0] if len(scale) else 0.0
    beta = np.zeros(len(keep))
    beta[on] = w[on] / scale
    mean = s / n
    mean[: len(at.numeric)] += at.shift[:-1]
    return Fit(beta, w, float(gram[0, at.label] / n + at.shift[-1] - beta @ mean))


def gram_matrices(sums: DataFrame, at: Inputs) -> dict[int, np.ndarray]:
    """The folds' sums as matrices on the driver; at most GRAM_INPUTS inputs."""
    if at.width > GRAM_INPUTS:
        raise ValueError(f"{at.width} inputs; at most {GRAM_INPUTS} are solved on the driver")
    t = sums.toArrow()
    fold, i, j, s = (np.asarray(t[c]) for c in ("fold", "i", "j", "s"))
    size = at.label + 1 + sum(at.sizes)
    out = {}
    for f in np.unique(fold).tolist():
        m = np.zeros((size, size))
        here = fold == f
        m[i[here], j[here]] = s[here]
        out[f] = m + np.triu(m, 1).T
    return out


class GramRidge(Model, MLWritable, MLReadable):
    """A fitted ridge over numeric columns and categorical values: ``transform`` adds ``prediction``.

    Categorical effects are joined by value; NULLs and unseen values count nothing.
    """

    def __init__(self, numeric: Sequence[str] = (), cats: Sequence[str] = (), table: DataFrame | None = None,
                 intercept: float = 0.0) -> None:
        super().__init__()
        self.numeric, self.cats, self.table, self.intercept = list(numeric), list(cats), table, float(intercept)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        effects = {r["feature"]: r["coefficient"] for r in self.table.where(F.col("value").isNull()).collect()}
        total = F.lit(self.intercept)
        for c in self.numeric:
            total = total + F.lit(effects[c]) * fill_zero(F.col(f"`{c}`").cast("double"))
        out = dataset
        for k, c in enumerate(self.cats):
            own = self.table.where((F.col("feature") == c) & F.col("value").isNotNull()).select(
                F.col("value").alias("_value"), F.col("coefficient").alias(f"_effect{k}"))
            out = out.join(own, F.col(c).cast("string") == F.col("_value"), "left").drop("_value")
            total = total + F.coalesce(F.col(f"_effect{k}"), F.lit(0.0))
        return out.withColumn("prediction", total).drop(*[f"_effect{k}" for k in range(len(self.cats))])

    def importance(self) -> DataFrame:
        """(feature, importance): absolute standardised coefficients, slots named column_value."""
        name = F.when(F.col("value").isNull(), F.col("feature")).otherwise(F.concat_ws("_", "feature", "value"))
        return self.table.select(name.alias("feature"), F.abs("standardised").alias("importance"))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: GramRidge) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        extra = {"numeric": m.numeric, "cats": m.cats, "intercept": m.intercept}
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata=extra)
        m.table.write.parquet(f"{path}/coefficients")


class _Reader(MLReader):
    def __init__(self, cls: type) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> GramRidge:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession, self.cls.__module__ + "." + self.cls.__name__)
        model = self.cls(meta["numeric"], meta["cats"], self.sparkSession.read.parquet(f"{path}/coefficients"),
                         meta["intercept"])
        model._resetUid(meta["uid"])
        return model


def _table(spark: SparkSession, fit: Fit, at: Inputs, codes: DataFrame | None) -> DataFrame:
    """(feature, value, coefficient, standardised): value is NULL for a numeric column."""
    schema = "feature string, value string, coefficient double, standardised double"
    p = len(at.numeric)
    rows = [(c, None, float(fit.coefficients[k]), float(fit.standardised[k])) for k, c in enumerate(at.numeric)]
    out = spark.createDataFrame(rows, schema)
    if at.cats:
        base = F.create_map(*[x for c, b in zip(at.cats, at.bases, strict=True) for x in (F.lit(c), F.lit(b - at.label - 1))])
        pick = lambda v: F.get(F.lit([float(x) for x in v[p:]]), (base[F.col("feature")] + F.col("code")).cast("int"))
        out = out.unionByName(codes.select("feature", "value", pick(fit.coefficients).alias("coefficient"),
                                           pick(fit.standardised).alias("standardised")))
    return cut_lineage(out)


def fit_ridge(train: DataFrame, numeric: Sequence[str], cats: Sequence[str] = (), alpha: float = 1.0,
              label: str = "label", prepared: Prepared | None = None) -> GramRidge:
    """M2 from one pass over the rows (besides the dictionary's)."""
    df, codes, at = prepared or prepare(train, numeric, cats, label)
    sums = gram_matrices(moments(df, at, label=label), at)
    size = at.label + 1 + sum(at.sizes)
    fit = solve(sums.get(0, np.zeros((size, size))), at, alpha)
    return GramRidge(numeric, at.cats, _table(train.sparkSession, fit, at, codes), fit.intercept)


# ------------------------------------------------------------------ validation


def _errors(at: Inputs, fits: list[Fit]):
    p = len(at.numeric)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(fits), 3))
        for batch in batches:
            folds, dense, codes = _batch(batch, at)
            for k, fit in enumerate(fits):
                mine = folds == k + 1
                if not mine.any():
                    continue
                x = dense[mine]
                told = x[:, 1: p + 1] @ fit.coefficients[:p] + fit.coefficients[:p] @ np.array(at.shift[:-1]) + fit.intercept
                for c, base in zip(codes, at.bases, strict=True):
                    own = c[mine]
                    told += np.where(own >= 0, fit.coefficients[np.maximum(own, 0) + base - 2], 0.0)
                e = x[:, p + 1] + at.shift[-1] - told
                total[k] += (len(e), np.abs(e).sum(), (e * e).sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(fits), dtype=np.int32)), *[pa.array(total[:, k]) for k in range(3)]],
            names=["fold", "n", "sum_abs", "sum_sq"])
    return run


def validate_ridge(folds: int, prepared: Prepared, alpha: float = 1.0) -> DataFrame:
    """(fold, mae, rmse) of ridge models that train on ``fold <= i`` and are tried on ``fold == i + 1``;
    ``prepared`` rows carry ``fold``.

    Two passes over the rows for any number of folds: sums of products, then errors.
    """
    df, _, at = prepared
    sums = gram_matrices(moments(df, at, F.col("fold")), at)
    size = at.label + 1 + sum(at.sizes)
    so_far, fits = np.zeros((size, size)), []
    for i in range(folds):
        so_far = so_far + sums.get(i, 0.0)
        fits.append(solve(so_far, at, alpha))
    part = _rows(df, at, F.col("fold"), "label").mapInArrow(_errors(at, fits), "fold int, n double, sum_abs double, sum_sq double")
    n = F.sum("n")
    return part.groupBy("fold").agg((F.sum("sum_abs") / n).alias("mae"), F.sqrt(F.sum("sum_sq") / n).alias("rmse"))


# ------------------------------------------------------------------ correlations


def correlated_slots(df: DataFrame, numeric: Sequence[str], cats: Sequence[str] = (), threshold: float = 0.7) -> DataFrame:
    """A17 over every model input, one-hot slots included: pairs with |Pearson r| > ``threshold`` (> 0).

    (i, j, feature_a, feature_b, abs_corr), inputs in the order numerics, then slots by column and value.
    Slots that never meet have no sum but may still be correlated (two values that share the rows): one of
    such a pair has odds p / (1 - p) above the threshold, and a column has at most (1 + t) / t such values, so
    that bounded table is compared with all slots. An input without variance is in no pair.
    """
    if threshold <= 0:
        raise ValueError("threshold must be above 0: absent pairs are found by it")
    df, codes, at = prepare(df, numeric, cats, label=None)
    sums = cut_lineage(moments(df, at, label=None).where((F.col("i") != at.label) & (F.col("j") != at.label)))
    ones = sums.where(F.col("i") == 0).select(F.col("j").alias("k"), F.col("s").alias("sum"))
    squares = sums.where((F.col("i") == F.col("j")) & (F.col("i") > 0)).select(F.col("i").alias("k"), F.col("s").alias("square"))
    rows = sums.where((F.col("i") == 0) & (F.col("j") == 0)).first()
    n = F.lit(float(rows["s"]) if rows else None).cast("double")  # without rows nothing is correlated
    names = [(k + 1, c) for k, c in enumerate(numeric)]
    named = df.sparkSession.createDataFrame(names, "k long, name string") if names else None
    if at.cats:
        base = F.create_map(*[x for c, b in zip(at.cats, at.bases, strict=True) for x in (F.lit(c), F.lit(b))])
        slot_names = codes.select((base[F.col("feature")] + F.col("code")).cast("long").alias("k"),
                                  F.concat_ws("_", "feature", "value").alias("name"))
        named = slot_names if named is None else named.unionByName(slot_names)
    var = F.col("square") / n - F.pow(F.col("sum") / n, F.lit(2.0))
    inputs = (ones.join(squares, "k").join(named, "k").withColumn("var", var)
              .where(F.col("var") > 1e-14 * F.col("square") / n).select("k", "name", "sum", F.sqrt("var").alias("sd")))
    inputs = cut_lineage(inputs)
    side = lambda t: inputs.select(*[F.col(c).alias(f"{t}_{c}") for c in ("k", "name", "sum", "sd")])
    met = (sums.where((F.col("i") > 0) & (F.col("i") < F.col("j"))).join(side("a"), F.col("i") == F.col("a_k"))
           .join(side("b"), F.col("j") == F.col("b_k")))
    slot = lambda t: F.col(f"{t}_k") > at.label
    p = F.col("a_sum") / n
    heavy = side("a").where(slot("a") & (p / (F.lit(1.0) - p) > threshold))
    pairs = side("b").where(slot("b")).join(F.broadcast(heavy), F.col("a_k") != F.col("b_k"))
    known = sums.where(F.col("i") > at.label).select(F.col("i").alias("_i"), F.col("j").alias("_j"))
    low, high = F.least("a_k", "b_k"), F.greatest("a_k", "b_k")
    apart = pairs.join(known, (low == F.col("_i")) & (high == F.col("_j")), "left_anti").withColumn("s", F.lit(0.0))
    cols = ["a_k", "a_name", "a_sum", "a_sd", "b_k", "b_name", "b_sum", "b_sd", "s"]
    both = met.select(*cols).unionByName(apart.select(*cols))
    corr = F.abs((F.col("s") / n - F.col("a_sum") / n * F.col("b_sum") / n) / (F.col("a_sd") * F.col("b_sd")))
    place = lambda k: F.when(k < at.label, k - 1).otherwise(k - 2).cast("int")
    first = F.col("a_k") < F.col("b_k")
    return (both.withColumn("abs_corr", corr).where(F.col("abs_corr") > threshold)
            .select(place(low).alias("i"), place(high).alias("j"),
                    F.when(first, F.col("a_name")).otherwise(F.col("b_name")).alias("feature_a"),
                    F.when(first, F.col("b_name")).otherwise(F.col("a_name")).alias("feature_b"), "abs_corr")
            .distinct())
