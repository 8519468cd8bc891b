"""Forests (M3) and boosting (M4) grown level by level from mergeable histograms.

A row is a bin per input column: a numeric has at most BINS bins (its distinct
values if they are that few, else quantiles of the whole column), a categorical
a bin per value, each of which is a one-hot slot (equal or not). So a row costs
its columns, however many slots there are. Binned rows are packed into blocks of
BLOCK rows and checkpointed once; a level of all trees is a pass over the
blocks: tasks walk their rows to the open nodes and add up (rows, label) per
node and bin, Spark adds the tasks' sums up per node, and each node's best split
is chosen where its sums meet. The driver sees a row per node. What a task sends
depends on the nodes and bins, not on its rows; where the open nodes' sums would
pass CELLS, a level takes several passes.

As in MLlib: variance gains, rows drawn per tree with Poisson weights (forests),
or trees fitted one by one to the squared error's gradient (boosting, the first
with weight 1, the others with the step size).
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import cut_lineage, ship_package

#: The column of a row's inputs: numerics, then the categoricals' codes (-1: none).
INPUTS = "inputs"
#: The column of the categoricals' numbers of codes, the same in every row.
SIZES = "input_sizes"
BINS = 32
#: Rows a block.
BLOCK = 32_768
#: (node, bin) sums that a task holds at once (16 bytes each).
CELLS = 16_000_000
#: Trees after which boosting writes the residuals into the blocks.
REFRESH = 5

#: Bytes of all tasks' sums up to which the driver adds them up itself, without a shuffle (a boosted tree's levels).
AT_ONCE = 16_000_000

BLOCK_SCHEMA = "block long, n int, bins binary, y binary"


@dataclass(frozen=True)
class Binning:
    """Numeric columns' cuts (a value goes left of the cuts that it is at most), categoricals' sizes; bins side by side."""
    cuts: tuple[np.ndarray, ...]
    sizes: tuple[int, ...]
    rows: int
    mean: float  # taken off the labels, so that sums keep their digits

    @property
    def counts(self) -> np.ndarray:
        """Bins per column; a categorical's last one is for rows without a slot."""
        return np.array([len(c) + 1 for c in self.cuts] + [s + 1 for s in self.sizes], np.int64)

    @property
    def bases(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.counts)])

    @property
    def width(self) -> int:
        """Slots: a numeric is one, a categorical one per value."""
        return len(self.cuts) + sum(self.sizes)

    @property
    def dtype(self) -> type:
        return np.uint16 if self.counts.max(initial=0) < 2 ** 16 else np.uint32

    def slots(self) -> np.ndarray:
        """The slot of every bin."""
        p = len(self.cuts)
        first = p + np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        parts = [np.full(len(c) + 1, k) for k, c in enumerate(self.cuts)]
        parts += [np.append(np.arange(s) + first[k], max(first[k] + s - 1, 0)) for k, s in enumerate(self.sizes)]
        return np.concatenate(parts).astype(np.int64)

    def bin(self, x: np.ndarray) -> np.ndarray:
        """Bins of the inputs (columns x rows)."""
        out = np.empty(x.shape, self.dtype)
        p = len(self.cuts)
        for k, cuts in enumerate(self.cuts):
            out[k] = np.searchsorted(cuts, x[k], side="left")
        for k, size in enumerate(self.sizes):
            codes = x[p + k]
            out[p + k] = np.where((codes >= 0) & (codes < size), codes, size)
        return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix, a row per input."""
    flat = np.asarray(column.flatten(), np.float64)
    return np.ascontiguousarray(flat.reshape(len(column), width).T) if width else np.zeros((0, len(column)))


# ------------------------------------------------------------------ binning


def _distinct(p: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray | None] = [np.zeros(0)] * p
        for batch in batches:
            x = _matrix(batch.column(0), width)
            for k in range(p):
                if seen[k] is not None:
                    values = np.union1d(seen[k], x[k])
                    seen[k] = values if len(values) <= BINS else None
        rows = [(k, v) for k in range(p) for v in ([None] if seen[k] is None else seen[k].tolist())]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([v for _, v in rows], pa.float64())],
                                         names=["k", "v"])
    return run


def fit_bins(df: DataFrame, p: int, sizes: tuple[int, ...]) -> Binning:
    """Cuts of the first ``p`` inputs: between their values if those are at most BINS, else quantiles of all rows."""
    width = p + len(sizes)
    found: dict[int, list] = {k: [] for k in range(p)}
    if p:
        for r in df.select(INPUTS).mapInArrow(_distinct(p, width), "k int, v double").distinct().collect():
            found[r["k"]].append(r["v"])
    many = [k for k, vs in found.items() if None in vs or len(vs) > BINS]
    asked = [F.percentile_approx(F.get(INPUTS, F.lit(k)), [i / BINS for i in range(1, BINS)], 10_000).alias(f"q{k}") for k in many]
    row = df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("label").cast("double")).alias("mean"), *asked).first()
    cuts = []
    for k in range(p):
        if k in many:
            cuts.append(np.unique(np.array(row[f"q{k}"], np.float64)))
        else:
            values = np.unique(np.array(found[k], np.float64))
            cuts.append((values[1:] + values[:-1]) / 2)
    return Binning(tuple(cuts), tuple(sizes), row["n"], float(row["mean"] or 0.0))


def _blocks(at: Binning, width: int):
    def block(number: int, bins: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([len(y)], pa.int32()), pa.array([bins.tobytes()], pa.binary()),
             pa.array([y.tobytes()], pa.binary())], names=["block", "n", "bins", "y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        held, ys, size = [], [], 0
        for batch in batches:
            held.append(at.bin(_matrix(batch.column(0), width)))
            ys.append(np.asarray(batch.column(1), np.float64) - at.mean)
            size += batch.num_rows
            if size >= BLOCK:
                yield block(number, np.concatenate(held, axis=1), np.concatenate(ys))
                number, held, ys, size = number + 1, [], [], 0
        if size:
            yield block(number, np.concatenate(held, axis=1), np.concatenate(ys))
    return run


def pack(df: DataFrame, at: Binning) -> DataFrame:
    """Binned rows in blocks, checkpointed: a block's number and rows stay the same for every pass."""
    rows = df.select(INPUTS, F.col("label").cast("double").alias("y")).mapInArrow(_blocks(at, len(at.counts)), BLOCK_SCHEMA)
    return cut_lineage(rows.repartition(min(df.sparkSession.sparkContext.defaultParallelism, -(-at.rows // BLOCK))))


# ------------------------------------------------------------------ trees


@dataclass
class Grown:
    """Nodes of a tree by number (0: root). A row goes to ``left + 1`` where low < its bin <= high, else to ``left``;
    a node without a split has ``left`` = its own number and no such bin."""
    column: list[int] = field(default_factory=list)
    low: list[int] = field(default_factory=list)
    high: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    slot: list[int] = field(default_factory=list)  # -1: no split
    gain: list[float] = field(default_factory=list)  # times the rows
    depth: list[int] = field(default_factory=list)

    def add(self, value: float, depth: int) -> int:
        node = len(self.value)
        for name, v in (("column", 0), ("low", 2 ** 40), ("high", -1), ("left", node), ("value", value), ("slot", -1),
                        ("gain", 0.0), ("depth", depth)):
            getattr(self, name).append(v)
        return node

    def split(self, node: int, column: int, low: int, high: int, slot: int, gain: float, left: float, right: float) -> tuple[int, int]:
        self.column[node], self.low[node], self.high[node], self.slot[node], self.gain[node] = column, low, high, slot, gain
        a, b = self.add(left, self.depth[node] + 1), self.add(right, self.depth[node] + 1)
        self.left[node] = a
        return a, b

    def arrays(self) -> tuple[np.ndarray, ...]:
        """column, low, high, left, value; and the depth."""
        ints = [np.array(v, np.int64) for v in (self.column, self.low, self.high, self.left)]
        return (*ints, np.array(self.value), max(self.depth, default=0))


def _walk(tree: tuple, cells: np.ndarray, rows: np.ndarray | None) -> np.ndarray:
    """The nodes of the given rows (all: None) of a matrix of inputs or bins (columns x rows)."""
    column, low, high, left, _, depth = tree
    n = cells.shape[1]
    node = np.zeros(n if rows is None else len(rows), np.int64)
    flat, at = cells.ravel(), (np.arange(n) if rows is None else rows)
    for _ in range(depth):
        v = flat[column[node] * n + at]
        node = left[node] + ((v > low[node]) & (v <= high[node]))
    return node


def _weights(share: float, replace: bool) -> np.ndarray | None:
    """A row's weight for each of 2^16 equally likely draws; None: every row counts once."""
    if not replace:
        return None if share >= 1 else (np.arange(2 ** 16) < share * 2 ** 16).astype(np.uint8)
    odds = np.exp(-share) * np.cumprod(np.concatenate([[1.0], share / np.arange(1, 30)]))
    return np.searchsorted(np.cumsum(odds), (np.arange(2 ** 16) + 0.5) / 2 ** 16).astype(np.uint8)


@dataclass(frozen=True)
class Pass:
    """What a task needs for the sums of one level: for every tree its number, nodes, and open nodes' places."""
    at: Binning
    trees: list[tuple[int, tuple, np.ndarray, np.ndarray]]  # number, arrays, open nodes, place of each node (-1: not open)
    drawn: np.ndarray | None
    seed: int
    before: list[tuple[float, tuple]]  # boosting: weights and arrays of trees not yet in the blocks
    factor: float = 1.0  # of the residual


def _unpack(bins: bytes, y: bytes, n: int, at: Binning) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(bins, at.dtype).reshape(len(at.counts), n), np.frombuffer(y, np.float64)


def _residual(cells: np.ndarray, y: np.ndarray, before: list[tuple[float, tuple]]) -> np.ndarray:
    for weight, tree in before:
        y = y - weight * tree[4][_walk(tree, cells, None)]
    return y


def _level_sums(todo: Pass):
    at = todo.at
    counts, bases = at.counts, at.bases
    width = int(bases[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((2, len(nodes), width)) for _, _, nodes, _ in todo.trees]
        for batch in batches:
            for b, n, bins, ys in zip(*[batch.column(k) for k in range(4)], strict=True):
                cells, y = _unpack(bins.as_buffer(), ys.as_buffer(), n.as_py(), at)
                y = todo.factor * _residual(cells, y, todo.before)
                for (number, tree, _, place), into in zip(todo.trees, sums, strict=True):
                    rows, w = None, None
                    if todo.drawn is not None:
                        rng = np.random.default_rng([todo.seed & 0xFFFFFFFF, number, b.as_py()])
                        w = todo.drawn[rng.integers(0, 2 ** 16, len(y), dtype=np.uint16)]
                        rows = np.flatnonzero(w)
                    node = place[_walk(tree, cells, rows)]
                    if (node < 0).any():
                        kept = np.flatnonzero(node >= 0)
                        node, rows = node[kept], kept if rows is None else rows[kept]
                    mine = cells if rows is None else cells[:, rows]
                    wy = y if rows is None else y[rows]
                    if w is not None:
                        w = w[rows].astype(np.float64)
                        wy = w * wy
                    open_nodes = into.shape[1]
                    for k, (count, base) in enumerate(zip(counts.tolist(), bases.tolist())):
                        where = node * count + mine[k]
                        for s, weights in enumerate((w, wy)):
                            into[s][:, base: base + count] += np.bincount(where, weights, open_nodes * count).reshape(open_nodes, count)
        for (number, _, nodes, _), found in zip(todo.trees, sums, strict=True):
            got = np.flatnonzero(found[0].any(axis=1))
            for some in np.array_split(got, max(1, len(got) * width // 500_000)):  # some 8 MB a batch
                if len(some):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), number, np.int32)), pa.array(nodes[some].astype(np.int64)),
                         pa.array([_thin(found[:, i]) for i in some.tolist()], pa.binary())], names=["tree", "node", "sums"])
    return run


def _thin(sums: np.ndarray) -> bytes:
    """Sums of a node: all bins, or where most are empty the others and their numbers."""
    have = np.flatnonzero(sums[0])
    if len(have) * 20 >= sums.size * 8:
        return b"\0" * 8 + sums.tobytes()
    return np.int64(len(have)).tobytes() + np.ascontiguousarray(sums[:, have]).tobytes() + have.astype(np.uint32).tobytes()


def _add_thin(into: np.ndarray, text: bytes) -> None:
    count = int(np.frombuffer(text, np.int64, 1)[0])
    if not count:
        into += np.frombuffer(text, np.float64, offset=8).reshape(into.shape)
    else:
        part = np.frombuffer(text, np.float64, 2 * count, offset=8).reshape(2, count)
        into[:, np.frombuffer(text, np.uint32, offset=8 + 16 * count)] += part


def _best_splits(at: Binning, min_rows: int, slots_a_node: int, seed: int):
    """(tree, node, n, s, bin, gain, left_n, left_s): the best split of every node; bin -1: none."""
    bases, p = at.bases, len(at.cuts)
    width = int(bases[-1])
    slot, numeric = at.slots(), np.arange(width) < bases[p]
    column = np.repeat(np.arange(len(at.counts)), at.counts)
    start, last = bases[column], bases[column + 1] - 1
    may = np.arange(width) != last  # a numeric's last bin has nothing on its right, a categorical's is no slot

    def choose(keys: list[tuple[int, int]], sums: np.ndarray) -> pa.RecordBatch:
        first = slice(0, int(at.counts[0]) if len(at.counts) else 0)
        n, s = (sums[:, k, first].sum(axis=1, keepdims=True) for k in (0, 1))
        left = []
        for k, whole in ((0, n), (1, s)):
            upto = np.concatenate([np.zeros((len(keys), 1)), np.cumsum(sums[:, k], axis=1)], axis=1)
            left.append(np.where(numeric, upto[:, 1:] - upto[:, start], whole - sums[:, k]))
        ln, ls = left
        ok = may & (ln >= min_rows) & (n - ln >= min_rows)
        if slots_a_node < at.width:
            for i, (tree, node) in enumerate(keys):
                rng = np.random.default_rng([seed & 0xFFFFFFFF, tree, node])
                taken = np.zeros(at.width, bool)
                taken[rng.choice(at.width, slots_a_node, replace=False)] = True
                ok[i] &= taken[slot]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(ok, ls * ls / ln + (s - ls) ** 2 / (n - ln) - s * s / n, -1.0)
        best = gain.argmax(axis=1)
        rows = np.arange(len(keys))
        top = gain[rows, best]
        found = top > 1e-12 * np.maximum(n[:, 0], s[:, 0] ** 2 / n[:, 0])
        return pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in keys], pa.int32()), pa.array([k for _, k in keys], pa.int64()), pa.array(n[:, 0]), pa.array(s[:, 0]),
             pa.array(np.where(found, best, -1)), pa.array(top), pa.array(ln[rows, best]), pa.array(ls[rows, best])],
            names=["tree", "node", "n", "s", "bin", "gain", "left_n", "left_s"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for tree, node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if (tree, node) not in found:
                    found[tree, node] = np.zeros((2, width))
                _add_thin(found[tree, node], text.as_buffer())
        keys = sorted(found)
        step = max(1, 1_000_000 // max(width, 1))
        for i in range(0, len(keys), step):
            some = keys[i: i + step]
            yield choose(some, np.stack([found.pop(k) for k in some]))
    return run


SPLITS = "tree int, node long, n double, s double, bin long, gain double, left_n double, left_s double"


def slots_asked(strategy: str | float, width: int, trees: int) -> int:
    """Slots that a node may choose from, by MLlib's names."""
    text = str(strategy)
    if text == "auto":
        text = "all" if trees == 1 else "onethird"
    if text == "all":
        return width
    if text in ("sqrt", "log2", "onethird"):
        share = {"sqrt": math.sqrt(width), "log2": math.log2(max(width, 1)), "onethird": width / 3}[text]
    else:
        share = float(text) if text.isdigit() else float(text) * width
    return min(max(1, math.ceil(share)), width)


def grow(blocks: DataFrame, at: Binning, numbers: list[int], depth: int, min_rows: int, strategy: str | float, seed: int,
         drawn: np.ndarray | None = None, before: list[tuple[float, tuple]] = (), factor: float = 1.0,
         trees_at_all: int | None = None) -> dict[int, Grown]:
    """Trees of the given numbers, a pass over the blocks per level (more where the open nodes' sums pass CELLS)."""
    bases = at.bases
    width, p, slot = int(bases[-1]), len(at.cuts), at.slots()
    asked = slots_asked(strategy, at.width, trees_at_all or len(numbers))
    out = {t: Grown() for t in numbers}
    todo = [(t, tree.add(0.0, 0)) for t, tree in out.items()]
    a_pass = max(1, CELLS // max(width, 1))
    parts, tasks = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(
        blocks.sparkSession.sparkContext.defaultParallelism, -(-at.rows // BLOCK))
    while todo:
        now, todo_later = todo[:a_pass], todo[a_pass:]
        chosen: dict[int, list[int]] = {}
        for t, node in now:
            chosen.setdefault(t, []).append(node)
        trees = []
        for t, nodes in chosen.items():
            place = np.full(len(out[t].value), -1, np.int64)
            place[nodes] = np.arange(len(nodes))
            trees.append((t, out[t].arrays(), np.array(nodes, np.int64), place))
        found = blocks.mapInArrow(_level_sums(Pass(at, trees, drawn, seed, list(before), factor)), "tree int, node long, sums binary")
        choose = _best_splits(at, min_rows, asked, seed)
        if len(now) * width * 16 * tasks <= AT_ONCE:
            splits = [r for batch in choose(iter(found.toArrow().to_batches())) for r in batch.to_pylist()]
        else:
            splits = found.repartition(min(parts, len(now)), "tree", "node").mapInArrow(choose, SPLITS).collect()
        children = []
        for r in sorted(splits, key=lambda r: (r["tree"], r["node"])):
            tree, node, n, s = out[r["tree"]], r["node"], r["n"], r["s"]
            if node == 0:
                tree.value[0] = s / n
            if r["bin"] < 0 or depth == 0:
                continue
            k = int(np.searchsorted(bases, r["bin"], side="right")) - 1
            b = r["bin"] - int(bases[k])
            low, high = (b, 2 ** 40) if k < p else (b - 1, b)
            ln, ls = r["left_n"], r["left_s"]
            pair = tree.split(node, k, low, high, int(slot[r["bin"]]), r["gain"], ls / ln, (s - ls) / (n - ln))
            if tree.depth[node] + 1 < depth:
                children += [(r["tree"], c) for c, rows in zip(pair, (ln, n - ln), strict=True) if rows >= 2 * min_rows]
        todo = todo_later + children if todo_later else children
    return out


# ------------------------------------------------------------------ model


class TreeEnsemble(Model, MLWritable, MLReadable):
    """Weighted trees over the INPUTS column; ``transform`` adds ``prediction``: the mean of a forest, the sum of boosting."""

    def __init__(self, trees: list[tuple] = (), weights: list[float] = (), importances: np.ndarray | None = None,
                 base: float = 0.0, mean: bool = True) -> None:
        super().__init__()
        self.trees, self.weights, self.base, self.mean = list(trees), [float(w) for w in weights], float(base), mean
        self.featureImportances = _Importances(np.zeros(0) if importances is None else importances)

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship_package(dataset.sparkSession)
        trees, share = self.trees, self.weights if not self.mean else [1.0 / len(self.trees)] * len(self.trees)
        base = self.base

        def told(inputs: pa.Array) -> pa.Array:
            x = _matrix(inputs, len(inputs.flatten()) // len(inputs) if len(inputs) else 0)
            out = np.full(len(inputs), base)
            if len(inputs):
                for tree, w in zip(trees, share, strict=True):
                    out += w * tree[4][_walk(tree, x, None)]
            return pa.array(out)
        told.__annotations__ = {"inputs": pa.Array, "return": pa.Array}
        return dataset.withColumn("prediction", F.arrow_udf(told, "double")(F.col(INPUTS)))

    def evaluateEachIteration(self, dataset: DataFrame, loss: str) -> list[float]:
        """Mean absolute error of boosting after each tree."""
        if loss != "absolute":
            raise ValueError(f"unknown loss {loss}")
        ship_package(dataset.sparkSession)
        trees, weights, base = self.trees, self.weights, self.base

        def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, rows = np.zeros(len(trees)), 0
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _matrix(batch.column(0), len(batch.column(0).flatten()) // batch.num_rows)
                left = np.asarray(batch.column(1), np.float64) - base
                rows += batch.num_rows
                for k, (tree, w) in enumerate(zip(trees, weights, strict=True)):
                    left = left - w * tree[4][_walk(tree, x, None)]
                    total[k] += np.abs(left).sum()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(trees), dtype=np.int32)), pa.array(total),
                                              pa.array(np.full(len(trees), float(rows)))], names=["stage", "s", "n"])
        part = dataset.select(INPUTS, F.col("label").cast("double")).mapInArrow(errors, "stage int, s double, n double")
        got = part.groupBy("stage").agg((F.sum("s") / F.sum("n")).alias("mae")).orderBy("stage").collect()
        return [r["mae"] for r in got]

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Importances(np.ndarray):
    """Importances by slot, with the vector's ``toArray``."""

    def __new__(cls, values: np.ndarray) -> _Importances:
        return np.asarray(values, np.float64).view(cls)

    def toArray(self) -> np.ndarray:
        return np.asarray(self)


class _Writer(MLWriter):
    def __init__(self, model: TreeEnsemble) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        extra = {"weights": json.dumps(m.weights), "base": m.base, "mean": m.mean, "depths": [int(t[5]) for t in m.trees],
                 "importances": m.featureImportances.tolist()}
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata=extra)
        rows = [(k, i, *row) for k, t in enumerate(m.trees) for i, row in enumerate(zip(*[a.tolist() for a in t[:5]], strict=True))]
        schema = "tree int, node int, column long, low double, high double, left long, value double"
        rows = [(k, i, c, float(lo), float(hi), le, v) for k, i, c, lo, hi, le, v in rows]
        self.sparkSession.createDataFrame(rows, schema).write.parquet(f"{path}/nodes")


class _Reader(MLReader):
    def __init__(self, cls: type) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TreeEnsemble:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession, self.cls.__module__ + "." + self.cls.__name__)
        rows = self.sparkSession.read.parquet(f"{path}/nodes").orderBy("tree", "node").toArrow()
        cols = {c: np.asarray(rows[c]) for c in rows.column_names}
        trees = []
        for k, depth in enumerate(meta["depths"]):
            mine = cols["tree"] == k
            trees.append((*[cols[c][mine] for c in ("column", "low", "high", "left", "value")], depth))
        model = self.cls(trees, json.loads(meta["weights"]), np.array(meta["importances"]), meta["base"], meta["mean"])
        model._resetUid(meta["uid"])
        return model


def _valued(tree: Grown, at: Binning) -> tuple:
    """The tree's arrays with its bins turned into values of the inputs."""
    column, low, high, left, value, depth = tree.arrays()
    lows, highs = np.full(len(low), np.inf), np.full(len(high), -np.inf)
    for i in np.flatnonzero(np.array(tree.slot) >= 0):
        if column[i] < len(at.cuts):
            lows[i], highs[i] = at.cuts[column[i]][low[i]], np.inf
        else:
            lows[i], highs[i] = high[i] - 0.5, high[i] + 0.5
    return column, lows, highs, left, value, depth


def _importances(trees: list[Grown], weights: list[float], width: int) -> np.ndarray:
    """Gains by slot, each tree's adding up to its weight, all to 1."""
    total = np.zeros(width)
    for tree, w in zip(trees, weights, strict=True):
        own = np.zeros(width)
        for s, g in zip(tree.slot, tree.gain, strict=True):
            if s >= 0:
                own[s] += g
        total += w * own / own.sum() if own.sum() else 0.0
    return total / total.sum() if total.sum() else total


@dataclass(frozen=True)
class TreeTrainer:
    """Estimator of a forest or of boosting; settings by MLlib's names."""
    kind: str
    seed: int = 42
    numTrees: int = 100
    maxIter: int = 100
    stepSize: float = 0.1
    maxDepth: int = 5
    minInstancesPerNode: int = 1
    subsamplingRate: float = 1.0
    featureSubsetStrategy: str | float = "all"

    def fit(self, rows: DataFrame) -> TreeEnsemble:
        ship_package(rows.sparkSession)
        first = rows.select(INPUTS, SIZES).first()
        if first is None:
            raise ValueError("trees need training rows")
        sizes = tuple(first[SIZES])
        at = fit_bins(rows, len(first[INPUTS]) - len(sizes), sizes)
        blocks = pack(rows, at)
        return self._forest(blocks, at) if self.kind == "random_forest" else self._boosted(blocks, at)

    def _forest(self, blocks: DataFrame, at: Binning) -> TreeEnsemble:
        drawn = _weights(self.subsamplingRate, True)
        found = grow(blocks, at, list(range(self.numTrees)), self.maxDepth, self.minInstancesPerNode, self.featureSubsetStrategy,
                     self.seed, drawn)
        trees = [found[t] for t in range(self.numTrees)]
        return TreeEnsemble([_valued(t, at) for t in trees], [1.0] * len(trees), _importances(trees, [1.0] * len(trees), at.width),
                            at.mean, True)

    def _boosted(self, blocks: DataFrame, at: Binning) -> TreeEnsemble:
        drawn = _weights(self.subsamplingRate, False)
        trees, weights, since, held = [], [], [], None
        for m in range(self.maxIter):
            # the gradient of (y - F)^2 is -2 (y - F)
            tree = grow(blocks, at, [m], self.maxDepth, self.minInstancesPerNode, self.featureSubsetStrategy, self.seed, drawn,
                        since, 2.0 if m else 1.0)[m]
            trees.append(tree)
            weights.append(self.stepSize if m else 1.0)
            since.append((weights[-1], tree.arrays()))
            if len(since) == REFRESH and m + 1 < self.maxIter:
                fresh = blocks.mapInArrow(_refresh(at, since), BLOCK_SCHEMA).persist(StorageLevel.MEMORY_AND_DISK)
                fresh.count()
                if held is not None:
                    held.unpersist()
                blocks, held, since = fresh, fresh, []
        if held is not None:
            held.unpersist()
        return TreeEnsemble([_valued(t, at) for t in trees], weights, _importances(trees, weights, at.width), at.mean, False)


def _refresh(at: Binning, since: list[tuple[float, tuple]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ys = []
            for n, bins, y in zip(*[batch.column(k) for k in (1, 2, 3)], strict=True):
                ys.append(_residual(*_unpack(bins.as_buffer(), y.as_buffer(), n.as_py(), at), since).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(ys, pa.binary())],
                                             names=["block", "n", "bins", "y"])
    return run
