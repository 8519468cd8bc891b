"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages that only share the document's label. Every
passage is described by what its characters and words look like (shares of
character classes and of their pairs, word length, repetition), encoded by a
tanh layer into h, and weighed by gated attention,
    a = softmax(w . (tanh(V h) * sigmoid(U h))),
learned from document labels alone; the document's score is a logistic
function of the weighted representation sum(a h). Trained by Adam on
mini-batches of bags.

Passages are PASSAGE_CHARS long. Scoring reads them all at that length, whatever
the text's, and pools in blocks of BLOCK passages: the greatest attention logit
so far and the sums of exp(e) and exp(e) h relative to it give the exact softmax
in constant memory. Training alone bounds a bag: there a text longer than MAX_BAG
passages is cut into MAX_BAG equal longer ones, so the whole text counts.

Defined cases: a null text is an empty one; an empty text is a bag of one
passage of zeros and gets a score too; several labels of one id are averaged,
null labels and null ids are not learned from; without any label, or with one
class only, the prior is the score; repeated rows get equal scores; extra
columns are ignored.

Scale: the classifier is fitted on at most TRAIN_DOCS labelled documents (those
with the smallest hash of their id), whose passage features (not texts) meet in one
task that returns the weights; scoring is one pass without a shuffle.
"""

from __future__ import annotations

import operator
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import fresh, held_out, python_tasks, table

PASSAGE_CHARS = 512
MAX_BAG = 64  # of a training text
BLOCK, ROWS = 64, 512
TRAIN_DOCS = 6000
HIDDEN, ATTENTION = 32, 16
STEPS, BATCH, RATE, DECAY = 660, 128, 3e-3, 1e-5
CLASSES = 14


def _classes() -> np.ndarray:
    """Class of every 16-bit unit: letters by case, digits, blanks, kinds of punctuation, the rest."""
    out = np.full(1 << 16, 13, np.uint8)
    for i in range(1 << 16):
        c = chr(i)
        if c.isalpha():
            out[i] = 0 if c.islower() else 1 if c.isupper() else 2
        elif c.isdigit():
            out[i] = 3
        elif c.isspace():
            out[i] = 5 if c == "\n" else 4
    for k, chars in enumerate((".", ",", "!?", "'\"-:;()", "#$%&*", "|", "<>=/\\_@{}[]+^~`"), 6):
        out[[ord(c) for c in chars]] = k
    return out


CLASS = _classes()
FEATURES = CLASSES * CLASSES + CLASSES + 5


def blocks(text: str | None) -> Iterator[list[str]]:
    """All passages of a text, in lists of at most BLOCK."""
    text = text or ""
    for a in range(0, max(1, len(text)), BLOCK * PASSAGE_CHARS):
        part = text[a: a + BLOCK * PASSAGE_CHARS]
        yield [part[i: i + PASSAGE_CHARS] for i in range(0, len(part), PASSAGE_CHARS)] or [""]


def passages(text: str | None) -> list[str]:
    """The passages of a training text, at most MAX_BAG."""
    text = text or ""
    step = max(PASSAGE_CHARS, -(-len(text) // MAX_BAG))
    return [text[i: i + step] for i in range(0, len(text), step)] or [""]


def features(bag: list[str]) -> np.ndarray:
    """One row of FEATURES numbers per passage."""
    out = np.zeros((len(bag), FEATURES), np.float32)
    for row, p in zip(out, bag, strict=True):
        if not p:
            continue
        c = CLASS[np.frombuffer(p.encode("utf-16-le", "replace"), "<u2")].astype(np.int64)
        row[:CLASSES] = np.bincount(c, minlength=CLASSES) / len(c)
        pairs = np.bincount(c[:-1] * CLASSES + c[1:], minlength=CLASSES * CLASSES)
        row[CLASSES: CLASSES + CLASSES * CLASSES] = np.sqrt(pairs / len(c))
        w = p.split()
        n = max(1, len(w))
        row[-5:] = (len(set(w)) / n, sum(map(operator.eq, w, w[1:])) / n, len(p) / n / 10, np.log1p(n) / 5,
                    len(set(p)) / 50)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class AttentionMIL:
    """Gated-attention pooling over passage encodings; bags are row ranges of one matrix."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float64)
        self.w = {"W": draw(FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "V": draw(HIDDEN, ATTENTION),
                  "U": draw(HIDDEN, ATTENTION), "a": draw(ATTENTION), "c": draw(HIDDEN), "d": np.zeros(1)}
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """Scaled features, encoding, both gates and the attention logit of every passage."""
        w = self.w
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        h = np.tanh(x @ w["W"] + w["b"])
        tv, su = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
        return x, h, tv, su, (tv * su) @ w["a"]

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict:
        w = self.w
        x, h, tv, su, e = self.encode(x)
        sizes = np.diff(np.append(starts, len(x)))
        bag = np.repeat(np.arange(len(starts)), sizes)
        e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts)
        return {"x": x, "bag": bag, "h": h, "tv": tv, "su": su, "a": a, "z": z, "p": _sigmoid(z @ w["c"] + w["d"])}

    def gradient(self, f: dict, y: np.ndarray, starts: np.ndarray) -> dict:
        w, bag = self.w, f["bag"]
        g = (f["p"] - y) / len(y)
        dz = g[:, None] * w["c"]
        da = (dz[bag] * f["h"]).sum(1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, starts)[bag])
        dg = de[:, None] * w["a"]
        dtv, dsu = dg * f["su"] * (1 - f["tv"] ** 2), dg * f["tv"] * f["su"] * (1 - f["su"])
        dh = (f["a"][:, None] * dz[bag] + dtv @ w["V"].T + dsu @ w["U"].T) * (1 - f["h"] ** 2)
        return {"W": f["x"].T @ dh, "b": dh.sum(0), "V": f["h"].T @ dtv, "U": f["h"].T @ dsu,
                "a": (f["tv"] * f["su"]).T @ de, "c": f["z"].T @ g, "d": np.array([g.sum()])}

    def fit(self, bags: list[np.ndarray], y: np.ndarray) -> AttentionMIL:
        n = sum(len(b) for b in bags)
        self.mean = sum(b.sum(0, dtype=np.float64) for b in bags) / n
        self.scale = np.sqrt(sum(((b - self.mean) ** 2).sum(0) for b in bags) / n) + 1e-2
        prior = np.clip(y.mean(), 0.01, 0.99)
        self.w["d"][:] = np.log(prior / (1 - prior))
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(x) for k, x in self.w.items()}
        rng, t = np.random.default_rng(11), 0
        while t < STEPS:
            rate = RATE * (1 - t / STEPS) + 1e-5
            order = rng.permutation(len(bags))
            for i in range(0, len(order), BATCH):
                part = [bags[j] for j in order[i: i + BATCH]]
                starts = np.concatenate([[0], np.cumsum([len(b) for b in part])[:-1]])
                got = self.forward(np.concatenate(part), starts)
                t += 1
                for k, g in self.gradient(got, y[order[i: i + BATCH]], starts).items():
                    g = g + DECAY * self.w[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.w[k] -= rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
        return self

    def score(self, texts: list[str | None]) -> np.ndarray:
        top, mass, z = np.full(len(texts), -np.inf), np.zeros(len(texts)), np.zeros((len(texts), HIDDEN))
        wait: list[tuple[int, np.ndarray]] = []

        def flush() -> None:
            _, h, _, _, e = self.encode(np.concatenate([x for _, x in wait]))
            a = 0
            for row, x in wait:
                he, ee = h[a: a + len(x)], e[a: a + len(x)]
                a += len(x)
                most = max(top[row], ee.max())
                keep, ee = np.exp(top[row] - most), np.exp(ee - most)
                mass[row] = mass[row] * keep + ee.sum()
                z[row] = z[row] * keep + ee @ he
                top[row] = most
            wait.clear()
        held = 0
        for row, text in enumerate(texts):
            for block in blocks(text):
                wait.append((row, features(block)))
                held += len(block)
                if held >= ROWS:
                    flush()
                    held = 0
        if wait:
            flush()
        return _sigmoid((z / mass[:, None]) @ self.w["c"] + self.w["d"])


def training_bags(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id (as text), y, x: label and passage features (32-bit floats) of at most TRAIN_DOCS labelled
    documents of the training folds."""
    python_tasks(docs.sparkSession, 1000)
    known = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), 3, 1))
             .groupBy("doc_id").agg(F.avg(F.col("quality").cast("double")).alias("y")))
    chosen = known.orderBy(F.xxhash64("doc_id", F.lit("bags")), "doc_id").limit(TRAIN_DOCS)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        F.col("doc_id").cast("string"), "y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(passages(t)).tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())],
                                             names=["doc_id", "y", "x"])
    return rows.mapInArrow(run, "doc_id string, y double, x binary").limit(2 * TRAIN_DOCS)


def model_of(bags: list[np.ndarray], y: np.ndarray) -> AttentionMIL:
    """The fitted model; the prior alone without two classes."""
    model = AttentionMIL()
    if len(y) and (y > 0.5).any() and (y <= 0.5).any():
        return model.fit(bags, y)
    prior = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
    model.w["c"][:], model.w["d"][:] = 0, np.log(prior / (1 - prior))
    return model


def train(docs: DataFrame, labels: DataFrame) -> AttentionMIL:
    """Fit in one task, on the bounded sample, so that the driver holds the weights alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            rows += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
        rows.sort()
        bags = [np.frombuffer(x, np.float32).reshape(-1, FEATURES) for _, _, x in rows]
        model = model_of(bags, np.array([min(1.0, max(0.0, y)) for _, y, _ in rows]))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])
    got = training_bags(docs, labels).repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(got[0]["model"]) if got else model_of([], np.zeros(0))


def classify(docs: DataFrame, model: AttentionMIL, score: str, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``score`` (0 to 1)."""
    python_tasks(docs.sparkSession, 1000)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # fixed size
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(sent.value.score(batch.column(at).to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, score])
    return docs.mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents the classifier does not reject; all columns."""
    score = fresh(docs, "score")
    return classify(docs, train(docs, labels), score).where(F.col(score) >= 0.5).drop(score)


def op2_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = classify(docs, train(docs, table(spark, sf_dir, "labels")), "score")
    return scored.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
