"""LM scoring by a hashed maximum-entropy model with class-factored softmax.

    p(w | history) = p(class | history) * p(w | class, history)

The HEAD most frequent training words (the end token among them) fill classes
of CLASS_WORDS; every other word falls into one of TAIL classes by its last
two bytes, inside which its probability is its add-one relative frequency (an
unseen word has count 0). Both softmaxes of head words are log-linear: a bias
from the training counts plus weights of features of the three words before:
each of them (the second and third are skip features) and, hashed, the
bigram before. The words-within-class softmax uses hashed (word before,
class) and (word two before, class) features.

Training: ROUNDS distributed gradient steps, each over another slice of the
training documents, together all of them. Tasks return the observed and
expected feature sums of their share, which are added up by row blocks in a
shuffle; the driver, which holds only the fixed-size weights, takes the step
gradient / (max(observed, expected) + SMOOTH).

Scoring works in batches of sparse feature indices (numpy). Counts of the
LEXICON most frequent words travel with the task (a fixed number); words
outside it are joined to the full count table in Spark.

Defined cases: null text is empty; an empty text is one end token; rows with a
null id are held out; repeated rows count and score each; without training
documents counts are 0 and weights stay 0; extra columns are ignored; long
texts are read in pieces.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import held_out, materialize, most_frequent, python_tasks, table, word_lists

CLASS_WORDS, HEAD_CLASSES, TAIL = 32, 32, 16
HEAD, CLASSES = CLASS_WORDS * HEAD_CLASSES, HEAD_CLASSES + TAIL
SYMBOLS = HEAD + TAIL + 1  # the last stands before a text
PAIRS, INNER = 1 << 13, 1 << 14
ROWS = 3 * SYMBOLS + PAIRS
LEXICON = 1 << 18
ROUNDS, RATE, SMOOTH = 4, 0.5, 2.0
TOKENS, PART = 1 << 16, 1 << 13
BLOCK = 512
END = b""  # no word is empty


def count_words(docs: DataFrame) -> DataFrame:
    """word (binary, the end token empty), c: counts over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())],
                                             names=["word", "n"])
            held.clear()
            return got
        for batch in batches:
            for value in batch.column(0):
                for words in word_lists(value.as_py()):
                    held.update(words)
                held[END] += 1
                if len(held) > 400_000:
                    yield out()
        yield out()
    python_tasks(docs.sparkSession, 200)
    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAIL


class Lexicon:
    """Symbols and counts of frequent words: the head, then others by class; biases from the counts."""

    def __init__(self, words: list[bytes], counts: list[int], tail_n: np.ndarray, tail_v: np.ndarray,
                 total: int, distinct: int):
        by = sorted(zip(words, counts, strict=True), key=lambda x: (x[0] != END, -x[1], x[0]))
        if not by or by[0][0] != END:
            by.insert(0, (END, 0))
        self.words = [w for w, _ in by]
        self.total, self.distinct = total, distinct
        c = np.array([n for _, n in by], float)
        self.log_count = np.log10(c + 1)
        self.known = c > 0
        self.symbol = np.array([i if i < HEAD else HEAD + tail_class(w) for i, w in enumerate(self.words)], np.int32)
        head = np.full(HEAD, -np.inf)
        head[: min(HEAD, len(c))] = np.log(c[:HEAD] + 1)
        self.word_bias = head.reshape(HEAD_CLASSES, CLASS_WORDS)
        self.tail_log = np.log10(tail_n + tail_v + 1)
        mass = np.concatenate([np.where(np.isfinite(self.word_bias), np.exp(self.word_bias), 0).sum(1), tail_n + tail_v + 1])
        self.class_bias = np.where(mass > 0, np.log(np.maximum(mass, 1) / mass.sum()), -1e4).astype(np.float32)
        of_class = np.log(np.maximum(mass[:HEAD_CLASSES, None], 1))
        self.word_bias = np.maximum(self.word_bias - of_class, -1e4).astype(np.float32)
        self.index: dict[bytes, int] = {}

    def open(self) -> Lexicon:
        self.index = {w: i for i, w in enumerate(self.words)}
        return self

    def __getstate__(self) -> dict:
        return self.__dict__ | {"index": {}}

    def read(self, text: str | None) -> tuple[np.ndarray, np.ndarray, Counter]:
        """Lexicon rows (-1 outside) and symbols of the tokens, and the words outside."""
        rows, symbols, rest = [], [], Counter()
        get = self.index.get
        for words in word_lists(text):
            at = np.array([get(w, -1) for w in words], np.int32)
            sym = self.symbol[at]
            for i in np.flatnonzero(at < 0):
                rest[words[i]] += 1
                sym[i] = HEAD + tail_class(words[i])
            rows.append(at)
            symbols.append(sym)
        return np.concatenate([*rows, [0]]).astype(np.int32), np.concatenate([*symbols, [0]]).astype(np.int32), rest


class Model:
    def __init__(self):
        self.w1 = np.zeros((ROWS, CLASSES), np.float32)
        self.w2 = np.zeros((INNER, CLASS_WORDS), np.float32)


def history(symbols: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Target and the three symbols before it, texts strung together."""
    first = np.full(3, SYMBOLS - 1, np.int32)
    parts = [np.concatenate([first, s]) for s in symbols]
    cut = lambda k: np.concatenate([p[3 - k: len(p) - k] for p in parts]).astype(np.int64)
    return cut(0), cut(1), cut(2), cut(3)


def _hash(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    h = (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ (b.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F))
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(40)).astype(np.int64) % size


def class_features(u: np.ndarray, v: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
    return [u, SYMBOLS + v, 2 * SYMBOLS + x, 3 * SYMBOLS + _hash(u, v, PAIRS)]


def word_features(u: np.ndarray, v: np.ndarray, c: np.ndarray) -> list[np.ndarray]:
    return [_hash(u * 2, c, INNER), _hash(v * 2 + 1, c, INNER)]


def logits(bias: np.ndarray, weights: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """Biases are log probabilities and weights small, so exponentials need no shift."""
    z = weights[rows[0]]
    for r in rows[1:]:
        z += weights[r]
    z += bias
    return z


def log_probs(m: Model, lex: Lexicon, t: np.ndarray, u: np.ndarray, v: np.ndarray,
              x: np.ndarray | None = None) -> np.ndarray:
    """Log10 probability of each token but for the count of a tail word; without ``x``, the text starts two before."""
    x = np.full(len(t), SYMBOLS - 1) if x is None else x
    head = t < HEAD
    c = np.where(head, t // CLASS_WORDS, t - HEAD + HEAD_CLASSES)
    z = logits(lex.class_bias, m.w1, class_features(u, v, x))
    picked = z[np.arange(len(t)), c].astype(np.float64)
    out = picked - np.log(np.exp(z, out=z) @ np.ones(CLASSES, np.float32))
    if head.any():
        ch = c[head]
        z = logits(lex.word_bias[ch], m.w2, word_features(u[head], v[head], ch))
        picked = z[np.arange(len(ch)), t[head] % CLASS_WORDS].astype(np.float64)
        out[head] += picked - np.log(np.exp(z, out=z) @ np.ones(CLASS_WORDS, np.float32))
    out /= np.log(10)
    out[~head] -= lex.tail_log[t[~head] - HEAD]
    return out


class Sums:
    """Observed and expected feature sums of both softmaxes."""

    def __init__(self):
        self.parts = [(np.zeros((ROWS, CLASSES), np.float32), np.zeros((ROWS, CLASSES), np.float32)),
                      (np.zeros((INNER, CLASS_WORDS), np.float32), np.zeros((INNER, CLASS_WORDS), np.float32))]

    @staticmethod
    def _expect(expected: np.ndarray, rows: list[np.ndarray], z: np.ndarray) -> None:
        e = np.exp(z, out=z)
        e /= (e @ np.ones(e.shape[1], np.float32))[:, None]
        for r in rows:
            order = np.argsort(r.astype(np.uint16), kind="stable")  # a radix sort; rows are fewer than 2^16
            s = r[order]
            first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
            expected[s[first]] += np.add.reduceat(e[order], first, axis=0)

    @staticmethod
    def _see(seen: np.ndarray, rows: list[np.ndarray], target: np.ndarray) -> None:
        flat = np.concatenate([r * seen.shape[1] + target for r in rows])
        seen += np.bincount(flat, minlength=seen.size).reshape(seen.shape)

    def add(self, m: Model, lex: Lexicon, t: np.ndarray, u: np.ndarray, v: np.ndarray, x: np.ndarray) -> None:
        head = t < HEAD
        c = np.where(head, t // CLASS_WORDS, t - HEAD + HEAD_CLASSES)
        rows = class_features(u, v, x)
        self._see(self.parts[0][0], rows, c)
        for a in range(0, len(t), PART):
            part = [r[a: a + PART] for r in rows]
            self._expect(self.parts[0][1], part, logits(lex.class_bias, m.w1, part))
        ch, th = c[head], t[head] % CLASS_WORDS
        rows = word_features(u[head], v[head], ch)
        self._see(self.parts[1][0], rows, th)
        for a in range(0, len(ch), PART):
            part = [r[a: a + PART] for r in rows]
            self._expect(self.parts[1][1], part, logits(lex.word_bias[ch[a: a + PART]], m.w2, part))


def chunks(symbols: list[np.ndarray], size: int) -> Iterator[tuple[np.ndarray, ...]]:
    h = history(symbols)
    for a in range(0, len(h[0]), size):
        yield tuple(y[a: a + size] for y in h)


def step(docs: DataFrame, model: Model, lex) -> None:
    """One distributed gradient step over ``docs``, into ``model``."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)  # fixed size
    schema = "part int, block int, seen binary, expected binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, sums, wait, size = lex.value.open(), Sums(), [], 0

        def flush() -> None:
            for part in chunks(wait, TOKENS):
                sums.add(sent.value, lexicon, *part)
            wait.clear()
        for batch in batches:
            for value in batch.column(0):
                wait.append(lexicon.read(value.as_py())[1])
                size += len(wait[-1])
                if size >= TOKENS:
                    flush()
                    size = 0
        if wait:
            flush()
        out = [(p, i, s[i: i + BLOCK].tobytes(), x[i: i + BLOCK].tobytes()) for p, (s, x) in enumerate(sums.parts)
               for i in range(0, len(s), BLOCK) if x[i: i + BLOCK].any()]
        cols = list(zip(*out, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
            cols, (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["part", "block", "seen", "expected"])

    def total(key: tuple, t: pa.Table) -> pa.Table:
        add = lambda name: sum(np.frombuffer(b.as_py(), np.float32).astype(float) for b in t[name]).astype(np.float32).tobytes()
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()),
                         "seen": pa.array([add("seen")], pa.binary()), "expected": pa.array([add("expected")], pa.binary())})
    # as many partial sums as the cluster has cores, however many files there are
    tasks = docs.select("text").coalesce(spark.sparkContext.defaultParallelism)
    for r in tasks.mapInArrow(run, schema).groupBy("part", "block").applyInArrow(total, schema).collect():
        w = (model.w1, model.w2)[r["part"]]
        seen, expected = (np.frombuffer(r[k], np.float32).reshape(-1, w.shape[1]) for k in ("seen", "expected"))
        w[r["block"]: r["block"] + BLOCK] += RATE * (seen - expected) / (np.maximum(seen, expected) + SMOOTH)


def lexicon(vocab: DataFrame) -> Lexicon:
    """The LEXICON most frequent words and the totals of the tail classes, from the full count table."""
    total, distinct = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = most_frequent(vocab, "c", LEXICON).toArrow()
    words, counts = top["word"].to_pylist(), top["c"].to_pylist()
    rank = sorted(zip(words, counts, strict=True), key=lambda x: (x[0] != END, -x[1], x[0]))[:HEAD]
    tail_n, tail_v = np.zeros(TAIL), np.zeros(TAIL)
    k = F.crc32(F.substring("word", -2, 2)) % TAIL
    for r in vocab.where(F.length("word") > 0).groupBy(k.alias("k")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        tail_n[r["k"]], tail_v[r["k"]] = r["n"], r["v"]
    for w, c in rank:
        if w != END:
            tail_n[tail_class(w)] -= c
            tail_v[tail_class(w)] -= 1
    return Lexicon(words, counts, tail_n, tail_v, total, distinct)


def train(docs: DataFrame) -> tuple[DataFrame, object, Model]:
    """Count table, broadcast lexicon and weights, from all rows of ``docs``."""
    spark = docs.sparkSession
    vocab = materialize(count_words(docs), "lm-counts")
    lex = spark.sparkContext.broadcast(lexicon(vocab))  # at most LEXICON words
    model = Model()
    for r in range(ROUNDS):
        step(docs.where(F.pmod(F.xxhash64("doc_id", F.lit("round")), F.lit(ROUNDS)) == r), model, lex)
    return vocab, lex, model


def score(docs: DataFrame, vocab: DataFrame, lex, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score of every row."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_tokens", "n_known", "base", "lm", "rest"]
    rest_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = lex.value.open()
        for batch in batches:
            n, known, base, lm, rest, wait, ends = [], [], [], [], [], [], []

            def flush() -> None:
                sums = np.zeros(len(wait))
                owner, a = np.repeat(np.arange(len(wait)), [len(s) for s in wait]), 0
                for part in chunks(wait, PART):
                    b = a + len(part[0])
                    sums += np.bincount(owner[a:b], log_probs(sent.value, lexicon, *part), len(wait))
                    a = b
                lm.extend(sums + ends)
                wait.clear()
                ends.clear()
            for value in batch.column(1):
                rows, symbols, outside = lexicon.read(value.as_py())
                inside = rows[rows >= 0]
                logs = lexicon.log_count[inside]
                n.append(len(rows))
                known.append(int(lexicon.known[inside].sum()))
                base.append(float(logs.sum()))
                ends.append(float(logs[lexicon.symbol[inside] >= HEAD].sum()))
                rest.append([{"word": w, "n": c} for w, c in outside.items()])
                wait.append(symbols)
                if sum(map(len, wait)) >= TOKENS:
                    flush()
            if wait:
                flush()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                                              pa.array(base, pa.float64()), pa.array(lm, pa.float64()),
                                              pa.array(rest, rest_type)], names=names)
    python_tasks(spark, 200)
    rows = docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, n_known long, base double, lm double, rest array<struct<word:binary,n:long>>")
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    rare = (rows.select("row", F.inline("rest")).join(vocab, "word").groupBy("row")
            .agg(F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("logs"), F.sum("n").alias("seen")))
    norm = float(np.log10(lex.value.total + lex.value.distinct + 1))
    logs = F.coalesce("logs", F.lit(0.0))
    return rows.drop("rest").join(rare, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(int(lex.value.total)).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * F.lit(norm)).alias("base_score"), (F.col("lm") + logs).alias("score"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 7, 2)
    scored = score(docs, *train(docs.where(~out)))
    return scored.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
