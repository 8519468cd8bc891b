"""Language identification by character Kneser-Ney models.

Training counts every character 4-gram of every training text, per language
(per task first, then one aggregate). From the full counts Spark derives an
interpolated Kneser-Ney model per language: continuation counts for the lower
orders, absolute discounts D = n1 / (n1 + 2 n2) per order, context totals, a
uniform floor. The n-grams of all languages are kept in sorted arrays of
hashes, each with its (language, probability) entries, and looked up by binary
search. A text goes to the language with the lowest cross-entropy per character.

Size: the model, which is sent to every task, holds every n-gram of the training
texts. It grows with a language's different n-grams (its alphabet and spelling),
not with its rows. ``keep`` cuts a language to its most frequent n-grams of every
order above the first where a caller must bound it: discounts, totals and
continuation counts still come from all n-grams, and the mass of those left out
goes to the back-off of their context, so probabilities still sum to one.

Calibration: training texts are dealt into two halves by a hash of their ids, and
every text is scored by models of the other half's counts. On these unseen texts,
all of them, a temperature for ``score`` (the softmax of negative entropies) is
fitted, and the entropy that all but REJECT_SHARE of right answers stay under;
texts above it are flagged ``rejected``. Tasks hand on sums of the losses and the
counts of entropies in steps of LIMIT_STEP. Predictions use the models of all
training texts.

Characters: letters in lower case, any run of others one space. An n-gram is
four UTF-16 units, 64 bits, hashed by an odd multiplier (one-to-one).

Defined cases: a text that is null, empty or without a letter is ``und`` with
score 0; ties go to the first language in sorted order; rows of null
language or null id are not learned from (an empty name is a language); without any training text all are
``und``; repeated rows count as often as they occur; extra columns are
ignored; very long texts are read in pieces of PIECE units.

Scale: every step up to the kept n-grams is a Spark aggregate or a window over
one context of one language (at most as many rows as there are units).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import held_out, materialize, python_tasks, table

ORDER = 4
CELLS = 1 << 22  # (n-gram, language) cells computed at once, and of the ready scores
TEMPERATURES = 2.0 ** np.arange(0, 9)
LIMIT_STEP = 1e-3  # nats a character
REJECT_SHARE = 0.001
PIECE = 1 << 19
FLUSH = 2_000_000
MIX = np.uint64(0x9E3779B97F4A7C15)
UNSEEN = "und"

_LETTER = np.zeros(1 << 16, bool)
_LETTER[[i for i in range(1 << 16) if 0xD800 <= i < 0xE000 or chr(i).isalpha()]] = True
_BEYOND = re.compile("[\U00010000-\U0010ffff]")


def units(text: str | None) -> np.ndarray:
    """Letters in lower case, other runs as one space, a space at both ends; empty without a letter."""
    text = (text or "").lower()
    text = _BEYOND.sub(lambda m: m[0] if m[0].isalpha() else " ", text)
    u = np.frombuffer(text.encode("utf-16-le", "replace"), "<u2")
    letter = _LETTER[u]
    if not letter.any():
        return u[:0]
    u = np.concatenate([[32], np.where(letter, u, 32), [32]]).astype(np.uint64)
    space = u == 32
    return u[~(space & np.concatenate([[False], space[:-1]]))]


def grams(u: np.ndarray, n: int = ORDER) -> np.ndarray:
    """Every n-gram as n packed units, in text order."""
    out = u[: max(0, len(u) - n + 1)].copy()
    for i in range(1, n):
        out = (out << np.uint64(16)) | u[i: len(u) - n + 1 + i]
    return out


def tail(g: np.ndarray, n: int) -> np.ndarray:
    return g & np.uint64((1 << (16 * n)) - 1)


def merge(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def count_grams(rows: DataFrame) -> DataFrame:
    """lang, gram (packed, as a signed integer), n from (lang, text) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def emit(lang: str) -> pa.RecordBatch:
            k, c = merge(np.concatenate([x[0] for x in held[lang]]), np.concatenate([x[1] for x in held[lang]]))
            held[lang] = [(k, c)]
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(k)), pa.array(k.view(np.int64)), pa.array(c)],
                                              names=["lang", "gram", "n"])

        def add(lang: str, parts: list[np.ndarray]) -> None:
            held.setdefault(lang, []).append(np.unique(np.concatenate(parts), return_counts=True))

        for batch in batches:
            wait: dict[str, list] = {}
            size: dict[str, int] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                u = units(text.as_py())
                for a in range(0, max(1, len(u)), PIECE):
                    wait.setdefault(lang, []).append(grams(u[a: a + PIECE + ORDER - 1]))
                    size[lang] = size.get(lang, 0) + len(wait[lang][-1])
                    if size[lang] > PIECE:
                        add(lang, wait.pop(lang))
                        size[lang] = 0
            for lang, parts in wait.items():
                add(lang, parts)
            for lang in list(held):
                if sum(len(x[0]) for x in held[lang]) > FLUSH:
                    out = emit(lang)
                    if out.num_rows > FLUSH // 2:  # merging no longer helps: hand them on
                        del held[lang]
                        yield out
        for lang in held:
            yield emit(lang)
    python_tasks(rows.sparkSession, 1000)
    return (rows.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


class Entries:
    """Sorted n-gram hashes, each with its (language, value) entries."""

    def __init__(self, gram: np.ndarray, lang: np.ndarray, value: np.ndarray):
        h = gram * MIX
        order = np.lexsort((lang, h))
        self.keys, self.start = np.unique(h[order], return_index=True)
        self.start = np.append(self.start, len(h))
        self.lang, self.value = lang[order].astype(np.int32), value[order].astype(np.float32)

    def find(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of g, language, value) of all entries of the n-grams ``g``."""
        h = g * MIX
        i = np.searchsorted(self.keys, h)
        hit = np.flatnonzero(self.keys[np.minimum(i, len(self.keys) - 1)] == h) if len(self.keys) else np.zeros(0, int)
        first, n = self.start[i[hit]], self.start[i[hit] + 1] - self.start[i[hit]]
        at = np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)
        return np.repeat(hit, n), self.lang[at], self.value[at]


class Models:
    """Interpolated Kneser-Ney models of all languages over shared sorted hash arrays.

    Made of (language number, order, packed n-gram, discounted probability)
    entries. ``p[n]`` holds them per order, ``back[n]`` the weight that a
    context passes to the next lower order: what its entries leave of one.
    The 4-grams that most languages know have their scores ready.
    """

    def __init__(self, langs: list[str], units: int, lang: np.ndarray, order: np.ndarray, gram: np.ndarray, p: np.ndarray):
        self.langs, self.floor = langs, 1.0 / (units + 1)
        self.step = max(1 << 10, min(PIECE, CELLS // max(1, len(langs))))
        self.p, self.back = {}, {}
        for o in range(1, ORDER + 1):
            g, i, v = gram[order == o], lang[order == o], p[order == o]
            self.p[o] = Entries(g, i, v)
            by = np.lexsort((i, g >> np.uint64(16)))
            ctx, i, v = (g >> np.uint64(16))[by], i[by], v[by]
            first = np.flatnonzero(np.r_[True, (ctx[1:] != ctx[:-1]) | (i[1:] != i[:-1])]) if len(ctx) else np.zeros(0, int)
            left = 1 - np.add.reduceat(v, first) if len(first) else v
            self.back[o] = Entries(ctx[first], i[first], np.maximum(left, 1e-9))
        g, known = np.unique(gram[order == ORDER], return_counts=True)
        g = g[np.argsort(-known, kind="stable")[: CELLS // max(1, len(langs))]]
        g = g[np.argsort(g * MIX)]
        self.ready, self.scores = g * MIX, self._logp(g)

    def _logp(self, g: np.ndarray) -> np.ndarray:
        out = np.empty((len(g), len(self.langs)), np.float32)
        for a in range(0, len(g), self.step):
            part = g[a: a + self.step]
            p = np.full((len(part), len(self.langs)), self.floor)
            for o in range(1, ORDER + 1):
                key = tail(part, o)
                row, lang, v = self.back[o].find(key >> np.uint64(16))
                p[row, lang] *= v
                row, lang, v = self.p[o].find(key)
                p[row, lang] += v
            out[a: a + self.step] = np.log(p)
        return out

    def score(self, g: np.ndarray) -> np.ndarray:
        """Log probabilities [n-gram, language] of the last unit of each packed 4-gram."""
        h = g * MIX
        i = np.minimum(np.searchsorted(self.ready, h), len(self.ready) - 1)
        out = self.scores[i]
        miss = np.flatnonzero(self.ready[i] != h)
        if len(miss):
            seen, which = np.unique(g[miss], return_inverse=True)
            out[miss] = self._logp(seen)[which]
        return out

    def entropies(self, texts: list[str | None]) -> np.ndarray:
        """Nats per character [text, language]; nan for a text without a letter."""
        out = np.full((len(texts), len(self.langs)), np.nan)
        wait, ends, size = [], [], 0
        if not self.langs:
            return out

        def flush() -> None:
            if wait:
                s = self.score(np.concatenate(wait))
                starts = np.concatenate([[0], np.cumsum([len(w) for w in wait])[:-1]])
                sums = np.add.reduceat(s, starts, axis=0, dtype=np.float64)
                for (row, n), v in zip(ends, sums, strict=True):
                    out[row] = np.nan_to_num(out[row]) - v / n
                wait.clear()
                ends.clear()
        for row, text in enumerate(texts):
            u = units(text)
            if not len(u):
                continue
            u = np.concatenate([np.full(ORDER - 2, 32, np.uint64), u])
            n = len(u) - ORDER + 1
            for a in range(0, n, self.step):
                part = grams(u[a: a + self.step + ORDER - 1])
                wait.append(part)
                ends.append((row, n))
                size += len(part)
                if size > self.step:
                    flush()
                    size = 0
        flush()
        return out


def gram_counts(rows: DataFrame) -> DataFrame:
    return materialize(count_grams(rows.where(F.col("lang").isNotNull())), "lid-counts")


def probabilities(counts: DataFrame, keep: int | None = None) -> DataFrame:
    """lang, o, gram, p: discounted probabilities of the n-grams of every order (of the ``keep`` most frequent), from all counts."""
    level = counts.select("lang", F.lit(ORDER).alias("o"), "gram", "n")
    every = level
    for o in range(ORDER - 1, 0, -1):  # continuation counts: distinct left neighbours
        level = (level.groupBy("lang", F.col("gram").bitwiseAND(F.lit((1 << (16 * o)) - 1)).alias("gram"))
                 .agg(F.count("*").alias("n")).select("lang", F.lit(o).alias("o"), "gram", "n"))
        every = every.unionAll(level)
    every = materialize(every, "lid-orders")
    n1, n2 = (F.sum(F.when(F.col("n") == k, 1).otherwise(0)) for k in (1, 2))
    discount = every.groupBy("lang", "o").agg(
        F.when((n1 > 0) & (n2 > 0), n1 / (n1 + 2 * n2)).otherwise(F.lit(0.5)).alias("d"))
    context = Window.partitionBy("lang", "o", F.shiftrightunsigned("gram", 16))
    told = every.withColumn("total", F.sum("n").over(context)).join(F.broadcast(discount), ["lang", "o"])  # ORDER rows a language
    if keep is not None:
        told = told.join(F.broadcast(least_kept(every, keep)), ["lang", "o"]).where(F.col("n") >= F.col("cut"))
    return told.select("lang", "o", "gram", ((F.col("n") - F.col("d")) / F.col("total")).alias("p"))


def least_kept(every: DataFrame, keep: int) -> DataFrame:
    """lang, o, cut: the least count kept, from a histogram (exact below 4096, then 64 steps an octave)."""
    n = F.col("n")
    step = F.when(n < 4096, n).otherwise(4096 + F.floor(F.log2(n.cast("double")) * 64)).cast("long")
    held = (every.groupBy("lang", "o", step.alias("step")).agg(F.count("*").alias("rows"), F.min("n").alias("least"))
            .withColumn("held", F.sum("rows").over(Window.partitionBy("lang", "o").orderBy(F.desc("step")))))
    return held.where((F.col("held") <= keep) | (F.col("o") == 1)).groupBy("lang", "o").agg(F.min("least").alias("cut"))


def build(counts: DataFrame, keep: int | None = None) -> Models:
    """Models from (lang, gram, n) counts."""
    kept = probabilities(counts, keep).toArrow()
    unit = F.col("gram").bitwiseAND(F.lit(0xFFFF))
    units_known = counts.agg(F.count_distinct(unit)).first()[0]
    langs, lang = np.unique(np.array(kept["lang"].to_pylist(), dtype=object).astype(str), return_inverse=True)
    return Models([str(x) for x in langs], units_known, lang, kept["o"].to_numpy(),
                  kept["gram"].to_numpy().view(np.uint64), kept["p"].to_numpy())


def train(rows: DataFrame, keep: int | None = None) -> Models:
    """Models from (lang, text) rows."""
    return build(gram_counts(rows), keep)


def half(doc_id: Column) -> Column:
    """0 or 1 by a hash of the id: all rows of an id fall into one half."""
    return F.pmod(F.xxhash64(doc_id, F.lit("calibration")), F.lit(2)).cast("int")


def losses(rows: DataFrame, halves: list[Models]) -> DataFrame:
    """(kind, at, n, s) of labelled rows (lang, text, half), each text scored by the models of the other half:
    kind 0: texts and sum of log losses at temperature number ``at``; kind 1: texts identified rightly
    with an entropy in step ``at``."""
    sent = rows.sparkSession.sparkContext.broadcast(halves)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, loss, steps = 0, np.zeros(len(TEMPERATURES)), np.zeros(0, np.int64)
        for batch in batches:
            langs, texts, own = (batch.column(i).to_pylist() for i in range(3))
            for k, m in enumerate(sent.value):
                number = {lang: i for i, lang in enumerate(m.langs)}
                mine = [r for r, h in enumerate(own) if h != k and langs[r] in number]
                if not mine:
                    continue
                e = m.entropies([texts[r] for r in mine])
                ok = ~np.isnan(e[:, 0])
                e, y = e[ok], np.array([number[langs[r]] for r in mine])[ok]
                for i, t in enumerate(TEMPERATURES):
                    z = -t * (e - e.min(1, keepdims=True))
                    loss[i] += (np.log(np.exp(z).sum(1)) - z[np.arange(len(y)), y]).sum()
                n += len(y)
                step = np.maximum(np.ceil(e.min(1)[e.argmin(1) == y] / LIMIT_STEP), 0).astype(np.int64)
                found = np.bincount(step, minlength=len(steps))
                found[: len(steps)] += steps
                steps = found
        at = np.flatnonzero(steps)
        kinds = len(TEMPERATURES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([0, 1], [kinds, len(at)]).astype(np.int32)), pa.array(np.concatenate([np.arange(kinds), at])),
             pa.array(np.concatenate([np.full(kinds, n), steps[at]])), pa.array(np.concatenate([loss, np.zeros(len(at))]))],
            names=["kind", "at", "n", "s"])
    python_tasks(rows.sparkSession, 1000)
    return (rows.select("lang", "text", "half").mapInArrow(run, "kind int, at long, n long, s double")
            .groupBy("kind", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")))


def calibrate(told: DataFrame) -> tuple[float, float]:
    """Temperature with the least log loss on labelled texts, and the entropy above which a text is rejected."""
    rows = told.collect()  # a row per temperature and per step of entropy
    loss = {float(TEMPERATURES[r["at"]]): r["s"] / r["n"] for r in rows if r["kind"] == 0 and r["n"]}
    if not loss:
        return 10.0, np.inf
    right = sorted((r["at"], r["n"]) for r in rows if r["kind"] == 1)
    limit, wanted = np.inf, (1 - REJECT_SHARE) * sum(n for _, n in right)
    for at, n in right:
        wanted -= n
        if wanted <= 0:
            limit = at * LIMIT_STEP
            break
    return min(loss, key=lambda t: (loss[t] + 1e-3 * np.log(t), t)), float(limit)


def predict(docs: DataFrame, models: Models, temperature: float, limit: float, text: str = "text",
            keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, lang_pred, score, entropy, rejected."""
    python_tasks(docs.sparkSession, 1000)
    sent = docs.sparkSession.sparkContext.broadcast(models)  # the n-grams of all languages
    names = ["lang_pred", "score", "entropy", "rejected"]
    schema = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            e = m.entropies(batch.column(len(keep)).to_pylist())
            none = np.isnan(e[:, 0]) if len(m.langs) else np.ones(len(e), bool)
            pred, score, ent = [UNSEEN] * len(e), np.zeros(len(e)), np.full(len(e), np.nan)
            if not none.all():
                best = e[~none].argmin(1)
                z = -temperature * (e[~none] - e[~none].min(1, keepdims=True))
                score[~none], ent[~none] = 1 / np.exp(z).sum(1), e[~none].min(1)
                for row, b in zip(np.flatnonzero(~none), best, strict=True):
                    pred[row] = m.langs[b]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))] + [
                    pa.array(pred), pa.array(score), pa.array(ent, mask=none), pa.array(none | (np.nan_to_num(ent) > limit))],
                names=[*keep, *names])
    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(
        run, f"{schema}, lang_pred string, score double, entropy double, rejected boolean")


def identify(docs: DataFrame, training: DataFrame) -> DataFrame:
    """Train on ``training`` (doc_id, text, lang) and predict every row of ``docs``."""
    training = training.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    training = training.withColumn("half", half(F.col("doc_id")))
    parts = [gram_counts(training.where(F.col("half") == k)) for k in (0, 1)]
    temperature, limit = calibrate(losses(training, [build(part) for part in parts]))
    counts = parts[0].unionAll(parts[1]).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "lid-counts")
    models = build(counts)
    return predict(docs, models, temperature, limit, keep=("doc_id",))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 4, 2)
    return identify(docs, docs.where(~out)).withColumn("held_out", out)
