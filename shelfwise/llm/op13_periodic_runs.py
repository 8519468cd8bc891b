"""Periodic runs of words in each text.

A run is a stretch of consecutive words with smallest period q, at least
max(MIN_WORDS, MIN_TURNS * q) words long, that no neighbouring word extends.

Method (descending-LCP Kruskal): suffixes of a text are sorted by prefix
doubling; neighbours in that order are edges weighted by their longest common
prefix (LCP). Edges are taken by decreasing LCP, and union-find unites the
classes of suffixes they join, each class holding its positions in order (the
smaller is put into the larger). When positions p and p + d become neighbours
in a class at LCP l with d <= l, the words from p to p + d + l have period d,
which ends there; if the word before p breaks it too, that is a run, and d is
its smallest period (a smaller one would have put a position between the two
into the class before). Every run appears so exactly once, at its first word.

Runs sought have an LCP of at least ``LEAST`` words (MIN_WORDS less a third of
it, as MIN_TURNS is 3), so only positions whose LEAST-word prefix occurs again
in the text are sorted further and united; that is no cut of the result.

Many texts are sorted in one pass of numpy: a word's first rank holds its text's
number, so no class spans texts, and each text ends in a mark of its own.

Defined cases: a null or empty text, or one of blanks only, has no words, no
runs, the digest of nothing, and nulls for the greatest run; a null doc_id has
no replaced words; words compare by their bytes; ties of the greatest exponent go
to the smallest start, then period; repeated rows are judged each; extra
columns are ignored and may have any name. Very long texts are read whole: memory
follows the longest text (some hundred bytes a word that recurs).
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm.common import python_tasks, table
from shelfwise.llm.sqltext import crc32_sql

MIN_WORDS = 24
MIN_TURNS = 3
LEAST = 16
assert LEAST <= MIN_WORDS - MIN_WORDS // MIN_TURNS and LEAST & (LEAST - 1) == 0
BATCH_WORDS = 1 << 19
ARROW_BYTES = 16 << 20
SMALL = 512
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    """Words ``[^\\x20\\x09-\\x0D]+``."""
    return [w for w in _SPACE.split(text or "") if w]


def planted(doc_id: int | None, ws: list[str]) -> list[str]:
    """The words as given, or, for a tenth of the ids, with a tail that repeats."""
    n = len(ws)
    if doc_id is None or not n:
        return ws
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return ws
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = ws[a: a + p]
    return ws[:a] + (unit * (-(-(n - a) // p)))[: n - a]


class Positions:
    """Ordered set of positions: a list, beyond SMALL a list of sorted lists."""

    __slots__ = ("blocks", "firsts", "size")

    def __init__(self, first: int) -> None:
        self.blocks, self.firsts, self.size = [[first]], [first], 1

    def add(self, p: int) -> tuple[int, int]:
        """Insert; the neighbours below and above, -1 where there is none."""
        k = max(bisect_left(self.firsts, p) - 1, 0)
        block = self.blocks[k]
        at = bisect_left(block, p)
        below = block[at - 1] if at else -1
        if at < len(block):
            above = block[at]
        else:
            above = self.firsts[k + 1] if k + 1 < len(self.firsts) else -1
        block.insert(at, p)
        self.firsts[k] = block[0]
        self.size += 1
        if len(block) > SMALL:
            half = len(block) // 2
            self.blocks.insert(k + 1, block[half:])
            self.firsts.insert(k + 1, block[half])
            del block[half:]
        return below, above

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block


def _dense(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions ``at`` in the order of their ``keys``, where each one's group of equal keys starts in that
    order, and whether the group holds several."""
    order = np.argsort(keys, kind="stable")
    keys, at = keys[order], at[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    starts = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    sizes = np.diff(np.append(starts, len(keys)))
    return at, starts[group], sizes[group] > 1


def recurring(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes whose LEAST-symbol prefix recurs, in suffix order, and each one's LCP with its predecessor.

    ``first`` holds a symbol per position; the last symbol of every text occurs once. Ranks double their
    depth in each step, for the positions only that still share theirs; all steps' ranks are kept, so that
    the LCP of neighbours is read off from the deepest step down.
    """
    n = len(first)
    at, rank_of, shared = _dense(first, np.arange(n))
    rank = np.empty(n, np.int64)
    rank[at] = rank_of
    ranks, active, width = [rank], at[shared], 1
    kept = None  # the positions that share a prefix of LEAST symbols
    while len(active):
        if width == LEAST:
            kept = active
        keys = ranks[-1][active] * np.int64(n) + ranks[-1][active + width]
        at, group, shared = _dense(keys, active)
        old = ranks[-1][at]
        # rank within the old class, whose members are neighbours here
        lead = np.ones(len(at), bool)
        lead[1:] = old[1:] != old[:-1]
        starts = np.flatnonzero(lead)
        offset = group - starts[np.cumsum(lead) - 1]
        rank = ranks[-1].copy()
        rank[at] = old + offset
        ranks.append(rank)
        active, width = at[shared], width * 2
    if kept is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = kept[np.argsort(ranks[-1][kept], kind="stable")]
    lcp = np.zeros(len(order), np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for k in range(len(ranks) - 1, -1, -1):
        same = ranks[k][np.minimum(a, n - 1)] == ranks[k][np.minimum(b, n - 1)]
        step = same.astype(np.int64) << k
        a += step
        b += step
    lcp[1:] = a - order[:-1]
    return order, lcp


def runs(first: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the symbols, by start, then period."""
    order, lcp = recurring(first)
    edges = np.flatnonzero(lcp >= LEAST)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    parent: dict[int, int] = {}
    classes: dict[int, Positions] = {}

    def root(p: int) -> int:
        if p not in parent:
            parent[p], classes[p] = p, Positions(p)
        while parent[p] != p:
            parent[p] = p = parent[parent[p]]
        return p

    out: list[tuple[int, int, int]] = []
    for x, y, long in zip(order[edges - 1].tolist(), order[edges].tolist(), lcp[edges].tolist(), strict=True):
        x, y = root(x), root(y)
        if classes[x].size < classes[y].size:
            x, y = y, x
        parent[y] = x
        big = classes[x]
        for p in classes.pop(y):
            below, above = big.add(p)
            for s, e in ((below, p), (p, above)):
                d = e - s
                if s < 0 or e < 0 or d > long:
                    continue
                length = d + long
                if length >= MIN_WORDS and length >= MIN_TURNS * d and (s == 0 or first[s - 1] != first[e - 1]):
                    out.append((s, length, d))
    return sorted(out, key=lambda r: (r[0], r[2]))


RESULT_SQL = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
              "runs_sha256 string, collapsed_sha256 string")
RESULT = pa.schema([(c, pa.int64()) for c in
                    ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")]
                   + [("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()


def collapse(ws: list[str], found: list[tuple[int, int, int]]) -> list[str]:
    """The words, without what any run holds after its first period."""
    if not found:
        return ws
    cover = np.zeros(len(ws) + 1, np.int64)
    for s, length, d in found:
        cover[s + d] += 1
        cover[s + length] -= 1
    keep = np.cumsum(cover[:-1]) == 0
    return [ws[i] for i in np.flatnonzero(keep).tolist()]


def judge(doc_id: int | None, ws: list[str], found: list[tuple[int, int, int]]) -> dict:
    best = None
    for s, length, d in found:  # by start, then period: the first of equals stays
        if best is None or length * best[2] > best[1] * d:
            best = (s, length, d)
    s, length, d = best or (None, None, None)
    return {"doc_id": doc_id, "n_runs": len(found), "start": s, "length": length, "period": d,
            "exponent_milli": 1000 * length // d if best else None,
            "runs_sha256": _sha("".join([f"{a},{b},{c}\n" for a, b, c in found])),
            "collapsed_sha256": _sha(" ".join(collapse(ws, found)))}


def runs_of_texts(texts: list[list[str]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, found together."""
    ids: dict[str, int] = {}
    symbols, starts = [], []
    size = 0
    for number, ws in enumerate(texts):
        code = np.fromiter((ids.setdefault(w, len(ids)) for w in ws), np.int64, len(ws))
        starts.append(size)
        symbols += [code + (np.int64(number) << 32), np.array([((number + 1) << 32) - 1])]
        size += len(ws) + 1
    out: list[list] = [[] for _ in texts]
    if size:
        begin = np.array(starts)
        for s, length, d in runs(np.concatenate(symbols)):
            t = int(np.searchsorted(begin, s, "right")) - 1
            out[t].append((s - starts[t], length, d))
    return out


def _tasks(change: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            found = runs_of_texts([ws for _, ws in held])
            return pa.RecordBatch.from_pylist([judge(i, ws, f) for (i, ws), f in zip(held, found, strict=True)], RESULT)

        for batch in batches:
            held: list[tuple] = []
            size = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ws = words(text.as_py())
                held.append((doc_id, planted(doc_id, ws) if change else ws))
                size += len(ws)
                if size >= BATCH_WORDS:
                    yield done()
                    held, size = [], 0
            if held:
                yield done()
    return run


def periodic_runs(docs: DataFrame, change: bool = False) -> DataFrame:
    """Per document of ``docs`` (doc_id, text) its runs' figures; ``change`` first makes the contract's
    repeating tails."""
    spark = docs.sparkSession
    python_tasks(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    rows = docs.selectExpr("cast(doc_id as long) as doc_id", "text")
    return rows.mapInArrow(_tasks(change), RESULT_SQL)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), change=True)


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, w, CAST(len(w) AS BIGINT) AS n, h, h // 10 AS g
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
               {crc32_sql('CAST(doc_id AS VARCHAR)')} AS h FROM documents)),
e AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM d),
f AS MATERIALIZED (SELECT r, doc_id, n, CASE WHEN a = n THEN w ELSE
       list_concat(w[1:a], list_transform(range(a, n), lambda i: w[1 + a + (i - a) % (1 + (n - a) // (3 + g % 8))])) END AS w
     FROM e),
x AS (SELECT r, i, hash(w[i + 1: i + 16]) AS k FROM (SELECT r, w, n, unnest(range(0, n - 15)) AS i FROM f WHERE n >= 16)),
pairs AS (SELECT b.r, b.i, c.i - b.i AS q FROM x b JOIN x c ON b.r = c.r AND b.k = c.k AND b.i < c.i),
isles AS (SELECT r, q, min(i) AS s, count(*) + 15 + q AS len
          FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS isle FROM pairs) GROUP BY r, q, isle),
runs AS (SELECT r, s, len, min(q) AS q FROM isles WHERE len >= 24 AND len >= 3 * q GROUP BY r, s, len),
per AS (SELECT r, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS listed FROM runs GROUP BY r),
top AS (SELECT r, s, len, q FROM runs a WHERE NOT EXISTS (SELECT 1 FROM runs b WHERE b.r = a.r AND
          (b.len * a.q > a.len * b.q OR (b.len * a.q = a.len * b.q AND (b.s < a.s OR (b.s = a.s AND b.q < a.q)))))),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + len)) AS i FROM runs),
kept AS (SELECT o.r, string_agg(o.word, ' ' ORDER BY o.i) AS body
         FROM (SELECT r, unnest(w) AS word, unnest(range(0, n)) AS i FROM f) o
         LEFT JOIN gone ON gone.r = o.r AND gone.i = o.i WHERE gone.i IS NULL GROUP BY o.r)
SELECT f.doc_id, coalesce(per.n_runs, 0) AS n_runs, top.s AS start, top.len AS length, top.q AS period,
       1000 * top.len // top.q AS exponent_milli, sha256(coalesce(per.listed, '')) AS runs_sha256,
       sha256(coalesce(kept.body, '')) AS collapsed_sha256
FROM f LEFT JOIN per ON per.r = f.r LEFT JOIN top ON top.r = f.r LEFT JOIN kept ON kept.r = f.r
"""
