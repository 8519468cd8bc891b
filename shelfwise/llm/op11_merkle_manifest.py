"""Merkle manifest of a table of documents, kept as a postorder append log.

Every row is a leaf. Leaves of one ``lang`` ascend by doc_id; runs of ARITY
consecutive nodes become their parent until one node, the subroot, is left;
the subroots, by lang, likewise become the root.

Method: leaves get their number in the lang, and aligned builders take blocks
of ARITY**LEVELS consecutive leaves. A builder appends each node when it is
complete (children before parents), so its segment of the log is the postorder
of its subtree. Where a node stands follows from subtree sizes alone
(``position``), so a proof addresses its siblings in the segment without
searching. The roots of the blocks are the leaves of the next round, until one
block per lang remains; a round divides the rows by ARITY**LEVELS. Proofs are
taken from the last round down: what a block's root needs from above is common
to all its leaves.

Defined cases: a null field is ``-`` in the leaf; null lang is a group of its
own, the first; null doc_ids come first in their group and are never tampered
with; repeated ids are ordered by leaf digest, equal rows are interchangeable
leaves of their own; empty and very long texts are hashed whole; an empty table
has no rows; a lone leaf is its lang's subroot, a lone subroot the root, and a
proof without siblings is the digest of nothing; extra columns are ignored and
may have any name.

Scale: a text is read once, to be hashed; afterwards a row is two digests and
an id. Leaves are numbered by range partitions and their counts, so a lang with
most of the rows is dealt over all tasks, also where ids repeat. A builder holds
one block (ARITY**LEVELS leaves). Every round is a written table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import id_bucket, materialize, python_tasks, table
from shelfwise.llm.sqltext import LOWER_AZ, crc32_sql

ARITY = 8
LEVELS = 3
BLOCK = ARITY ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 3
ARROW_BYTES = 16 << 20
TOP = "top"


def position(level: int, index: int, leaves: int) -> int:
    """Place of a node in the postorder of a tree over ``leaves`` leaves: its last leaf, the inner
    nodes completed before that leaf, and the levels completed with it."""
    last = min((index + 1) * ARITY ** level, leaves) - 1
    at, size = last + level, ARITY
    while size <= last:
        at += last // size
        size *= ARITY
    return at


def _field(c: Column) -> Column:
    value = c.cast("string")
    return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(text: Column) -> Column:
    parts = [_field(text if c == "text" else F.col(c)) for c in FIELDS]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """key, doc_id, leaf, altered (the tampered row's digest; null where the row is left alone)."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.coalesce(id_bucket(F.col("doc_id"), TAMPERED) == 0, F.lit(False))
    key = F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))  # null before all others, bytewise
    return docs.select(key.alias("key"), "doc_id", leaf_digest(F.col("text")).alias("leaf"),
                       F.when(hit, leaf_digest(lowered)).alias("altered"))


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` (with ``key``) plus i, the number from 0 in the key's order, and n, the key's rows.

    Rows are dealt out by ranges of (key, order), with a row id behind it so that equal rows are
    dealt out too; the ranges' counts per key, a small table, give each range's first number.
    """
    tie = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = (tie.repartitionByRange("key", *order, "_tie").sortWithinPartitions("key", *order, "_tie").drop("_tie")
              .withColumn("_at", F.monotonically_increasing_id()))
    ranged = materialize(ranged, f"{name}-ranged")
    ranged = ranged.withColumn("_part", F.shiftright("_at", 33))
    counts = ranged.groupBy("key", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    w = Window.partitionBy("key")
    before = F.sum("_n").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("_off", F.coalesce(before, F.lit(0)) - F.col("_first")).withColumn(
        "n", F.sum("_n").over(w)).select("key", "_part", "_off", "n")
    return (ranged.join(counts, ["key", "_part"]).withColumn("i", F.col("_at") + F.col("_off"))
            .drop("_part", "_at", "_off"))


def _parent(children: list[bytes]) -> bytes:
    return hashlib.sha256("".join([c.hex() for c in children]).encode()).digest()


def _height(count: int, goes_on: bool) -> int:
    """Levels above the leaves of a block: all of them if its root is only a leaf of the next round."""
    top = 0
    while top < LEVELS and (goes_on or ARITY ** top < count):
        top += 1
    return top


def append_log(digests: list[bytes], goes_on: bool) -> bytes:
    """The block's nodes, 32 bytes each, in the order in which they are completed."""
    top = _height(len(digests), goes_on)
    log = bytearray()
    pending: list[list[bytes]] = [[] for _ in range(top + 1)]

    def complete(level: int, digest: bytes) -> None:
        log.extend(digest)
        pending[level].append(digest)
        if level < top and len(pending[level]) == ARITY:
            close(level)

    def close(level: int) -> None:
        children, pending[level] = pending[level], []
        complete(level + 1, _parent(children))

    for digest in digests:
        complete(0, digest)
    for level in range(top):
        if pending[level]:
            close(level)
    return bytes(log)


SEGMENT = pa.schema([("key", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("root", pa.binary()),
                     ("nodes", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
                     ("altered", pa.list_(pa.binary()))])
SEGMENT_SQL = "key string, block long, n long, root binary, nodes binary, doc_ids array<long>, altered array<binary>"


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block from rows (key, block, i, n, digest, doc_id, altered) sorted by (key, block, i)."""
    held: list[tuple] = []
    now = None

    def segment() -> pa.RecordBatch:
        key, block, n = now
        log = append_log([h[0] for h in held], n > BLOCK)
        row = {"key": key, "block": block, "n": n, "root": log[-32:], "nodes": log,
               "doc_ids": [h[1] for h in held], "altered": [h[2] for h in held]}
        return pa.RecordBatch.from_pylist([row], SEGMENT)

    for batch in batches:
        cols = [c.to_pylist() for c in batch.columns]
        for key, block, _, n, digest, doc_id, altered in zip(*cols, strict=True):
            if now != (key, block, n):
                if held:
                    yield segment()
                held, now = [], (key, block, n)
            held.append((digest, doc_id, altered))
    if held:
        yield segment()


def _round(rows: DataFrame, name: str) -> DataFrame:
    """Segments of one round: rows (key, i, n, digest[, doc_id, altered]) in aligned blocks."""
    have = rows.columns
    ids = F.col("doc_id").cast("long") if "doc_id" in have else F.lit(None).cast("long")
    altered = F.col("altered") if "altered" in have else F.lit(None).cast("binary")
    dealt = (rows.select("key", F.floor(F.col("i") / BLOCK).cast("long").alias("block"), "i", "n", "digest",
                         ids.alias("doc_id"), altered.alias("altered"))
             .repartition("key", "block").sortWithinPartitions("key", "block", "i"))
    return materialize(dealt.mapInArrow(_build, SEGMENT_SQL), name)


def rounds(rows: DataFrame, name: str) -> list[DataFrame]:
    """Segments of all rounds, leaves first, until every key has one block."""
    out = [_round(rows, f"{name}-log")]
    most = rows.agg(F.max("n")).first()[0] or 0
    while most > BLOCK:
        up = out[-1].where(F.col("n") > BLOCK).select(
            "key", F.col("block").alias("i"), F.ceil(F.col("n") / BLOCK).cast("long").alias("n"),
            F.col("root").alias("digest"))
        out.append(_round(up, f"{name}-log"))
        most = -(-most // BLOCK)
    return out


class Manifest:
    """``logs`` (rounds over the rows), ``tops`` (rounds over the subroots), ``order`` (subroots by
    number): written tables."""

    def __init__(self, logs: list[DataFrame], tops: list[DataFrame], order: DataFrame) -> None:
        self.logs, self.tops, self.order = logs, tops, order

    def root(self) -> DataFrame:
        """One row: root (hex); none for an empty table."""
        return self.tops[-1].where(F.col("n") <= BLOCK).select(F.lower(F.hex("root")).alias("root"))

    def subroots(self) -> DataFrame:
        """lang, subroot (hex), n_leaves."""
        lang = F.when(F.col("key") != "", F.expr("substr(key, 2)"))
        leaf_count = self.logs[0].groupBy("key").agg(F.max("n").alias("n_leaves"))
        return (_ends(self.logs).join(leaf_count, "key")
                .select(lang.alias("lang"), F.lower(F.hex("digest")).alias("subroot"), "n_leaves"))

    def nodes(self) -> DataFrame:
        """The log as rows: lang, level, index, position (in the lang's postorder), digest (hex)."""
        counts = self.logs[0].groupBy("key").agg(F.max("n").alias("leaves"))
        out = None
        for r, seg in enumerate(self.logs):
            part = seg.mapInArrow(_listed(r), "key string, level int, index long, digest string")
            out = part if out is None else out.unionByName(part)
        last = F.least((F.col("index") + 1) * F.pow(F.lit(ARITY), "level").cast("long"), F.col("leaves")) - 1
        at = F.aggregate(F.sequence(F.lit(1), F.lit(20)), F.col("last") + F.col("level"),
                         lambda s, k: s + F.floor(F.col("last") / F.pow(F.lit(float(ARITY)), k)))
        return (out.join(counts, "key").withColumn("last", last).withColumn("position", at)
                .select(F.when(F.col("key") != "", F.expr("substr(key, 2)")).alias("lang"),
                        "level", "index", "position", "digest"))


def _listed(r: int):
    """Nodes of a round's segments with their level and index in the whole tree (a block's leaves, which
    are the roots of the round before, are listed there)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.select(["key", "block", "n", "nodes", "doc_ids"]).to_pylist():
                m = len(row["doc_ids"])
                out = []
                for level in range(1 if r else 0, _height(m, row["n"] > BLOCK) + 1):
                    for j in range(-(-m // ARITY ** level)):
                        p = 32 * position(level, j, m)
                        out.append({"key": row["key"], "level": r * LEVELS + level,
                                    "index": row["block"] * (BLOCK // ARITY ** level) + j,
                                    "digest": row["nodes"][p: p + 32].hex()})
                yield pa.RecordBatch.from_pylist(out, pa.schema(
                    [("key", pa.string()), ("level", pa.int32()), ("index", pa.int64()), ("digest", pa.string())]))
    return run


def _ends(logs: list[DataFrame]) -> DataFrame:
    """key, digest of the node that remains, round in which it was reached."""
    out = None
    for r, seg in enumerate(logs):
        part = seg.where(F.col("n") <= BLOCK).select("key", F.col("root").alias("digest"), F.lit(r).alias("round"))
        out = part if out is None else out.unionByName(part)
    return out


def build(docs: DataFrame) -> Manifest:
    spark = docs.sparkSession
    python_tasks(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    made = materialize(leaves(docs), "merkle-leaves")
    logs = rounds(numbered(made, ["doc_id", "leaf"], "merkle").withColumnRenamed("leaf", "digest"), "merkle")
    ends = _ends(logs).select(F.lit(TOP).alias("key"), F.col("key").alias("lang_key"), "digest")
    order = materialize(numbered(ends, ["lang_key"], "merkle-top"), "merkle-subroots")
    return Manifest(logs, rounds(order, "merkle-top"), order)


def _entries(nodes: bytes, m: int, top: int) -> list[list[bytes]]:
    """Per level and node: its place among the children of its parent (a byte), then the others' hex digests.
    Children are read where the closed form puts them."""
    out = []
    for level in range(top):
        count = -(-m // ARITY ** level)
        here = []
        for first in range(0, count, ARITY):
            run = []
            for j in range(first, min(first + ARITY, count)):
                p = 32 * position(level, j, m)
                run.append(nodes[p: p + 32].hex().encode())
            here += [bytes([k]) + b"".join(run[:k] + run[k + 1:]) for k in range(len(run))]
        out.append(here)
    return out


def fold(digest: bytes, path: list[bytes]) -> bytes:
    """The root (hex) that a leaf (hex) and the entries of its path lead to."""
    for e in path:
        k = 64 * e[0] + 1
        digest = hashlib.sha256(e[1:k] + digest + e[k:]).hexdigest().encode()
    return digest


PATHS_SQL = "key string, i long, path array<binary>, subroot binary, whole binary"
PATHS = pa.schema([("key", pa.string()), ("i", pa.int64()), ("path", pa.list_(pa.binary())),
                   ("subroot", pa.binary()), ("whole", pa.binary())])
PROOFS_SQL = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
              "verified boolean")
PROOFS = pa.schema([("doc_id", pa.int64())] + [(c, pa.string()) for c in
                   ("leaf", "subroot", "root", "proof_sha256", "folded_root")] + [("verified", pa.bool_())])


def _walk(row: dict) -> Iterator[tuple[int, bytes, list[bytes]]]:
    m = len(row["doc_ids"])
    top = _height(m, row["n"] > BLOCK)
    entries = _entries(row["nodes"], m, top)
    for x in range(m):
        p = 32 * position(0, x, m)
        yield x, row["nodes"][p: p + 32], [entries[h][x // ARITY ** h] for h in range(top)] + row["path"]


def _upper(subroots: bool):
    """Paths of a round's leaves; ``subroots``: the leaves of the lowest such round are the subroots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                out = [{"key": row["key"], "i": row["block"] * BLOCK + x, "path": path,
                        "subroot": leaf if subroots else row["subroot"], "whole": row["whole"]}
                       for x, leaf, path in _walk(row)]
                yield pa.RecordBatch.from_pylist(out, PATHS)
    return run


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            subroot, root = row["subroot"].hex(), row["whole"].hex()
            out = []
            for x, leaf, path in _walk(row):
                told = leaf.hex()
                changed = row["altered"][x]
                folded = fold((told if changed is None else changed.hex()).encode(), path).decode()
                out.append({"doc_id": row["doc_ids"][x], "leaf": told, "subroot": subroot, "root": root,
                            "proof_sha256": hashlib.sha256(b"".join([e[1:] for e in path])).hexdigest(),
                            "folded_root": folded, "verified": folded == root})
            yield pa.RecordBatch.from_pylist(out, PROOFS)


def _with_paths(seg: DataFrame, above: DataFrame) -> DataFrame:
    up = above.select("key", F.col("i").alias("block"), "path", "subroot", "whole")
    return seg.join(up, ["key", "block"])


def _start(seg: DataFrame) -> DataFrame:
    """Paths of the blocks that are whole trees: nothing above."""
    return seg.where(F.col("n") <= BLOCK).select(
        "key", F.col("block").alias("i"), F.array().cast("array<binary>").alias("path"),
        F.lit(None).cast("binary").alias("subroot"), F.col("root").alias("whole"))


def proofs(m: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of the manifest."""
    paths = _start(m.tops[-1])
    for seg in reversed(m.tops):
        paths = materialize(_with_paths(seg, paths).mapInArrow(_upper(True), PATHS_SQL), "merkle-paths")
    # the path of each subroot, at the lang whose block it is
    spot = m.order.select("i", F.col("lang_key").alias("lang"))
    tops = (paths.drop("key").join(spot, "i")
            .select(F.col("lang").alias("key"), F.lit(0).cast("long").alias("i"), "path", "subroot", "whole"))
    ends = _ends(m.logs).select("key", "round")
    tops = materialize(tops.join(ends, "key"), "merkle-tops")
    above = None
    for r in range(len(m.logs) - 1, -1, -1):
        here = tops.where(F.col("round") == r).drop("round")
        above = here if above is None else above.unionByName(here)
        joined = _with_paths(m.logs[r], above)
        if r == 0:
            return joined.mapInArrow(_proofs, PROOFS_SQL)
        above = materialize(joined.mapInArrow(_upper(False), PATHS_SQL), "merkle-paths")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proofs(build(table(spark, sf_dir, "documents")))


def _f(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"


_OTHERS = " || ".join(_f(c) for c in FIELDS[:-1])
_RUNS = """SELECT {key} a.h, a.i, a.i // 8 AS up,
  coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
  coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
  FROM {t} a JOIN {t} b ON {same} a.h = b.h AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY {key} a.h, a.i"""

SQL = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce('=' || lang, '') AS k, sha256({_OTHERS} || {_f('text')}) AS leaf,
         CASE WHEN {crc32_sql('CAST(doc_id AS VARCHAR)')} % 3 = 0
              THEN sha256({_OTHERS} || {_f(LOWER_AZ.format('text'))}) END AS altered
  FROM documents),
num AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
               count(*) OVER (PARTITION BY k) AS n FROM docs),
t(k, h, i, n, d) AS (
  SELECT k, 0, i, n, leaf FROM num
  UNION ALL
  SELECT k, h + 1, i // 8, (n + 7) // 8, sha256(string_agg(d, '' ORDER BY i)) FROM t WHERE n > 1 GROUP BY k, h, n, i // 8),
sub AS (SELECT k, h, d, row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
u(h, i, n, d) AS (
  SELECT 0, i, n, d FROM sub
  UNION ALL
  SELECT h + 1, i // 8, (n + 7) // 8, sha256(string_agg(d, '' ORDER BY i)) FROM u WHERE n > 1 GROUP BY h, n, i // 8),
tr AS ({_RUNS.format(key='a.k,', t='t', same='a.k = b.k AND')}),
ur AS ({_RUNS.format(key='', t='u', same='')}),
p(k, x, h, i, d, proof) AS (
  SELECT k, i, 0, i, coalesce(altered, leaf), '' FROM num
  UNION ALL
  SELECT p.k, p.x, p.h + 1, tr.up, sha256(tr.l || p.d || tr.r), p.proof || tr.l || tr.r
  FROM p JOIN tr ON p.k = tr.k AND p.h = tr.h AND p.i = tr.i),
q(k, x, h, i, d, proof) AS (
  SELECT p.k, p.x, 0, sub.i, p.d, p.proof FROM p JOIN sub ON p.k = sub.k AND p.h = sub.h
  UNION ALL
  SELECT q.k, q.x, q.h + 1, ur.up, sha256(ur.l || q.d || ur.r), q.proof || ur.l || ur.r
  FROM q JOIN ur ON q.h = ur.h AND q.i = ur.i),
whole AS (SELECT h, d FROM u WHERE n = 1)
SELECT num.doc_id, num.leaf, sub.d AS subroot, whole.d AS root, sha256(q.proof) AS proof_sha256,
       q.d AS folded_root, q.d = whole.d AS verified
FROM num JOIN sub ON num.k = sub.k JOIN q ON q.k = num.k AND q.x = num.i JOIN whole ON q.h = whole.h
"""
