"""N-gram Jaccard join by prefixes of token combinations.

Tokens are 64-bit hashes of k-word shingles, in one global order: rare ones
first, frequent ones last, by hash within each. Of a set of n tokens at most
n - ceil(t n) are missing from any partner, so a signature scheme that takes
more misses than that to destroy must meet the partner's:

* a rare token is a signature by itself and takes one miss to destroy;
* frequent tokens are dealt into groups by hash; a group with m of them in the
  prefix is indexed by its pairs and takes m - 1 misses to destroy.

The prefix is extended until it withstands all possible misses. (The shorter
of two partners' prefixes, measured in the global order, holds only tokens the
other prefix holds too if the other set has them; so some group keeps two
common tokens, or some rare token is common.) Groups are sized by the bands
[2^j, 2^(j+1)) of the larger partner, so pairs stay linear in set size.

Sets are collapsed to distinct ones first. Members of a signature are paired
with its smallest member, the center; exact Jaccard is checked on whole sets;
links become components. Where members of a signature are still in different
components, sets are told apart by how they differ from the center C, as the
passages they share with it say nothing: D is what one has and the other lacks.
Sets S, S' of n, n' tokens link if |D| + |D'| - 2 |D & D'| <= a (n + n') with
a = (1 - t) / (1 + t). With the excess e = |D| - a n this asks for
(e + e') / 2 common tokens of D and D'. If that is none, both link to C and are
connected. Else the first common one (rare in the group first) is at a place i
with e' <= 2 (|D| - i) - e in either, its reach; so D's tokens are indexed with
excess and reach, and tokens no partner's excess reaches are dropped by
aggregates alone. What meets is first paired with one member of the token's
largest component; pairs still apart after that are checked each. So every pair
is checked, connected or too far apart, without all pairs of a copy group.

Each set also has a bitmap of BITS bits, one set per token hash: two bitmaps
differ in at most as many bits as their sets differ in tokens, so pairs whose
bitmaps differ in more than partners may are left out unchecked. The bitmap of a
large set is full and tells nothing, so sets of SKETCHED tokens or more also have
a sketch that grows with them: their tokens' number in each of some buckets, one
for 8 to 16 tokens. Two sketches, the longer one folded, likewise differ in at
most as many counts as their sets differ in tokens.

To check the pairs left, whole sets go to the partition of one of the two (the
hub), dealt over SALTS parts so that a hub with many partners is spread, and are
read there as a sorted stream. Texts are found for them by a join on the document,
whose small side is broadcast only if its goals are counted to be at most BROADCAST_GOALS.

Which tokens are frequent steers the cost alone, never the result: tasks count
tokens lossily in bounded tables, and at most FREQUENT of those that reach
MIN_FREQUENT are sent to the tasks. Likewise the order of a group's differences:
those that one in LATE of some PROBES of its members has come last.

Defined cases: null or blank texts have no shingles, n_shingles 0 and are
linked with nothing; texts under k words are one shingle; rows of one id and
different texts are documents of their own; a null id takes part, the
component's id is the smallest non-null one; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import fresh, materialize, most_frequent, python_tasks, table, word_lists

FREQUENT = 1 << 18
MIN_FREQUENT = 512
LOCAL = 3  # counts a task reports
SALTS = 32
LATE = 4
PROBES = 16
FEW = 64
FIRST = 8
WORDS64 = 16
BITS = 64 * WORDS64
SKETCHED = 1024  # tokens from which a bitmap of BITS bits is too full
BROADCAST_GOALS = 1_000_000
HELD, SEEN = 1_000_000, 300_000  # tokens counted and set names remembered in a task
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def token_set(text: str | None, k: int, salt: int = 0) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of a text."""
    from xxhash import xxh3_64_intdigest
    parts = [np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words)) for words in word_lists(text)]
    w = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    if not len(w):
        return w
    w = mix(w + np.uint64(salt))
    width = min(k, len(w))
    s = np.zeros(len(w) - width + 1, np.uint64)
    for i in range(width):
        s += w[i: len(w) - width + 1 + i] * _ODD[i]
    return np.unique(mix(s + np.uint64(width)))


def node_of(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit names of a set."""
    d = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def bitmap(tokens: np.ndarray) -> list[int]:
    """BITS bits as 64-bit words; a token sets the bit its upper hash bits name."""
    on = np.zeros(BITS, bool)
    on[(tokens >> np.uint64(40)) % np.uint64(BITS)] = True
    return np.packbits(on).view(np.int64).tolist()


def sketch(tokens: np.ndarray) -> bytes | None:
    """Tokens a bucket modulo 256, of a set of SKETCHED or more."""
    n = len(tokens)
    if n < SKETCHED:
        return None
    buckets = 1 << (n.bit_length() - 4)
    at = (tokens >> np.uint64(8)) & np.uint64(buckets - 1)
    return np.bincount(at.astype(np.int64), minlength=buckets).astype(np.uint8).tobytes()


def least_apart(x: bytes, y: bytes) -> int:
    """The sets of these sketches differ in that many tokens or more."""
    a, b = (np.frombuffer(s, np.uint8) for s in (x, y))
    width = min(len(a), len(b))
    d = np.subtract(*(s.reshape(-1, width).sum(axis=0, dtype=np.uint8) for s in (a, b)))
    return int(np.minimum(d, np.negative(d)).sum(dtype=np.int64))


def sketches_may_link(percent: int) -> Callable:
    """The same as ``may_link`` by n_hub, n_leaf, sketch_hub, sketch_leaf; a set without a sketch may link."""
    def room(n: pa.Array, m: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
        size = np.asarray(n, np.int64) + np.asarray(m, np.int64)
        most = size - 2 * -(-percent * size // (100 + percent))
        return pa.array([not (a.is_valid and b.is_valid) or least_apart(a.as_buffer(), b.as_buffer()) <= d
                         for a, b, d in zip(x, y, most.tolist(), strict=True)], pa.bool_())
    room.__annotations__ = {"n": pa.Array, "m": pa.Array, "x": pa.Array, "y": pa.Array, "return": pa.Array}
    return F.arrow_udf(room, "boolean")


def may_link(percent: int, x: str, y: str) -> Column:
    """Sizes n_<x>, n_<y> and bitmaps b_<x>, b_<y> (a column per word) leave room for a link."""
    n = F.col(f"n_{x}") + F.col(f"n_{y}")
    least = F.ceil(percent * n / F.lit(100 + percent))
    apart = [F.bit_count(F.col(f"b{i}_{x}").bitwiseXOR(F.col(f"b{i}_{y}"))) for i in range(WORDS64)]
    return ((100 * F.least(f"n_{x}", f"n_{y}") >= percent * F.greatest(f"n_{x}", f"n_{y}"))
            & (sum(apart[1:], apart[0]) <= n - 2 * least))


def signatures(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """Signatures of a set, and their number if all are rare tokens, else 0; ``frequent``: sorted hashes."""
    n = len(tokens)
    if n < 2:
        return np.zeros(0, np.uint64), 0  # a partner of one token would be equal
    need = n - (percent * n + 99) // 100 + 1
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        often = frequent[at] == tokens
    else:
        often = np.zeros(n, bool)
    rare = tokens[~often][:need]
    if len(rare) == need:
        return rare, need
    common, out = tokens[often], [rare]
    for band in {n.bit_length(), (100 * n // percent).bit_length()}:
        groups = np.uint64(max(1, (1 << (band - 1)) // 4))
        g = mix(common + np.uint64(band)) % groups
        first = np.zeros(len(g), bool)
        first[np.unique(g, return_index=True)[1]] = True  # the first of a group adds no cover
        cover = np.cumsum(~first)
        end = int(np.searchsorted(cover, need - len(rare))) + 1
        c, g = common[:end], g[:end]
        order = np.argsort(g, kind="stable")
        c, g = c[order], g[order]
        for gap in range(1, len(c)):
            same = g[gap:] == g[:-gap]
            if not same.any():
                break
            a, b = c[:-gap][same], c[gap:][same]
            out.append(mix((a * _ODD[0] + b * _ODD[1]) ^ (np.array([band], np.uint64) * _ODD[2])))
    return np.unique(np.concatenate(out)), 0


def differences(center: np.ndarray, tokens: np.ndarray, late: np.ndarray, percent: int) -> list[tuple[int, int, int]]:
    """(token, excess, reach) of the differences between two sets at which a partner may be met;
    ``late``: the tokens that come last, in their order."""
    d, n = np.setxor1d(center, tokens, assume_unique=True), len(tokens)
    excess = (100 + percent) * len(d) - (100 - percent) * n
    held = center[np.minimum(np.searchsorted(center, d), len(center) - 1)] == d
    place = np.zeros(len(d), np.int64)
    if len(late):
        order = np.argsort(late, kind="stable")
        at = np.minimum(np.searchsorted(late, d, sorter=order), len(late) - 1)
        place = np.where(late[order[at]] == d, 1 + order[at], 0)
    d = d[np.lexsort((d, held, place))]
    reach = 2 * (100 + percent) * (len(d) - np.arange(len(d))) - excess
    # a partner has at most 100 n / percent tokens, its D as many as this one's but for what a link may differ in
    use = reach >= max(1 - excess, excess - 2 * (100 - percent) * (100 * n // percent))
    return list(zip(d[use].view(np.int64).tolist(), [excess] * int(use.sum()), reach[use].tolist(), strict=True))


class _Tally:
    """Lossy counts: a table of at most HELD tokens that forgets those met once."""

    def __init__(self):
        self.keys, self.counts, self.wait, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

    def add(self, tokens: np.ndarray) -> None:
        self.wait.append(tokens)
        self.size += len(tokens)
        if self.size > HELD:
            self.merge()

    def merge(self) -> None:
        if not self.wait:
            return
        k, c = np.unique(np.concatenate(self.wait), return_counts=True)
        k, c = np.concatenate([self.keys, k]), np.concatenate([self.counts, c])
        self.wait, self.size = [], 0
        if not len(k):
            return
        order = np.argsort(k, kind="stable")
        k, c = k[order], c[order]
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        self.keys, self.counts = k[first], np.add.reduceat(c, first)
        low = 1
        while len(self.keys) > HELD:
            keep = self.counts > low
            self.keys, self.counts, low = self.keys[keep], self.counts[keep], low + 1


class Join:
    """The join of one table: ``k``-word shingles, links at ``percent`` / 100 or more."""

    def __init__(self, docs: DataFrame, k: int, percent: int, text: str = "text"):
        if not 70 <= percent <= 100:
            raise ValueError("the group sizes are proven for similarities from 0.7")
        self.spark, self.k, self.percent, self.salt = docs.sparkSession, k, percent, 0
        self.docs = docs.select("doc_id", F.col(text).alias("text"), text_hash(F.col(text)).alias("th"))
        python_tasks(self.spark, 1000)

    # -- passes over the texts ------------------------------------------------
    def _names(self) -> DataFrame:
        """Two kinds of rows. Documents: doc_id, th, n, node, again, bits, sketch (every row's set by name).
        Tokens: no th, a task's lossy count n of token ``node``."""
        k, salt = self.k, self.salt
        names, bits_type = ["doc_id", "th", "n", "node", "again", "bits", "sketch"], pa.list_(pa.int64())
        kind = self.docs.schema["doc_id"].dataType

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tally, seen, ids = _Tally(), set(), None
            for batch in batches:
                n, named, bits, sketches = [], [], [], []
                for value in batch.column(2):
                    s = token_set(value.as_py(), k, salt)
                    n.append(len(s))
                    named.append(node_of(s))
                    bits.append(bitmap(s))
                    sketches.append(sketch(s))
                    if named[-1][0] not in seen:
                        seen.add(named[-1][0])
                        tally.add(s)
                if len(seen) > SEEN:
                    seen.clear()
                ids = batch.column(0).type
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), *(
                    pa.array([x[i] for x in named], pa.int64()) for i in (0, 1)), pa.array(bits, bits_type),
                    pa.array(sketches, pa.binary())], names=names)
            tally.merge()
            keep = tally.counts >= LOCAL
            tokens, counts = tally.keys[keep].view(np.int64), tally.counts[keep]
            for a in range(0, len(tokens), 100_000):
                t, c = tokens[a: a + 100_000], counts[a: a + 100_000]
                yield pa.RecordBatch.from_arrays([pa.nulls(len(t), ids), pa.nulls(len(t), pa.int64()), pa.array(c),
                                                  pa.array(t), pa.nulls(len(t), pa.int64()),
                                                  pa.nulls(len(t), bits_type), pa.nulls(len(t), pa.binary())], names=names)
        # as many tallies as a few rounds of the cluster's cores: each sees a fair part of the corpus
        part = self.docs.select("doc_id", "th", "text").coalesce(4 * self.spark.sparkContext.defaultParallelism)
        return part.mapInArrow(run, f"doc_id {kind.simpleString()}, th long, n long, node long, again long, bits array<long>, "
                                    "sketch binary")

    def _frequent(self, named: DataFrame) -> np.ndarray:
        found = (named.where(F.col("th").isNull()).groupBy("node").agg(F.sum("n").alias("n"))
                 .where(F.col("n") >= MIN_FREQUENT))
        top = most_frequent(materialize(found, "jaccard-frequent"), "n", FREQUENT).select("node").toArrow()
        return np.sort(top["node"].to_numpy().view(np.uint64))

    def _index(self, frequent) -> DataFrame:
        """sig, node, pure of every distinct set (a task leaves out sets it has met)."""
        k, salt, percent = self.k, self.salt, self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen = set()
            for batch in batches:
                sigs, nodes, pure = [], [], []
                for value in batch.column(0):
                    s = token_set(value.as_py(), k, salt)
                    name = node_of(s)[0]
                    if name not in seen:
                        seen.add(name)
                        found, rare = signatures(s, frequent.value, percent)
                        sigs.append(found)
                        nodes.append(np.full(len(found), name, np.int64))
                        pure.append(np.full(len(found), rare > 0))
                if len(seen) > SEEN:
                    seen.clear()
                if sigs:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), pa.array(
                        np.concatenate(nodes)), pa.array(np.concatenate(pure))], names=["sig", "node", "pure"])
        return self.docs.select("text").mapInArrow(run, "sig long, node long, pure boolean")

    # -- candidates, verification, components -----------------------------------
    def _stars(self, index: DataFrame) -> DataFrame:
        """sig, node, pure, center, center_pure, at of signatures with several members, in one pass over
        rows sorted by signature, which holds one batch whatever a signature's size."""
        names = ["sig", "node", "pure", "center", "center_pure", "at"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64),
                    np.zeros(0, bool), np.zeros(0, np.int64)]  # of the open signature
            for batch in batches:
                if not batch.num_rows:
                    continue
                s, v, p = (np.concatenate([old, c.to_numpy(zero_copy_only=False)])
                           for old, c in zip(last, batch.columns, strict=False))
                new = np.concatenate([[True], s[1:] != s[:-1]])
                start = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
                fresh = new | np.concatenate([[True], v[1:] != v[:-1]])
                c, cp, place = v[start], p[start], np.cumsum(fresh) - np.cumsum(fresh)[start]
                use = fresh & (place > 0)
                if len(last[0]):
                    going = start == 0
                    c, cp = np.where(going, last[3][0], c), np.where(going, last[4][0], cp)
                    place = np.where(going, place + last[5][0], place)
                    use = fresh & (place > 0)
                    use[0] = False  # given out before
                yield pa.RecordBatch.from_arrays([pa.array(x[use]) for x in (s, v, p, c, cp, place)], names=names)
                last = [x[-1:] for x in (s, v, p, c, cp, place)]
        parts = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), 1)
        return (index.repartition(parts, "sig").sortWithinPartitions("sig", "node")
                .mapInArrow(run, "sig long, node long, pure boolean, center long, center_pure boolean, at long"))

    def _sided(self, pairs: DataFrame, nodes: DataFrame, near: bool = True) -> DataFrame:
        """``pairs`` (hub, leaf) with the document that holds each set and the part of the hub;
        ``near``: without those whose sizes, bitmaps or sketches rule out a link."""
        of = lambda s: nodes.select(F.col("node").alias(f"at_{s}"), F.col("n").alias(f"n_{s}"),
                                    F.struct("doc_id", "th").alias(f"d_{s}"), *([*_bits(s), F.col("sketch").alias(f"sketch_{s}")] if near else []))
        met = F.col("leaf") == F.col("at_leaf")
        pairs = (pairs.join(of("hub"), F.col("hub") == F.col("at_hub"))
                 .join(of("leaf"), met & may_link(self.percent, "hub", "leaf") if near else met))
        if near:
            pairs = pairs.where(sketches_may_link(self.percent)("n_hub", "n_leaf", "sketch_hub", "sketch_leaf"))
        pairs = pairs.select("hub", "leaf", "d_hub", "d_leaf", F.pmod(F.xxhash64("leaf"), F.lit(SALTS)).cast("int").alias("salt"))
        return materialize(pairs, "jaccard-pairs")

    def _links(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sets are similar enough; ``pairs``: (hub, leaf), each once."""
        percent = self.percent

        def enough(y: np.ndarray, m: int, x: np.ndarray, n: int, late: np.ndarray) -> list[tuple]:
            common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(y) else 0
            # partners of n and m tokens share at least ceil(t (n + m) / (1 + t))
            return [()] if len(x) + len(y) - 2 * common <= n + m - 2 * -(-percent * (n + m) // (100 + percent)) else []
        pairs = self._sided(pairs, nodes)
        if pairs.isEmpty():
            return pairs.select(F.col("hub").alias("a"), F.col("leaf").alias("b"))
        return self._meet(pairs, enough, []).select(F.col("hub").alias("a"), F.col("leaf").alias("b"))

    def _meet(self, pairs: DataFrame, visit: Callable, more: list[str], late: DataFrame | None = None) -> DataFrame:
        """The rows (hub, leaf, *``more``) that ``visit`` makes of the sets of each pair: their tokens, their
        sizes and the hub's array in ``late`` (hub, late)."""
        k, salt = self.k, self.salt
        goal = lambda role: F.struct("hub", "salt", F.lit(role).alias("role"))
        wanted = (pairs.select("d_hub.*", goal(0).alias("goal")).distinct()
                  .unionByName(pairs.select("d_leaf.*", goal(1).alias("goal")))
                  .groupBy(F.col("doc_id").alias("to_id"), F.col("th").alias("to_text"))
                  .agg(F.collect_list("goal").alias("goals")))
        wanted = materialize(wanted, "jaccard-wanted")
        small = wanted.agg(F.coalesce(F.sum(F.size("goals")), F.lit(0))).first()[0] <= BROADCAST_GOALS
        w = F.broadcast(wanted) if small else wanted
        rows = self.docs.join(w, self.docs["doc_id"].eqNullSafe(w["to_id"]) & (self.docs["th"] == w["to_text"]))
        names = ["hub", "salt", "role", "node", "n", "tokens"]

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for value, goals in zip(batch.column(0), batch.column(1), strict=True):
                    s = token_set(value.as_py(), k, salt)
                    node, n, blob, goals = node_of(s)[0], len(s), s.tobytes(), goals.as_py()
                    step = max(1, (1 << 24) // max(1, len(blob)))
                    for a in range(0, len(goals), step):
                        part = goals[a: a + step]
                        yield pa.RecordBatch.from_arrays([
                            pa.array([g["hub"] for g in part], pa.int64()), pa.array([g["salt"] for g in part], pa.int32()),
                            pa.array([g["role"] for g in part], pa.int32()), pa.array([node] * len(part), pa.int64()),
                            pa.array([n] * len(part), pa.int64()), pa.array([blob] * len(part), pa.binary())], names=names)

        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, y, m, held, last = None, None, 0, None, np.zeros(0, np.uint64)
            for batch in batches:
                out = []
                for i, (hub, part, role, node, n) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:5]), strict=True)):
                    if role < 0:
                        held, last = (hub, part), np.array(batch.column(6)[i].as_py(), np.int64).view(np.uint64)
                        continue
                    x = np.frombuffer(batch.column(5)[i].as_buffer(), np.uint64)
                    if role == 0:
                        key, y, m = (hub, part), x.copy(), n
                        if held != key:
                            last = np.zeros(0, np.uint64)
                    elif key == (hub, part):
                        out += [(hub, node, *r) for r in visit(y, m, x, n, last)]
                cols = list(zip(*out, strict=True)) or [()] * (2 + len(more))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["hub", "leaf", *more])
        parts = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), 1)
        met = (rows.select("text", "goals").mapInArrow(sets, "hub long, salt int, role int, node long, n long, tokens binary")
               .withColumn("late", F.lit(None).cast("array<long>")))
        if late is not None:
            met = met.unionByName(pairs.select("hub", "salt").distinct().join(late, "hub").select(
                "hub", "salt", F.lit(-1).alias("role"), F.col("hub").alias("node"), F.lit(0).cast("long").alias("n"),
                F.lit(None).cast("binary").alias("tokens"), "late"))
        met = met.repartition(parts, "hub", "salt").sortWithinPartitions("hub", "salt", "role")
        return materialize(met.mapInArrow(check, ", ".join(f"{c} long" for c in ("hub", "leaf", *more))), "jaccard-met")

    def _mixed(self, stars: DataFrame, component: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Signatures whose members are in several components, dealt by pairs of neighbouring size bands, as
        links ask for sizes within a factor: (sig, band, node) of those of more than FEW members, and the
        pairs (hub, leaf) of members apart of the others."""
        own = component.select("node", "component")
        size = stars.groupBy("sig").agg(F.max("at").alias("size")).where(F.col("size") > 1)
        of = stars.join(size, "sig")
        every = of.select("sig", "node").unionByName(of.where(F.col("at") == 1).select("sig", F.col("center").alias("node")))
        every = (every.join(nodes.select("node", "n"), "node").join(own, "node", "left")
                 .withColumn("component", F.coalesce("component", "node")))
        # one more than a factor of 100 / percent, so that rounding of the logarithm can't part two partners
        band = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(101 / self.percent)))
        every = every.withColumn("band", F.explode(F.array(band, band + 1)))
        mixed = (every.groupBy("sig", "band").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("size"))
                 .where(F.col("a") != F.col("b")).select("sig", "band", "size"))
        every = materialize(every.join(mixed, ["sig", "band"]), "jaccard-mixed")
        few = every.where(F.col("size") <= FEW).join(nodes.drop("n", "doc_id", "th", "smallest", "sketch"), "node")
        side = lambda s: [*(F.col(c).alias(f"{c}_{s}") for c in ("sig", "band", "node", "n", "component")), *_bits(s)]
        met = few.select(*side("x")).join(few.select(*side("y")), (
            F.col("sig_x") == F.col("sig_y")) & (F.col("band_x") == F.col("band_y")) & (F.col("node_x") < F.col("node_y"))
            & (F.col("component_x") != F.col("component_y")) & may_link(self.percent, "x", "y"))
        return (every.where(F.col("size") > FEW).select("sig", "band", "node"),
                met.select(F.col("node_x").alias("hub"), F.col("node_y").alias("leaf")))

    def _differences(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """hub, token, leaf, excess, reach of the indexed differences between hub and leaf;
        excess and reach times 100 + percent. ``pairs``: (hub, leaf, members of the hub)."""
        percent = self.percent

        probed = [None, np.zeros(0, np.uint64)]  # a hub's tokens and the differences of its probes so far

        def often(y: np.ndarray, m: int, x: np.ndarray, n: int, late: np.ndarray) -> list[tuple]:
            d = np.setxor1d(x, y, assume_unique=True)
            probed[:] = [y, np.concatenate([probed[1], d]) if probed[0] is y else d]
            t, c = np.unique(probed[1], return_counts=True)
            return [(v,) for v in np.intersect1d(d, t[LATE * c >= PROBES]).view(np.int64).tolist()]

        def indexed(y: np.ndarray, m: int, x: np.ndarray, n: int, late: np.ndarray) -> list[tuple]:
            return [(t, e, r) for t, e, r in differences(y, x, late, percent)]
        some = F.pmod(F.xxhash64("leaf", "hub"), F.col("members")) < PROBES  # about PROBES of a hub's members
        probes = pairs.where(some).select("hub", "leaf")
        pairs = self._sided(pairs, nodes, near=False)
        part = pairs.join(probes, ["hub", "leaf"], "left_semi").withColumn("salt", F.lit(0))  # one stream a hub
        late = (self._meet(part, often, ["token"]).groupBy("hub", "token").agg(F.count("*").alias("c"))
                .groupBy("hub").agg(F.array_sort(F.collect_list(F.struct("c", "token"))).alias("late"))
                .select("hub", F.col("late.token").alias("late")))
        return self._meet(pairs, indexed, ["token", "excess", "reach"], materialize(late, "jaccard-late"))

    def _within_reach(self, index: DataFrame, component: DataFrame) -> DataFrame:
        """The rows of ``index`` that may have a partner in another component, with their component, the
        largest one of their token (top) and its member of least excess."""
        own = component.select(F.col("node").alias("leaf"), "component")
        rows = index.join(own, "leaf", "left").withColumn("component", F.coalesce("component", "leaf"))
        keys = ["hub", "token"]
        rows = rows.select(*keys, "leaf", "excess", "reach", "component").repartition(*keys)  # one exchange for both sides
        several = rows.groupBy(*keys).agg(F.min("component").alias("a"), F.max("component").alias("b")).where(F.col("a") != F.col("b"))
        rows = materialize(rows.join(several.drop("a", "b"), keys), "jaccard-several")
        for _ in range(2):
            shares = rows.groupBy(*keys, "component").agg(
                F.count("*").alias("c"), F.min(F.struct("excess", "leaf", "reach")).alias("least"), F.max("reach").alias("far"))
            tops = (shares.groupBy(*keys).agg(F.max(F.struct("c", "component", "least", "far")).alias("t"), F.count("*").alias("k"))
                    .where(F.col("k") > 1))
            rest = (shares.join(tops, keys).where(F.col("component") != F.col("t.component")).groupBy(*keys)
                    .agg(F.min("least.excess").alias("low"), F.max("far").alias("far")))
            tops = (tops.join(rest, keys).select(*keys, F.col("t.component").alias("top"), F.col("t.least").alias("head"),
                                                 F.col("t.far").alias("top_far"), "low", "far"))
            inside = F.col("component") == F.col("top")
            low = F.when(inside, F.col("low")).otherwise(F.least("low", "head.excess"))
            far = F.when(inside, F.col("far")).otherwise(F.greatest("far", "top_far"))
            rows = rows.select(*keys, "leaf", "excess", "reach", "component").join(tops, keys).where(
                (low <= F.col("reach")) & (F.col("excess") <= far)).drop("low", "far", "top_far")
            rows = materialize(rows, "jaccard-reach")
        return rows

    def _apart(self, rows: DataFrame) -> DataFrame:
        """Pairs (hub, leaf) in different components that reach each other by a token."""
        side = lambda s: [F.col(c).alias(f"{c}_{s}") for c in ("leaf", "excess", "reach", "component")]
        x = rows.where(F.col("component") != F.col("top")).select(F.col("hub").alias("hub_x"), F.col("token").alias("token_x"), *side("x"))
        y = rows.select("hub", "token", "top", *side("y"))
        met = x.join(y, (F.col("hub_x") == F.col("hub")) & (F.col("token_x") == F.col("token"))
                     & (F.col("component_x") != F.col("component_y"))
                     & ((F.col("component_y") == F.col("top")) | (F.col("leaf_x") < F.col("leaf_y")))
                     & (F.col("excess_y") <= F.col("reach_x")) & (F.col("excess_x") <= F.col("reach_y"))
                     & (F.col("excess_x") + F.col("excess_y") > 0))
        return met.select(F.least("leaf_x", "leaf_y").alias("hub"), F.greatest("leaf_x", "leaf_y").alias("leaf")).distinct()

    def rows(self) -> DataFrame:
        """doc_id, th, n_shingles, component_id, component (the set's or component's name) of every row."""
        while True:
            named = materialize(self._names(), "jaccard-rows")
            found = named.where(F.col("th").isNotNull())
            nodes = materialize(found.where(F.col("n") > 0).groupBy("node").agg(
                F.min("n").alias("n"), F.min("again").alias("lo"), F.max("again").alias("hi"),
                F.min(F.struct("doc_id", "th")).alias("rep"), F.min("doc_id").alias("smallest"),
                F.first("bits").alias("bits"), F.first("sketch").alias("sketch")), "jaccard-nodes")
            if nodes.where(F.col("lo") != F.col("hi")).isEmpty():
                break
            self.salt += 1  # two sets share a name: name all anew
        nodes = nodes.select("node", "n", "rep.doc_id", "rep.th", "smallest", "sketch",
                             *[F.get("bits", F.lit(i)).alias(f"b{i}") for i in range(WORDS64)])
        frequent = self.spark.sparkContext.broadcast(self._frequent(named))  # at most FREQUENT hashes
        stars = materialize(self._stars(self._index(frequent)), "jaccard-stars")
        links = self._links(stars.select(F.col("center").alias("hub"), F.col("node").alias("leaf")).distinct(), nodes)
        component = components(links)
        root = lambda s: component.select(F.col("node").alias(s), F.col("component").alias(f"root_{s}"))
        members, narrow = self._mixed(stars, component, nodes)
        centers = members.groupBy("sig", "band").agg(F.min("node").alias("hub"))
        pairs = members.join(centers, ["sig", "band"]).where(F.col("node") != F.col("hub")).select("hub", F.col("node").alias("leaf"))
        groups = materialize(pairs.distinct(), "jaccard-groups")

        def connect(pairs: DataFrame) -> bool:
            """Check the pairs that are not connected yet; True if any links."""
            nonlocal links, component
            more = self._links(pairs.join(root("hub"), "hub", "left").join(root("leaf"), "leaf", "left").where(
                F.coalesce("root_hub", "hub") != F.coalesce("root_leaf", "leaf")).select("hub", "leaf"), nodes)
            if more.isEmpty():
                return False
            links = links.unionByName(more)
            component = components(links)
            return True
        connect(groups)
        apart = F.coalesce("root_hub", "hub") != F.coalesce("root_leaf", "leaf")
        open_ = (groups.join(root("hub"), "hub", "left").join(root("leaf"), "leaf", "left").where(apart)
                 .groupBy("hub").agg(F.count("*").alias("outside")))
        size = groups.groupBy("hub").agg(F.count("*").alias("members"))
        open_ = open_.join(size, "hub").where(F.col("members") > 1).select("hub", "members")
        index = self._differences(groups.join(open_, "hub"), nodes)
        meeting = self._within_reach(index, component)
        heads = (meeting.where((F.col("component") != F.col("top")) & (F.col("head.excess") <= F.col("reach"))
                               & (F.col("excess") <= F.col("head.reach")) & (F.col("excess") + F.col("head.excess") > 0))
                 .select(F.col("head.leaf").alias("hub"), "leaf").distinct())
        if connect(heads):
            meeting = self._within_reach(meeting.select("hub", "token", "leaf", "excess", "reach"), component)
        across = materialize(narrow.unionByName(self._apart(meeting)).distinct(), "jaccard-across")
        early = F.pmod(F.xxhash64("hub", "leaf"), F.lit(FIRST)) == 0
        connect(across.where(early))
        connect(across.where(~early))
        whole = nodes.join(component, "node", "left").select(
            "node", F.coalesce("component", "node").alias("component"), "smallest")
        least = whole.groupBy("component").agg(F.min("smallest").alias("component_id"))
        whole = whole.join(least, "component").select("node", "component", "component_id")
        return found.join(whole, "node", "left").select(
            "doc_id", "th", F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
            F.when(F.col("n") > 0, F.col("component")).alias("component"))


def _bits(side: str) -> list[Column]:
    return [F.col(f"b{i}").alias(f"b{i}_{side}") for i in range(WORDS64)]


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node) of the nodes on links, by alternating large and small stars."""
    edges = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, mark = materialize(edges, "stars"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.where(F.col("u") != F.col("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        edges = materialize(small, "stars")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark:
            break
        mark = now
    star = edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    return materialize(star.unionByName(star.select(F.col("component").alias("node"), "component")).distinct(), "components")


def jaccard_components(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    return Join(docs, k, percent).rows().select("doc_id", "n_shingles", "component_id")


def deduplicate(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component (that of the smallest id, then text hash), all columns; rows
    that repeat id and text are one document; texts without a word all stay."""
    found = Join(docs, k, percent).rows()
    best = found.where(F.col("component").isNotNull()).groupBy("component").agg(F.min(F.struct("doc_id", "th")).alias("k"))
    keep = best.select("k.*").unionByName(found.where(F.col("component").isNull()).select("doc_id", "th").distinct())
    keep = materialize(keep.select(F.col("doc_id").alias("kept_id"), F.col("th").alias("kept_text")), "jaccard-kept")
    name = fresh(docs, "text_hash")
    rows = docs.withColumn(name, text_hash(F.col("text")))
    rows = rows.join(keep, rows["doc_id"].eqNullSafe(keep["kept_id"]) & (rows[name] == keep["kept_text"]), "left_semi")
    return rows.dropDuplicates(["doc_id", name]).drop(name)


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), k=4, percent=85)


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_sort(list_distinct(list_transform(range(len(w) - 3), lambda i: array_to_string(w[i + 1 : i + 4], ' ')))) END AS g FROM d),
r AS (SELECT row_number() OVER (ORDER BY doc_id, g) AS k, doc_id, g FROM s),
u AS (SELECT min(k) AS k, g, len(g) AS n FROM r WHERE len(g) > 0 GROUP BY g),
t AS (SELECT k, n, unnest(g) AS x FROM u),
p AS (SELECT a.k AS a, b.k AS b FROM t a JOIN t b ON a.x = b.x AND a.k < b.k GROUP BY a.k, b.k, a.n, b.n
      HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
c AS (SELECT k AS node, k AS root FROM u UNION SELECT e.b, c.root FROM c JOIN e ON e.a = c.node),
m AS (SELECT node, min(root) AS root FROM c GROUP BY node),
z AS (SELECT r.doc_id, len(r.g) AS n, m.root FROM r LEFT JOIN u ON r.g = u.g LEFT JOIN m ON m.node = u.k)
SELECT doc_id, n AS n_shingles, CASE WHEN n = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY root) END AS component_id FROM z
"""
