"""Benchmark decontamination by SimHash windows (DataFrame functions only).

1. Texts become lower-case words (letters and digits) and five-word shingles.
   A passage of similarity 0.8 to an item shares shingles with it, so windows
   need to be looked at only where document and benchmark share one: an equal
   shingle at document word p and item word q anchors the item-sized window
   that starts at p - q (moved into the text at its edges).
2. Each distinct window text and each item gets a 64-bit SimHash of its
   weighted shingles. Fingerprints are cut into RADIUS + 1 blocks; two within
   RADIUS bits agree in at least one block (pigeonhole), so an equi-join on
   (length, block number, block value) misses none of them.
3. Fingerprints of similar short texts can differ in more than RADIUS bits, so
   window and item also meet if they share a shingle of both prefixes. A prefix
   holds the heaviest shingles of a text, up to the first whose followers weigh
   less than SIMILARITY of the text; two texts without a shingle in common there
   share less than that, so no pair of SIMILARITY is missed.
4. Candidates are verified by the exact weighted Jaccard similarity of their
   shingle multisets; SIMILARITY or more is a match.

A shingle weighs 1 + ln((1 + items) / (1 + items that hold it)).

Defined cases: null texts and those under five words hold no shingle and match
nothing, on either side; rows of one doc_id count as one document (null is an
id of its own); repeated items count once by (item_id, text); a document
shorter than the item is one window; empty tables give no matches; extra
columns are ignored by ``matches`` and kept by ``decontaminate``.

Scale: documents are read twice, shingled without a shuffle, and joined to the
benchmark's shingles, which are broadcast only if counted to be at most
BROADCAST_SHINGLES. Windows are merged by content before fingerprints are
made, so a passage that many documents share is worked on once. Each step is a
written table, so no plan is large: the driver plans what is left of one anew
after each of its stages, and holds all its broadcasts at once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import materialize, table

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 15
BITS = 64
BROADCAST_SHINGLES = 1_000_000


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(w: Column) -> Column:
    """Hashes of the five-word shingles of a word array, in text order; empty if there is none."""
    at = lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(SHINGLE)))
    return F.when(F.size(w) >= SHINGLE, F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), at)).otherwise(
        F.array().cast("array<bigint>"))


def _fingerprint(weighted: DataFrame, key: str) -> DataFrame:
    """SimHash of (key, h, w) rows: bit b is set if the weights of shingles with bit b outweigh the others."""
    bit = lambda b: F.shiftright("h", b).bitwiseAND(F.lit(1)) == 1
    sums = weighted.groupBy(key).agg(*(F.sum(F.when(bit(b), F.col("w")).otherwise(-F.col("w"))).alias(f"b{b}")
                                       for b in range(BITS)))
    one = lambda b: F.shiftleft(F.when(F.col(f"b{b}") > 0, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long")), b)
    return sums.select(key, reduce(lambda x, y: x.bitwiseOR(y), (one(b) for b in range(BITS))).alias("fp"))


def _blocks(df: DataFrame) -> DataFrame:
    """One row per block: RADIUS + 1 blocks whose widths add up to the fingerprint's."""
    n = RADIUS + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    block = lambda a, b: F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long"))
    return df.withColumn("blk", F.explode(F.array(*(
        F.struct(F.lit(i).alias("i"), block(cuts[i], cuts[i + 1]).alias("v")) for i in range(n)))))


def _prefix(bag: DataFrame, key: str) -> DataFrame:
    """(key, h): the shingles of a text, heaviest first (u, then h: one order for all texts), that
    come before the first whose followers weigh less than SIMILARITY of it, and that one."""
    order = Window.partitionBy(key).orderBy(F.desc("u"), "h").rowsBetween(Window.unboundedPreceding, -1)
    sums = bag.select(key, "h", F.coalesce(F.sum("w").over(order), F.lit(0.0)).alias("before"),
                      F.sum("w").over(Window.partitionBy(key)).alias("total"))
    return sums.where(F.col("before") <= (1 - SIMILARITY + 1e-6) * F.col("total")).select(key, "h")


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_SHINGLES else df


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity: the best window of each document for each item it holds."""
    items = materialize(
        benchmark.select("item_id", words(F.col("text")).alias("w")).withColumn("sh", shingles(F.col("w")))
        .where(F.size("sh") > 0).distinct()
        .select(F.xxhash64("item_id", "w").alias("ikey"), "item_id", F.size("w").alias("len"), "sh"), "decon-items")
    n_items, n_shingles = items.agg(F.count("*"), F.coalesce(F.sum(F.size("sh")), F.lit(0))).first()
    item_sh = items.select("ikey", "len", F.posexplode("sh").alias("q", "h"))
    weights = _small(item_sh.groupBy("h").agg(F.count_distinct("ikey").alias("df"))
                     .select("h", (1 + F.log((1 + F.lit(n_items)) / (1 + F.col("df")))).alias("w")), n_shingles)
    rare = 1 + F.log(1 + F.lit(n_items).cast("double"))

    anchors = _small(item_sh.groupBy("h").agg(F.collect_set(F.struct("q", "len")).alias("at")), n_shingles)
    text = docs.select("doc_id", words(F.col("text")).alias("w"))
    hits = (text.select("doc_id", F.size("w").alias("n"), F.posexplode(shingles(F.col("w"))).alias("p", "h"))
            .join(anchors, "h").select("doc_id", "n", "p", F.inline("at")))
    start = F.greatest(F.lit(0), F.least(F.col("p") - F.col("q"), F.col("n") - F.col("len")))
    windows = materialize(hits.select("doc_id", start.cast("int").alias("s"), "len").distinct(), "decon-windows")

    held = windows.withColumnRenamed("doc_id", "_d")
    found = (docs.select("doc_id", "text").join(held, F.col("doc_id").eqNullSafe(F.col("_d")))
             .select("doc_id", "len", F.slice(words(F.col("text")), F.col("s") + 1, F.col("len")).alias("w")))
    found = found.where(F.size("w") >= SHINGLE).select(
        "doc_id", "len", F.xxhash64("len", "w").alias("wkey"), shingles(F.col("w")).alias("sh"))
    found = materialize(found, "decon-found")

    texts = materialize(found.groupBy("wkey").agg(F.first("len").alias("len"), F.first("sh").alias("sh")), "decon-texts")

    def bags(df: DataFrame, key: str) -> DataFrame:
        """(key, h, u, w): weight of a shingle, and that times its count in the text."""
        tf = df.select(key, F.explode("sh").alias("h")).groupBy(key, "h").agg(F.count("*").alias("tf"))
        u = F.coalesce("w", rare)
        return tf.join(weights, "h", "left").select(key, "h", u.alias("u"), (F.col("tf") * u).alias("w"))
    wbag, ibag = materialize(bags(texts, "wkey"), "decon-wbag"), materialize(bags(items, "ikey"), "decon-ibag")

    wfp = materialize(_fingerprint(wbag, "wkey").join(texts.select("wkey", "len"), "wkey"), "decon-wfp")
    ifp = materialize(_fingerprint(ibag, "ikey").join(items.select("ikey", "len"), "ikey"), "decon-ifp")
    near = (_blocks(wfp).join(_blocks(ifp).withColumnRenamed("fp", "ifp"), ["len", "blk"])
            .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= RADIUS).select("wkey", "ikey"))
    sharing = (_prefix(wbag, "wkey").join(texts.select("wkey", "len"), "wkey")
               .join(_prefix(ibag, "ikey").join(items.select("ikey", "len"), "ikey"), ["len", "h"]).select("wkey", "ikey"))
    near = materialize(near.union(sharing).distinct(), "decon-near")

    wbag, ibag = wbag.drop("u"), ibag.drop("u")
    both = (near.join(wbag, "wkey").join(ibag.withColumnRenamed("w", "iw"), ["ikey", "h"])
            .groupBy("wkey", "ikey").agg(F.sum(F.least("w", "iw")).alias("shared")))
    total = lambda bag, key, name: bag.groupBy(key).agg(F.sum("w").alias(name))
    sim = F.col("shared") / (F.col("wt") + F.col("it") - F.col("shared"))
    alike = (both.join(total(wbag, "wkey", "wt"), "wkey").join(total(ibag, "ikey", "it"), "ikey")
             .select("wkey", "ikey", sim.alias("similarity")).where(F.col("similarity") >= SIMILARITY - 1e-9))
    alike = materialize(alike, "decon-alike")
    return (alike.join(items.select("ikey", "item_id"), "ikey").join(found.select("doc_id", "wkey").distinct(), "wkey")
            .groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity")))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item; all columns."""
    bad = matches(docs, benchmark).select(F.col("doc_id").alias("_d")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_d"]), "left_anti")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, contaminated, n_items, similarity (of the best match, 0 without one)."""
    docs = table(spark, sf_dir, "documents")
    found = (matches(docs, table(spark, sf_dir, "benchmark")).groupBy(F.col("doc_id").alias("_d"))
             .agg(F.count("*").alias("n"), F.max("similarity").alias("best")))
    ids = docs.select("doc_id").distinct()
    return ids.join(found, ids["doc_id"].eqNullSafe(found["_d"]), "left").select(
        "doc_id", F.col("n").isNotNull().alias("contaminated"), F.coalesce("n", F.lit(0)).cast("long").alias("n_items"),
        F.round(F.coalesce("best", F.lit(0.0)), 6).alias("similarity"))


SQL = r"""
WITH RECURSIVE it AS (SELECT DISTINCT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
i0 AS (SELECT row_number() OVER (ORDER BY item_id, w) AS k, item_id, w, len(w) AS n FROM it WHERE len(w) >= 5),
ish AS (SELECT k, n, unnest(range(n - 4)) AS q, w FROM i0),
ig AS (SELECT k, n, q, array_to_string(w[q + 1 : q + 5], ' ') AS g FROM ish),
wt AS (SELECT g, 1 + ln((1 + (SELECT count(*) FROM i0)) / (1.0 + count(DISTINCT k))) AS w FROM ig GROUP BY g),
d0 AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
d1 AS (SELECT doc_id, w, len(w) AS n, unnest(range(len(w) - 4)) AS p FROM d0 WHERE len(w) >= 5),
hit AS (SELECT DISTINCT d1.doc_id, d1.w, ig.n AS len, greatest(0, least(p - q, d1.n - ig.n)) AS s
        FROM (SELECT *, array_to_string(w[p + 1 : p + 5], ' ') AS g FROM d1) d1 JOIN ig USING (g)),
win AS (SELECT row_number() OVER () AS wk, doc_id, len, w[s + 1 : s + len] AS w FROM hit),
wg AS (SELECT wk, len, g, count(*) AS tf FROM (SELECT wk, len, w, unnest(range(len(w) - 4)) AS p FROM win),
       LATERAL (SELECT array_to_string(w[p + 1 : p + 5], ' ') AS g) GROUP BY ALL),
wbag AS (SELECT wk, len, g, tf * coalesce(w, 1 + ln(1.0 + (SELECT count(*) FROM i0))) AS w FROM wg LEFT JOIN wt USING (g)),
ibag AS (SELECT k, n, g, count(*) * any_value(w) AS w FROM ig JOIN wt USING (g) GROUP BY k, n, g),
sh AS (SELECT wk, k, sum(least(a.w, b.w)) AS s FROM wbag a JOIN ibag b ON a.g = b.g AND a.len = b.n GROUP BY wk, k),
sim AS (SELECT wk, k, s / ((SELECT sum(w) FROM wbag x WHERE x.wk = sh.wk) + (SELECT sum(w) FROM ibag y WHERE y.k = sh.k) - s) AS v FROM sh),
m AS (SELECT doc_id, count(DISTINCT item_id) AS n, max(v) AS v FROM sim JOIN win USING (wk) JOIN i0 USING (k) WHERE v >= 0.8 - 1e-9 GROUP BY doc_id)
SELECT d.doc_id, m.n IS NOT NULL AS contaminated, coalesce(m.n, 0) AS n_items, round(coalesce(m.v, 0.0), 6) AS similarity
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN m ON d.doc_id IS NOT DISTINCT FROM m.doc_id
"""
