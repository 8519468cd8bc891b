"""Chat formatting with cumulative-snapshot collapse (DataFrame functions only).

A chat log often holds the same conversation several times, each snapshot a
few turns longer. Every conversation gets rolling hashes of its turn prefixes;
one whose full hash is a proper prefix hash of a longer conversation is
dropped by an anti-join, equal ones keep the smallest id, and only these
maximal conversations are rendered.

Defined cases: a null conv_id names one conversation of its own; null turns
sort first; a null role reads ``unknown``, a null text is empty; repeated
identical rows count once; rows of one turn number sort by role and text; an
empty table gives no rows; extra columns are ignored.

Scale: all comparing runs on 128-bit hashes, the texts are shuffled once, for
the kept conversations only. A very long conversation is scanned in slices of
``SLICE`` turn numbers (totals per slice, a running window over the slices,
then offsets back), so no task holds it whole. Slices only spread the work:
turns are counted by position, whatever their numbers (gaps, timestamps). A
conversation is rendered as one row; one of more than ``segment_turns`` turns as
a row per that many turns, by position. Hot prefixes (a greeting that opens a third of all logs) collapse in a
partial aggregate before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import materialize, table

SLICE = 1024
SEGMENT_TURNS = 1 << 16
START, END = "<|im_start|>", "<|im_end|>"


def _clean(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        F.col("conv_id").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).withColumn("slice", F.coalesce(F.expr(f"floor(turn / {SLICE}D)"), F.lit(-(1 << 62))))  # null turns come first


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """One row per turn: conv_id, pos (from 1), n (turns in all), h1, h2 (hash of the first pos turns)."""
    rows = (turns.select("conv_id", "slice", "turn", "role",
                         F.xxhash64("role", "text").alias("a"), F.xxhash64("text", F.lit(7), "role").alias("b"))
            .distinct())
    in_slice = Window.partitionBy("conv_id", "slice").orderBy("turn", "role", "a", "b")
    over = Window.partitionBy("conv_id").orderBy("slice")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    rows = rows.withColumn("pos", F.row_number().over(in_slice).cast("long"))
    counts = (rows.groupBy("conv_id", "slice").agg(F.count("*").alias("c"))
              .select("conv_id", "slice", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("off"),
                      F.sum("c").over(whole).alias("n")))
    rows = (_same(rows, counts).withColumn("pos", F.col("pos") + F.col("off"))
            .withColumn("a", F.xxhash64("pos", "a", "b")).withColumn("b", F.xxhash64("b", "pos", F.lit(3), "a")))
    run = Window.partitionBy("conv_id", "slice").orderBy("pos")
    rows = rows.withColumn("x1", F.bit_xor("a").over(run)).withColumn("x2", F.bit_xor("b").over(run))
    sums = (rows.groupBy("conv_id", "slice").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
            .select("conv_id", "slice", F.coalesce(F.bit_xor("a").over(before), F.lit(0)).alias("p1"),
                    F.coalesce(F.bit_xor("b").over(before), F.lit(0)).alias("p2")))
    return _same(rows, sums).select("conv_id", "pos", "n", F.col("x1").bitwiseXOR(F.col("p1")).alias("h1"),
                                    F.col("x2").bitwiseXOR(F.col("p2")).alias("h2"))


def _same(left: DataFrame, right: DataFrame) -> DataFrame:
    r = right.withColumnRenamed("conv_id", "_c").withColumnRenamed("slice", "_s")
    return left.join(r, left["conv_id"].eqNullSafe(r["_c"]) & (left["slice"] == r["_s"])).drop("_c", "_s")


def maximal(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, copies of the conversations that no longer one continues."""
    hashes = materialize(prefix_hashes(_clean(conversations)), "chat-prefixes")
    full = (hashes.where(F.col("pos") == F.col("n")).groupBy("n", "h1", "h2")
            .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies")))
    proper = hashes.where(F.col("pos") < F.col("n")).select(F.col("pos").alias("n"), "h1", "h2").distinct()
    return full.join(proper, ["n", "h1", "h2"], "left_anti").select("conv_id", F.col("n").alias("n_turns"), "copies")


def _safe(c: Column) -> Column:
    """Text cannot forge a marker of the template."""
    return F.replace(c, F.lit("<|"), F.lit("< |"))


def _segments(turns: DataFrame, size: int) -> DataFrame:
    """Distinct turns of conversations with ``segment``, their position (from 0) over ``size``."""
    rows = turns.distinct().withColumn("pos", F.row_number().over(
        Window.partitionBy("conv_id", "slice").orderBy("turn", "role", "text")))
    before = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = (turns.distinct().groupBy("conv_id", "slice").agg(F.count("*").alias("c"))
              .select("conv_id", "slice", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("off")))
    return (_same(rows, counts).withColumn("segment", F.floor((F.col("pos") + F.col("off") - 1) / size).cast("int"))
            .drop("pos", "off"))


def render(conversations: DataFrame, segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """conv_id, segment (from 0: the only one up to ``segment_turns`` turns), n_turns, copies, text."""
    kept = maximal(conversations).withColumnRenamed("conv_id", "_c")
    turns = _clean(conversations)
    turns = turns.join(kept, turns["conv_id"].eqNullSafe(kept["_c"])).drop("_c")
    short = turns.where(F.col("n_turns") <= segment_turns).withColumn("segment", F.lit(0))
    long = _segments(turns.where(F.col("n_turns") > segment_turns), segment_turns)
    line = lambda t: F.concat(F.lit(START), _safe(t["role"]), F.lit("\n"), _safe(t["text"]), F.lit(END + "\n"))
    return (short.unionByName(long).groupBy("conv_id", "segment", "n_turns", "copies")
            .agg(F.sort_array(F.collect_set(F.struct("turn", "role", "text"))).alias("t"))
            .select("conv_id", "segment", "n_turns", "copies", F.array_join(F.transform("t", line), "").alias("text")))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render(table(spark, sf_dir, "conversations"))


SQL = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
s AS (SELECT conv_id, count(*) AS n,
        string_agg(role || chr(31) || text || chr(30), '' ORDER BY turn NULLS FIRST, role, text) AS body,
        string_agg('<|im_start|>' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |')
                   || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS text
      FROM t GROUP BY conv_id),
m AS (SELECT * FROM s a WHERE NOT EXISTS (SELECT 1 FROM s b WHERE b.n > a.n AND starts_with(b.body, a.body)))
SELECT min(conv_id) AS conv_id, CAST(0 AS INTEGER) AS segment, n AS n_turns, count(*) AS copies, min(text) AS text
FROM m GROUP BY n, body
"""
