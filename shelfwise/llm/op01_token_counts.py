"""Token counts: rollups maintained by signed deltas.

Totals per (source, lang, tokenizer) are additive, so a batch of changes needs
only the rows it touches: an insert adds, a delete takes back what the ledger
holds for the document, a revised count does both. Each batch is written once
as its signed sums, under its id:

    ledger/<batch>   the newest entry per document and tokenizer version
    deltas/<batch>   signed sums per source, language and tokenizer version
    commits/<batch>  written last: from then on the batch counts

A batch whose commit exists is skipped when it comes again; one that died
before its commit is written anew over its remains. Totals are the sums of
committed deltas.

Defined cases: an insert of a known document revises it; a delete of an
unknown one does nothing; several changes of one document in a batch count as
its greatest (seq, op, n_tokens, source, lang); null sources and languages are
groups of their own, null ids a document of their own; null texts have 0
tokens; groups that sum to no document are left out; an empty batch commits;
extra columns are ignored.

Scale: the ledger is joined on (document, tokenizer) only; a hot source is
summed in the tasks before its shuffle.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import new_path, python_tasks, table

GROUP = ["source", "lang", "tokenizer"]
_ENCODINGS: dict = {}


def _encoding(ranks: bytes, pattern: str):
    """The encoder of a rank file, made once in a worker process."""
    import tiktoken
    key = (hash(ranks), pattern)
    if key not in _ENCODINGS:
        lines = (line.split() for line in ranks.splitlines() if line)
        _ENCODINGS[key] = tiktoken.Encoding("ranks", pat_str=pattern, special_tokens={},
                                            mergeable_ranks={base64.b64decode(a): int(b) for a, b in lines})
    return _ENCODINGS[key]


def count_tokens(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """All columns but ``text``, and n_tokens (byte-level BPE of the whole text), in place of one of that name."""
    spark = docs.sparkSession
    python_tasks(spark, 500)
    with open(ranks_path, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())  # a vocabulary file, of fixed size
    keep = [c for c in docs.columns if c != text and c.lower() != "n_tokens"]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(ranks.value, pattern)
        for batch in batches:
            n = [len(encoding.encode_ordinary(t)) if t else 0 for t in (v.as_py() for v in batch.column(len(keep)))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(n, pa.int64())],
                                             names=[*keep, "n_tokens"])
    return docs.select(*keep, text).mapInArrow(run, schema)


class TokenRollup:
    """Totals in ``root``, a folder all executors share; ``changes`` rows are
    (doc_id, op insert|delete|revise, source, lang, tokenizer, n_tokens[, seq])."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, kind: str, batch: str) -> str:
        return f"{self.root}/{kind}/{batch}"

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def committed(self) -> list[str]:
        """Ids of the batches that count, in order of their commits."""
        fs, p = self._fs(f"{self.root}/commits")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        done = [n for n in names if self._exists(f"{self._path('commits', n)}/_SUCCESS")]
        return [n for _, n in sorted((self.spark.read.parquet(self._path("commits", n)).first()["number"], n) for n in done)]

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def _all(self, kind: str, batches: list[str]) -> DataFrame | None:
        return reduce(DataFrame.unionByName, (self.spark.read.parquet(self._path(kind, b)) for b in batches)) if batches else None

    def ledger(self) -> DataFrame | None:
        """Newest entry per document and tokenizer version."""
        entries = self._all("ledger", self.committed())
        if entries is None:
            return None
        newest = F.max(F.struct("number", "alive", "source", "lang", "n_tokens")).alias("e")
        return entries.groupBy("doc_id", "tokenizer").agg(newest).where("e.alive").select(
            "doc_id", "tokenizer", "e.source", "e.lang", "e.n_tokens")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch once; False if it was committed before."""
        done = self.committed()
        if batch in done:
            return False
        number = len(done) + 1
        seq = F.col("seq") if "seq" in changes.columns else F.lit(0)
        new = (changes.select("doc_id", "tokenizer", F.struct(
            seq.alias("seq"), F.col("op").alias("op"), F.col("n_tokens").cast("long").alias("n_tokens"),
            F.col("source").alias("source"), F.col("lang").alias("lang")).alias("e"))
            .groupBy("doc_id", "tokenizer").agg(F.max("e").alias("e"))
            .select("doc_id", "tokenizer", (F.col("e.op") != "delete").alias("alive"), "e.source", "e.lang",
                    F.coalesce("e.n_tokens", F.lit(0)).alias("n_tokens"), F.lit(number).alias("number")))
        new.write.mode("overwrite").parquet(self._path("ledger", batch))
        new = self.spark.read.parquet(self._path("ledger", batch))
        sums = new.where("alive").select(*GROUP, F.lit(1).alias("d"), F.col("n_tokens").alias("t"))
        held = self.ledger()
        if held is not None:
            key = new.select(F.col("doc_id").alias("_d"), F.col("tokenizer").alias("_t"))
            back = held.join(key, held["doc_id"].eqNullSafe(key["_d"]) & held["tokenizer"].eqNullSafe(key["_t"]), "left_semi")
            sums = sums.unionByName(back.select(*GROUP, F.lit(-1).alias("d"), (-F.col("n_tokens")).alias("t")))
        sums = sums.groupBy(*GROUP).agg(F.sum("d").cast("long").alias("n_docs"), F.sum("t").cast("long").alias("n_tokens"))
        sums.write.mode("overwrite").parquet(self._path("deltas", batch))
        self.spark.range(1).select(F.lit(number).alias("number")).write.mode("overwrite").parquet(self._path("commits", batch))
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens of all committed batches."""
        deltas = self._all("deltas", self.committed())
        if deltas is None:
            return self.spark.createDataFrame([], "source string, lang string, tokenizer string, n_docs long, n_tokens long")
        return (deltas.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
                .where(F.col("n_docs") != 0))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all documents, delete exact copies of a text (all but its smallest id), recount the texts
    that repeat a line without the repeats, and replay the first batch, which changes nothing."""
    import public_tokenizers
    version = "byte_bpe_50k"
    rank_file, pattern = public_tokenizers.path(f"{version}.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    tag = lambda df, op: df.withColumn("tokenizer", F.lit(version)).withColumn("op", F.lit(op))
    rollup = TokenRollup(spark, new_path(spark, "token-rollup"))
    load = tag(count_tokens(docs, rank_file, pattern), "insert")
    rollup.commit("load", load)

    texts = docs.select("doc_id", "source", "lang", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    first = texts.groupBy("h").agg(F.min("doc_id").alias("first"))
    copies = texts.join(first, "h").where(F.col("doc_id") > F.col("first")).select("doc_id", "source", "lang")
    rollup.commit("copies", tag(copies, "delete").withColumn("n_tokens", F.lit(0)))

    lines = F.array_join(F.array_distinct(F.split("text", "\n")), "\n")
    kept = docs.withColumn("line_text", lines).where(F.col("line_text") != F.col("text"))
    gone = copies.select(F.col("doc_id").alias("_d"))
    kept = kept.join(gone, kept["doc_id"] == gone["_d"], "left_anti").select(
        "doc_id", "source", "lang", F.col("line_text").alias("text"))
    rollup.commit("lines", tag(count_tokens(kept, rank_file, pattern), "revise"))
    rollup.commit("load", load)
    return rollup.totals()
