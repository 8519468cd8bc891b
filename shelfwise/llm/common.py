"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``; only a
    local master without that setting gets a scratch folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="shelfwise-llm-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write a table into the shared folder and read it back.
    A lost executor then costs a re-read, not a recomputation."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (whatever its case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def id_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """A null id belongs to no training fold, so it counts as held out."""
    return F.coalesce(id_bucket(doc_id, modulus) == F.lit(remainder), F.lit(True))


_SHIPPED: set[str] = set()


def python_tasks(spark: SparkSession, rows: int = 1000) -> None:
    """Before Python work: make this package importable in the workers, and bound the rows of an
    Arrow batch, as long texts must not meet by thousands."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        out = Path(tempfile.mkdtemp(prefix="shelfwise-py-")) / "shelfwise_tasks.zip"
        with zipfile.ZipFile(out, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(str(out))
        _SHIPPED.add(sc.applicationId)


def most_frequent(df: DataFrame, count: str, bound: int) -> DataFrame:
    """The rows of the greatest counts, at most ``bound``: those from the smallest cutoff that fits.
    The cutoff comes from a histogram of bounded size (exact below 4096, then 64 steps an octave)."""
    c = F.col(count)
    group = F.when(c < 4096, c).otherwise(4096 + F.floor(F.log2(c.cast("double")) * 64)).cast("long")
    held, cutoff = 0, None
    for r in sorted(df.groupBy(group.alias("g")).agg(F.count("*").alias("n"), F.min(c).alias("least")).collect(),
                    key=lambda r: -r["least"]):
        held += r["n"]
        if held > bound:
            break
        cutoff = r["least"]
    return df.limit(0) if cutoff is None else df.where(c >= cutoff)


WORD_PIECE = 1 << 22
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def word_lists(text: str | None) -> Iterator[list[bytes]]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z in lower case, as UTF-8, a
    list per piece of some megabytes (pieces are cut at blanks)."""
    data = (text or "").encode("utf-8", "replace").lower()
    a = 0
    while a < len(data):
        b = a + WORD_PIECE
        if b < len(data):
            found = _SPACE.search(data, b)
            b = found.start() if found else len(data)
        yield data[a:b].split()
        a = b
