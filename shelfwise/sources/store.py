"""Tables that survive a lost driver: atomic replacement (S4) and stages that a repeated run resumes (L2, L4).

Paths are reached by Hadoop's file system, so any store that Spark reads will do.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    """The path's file system and its class of paths."""
    cls = spark._jvm.org.apache.hadoop.fs.Path
    return cls(path).getFileSystem(spark._jsc.hadoopConfiguration()), cls


def exists(spark: SparkSession, path: str) -> bool:
    fs, cls = _fs(spark, path)
    return fs.exists(cls(path))


def _names(path: str) -> tuple[str, str]:
    path = path.rstrip("/")
    return f"{path}.new", f"{path}.old"


def settle(spark: SparkSession, path: str) -> None:
    """Finish or undo a replacement that was cut off: the table is complete afterwards, the old or the new one."""
    fs, cls = _fs(spark, path)
    _, old = _names(path)
    if fs.exists(cls(old)):
        if fs.exists(cls(path)):
            fs.delete(cls(old), True)
        else:
            fs.rename(cls(old), cls(path))


def replace_table(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Replace the table at ``path`` by what ``write`` puts at the path it is given.

    The new table is written beside the old one, which stays readable until the new one is whole; then two
    renames switch them. A run killed before leaves the old table, one killed between them is settled by the
    next ``settle``, ``read_table`` or ``replace_table``.
    """
    settle(spark, path)
    fs, cls = _fs(spark, path)
    new, old = _names(path)
    staged = f"{new}-{uuid.uuid4().hex}"
    try:
        write(staged)
    except Exception:
        fs.delete(cls(staged), True)
        raise
    if fs.exists(cls(path)) and not fs.rename(cls(path), cls(old)):
        raise OSError(f"could not set {path} aside")
    if not fs.rename(cls(staged), cls(path)):
        settle(spark, path)
        raise OSError(f"could not put {staged} in place")
    fs.delete(cls(old), True)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    settle(spark, path)
    return spark.read.format(fmt).load(path)


def fingerprint(df: DataFrame) -> str:
    """Of a frame's input: its plan, and the names, sizes and times of its files."""
    spark = df.sparkSession
    files = []
    for name in sorted(df.inputFiles()):
        fs, cls = _fs(spark, name)
        s = fs.getFileStatus(cls(name))
        files.append([name, s.getLen(), s.getModificationTime()])
    return hashlib.sha256(json.dumps([files, None if files else df.semanticHash()]).encode()).hexdigest()


class RunStore:
    """Stage tables of a run under ``root``, each named by the hash of the run's inputs and settings.

    A stage whose table is complete is read, not computed again; any change of inputs or settings is another
    hash, so no stale table is read.
    """

    def __init__(self, spark: SparkSession, root: str, inputs: list[DataFrame], settings: dict) -> None:
        text = json.dumps([[fingerprint(df) for df in inputs], settings], sort_keys=True, default=str)
        self.spark, self.root, self.key = spark, root.rstrip("/"), hashlib.sha256(text.encode()).hexdigest()[:16]
        self.built: list[str] = []

    def path(self, name: str) -> str:
        return f"{self.root}/stages/{name}-{self.key}"

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stage's table; ``_SUCCESS``, which a write leaves last, tells that it is whole."""
        path = self.path(name)
        if not exists(self.spark, f"{path}/_SUCCESS"):
            build().write.mode("overwrite").parquet(path)
            self.built.append(name)
        return self.spark.read.parquet(path)
