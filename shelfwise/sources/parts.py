"""Tables written part after part, so that disk holds the shuffle files of one part at a time.

A part is the rows whose keys' hash leaves one remainder: work that never needs rows of different keys
together (an equi-join on the keys, exact duplicates, groups) is done part by part with the same rows as
at once. Shuffles then take up to 1 / MAX_PARTS of the disk that they would take together; what stays is
the written table, columnar and compressed. Each part scans the whole source once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import ensure_checkpoint_dir

#: Rows a part, and the most parts: beyond it parts grow with the rows, as every part scans all of them.
PART_ROWS = 6_000_000
MAX_PARTS = 8

#: Remove an execution's shuffle files when it ends; without it they stay until the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def parts_for(rows: int) -> int:
    return min(MAX_PARTS, max(1, -(-rows // PART_ROWS)))


def in_part(part: int, parts: int, *keys: str) -> Column:
    """Predicate: the row's keys (NULL is a value) belong to this part. Not the hash that deals out shuffles,
    whose partitions would else be filled unevenly."""
    return F.pmod(F.xxhash64(*keys), F.lit(parts)) == F.lit(part) if parts > 1 else F.lit(True)


@contextmanager
def _no_shuffle_files_left(spark: SparkSession) -> Iterator[None]:
    was = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if was is None else spark.conf.set(CLEANUP, was)


def written(spark: SparkSession, name: str, parts: int, part: Callable[[int], DataFrame]) -> DataFrame:
    """The union of ``part(0)`` .. ``part(parts - 1)``, each written into the checkpoint folder before the next is run."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    paths, schema = [], None
    for k in range(parts):
        df = part(k)
        schema = schema or df.schema
        paths.append(f"{root}/{k}")
        with _no_shuffle_files_left(spark):
            df.write.parquet(paths[-1])
    return spark.read.schema(schema).parquet(*paths)
