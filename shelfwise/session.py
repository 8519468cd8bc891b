"""Session helpers for tests, the bench and local runs.

On a cluster the session comes from the platform; these helpers only fill in
settings that are unset, never override them.
"""

from __future__ import annotations

import os
import tempfile
import threading
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "shelfwise") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SHELFWISE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only a local master without
    one gets a scratch directory (tests, bench)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="shelfwise-ckpt-")
    sc.setCheckpointDir(path)
    return path


#: Rows of the fact table a task, and shuffled bytes a task: what it sorts, hashes and buffers (some 400
#: bytes a row) then stays in memory at any size of the input.
TASK_ROWS = 250_000
TASK_BYTES = "16MB"

_SIZED: dict[tuple[str, str], str] = {}


def size_tasks(spark: SparkSession, rows: int) -> None:
    """Bound the tasks of shuffles for a fact table of ``rows`` rows. Settings of the platform are left alone."""
    wanted = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES}
    parts = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    wanted[parts] = str(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS)))
    for key, value in wanted.items():
        mine = (spark.sparkContext.applicationId, key)
        if spark.conf.get(key, None) in (None, _SIZED.get(mine)):
            spark.conf.set(key, value)
            _SIZED[mine] = value


def cut_lineage(df):
    """Reliable checkpoint into the session's shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()
_SHIPPING = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application (also if fits run in several threads)."""
    sc = spark.sparkContext
    with _SHIPPING:
        if sc.applicationId in _SHIPPED:
            return
        package = Path(__file__).resolve().parent
        out = Path(tempfile.mkdtemp(prefix="shelfwise-tasks-")) / "shelfwise_package.zip"
        with zipfile.ZipFile(out, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(str(out))
        _SHIPPED.add(sc.applicationId)
