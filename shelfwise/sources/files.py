"""File sources: sales CSV/Parquet (S1), zipped CSV archives (S2), stock file (S3)."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.keys import product_key
from shelfwise.operators.quality import require_columns
from shelfwise.schema import REQUIRED_RAW_COLUMNS, normalise_name


def normalise_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalise_name(c) for c in df.columns])


def read_sales(spark: SparkSession, path: str, fmt: str = "csv",
               validate: bool = True) -> DataFrame:
    """Read raw sales rows; CSV is read as text (``coerce_types`` types it)."""
    if not path:
        raise ValueError("sales path: None or empty")
    if fmt == "csv":
        df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    if validate:
        require_columns(df, REQUIRED_RAW_COLUMNS)
    return normalise_columns(df)


def pick_csv_member(names: list[str]) -> str | None:
    """Of all ``.csv`` members, the one with fewest '/' then the shortest name."""
    csvs = [n for n in names if n.lower().endswith(".csv")]
    if not csvs:
        return None
    return sorted(csvs, key=lambda n: (n.count("/"), len(n), n))[0]


def _open_member(path: str, content: bytes):
    """The chosen CSV member of an archive, as an open file."""
    archive = zipfile.ZipFile(io.BytesIO(content))
    member = pick_csv_member(archive.namelist())
    if member is None:
        raise ValueError(f"no CSV member in archive {path}")
    return archive.open(member)


def _headers(batches):
    """(path, name): every column of every archive's member."""
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"], strict=True):
            with _open_member(path, content) as fh:
                names = [normalise_name(c) for c in pd.read_csv(fh, nrows=0).columns]
            yield pd.DataFrame({"path": path, "name": names})


def _unzip_rows(columns: list[str]):
    def run(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                with _open_member(path, content) as fh:
                    for chunk in pd.read_csv(fh, dtype=str, keep_default_na=False,
                                             na_values=[""], chunksize=100_000):
                        chunk = chunk.rename(columns=normalise_name)
                        out = pd.DataFrame({c: chunk[c] if c in chunk else None for c in columns})
                        yield out.astype(object).where(out.notna(), None)
    return run


#: Bytes of archives that reach a Python worker at once.
ARCHIVE_BATCH_BYTES = 64 << 20


def read_sales_zips(spark: SparkSession, glob: str, columns: list[str] | None = None,
                    validate: bool = True) -> DataFrame:
    """Many zipped CSV archives at once, all values as text.

    Zip is not splittable, so an archive is read in one task, where it lies (its
    content is not shuffled), and its rows are streamed out in chunks; an
    archive must fit a row (2 GB). A first pass reads the headers alone: the
    result has the union of all columns, and an archive without a required one
    is an error. ``columns`` overrides the union.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARCHIVE_BATCH_BYTES))
    files = spark.read.format("binaryFile").load(glob).select("path", "content")
    if columns is None or validate:
        found = files.mapInPandas(_headers, "path string, name string")
        required = sorted(normalise_name(c) for c in REQUIRED_RAW_COLUMNS)
        # one row per distinct column set, whatever the number of archives
        sets = (found.groupBy("path").agg(F.array_sort(F.collect_set("name")).alias("names"))
                .groupBy("names").agg(F.min("path").alias("path")).collect())
        for r in sets if validate else ():
            if lacking := [c for c in required if c not in r["names"]]:
                raise ValueError(f"archive {r['path']}: missing required columns {lacking}")
        if columns is None:
            columns = sorted({c for r in sets for c in r["names"]})
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return files.mapInPandas(_unzip_rows(columns), schema)


def stock_from_frame(df: DataFrame, order: Column | None = None) -> DataFrame:
    """(product_key, current_stock >= 0) from either stock layout, one row per product.

    Of several rows the last by ``order`` counts; without an order, the row of
    the greatest stock. Text that is no number is 0.
    """
    cols = set(df.columns)
    if not ({"product_line"} <= cols or {"product_id", "category"} <= cols):
        raise ValueError("stock table: needs 'product_line', or 'Product ID' and 'Category'")
    value = F.expr("try_cast(current_stock as double)")
    stock = F.greatest(F.coalesce(F.when(~F.isnan(value), value), F.lit(0.0)), F.lit(0.0))
    rows = df.select(product_key(df).alias("product_key"), stock.alias("current_stock"),
                     (F.lit(0) if order is None else order).alias("_order"))
    return (rows.where(F.col("product_key").isNotNull()).groupBy("product_key")
            .agg(F.max_by("current_stock", F.struct("_order", "current_stock")).alias("current_stock")))


def read_stock(spark: SparkSession, path: str) -> DataFrame:
    """Stock file(s); of several rows of a product the last counts (by file, then place in it)."""
    df = normalise_columns(spark.read.option("header", True).csv(path))
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return stock_from_frame(df.select("*", place.alias("_place")), F.col("_place"))
