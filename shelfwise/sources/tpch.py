"""Binding of the driver's TPC-H-like tables to the retail sales vocabulary.

One raw sales row per lineitem:

  date               <- l_shipdate (as date)
  store_id / region  <- supplier's nation name / region name
  product_id         <- p_brand (or l_partkey for a sparse-history binding)
  category           <- p_type
  units_sold / price <- l_quantity / l_extendedprice per unit
  weather_condition  <- o_orderpriority (stand-in categorical)
  seasonality        <- Winter/Spring/Summer/Autumn by quarter
  inventory_level    <- p_size, units_ordered <- l_linenumber (stand-ins)
  discount           <- l_discount, competitor_pricing <- p_retailprice
  holiday            <- l_returnflag = 'R', promotion <- l_discount >= 0.05

nation (25 rows) and region (5 rows) are fixed-size dimension tables and are
broadcast explicitly; suppliers are if counted to be at most GEO_ROWS. Part and
orders grow with the scale factor, so their join strategy is left to AQE's
runtime size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import size_tasks
from shelfwise.sources.parts import in_part, parts_for, written

# Quarter -> season label.
SEASONS = ("Winter", "Spring", "Summer", "Autumn")


# Declared layouts of the driver's tables (only the columns the
# binding reads). Declaring them skips a schema-inference job per scan.
SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_returnflag STRING, "
                "l_shipdate TIMESTAMP_NTZ",
    "orders": "o_orderkey BIGINT, o_orderpriority STRING",
    "part": "p_partkey BIGINT, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "events": "ts TIMESTAMP_NTZ, event_type STRING, value DOUBLE",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


#: Suppliers with their nation and region are broadcast up to so many rows.
GEO_ROWS = 500_000


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lineitem joined to its order, part, supplier, nation and region, as a written table.

    The joins run once, however often the rows are read, and in parts of the order keys (``sources.parts``),
    so that disk holds the shuffled rows of one part only.
    """
    facts = table(spark, sf_dir, "lineitem")
    rows = facts.count()  # read from the files' footers
    size_tasks(spark, rows)
    li = facts.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = (supplier
           .join(F.broadcast(nation), supplier.s_nationkey == nation.n_nationkey)
           .join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
           .select("s_suppkey", "n_name", "r_name"))
    if supplier.count() <= GEO_ROWS:
        geo = F.broadcast(geo)
    n = parts_for(rows)

    def joined(k: int) -> DataFrame:
        mine, theirs = li.where(in_part(k, n, "l_orderkey")), orders.where(in_part(k, n, "o_orderkey"))
        return (mine.join(theirs, mine.l_orderkey == theirs.o_orderkey)
                .join(part, mine.l_partkey == part.p_partkey)
                .join(geo, mine.l_suppkey == geo.s_suppkey)
                .select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                        "l_returnflag", "l_shipdate", "o_orderpriority", "p_brand", "p_type", "p_size",
                        "p_retailprice", "n_name", "r_name"))
    return written(spark, "sales-lines", n, joined)


def retail_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The tables behind ``sales_lines``: their files tell a run's input from another's."""
    return [table(spark, sf_dir, t) for t in ("lineitem", "orders", "part", "supplier", "nation", "region")]


def _season(d):
    return F.element_at(F.array(*[F.lit(s) for s in SEASONS]), F.quarter(d))


def retail_raw(spark: SparkSession, sf_dir: str, product: str = "brand", lines: DataFrame | None = None) -> DataFrame:
    """Clean, typed raw sales rows (``date`` already a DateType). ``lines``: ``sales_lines``, if the caller has them."""
    j = sales_lines(spark, sf_dir) if lines is None else lines
    d = F.to_date("l_shipdate")
    product_col = F.col("p_brand") if product == "brand" else F.col("l_partkey").cast("string")
    return j.select(
        d.alias("date"),
        F.col("n_name").alias("store_id"),
        product_col.alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("r_name").alias("region"),
        F.col("l_quantity").alias("units_sold"),
        F.try_divide("l_extendedprice", "l_quantity").alias("price"),
        F.col("o_orderpriority").alias("weather_condition"),
        _season(d).alias("seasonality"),
        F.col("p_size").cast("double").alias("inventory_level"),
        F.col("l_linenumber").cast("double").alias("units_ordered"),
        F.col("l_discount").alias("discount"),
        F.col("p_retailprice").alias("competitor_pricing"),
        (F.col("l_returnflag") == "R").cast("int").alias("holiday"),
        (F.col("l_discount") >= 0.05).cast("int").alias("promotion"),
    )


def retail_raw_dirty(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Raw text rows as a CSV export would deliver them, with injected defects.

    Defects are chosen by residues of the order key over the whole table (no row
    is dropped): duplicated rows (% 97), negative units (% 101) and prices
    (% 89), missing units (% 103), product (% 107) and category (% 109),
    unparseable units (% 127) and prices (% 131), US-style dates (% 7) and
    unparseable dates (% 113).
    """
    j = sales_lines(spark, sf_dir) if lines is None else lines
    k = F.col("l_orderkey")
    d = F.to_date("l_shipdate")
    units = F.when(k % 101 == 0, -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    price = F.try_divide("l_extendedprice", "l_quantity")
    price = F.when(k % 89 == 0, -price).otherwise(price)
    rows = j.select(
        F.when(k % 113 == 0, F.lit("not a date"))
         .when(k % 7 == 0, F.date_format(d, "MM/dd/yyyy"))
         .otherwise(F.date_format(d, "yyyy-MM-dd")).alias("date_text"),
        F.col("n_name").alias("store_id"),
        F.when(k % 107 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("product_id"),
        F.when(k % 109 == 0, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("category"),
        F.col("r_name").alias("region"),
        F.when(k % 103 == 0, F.lit(None).cast("string"))
         .when(k % 127 == 0, F.lit("n/a"))
         .otherwise(units.cast("string")).alias("units_sold"),
        F.when(k % 131 == 0, F.lit("unknown")).otherwise(price.cast("string")).alias("price"),
        F.col("o_orderpriority").alias("weather_condition"),
        _season(d).alias("seasonality"),
        F.col("p_size").cast("double").alias("inventory_level"),
        F.col("l_linenumber").cast("double").alias("units_ordered"),
        F.col("l_discount").alias("discount"),
        F.col("p_retailprice").alias("competitor_pricing"),
        k.alias("_k"),
    )
    copies = F.sequence(F.lit(1), F.when(F.col("_k") % 97 == 0, 2).otherwise(1))
    return rows.withColumn("_copy", F.explode(copies)).drop("_k", "_copy")


def stock_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stock table in the (Product ID, Category, current_stock) layout, derived
    from ``part``: ``(sum(p_size) % 20) * 25 - 25`` per brand and type, which
    spreads days of cover over all four urgency levels (negatives are clamped
    by the stock reader)."""
    part = table(spark, sf_dir, "part")
    return (part.groupBy(F.col("p_brand").alias("product_id"), F.col("p_type").alias("category"))
            .agg(((F.sum("p_size") % 20) * 25 - 25).cast("double").alias("current_stock")))


def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense second binding: one sale per event, product = event type."""
    ev = table(spark, sf_dir, "events").select("ts", "event_type", "value")
    d = F.to_date("ts")
    return ev.select(
        d.alias("date"),
        F.lit("web").alias("store_id"),
        F.col("event_type").alias("product_id"),
        F.lit("events").alias("category"),
        F.lit("global").alias("region"),
        F.lit(1.0).alias("units_sold"),
        F.col("value").alias("price"),
        F.lit("n/a").alias("weather_condition"),
        _season(d).alias("seasonality"),
    )
