
from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, which driver and executors share; only a local master may do without one."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not at and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return at or f"file://{tempfile.mkdtemp(prefix='spark-', dir='/tmp')}"


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants and standalone products: one row per part."""
    at = F.expr("l_shipdate + make_dt_interval(0, 0, 0, CAST((l_orderkey * 7919 % 86400000) / 1000 AS DECIMAL(18, 6)))")  # a time of the day for each order
    times = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.min(at).alias("created"), F.max(at).alias("modified"), F.max("l_discount").alias("discount"))
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    variant = key % 10 != 0
    return part.join(times, part["p_partkey"] == times["l_partkey"], "left").select(
        F.concat(F.lit("P"), key).alias("id"), key.alias("key"), variant.alias("is_variant"),
        F.when(variant, F.concat(F.lit("M-"), F.regexp_replace("p_brand", "[^0-9]", ""), F.lit("-"), F.col("p_type"))).alias("master_id"),
        F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_type").alias("type"), F.split("p_name", " ")[0].alias("color"), F.col("p_size").alias("size"),
        (key % 7 != 0).alias("online"), (key % 11 != 0).alias("searchable"), "created", "modified",
        F.col("p_retailprice").alias("list_price"), F.when(key % 3 == 0, F.col("p_retailprice") * (1 - F.col("discount"))).alias("sale_price"),
    )


def masters(items: DataFrame) -> DataFrame:
    """One master per brand and type of the variants; made just before the first of them, changed just after the last."""
    milli = F.expr("make_dt_interval(0, 0, 0, 0.001)")
    return items.filter("is_variant").groupBy("master_id").agg(F.first("type").alias("type"), F.first("brand").alias("brand"), (F.min("created") - milli).alias("created"), (F.max("modified") + milli).alias("modified")).select(
        F.col("master_id").alias("id"), "brand", "type", (F.col("type") != "PROMO").alias("online"), F.lit(True).alias("searchable"), "created", "modified"
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region over nation over supplier, as an adjacency list."""
    region, nation, supplier = (table(spark, sf_dir, t) for t in ("region", "nation", "supplier"))
    top = region.select(F.concat(F.lit("R"), "r_regionkey").alias("id"), F.lit("root").alias("parent_id"), F.col("r_name").alias("name"), F.lit(True).alias("online"), F.col("r_regionkey").cast("long").alias("pos"))
    middle = nation.select(F.concat(F.lit("N"), "n_nationkey"), F.concat(F.lit("R"), "n_regionkey"), "n_name", F.col("n_nationkey") % 12 != 0, F.col("n_nationkey").cast("long"))
    low = supplier.select(F.concat(F.lit("S"), "s_suppkey"), F.concat(F.lit("N"), "s_nationkey"), "s_name", F.col("s_suppkey") % 9 != 0, F.col("s_suppkey"))
    return top.union(middle).union(low)


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product to category; the first is the primary one."""
    lines = table(spark, sf_dir, "lineitem")
    every = lines.groupBy("l_partkey").agg(F.collect_set("l_suppkey").alias("all"))  # a product's suppliers are few
    rows = every.select(F.concat(F.lit("P"), "l_partkey").alias("product_id"), F.array_min("all").alias("first"), F.explode("all").alias("pos"))
    return rows.select("product_id", F.concat(F.lit("S"), "pos").alias("category_id"), "pos", (F.col("pos") == F.col("first")).alias("is_primary"))


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as purchase rows: product and quantity are text, blank or invalid where the order says so."""
    order = F.col("l_orderkey")
    number = F.when(order % 97 == 0, "").when(order % 89 == 0, "-1").otherwise(F.col("l_quantity").cast("int").cast("string"))
    return table(spark, sf_dir, "lineitem").select(F.when(order % 101 == 0, "").otherwise(F.concat(F.lit("P"), "l_partkey")).alias("product_id"), number.alias("quantity"), F.col("l_shipdate").alias("ts"))
