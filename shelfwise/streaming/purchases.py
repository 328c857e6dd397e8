"""Structured Streaming variants."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.sources.catalog import shared_folder


def event_purchases(events: DataFrame) -> DataFrame:
    """The stream's time is cast to TIMESTAMP, which watermarks need."""
    return events.filter("event_type = 'purchase'").select(F.concat(F.lit("P"), F.get_json_object("props", "$.k")).alias("product_id"), F.col("value"), F.col("ts").cast("timestamp").alias("ts"))


def daily_units(rows: DataFrame) -> DataFrame:
    """G1: units per product and day; on a stream, late rows count within two days."""
    if rows.isStreaming:
        rows = rows.withWatermark("ts", "2 days")
    return rows.groupBy(F.window("ts", "1 day").alias("w"), "product_id").agg(F.sum(F.floor(F.col("value") + 0.5)).alias("units"), F.count(F.lit(1)).alias("n")).select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "product_id", "units", "n")


def rolled(daily: DataFrame, days: int) -> DataFrame:
    """G1: of daily buckets (day, product_id, units), the units of the last `days` days at each day on which a product was bought."""
    when = F.unix_date(F.to_date("day"))
    back = Window.partitionBy("product_id").orderBy("on").rangeBetween(1 - days, 0)
    return daily.withColumn("on", when).select("day", "product_id", F.sum("units").over(back).alias("units"))


def drained(stream: DataFrame, mode: str = "complete") -> DataFrame:
    """Runs a stream over what is there; each micro-batch replaces the result table in shared storage, so nothing passes the driver."""
    spark = stream.sparkSession
    at = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"

    def replace(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/result")

    stream.writeStream.outputMode(mode).foreachBatch(replace).option("checkpointLocation", f"{at}/progress").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/result")


def streamed_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events*.parquet")
    return drained(daily_units(event_purchases(events)))
