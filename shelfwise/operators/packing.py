"""Upload batches with parents, byte costs and packing across roots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Operations and estimated bytes of an upload, and bytes for each character and each comma.
MAX_ITEMS, MAX_BYTES, BYTES_PER_CHAR = 1000, 5 * 1024 * 1024, 3
_FRAME = len('{"addOrUpdate":[],"delete":[]}') * BYTES_PER_CHAR


def estimated_bytes(payload: Column) -> Column:
    """F44, of JSON text."""
    return F.length(payload).cast("long") * BYTES_PER_CHAR


def root_batches(items: DataFrame, max_items: int = MAX_ITEMS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """(root_id, batch, document_id, repeated, frame_bytes) of items (root_id, pos, document_id, object_type, product_id, payload).

    Variants are packed under their product, which opens each of its batches (`repeated` from the second on); a variant without
    its product in the root is an error, and so is an item that no batch can hold. A group is one product's variants or one root's
    other items, folded in order by one task; groups are bounded by a product's variants."""
    costs = items.withColumn("cost", estimated_bytes(F.col("payload")))
    parents = costs.filter("object_type = 'Product'").select("root_id", "product_id", F.col("document_id").alias("parent"), F.col("pos").alias("parent_pos"), F.col("cost").alias("parent_cost"))
    kids = costs.filter("object_type = 'Variant'").groupBy("root_id", "product_id").agg(F.array_sort(F.collect_list(F.struct("pos", "document_id", "cost"))).alias("items"))
    both = parents.join(kids, ["root_id", "product_id"], "full_outer")
    orphan = F.raise_error(F.concat(F.lit("a variant without its product in "), F.col("root_id"))).cast("string")
    grouped = both.select("root_id", F.when(F.col("parent").isNull(), orphan).otherwise(F.col("parent")).alias("parent"), "parent_pos", "parent_cost", F.coalesce("items", F.array().cast("array<struct<pos:long,document_id:string,cost:long>>")).alias("items"))

    base = F.col("parent_cost") + _FRAME
    start = F.struct(F.lit(0).cast("long").alias("batch"), base.alias("used"), F.lit(1).cast("long").alias("n"), F.array().cast("array<struct<batch:long,document_id:string>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        cost = x["cost"] + BYTES_PER_CHAR
        full = (acc["n"] >= max_items) | (acc["used"] + cost > max_bytes)
        batch, used = acc["batch"] + full.cast("long"), F.when(full, base).otherwise(acc["used"]) + cost
        sound = F.when(used > max_bytes, F.raise_error(F.concat(F.lit("an item too large for a batch: "), x["document_id"])).cast("string")).otherwise(x["document_id"])
        return F.struct(batch.alias("batch"), used.alias("used"), (F.when(full, F.lit(1).cast("long")).otherwise(acc["n"]) + 1).alias("n"), F.concat(acc["out"], F.array(F.struct(batch.alias("batch"), sound.alias("document_id")))).alias("out"))

    packed = grouped.withColumn("packed", F.aggregate("items", start, step))
    opened = packed.select("root_id", "parent", F.explode(F.sequence(F.lit(0).cast("long"), F.col("packed.batch"))).alias("batch"))
    head = opened.select("root_id", "parent", "batch", F.col("parent").alias("document_id"), (F.col("batch") > 0).alias("repeated"))
    return head.union(packed.select("root_id", "parent", F.explode("packed.out").alias("o")).select("root_id", "parent", "o.batch", "o.document_id", F.lit(False)))


def cross_root_uploads(batches: DataFrame, max_items: int = MAX_ITEMS, max_bytes: int = MAX_BYTES, lanes: int = 16) -> DataFrame:
    """(root_id, upload, lane) of root batches (root_id, n_items, n_bytes): the batches of a lane go into uploads in order of root
    until one more would pass a limit. Lanes are a hash of the root, so that more lanes are more tasks; each is folded by one task
    in a stream of rows (mapInPandas), nothing is collected."""
    import pandas as pd

    def fold(frames):  # type: ignore[no-untyped-def]
        lane, upload, n, size = None, 0, 0, 0
        for frame in frames:
            uploads = []
            for now, items, cost in zip(frame["lane"], frame["n_items"], frame["n_bytes"], strict=True):
                if now != lane:
                    lane, upload, n, size = now, 0, 0, 0
                elif n and (n + items > max_items or size + cost > max_bytes):
                    upload, n, size = upload + 1, 0, 0
                n, size = n + items, size + cost
                uploads.append(upload)
            yield pd.DataFrame({"root_id": frame["root_id"], "lane": frame["lane"], "upload": uploads})

    rows = batches.select("root_id", "n_items", "n_bytes", F.pmod(F.conv(F.substring(F.md5("root_id"), 1, 6), 16, 10).cast("long"), F.lit(lanes)).alias("lane"))
    return rows.repartition("lane").sortWithinPartitions("lane", "root_id").mapInPandas(fold, "root_id string, lane long, upload long")
