"""Uploads over one global order, and the index they go into.

An upload takes rows in order until one more would pass a limit, so where it ends depends on where it began, and that on all
before it. Still no task sees more than a block of rows: each block works out, for each of its first rows, in which row of the
next block the upload begins that follows if one begins here; these small tables are composed by doubling over the blocks; then each
block knows its own beginning and numbers its uploads.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.operators import generations
from shelfwise.operators.packing import BYTES_PER_CHAR, MAX_BYTES, MAX_ITEMS
from shelfwise.sources.catalog import shared_folder

#: Rows of a block: at least as many as an upload can have.
BLOCK = 100_000


def _stored(rows: DataFrame, at: str, name: str) -> DataFrame:
    rows.write.parquet(f"{at}/{name}")
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{at}/{name}")


def in_order(rows: DataFrame, order: list[Column], at: str) -> DataFrame:
    """Rows with `i`, their place in one global order from 0, by range partitions and the counts of those before: a number per partition."""
    sorted_ = _stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id()), at, "sorted")
    part = F.shiftright("_m", 33)
    sizes = sorted_.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("_p", (F.sum("n").over(Window.orderBy("_p")) - F.col("n")).alias("_before"))
    within = F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    return sorted_.join(F.broadcast(before), part == F.col("_p")).withColumn("i", F.col("_before") + within).drop("_m", "_p", "_before")


def next_starts(items: np.ndarray, sizes: np.ndarray, max_items: int, max_bytes: int) -> np.ndarray:
    """For each row, the first row that doesn't fit into an upload that begins with it."""
    n, size = np.append(0, np.cumsum(items)), np.append(0, np.cumsum(sizes))
    start = np.arange(len(items))
    end = np.minimum(np.searchsorted(n, n[:-1] + max_items, side="right"), np.searchsorted(size, size[:-1] + max_bytes, side="right")) - 1
    return np.maximum(end, start + 1)


def uploads(rows: DataFrame, order: list[Column], max_items: int = MAX_ITEMS, max_bytes: int = MAX_BYTES, block: int = BLOCK) -> DataFrame:
    """Rows (n_items, n_bytes, others) with `upload`, the number of theirs from 0 on, over the whole order. A row beyond a limit by itself is an
    error, and so is one without items."""
    spark = rows.sparkSession
    if block < max_items:
        raise ValueError("a block is smaller than an upload")
    at = f"{shared_folder(spark)}/uploads-{uuid.uuid4().hex}"
    sound = F.when((F.col("n_items") > max_items) | (F.col("n_bytes") > max_bytes), F.raise_error(F.lit("a row exceeds the limits of an upload")).cast("long")).when(F.col("n_items") < 1, F.raise_error(F.lit("a row without items")).cast("long")).otherwise(F.col("n_items"))
    placed = _stored(in_order(rows.withColumn("n_items", sound), order, at), at, "placed")
    own = F.floor(F.col("i") / block)
    # a block's uploads can end among the first rows of the next: those go to both
    both = F.when((F.col("i") % block < max_items) & (own > 0), F.array(own, own - 1)).otherwise(F.array(own))
    costs = placed.select("i", F.col("n_items").cast("long").alias("n"), F.col("n_bytes").cast("long").alias("size"), F.explode(both).alias("block"))

    def dealt(found: DataFrame) -> DataFrame:
        return found.repartition("block").sortWithinPartitions("block", "i")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        """Each block's columns, whole: block and overlap are bounded."""
        held: list[np.ndarray] = []
        for batch in batches:
            now = np.stack([batch.column(c).to_numpy() for c in range(batch.num_columns)]) if batch.num_rows else None
            if now is None:
                continue
            held = [np.concatenate([*held, now], axis=1)]
            edge = np.flatnonzero(np.diff(held[0][0])) + 1
            for lo, hi in zip([0, *edge.tolist()], edge.tolist(), strict=False):
                yield int(held[0][0, lo]), held[0][:, lo:hi]
            held = [held[0][:, edge[-1] :]] if len(edge) else held
        if held and held[0].shape[1]:
            yield int(held[0][0, 0]), held[0]

    steps = pa.schema([("block", pa.int64()), ("entry", pa.int64()), ("next", pa.int64())])

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, (_, i, n, size) in blocks(batches):
            inside = int((i < (number + 1) * block).sum())
            after = next_starts(n, size, max_items, max_bytes)
            leaves = np.arange(len(i) + 1)
            for k in range(inside - 1, -1, -1):  # from the right: where the chain from here leaves the block
                leaves[k] = leaves[after[k]]
            entry = np.arange(min(max_items, inside))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(entry), number)), pa.array(entry), pa.array(leaves[entry] - inside)], schema=steps)

    cols = costs.select("block", "i", "n", "size")
    jump = _stored(dealt(cols).mapInArrow(tables, "block long, entry long, next long"), at, "jump-0")
    known = _stored(spark.range(1).select(F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("entry")), at, "known-0")
    last, width, k = placed.agg(F.max("i")).first()[0], 1, 0
    while last is not None and width <= last // block:  # rounds: the logarithm of the blocks
        k += 1
        far = known.join(jump, ["block", "entry"]).select((F.col("block") + width).alias("block"), F.col("next").alias("entry"))
        known = _stored(known.union(far), at, f"known-{k}")
        ahead = jump.select((F.col("block") - width).alias("block"), F.col("entry").alias("next"), F.col("next").alias("then"))
        jump = _stored(jump.join(ahead, ["block", "next"]).select("block", "entry", F.col("then").alias("next")), at, f"jump-{k}")
        width *= 2

    labels = pa.schema([("i", pa.int64()), ("block", pa.int64()), ("nth", pa.int64())])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, (_, i, n, size, entry) in blocks(batches):
            inside = int((i < (number + 1) * block).sum())
            after = next_starts(n, size, max_items, max_bytes)
            begins = np.zeros(inside, dtype=np.int64)
            k = int(entry[0])
            while k < inside:
                begins[k] = 1
                k = int(after[k])
            yield pa.RecordBatch.from_arrays([pa.array(i[:inside]), pa.array(np.full(inside, number)), pa.array(np.cumsum(begins))], schema=labels)

    entered = dealt(costs.join(known, "block").select("block", "i", "n", "size", "entry"))
    nth = _stored(entered.mapInArrow(numbered, "i long, block long, nth long"), at, "nth")
    for name in ("sorted", *(f"{t}-{j}" for t in ("jump", "known") for j in range(k + 1))):
        generations.removed(spark, f"{at}/{name}")
    begun = nth.groupBy("block").agg(F.max("nth").alias("n"))
    before = begun.select("block", (F.sum("n").over(Window.orderBy("block")) - F.col("n")).alias("before"))  # a number per block
    numbers = nth.join(F.broadcast(before), "block").select("i", (F.col("before") + F.col("nth") - 1).alias("upload"))
    return placed.join(numbers, "i").drop("i")


def delta_uploads(batches: DataFrame, deletes: DataFrame, order: list[str], max_items: int = MAX_ITEMS, max_bytes: int = MAX_BYTES, block: int = BLOCK) -> DataFrame:
    """The batches (n_items, n_bytes and the columns of `order`, by which they come) of all roots, then the deletes (document_id), which share
    the last root's upload."""
    kinds = {c: batches.schema[c].dataType for c in order}
    none = F.lit(None).cast("string")
    adds = batches.select(F.lit(0).alias("late"), *order, none.alias("document_id"), F.col("n_items").cast("long"), F.col("n_bytes").cast("long"))
    quoted = F.length(F.to_json(F.struct(F.col("document_id").alias("d")))) - len('{"d":}')
    gone = deletes.select(F.lit(1).alias("late"), *(F.lit(None).cast(k).alias(c) for c, k in kinds.items()), "document_id", F.lit(1).cast("long").alias("n_items"), (quoted * BYTES_PER_CHAR).cast("long").alias("n_bytes"))
    return uploads(adds.union(gone), [F.col(c) for c in ("late", *order, "document_id")], max_items, max_bytes, block).drop("late")


def payloads(operations: DataFrame) -> DataFrame:
    """K1: (batch, payload) of operations (batch, op, pos, document_id, item): one JSON document for each batch, its items and deletes in order.

    A batch is refused, and with it the write, if a document is both added and deleted in it, comes twice, has no id, or if an added item
    is empty. A batch is an upload, so it fits a row."""
    add = F.col("op") == "addOrUpdate"
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(c)), lambda x: x["v"])
    empty = (F.coalesce("document_id", F.lit("")) == "") | (add & F.coalesce(F.trim("item"), F.lit("")).isin("", "{}", "null")) | ~F.col("op").isin("addOrUpdate", "delete")
    grouped = operations.groupBy("batch").agg(
        F.max(empty).alias("empty"), F.count(F.lit(1)).alias("n"), F.count_distinct("document_id").alias("documents"), F.count_distinct("op", "document_id").alias("pairs"),
        ordered(F.when(add, F.struct("pos", F.col("item").alias("v")))).alias("items"), ordered(F.when(~add, F.struct("pos", F.col("document_id").alias("v")))).alias("gone"),
    )
    refused = F.when(F.col("empty"), "an empty operation").when(F.col("pairs") > F.col("documents"), "a document is added and deleted").when(F.col("n") > F.col("pairs"), "a document comes twice")
    quoted = F.substring(F.to_json(F.struct(F.col("gone").alias("d"))), 6, 1 << 30)  # {"d":[...]} without its head
    text = F.concat(F.lit('{"addOrUpdate":['), F.array_join("items", ","), F.lit('],"delete":'), quoted)
    fails = F.raise_error(F.concat(F.lit("batch "), F.col("batch").cast("string"), F.lit(": "), refused)).cast("string")
    return grouped.select("batch", F.when(refused.isNotNull(), fails).otherwise(text).alias("payload"))


def write_payloads(operations: DataFrame, at: str) -> None:
    """K1: a folder for each batch with one text file of one line. Spark commits all files of the write or, if a batch is refused, none."""
    payloads(operations).repartition("batch").write.partitionBy("batch").text(at)


PLACEHOLDER = "placeholder://empty-run"
_INDEX = "ordering_id long, document_id string, op string, item string"


def reserve(spark: SparkSession, at: str, n: int) -> int:
    """The first of `n` ordering ids that no other run gets: they only ever grow. One run at a time."""
    record = generations.active(spark, at) or {"tables": {}, "info": {}}
    first = int(record["info"].get("next", 1))
    run = generations.begin(spark, at)
    generations.promote(spark, run, [], info={**record["info"], "next": first + n}, keep=record["tables"])
    return first


def push(spark: SparkSession, at: str, operations: DataFrame) -> int | None:
    """Puts a run's operations (upload from 0 on, document_id, op, item) into the index, each upload under an ordering id; W7: the run's first
    ordering id, none if it has no operations. Each upload is a partition."""
    least, last = operations.agg(F.min("upload"), F.max("upload")).first()
    if last is None:
        return None
    first = reserve(spark, at, int(last) + 1)
    record = generations.active(spark, at)
    run = generations.begin(spark, at)
    try:
        rows = operations.select((F.col("upload") + first).cast("long").alias("ordering_id"), "document_id", "op", "item")
        rows.repartition("ordering_id").write.mode("overwrite").partitionBy("ordering_id").parquet(run.path("index"))
        generations.promote(spark, run, [], info=record["info"], keep={**record["tables"], f"index {first}": run.path("index")})
    except BaseException:
        generations.abort(spark, run)
        raise
    return first + int(least)


def delete_older_than(spark: SparkSession, at: str, ordering_id: int) -> None:
    """Nothing below the ordering id is in the index any more: the boundary moves in one record, then whole uploads go, unread."""
    record = generations.active(spark, at)
    if not record:
        return
    run = generations.begin(spark, at)
    boundary = max(ordering_id, int(record["info"].get("boundary", 0)))
    starts = sorted(int(n.split()[1]) for n in record["tables"] if n.startswith("index "))
    ends = dict(zip(starts, [*starts[1:], int(record["info"]["next"])], strict=True))
    keep = {n: p for n, p in record["tables"].items() if not n.startswith("index ") or ends[int(n.split()[1])] > boundary}
    generations.promote(spark, run, [], info={**record["info"], "boundary": boundary}, keep=keep)


def full_run(spark: SparkSession, at: str, operations: DataFrame) -> int:
    """A full run's operations go in, and what is older goes out. A run without operations deletes a document that doesn't exist, so that
    it too has an ordering id and the boundary moves."""
    first = push(spark, at, operations)
    if first is None:
        first = push(spark, at, spark.createDataFrame([(0, PLACEHOLDER, "delete", None)], "upload long, document_id string, op string, item string"))
    delete_older_than(spark, at, first)
    return first


def index(spark: SparkSession, at: str) -> DataFrame:
    """(document_id, ordering_id, item): what the index holds: each document's last operation from the boundary on, if it isn't a delete."""
    record = generations.active(spark, at) or {"tables": {}, "info": {}}
    rows = spark.createDataFrame([], _INDEX)
    for name, path in sorted(record["tables"].items()):
        if name.startswith("index "):
            rows = rows.unionByName(spark.read.schema(_INDEX).parquet(path))
    live = rows.filter(F.col("ordering_id") >= int(record["info"].get("boundary", 0)))
    last = live.groupBy("document_id").agg(F.max_by(F.struct("op", "ordering_id", "item"), "ordering_id").alias("x"))
    return last.filter("x.op <> 'delete'").select("document_id", "x.ordering_id", "x.item")
