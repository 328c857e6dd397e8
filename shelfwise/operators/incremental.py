"""Change batches against a keyed manifest (G2, with A12, J6-J9, P21 and K13).

The manifest has a row per root and lives in buckets by the root's hash; beside it are the owners of each document, in buckets by the document's.
A batch reads and rewrites only the buckets that its roots and their changed documents fall into. A root that a batch doesn't
name is left alone: removal is a row that says so, or follows from a batch that is a complete scan. The new buckets and the
batch's operations are published by one record that also has the batch's number, so a batch that comes again, after a
failure on either side of that record, changes nothing or does all of it again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import generations, reconcile

#: Buckets of the manifest and of the owners. A record names each; more make a batch's share of a large manifest smaller.
BUCKETS = 32
MANIFEST = "root_id string, modified_at string, modification_signature string, eligibility_signature string, ownership_signature string, document_ids array<string>, payload_checksum string"
_OWNERS = "document_id string, root_id string"
Checksums = Callable[[DataFrame], DataFrame]


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _held(spark: SparkSession, record: dict, kind: str, buckets: list[int] | None, schema: str) -> DataFrame:
    """The rows of some buckets, or of all."""
    names = [f"{kind} {b}" for b in (range(BUCKETS) if buckets is None else buckets)]
    paths = [record["tables"][n] for n in names if n in record["tables"]]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _staged(run: generations.Run, kind: str, rows: DataFrame, key: str, buckets: list[int]) -> dict[str, str]:
    """Writes rows by bucket; where each bucket is now. A bucket without rows is nowhere."""
    spark, at = rows.sparkSession, run.path(kind)
    rows.withColumn("bucket", _bucket(key)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(at)
    return {f"{kind} {b}": f"{at}/bucket={b}" for b in buckets if generations.exists(spark, f"{at}/bucket={b}")}


def manifest(spark: SparkSession, at: str) -> DataFrame:
    """All roots as of the last batch."""
    return _held(spark, generations.active(spark, at) or {"tables": {}}, "manifest", None, MANIFEST)


def last_batch(spark: SparkSession, at: str) -> int | None:
    return ((generations.active(spark, at) or {}).get("info") or {}).get("batch")


def load(spark: SparkSession, at: str, rows: DataFrame, number: int = -1) -> None:
    """Publishes a whole manifest, such as a full run's, as of batch `number`."""
    run = generations.begin(spark, at)
    try:
        base = generations.stage(run, "base", rows.select(*(c.split()[0] for c in MANIFEST.split(", "))))
        owners = base.select(F.explode("document_ids").alias("document_id"), "root_id").distinct()
        every = list(range(BUCKETS))
        tables = _staged(run, "manifest", base, "root_id", every) | _staged(run, "owners", owners, "document_id", every)
        generations.promote(spark, run, [], info={"batch": number}, keep=tables)
    except BaseException:
        generations.abort(spark, run)
        raise
    generations.removed(spark, run.path("base"))


def _touched_buckets(rows: DataFrame, key: str) -> list[int]:
    return sorted(r[0] for r in rows.select(_bucket(key)).distinct().collect())  # at most BUCKETS


def latest(changes: DataFrame) -> DataFrame:
    """One row per root of a batch: of several the last by `seq`, where there is one."""
    if "seq" not in changes.columns:
        return changes.dropDuplicates(["root_id"])
    names = [c for c in changes.columns if c not in ("root_id", "seq")]
    return changes.groupBy("root_id").agg(F.max_by(F.struct(*names), "seq").alias("x")).select("root_id", *(f"x.{c}" for c in names))


def apply(spark: SparkSession, at: str, changes: DataFrame, number: int, touched: DataFrame, checksums: Checksums, complete: bool = False, check: Callable[[generations.Run], None] | None = None) -> bool:
    """Applies batch `number`: descriptors (root_id, modified_at, three signatures, document_ids) and removed, which may be absent. `checksums` gives
    (root_id, payload_checksum) of the roots it is handed, which are the dirty ones: payloads are made for no others. False if
    the batch was applied before."""
    record = generations.active(spark, at) or {"tables": {}, "info": {}}
    if number <= record["info"].get("batch", -1):
        return False
    run = generations.begin(spark, at, mode="fast", generation=f"batch-{number}")
    try:
        rows = changes if "removed" in changes.columns else changes.withColumn("removed", F.lit(False))
        batch = generations.stage(run, "changes", latest(rows).withColumn("removed", F.coalesce("removed", F.lit(False))))
        roots = None if complete else _touched_buckets(batch, "root_id")
        before = _held(spark, record, "manifest", roots, MANIFEST)
        mine = before if complete else before.join(batch.select("root_id"), "root_id", "left_semi")
        now = batch.filter("not removed").drop("removed")
        reasons = generations.stage(run, "reasons", reconcile.dirty_reasons(now, mine, touched))
        dirty = reasons.filter("reason not in ('clean', 'removed')").select("root_id")
        paid = generations.stage(run, "checksums", checksums(dirty))
        judged = reconcile.with_checksums(reasons, paid)

        moved = _moved(judged)
        documents = _touched_buckets(moved, "document_id")
        owners = _held(spark, record, "owners", documents, _OWNERS)
        gone, new = (moved.filter(f).select("document_id", "root_id") for f in ("not new", "new"))
        owners_now = generations.stage(run, "owners-now", owners.join(gone, ["document_id", "root_id"], "left_anti").union(new).distinct())

        kept = now.join(judged.select("root_id", "payload_checksum"), "root_id").select(*before.columns)
        rest = before.limit(0) if complete else before.join(batch.select("root_id"), "root_id", "left_anti")
        generations.stage(run, f"operations {number}", reconcile.gated_operations(judged, owners_now).withColumn("batch", F.lit(number)))
        tables = {**record["tables"]}
        for kind, table, key, buckets in (("manifest", rest.union(kept), "root_id", list(range(BUCKETS)) if complete else roots), ("owners", owners_now, "document_id", documents)):
            for b in buckets:
                tables.pop(f"{kind} {b}", None)
            tables |= _staged(run, kind, table, key, buckets)
        if check:
            check(run)
        generations.promote(spark, run, [f"operations {number}"], info={**record["info"], "batch": number}, keep=tables)
    except BaseException:
        generations.abort(spark, run)
        raise
    for name in ("changes", "reasons", "checksums", "owners-now"):
        generations.removed(spark, run.path(name))
    return True


def _moved(judged: DataFrame) -> DataFrame:
    """(document_id, root_id, new): what dirty and removed roots got and what they no longer have."""
    nothing = F.array().cast("array<string>")
    now, was = F.coalesce("document_ids", nothing), F.coalesce("previous_ids", nothing)
    dirty = judged.filter("reason <> 'clean'")
    parts = [dirty.select(F.explode(F.array_except(a, b)).alias("document_id"), "root_id", F.lit(new).alias("new")) for a, b, new in ((now, was, True), (was, now, False))]
    return reduce(DataFrame.union, parts).distinct()


def operations(spark: SparkSession, at: str) -> DataFrame:
    """(op, document_id, batch) of all batches that `acknowledge` hasn't let go."""
    tables = (generations.active(spark, at) or {"tables": {}})["tables"]
    paths = [path for name, path in tables.items() if name.startswith("operations ")]
    schema = "op string, document_id string, batch int"
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def net_operations(operations_: DataFrame) -> DataFrame:
    """What is left to do for each document after several batches: its last operation."""
    return operations_.groupBy("document_id").agg(F.max_by("op", "batch").alias("op")).select("op", "document_id")


def acknowledge(spark: SparkSession, at: str, number: int) -> None:
    """Lets the operations of batches up to this one go, once they are uploaded."""
    run, record = generations.begin(spark, at, mode="fast"), generations.active(spark, at)
    if record:
        keep = {n: p for n, p in record["tables"].items() if not n.startswith("operations ") or int(n.split()[1]) > number}
        generations.promote(spark, run, [], info=record["info"], keep=keep)


def applied_stream(stream: DataFrame, at: str, touched: DataFrame, checksums: Checksums, progress: str) -> None:
    """Runs over all that a stream of changes has, a batch for each trigger; batch numbers are the stream's own, so a restart from `progress` replays
    the last one at most."""

    def each(batch: DataFrame, number: int) -> None:
        apply(batch.sparkSession, at, batch, number, touched, checksums)

    stream.writeStream.foreachBatch(each).option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()
