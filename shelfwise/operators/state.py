"""Manifests, snapshots and target state in storage.

Each place is a folder in shared storage whose tables are published through `generations`: what is written is staged, and one record makes it
visible, so a reader never sees half of it, and a run that fails leaves what was there.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import generations
from shelfwise.operators.purchases import totals

#: Hours after which a full reconciliation is due, minutes for which a snapshot is fresh, the descriptors' version.
MAX_AGE_HOURS, FRESH_MINUTES, DESCRIPTOR_VERSION = 24, 60, 1


def write_manifest(descriptors: DataFrame, at: str, generation: str, started: str, mode: str = "deep", completed: str = "", check: Callable[[generations.Run], None] | None = None) -> dict:
    """The descriptors and their run row, with totals (A7) and the time when the run began, as a generation."""
    spark = descriptors.sparkSession
    run = generations.begin(spark, at, mode, started, generation)
    try:
        totals_ = run_totals(generations.stage(run, "manifest", descriptors))
        generations.stage(run, "run", totals_.select(F.lit(started).alias("started"), "*"))
        if check:
            check(run)
        return generations.promote(spark, run, ["manifest", "run"], completed)
    except BaseException:
        generations.abort(spark, run)
        raise


def read_manifest(spark: SparkSession, at: str, generation: str | None = None) -> DataFrame:
    """The published manifest; another generation than the one asked for, or none, is an error."""
    record = generations.active(spark, at)
    if record is None or generation not in (None, record["generation"]):
        raise ValueError(f"{at} has no manifest {generation or ''}")
    return generations.table(spark, at, "manifest")


def high_water(spark: SparkSession, at: str) -> str | None:
    """When the published run began, from where the next one looks for changes."""
    return None if generations.active(spark, at) is None else generations.table(spark, at, "run").first()["started"]


def run_totals(descriptors: DataFrame) -> DataFrame:
    """A7."""
    return descriptors.agg(F.count(F.lit(1)).alias("n_roots"), F.coalesce(F.sum(F.size("document_ids")), F.lit(0)).cast("long").alias("n_documents"))


def document_index(descriptors: DataFrame) -> DataFrame:
    """K3: a row per current document."""
    return descriptors.select(F.explode("document_ids").alias("document_id"), "root_id")


def mode(requested: Column, force: Column, pending: Column, has_manifest: Column, version: Column, last_deep: Column, now: Column, max_hours: Column) -> Column:
    """struct(mode, reason, age_hours, rejected) of a reconciliation run. `rejected` means that fast was asked for and can't be."""
    age = F.greatest(F.lit(0.0), (F.unix_micros(now) - F.unix_micros(last_deep)) / F.lit(3.6e9))
    due = F.coalesce(max_hours, F.lit(MAX_AGE_HOURS))
    needed = (
        F.when(pending, "pending-deep-request").when(~has_manifest, "missing-deep-baseline").when(~version.eqNullSafe(F.lit(DESCRIPTOR_VERSION)), "unsupported-descriptor-schema")
        .when(last_deep.isNull(), "invalid-deep-baseline-timestamp").when(age >= due, "maximum-deep-age-exceeded")
    )
    reason = F.when(force, "force-deep").when(requested == "deep", "explicit-deep").otherwise(F.coalesce(needed, F.lit("usable-deep-baseline")))
    aged = reason.isin("maximum-deep-age-exceeded", "usable-deep-baseline")
    return F.struct(F.when(reason == "usable-deep-baseline", "fast").otherwise("deep").alias("mode"), reason.alias("reason"), F.when(aged, age).alias("age_hours"), ((requested == "fast") & ~force & needed.isNotNull()).alias("rejected"))


def fresh(taken: Column, now: Column, minutes: int = FRESH_MINUTES) -> Column:
    """P23."""
    age = F.unix_micros(now) - F.unix_micros(taken)
    return F.coalesce((age >= 0) & (age <= minutes * 60_000_000), F.lit(False))


def _counts(tracking_id: str, window_days: int) -> str:
    return f"counts {window_days} {tracking_id}"


def _state(target: str, part: str) -> str:
    return f"{part} {target}"


def write_snapshot(counts: DataFrame, at: str, tracking_id: str, window_days: int, taken: str) -> dict:
    """K6: counts (product_id, units_sold) of one tracking id and window, and when they were taken."""
    name = _counts(tracking_id, window_days)
    return generations.publish(counts.sparkSession, at, {name: counts}, {name: {"tracking_id": tracking_id, "window_days": window_days, "taken": taken}})


def read_snapshots(spark: SparkSession, at: str, tracking_id: str) -> DataFrame:
    """(window_days, product_id, units_sold, taken) of all windows of a tracking id; a window whose counts are gone is an error, and so is a
    tracking id without any."""
    record = generations.active(spark, at) or {"tables": {}, "info": {}}
    known = {name: x for name, x in record["info"].items() if name.startswith("counts ") and x["tracking_id"] == tracking_id}
    if not known:
        raise ValueError(f"{at} has no snapshot of {tracking_id}")
    gone = [name for name in known if name not in record["tables"] or not generations.exists(spark, f"{record['tables'][name]}/_SUCCESS")]
    if gone:
        raise ValueError(f"a snapshot's counts are missing: {', '.join(sorted(gone))}")
    parts = [spark.read.parquet(record["tables"][name]).select(F.lit(x["window_days"]).alias("window_days"), "product_id", "units_sold", F.lit(x["taken"]).alias("taken")) for name, x in sorted(known.items())]
    return reduce(DataFrame.union, parts)


def _summary(mapped: DataFrame, skipped: DataFrame) -> DataFrame:
    """One row, from one count each."""
    both = mapped.select(F.lit(1).alias("m")).union(skipped.select(F.lit(0)))
    return both.agg(F.coalesce(F.sum("m"), F.lit(0)).cast("long").alias("n_mapped"), F.coalesce(F.sum(1 - F.col("m")), F.lit(0)).cast("long").alias("n_skipped"))


def _target_outputs(mapped: DataFrame, skipped: DataFrame, target: str) -> dict[str, DataFrame | Callable[[Mapping[str, DataFrame]], DataFrame]]:
    """The summary counts what was staged: neither table is made a second time for it."""
    lost, current = _state(target, "skipped"), _state(target, "current")
    return {lost: skipped, current: mapped, _state(target, "summary"): lambda staged: _summary(staged[current], staged[lost])}


def write_target_state(mapped: DataFrame, skipped: DataFrame, at: str, target: str = "") -> dict:
    """A target's mapped products, which are its current state, the skipped ones and their counts."""
    return generations.publish(mapped.sparkSession, at, _target_outputs(mapped, skipped, target))


def publish_metrics(counts: DataFrame, mapped: DataFrame, skipped: DataFrame, at: str, tracking_id: str, window_days: int, taken: str, target: str, check: Callable[[generations.Run], None] | None = None) -> dict:
    """K8: the snapshot that all targets of a tracking id share and one target's state, both or neither."""
    name = _counts(tracking_id, window_days)
    return generations.publish(counts.sparkSession, at, {name: counts, **_target_outputs(mapped, skipped, target)}, {name: {"tracking_id": tracking_id, "window_days": window_days, "taken": taken}}, check=check)


def read_target_state(spark: SparkSession, at: str, which: str = "current", target: str = "") -> DataFrame:
    """Product, root, document and units; none are zero. A state that was never written is empty."""
    rows = generations.table(spark, at, _state(target, which), "product_id string, root_id string, document_id string, units_sold long")
    return rows.withColumn("units_sold", F.coalesce("units_sold", F.lit(0)))


def target_summary(spark: SparkSession, at: str, target: str = "") -> DataFrame:
    return generations.table(spark, at, _state(target, "summary"))


def write_target_reports(spark: SparkSession, at: str, to: str, target: str = "") -> None:
    """K7, K9: the mapped and the skipped products of the published state as CSV."""
    write_sorted_csv(read_target_state(spark, at, "current", target), "product_id", f"{to}/mapped")
    write_sorted_csv(generations.table(spark, at, _state(target, "skipped")), "product_id", f"{to}/skipped")


def advance_full(spark: SparkSession, at: str, target: str = "") -> DataFrame:
    """After a full export the applied state is the current one: the record names its table twice, nothing is copied."""
    run, record = generations.begin(spark, at), generations.active(spark, at) or {"tables": {}, "info": {}}
    if (current := record["tables"].get(_state(target, "current"))) is None:
        raise ValueError(f"{at} has no state of {target}")
    generations.promote(spark, run, [], record.get("completed", ""), record["info"], {**record["tables"], _state(target, "applied"): current})
    return read_target_state(spark, at, "applied", target)


def advance_delta(spark: SparkSession, at: str, applied: DataFrame, target: str = "") -> DataFrame:
    """The state after a delta run, as `purchases.advanced` gives it."""
    generations.publish(spark, at, {_state(target, "applied"): applied})
    return read_target_state(spark, at, "applied", target)


def header_of(columns: list[str], dimension: str) -> str:
    """The column of a dimension, by its full name, else by what follows the last dot; a byte order mark is no part of it."""
    bare = {c.lstrip("﻿").strip(): c for c in reversed(columns)}
    for name in (dimension, dimension.rsplit(".", 1)[-1]):
        if name in bare:
            return bare[name]
    raise ValueError(f"no column {dimension} among {', '.join(columns)}")


def purchase_file(spark: SparkSession, path: str, product: str, quantity: str) -> DataFrame:
    """Product and quantity of a purchase export in CSV, as text."""
    rows = spark.read.option("header", True).option("escape", '"').csv(path)
    columns = [F.coalesce(F.col(f"`{header_of(rows.columns, d)}`"), F.lit("")).alias(n) for d, n in ((product, "product_id"), (quantity, "quantity"))]
    return rows.select(*columns)


def purchase_totals_of_file(spark: SparkSession, path: str, product: str, quantity: str) -> DataFrame:
    return totals(purchase_file(spark, path, product, quantity))


def write_sorted_csv(rows: DataFrame, key: str, at: str) -> None:
    """K9: CSV with a header, sorted by key inside each file."""
    rows.repartition(key).sortWithinPartitions(key).write.mode("overwrite").option("header", True).option("escape", '"').csv(at)
