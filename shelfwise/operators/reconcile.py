"""Comparing the current roots with the last manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SIGNATURES = ("modification_signature", "eligibility_signature", "ownership_signature")


def previous_manifest(current: DataFrame) -> DataFrame:
    """A stand-in for the last run: some roots absent, some older, some since gone."""
    n = F.conv(F.substring(F.md5("root_id"), 1, 6), 16, 10).cast("long")
    kept = current.filter(n % 13 != 0).withColumn("modification_signature", F.when(n % 5 == 0, F.lit("old")).otherwise(F.col("modification_signature")))
    kept = kept.withColumn("document_ids", F.when(n % 7 == 0, F.concat("document_ids", F.array(F.concat(F.lit("product://pid=OLD-"), "root_id")))).otherwise(F.col("document_ids")))
    kept = kept.withColumn("eligibility_signature", F.when(n % 11 == 0, F.lit("other")).otherwise(F.col("eligibility_signature")))
    gone = current.filter(n % 17 == 0).select(F.concat(F.lit("GONE-"), "root_id").alias("root_id"), *SIGNATURES, F.array_compact(F.array(F.concat(F.lit("product://pid=GONE-"), "root_id"), F.get("document_ids", F.lit(0)))).alias("document_ids"))
    return kept.select("root_id", *SIGNATURES, "document_ids").unionByName(gone)


def dirty_reasons(current: DataFrame, previous: DataFrame, touched: DataFrame, deep: bool = False) -> DataFrame:
    """One full outer join; the first reason that holds. Removed roots are in the previous manifest only."""
    c, p = current.alias("c"), previous.alias("p")
    joined = c.join(p, F.col("c.root_id") == F.col("p.root_id"), "full_outer")
    paid = [F.col("p.payload_checksum").alias("previous_checksum")] if "payload_checksum" in previous.columns else []
    wide = joined.select(F.coalesce("c.root_id", "p.root_id").alias("root_id"), *paid, *(F.col(f"{s}.{k}").alias(f"{s}_{k}") for s in "cp" for k in ("root_id", *SIGNATURES, "document_ids")))
    marked = wide.join(touched.distinct().withColumn("touched", F.lit(True)), "root_id", "left")
    reason = F.when(F.col("c_root_id").isNull(), "removed")
    if deep:
        reason = reason.otherwise("forced")
    else:
        reason = (
            reason.when(F.col("p_root_id").isNull(), "new")
            .when(F.col("p_modification_signature").isNull(), "migration")
            .when(F.col("c_modification_signature") != F.col("p_modification_signature"), "modified")
            .when((F.col("c_eligibility_signature") != F.col("p_eligibility_signature")) | (F.col("c_ownership_signature") != F.col("p_ownership_signature")), "eligibilityOwnership")
            .when(F.col("touched"), "purchase")
            .otherwise("clean")
        )
    return marked.select("root_id", reason.alias("reason"), F.col("c_document_ids").alias("document_ids"), F.col("p_document_ids").alias("previous_ids"), *(["previous_checksum"] if paid else []))


def with_checksums(reasons: DataFrame, checksums: DataFrame) -> DataFrame:
    """Adds payload_checksum: that of the dirty roots' payloads, made for this run; clean roots carry theirs over."""
    rows = reasons.join(checksums.select("root_id", F.col("payload_checksum").alias("made")), "root_id", "left")
    made = F.coalesce("made", F.sha2(F.lit(""), 256))  # a root without documents has an empty payload
    return rows.withColumn("payload_checksum", F.when(F.col("reason") == "clean", F.col("previous_checksum")).when(F.col("reason") != "removed", made)).drop("made")


def gated_operations(judged: DataFrame, owned: DataFrame) -> DataFrame:
    """Documents of dirty roots whose payload isn't the one that was sent last; candidates that no root in `owned` (document_id) has
    are deleted."""
    changed = judged.filter("reason not in ('clean', 'removed') and not payload_checksum <=> previous_checksum")
    adds = changed.select(F.lit("addOrUpdate").alias("op"), F.explode("document_ids").alias("document_id")).distinct()
    deletes = delete_candidates(judged).join(owned.select("document_id").distinct(), "document_id", "left_anti").select(F.lit("delete").alias("op"), "document_id")
    return adds.union(deletes)


def unstable_roots(before: DataFrame, after: DataFrame, generated: DataFrame) -> DataFrame:
    """(root_id, problem) of roots whose descriptor isn't the same before and after their items were made (appeared, disappeared, a signature
    that differs), or whose items (root_id, document_ids) aren't those of the descriptor. One grouping over both reads and the items."""
    side = lambda rows, n: rows.select("root_id", F.lit(n).alias("side"), *SIGNATURES, F.array_sort("document_ids").alias("ids"))
    items = generated.select("root_id", F.lit("g").alias("side"), *(F.lit(None).cast("string").alias(s) for s in SIGNATURES), F.array_sort("document_ids").alias("ids"))
    rows = side(before, "b").union(side(after, "a")).union(items)
    of = lambda n: F.first(F.when(F.col("side") == n, F.struct(*SIGNATURES, "ids")), ignorenulls=True).alias(n)
    seen = rows.groupBy("root_id").agg(of("b"), of("a"), of("g"))
    nothing = F.array().cast("array<string>")
    problem = (
        F.when(F.col("b").isNull() & F.col("a").isNotNull(), "appeared").when(F.col("b").isNotNull() & F.col("a").isNull(), "disappeared")
        .when(F.coalesce(*(F.when(~F.col(f"b.{s}").eqNullSafe(F.col(f"a.{s}")), F.lit(s)) for s in SIGNATURES), F.lit("")) != "", F.concat(F.coalesce(*(F.when(~F.col(f"b.{s}").eqNullSafe(F.col(f"a.{s}")), F.lit(s)) for s in SIGNATURES)), F.lit(" differs")))
        .when(F.coalesce("g.ids", nothing) != F.coalesce("b.ids", nothing), "other documents")
    )
    return seen.select("root_id", problem.alias("problem")).filter("problem is not null")


def assert_stable(before: DataFrame, after: DataFrame, generated: DataFrame) -> None:
    """Fails a run before it is published, naming the first unstable roots and how many there are."""
    worst = unstable_roots(before, after, generated).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("root_id", "problem")).alias("first")).first()
    if worst["n"]:
        raise ValueError(f"{worst['n']} roots changed while the run went on, first {worst['first']['root_id']}: {worst['first']['problem']}; run it again")


def statistics(reasons: DataFrame) -> DataFrame:
    """A6."""
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def delete_candidates(reasons: DataFrame) -> DataFrame:
    """Documents that dirty and removed roots no longer have."""
    gone = F.array_except("previous_ids", F.coalesce("document_ids", F.array().cast("array<string>")))
    return reasons.filter("reason <> 'clean' and previous_ids is not null").select(F.explode(gone).alias("document_id")).distinct()


def operations(reasons: DataFrame) -> DataFrame:
    """Documents of dirty roots are added; candidates that no current root owns are deleted."""
    owned = reasons.select(F.explode("document_ids").alias("document_id"))
    adds = reasons.filter("reason not in ('clean', 'removed')").select(F.lit("addOrUpdate").alias("op"), F.explode("document_ids").alias("document_id")).distinct()
    deletes = delete_candidates(reasons).join(owned, "document_id", "left_anti").select(F.lit("delete").alias("op"), "document_id")
    return adds.union(deletes)


def write_batches(rows: DataFrame, at: str) -> None:
    """K1: operations (batch, op, document_id, payload) as JSON lines, a folder for each batch."""
    rows.repartition("batch").write.mode("overwrite").partitionBy("batch").json(at)


def fixed_batches(rows: DataFrame, within: str, order: str, size: int) -> DataFrame:
    """Chunks of a fixed size, numbered within each group."""
    n = F.row_number().over(Window.partitionBy(within).orderBy(order))
    return rows.withColumn("batch", F.floor((n - 1) / size))


def greedy_batches(rows: DataFrame, within: str, item: str, cost: str, limit: int, most: int) -> DataFrame:
    """In order, a batch is closed when one more item would pass the limit or it holds `most` items.
    A fold over the group's array: groups are single roots, which fit a row."""
    items = rows.groupBy(within).agg(F.array_sort(F.collect_list(F.struct(item, cost))).alias("items"))
    start = F.struct(F.lit(0).cast("long").alias("batch"), F.lit(0).cast("long").alias("used"), F.lit(0).cast("long").alias("n"), F.array().cast(f"array<struct<{item}:string,batch:bigint>>").alias("out"))

    def step(acc, x):
        full = (acc["n"] > 0) & ((acc["n"] >= most) | (acc["used"] + x[cost] > limit))
        batch = acc["batch"] + F.when(full, 1).otherwise(0)
        used = F.when(full, F.lit(0).cast("long")).otherwise(acc["used"]) + x[cost]
        n = F.when(full, F.lit(0).cast("long")).otherwise(acc["n"]) + 1
        return F.struct(batch.alias("batch"), used.alias("used"), n.alias("n"), F.concat(acc["out"], F.array(F.struct(x[item].alias(item), batch.alias("batch")))).alias("out"))

    return items.select(within, F.explode(F.aggregate("items", start, step)["out"]).alias("o")).select(within, f"o.{item}", "o.batch")


def validation_errors(items: DataFrame) -> DataFrame:
    """The part of P12 that items known by document alone allow: duplicates by count, parents by anti-join."""
    repeated = F.count(F.lit(1)).over(Window.partitionBy("document_id")) > 1
    parents = items.filter("object_type = 'Product'").select(F.col("document_id").alias("parent_id")).distinct()
    orphan = items.filter("object_type = 'Variant'").join(parents, "parent_id", "left_anti").select("document_id", F.lit("missing_parent").alias("error"))
    checks = F.array_compact(F.array(F.when(F.coalesce("document_id", F.lit("")) == "", "missing_document_id"), F.when(F.coalesce("language", F.lit("")) == "", "missing_language").when(F.col("language") != "en", "wrong_language"), F.when(F.col("repeated"), "duplicate_document")))
    return items.withColumn("repeated", repeated).select("document_id", F.explode(checks).alias("error")).union(orphan)


def item_errors(items: DataFrame, language: str = "", mode: str = "product_only") -> DataFrame:
    """(pos, error) of items (pos, legacy_product_id, document_id, language, object_type, product_id, variant_id,
    permanent_id). An item's own rules, variants whose id an earlier sound variant has, and variants without a sound
    parent; in product_only mode a variant is one error beside those of all items."""
    missing = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    only = (mode.strip().lower() or "product_only") == "product_only"
    product, variant = F.col("object_type") == "Product", F.col("object_type") == "Variant"
    unlike = lambda c: ~F.col("permanent_id").eqNullSafe(F.col(c))
    checks = [
        F.when(~missing("legacy_product_id"), "legacy_product_id"), F.when(missing("document_id"), "missing_document_id"),
        F.when(missing("language"), "missing_language").when((F.lit(language) != "") & (F.lower("language") != language.lower()), "wrong_language"),
        F.when(product, F.when(missing("product_id"), "missing_product_id").when(unlike("product_id"), "permanent_id_not_product_id")),
    ]
    if only:
        return items.select("pos", F.explode(F.array_compact(F.array(*checks, F.when(variant, "variant_in_product_only")))).alias("error"))
    checks += [F.when(variant & missing("product_id"), "missing_product_id"), F.when(variant, F.when(missing("variant_id"), "missing_variant_id").when(unlike("variant_id"), "permanent_id_not_variant_id"))]
    own = items.select("pos", F.explode(F.array_compact(F.array(*checks))).alias("error"))
    sound = items.filter(variant & ~missing("variant_id") & ~unlike("variant_id")).select("pos", "variant_id")
    first = sound.groupBy("variant_id").agg(F.min("pos").alias("first"))
    again = sound.join(first, "variant_id").filter("pos > first").select("pos", F.lit("duplicate_variant_id").alias("error"))
    parents = items.filter(product & ~missing("product_id") & ~unlike("product_id")).select("product_id").distinct()
    orphans = items.filter(variant & ~missing("product_id")).join(parents, "product_id", "left_anti").select("pos", F.lit("missing_parent").alias("error"))
    return own.union(again).union(orphans)


def conflicts(operations_: DataFrame) -> DataFrame:
    """Documents both added and deleted."""
    adds, deletes = (operations_.filter(F.col("op") == op).select("document_id").distinct() for op in ("addOrUpdate", "delete"))
    return adds.join(deletes, "document_id", "left_semi")
