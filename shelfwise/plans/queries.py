"""The catalog queries by name: (spark, sf_dir) to DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.scalars import html_document, rating, slug
from shelfwise.operators import attributes, catalog, incremental, listing, purchases, reconcile
from shelfwise.sources import catalog as source
from shelfwise.streaming import purchases as streams

SINCE = "2001-10-20"
LOCALES = [("en_CA", "https://shop.example/en"), ("fr_CA", "https://shop.example/fr")]
EXCLUDED = ["ASIA"]
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _eligible(spark: SparkSession, d: str) -> DataFrame:
    items = source.products(spark, d)
    return catalog.with_eligibility(items, source.masters(items))


def _descriptors(spark: SparkSession, d: str) -> DataFrame:
    items = source.products(spark, d)
    masters = source.masters(items)
    return catalog.descriptors(catalog.with_eligibility(items, masters), masters)


def _touched(spark: SparkSession, d: str) -> DataFrame:
    return source.products(spark, d).filter("key % 19 = 0").select(catalog.root_id().alias("root_id")).distinct()


def _reasons(spark: SparkSession, d: str) -> DataFrame:
    current = _descriptors(spark, d)
    return reconcile.dirty_reasons(current, reconcile.previous_manifest(current), _touched(spark, d))


@query
def roots_full(spark: SparkSession, d: str) -> DataFrame:
    return catalog.roots(source.products(spark, d))


@query
def roots_catalog_scope(spark: SparkSession, d: str) -> DataFrame:
    items = source.products(spark, d)
    scope = items.agg(F.min("brand").alias("brand"))
    return catalog.roots(items.join(F.broadcast(scope), "brand"))


@query
def roots_modified_since(spark: SparkSession, d: str) -> DataFrame:
    items = source.products(spark, d)
    return catalog.modified_roots(items, source.masters(items), SINCE)


@query
def roots_merged(spark: SparkSession, d: str) -> DataFrame:
    changed = source.products(spark, d).filter(F.col("modified") >= F.lit(SINCE).cast("timestamp_ntz")).select(catalog.root_id().alias("root_id"))
    return catalog.merged_roots(changed, _touched(spark, d))


@query
def eligible_variants(spark: SparkSession, d: str) -> DataFrame:
    return _eligible(spark, d).filter("is_variant and eligible").select("id", "master_id")


@query
def eligible_roots(spark: SparkSession, d: str) -> DataFrame:
    return _eligible(spark, d).filter("eligible").groupBy(catalog.root_id().alias("root_id")).agg(F.count(F.lit(1)).alias("n_eligible"))


@query
def category_paths(spark: SparkSession, d: str) -> DataFrame:
    return catalog.category_paths(spark, source.categories(spark, d)).select("category_id", F.array_join("path", "|").alias("path"))


@query
def product_categories(spark: SparkSession, d: str) -> DataFrame:
    return catalog.product_categories(source.assignments(spark, d), catalog.category_paths(spark, source.categories(spark, d)))


@query
def export_prices(spark: SparkSession, d: str) -> DataFrame:
    return catalog.prices(source.products(spark, d))


@query
def documents_product_only(spark: SparkSession, d: str) -> DataFrame:
    return catalog.documents_product_only(_eligible(spark, d))


@query
def documents_product_variant(spark: SparkSession, d: str) -> DataFrame:
    return catalog.documents_product_variant(_eligible(spark, d))


@query
def root_descriptors(spark: SparkSession, d: str) -> DataFrame:
    return _descriptors(spark, d).withColumn("document_ids", F.array_join("document_ids", ","))


@query
def payload_checksums(spark: SparkSession, d: str) -> DataFrame:
    return catalog.payload_checksums(documents_product_only(spark, d))


@query
def dirty_reasons(spark: SparkSession, d: str) -> DataFrame:
    return _reasons(spark, d).select("root_id", "reason")


@query
def reconcile_stats(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.statistics(_reasons(spark, d))


@query
def delete_candidates(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.delete_candidates(_reasons(spark, d))


@query
def delta_operations(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.operations(_reasons(spark, d))


@query
def operation_conflicts(spark: SparkSession, d: str) -> DataFrame:
    docs = documents_product_only(spark, d)
    adds, deletes = docs.filter("size % 2 = 0"), docs.filter("size % 4 = 0 or size % 4 = 1")
    return reconcile.conflicts(adds.select(F.lit("addOrUpdate").alias("op"), "document_id").union(deletes.select(F.lit("delete"), "document_id")))


@query
def batches_fixed(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.fixed_batches(documents_product_only(spark, d).select("root_id", "document_id"), "root_id", "document_id", 5)


@query
def batches_greedy(spark: SparkSession, d: str) -> DataFrame:
    rows = documents_product_only(spark, d).select("root_id", "document_id", F.length("name").cast("long").alias("cost"))
    return reconcile.greedy_batches(rows, "root_id", "document_id", "cost", 40, 4)


@query
def validation_errors(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("key")
    pid = lambda c: F.concat(F.lit("product://pid="), c)
    items = source.products(spark, d).select(
        F.when(k % 23 == 0, "").otherwise(pid("id")).alias("document_id"), F.when(k % 29 == 0, "").when(k % 31 == 0, "fr").otherwise("en").alias("language"),
        F.when(k % 37 == 0, "Variant").otherwise("Product").alias("object_type"), pid(F.when(k % 2 == 0, F.col("id")).otherwise("none")).alias("parent_id"),
    )
    return reconcile.validation_errors(items)


@query
def purchase_totals(spark: SparkSession, d: str) -> DataFrame:
    return purchases.totals(source.purchases(spark, d))


@query
def purchase_counters(spark: SparkSession, d: str) -> DataFrame:
    return purchases.counters(source.purchases(spark, d))


@query
def units_sold_windows(spark: SparkSession, d: str) -> DataFrame:
    return purchases.windows(source.purchases(spark, d))


def _state(spark: SparkSession, d: str) -> DataFrame:
    return purchases.mapped(purchase_totals(spark, d), purchases.aliases(documents_product_only(spark, d)))


def _applied(spark: SparkSession, state: DataFrame) -> DataFrame:
    """The state as last exported: some rows missing, some with other counts, one since gone."""
    old = state.filter("product_id not like '%3'").withColumn("units_sold", F.when(F.length("product_id") % 2 == 0, F.col("units_sold") + 1).otherwise(F.col("units_sold")))
    return old.union(state.sparkSession.sql("SELECT 'GONE', 'R-GONE', 'D-GONE', 1L"))


@query
def purchase_mapping(spark: SparkSession, d: str) -> DataFrame:
    return _state(spark, d)


@query
def purchase_skipped(spark: SparkSession, d: str) -> DataFrame:
    return purchases.skipped(purchase_totals(spark, d), purchases.aliases(documents_product_only(spark, d)))


@query
def document_metrics(spark: SparkSession, d: str) -> DataFrame:
    return purchases.document_metrics(documents_product_only(spark, d), _state(spark, d))


@query
def changed_roots(spark: SparkSession, d: str) -> DataFrame:
    state = _state(spark, d)
    return purchases.changed_roots(state, _applied(spark, state))


@query
def applied_after_delta(spark: SparkSession, d: str) -> DataFrame:
    state = _state(spark, d)
    applied = _applied(spark, state)
    return purchases.advanced(state, applied, purchases.changed_roots(state, applied).filter("length(root_id) % 2 = 0"))


@query
def best_sellers(spark: SparkSession, d: str) -> DataFrame:
    return purchases.best_sellers(purchase_totals(spark, d), 25)


@query
def best_per_root(spark: SparkSession, d: str) -> DataFrame:
    return purchases.per_root_best(_state(spark, d))


@query
def attribute_audit(spark: SparkSession, d: str) -> DataFrame:
    docs = source.table(spark, d, "documents").select("doc_id", "lang", "source").join(source.table(spark, d, "labels"), "doc_id", "left").withColumn("kind", F.col("lang"))
    return attributes.audit(attributes.unpivoted(docs, "doc_id", "kind", ["lang", "source", "quality", "toxic"]), ["en", "de", "fr", "es"])


@query
def category_audit(spark: SparkSession, d: str) -> DataFrame:
    return attributes.audit_categories(source.assignments(spark, d), source.categories(spark, d))


@query
def listing_entries(spark: SparkSession, d: str) -> DataFrame:
    return listing.entries(spark, source.categories(spark, d), EXCLUDED).drop("names")


@query
def listing_pages(spark: SparkSession, d: str) -> DataFrame:
    return listing.pages(listing.entries(spark, source.categories(spark, d), EXCLUDED), LOCALES)


@query
def listing_plan(spark: SparkSession, d: str) -> DataFrame:
    desired = listing_pages(spark, d)
    even = desired.filter("length(key_path) % 2 = 0")
    name = F.when(F.col("category_id").like("N%"), F.col("filter_value")).otherwise(F.concat(F.lit("other "), "key_path"))
    patterns = F.when(F.col("category_id").like("R%"), F.col("patterns")).otherwise(F.concat(F.lit("/none/"), "key_path"))
    return listing.plan(desired, even.select(F.concat(F.lit("page-"), "key_path").alias("page_id"), name.alias("name"), patterns.alias("patterns")))


@query
def listing_dedupe(spark: SparkSession, d: str) -> DataFrame:
    host = F.lower(F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = source.table(spark, d, "pages").select(host.alias("site"), F.col("page_id").alias("pos"), F.col("url"), listing.page_name(F.col("html")).alias("name"))
    return listing.first_wins(rows)


@query
def slugs(spark: SparkSession, d: str) -> DataFrame:
    return source.table(spark, d, "documents").select("doc_id", slug(F.col("text")).alias("slug"))


@query
def html_documents(spark: SparkSession, d: str) -> DataFrame:
    pages = source.table(spark, d, "pages").select(F.col("page_id").alias("id"), html_document(F.col("html")).alias("html"))
    return pages.union(source.table(spark, d, "documents").select(F.lit(-1) - F.col("doc_id"), html_document(F.col("text"))))


@query
def ratings(spark: SparkSession, d: str) -> DataFrame:
    return source.products(spark, d).select("id", rating(F.col("id")).alias("rating"))


def _mappings(spark: SparkSession, d: str) -> DataFrame:
    """One mapping per nation, some of them faulty."""
    n = F.col("n_nationkey")
    mode = F.when(n % 4 == 0, "raw").when(n % 4 == 1, "displayValue").when(n % 4 == 2, "displayValueArray").otherwise("odd")
    target = F.when(n % 11 == 0, "EC_Name").when(n % 5 == 0, "x_shared").otherwise(F.concat(F.lit("x_"), n))
    return source.table(spark, d, "nation").select(F.concat(F.lit("map-"), n).alias("mapping_id"), (n % 6 != 0).alias("enabled"), F.when(n % 7 == 0, "").otherwise("color").alias("source_attribute"), target.alias("target_field"), mode.alias("value_mode"))


@query
def mapping_errors(spark: SparkSession, d: str) -> DataFrame:
    return attributes.mapping_errors(_mappings(spark, d))


@query
def mapping_upsert(spark: SparkSession, d: str) -> DataFrame:
    rows = _mappings(spark, d)
    return attributes.upserted(rows.filter("enabled"), rows.filter("mapping_id not like '%1'"))


@query
def source_ownership(spark: SparkSession, d: str) -> DataFrame:
    rows = source.table(spark, d, "supplier").select(F.col("s_nationkey").alias("organization"), (F.col("s_suppkey") % 10).alias("source"), "s_suppkey")
    return rows.groupBy("organization", "source").agg(F.countDistinct("s_suppkey").alias("n_targets")).filter("n_targets > 1")


@query
def streamed_units_sold(spark: SparkSession, d: str) -> DataFrame:
    return streams.streamed_units(spark, d)


@query
def delta_microbatch(spark: SparkSession, d: str) -> DataFrame:
    """Changes arrive as a stream of three files, each a batch against the manifest in storage; then the second comes again. What the batches
    leave to do is what one run over everything gives."""
    at = f"{source.shared_folder(spark)}/delta-{uuid.uuid4().hex}"
    current = _descriptors(spark, d)
    current.write.parquet(f"{at}/current")
    current = spark.read.parquet(f"{at}/current")
    previous = reconcile.previous_manifest(current)
    incremental.load(spark, f"{at}/state", previous.withColumn("modified_at", F.lit("")).withColumn("payload_checksum", F.lit(None).cast("string")))
    gone = previous.join(current.select("root_id"), "root_id", "left_anti").select("root_id")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in current.schema.fields[1:]]
    changes = current.withColumn("removed", F.lit(False)).union(gone.select("root_id", *nothing, F.lit(True)))
    part = F.pmod(F.crc32("root_id"), F.lit(3))
    batches = [changes.filter(part == k) for k in range(3)]
    for k, rows in enumerate(batches):
        rows.coalesce(1).write.parquet(f"{at}/changes/{k}")
    touched, payloads = _touched(spark, d), documents_product_only(spark, d)
    checksums = lambda dirty: catalog.payload_checksums(payloads.join(dirty, "root_id", "left_semi"))
    stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(f"{at}/changes/*")
    incremental.applied_stream(stream, f"{at}/state", touched, checksums, f"{at}/progress")
    if incremental.apply(spark, f"{at}/state", batches[1], 1, touched, checksums):
        raise ValueError("a batch was applied twice")
    return incremental.net_operations(incremental.operations(spark, f"{at}/state"))
