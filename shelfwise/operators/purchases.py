"""Purchase enrichment: totals, alias mapping, metrics and state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.scalars import alias_suffix, quantity


def counted(rows: DataFrame) -> DataFrame:
    """The product is tested before the quantity; wholly blank rows count nowhere."""
    blank_id, blank_n = F.trim("product_id") == "", F.trim("quantity") == ""
    units = quantity(F.col("quantity"))
    state = F.when(blank_id & blank_n, "skipped").when(blank_id, "blank").when(units.isNull(), "invalid").otherwise("processed")
    return rows.withColumn("units", units).withColumn("state", state)


def extracted(events: DataFrame, tracking_id: str, days: int, now: Column, event_type: str = "purchase") -> DataFrame:
    """Events (tracking_id, event_type, ts, others) of one tracking id and type in the `days` up to `now`, both ends included; the filters reach the scan."""
    since = now - F.make_dt_interval(F.lit(days))
    return events.filter((F.col("tracking_id") == tracking_id) & (F.col("event_type") == event_type) & F.col("ts").between(since, now))


def totals(rows: DataFrame) -> DataFrame:
    """A1."""
    return counted(rows).filter("state = 'processed'").groupBy("product_id").agg(F.sum("units").alias("units_sold"))


def counters(rows: DataFrame) -> DataFrame:
    return counted(rows).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def windows(rows: DataFrame, days: tuple[int, ...] = (30, 90, 365)) -> DataFrame:
    """Rolling windows that end with the last purchase, all in one pass."""
    now = rows.agg(F.max("ts").alias("now"))
    dated = counted(rows).filter("state = 'processed'").join(F.broadcast(now))  # one row
    sums = [F.coalesce(F.sum(F.when(F.col("ts") >= F.col("now") - F.expr(f"INTERVAL {d} DAYS"), F.col("units"))), F.lit(0)).alias(f"units_{d}d") for d in days]
    return dated.groupBy("product_id").agg(*sums)


def aliases(documents: DataFrame, variants: DataFrame | None = None) -> DataFrame:
    """Product id, sku, what follows the product id's last hyphen, and the ids of its variants (product_id,
    variant_id, permanent_id) lead to the document. A product id that is not given is the document id's; sku may be absent."""
    product = F.col("product_id") if "product_id" in documents.columns else F.regexp_replace("document_id", "^product://pid=", "")
    sku = F.col("sku") if "sku" in documents.columns else F.lit(None).cast("string")
    rows = documents.select(product.alias("product_id"), sku.alias("sku"), "root_id", "document_id").filter("product_id <> '' and document_id <> ''")
    names = rows.select(F.explode(F.array("product_id", "sku", alias_suffix(F.col("product_id")))).alias("alias"), "root_id", "document_id")
    if variants is not None:
        known = variants.filter("product_id <> '' and variant_id <> ''").select("product_id", F.explode(F.array("variant_id", "permanent_id")).alias("alias"))
        names = names.union(known.join(rows, "product_id").select("alias", "root_id", "document_id"))
    return names.select(F.trim("alias").alias("product_id"), "root_id", "document_id").filter("product_id <> ''").distinct()


def mapped(counts: DataFrame, alias: DataFrame) -> DataFrame:
    """A purchased id's units go to its document, once; an id that leads to two documents is an error."""
    found = counts.join(alias, "product_id").groupBy("product_id", "units_sold").agg(F.min(F.struct("document_id", "root_id")).alias("d"), F.max("document_id").alias("last"))
    error = F.raise_error(F.concat(F.lit("multiple documents for alias "), F.col("product_id")))
    document = F.when(F.col("d.document_id") == F.col("last"), F.col("last")).otherwise(error.cast("string"))
    return found.select("product_id", F.col("d.root_id").alias("root_id"), document.alias("document_id"), "units_sold")


def skipped(counts: DataFrame, alias: DataFrame) -> DataFrame:
    return counts.join(alias, "product_id", "left_anti").select("product_id", "units_sold", F.lit("missing-product-mapping").alias("reason"))


def document_metrics(documents: DataFrame, state: DataFrame) -> DataFrame:
    """A document's total, 0 without purchases."""
    sums = state.groupBy("document_id").agg(F.sum("units_sold").alias("units_sold"))
    return documents.select("document_id").join(sums, "document_id", "left").select("document_id", F.coalesce("units_sold", F.lit(0)).alias("units_sold"))


def metric_fields(documents: DataFrame, alias_counts: DataFrame, document_counts: DataFrame, fields: list[str]) -> DataFrame:
    """A column for each field, that is for each window's snapshot, of documents (document_id, object_type, aliases). A Product has
    what its document was counted with (document_counts: field, document_id, units_sold); where that doesn't name it, and for all others, the
    counts of the aliases are added up (alias_counts: field, product_id, units_sold). One pass over each, whatever the number of fields."""
    wide = lambda prefix: [F.sum(F.when(F.col("field") == f, F.col("units_sold"))).alias(f"{prefix}{f}") for f in fields]
    one = documents.select("document_id", F.explode("aliases").alias("product_id")).distinct()
    by_alias = one.join(alias_counts, "product_id").groupBy("document_id").agg(*wide("a_"))
    by_document = document_counts.groupBy("document_id").agg(*wide("d_"))
    rows = documents.select("document_id", "object_type").join(by_alias, "document_id", "left").join(by_document, "document_id", "left")
    value = lambda f: F.coalesce(F.when(F.col("object_type") == "Product", F.col(f"d_{f}")), F.col(f"a_{f}"), F.lit(0)).alias(f)
    return rows.select("document_id", *(value(f) for f in fields))


def changed_roots(current: DataFrame, applied: DataFrame) -> DataFrame:
    """Roots of rows that are new, changed or gone; a moved row reports its current root."""
    c, a = current.alias("c"), applied.alias("a")
    joined = c.join(a, "product_id", "full_outer")
    differs = ~(F.struct("c.root_id", "c.document_id", "c.units_sold").eqNullSafe(F.struct("a.root_id", "a.document_id", "a.units_sold")))
    return joined.filter(differs).select(F.coalesce("c.root_id", "a.root_id").alias("root_id")).distinct()


def advanced(current: DataFrame, applied: DataFrame, exported: DataFrame) -> DataFrame:
    """Rows of exported roots as they are now, the other applied rows as they were."""
    taken = current.join(exported, "root_id", "left_semi").select("product_id", "root_id", "document_id", "units_sold")
    rest = applied.join(exported, "root_id", "left_anti").join(taken.select("product_id"), "product_id", "left_anti").select("product_id", "root_id", "document_id", "units_sold")
    return taken.unionByName(rest)


def best_sellers(counts: DataFrame, k: int) -> DataFrame:
    """Top k by units, ties by id."""
    return counts.orderBy(F.desc("units_sold"), "product_id").limit(k)


def per_root_best(state: DataFrame) -> DataFrame:
    """W1 over metrics: each root's best product."""
    w = Window.partitionBy("root_id").orderBy(F.desc("units_sold"), "product_id")
    return state.withColumn("n", F.row_number().over(w)).filter("n = 1").select("root_id", "product_id", "units_sold")
