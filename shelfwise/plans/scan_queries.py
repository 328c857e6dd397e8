"""Queries of scans, metric fields, rules and reports in files, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import attributes, catalog, fields, purchases, report, targets
from shelfwise.plans import config_queries as config
from shelfwise.plans import queries as base
from shelfwise.plans.queries import SINCE, query
from shelfwise.plans.sql import CATALOG, DOCUMENTS, ORACLE_SQL, PURCHASES, _with
from shelfwise.sources import catalog as source
from shelfwise.sources.catalog import table
from shelfwise.streaming import purchases as streams

SQL: dict[str, str] = {}


@query
def purchase_extraction(spark: SparkSession, d: str) -> DataFrame:
    """One tracking id's purchases of the last 30 days."""
    events = table(spark, d, "events")
    now = events.agg(F.max("ts")).first()[0]
    rows = events.select(F.concat(F.lit("tr"), F.col("user_id") % 3).alias("tracking_id"), "event_type", "ts", F.concat(F.lit("P"), F.get_json_object("props", "$.k")).alias("product_id"), F.col("value").cast("string").alias("quantity"))
    return purchases.totals(purchases.extracted(rows, "tr1", 30, F.lit(now).cast(events.schema["ts"].dataType)))


SQL["purchase_extraction"] = """SELECT 'P' || json_extract_string(props, '$.k') AS product_id, sum(floor(value + 0.5))::BIGINT AS units_sold FROM events WHERE event_type = 'purchase' AND user_id % 3 = 1
    AND ts >= (SELECT max(ts) FROM events) - to_days(30) AND value > 0 GROUP BY 1"""


@query
def metric_fields(spark: SparkSession, d: str) -> DataFrame:
    """A field for each of three windows; some Products have document counts of one of them."""
    key = F.substring("document_id", 16, 20).cast("long")
    docs = base.documents_product_only(spark, d).select("document_id", key.alias("key"))
    kinds = docs.select("document_id", F.when(F.col("key") % 2 == 0, "Product").otherwise("Variant").alias("object_type"), F.array(F.concat(F.lit("P"), "key"), F.concat(F.lit("P"), F.col("key") + 1)).alias("aliases"))
    windows = purchases.windows(source.purchases(spark, d))
    counts = windows.select("product_id", F.explode(F.create_map(*(x for f in (30, 90, 365) for x in (F.lit(f"sold_{f}"), F.col(f"units_{f}d"))))).alias("field", "units_sold"))
    counted = docs.filter("key % 3 = 0").select(F.lit("sold_90").alias("field"), "document_id", (F.col("key") + 1000).alias("units_sold"))
    return purchases.metric_fields(kinds, counts, counted, ["sold_30", "sold_90", "sold_365"])


SQL["metric_fields"] = _with(CATALOG + DOCUMENTS + PURCHASES, """, w AS (SELECT product_id, unnest([30, 90, 365]) AS days FROM (SELECT DISTINCT product_id FROM q WHERE state = 'processed')),
    u AS (SELECT w.product_id, w.days, coalesce(sum(quantity::BIGINT) FILTER (WHERE ts >= (SELECT max(ts) FROM b) - to_days(w.days)), 0)::BIGINT AS units FROM w JOIN q ON q.product_id = w.product_id AND state = 'processed' GROUP BY ALL),
    k AS (SELECT document_id, substr(document_id, 16)::BIGINT AS key FROM d)
    SELECT document_id, coalesce(sum(units) FILTER (WHERE days = 30), 0)::BIGINT AS sold_30, CASE WHEN key % 2 = 0 AND key % 3 = 0 THEN key + 1000 ELSE coalesce(sum(units) FILTER (WHERE days = 90), 0)::BIGINT END AS sold_90, coalesce(sum(units) FILTER (WHERE days = 365), 0)::BIGINT AS sold_365
    FROM k LEFT JOIN u ON u.product_id IN ('P' || key, 'P' || (key + 1)) GROUP BY document_id, key""".lstrip())


@query
def streamed_units_rolled(spark: SparkSession, d: str) -> DataFrame:
    """G1: the stream's daily buckets rolled to seven days."""
    return streams.rolled(streams.streamed_units(spark, d), 7)


SQL["streamed_units_rolled"] = """WITH b AS (SELECT ts::DATE AS day, 'P' || json_extract_string(props, '$.k') AS product_id, sum(floor(value + 0.5))::BIGINT AS units FROM events WHERE event_type = 'purchase' GROUP BY ALL)
    SELECT strftime(x.day, '%Y-%m-%d') AS day, x.product_id, sum(y.units)::BIGINT AS units FROM b x JOIN b y ON y.product_id = x.product_id AND y.day BETWEEN x.day - 6 AND x.day GROUP BY ALL"""


def _rules(spark: SparkSession, d: str) -> DataFrame:
    """A mapping per supplier, many of them faulty."""
    k = F.col("s_suppkey")
    text = lambda p: F.concat(F.lit(p), k)
    return table(spark, d, "supplier").select(
        k.alias("place"), text("map-").alias("mapping_id"), F.when(k % 13 == 0, " ").otherwise(F.concat(F.lit("site"), k % 2)).alias("site_id"), F.concat(F.lit("p"), k % 3).alias("profile_id"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(text("a")).alias("source_attribute"), config._case(k, 5, "x_Shared", "X_SHARED ", "x_a", "EC_Brand", "x_b").alias("target_field"),
        config._case(k, 7, "Both", "Product", "Variant", "both", "Both", "Both", None).alias("applies_to"), F.when(k % 17 == 0, "category").otherwise("masterProduct").alias("source_object"),
        F.when(k % 19 == 0, "").otherwise("custom").alias("source_scope"), F.when(k % 23 == 0, "RAW").otherwise("raw").alias("value_mode"), (k % 4).alias("sort_order"), (-k).alias("created_pos"),
    )


_RULES_SQL = """r AS (SELECT s_suppkey AS k, 'map-' || s_suppkey AS mapping_id, CASE WHEN s_suppkey % 13 = 0 THEN ' ' ELSE 'site' || s_suppkey % 2 END AS site, 'p' || s_suppkey % 3 AS profile, ['x_Shared', 'X_SHARED ', 'x_a', 'EC_Brand', 'x_b'][s_suppkey % 5 + 1] AS target FROM supplier),
own AS (SELECT *, CASE WHEN k % 13 = 0 AND k % 11 = 0 THEN 'missing site_id, source_attribute' WHEN k % 13 = 0 THEN 'missing site_id' WHEN k % 11 = 0 THEN 'missing source_attribute' WHEN k % 7 IN (3, 6) THEN 'unsupported applies_to' WHEN k % 17 = 0 THEN 'unsupported source_object'
    WHEN k % 19 = 0 THEN 'unsupported source_scope' WHEN k % 23 = 0 THEN 'unsupported value_mode' WHEN k % 5 = 3 THEN 'reserved target_field' END AS own, lower(trim(target)) AS t FROM r),
"""


@query
def mapping_rule_errors(spark: SparkSession, d: str) -> DataFrame:
    """The first rule that each mapping breaks, with all domains."""
    return attributes.first_rule_broken(_rules(spark, d))


SQL["mapping_rule_errors"] = _with(_RULES_SQL, """SELECT * FROM (SELECT k AS place, mapping_id, coalesce(own, CASE WHEN EXISTS (SELECT 1 FROM own y WHERE y.site = x.site AND y.profile = x.profile AND y.t = x.t AND y.k < x.k AND y.own IS NULL) THEN 'duplicate target_field' END) AS error FROM own x) WHERE error IS NOT NULL""")


@query
def mappings_in_order(spark: SparkSession, d: str) -> DataFrame:
    """The first 20 mappings of one site and profile in their order; the limit is the caller's."""
    rows = report.scanned(fields.mapping_rows(_rules(spark, d), "site1", "p1"), "place", 20)
    return rows.select("mapping_id", "target_field", F.col("place.sort_order").alias("sort_order"), F.col("place.created_pos").alias("created_pos"))


SQL["mappings_in_order"] = _with(_RULES_SQL, "SELECT mapping_id, target AS target_field, k % 4 AS sort_order, -k AS created_pos FROM r WHERE site = 'site1' AND profile = 'p1' ORDER BY k % 4, -k LIMIT 20")


@query
def mapping_imports_from_files(spark: SparkSession, d: str) -> DataFrame:
    """The configurations as JSON files, read back and imported."""
    at = config._folder(spark)
    config._imports(spark, d).select(F.to_json(F.struct("profile", "mappings")).alias("value"), F.col("profile.profile_id").alias("p")).repartition("p").write.partitionBy("p").text(at)
    return attributes.imported(attributes.read_imports(spark, at)).select("profile_id", "mapping_id", "site_id", "enabled", "target_field", "error")


SQL["mapping_imports_from_files"] = config.SQL["mapping_imports"]


@query
def mapping_replaced(spark: SparkSession, d: str) -> DataFrame:
    """An import that replaces: mappings that it doesn't have go."""
    rows = base._mappings(spark, d)
    return attributes.upserted(rows.filter("enabled"), rows.filter("mapping_id not like '%1'"), replace=True)


SQL["mapping_replaced"] = ORACLE_SQL["mapping_upsert"].replace("WHERE enabled OR right(mapping_id, 1) <> '1'", "WHERE enabled")


@query
def targets_by_creation(spark: SparkSession, d: str) -> DataFrame:
    """A site's targets in the order of their creation."""
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").select(F.concat(F.lit("T"), k).alias("target_id"), F.concat(F.lit("site"), k % 3).alias("site_id"), (k * 7919 % 97).alias("created"))
    return targets.of_site(rows, "site2").select("target_id", "created", "place")


SQL["targets_by_creation"] = "SELECT 'T' || c_custkey AS target_id, c_custkey * 7919 % 97 AS created, row_number() OVER (ORDER BY c_custkey * 7919 % 97, 'T' || c_custkey) AS place FROM customer WHERE c_custkey % 3 = 2"


@query
def roots_by_run(spark: SparkSession, d: str) -> DataFrame:
    """What four runs look at: full and delta, over everything and over the catalog of one brand."""
    items = source.products(spark, d).withColumn("catalog_id", F.col("brand"))
    masters, catalogs, bought = source.masters(items), items.select("catalog_id").distinct(), base._touched(spark, d)
    brand = catalogs.agg(F.min("catalog_id")).first()[0] or ""
    runs = {
        "full": catalog.scan(items, masters, False), "full in catalog": catalog.scan(items, masters, False, catalogs=catalogs, catalog_id=brand),
        "delta": catalog.scan(items, masters, True, SINCE, purchased=bought), "delta in catalog": catalog.scan(items, masters, True, SINCE, catalogs, brand),
    }
    parts = [rows.select(F.lit(name).alias("run"), "root_id") for name, rows in runs.items()]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


_CHANGED = "(e.modified >= TIMESTAMP '2001-10-20' OR e.created >= TIMESTAMP '2001-10-20' OR m.modified >= TIMESTAMP '2001-10-20')"
SQL["roots_by_run"] = _with(CATALOG, f"""SELECT DISTINCT 'full' AS run, root_id FROM e UNION ALL SELECT DISTINCT 'full in catalog', root_id FROM e WHERE brand = (SELECT min(p_brand) FROM part)
    UNION ALL (SELECT 'delta', e.root_id FROM e LEFT JOIN m ON m.id = e.master_id WHERE {_CHANGED} UNION SELECT 'delta', root_id FROM e WHERE key % 19 = 0)
    UNION ALL SELECT DISTINCT 'delta in catalog', e.root_id FROM e LEFT JOIN m ON m.id = e.master_id WHERE {_CHANGED} AND brand = (SELECT min(p_brand) FROM part)""")


@query
def report_files(spark: SparkSession, d: str) -> DataFrame:
    """The attribute report as CSV and as JSON, with quotes, commas and line breaks in a name, written and read back."""
    at = config._folder(spark)
    rows = config.attribute_report(spark, d).withColumn("display_name", F.concat("display_name", F.lit(' "a", b\nc;')))
    report.write_csv(rows, f"{at}/csv")
    report.write_json(rows, f"{at}/json")
    schema = rows.schema
    csv = spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(f"{at}/csv")
    names = ["attribute", "display_name", "n_products", "raw_samples", "display_samples", "place"]
    both = csv.select(F.lit("csv").alias("file"), *names).union(spark.read.schema(schema).json(f"{at}/json").select(F.lit("json"), *names))
    return both.withColumn("raw_samples", F.coalesce("raw_samples", F.lit(""))).withColumn("display_samples", F.coalesce("display_samples", F.lit("")))


SQL["report_files"] = f"""SELECT file, attribute, display_name || ' "a", b' || chr(10) || 'c;' AS display_name, n_products, raw_samples, display_samples, place FROM ({config.SQL['attribute_report']}), (VALUES ('csv'), ('json')) v(file)"""

#: W6, by recursion over the pages of each site in order.
SQL["listing_dedupe"] = r"""WITH RECURSIVE p AS (SELECT lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS site, page_id AS pos, md5(coalesce('=' || url, '')) AS u, html, trim(regexp_extract(html, '(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>', 1)) AS title FROM pages),
r AS (SELECT site, pos, u, md5(coalesce('=' || CASE WHEN title <> '' THEN title ELSE html END, '')) AS n, row_number() OVER (PARTITION BY site ORDER BY pos) AS i FROM p),
s AS (SELECT site, i, pos, true AS accepted, [u] AS us, [n] AS ns FROM r WHERE i = 1
    UNION ALL SELECT r.site, r.i, r.pos, NOT (list_contains(us, u) OR list_contains(ns, n)), CASE WHEN list_contains(us, u) OR list_contains(ns, n) THEN us ELSE list_append(us, u) END, CASE WHEN list_contains(us, u) OR list_contains(ns, n) THEN ns ELSE list_append(ns, n) END
    FROM s JOIN r ON r.site IS NOT DISTINCT FROM s.site AND r.i = s.i + 1)
SELECT site, pos, accepted FROM s"""
