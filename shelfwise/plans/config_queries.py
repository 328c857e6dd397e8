"""Queries of targets, fields, states, reports, payloads and batches, each with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import scalars as s
from shelfwise.operators import attributes, catalog, fields, listing, packing, products, purchases, reconcile, report, state, targets
from shelfwise.plans import queries as base
from shelfwise.plans.queries import query
from shelfwise.plans.sql import CATALOG, CATEGORIES, DESCRIPTORS, DOCUMENTS, ENTRIES, PURCHASES, STATE, _with
from shelfwise.sources import catalog as source
from shelfwise.sources.catalog import shared_folder, table

SQL: dict[str, str] = {}


def _case(key: Column, by: int, *values: object) -> Column:
    """The value at key % by."""
    return F.get(F.array(*(F.lit(v) for v in values)), (key % by).cast("int"))


def _targets(spark: SparkSession, d: str) -> DataFrame:
    """One export target per customer, some faulty."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    unless = lambda m, v: F.when(k % m == 0, "").otherwise(v)
    rows = table(spark, d, "customer").select(
        F.concat(F.lit("T"), k).alias("target_id"), unless(53, F.concat(F.lit("site"), k % 3)).alias("site_id"), _case(n, 4, "en_CA", "fr-CA", "de_DE", "en_US").alias("locale"),
        unless(5, _case(n, 4, "en", "FR", "de", "en")).alias("language"), F.when(k % 41 == 0, "bad-org").otherwise(F.concat(F.lit("org"), n)).alias("organization_id"),
        F.concat(F.lit("src"), F.when(k % 7 == 0, 7).otherwise(k)).alias("source_id"), unless(59, F.concat(F.lit("tr"), F.when(k % 3 == 0, k % 30).otherwise(k + 100))).alias("tracking_id"),
        unless(47, F.lit("https://shop.example")).alias("base_url"), F.lit("CA").alias("country"), F.lit("CAD").alias("currency"), (k % 37 != 0).alias("enabled"),
        _case(k, 4, "", "Product_Variant", " product_only ", "odd").alias("structure_mode"), _case(k, 5, "", "ALL", "legacy", "online_and_searchable", "x").alias("eligibility_mode"),
        _case(k, 6, "", "fr_CA, it_IT", "FR_ca;fr_CA", "en_GB", "it_IT\nit_CH", "12_AB").alias("alternate_locales"),
        F.when(k % 2 == 0, F.concat(F.lit("P"), n)).otherwise("").alias("mapping_profile_id"), F.lit("1").alias("schema_version"), F.lit("main").alias("catalog_id"),
    )
    return targets.normalized(rows)


_ALTERNATES = "list_filter(list_transform(regexp_split_to_array({c}, '[\\r\\n,;]+'), lambda x: trim(x)), lambda x: x <> '')"
TARGETS = r"""
t0 AS (SELECT 'T' || c_custkey AS target_id, CASE WHEN c_custkey % 53 = 0 THEN '' ELSE 'site' || c_custkey % 3 END AS site_id, ['en_CA', 'fr-CA', 'de_DE', 'en_US'][c_nationkey % 4 + 1] AS locale,
        CASE WHEN c_custkey % 5 = 0 THEN '' ELSE ['en', 'FR', 'de', 'en'][c_nationkey % 4 + 1] END AS lang0, CASE WHEN c_custkey % 41 = 0 THEN 'bad-org' ELSE 'org' || c_nationkey END AS organization_id,
        'src' || CASE WHEN c_custkey % 7 = 0 THEN 7 ELSE c_custkey END AS source_id, CASE WHEN c_custkey % 59 = 0 THEN '' ELSE 'tr' || CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 30 ELSE c_custkey + 100 END END AS tracking_id,
        CASE WHEN c_custkey % 47 = 0 THEN '' ELSE 'https://shop.example' END AS base_url, c_custkey % 37 <> 0 AS enabled, ['product_only', 'product_variant', 'product_only', 'odd'][c_custkey % 4 + 1] AS structure_mode,
        ['legacy', 'all', 'legacy', 'online_and_searchable', 'x'][c_custkey % 5 + 1] AS eligibility_mode, ['', 'fr_CA, it_IT', 'FR_ca;fr_CA', 'en_GB', 'it_IT' || chr(10) || 'it_CH', '12_AB'][c_custkey % 6 + 1] AS al,
        CASE WHEN c_custkey % 2 = 0 THEN 'P' || c_nationkey ELSE '' END AS mapping_profile_id FROM customer),
t AS (SELECT *, lower(CASE WHEN lang0 <> '' THEN lang0 ELSE regexp_split_to_array(locale, '[-_]')[1] END) AS language, """ + _ALTERNATES.format(c="al") + r""" AS parts FROM t0),
alt AS (SELECT target_id, locale, language, x AS alocale, lower(regexp_split_to_array(x, '[-_]')[1]) AS alang, pos FROM (SELECT target_id, locale, language, parts, unnest(parts) AS x, generate_subscripts(parts, 1) AS pos FROM t)
        WHERE list_position(list_transform(parts, lambda y: lower(y)), lower(x)) = pos),
"""


def _mapped_names(spark: SparkSession, d: str) -> DataFrame:
    """The mapped fields of each target: two, one of them sometimes an alternate language's."""
    k = F.col("c_custkey")
    names = F.array(F.lit("x_style"), F.when(k % 9 == 0, "EC_Name_fr").otherwise("x_other"))
    return table(spark, d, "customer").select(F.concat(F.lit("T"), k).alias("target_id"), F.explode(names).alias("field"))


@query
def target_errors(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("n_nationkey")
    profiles = table(spark, d, "nation").filter(n % 8 != 0).select(F.concat(F.lit("P"), n).alias("profile_id"), F.concat(F.lit("site"), n % 3).alias("site_id"), (n % 5 != 0).alias("enabled"))
    return targets.target_errors(_targets(spark, d), profiles, _mapped_names(spark, d))


SQL["target_errors"] = _with(TARGETS, """, sfx AS (SELECT target_id, alang, count(*) AS n FROM alt GROUP BY ALL), every AS (
    SELECT target_id, 'missing_site_id' AS error FROM t WHERE site_id = '' UNION ALL SELECT target_id, 'missing_tracking_id' FROM t WHERE tracking_id = '' UNION ALL SELECT target_id, 'missing_base_url' FROM t WHERE base_url = ''
    UNION ALL SELECT target_id, 'disabled' FROM t WHERE NOT enabled UNION ALL SELECT target_id, 'invalid_organization' FROM t WHERE organization_id = 'bad-org'
    UNION ALL SELECT target_id, 'unsupported_structure' FROM t WHERE structure_mode = 'odd' UNION ALL SELECT target_id, 'unsupported_eligibility' FROM t WHERE eligibility_mode = 'x'
    UNION ALL SELECT target_id, 'invalid_alternate_language' FROM alt WHERE NOT regexp_full_match(alang, '[a-z]{2,8}') UNION ALL SELECT target_id, 'alternate_is_primary_locale' FROM alt WHERE lower(alocale) = lower(locale)
    UNION ALL SELECT target_id, 'alternate_has_primary_language' FROM alt WHERE alang = language UNION ALL SELECT target_id, 'repeated_alternate_language' FROM sfx WHERE n > 1
    UNION ALL SELECT 'T' || c_custkey, 'mapped_field_is_alternate' FROM customer JOIN sfx ON target_id = 'T' || c_custkey AND alang = 'fr' WHERE c_custkey % 9 = 0
    UNION ALL SELECT target_id, 'source_of_several_targets' FROM (SELECT target_id, count(*) OVER (PARTITION BY organization_id, source_id) AS n FROM t) WHERE n > 1
    UNION ALL SELECT target_id, 'warning_shared_tracking_id' FROM (SELECT target_id, tracking_id, count(*) OVER (PARTITION BY tracking_id) AS n FROM t) WHERE n > 1 AND tracking_id <> ''
    UNION ALL SELECT target_id, CASE WHEN n_nationkey IS NULL THEN 'unknown_profile' WHEN n_nationkey % 5 = 0 THEN 'disabled_profile' ELSE 'profile_of_other_site' END FROM t LEFT JOIN nation ON mapping_profile_id = 'P' || n_nationkey AND n_nationkey % 8 <> 0
        WHERE mapping_profile_id <> '' AND (n_nationkey IS NULL OR n_nationkey % 5 = 0 OR site_id <> 'site' || n_nationkey % 3))
    SELECT DISTINCT target_id, error FROM every""".lstrip())


@query
def target_groups(spark: SparkSession, d: str) -> DataFrame:
    return targets.groups(_targets(spark, d))


SQL["target_groups"] = _with(TARGETS, "SELECT tracking_id, arg_min(target_id, (locale, target_id)) AS primary_id, string_agg(target_id, ',' ORDER BY locale, target_id) AS target_ids FROM t GROUP BY tracking_id")


@query
def related_targets(spark: SparkSession, d: str) -> DataFrame:
    return targets.related(_targets(spark, d), "T3", ["site2"])


SQL["related_targets"] = _with(TARGETS, "SELECT target_id, site_id, tracking_id FROM t WHERE tracking_id = (SELECT tracking_id FROM t WHERE target_id = 'T3') AND (site_id = 'site2' OR site_id = (SELECT site_id FROM t WHERE target_id = 'T3'))")


@query
def target_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return targets.fingerprint(_targets(spark, d))


_SETTINGS = "schema_version: '1', site_id: site_id, target_id: target_id, organization_id: organization_id, source_id: source_id, catalog_id: 'main', locale: locale, language: language, structure_mode: structure_mode, eligibility_mode: eligibility_mode, mapping_profile_id: mapping_profile_id"
SQL["target_fingerprints"] = _with(TARGETS, f", al AS (SELECT target_id, list(alocale ORDER BY pos) AS ls FROM alt GROUP BY target_id) SELECT target_id, CASE WHEN ls IS NULL THEN to_json({{{_SETTINGS}}}) ELSE to_json({{{_SETTINGS}, alternate_locales: ls}}) END::VARCHAR AS fingerprint FROM t LEFT JOIN al USING (target_id)".lstrip())


@query
def incompatible_manifests(spark: SparkSession, d: str) -> DataFrame:
    now = _targets(spark, d)
    before = now.withColumn("source_id", F.when(F.length("target_id") % 2 == 0, F.lit("moved")).otherwise(F.col("source_id")))
    return targets.incompatible(now, targets.fingerprint(before))


SQL["incompatible_manifests"] = _with(TARGETS, "SELECT target_id FROM t WHERE length(target_id) % 2 = 0")


@query
def alternate_index_fields(spark: SparkSession, d: str) -> DataFrame:
    return fields.alternate_fields(_targets(spark, d))


SQL["alternate_index_fields"] = _with(TARGETS, "SELECT target_id, 'ec_' || b || '_' || alang AS name, 'STRING' AS type FROM alt, (SELECT unnest(['name', 'description', 'shortdesc']) AS b)")


@query
def alternate_texts(spark: SparkSession, d: str) -> DataFrame:
    docs = base.documents_product_variant(spark, d)
    k = F.col("p_partkey")
    texts = source.products(spark, d).filter("key % 3 <> 0").select(
        catalog.root_id().alias("root_id"), _case(F.col("key"), 2, "fr", "de").alias("language"), F.concat(F.lit(" nom "), "name").alias("t_name"), F.when(F.col("key") % 4 == 0, "").otherwise("texte").alias("t_description"), F.lit(None).cast("string").alias("t_short")
    ).groupBy("root_id", "language").agg(F.min("t_name").alias("t_name"), F.min("t_description").alias("t_description"), F.min("t_short").alias("t_short"))
    return targets.alternate_texts(docs, texts)


VARIANT_DOCS = """
g AS (SELECT *, CASE WHEN is_variant THEN color ELSE id END AS gk FROM e WHERE eligible),
rr AS (SELECT *, first_value(id) OVER w AS lead, row_number() OVER w AS n FROM g WINDOW w AS (PARTITION BY master_id, gk ORDER BY key)),
vd AS (SELECT 'product://pid=' || lead AS document_id, 'Product' AS object_type, root_id FROM rr WHERE n = 1 UNION ALL SELECT 'product://pid=s' || id, 'Variant', root_id FROM rr WHERE is_variant),
"""
SQL["alternate_texts"] = _with(CATALOG + VARIANT_DOCS, """, x AS (SELECT root_id, CASE WHEN key % 2 = 0 THEN 'fr' ELSE 'de' END AS language, min('nom ' || name) AS nom, min(CASE WHEN key % 4 = 0 THEN '' ELSE 'texte' END) AS texte FROM e WHERE key % 3 <> 0 GROUP BY ALL)
    SELECT document_id, 'ec_name_' || language AS field, nom AS value FROM vd JOIN x USING (root_id) UNION ALL SELECT document_id, 'ec_description_' || language, texte FROM vd JOIN x USING (root_id) WHERE object_type = 'Product' AND texte <> ''""".lstrip())


def _field_mappings(spark: SparkSession, d: str) -> DataFrame:
    """One mapping per supplier with its index-field options, some faulty."""
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(
        F.concat(F.lit("m"), k).alias("mapping_id"), F.lit("main").alias("profile_id"), (k % 6 != 0).alias("enabled"), F.lit("product").alias("source_object"), F.lit("custom").alias("source_scope"), F.lit("style").alias("source_attribute"),
        F.when(k % 13 == 0, "Bad-Name").otherwise(F.concat(F.lit("x_"), k)).alias("target_field"), _case(k, 3, "raw", "displayValue", "displayValueArray").alias("value_mode"),
        _case(k, 5, "", "LONG", "STRING", "ODD", "DOUBLE").alias("option_type"), F.when(k % 4 == 0, "own text").alias("option_description"), F.when(k % 10 == 0, False).alias("sync"), F.when(k % 2 == 0, True).alias("facet"),
        F.when(k % 7 == 0, True).alias("multi_value_facet"), F.when(k % 14 == 0, ",").alias("tokenizers"), F.when(k % 11 == 0, True).alias("stemming"),
    )


@query
def index_fields(spark: SparkSession, d: str) -> DataFrame:
    return fields.index_fields(_field_mappings(spark, d))


INDEX_FIELDS = """
fm AS (SELECT s_suppkey AS k, 'm' || s_suppkey AS mapping_id, CASE WHEN s_suppkey % 13 = 0 THEN 'Bad-Name' ELSE 'x_' || s_suppkey END AS name, CASE WHEN s_suppkey % 5 IN (0, 2) THEN 'STRING' WHEN s_suppkey % 5 = 1 THEN 'LONG' WHEN s_suppkey % 5 = 3 THEN 'ODD' ELSE 'DOUBLE' END AS type,
        CASE WHEN s_suppkey % 7 = 0 OR s_suppkey % 3 = 2 THEN true END AS mvf FROM supplier WHERE s_suppkey % 6 <> 0 AND s_suppkey % 10 <> 0),
idx AS (SELECT mapping_id, name, CASE WHEN k % 4 = 0 THEN 'own text' ELSE 'Generated from mapping profile main: product.custom.style -> ' || name END AS description, type, CASE WHEN k % 2 = 0 AND mvf IS NULL THEN true END AS facet, mvf AS multi_value_facet,
        CASE WHEN mvf THEN CASE WHEN k % 14 = 0 THEN ',' ELSE ';' END END AS tokenizers, CASE WHEN k % 11 = 0 THEN true END AS stemming,
        CASE WHEN name = 'Bad-Name' THEN 'invalid_name' WHEN type = 'ODD' THEN 'unsupported_type' WHEN type <> 'STRING' AND mvf THEN 'multi_value_not_string' WHEN type <> 'STRING' AND k % 11 = 0 THEN 'stemming_not_string' END AS error FROM fm),
"""
SQL["index_fields"] = _with(INDEX_FIELDS, "SELECT * FROM idx")


@query
def missing_index_fields(spark: SparkSession, d: str) -> DataFrame:
    wanted = fields.index_fields(_field_mappings(spark, d)).filter("error is null").select("name", "type").union(fields.alternate_fields(_targets(spark, d)).select("name", "type"))
    days = table(spark, d, "region").select((F.col("r_regionkey") * 30 + 30).alias("window_days"))
    existing = table(spark, d, "supplier").filter("s_suppkey % 4 = 1").select(F.concat(F.lit("X_"), "s_suppkey").alias("name"))
    return fields.missing_fields(wanted.union(fields.metric_fields(days)), existing)


SQL["missing_index_fields"] = _with(TARGETS + INDEX_FIELDS, """, w AS (SELECT name, type FROM idx WHERE error IS NULL UNION SELECT 'ec_' || b || '_' || alang, 'STRING' FROM alt, (SELECT unnest(['name', 'description', 'shortdesc']) AS b) UNION SELECT 'units_sold_' || (r_regionkey * 30 + 30) || 'd', 'LONG_64' FROM region)
    SELECT lower(name) AS name, min(type) AS type FROM w WHERE lower(name) NOT IN (SELECT 'x_' || s_suppkey FROM supplier WHERE s_suppkey % 4 = 1) GROUP BY 1""".lstrip())


@query
def mapped_fields(spark: SparkSession, d: str) -> DataFrame:
    """Colour (by label), tags (a set of colour and type) and the master's brand, under mappings that differ in mode and scope."""
    items = source.products(spark, d)
    types = F.when(F.col("is_variant"), F.array(F.lit("Variant"), F.lit("Product"))).otherwise(F.array(F.lit("Product")))
    of = lambda obj, name, *v: F.struct(F.lit(obj).alias("source_object"), F.lit(name).alias("attribute"), F.array(*v).alias("values"))
    each = F.array(of("product", "color", F.col("color")), of("product", "tags", F.col("color"), F.lit(""), F.col("type")), of("masterProduct", "brand", F.when(F.col("is_variant"), F.col("brand"))))
    objects = items.select("id", types.alias("types"), F.explode(each).alias("o")).select("id", "types", "o.*")
    rules = spark.createDataFrame(
        [("a", True, 1, "Both", "product", "color", "x_color", "displayValue", 33), ("b", True, 2, "Variant", "product", "color", "x_raw", "raw", 33), ("c", True, 3, "Product", "product", "tags", "x_tags", "displayValueArray", 23),
         ("d", True, 4, "Both", "masterProduct", "brand", "x_brand", "raw", 3), ("e", False, 5, "Both", "product", "color", "x_off", "raw", 33), ("f", True, 6, "Both", "product", "tags", "x_set", "raw", 23)],
        "mapping_id string, enabled boolean, sort_order int, applies_to string, source_object string, attribute string, target_field string, value_mode string, type_code int",
    )
    labels = items.select(F.explode(F.array(F.lit("color"), F.lit("tags"))).alias("attribute"), F.col("color").alias("value_id"), F.initcap("color").alias("label")).distinct()
    return fields.mapped_values(objects, rules, labels)


SQL["mapped_fields"] = _with(CATALOG, """, l AS (SELECT *, upper(left(color, 1)) || substr(color, 2) AS label FROM e)
    SELECT id, 'x_color' AS field, 1 AS sort_order, false AS is_array, label AS value FROM l WHERE color <> '' UNION ALL SELECT id, 'x_raw', 2, false, color FROM l WHERE is_variant AND color <> ''
    UNION ALL SELECT id, 'x_tags', 3, true, label || ';' || CASE WHEN type IN (SELECT color FROM l) THEN upper(left(type, 1)) || substr(type, 2) ELSE type END FROM l UNION ALL SELECT id, 'x_brand', 4, false, brand FROM l WHERE is_variant UNION ALL SELECT id, 'x_set', 6, true, color || ';' || type FROM l""".lstrip())


@query
def attribute_report(spark: SparkSession, d: str) -> DataFrame:
    items = source.products(spark, d)
    kind = report_type(F.col("is_variant"))
    each = F.array(*(F.struct(F.lit(n).alias("attribute"), v.alias("values")) for n, v in (("color", F.array("color")), ("size", F.array(F.when(F.col("size") % 2 == 0, F.col("size").cast("string")))), ("tags", F.array(F.col("type"), F.lit(""), F.col("color"))))))
    values = items.select(F.lit("product").alias("object"), F.col("key").alias("id"), kind.alias("type"), F.explode(each).alias("o")).select("object", "id", "type", "o.*")
    definitions = spark.createDataFrame(
        [("color", "Color", False, True, False, 33, ["b", "", "a"]), ("size", "Size", False, False, False, 3, []), ("tags", "Tags", True, True, True, 33, ["g"]), ("unused", "Unused", True, False, False, 99, None)],
        "attribute string, display_name string, system boolean, localizable boolean, multi_value boolean, type_code int, group_ids array<string>",
    )
    labels = items.select(F.lit("color").alias("attribute"), F.col("color").alias("value_id"), F.upper("color").alias("label")).distinct()
    return report.attribute_report(values, definitions, labels).withColumn("group_ids", F.coalesce("group_ids", F.lit("")))


def report_type(variant: Column) -> Column:
    return catalog.product_type(variant, F.lit(False), F.lit(False), F.lit(False))


def _samples(attribute: str, value: str, upper: bool = False) -> str:
    shown = f"upper({value})" if upper else value
    return f"(SELECT string_agg(v, ' || ' ORDER BY n) FROM (SELECT v, row_number() OVER (ORDER BY f, v) AS n FROM (SELECT {shown} AS v, min(key) AS f FROM e WHERE {value} IS NOT NULL GROUP BY ALL)) WHERE n <= 3)"


SQL["attribute_report"] = _with(CATALOG, ", q AS (SELECT count(*) AS n, count(*) FILTER (WHERE is_variant) AS nv, count(*) FILTER (WHERE size % 2 = 0) AS s, count(*) FILTER (WHERE size % 2 = 0 AND is_variant) AS sv FROM e), r AS ("
    f"SELECT 'color' AS attribute, 'Color' AS display_name, false AS system, true AS localizable, false AS multi_value, 'enum-of-string' AS value_type, 'displayValue' AS suggested_mode, 'a|b' AS group_ids, n AS n_products, nv AS n_variant, {_samples('color', 'color')} AS raw_samples, {_samples('color', 'color', True)} AS display_samples FROM q "
    f"UNION ALL SELECT 'size', 'Size', false, false, false, 'string', 'raw', '', s, sv, {_samples('size', 'CASE WHEN size % 2 = 0 THEN size::VARCHAR END')}, {_samples('size', 'CASE WHEN size % 2 = 0 THEN size::VARCHAR END')} FROM q "
    "UNION ALL SELECT 'tags', 'Tags', true, true, true, 'enum-of-string', 'displayValueArray', 'g', n, nv, " + _samples("tags", "(type || ' | ' || color)") + ", " + _samples("tags", "(type || ' | ' || color)") + " FROM q UNION ALL SELECT 'unused', 'Unused', true, false, false, '99', 'raw', '', 0, 0, '', '') "
    "SELECT attribute, display_name, system, localizable, multi_value, value_type, suggested_mode, group_ids, n_products, 0::BIGINT AS n_categories, 0::BIGINT AS n_master, n_variant, n_products - n_variant AS n_standard, 0::BIGINT AS n_bundle, 0::BIGINT AS n_set, raw_samples, display_samples, row_number() OVER (ORDER BY n_products DESC, attribute) AS place FROM r")


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/catalog-{uuid.uuid4().hex}"


@query
def manifest_totals(spark: SparkSession, d: str) -> DataFrame:
    at = _folder(spark)
    state.write_manifest(base._descriptors(spark, d), at, "1", "2026-01-01T00:00:00.000Z")
    return state.run_totals(state.read_manifest(spark, at, "1"))


SQL["manifest_totals"] = _with(CATALOG + DESCRIPTORS, "SELECT count(*) AS n_roots, coalesce(sum(len(document_ids)), 0)::BIGINT AS n_documents FROM sig")


@query
def manifest_documents(spark: SparkSession, d: str) -> DataFrame:
    return state.document_index(base._descriptors(spark, d))


SQL["manifest_documents"] = _with(CATALOG + DESCRIPTORS, "SELECT unnest(document_ids) AS document_id, root_id FROM sig")


@query
def reconciliation_modes(spark: SparkSession, d: str) -> DataFrame:
    """Each order as a run: when the last full run was, what is asked for and what is pending."""
    k, now = F.col("o_orderkey"), F.lit("2001-01-01 00:00:00").cast("timestamp_ntz")
    at = lambda c: c.cast("timestamp")
    last = F.when(k % 17 != 0, F.col("o_orderdate") + F.expr("make_dt_interval(0, o_orderkey % 24)"))
    m = state.mode(_case(k, 3, "auto", "fast", "deep"), k % 19 == 0, k % 13 == 0, k % 11 != 0, F.when(k % 7 == 0, 0).otherwise(1), at(last), at(now), F.when(k % 2 == 0, 24 * 365 * 5))
    return table(spark, d, "orders").select(k.alias("run"), m.alias("m"), state.fresh(at(last), at(now), 60 * 24 * 365).alias("fresh")).select("run", "m.mode", "m.reason", "m.age_hours", "m.rejected", "fresh")


SQL["reconciliation_modes"] = """WITH r AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 17 <> 0 THEN o_orderdate + to_hours((o_orderkey % 24)::INT) END AS last, TIMESTAMP '2001-01-01' AS now FROM orders),
    g AS (SELECT *, greatest(0.0, epoch_us(now) - epoch_us(last)) / 3.6e9 AS age FROM r),
    w AS (SELECT *, CASE WHEN k % 13 = 0 THEN 'pending-deep-request' WHEN k % 11 = 0 THEN 'missing-deep-baseline' WHEN k % 7 = 0 THEN 'unsupported-descriptor-schema' WHEN last IS NULL THEN 'invalid-deep-baseline-timestamp'
        WHEN age >= CASE WHEN k % 2 = 0 THEN 43800 ELSE 24 END THEN 'maximum-deep-age-exceeded' END AS needed FROM g),
    x AS (SELECT *, CASE WHEN k % 19 = 0 THEN 'force-deep' WHEN k % 3 = 2 THEN 'explicit-deep' ELSE coalesce(needed, 'usable-deep-baseline') END AS reason FROM w)
    SELECT k AS run, CASE WHEN reason = 'usable-deep-baseline' THEN 'fast' ELSE 'deep' END AS mode, reason, CASE WHEN reason IN ('maximum-deep-age-exceeded', 'usable-deep-baseline') THEN age END::DOUBLE AS age_hours,
        k % 3 = 1 AND k % 19 <> 0 AND needed IS NOT NULL AS rejected, coalesce(epoch_us(now) - epoch_us(last) BETWEEN 0 AND 60 * 24 * 365 * 60000000::BIGINT, false) AS fresh FROM x"""


@query
def snapshot_counts(spark: SparkSession, d: str) -> DataFrame:
    at, rows = _folder(spark), purchases.windows(source.purchases(spark, d)).persist()
    for days in (30, 90, 365):
        state.write_snapshot(rows.select("product_id", F.col(f"units_{days}d").alias("units_sold")).filter("units_sold > 0"), at, "tr1", days, "2001-01-01")
    rows.unpersist()
    return state.read_snapshots(spark, at, "tr1").withColumn("window_days", F.col("window_days").cast("int"))


SQL["snapshot_counts"] = _with(PURCHASES, ", u AS (SELECT unnest([30, 90, 365]) AS window_days) SELECT window_days, product_id, sum(quantity::BIGINT)::BIGINT AS units_sold, '2001-01-01' AS taken FROM q, u WHERE state = 'processed' AND ts >= (SELECT max(ts) FROM b) - to_days(window_days) GROUP BY ALL".lstrip())


@query
def applied_after_full(spark: SparkSession, d: str) -> DataFrame:
    at = _folder(spark)
    alias = purchases.aliases(base.documents_product_only(spark, d))
    state.write_target_state(base._state(spark, d), purchases.skipped(base.purchase_totals(spark, d), alias), at)
    summary = state.target_summary(spark, at).select(F.lit("summary").alias("product_id"), F.lit("").alias("root_id"), F.col("n_skipped").cast("string").alias("document_id"), F.col("n_mapped").alias("units_sold"))
    never = state.read_target_state(spark, at, "missing")
    return state.advance_full(spark, at).union(never).union(summary)


SQL["applied_after_full"] = _with(CATALOG + DOCUMENTS + PURCHASES + STATE, "SELECT product_id, root_id, document_id, units_sold FROM now_ UNION ALL SELECT 'summary', '', (SELECT count(*) FROM n WHERE 'product://pid=' || product_id NOT IN (SELECT document_id FROM d))::VARCHAR, (SELECT count(*) FROM now_)")


@query
def purchase_file_totals(spark: SparkSession, d: str) -> DataFrame:
    """The purchase rows as an export in CSV with dotted headers, read back by dimension."""
    at = _folder(spark)
    rows = source.purchases(spark, d).select(F.col("product_id").alias("﻿c_contentidvalue"), F.col("quantity").alias("events.c_quantity"), F.lit('say "hi", all').alias("note"))
    state.write_sorted_csv(rows, "﻿c_contentidvalue", f"{at}/export")
    return state.purchase_totals_of_file(spark, f"{at}/export", "events.c_contentidvalue", "events.c_quantity")


SQL["purchase_file_totals"] = _with(PURCHASES, "SELECT product_id, units_sold FROM n")


def _batch_items(spark: SparkSession, d: str) -> DataFrame:
    docs = base.documents_product_variant(spark, d)
    product = F.regexp_replace(F.coalesce("parent_id", "document_id"), "product://pid=", "")
    payload = F.to_json(F.struct(F.col("document_id").alias("documentId"), F.col("object_type").alias("objecttype"), F.col("group_id").alias("ec_item_group_id")))
    pos = F.conv(F.substring(F.md5("document_id"), 1, 10), 16, 10).cast("long")
    return docs.select("root_id", pos.alias("pos"), "document_id", "object_type", product.alias("product_id"), payload.alias("payload"))


@query
def root_batches(spark: SparkSession, d: str) -> DataFrame:
    return packing.root_batches(_batch_items(spark, d), 4, 2000)


_PACKED = """
it AS (SELECT rr.root_id, ('0x' || substr(md5(did), 1, 10))::BIGINT AS pos, did, ot, lead, length('{"documentId":"' || did || '","objecttype":"' || ot || '","ec_item_group_id":"' || gid || '"}') * 3 AS cost FROM (
        SELECT root_id, 'product://pid=' || lead AS did, 'Product' AS ot, lead, CASE WHEN is_variant THEN master_id || '-' || gk ELSE id END AS gid FROM rr WHERE n = 1
        UNION ALL SELECT root_id, 'product://pid=s' || id, 'Variant', lead, CASE WHEN is_variant THEN master_id || '-' || gk ELSE id END FROM rr WHERE is_variant) rr),
pa AS (SELECT root_id, lead, did AS parent, cost + 90 AS base FROM it WHERE ot = 'Product'),
kid AS (SELECT it.lead, it.did, it.cost + 3 AS cost, base, parent, it.root_id, row_number() OVER (PARTITION BY it.root_id, it.lead ORDER BY pos) AS i FROM it JOIN pa ON pa.root_id = it.root_id AND pa.lead = it.lead WHERE ot = 'Variant'),
fold AS (SELECT root_id, parent, lead, did, i, 0::BIGINT AS batch, base + cost AS used, 2 AS n FROM kid WHERE i = 1
    UNION ALL SELECT k.root_id, k.parent, k.lead, k.did, k.i, f.batch + CASE WHEN f.n >= 4 OR f.used + k.cost > 2000 THEN 1 ELSE 0 END, CASE WHEN f.n >= 4 OR f.used + k.cost > 2000 THEN base + k.cost ELSE f.used + k.cost END, CASE WHEN f.n >= 4 OR f.used + k.cost > 2000 THEN 2 ELSE f.n + 1 END
    FROM fold f JOIN kid k ON k.root_id = f.root_id AND k.lead = f.lead AND k.i = f.i + 1),
out_ AS (SELECT root_id, parent, batch, did AS document_id, false AS repeated FROM fold UNION ALL SELECT root_id, parent, b, parent, b > 0 FROM (SELECT pa.root_id, pa.parent, unnest(range(0, coalesce(m, 0) + 1)) AS b FROM pa LEFT JOIN (SELECT root_id, parent, max(batch) AS m FROM fold GROUP BY ALL) x USING (root_id, parent))),
"""
SQL["root_batches"] = _with("RECURSIVE " + CATALOG.lstrip() + VARIANT_DOCS + _PACKED, "SELECT root_id, parent, batch, document_id, repeated FROM out_")


@query
def cross_root_uploads(spark: SparkSession, d: str) -> DataFrame:
    rows = _batch_items(spark, d).groupBy("root_id").agg(F.count(F.lit(1)).alias("n_items"), F.sum(packing.estimated_bytes(F.col("payload"))).alias("n_bytes"))
    return packing.cross_root_uploads(rows, 200, 30_000)


SQL["cross_root_uploads"] = _with("RECURSIVE " + CATALOG.lstrip() + VARIANT_DOCS + _PACKED, """, o AS (SELECT root_id, n, cost, lane, row_number() OVER (PARTITION BY lane ORDER BY root_id) AS i FROM (SELECT root_id, count(*) AS n, sum(cost) AS cost, ('0x' || substr(md5(root_id), 1, 6))::BIGINT % 16 AS lane FROM it GROUP BY root_id)),
    u AS (SELECT root_id, lane, i, 0::BIGINT AS upload, n, cost FROM o WHERE i = 1 UNION ALL
        SELECT o.root_id, o.lane, o.i, u.upload + CASE WHEN u.n + o.n > 200 OR u.cost + o.cost > 30000 THEN 1 ELSE 0 END, CASE WHEN u.n + o.n > 200 OR u.cost + o.cost > 30000 THEN o.n ELSE u.n + o.n END, CASE WHEN u.n + o.n > 200 OR u.cost + o.cost > 30000 THEN o.cost ELSE u.cost + o.cost END
        FROM u JOIN o ON o.lane = u.lane AND o.i = u.i + 1) SELECT root_id, lane, upload FROM u""".lstrip())


def _payload_items(spark: SparkSession, d: str) -> DataFrame:
    items = catalog.with_eligibility(source.products(spark, d), source.masters(source.products(spark, d))).filter("eligible")
    k, none = F.col("key"), F.lit(None).cast("array<string>")
    url = lambda t, i: F.concat(F.lit(f"https://img.example/{t}/{i}/"), "id")
    images = F.create_map(F.lit("large"), F.when(k % 4 == 0, none).otherwise(F.array(url("large", 1), F.lit(""), url("large", 1), url("large", 2))), F.lit("medium"), F.when(k % 5 == 0, none).otherwise(F.array(url("medium", 1))))
    labels = items.select(F.lit("color").alias("attribute"), F.col("color").alias("value_id"), F.upper("color").alias("label")).union(items.filter("size % 2 = 0").select(F.lit("size"), F.col("size").cast("string"), F.concat(F.lit("Size "), "size"))).union(items.filter("size % 3 = 0").select(F.lit("accessorySize"), F.col("size").cast("string"), F.concat(F.lit("Acc "), "size"))).distinct()
    price, promo = s.price_pair(F.when(k % 3 == 0, F.col("sale_price")), F.col("list_price"))
    rows = variation(items, labels).select(
        "*", F.col("id").alias("product_id"), F.when(F.col("is_variant"), F.concat("master_id", F.lit("-"), "color")).otherwise(F.col("id")).alias("group_id"), F.lit("en").alias("language"), images.alias("images"),
        F.when(k % 6 == 0, url("swatch", 1)).alias("swatch"), products.view_types(F.lit(" large ;medium,large"), products.IMAGE_TYPES).alias("image_types"), products.view_types(F.lit(None).cast("string"), products.THUMBNAIL_TYPES).alias("thumbnail_types"),
        F.lit("HTTPS://img.example/none").alias("image_placeholder"), F.lit("").alias("thumbnail_placeholder"), s.money(price).alias("price"), s.money(promo).alias("promo_price"),
        F.lit("").alias("hierarchies"), F.lit("").alias("primary_hierarchy"), F.when(k % 2 == 0, F.concat(F.lit("<HTML lang=en>"), "name", F.lit("</HTML>"))).alias("long_description"), F.when(k % 10 != 1, F.col("name")).alias("short_description"),
    )
    return rows


variation = products.variation_labels


@query
def product_payloads(spark: SparkSession, d: str) -> DataFrame:
    joined = {c: F.array_join(c, " ") for c in ("ec_images", "ec_thumbnails")}
    return products.product_payloads(_payload_items(spark, d)).withColumns(joined)


_LABELS = "CASE WHEN NOT is_variant THEN '' WHEN size % 2 = 0 THEN 'Size ' || size WHEN size % 3 = 0 THEN 'Acc ' || size ELSE '' END"
_IMG = "'https://img.example/{t}/{i}/' || id"
SQL["product_payloads"] = _with(CATALOG, f""", s AS (SELECT *, list_sum(list_transform(string_split(id, ''), lambda x: ascii(x)))::INT AS sm FROM e WHERE eligible), r AS (SELECT *, ceil((sm % 3) + 2 + (sm % 10) / 10 + 0.1) AS rt FROM s)
    SELECT 'product://pid=' || id AS documentId, '.html' AS FileExtension, 'Product' AS model, 'en' AS language, id AS permanentid, id AS ec_product_id,
        CASE WHEN key % 4 <> 0 THEN {_IMG.format(t='large', i=1)} || ' ' || {_IMG.format(t='large', i=2)} WHEN key % 5 <> 0 THEN {_IMG.format(t='medium', i=1)} ELSE 'HTTPS://img.example/none' END AS ec_images,
        CASE WHEN key % 5 <> 0 THEN {_IMG.format(t='medium', i=1)} WHEN key % 4 <> 0 THEN {_IMG.format(t='large', i=1)} || ' ' || {_IMG.format(t='large', i=2)} ELSE 'HTTPS://img.example/none' END AS ec_thumbnails,
        CASE WHEN key % 6 = 0 THEN {_IMG.format(t='swatch', i=1)} ELSE '' END AS ec_swatch, round(list_price, 2) AS ec_price, round(CASE WHEN key % 3 = 0 AND sale_price < list_price THEN sale_price END, 2) AS ec_promo_price, '' AS ec_category, '' AS ec_primary_category, 'Product' AS objecttype,
        (CASE WHEN rt < 5 THEN rt + ((sm % 10) * 0.1::DOUBLE + 0.1::DOUBLE) ELSE rt END)::DOUBLE AS ec_rating, brand AS ec_brand, CASE WHEN key % 2 = 0 THEN '<HTML lang=en>' || name || '</HTML>' WHEN key % 10 <> 1 THEN '<html><body>' || name || '</body></html>' ELSE '' END AS ec_description,
        CASE WHEN key % 10 <> 1 THEN name ELSE '' END AS ec_shortdesc, CASE WHEN is_variant AND color <> '' THEN upper(color) END AS ec_color, CASE WHEN is_variant AND size IS NOT NULL THEN {_LABELS} END AS ec_size, CASE WHEN is_variant THEN id END AS ec_sku,
        CASE WHEN is_variant THEN master_id || '-' || color ELSE id END AS ec_item_group_id FROM r""".lstrip())


@query
def variant_payloads(spark: SparkSession, d: str) -> DataFrame:
    return products.variant_payloads(_payload_items(spark, d))


SQL["variant_payloads"] = _with(CATALOG, f"SELECT 'product://pid=s' || id AS documentId, '.html' AS FileExtension, 'en' AS language, id AS permanentid, id AS ec_sku, {_LABELS} AS ec_size, 'Variant' AS objecttype, id AS ec_product_id, id AS ec_variant_id FROM e WHERE eligible AND is_variant")


@query
def alias_sums(spark: SparkSession, d: str) -> DataFrame:
    docs = source.products(spark, d).select(F.col("id").alias("document_id"), products.metric_aliases(F.col("id"), F.concat(F.lit(" "), "id"), F.lit(""), F.when(F.col("key") % 2 == 0, F.concat(F.lit("P"), F.col("key") + 1))).alias("aliases"))
    return products.alias_sums(docs, base.purchase_totals(spark, d))


SQL["alias_sums"] = _with(CATALOG + PURCHASES, "SELECT id AS document_id, (coalesce(a.units_sold, 0) + coalesce(b.units_sold, 0))::BIGINT AS units_sold FROM p LEFT JOIN n a ON a.product_id = id LEFT JOIN n b ON key % 2 = 0 AND b.product_id = 'P' || (key + 1)")


@query
def product_types(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("key")
    variant = F.col("is_variant")
    return source.products(spark, d).select("id", catalog.root_type(k % 20 == 0, variant).alias("root_type"), catalog.product_type(variant, k % 20 == 0, k % 30 == 0, k % 70 == 0).alias("product_type"))


SQL["product_types"] = _with(CATALOG, "SELECT id, CASE WHEN key % 20 = 0 THEN 'master' WHEN is_variant THEN 'variant' ELSE 'standalone' END AS root_type, CASE WHEN is_variant THEN 'variant' WHEN key % 20 = 0 THEN 'master' WHEN key % 30 = 0 THEN 'bundle' WHEN key % 70 = 0 THEN 'set' ELSE 'standard' END AS product_type FROM p")


def _generated(spark: SparkSession, d: str) -> DataFrame:
    pages = base.listing_pages(spark, d)
    depth = F.size(F.split("key_path", r"\|"))
    brand = products.legacy_brand(depth, F.split("key_path", r"\|")[0], F.when(F.col("filter_value").like("EUROPE%"), " Brands ").otherwise(""))
    locale = products.rule_locale(F.lit("EN"), F.lit("ca"), F.lit("cad"))
    path = products.rendered("/{kind}/{name}?x={kind}", {"kind": F.when(brand, "brand").otherwise("category"), "name": F.lower("category_id")})
    return pages.select("category_id", F.when(brand, "brand").otherwise("category").alias("generated_type"), F.concat_ws("-", locale["language"], locale["country"], locale["currency"]).alias("locale"), path.alias("path"), products.label(F.lit(" "), F.col("filter_value"), trim=True).alias("label"))


@query
def page_counts(spark: SparkSession, d: str) -> DataFrame:
    return products.page_counts(_generated(spark, d))


@query
def page_payloads(spark: SparkSession, d: str) -> DataFrame:
    return products.api_payloads(_generated(spark, d))


_GENERATED = ", gen AS (SELECT category_id, CASE WHEN length(key_path) - length(replace(key_path, '|', '')) = 1 AND filter_value LIKE 'EUROPE%' THEN 'brand' ELSE 'category' END AS kind, filter_value FROM pg)"
SQL["page_counts"] = _with(CATEGORIES + ENTRIES, _GENERATED + " SELECT kind AS generated_type, count(*) AS n_pages FROM gen GROUP BY kind")
SQL["page_payloads"] = _with(CATEGORIES + ENTRIES, _GENERATED + " SELECT category_id, 'en-CA-CAD' AS locale, '/' || kind || '/' || lower(category_id) || '?x=' || kind AS path, trim(filter_value) AS label FROM gen")


@query
def scalar_values(spark: SparkSession, d: str) -> DataFrame:
    """The small functions over orders: times, truth, numbers, languages, suffixes, paths, ids."""
    k = F.col("o_orderkey")
    text = _case(k, 6, "  TRUE ", "false", "", "12abc", "-7", " x ")
    return table(spark, d, "orders").select(
        k.alias("k"), s.iso_time(F.when(k % 9 != 0, F.col("o_orderdate"))).alias("iso"), s.trimmed(text).alias("trimmed"), s.truthy(text).alias("truthy"), s.optional_truthy(text).alias("optional"), s.sort_order(text).alias("sort_order"),
        s.language(_case(k, 3, "en_CA", "FR-ca", "de")).alias("language"), s.alias_suffix(_case(k, 4, "group-12-9", "-9", "plain", "a-b")).alias("suffix"), s.relative_url(_case(k, 3, "https://a.b/c/d", "/c", "c/d")).alias("path"),
        F.array_join(s.ordered_ids(F.array(F.lit(" b "), F.lit(""), F.lit("a"), F.col("o_orderstatus"), F.lit("b"))), ",").alias("ids"),
    )


SQL["scalar_values"] = """WITH o AS (SELECT *, ['  TRUE ', 'false', '', '12abc', '-7', ' x '][o_orderkey % 6 + 1] AS t FROM orders)
    SELECT o_orderkey AS k, CASE WHEN o_orderkey % 9 <> 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%gZ') ELSE '' END AS iso, trim(t) AS trimmed, lower(trim(t)) = 'true' AS truthy, CASE WHEN trim(t) <> '' THEN lower(trim(t)) = 'true' END AS optional,
    CASE WHEN t = '12abc' THEN 12 WHEN t = '-7' THEN -7 ELSE 0 END AS sort_order, ['en', 'fr', 'de'][o_orderkey % 3 + 1] AS language, ['9', NULL, NULL, 'b'][o_orderkey % 4 + 1] AS suffix, ['/c/d', '/c', '/c/d'][o_orderkey % 3 + 1] AS path,
    array_to_string(list_sort(list_distinct(['b', 'a', o_orderstatus])), ',') AS ids FROM o"""


@query
def item_errors(spark: SparkSession, d: str) -> DataFrame:
    """The rules over all products and variants of both structures, some faulty."""
    k = F.col("key")
    product = F.col("kind") == "Product"
    rows = source.products(spark, d).select("*", F.explode(F.when(F.col("is_variant"), F.array(F.lit("Product"), F.lit("Variant"))).otherwise(F.array(F.lit("Product")))).alias("kind"))
    owner = F.when(k % 31 == 0, "").when(~product & (k % 37 == 0), "nobody").otherwise(F.col("id"))
    variant = F.when(product, F.lit(None).cast("string")).when(k % 41 == 0, "").when(k % 43 == 0, "same").otherwise(F.concat(F.lit("v"), "id"))
    items = rows.select(
        (k * 2 + (~product).cast("long")).alias("pos"), F.when(k % 61 == 0, "old").alias("legacy_product_id"), F.when(k % 23 == 0, "").otherwise(F.col("id")).alias("document_id"), _case(k, 29, "", "FR", *["En"] * 27).alias("language"), F.col("kind").alias("object_type"),
        owner.alias("product_id"), variant.alias("variant_id"), F.when(k % 47 == 0, "other").when(product, owner).otherwise(variant).alias("permanent_id"),
    )
    return reconcile.item_errors(items, "en", "product_variant")


SQL["item_errors"] = _with(CATALOG, """, i AS (SELECT key * 2 + kind AS pos, key, kind = 0 AS product, CASE WHEN key % 31 = 0 THEN '' WHEN kind = 1 AND key % 37 = 0 THEN 'nobody' ELSE id END AS pid, CASE WHEN kind = 0 THEN NULL WHEN key % 41 = 0 THEN '' WHEN key % 43 = 0 THEN 'same' ELSE 'v' || id END AS vid FROM p, (SELECT unnest([0, 1]) AS kind) WHERE kind = 0 OR is_variant),
    j AS (SELECT *, CASE WHEN key % 47 = 0 THEN 'other' WHEN product THEN pid ELSE vid END AS perm FROM i), sound AS (SELECT pos, vid, min(pos) OVER (PARTITION BY vid) AS f FROM j WHERE NOT product AND vid <> '' AND perm = vid)
    SELECT pos, 'legacy_product_id' AS error FROM j WHERE key % 61 = 0 UNION ALL SELECT pos, 'missing_document_id' FROM j WHERE key % 23 = 0 UNION ALL SELECT pos, 'missing_language' FROM j WHERE key % 29 = 0 UNION ALL SELECT pos, 'wrong_language' FROM j WHERE key % 29 = 1
    UNION ALL SELECT pos, 'missing_product_id' FROM j WHERE pid = '' UNION ALL SELECT pos, 'permanent_id_not_product_id' FROM j WHERE product AND pid <> '' AND perm <> pid UNION ALL SELECT pos, 'missing_variant_id' FROM j WHERE NOT product AND vid = ''
    UNION ALL SELECT pos, 'permanent_id_not_variant_id' FROM j WHERE NOT product AND vid <> '' AND perm <> vid UNION ALL SELECT pos, 'duplicate_variant_id' FROM sound WHERE pos > f
    UNION ALL SELECT pos, 'missing_parent' FROM j WHERE NOT product AND pid <> '' AND pid NOT IN (SELECT pid FROM j WHERE product AND pid <> '' AND perm = pid)""".lstrip())


@query
def eligible_in_all_mode(spark: SparkSession, d: str) -> DataFrame:
    items = source.products(spark, d)
    return catalog.with_eligibility(items, source.masters(items), " ALL").filter("eligible").groupBy(catalog.root_id().alias("root_id")).agg(F.count(F.lit(1)).alias("n_eligible"))


SQL["eligible_in_all_mode"] = _with(CATALOG, "SELECT root_id, count(*) AS n_eligible FROM e GROUP BY root_id")


@query
def book_prices(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as price books in chains of halves; each part sold under one book, with list amounts in top books."""
    k, b = F.col("p_partkey"), F.col("s_suppkey")
    supplier, part = table(spark, d, "supplier"), table(spark, d, "part")
    books = supplier.select(F.concat(F.lit("B"), b).alias("book_id"), F.when(b > 3, F.concat(F.lit("B"), F.floor(b / 2).cast("long"))).when(b == 3, "nowhere").alias("parent_id"))
    items = part.select(F.concat(F.lit("P"), k).alias("id"), F.concat(F.lit("B"), k % 17).alias("book_id"), F.when(k % 3 == 0, F.col("p_retailprice") * 0.8).alias("price"), F.when(k % 5 == 0, F.col("p_retailprice") * 0.9).alias("least"), F.when(k % 7 != 0, F.col("p_retailprice")).alias("most"))
    amounts = part.select(F.concat(F.lit("P"), k).alias("product_id"), F.explode(F.array(F.lit("B2"), F.lit("B3"))).alias("book_id"), F.col("p_retailprice").alias("amount")).filter("book_id = 'B2' or amount > 905")
    return catalog.book_prices(items, amounts, books)


SQL["book_prices"] = """WITH RECURSIVE up AS (SELECT s_suppkey AS b, s_suppkey AS r FROM supplier UNION ALL SELECT b, r // 2 FROM up WHERE r > 3), top AS (SELECT b, min(r) AS r FROM up WHERE r <= 3 GROUP BY b),
    i AS (SELECT p_partkey AS k, p_retailprice AS v, r, CASE WHEN p_partkey % 3 = 0 THEN v * 0.8::DOUBLE END AS price, CASE WHEN p_partkey % 5 = 0 THEN v * 0.9::DOUBLE END AS least, CASE WHEN p_partkey % 7 <> 0 THEN v END AS most FROM part LEFT JOIN top ON b = p_partkey % 17),
    j AS (SELECT *, coalesce(price, least, most) AS sales, coalesce(CASE WHEN r = 2 OR (r = 3 AND v > 905) THEN v END, most) AS base FROM i)
    SELECT 'P' || k AS id, round(coalesce(base, sales), 2) AS price, round(CASE WHEN sales < base THEN sales END, 2) AS promo_price FROM j"""


def _imports(spark: SparkSession, d: str) -> DataFrame:
    """A configuration per nation with its suppliers as mappings, written as JSON and read back."""
    n, k = F.col("s_nationkey"), F.col("s_suppkey")
    profile = F.struct(F.concat(F.lit("prof"), n).alias("profile_id"), F.lit("site1").alias("site_id"))
    mapping = F.struct(
        F.concat(F.lit(" m"), k % 40).alias("mapping_id"), F.when(k % 8 == 0, "site2").alias("site_id"), F.when(k % 9 == 0, "elsewhere").alias("profile_id"), F.when(k % 4 == 0, False).alias("enabled"), F.when(k % 10 == 0, " ").otherwise("Both").alias("applies_to"),
        F.lit("product").alias("source_object"), F.lit("custom").alias("source_scope"), F.lit("style").alias("source_attribute"), F.concat(F.lit("x_"), k).alias("target_field"), F.when(k % 11 != 0, "raw").alias("value_mode"),
    )
    at = f"{_folder(spark)}/imports"
    config = table(spark, d, "supplier").groupBy(profile.alias("profile")).agg(F.collect_list(mapping).alias("mappings"))
    config.write.json(at)
    return spark.read.schema(config.schema).json(at)


@query
def mapping_imports(spark: SparkSession, d: str) -> DataFrame:
    return attributes.imported(_imports(spark, d)).select("profile_id", "mapping_id", "site_id", "enabled", "target_field", "error")


SQL["mapping_imports"] = """SELECT 'prof' || s_nationkey AS profile_id, 'm' || s_suppkey % 40 AS mapping_id, CASE WHEN s_suppkey % 8 = 0 THEN 'site2' ELSE 'site1' END AS site_id, s_suppkey % 4 <> 0 AS enabled, 'x_' || s_suppkey AS target_field,
    CASE WHEN s_suppkey % 10 = 0 THEN 'missing_applies_to' WHEN s_suppkey % 11 = 0 THEN 'missing_value_mode' WHEN s_suppkey % 8 = 0 THEN 'other_site' WHEN s_suppkey % 9 = 0 THEN 'other_profile' WHEN count(*) OVER (PARTITION BY s_nationkey, s_suppkey % 40) > 1 THEN 'repeated_mapping' END AS error FROM supplier"""


@query
def final_mapping_errors(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    rows = table(spark, d, "supplier").select(F.concat(F.lit("m"), k).alias("mapping_id"), (k % 6 != 0).alias("enabled"), F.lit("color").alias("source_attribute"), F.concat(F.lit("X_"), k % 20).alias("target_field"), F.lit("raw").alias("value_mode"), k.alias("k"))
    new = rows.filter("k % 2 = 0").withColumn("target_field", F.when(F.col("k") % 4 == 0, F.concat(F.lit("y_"), "k")).otherwise("EC_Brand"))
    return attributes.final_errors(new.drop("k"), rows.filter("k % 3 <> 0").drop("k"))


SQL["final_mapping_errors"] = """WITH r AS (SELECT 'm' || s_suppkey AS mapping_id, lower(CASE WHEN s_suppkey % 4 = 0 THEN 'y_' || s_suppkey WHEN s_suppkey % 2 = 0 THEN 'EC_Brand' ELSE 'X_' || s_suppkey % 20 END) AS t FROM supplier WHERE s_suppkey % 6 <> 0 AND (s_suppkey % 2 = 0 OR s_suppkey % 3 <> 0))
    SELECT mapping_id, 'reserved_target' AS error FROM r WHERE t = 'ec_brand' UNION ALL SELECT mapping_id, 'repeated_target' FROM (SELECT mapping_id, count(*) OVER (PARTITION BY t) AS n FROM r) WHERE n > 1"""


def _read_pages(spark: SparkSession, d: str) -> DataFrame:
    """The pages that exist, as three tracking ids show them: some without an id, some twice."""
    k = F.col("s_suppkey")
    rows = table(spark, d, "supplier").select(F.explode(F.array(*(F.lit(x) for x in ("tr1", "tr2", "tr3")))).alias("tracking_id"), k)
    shown = rows.filter("s_suppkey % 3 <> 0 or tracking_id <> 'tr1'")
    return shown.select("tracking_id", F.when(k % 4 != 0, F.concat(F.lit("page-"), k)).alias("page_id"), F.concat(F.lit("name "), F.floor(k / 8)).alias("name"), F.concat(F.lit("/u/"), k % 16, F.lit(" /v")).alias("patterns"))


@query
def existing_pages(spark: SparkSession, d: str) -> DataFrame:
    return listing.existing_pages(_read_pages(spark, d))


_PAGES_READ = "rd AS (SELECT tr AS tracking_id, CASE WHEN s_suppkey % 4 <> 0 THEN 'page-' || s_suppkey END AS page_id, 'name ' || s_suppkey // 8 AS name, '/u/' || s_suppkey % 16 || ' /v' AS patterns FROM supplier, (SELECT unnest(['tr1', 'tr2', 'tr3']) AS tr) WHERE s_suppkey % 3 <> 0 OR tr <> 'tr1'),"
SQL["existing_pages"] = _with(_PAGES_READ, "SELECT min(tracking_id) AS tracking_id, page_id, min(name) AS name, min(patterns) AS patterns FROM rd WHERE page_id IS NOT NULL GROUP BY page_id UNION ALL SELECT min(tracking_id), NULL, name, patterns FROM rd WHERE page_id IS NULL GROUP BY name, patterns")


@query
def unverified_pages(spark: SparkSession, d: str) -> DataFrame:
    now = listing.existing_pages(_read_pages(spark, d)).select("name", "patterns").distinct()
    return listing.unverified(now, now.filter("name not like '%1'"))


SQL["unverified_pages"] = _with(_PAGES_READ, "SELECT DISTINCT name, patterns FROM rd WHERE right(name, 1) = '1'")


@query
def operation_files(spark: SparkSession, d: str) -> DataFrame:
    """The operations of a delta run in batches, written as JSON lines and read back."""
    at, ops = f"{_folder(spark)}/operations", reconcile.operations(base._reasons(spark, d))
    reconcile.write_batches(reconcile.fixed_batches(ops, "op", "document_id", 50).withColumn("payload", F.concat(F.lit("p:"), "document_id")), at)
    return spark.read.schema("op string, document_id string, payload string, batch long").json(at)


SQL["operation_files"] = _with(CATALOG + DESCRIPTORS, "SELECT op, document_id, 'p:' || document_id AS payload, ((row_number() OVER (PARTITION BY op ORDER BY document_id) - 1) // 50)::BIGINT AS batch FROM ops")
