"""Attribute audit and field mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def unpivoted(rows: DataFrame, id_col: str, type_col: str, names: list[str]) -> DataFrame:
    """A row per object and populated attribute; 0 and false are values."""
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("attribute"), F.col(n).cast("string").alias("value")) for n in names)))
    return rows.select(F.col(id_col).alias("id"), F.col(type_col).alias("type"), pairs.alias("p")).select("id", "type", "p.attribute", "p.value").filter("value is not null and value <> ''")


def audit(rows: DataFrame, types: list[str], samples: int = 3) -> DataFrame:
    """Populated counts, by type too, and the first distinct values in order of id."""
    counts = rows.groupBy("attribute").agg(F.count(F.lit(1)).alias("n_objects"), *(F.count_if(F.col("type") == t).alias(f"n_{t}") for t in types))
    firsts = rows.groupBy("attribute", "value").agg(F.min("id").alias("first_id"))
    w = Window.partitionBy("attribute").orderBy("first_id", "value")
    top = firsts.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= samples).groupBy("attribute").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "value"))), lambda s: s["value"]), " | ").alias("samples"))
    return counts.join(top, "attribute")


def audit_categories(assigned: DataFrame, categories: DataFrame) -> DataFrame:
    """A5: category attributes once per product and once per distinct category."""
    primary = assigned.filter("is_primary").join(categories, assigned["category_id"] == categories["id"])
    return primary.agg(F.count(F.lit(1)).alias("n_products"), F.countDistinct("category_id").alias("n_categories"), F.count_if("online").alias("n_online"))


#: Names that a mapping may not write, in lower case.
RESERVED = (
    "documentid", "fileextension", "model", "language", "permanentid", "ec_product_id", "ec_images", "ec_thumbnails", "ec_swatch", "ec_price", "ec_promo_price", "ec_category",
    "ec_primary_category", "objecttype", "ec_rating", "ec_brand", "ec_description", "ec_shortdesc", "ec_color", "ec_size", "ec_item_group_id", "ec_sku", "ec_variant_id", "ec_name",
)


def mapping_errors(mappings: DataFrame) -> DataFrame:
    """Enabled mappings with a missing field, an unknown mode, a reserved or repeated target (case-insensitive)."""
    on = mappings.filter("enabled").withColumn("target", F.lower("target_field")).withColumn("repeated", F.count(F.lit(1)).over(Window.partitionBy("target")) > 1)
    checks = F.array_compact(F.array(
        F.when(F.coalesce("source_attribute", F.lit("")) == "", "missing_source"), F.when(~F.col("value_mode").isin("raw", "displayValue", "displayValueArray"), "unknown_mode"),
        F.when(F.col("target").isin(*RESERVED), "reserved_target"), F.when(F.col("repeated"), "repeated_target"),
    ))
    return on.select("mapping_id", F.explode(checks).alias("error"))


#: What a mapping's columns may say.
DOMAINS = {"applies_to": ("Product", "Variant", "Both"), "source_object": ("product", "masterProduct", "primaryCategory"), "source_scope": ("system", "custom"), "value_mode": ("raw", "displayValue", "displayValueArray")}
_MUST_HAVE = ("mapping_id", "site_id", "profile_id", "source_attribute", "target_field")


def first_rule_broken(mappings: DataFrame) -> DataFrame:
    """(place, mapping_id, error) of mappings in order of `place`: the first rule that a mapping breaks: missing values, each domain, a reserved
    target, then a target that an earlier sound mapping of its profile has, in any case."""
    blank = [F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.lit(c)) for c in _MUST_HAVE]
    missing = F.array_join(F.array_compact(F.array(*blank)), ", ")
    error = F.when(missing != "", F.concat(F.lit("missing "), missing))
    for column, values in DOMAINS.items():
        error = error.when(~F.coalesce(F.col(column).isin(*values), F.lit(False)), f"unsupported {column}")
    error = error.when(F.lower(F.trim("target_field")).isin(*RESERVED), "reserved target_field")
    rows = mappings.withColumn("own", error).withColumn("target", F.lower(F.trim("target_field")))
    earlier = Window.partitionBy("site_id", "profile_id", "target").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    again = F.coalesce(F.max(F.col("own").isNull()).over(earlier), F.lit(False))
    found = rows.withColumn("again", again).withColumn("error", F.coalesce("own", F.when(F.col("again"), "duplicate target_field")))
    return found.filter("error is not null").select("place", "mapping_id", "error")


def upserted(new: DataFrame, old: DataFrame, replace: bool = False) -> DataFrame:
    """Insert or overwrite by key; in replace mode old keys that were not imported go."""
    both = new.alias("n").join(old.alias("o"), "mapping_id", "left" if replace else "full_outer")
    state = F.when(F.col("o.target_field").isNull(), "created").when(F.col("n.target_field").isNull(), "kept").otherwise("updated")
    return both.select("mapping_id", F.coalesce("n.target_field", "o.target_field").alias("target_field"), state.alias("state"))


def imported(config: DataFrame) -> DataFrame:
    """(profile_id, mapping_id, site_id, enabled, ..., error) of nested configurations (profile struct, mappings array of
    structs): what a mapping leaves blank is its profile's; error is the first rule it breaks."""
    rows = config.select(F.col("profile.profile_id").alias("p_id"), F.col("profile.site_id").alias("p_site"), F.explode("mappings").alias("m"))
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    out = rows.select(
        F.col("p_id").alias("profile_id"), "p_site", F.trim("m.mapping_id").alias("mapping_id"), F.when(blank("m.site_id"), F.col("p_site")).otherwise(F.trim("m.site_id")).alias("site_id"),
        F.when(blank("m.profile_id"), F.col("p_id")).otherwise(F.trim("m.profile_id")).alias("own_profile"), F.coalesce("m.enabled", F.lit(True)).alias("enabled"), *(F.trim(f"m.{c}").alias(c) for c in REQUIRED[1:]),
    )
    again = F.count(F.lit(1)).over(Window.partitionBy("profile_id", "mapping_id")) > 1
    error = F.coalesce(*(F.when(blank(c), f"missing_{c}") for c in REQUIRED), F.when(F.col("site_id") != F.col("p_site"), "other_site"), F.when(F.col("own_profile") != F.col("profile_id"), "other_profile"), F.when(again, "repeated_mapping"))
    return out.withColumn("error", error).drop("p_site", "own_profile")


def read_imports(spark: SparkSession, path: str) -> DataFrame:
    """Nested configurations for `imported` from files of JSON text, one document each; one that isn't an object with a profile and a list
    of mappings is an error."""
    text = spark.read.text(path, wholetext=True)
    mapping = ", ".join(f"{c}: {'boolean' if c == 'enabled' else 'string'}" for c in ("mapping_id", "site_id", "profile_id", "enabled", *REQUIRED[1:]))
    parsed = F.from_json("value", f"profile struct<profile_id: string, site_id: string>, mappings array<struct<{mapping}>>", {"mode": "PERMISSIVE"})
    rows = text.select(F.col("value").rlike(r"^\s*\{").alias("object"), parsed.alias("c"))
    sound = F.col("object") & F.col("c.profile.profile_id").isNotNull() & F.col("c.mappings").isNotNull()
    fails = F.raise_error(F.lit("a configuration must be an object with a profile and mappings")).cast(f"array<struct<{mapping}>>")
    return rows.select("c.profile", F.when(sound, F.col("c.mappings")).otherwise(fails).alias("mappings"))


#: What a mapping in an import must have.
REQUIRED = ("mapping_id", "applies_to", "source_object", "source_scope", "source_attribute", "target_field", "value_mode")


def final_errors(new: DataFrame, old: DataFrame, replace: bool = False) -> DataFrame:
    """P14 over the table as it is after an import of `new` over `old` (mapping_id, enabled, source_attribute, target_field,
    value_mode); in replace mode old rows that were not imported are gone."""
    kept = new if replace else new.unionByName(old.join(new.select("mapping_id"), "mapping_id", "left_anti"))
    return mapping_errors(kept)
