"""Index fields and mapped values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Index field types, the separator of values in one field, and how a mapping's value may be written.
FIELD_TYPES = ("LONG", "LONG_64", "DOUBLE", "DATE", "STRING")
SEPARATOR = ";"
MODES = ("raw", "displayValue", "displayValueArray")
#: Names of the attribute types by code.
TYPE_NAMES = {1: "int", 2: "number", 3: "string", 4: "text", 5: "html", 6: "date", 7: "image", 8: "boolean", 9: "money", 10: "quantity", 11: "datetime", 12: "email", 13: "password", 21: "set-of-int", 22: "set-of-number", 23: "set-of-string", 31: "enum-of-int", 33: "enum-of-string"}
ENUMS, SETS = (31, 33), (21, 22, 23)


def _text(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def type_name(code: Column) -> Column:
    """the name of a type, or its code as text."""
    names = F.create_map(*(F.lit(x) for pair in TYPE_NAMES.items() for x in pair))
    return F.coalesce(F.try_element_at(names, code), code.cast("string"), F.lit(""))


def suggested_mode(code: Column, multi_value: Column, localizable: Column) -> Column:
    """F39."""
    enum = code.isin(*ENUMS)
    return F.when(enum & multi_value, "displayValueArray").when(enum & localizable, "displayValue").otherwise("raw")


def group_ids(ids: Column) -> Column:
    """without blanks, sorted."""
    return F.array_sort(F.filter(ids, lambda x: F.coalesce(x, F.lit("")) != ""))


def mapping_rows(table: DataFrame, site: str, profile: str) -> DataFrame:
    """The mappings of one site and profile, with their place in the order (sort order, then creation)."""
    return table.filter((F.col("site_id") == site) & (F.col("profile_id") == profile)).withColumn("place", F.struct("sort_order", "created_pos"))


def applies(applies_to: Column, types: Column) -> Column:
    """P16."""
    return (applies_to == "Both") | F.array_contains(types, applies_to)


def index_fields(mappings: DataFrame) -> DataFrame:
    """The index field of each enabled mapping (mapping_id, profile_id, source_object, source_scope,
    source_attribute, target_field, value_mode, and the options option_type, option_description, sync, facet, multi_value_facet,
    tokenizers, stemming); those with sync off have none. error: the first rule that the field breaks, null if none."""
    described = F.concat(F.lit("Generated from mapping profile "), _text("profile_id"), F.lit(": "), F.concat_ws(".", "source_object", "source_scope", "source_attribute"), F.lit(" -> "), _text("target_field"))
    several = F.coalesce("multi_value_facet", F.when(F.col("value_mode") == "displayValueArray", True))
    on = F.coalesce(several, F.lit(False))
    kind = F.when(_text("option_type") != "", F.col("option_type")).otherwise("STRING")
    name = F.trim(_text("target_field"))
    tokens = F.when(on, F.when(_text("tokenizers") != "", F.col("tokenizers")).otherwise(SEPARATOR))
    plain = kind != "STRING"
    error = F.when(~name.rlike("^[a-z][a-z0-9_]{0,254}$"), "invalid_name").when(~kind.isin(*FIELD_TYPES), "unsupported_type").when(plain & on, "multi_value_not_string").when(plain & F.coalesce("stemming", F.lit(False)), "stemming_not_string")
    rows = mappings.filter("enabled and coalesce(sync, true)")
    return rows.select(
        "mapping_id", name.alias("name"), F.when(_text("option_description") != "", F.col("option_description")).otherwise(described).alias("description"), kind.alias("type"),
        F.when(~on, F.col("facet")).alias("facet"), several.alias("multi_value_facet"), tokens.alias("tokenizers"), "stemming", error.alias("error"),
    )


def alternate_fields(targets: DataFrame) -> DataFrame:
    """Name, description and short description in each alternate language of a target (target_id, alternates)."""
    rows = targets.select("target_id", F.explode("alternates").alias("x"))
    names = F.array(*(F.concat(F.lit(f"ec_{base}_"), F.col("x.language")) for base in ("name", "description", "shortdesc")))
    return rows.select("target_id", F.explode(names).alias("name"), F.lit("STRING").alias("type"))


def metric_fields(snapshots: DataFrame) -> DataFrame:
    """One field for each window of the snapshots (window_days)."""
    return snapshots.select(F.concat(F.lit("units_sold_"), "window_days", F.lit("d")).alias("name"), F.lit("LONG_64").alias("type")).distinct()


def missing_fields(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """Fields to create: each wanted name once, in lower case, unless the index has it."""
    named = wanted.select(F.lower("name").alias("name"), "type").groupBy("name").agg(F.min("type").alias("type"))
    return named.join(existing.select(F.lower("name").alias("name")), "name", "left_anti")


def labelled(values: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds the display label of each raw value (attribute, value), the value itself where there is none."""
    found = labels.select("attribute", F.col("value_id").alias("value"), F.col("label"))
    return values.join(found, ["attribute", "value"], "left").withColumn("label", F.when(_text("label") != "", F.col("label")).otherwise(F.col("value")))


def mapped_values(objects: DataFrame, mappings: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, field, values, array, place) for objects (id, types, source_object, attribute, values).

    A mapping takes the attribute of its source object if it applies to the item's types; sets and array modes give arrays without
    blanks, others one value; what is empty is left out. Mappings are few and are broadcast by Spark while they are small."""
    on = mappings.filter("enabled")
    met = objects.join(on, ["source_object", "attribute"]).filter(applies(F.col("applies_to"), F.col("types")))
    one = met.select("id", "mapping_id", "target_field", "value_mode", "type_code", "sort_order", "attribute", F.posexplode(F.coalesce("values", F.array().cast("array<string>"))).alias("pos", "value"))
    shown = labelled(one, labels).withColumn("out", F.when(F.col("value_mode") == "raw", F.col("value")).otherwise(F.col("label"))).filter(_text("out") != "")
    array = (F.col("value_mode") == "displayValueArray") | F.col("type_code").isin(*SETS)
    gathered = shown.groupBy("id", "mapping_id", "target_field", "sort_order", array.alias("is_array")).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "out"))), lambda x: x["out"]).alias("v"))
    return gathered.select("id", F.col("target_field").alias("field"), "sort_order", "is_array", F.when(F.col("is_array"), F.array_join("v", SEPARATOR)).otherwise(F.get("v", F.lit(0))).alias("value"))
