"""The attribute report (K10, K11, O1, O5, P9, F41-F43, F47, S18, A4 by product type)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.fields import group_ids, labelled, suggested_mode, type_name

TYPES = ("master", "variant", "standard", "bundle", "set")


def scalar(*forms: Column) -> Column:
    """the first form of a value that isn't empty: source, secure address, address, value, id, text."""
    return F.coalesce(*(F.when(f != "", f) for f in forms))


def clean(values: Column) -> Column:
    """without blanks."""
    return F.filter(values, lambda x: F.coalesce(x, F.lit("")) != "")


def scanned(products: DataFrame, pos: str, most: int = 0) -> DataFrame:
    """The first products in order, all for 0. A limit that the caller sets, not one of this library."""
    return products.orderBy(pos).limit(most) if most else products


def attribute_report(values: DataFrame, definitions: DataFrame, labels: DataFrame, samples: int = 3) -> DataFrame:
    """A row per attribute of values (object, id, type, attribute, values): counts of distinct objects with a value, by type
    too, and the first distinct samples, raw and as shown. place: by count descending, then attribute."""
    held = values.withColumn("values", clean(F.col("values"))).filter(F.size("values") > 0)
    by_type = [F.count_if(F.col("type") == t).alias(f"n_{t}") for t in TYPES]
    counts = held.groupBy("attribute").agg(F.count_if(F.col("object") == "product").alias("n_products"), F.count_if(F.col("object") == "category").alias("n_categories"), *by_type)
    one = labelled(held.select("attribute", "id", F.posexplode("values").alias("pos", "value")), labels)
    shown = one.groupBy("attribute", "id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value", "label"))), lambda x: F.struct(x["value"].alias("value"), x["label"].alias("label"))).alias("v"))
    texts = shown.select("attribute", "id", F.array_join(F.transform("v", lambda x: x["value"]), " | ").alias("raw"), F.array_join(F.transform("v", lambda x: x["label"]), " | ").alias("display"))

    def firsts(column: str) -> DataFrame:
        distinct = texts.groupBy("attribute", column).agg(F.min("id").alias("first_id"))
        w = Window.partitionBy("attribute").orderBy("first_id", column)
        top = distinct.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= samples)
        return top.groupBy("attribute").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", column))), lambda x: x[column]), " || ").alias(f"{column}_samples"))

    rows = definitions.join(counts, "attribute", "left").join(firsts("raw"), "attribute", "left").join(firsts("display"), "attribute", "left")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_products", "n_categories", *(f"n_{t}" for t in TYPES))]
    return rows.select(
        "attribute", "display_name", "system", "localizable", "multi_value", type_name(F.col("type_code")).alias("value_type"), suggested_mode(F.col("type_code"), F.col("multi_value"), F.col("localizable")).alias("suggested_mode"),
        F.array_join(group_ids(F.col("group_ids")), "|").alias("group_ids"), *zero, F.coalesce("raw_samples", F.lit("")).alias("raw_samples"), F.coalesce("display_samples", F.lit("")).alias("display_samples"),
        F.row_number().over(Window.orderBy(F.desc_nulls_last("n_products"), "attribute")).cast("long").alias("place"),  # one row per attribute
    )


def write_csv(report: DataFrame, at: str) -> None:
    """Quotes doubled."""
    report.orderBy("place").write.mode("overwrite").option("header", True).option("escape", '"').csv(at)


def write_json(report: DataFrame, at: str) -> None:
    """K11."""
    report.orderBy("place").write.mode("overwrite").json(at)
