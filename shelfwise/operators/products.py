"""Whole product and variant payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.scalars import alias_suffix, html_document, rating

#: The default view types of images and thumbnails, in order of preference.
IMAGE_TYPES, THUMBNAIL_TYPES = ("large", "medium"), ("medium", "large")
EXTENSION, MODEL = ".html", "Product"


def label(*names: Column, trim: bool = False) -> Column:
    """the first name that isn't empty."""
    shown = [F.trim(n) if trim else n for n in names]
    return F.coalesce(*(F.when(n != "", n) for n in shown), F.lit(""))


def markup(c: Column) -> Column:
    """F15."""
    return F.coalesce(c, F.lit(""))


def view_types(setting: Column, default: tuple[str, ...]) -> Column:
    """the types of a setting, parted by commas, semicolons or lines, each once; the default if there are none."""
    found = F.array_distinct(F.filter(F.transform(F.split(F.coalesce(setting, F.lit("")), r"[\r\n,;]+"), lambda x: F.trim(x)), lambda x: x != ""))
    return F.when(F.size(found) > 0, found).otherwise(F.array(*map(F.lit, default)))


def placeholder(*settings: Column) -> Column:
    """the first setting that isn't empty, if it is a web address."""
    url = label(*settings)
    return F.when(url.rlike("(?i)^https?://"), url).otherwise("")


def image_urls(images: Column, types: Column, fallback: Column) -> Column:
    """The distinct URLs of the first view type that has any (images: map of type to URLs), else the fallback's."""
    clean = lambda t: F.array_distinct(F.filter(F.coalesce(F.try_element_at(images, t), F.array().cast("array<string>")), lambda u: F.coalesce(u, F.lit("")) != ""))
    found = F.get(F.filter(F.transform(types, clean), lambda x: F.size(x) > 0), F.lit(0))
    return F.coalesce(found, F.when(fallback != "", F.array(fallback)), F.array().cast("array<string>"))


def variation_labels(items: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds color_label and size_label of variants, empty where the value has none; a size is also looked up among
    accessory sizes. labels: (attribute, value_id, label)."""
    of = lambda a, name: labels.filter(F.col("attribute") == a).select(F.col("value_id").alias(f"{name}_id"), F.col("label").alias(name))
    out = items.join(of("color", "c"), items["color"] == F.col("c_id"), "left").join(of("size", "s"), items["size"].cast("string") == F.col("s_id"), "left").join(of("accessorySize", "x"), items["size"].cast("string") == F.col("x_id"), "left")
    shown = lambda *c: F.when(F.col("is_variant"), label(*(F.col(n) for n in c))).otherwise("")
    return out.withColumn("color_label", shown("c")).withColumn("size_label", shown("s", "x")).drop("c_id", "c", "s_id", "s", "x_id", "x")


def product_payloads(items: DataFrame, only: bool = True) -> DataFrame:
    """The product document. items has id, product_id, group_id, language, images (map), swatch, image_types, thumbnail_types,
    placeholders, price, promo_price, hierarchies, primary_hierarchy, brand, long and short descriptions, labels, is_variant."""
    described = html_document(F.col("long_description"))
    when = lambda c, v: F.when(F.col("is_variant") & (F.coalesce(F.col(c).cast("string"), F.lit("")) != ""), v)
    return items.select(
        F.concat(F.lit("product://pid="), "id").alias("documentId"), F.lit(EXTENSION).alias("FileExtension"), F.lit(MODEL).alias("model"), "language",
        F.col("product_id").alias("permanentid"), F.col("product_id").alias("ec_product_id"),
        image_urls(F.col("images"), F.col("image_types"), placeholder(F.col("image_placeholder"))).alias("ec_images"),
        image_urls(F.col("images"), F.col("thumbnail_types"), placeholder(F.col("thumbnail_placeholder"), F.col("image_placeholder"))).alias("ec_thumbnails"),
        F.coalesce("swatch", F.lit("")).alias("ec_swatch"), F.col("price").alias("ec_price"), F.col("promo_price").alias("ec_promo_price"), F.col("hierarchies").alias("ec_category"),
        F.col("primary_hierarchy").alias("ec_primary_category"), F.lit("Product").alias("objecttype"), rating(F.col("id")).alias("ec_rating"), F.col("brand").alias("ec_brand"),
        F.when(described != "", described).otherwise(html_document(F.col("short_description"))).alias("ec_description"), markup(F.col("short_description")).alias("ec_shortdesc"),
        when("color", F.col("color_label")).alias("ec_color"), when("size", F.col("size_label")).alias("ec_size"), F.when(F.col("is_variant") & F.lit(only), F.col("id")).alias("ec_sku"), F.col("group_id").alias("ec_item_group_id"),
    )


def variant_payloads(items: DataFrame) -> DataFrame:
    """The variant document."""
    return items.filter("is_variant").select(
        F.concat(F.lit("product://pid=s"), "id").alias("documentId"), F.lit(EXTENSION).alias("FileExtension"), "language", F.col("id").alias("permanentid"), F.col("id").alias("ec_sku"),
        F.col("size_label").alias("ec_size"), F.lit("Variant").alias("objecttype"), F.col("product_id").alias("ec_product_id"), F.col("id").alias("ec_variant_id"),
    )


def metric_aliases(*names: Column) -> Column:
    """Trimmed, without blanks, each once, in order."""
    return F.array_distinct(F.filter(F.transform(F.array(*names), lambda x: F.trim(F.coalesce(x, F.lit("")))), lambda x: x != ""))


def alias_sums(documents: DataFrame, counts: DataFrame) -> DataFrame:
    """The units of all aliases (array) of a document, 0 if none was sold."""
    one = documents.select("document_id", F.explode("aliases").alias("product_id")).distinct()
    sums = one.join(counts, "product_id").groupBy("document_id").agg(F.sum("units_sold").alias("units_sold"))
    return documents.select("document_id").join(sums, "document_id", "left").select("document_id", F.coalesce("units_sold", F.lit(0)).alias("units_sold"))


def document_aliases() -> Column:
    return metric_aliases(F.col("product_id"), alias_suffix(F.col("product_id")))


def rendered(template: str, values: dict[str, Column]) -> Column:
    """the template with each {key} replaced."""
    out = F.lit(template)
    for key, value in values.items():
        out = F.replace(out, F.lit("{" + key + "}"), F.coalesce(value, F.lit("")))
    return out


def rule_locale(language: Column, country: Column, currency: Column) -> Column:
    """F35."""
    return F.struct(F.lower(language).alias("language"), F.upper(country).alias("country"), F.upper(currency).alias("currency"))


def legacy_brand(depth: Column, root_id: Column, root_name: Column) -> Column:
    """an entry right under a root that is named brands."""
    return (depth == 2) & ((F.lower(root_id) == "brands") | (F.lower(F.trim(root_name)) == "brands"))


def page_counts(pages: DataFrame) -> DataFrame:
    """A16."""
    return pages.groupBy("generated_type").agg(F.count(F.lit(1)).alias("n_pages"))


def api_payloads(pages: DataFrame) -> DataFrame:
    """Pages as they are sent, without the type that made them."""
    return pages.drop("generated_type")
