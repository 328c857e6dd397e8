"""Export targets: locales, rules, groups and fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.scalars import language, trimmed

#: The values of a target's modes.
STRUCTURES = ("product_only", "product_variant")
ELIGIBILITIES = ("legacy", "all", "online_and_searchable")
FINGERPRINT = ("schema_version", "site_id", "target_id", "organization_id", "source_id", "catalog_id", "locale", "language", "structure_mode", "eligibility_mode", "mapping_profile_id")


def structure_mode(c: Column) -> Column:
    """F51."""
    v = F.lower(trimmed(c))
    return F.when(v == "", "product_only").otherwise(v)


def eligibility_mode(c: Column) -> Column:
    """F52."""
    v = F.lower(trimmed(c))
    return F.when(v == "", "legacy").otherwise(v)


def export_language(target_language: Column, locale: Column) -> Column:
    """the target's language, else that of its locale."""
    own = F.lower(trimmed(target_language))
    return F.when(own != "", own).otherwise(language(locale))


def alternates(c: Column) -> Column:
    """the alternate locales of a list, each once whatever its case, with their languages, in order."""
    parts = F.filter(F.transform(F.split(trimmed(c), r"[\r\n,;]+"), trimmed), lambda x: x != "")
    lower = F.transform(parts, F.lower)
    first = F.filter(F.transform(parts, lambda x, i: F.struct(x.alias("locale"), language(x).alias("language"), (F.array_position(lower, F.lower(x)) == i + 1).alias("first"))), lambda s: s["first"])
    return F.transform(first, lambda s: F.struct(s["locale"].alias("locale"), s["language"].alias("language")))


def normalized(targets: DataFrame) -> DataFrame:
    """Modes, language and alternate locales in their final form."""
    return targets.withColumns({
        "structure_mode": structure_mode(F.col("structure_mode")), "eligibility_mode": eligibility_mode(F.col("eligibility_mode")),
        "language": export_language(F.col("language"), F.col("locale")), "alternates": alternates(F.col("alternate_locales")),
    })


def target_errors(targets: DataFrame, profiles: DataFrame, mapped: DataFrame) -> DataFrame:
    """(target_id, error) of normalised targets. profiles: (profile_id, site_id, enabled); mapped: the
    targets' mapped fields (target_id, field)."""
    blank = lambda c: trimmed(F.col(c)) == ""
    required = [F.when(blank(c), f"missing_{c}") for c in ("site_id", "locale", "language", "organization_id", "source_id", "tracking_id", "base_url", "country", "currency")]
    checks = [
        *required, F.when(~F.col("enabled"), "disabled"), F.when(~blank("organization_id") & ~F.col("organization_id").rlike("^[A-Za-z0-9]+$"), "invalid_organization"),
        F.when(~F.col("structure_mode").isin(*STRUCTURES), "unsupported_structure"), F.when(~F.col("eligibility_mode").isin(*ELIGIBILITIES), "unsupported_eligibility"),
    ]
    own = targets.select("target_id", F.explode(F.array_compact(F.array(*checks))).alias("error"))

    each = targets.select("target_id", "locale", "language", F.explode("alternates").alias("x"))
    alone = F.array_compact(F.array(
        F.when(~F.col("x.language").rlike("^[a-z]{2,8}$"), "invalid_alternate_language"), F.when(F.lower("x.locale") == F.lower("locale"), "alternate_is_primary_locale"),
        F.when(F.col("x.language") == F.lower("language"), "alternate_has_primary_language"),
    ))
    suffixes = each.groupBy("target_id", F.col("x.language").alias("language")).agg(F.count(F.lit(1)).alias("n"))
    again = suffixes.filter("n > 1").select("target_id", F.lit("repeated_alternate_language"))
    made = suffixes.select("target_id", F.explode(F.array(*(F.concat(F.lit(f"ec_{b}_"), "language") for b in ("name", "description", "shortdesc")))).alias("field"))
    taken = mapped.select("target_id", F.lower(trimmed(F.col("field"))).alias("field")).join(made, ["target_id", "field"], "left_semi").select("target_id", F.lit("mapped_field_is_alternate"))

    owners = targets.filter(~blank("organization_id") & ~blank("source_id")).groupBy("organization_id", "source_id").agg(F.countDistinct("target_id").alias("n")).filter("n > 1")
    owned = targets.join(owners, ["organization_id", "source_id"], "left_semi").select("target_id", F.lit("source_of_several_targets"))
    trackers = targets.filter(~blank("tracking_id")).groupBy("tracking_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = targets.join(trackers, "tracking_id", "left_semi").select("target_id", F.lit("warning_shared_tracking_id"))

    named = targets.filter(~blank("mapping_profile_id")).select("target_id", F.col("site_id").alias("t_site"), F.col("mapping_profile_id").alias("profile_id"))
    found = named.join(profiles.select("profile_id", F.col("site_id").alias("p_site"), F.col("enabled").alias("p_enabled")), "profile_id", "left")
    profile = found.select("target_id", F.when(F.col("p_site").isNull(), "unknown_profile").when(~F.col("p_enabled"), "disabled_profile").when(F.col("p_site") != F.col("t_site"), "profile_of_other_site").alias("error")).filter("error is not null")
    return own.union(each.select("target_id", F.explode(alone))).union(again).union(taken).union(owned).union(shared).union(profile).distinct()


def groups(targets: DataFrame) -> DataFrame:
    """Targets by tracking id; the first by locale and id is the primary one."""
    order = F.struct("locale", "target_id")
    return targets.groupBy("tracking_id").agg(F.min(order)["target_id"].alias("primary_id"), F.array_join(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["target_id"]), ",").alias("target_ids"))


def related(targets: DataFrame, target_id: str, readable_sites: list[str]) -> DataFrame:
    """Targets that share the tracking id of the one asked for, of its own or a readable site."""
    asked = targets.filter(F.col("target_id") == target_id).select("tracking_id", F.col("site_id").alias("own_site"))
    return targets.join(asked, "tracking_id").filter((F.col("site_id") == F.col("own_site")) | F.col("site_id").isin(readable_sites)).select("target_id", "site_id", "tracking_id")


def fingerprint(targets: DataFrame) -> DataFrame:
    """The settings whose change makes a manifest useless, as canonical JSON; alternate locales only where there are some."""
    rows = targets.select("target_id", F.to_json(F.struct(*(trimmed(F.col(c).cast("string")).alias(c) for c in FINGERPRINT), F.when(F.size("alternates") > 0, F.transform("alternates", lambda x: x["locale"])).alias("alternate_locales"))).alias("fingerprint"))
    return rows


def incompatible(targets: DataFrame, stored: DataFrame) -> DataFrame:
    """Targets whose manifest was written under another fingerprint."""
    return fingerprint(targets).join(stored.select("target_id", F.col("fingerprint").alias("stored")), "target_id").filter("stored <> fingerprint").select("target_id")


def alternate_texts(documents: DataFrame, texts: DataFrame) -> DataFrame:
    """(document_id, field, value) of localised texts (root_id, language, name, description, short_description): all three on
    products, the name alone on variants; blanks are left out."""
    met = documents.join(texts, "root_id")
    product = F.col("object_type") == "Product"
    field = lambda base, on, c: F.when(on, F.struct(F.concat(F.lit(f"ec_{base}_"), "language").alias("field"), trimmed(F.col(c)).alias("value")))
    every = F.array_compact(F.array(field("name", F.lit(True), "t_name"), field("description", product, "t_description"), field("shortdesc", product, "t_short")))
    return met.select("document_id", F.explode(every).alias("f")).select("document_id", "f.*").filter("value <> ''")


def of_site(targets: DataFrame, site: str) -> DataFrame:
    """The targets (site_id, created, target_id) of one site, with their place by creation."""
    return targets.filter(F.col("site_id") == site).withColumn("place", F.row_number().over(Window.partitionBy("site_id").orderBy("created", "target_id")).cast("long"))
