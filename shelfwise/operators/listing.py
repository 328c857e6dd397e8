"""Listing pages from the category tree."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.functions.scalars import absolute_url, slug
from shelfwise.operators import generations, hierarchy
from shelfwise.sources.catalog import shared_folder


def entries(spark: SparkSession, categories: DataFrame, excluded: list[str]) -> DataFrame:
    """the online tree without excluded roots, at any depth: ids and names from the root."""
    out = [x.lower() for x in excluded]
    banned = (F.col("parent_id") == "root") & (F.lower("id").isin(out) | F.lower("name").isin(out))
    ways, _ = hierarchy.ways_up(categories.withColumn("step", F.struct("name", (F.col("online") & ~F.coalesce(banned, F.lit(False))).alias("sound"))), "step")
    sound = ways.filter((F.col("above") == "root") & F.forall("values", lambda v: F.coalesce(v["sound"], F.lit(False))))
    names = F.transform("values", lambda v: v["name"])
    return sound.select(F.col("id").alias("category_id"), F.array_join("ids", "|").alias("key_path"), names.alias("names"), F.array_join(names, "|").alias("name_path"), F.size("ids").alias("depth"))


def pages(rows: DataFrame, locales: list[tuple[str, str]]) -> DataFrame:
    """Per category one page: the patterns of all locales and one rule value per locale."""
    where = F.explode(F.array(*(F.struct(F.lit(x).alias("locale"), F.lit(base).alias("base")) for x, base in locales)))
    path = F.concat(F.lit("/"), F.array_join(F.transform("names", lambda n: slug(n)), "/"))
    each = rows.select("category_id", "key_path", "name_path", path.alias("path"), where.alias("l")).select("*", "l.locale", absolute_url(F.col("l.base"), F.col("path")).alias("url"))
    patterns = F.array_sort(F.array_distinct(F.concat(F.collect_list("url"), F.collect_list("path"))))
    return each.groupBy("key_path").agg(F.first("category_id").alias("category_id"), F.first("name_path").alias("filter_value"), F.array_join(patterns, " ").alias("patterns"), F.min("path").alias("primary_url"), F.count(F.lit(1)).alias("n_rules"))


def existing_pages(rows: DataFrame) -> DataFrame:
    """Pages read under several tracking ids (tracking_id, page_id, name, patterns), each once: by its id, else by name and first
    pattern; the first tracking id's stays."""
    known = F.coalesce(F.trim("page_id"), F.lit("")) != ""
    key = F.when(known, F.concat(F.lit("id|"), "page_id")).otherwise(F.concat(F.lit("name|"), F.coalesce("name", F.lit("")), F.lit("|"), primary_url(F.col("patterns"))))
    return rows.withColumn("key", key).groupBy("key").agg(F.min_by(F.struct("tracking_id", "page_id", "name", "patterns"), F.struct("tracking_id", "patterns", "name")).alias("p")).select("p.*")


def primary_url(patterns: Column) -> Column:
    """of patterns joined by spaces."""
    return F.coalesce(F.get(F.split(patterns, " "), F.lit(0)), F.lit(""))


def unverified(written: DataFrame, fresh: DataFrame) -> DataFrame:
    """P25: pages written (name, patterns) that a fresh read doesn't have."""
    return written.join(fresh.select("name", "patterns"), ["name", "patterns"], "left_anti")


def plan(desired: DataFrame, existing: DataFrame) -> DataFrame:
    """Matched by primary URL against any pattern, else by name; matched pages are updated. A page that more than
    one existing page matches is an error."""
    pages_by = lambda rows, key: rows.groupBy(key).agg(F.min("page_id").alias(f"least_{key}"), F.max("page_id").alias(f"most_{key}"))
    by_url = pages_by(existing.select(F.explode(F.split("patterns", " ")).alias("primary_url"), "page_id"), "primary_url")
    by_name = pages_by(existing.select(F.col("name").alias("filter_value"), "page_id"), "filter_value")
    found = desired.join(by_url, "primary_url", "left").join(by_name, "filter_value", "left")
    one = lambda key: F.when(F.col(f"least_{key}") < F.col(f"most_{key}"), F.raise_error(F.concat(F.lit("several pages match "), F.col(key))).cast("string")).otherwise(F.col(f"least_{key}"))
    page = F.when(F.col("least_primary_url").isNotNull(), one("primary_url")).otherwise(one("filter_value"))
    return found.select("key_path", page.alias("page_id")).withColumn("action", F.when(F.col("page_id").isNull(), "create").otherwise("update"))


def page_name(html: Column) -> Column:
    """A page's whole title; a page without one is named by all it holds."""
    title = F.trim(F.regexp_extract(html, "(?is)<title(?:\\s[^>]*)?>(.*?)</title\\s*>", 1))
    return F.when(title != "", title).otherwise(html)


def _stored(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def first_wins(rows: DataFrame) -> DataFrame:
    """In order, a page is skipped if an accepted one has its URL or name; skipped pages reserve nothing.

    In rounds: of the undecided pages, those that come first for both their URL and their name are accepted, those that
    share one of them with an accepted page are skipped. A site's first undecided page is always accepted, so the
    rounds end; no site, URL or name is held by one task. Missing URLs or names are equal to each other."""
    spark = rows.sparkSession
    base = f"{shared_folder(spark)}/pages-{uuid.uuid4().hex}"
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit(""))
    order = F.struct(F.col("pos").isNull().alias("late"), "pos", F.monotonically_increasing_id().alias("i"))
    rest = _stored(rows.select("site", "pos", key("site").alias("s"), key("url").alias("u"), key("name").alias("n"), order.alias("o")), f"{base}/0")
    done: DataFrame | None = None
    round_ = 0
    while not rest.isEmpty():
        round_ += 1
        marked = rest
        for k in "un":
            marked = marked.join(rest.groupBy("s", k).agg(F.min("o").alias(f"first_{k}")), ["s", k])
        accepted = _stored(marked.filter("o = first_u and o = first_n").select("site", "pos", "s", "u", "n", "o"), f"{base}/accepted-{round_}")
        for k in "un":
            rest = rest.join(accepted.select("s", k, F.lit(True).alias(f"taken_{k}")), ["s", k], "left")
        marked = _stored(rest.join(accepted.select("o", "s", F.lit(True).alias("accepted")), ["s", "o"], "left"), f"{base}/{round_}")
        # decided pages go out, so that the round's tables can
        decided = _stored(marked.filter("taken_u or taken_n").select("site", "pos", F.coalesce("accepted", F.lit(False)).alias("accepted")), f"{base}/decided-{round_}")
        for old in (f"{base}/{round_ - 1}", f"{base}/accepted-{round_}"):
            generations.removed(spark, old)
        done = decided if done is None else done.union(decided)
        rest = marked.filter("taken_u is null and taken_n is null").select("site", "pos", "s", "u", "n", "o")
    return rows.select("site", "pos", F.lit(True).alias("accepted")).limit(0) if done is None else done


def chunks(rows: DataFrame, order: str, size: int) -> DataFrame:
    """W8 per site."""
    return rows.withColumn("chunk", F.floor((F.row_number().over(Window.partitionBy("site").orderBy(order)) - 1) / size))
