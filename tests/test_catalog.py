"""Small cases of the catalog operators."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import scalars as s
from shelfwise.operators import attributes, catalog, listing, purchases, reconcile
from shelfwise.plans.queries import QUERIES


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double'}" for k, v in values.items())).select(column).first()[0]


def test_scalars(spark):
    assert one(spark, s.slug(F.col("x")), x="Food & Tréats — l'Été") == "food-and-treats-lete"
    assert one(spark, s.html_document(F.col("x")), x="a") == "<html><body>a</body></html>"
    assert one(spark, s.html_document(F.col("x")), x="<HTML >a") == "<HTML >a"
    assert one(spark, s.alias_suffix(F.col("x")), x="group-1234-2000999") == "2000999"
    assert one(spark, s.alias_suffix(F.col("x")), x="-5") is None
    assert [one(spark, s.quantity(F.col("x")), x=v) for v in ("2", "0.4", "1e3", "5d", "NaN", "", "-1", "2.5")] == [2, 0, 1000, None, None, None, None, 3]
    assert one(spark, s.language(F.col("x")), x="en_CA") == "en"
    assert one(spark, s.absolute_url(F.lit("https://a.example/"), F.col("x")), x="/cat/x") == "https://a.example/cat/x"
    assert one(spark, s.relative_url(F.col("x")), x="https://a.example/cat/x") == "/cat/x"
    assert one(spark, s.trimmed(F.col("x")), x="  a ") == "a"
    assert one(spark, s.sort_order(F.col("x")), x="12abc") == 12


def test_purchase_rows(spark):
    rows = spark.createDataFrame([("sku-1", "2"), ("sku-1", "3"), ("sku-2", "1"), ("", "4"), ("sku-3", ""), ("", "")], "product_id string, quantity string")
    assert {tuple(r) for r in purchases.totals(rows).collect()} == {("sku-1", 5), ("sku-2", 1)}
    assert {tuple(r) for r in purchases.counters(rows).collect()} == {("processed", 3), ("blank", 1), ("invalid", 1), ("skipped", 1)}


def test_state_difference_and_advance(spark):
    schema = "product_id string, root_id string, document_id string, units_sold long"
    now = spark.createDataFrame([("a", "r1", "d1", 2), ("b", "r2", "d2", 1), ("c", "r3", "d3", 1)], schema)
    old = spark.createDataFrame([("a", "r1", "d1", 1), ("b", "r2", "d2", 1), ("z", "r9", "d9", 1)], schema)
    changed = purchases.changed_roots(now, old)
    assert {r[0] for r in changed.collect()} == {"r1", "r3", "r9"}
    after = purchases.advanced(now, old, changed)
    assert sorted(map(tuple, after.collect())) == sorted(map(tuple, now.collect()))


def reasons(spark, deep=False):
    schema = "root_id string, modification_signature string, eligibility_signature string, ownership_signature string, document_ids array<string>"
    now = spark.createDataFrame([("KEEP", "m", "e", "o", ["k"]), ("CHANGE", "m2", "e", "o", ["c"]), ("NEW", "m", "e", "o", ["n", "moved"]), ("OFF", "m", "e2", "o", [])], schema)
    old = spark.createDataFrame([("KEEP", "m", "e", "o", ["k"]), ("CHANGE", "m", "e", "o", ["c"]), ("OFF", "m", "e", "o", ["offline"]), ("DELETED", "m", "e", "o", ["deleted", "moved"])], schema)
    return reconcile.dirty_reasons(now, old, spark.createDataFrame([], "root_id string"), deep)


def test_reconcile(spark):
    r = reasons(spark)
    assert {x["root_id"]: x["reason"] for x in r.collect()} == {"KEEP": "clean", "CHANGE": "modified", "NEW": "new", "OFF": "eligibilityOwnership", "DELETED": "removed"}
    # a document that moved to another root is not deleted
    assert {tuple(x) for x in reconcile.operations(r).collect()} == {("addOrUpdate", "c"), ("addOrUpdate", "n"), ("addOrUpdate", "moved"), ("delete", "offline"), ("delete", "deleted")}
    assert {x["reason"] for x in reasons(spark, deep=True).collect()} == {"forced", "removed"}


def test_batches(spark):
    rows = spark.createDataFrame([("r", f"d{i:04d}", 1) for i in range(1001)], "root_id string, document_id string, cost long")
    sizes = [r["count"] for r in reconcile.greedy_batches(rows, "root_id", "document_id", "cost", 10**9, 1000).groupBy("batch").count().orderBy("batch").collect()]
    assert sizes == [1000, 1]


def test_first_wins_skipped_pages_reserve_nothing(spark):
    rows = spark.createDataFrame([("s", 1, "u1", "a"), ("s", 2, "u1", "b"), ("s", 3, "u3", "b")], "site string, pos long, url string, name string")
    assert {r["pos"]: r["accepted"] for r in listing.first_wins(rows).collect()} == {1: True, 2: False, 3: True}


def in_order(rows):
    taken, out = set(), {}
    for site, pos, url, name in sorted(rows, key=lambda r: r[1]):
        keys = {(site, "u", url), (site, "n", name)}
        out[pos] = not keys & taken
        taken |= keys if out[pos] else set()
    return out


def test_first_wins_in_rounds_is_the_sequential_rule(spark):
    r = random.Random(3)
    rows = [(r.choice("st"), i, r.choice([None, *"abcdefghijkl"]), r.choice([None, *"mnopqrstuvwx"])) for i in range(150)]
    rows += [("chain", 1000 + i, f"u{(i + 1) // 2}", f"n{i // 2}") for i in range(9)]
    got = listing.first_wins(spark.createDataFrame(rows, "site string, pos long, url string, name string"))
    assert {x["pos"]: x["accepted"] for x in got.collect()} == in_order(rows) and got.count() == len(rows)
    assert listing.first_wins(spark.createDataFrame([], "site string, pos long, url string, name string")).count() == 0


def test_listing_dedupe_names_pages_by_title_and_site_by_host(spark):
    assert one(spark, listing.page_name(F.col("x")), x="<html><head><TITLE lang=en> A b\n</TITLE><title>c</title>") == "A b\n".strip(" ")
    assert one(spark, listing.page_name(F.col("x")), x="<html><p>no title") == "<html><p>no title"
    sf = "/root/testdata/sf0.001"
    pages = [(re.match(r"[a-z]+://([^/?#]*)", x["url"])[1], x["page_id"], x["url"], re.search(r"(?is)<title[^>]*>(.*?)</title>", x["html"])[1].strip(" ")) for x in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    got = {x["pos"]: x["accepted"] for x in QUERIES["listing_dedupe"](spark, sf).collect()}
    assert got == in_order(pages) and sum(got.values()) > 32


def test_every_reserved_target_is_an_error(spark):
    names = "documentId FileExtension model language permanentid ec_product_id ec_images ec_thumbnails ec_swatch ec_price ec_promo_price ec_category ec_primary_category objecttype ec_rating ec_brand ec_description ec_shortdesc ec_color ec_size ec_item_group_id ec_sku ec_variant_id ec_name".split()
    rows = [(n, True, "color", "raw", n.upper()) for n in names] + [("free", True, "color", "raw", "x_free")]
    got = attributes.mapping_errors(spark.createDataFrame(rows, "mapping_id string, enabled boolean, source_attribute string, value_mode string, target_field string"))
    assert len(names) == 24 and {tuple(x) for x in got.collect()} == {(n, "reserved_target") for n in names}


def test_root_and_product_types(spark):
    rows = spark.createDataFrame([(True, True, None, None), (None, True, True, True), (False, False, True, True), (False, None, False, True), (False, False, False, False)], "v boolean, m boolean, b boolean, s boolean")
    got = rows.select(catalog.root_type(F.col("m"), F.col("v")), catalog.product_type(F.col("v"), F.col("m"), F.col("b"), F.col("s"))).collect()
    assert [tuple(x) for x in got] == [("master", "variant"), ("master", "master"), ("standalone", "bundle"), ("standalone", "set"), ("standalone", "standard")]


def test_item_errors(spark):
    schema = "pos long, legacy_product_id string, document_id string, language string, object_type string, product_id string, variant_id string, permanent_id string"
    rows = [
        (0, None, "d", "EN", "Product", "p", None, "p"), (1, "x", "", None, "Product", "q", None, "other"), (2, None, "d", "fr", "Product", "", None, None),
        (3, None, "d", "en", "Variant", "p", "v", "v"), (4, None, "d", "en", "Variant", "p", "v", "v"), (5, None, "d", "en", "Variant", "q", "", None), (6, None, "d", "en", "Variant", None, "v", "w"),
    ]
    items = spark.createDataFrame(rows, schema)
    common = {(1, "legacy_product_id"), (1, "missing_document_id"), (1, "missing_language"), (2, "wrong_language"), (1, "permanent_id_not_product_id"), (2, "missing_product_id")}
    assert sorted(map(tuple, reconcile.item_errors(items, "en").collect())) == sorted(common | {(i, "variant_in_product_only") for i in (3, 4, 5, 6)})
    more = {(4, "duplicate_variant_id"), (5, "missing_variant_id"), (5, "missing_parent"), (6, "missing_product_id"), (6, "permanent_id_not_variant_id")}
    assert sorted(map(tuple, reconcile.item_errors(items, "en", "product_variant").collect())) == sorted(common | more)


def test_aliases_of_products_and_variants(spark):
    documents = spark.createDataFrame([("r", "d1", "s-12", "k1"), ("r", "d2", "-5", None)], "root_id string, document_id string, product_id string, sku string")
    variants = spark.createDataFrame([("s-12", "v1", "m1"), ("none", "v2", "m2")], "product_id string, variant_id string, permanent_id string")
    alias = purchases.aliases(documents, variants)
    assert {(x["product_id"], x["document_id"]) for x in alias.collect()} == {("s-12", "d1"), ("12", "d1"), ("k1", "d1"), ("v1", "d1"), ("m1", "d1"), ("-5", "d2")}
    counts = spark.createDataFrame([("12", 3), ("v1", 2), ("zz", 9)], "product_id string, units_sold long")
    assert {tuple(x) for x in purchases.mapped(counts, alias).collect()} == {("12", "r", "d1", 3), ("v1", "r", "d1", 2)}
    both = alias.union(spark.createDataFrame([("12", "r2", "d9"), ("unsold", "r", "d1"), ("unsold", "r", "d2")], "product_id string, root_id string, document_id string"))
    with pytest.raises(Exception, match="multiple documents for alias 12"):
        purchases.mapped(counts, both).collect()


def test_upsert(spark):
    schema = "mapping_id string, target_field string"
    new, old = spark.createDataFrame([("a", "x"), ("b", "y")], schema), spark.createDataFrame([("b", "z"), ("c", "w")], schema)
    assert {tuple(r) for r in attributes.upserted(new, old).collect()} == {("a", "x", "created"), ("b", "y", "updated"), ("c", "w", "kept")}
    assert {tuple(r) for r in attributes.upserted(new, old, replace=True).collect()} == {("a", "x", "created"), ("b", "y", "updated")}


def test_empty_tables(spark):
    rows = spark.createDataFrame([], "product_id string, quantity string")
    assert purchases.totals(rows).collect() == []


def test_prices_at_half_a_cent_are_those_of_sql(spark):
    import duckdb

    rows = spark.range(100_000).select(F.col("id").cast("string").alias("id"), ((90_000 + F.col("id") / 2) / 100).cast("double").alias("list_price"), F.lit(0.05).alias("discount"))
    rows = rows.withColumn("list_price", F.floor(F.col("list_price") * 100) / 100).withColumn("sale_price", F.col("list_price") * (1 - F.col("discount")))
    found = catalog.prices(rows).toPandas()
    given = rows.select("id", "sale_price").toPandas()
    expected = duckdb.sql("SELECT g.id, f.promo_price AS found, round(g.sale_price, 2) AS expected FROM given g JOIN found f ON f.id = g.id WHERE found IS DISTINCT FROM expected").fetchall()
    assert len(found) == len(given) and expected == []
