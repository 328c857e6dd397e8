"""Roots, eligibility, hierarchies, prices and documents."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.functions.scalars import hierarchy_prefixes, iso_time, money, price_pair
from shelfwise.operators import hierarchy
from shelfwise.sources.catalog import shared_folder


def root_id() -> Column:
    """A variant's master, else the product itself."""
    return F.coalesce("master_id", "id")


def root_type(master: Column, variant: Column) -> Column:
    """P8."""
    return F.when(master, "master").when(variant, "variant").otherwise("standalone")


def product_type(variant: Column, master: Column, bundle: Column, product_set: Column) -> Column:
    """The first that holds; unknown is false."""
    return F.when(variant, "variant").when(master, "master").when(bundle, "bundle").when(product_set, "set").otherwise("standard")


def roots(items: DataFrame, catalog: Column | None = None) -> DataFrame:
    """Distinct roots, of one catalog if a condition is given."""
    return (items if catalog is None else items.filter(catalog)).select(root_id().alias("root_id")).distinct()


def scoped(items: DataFrame, catalogs: DataFrame, catalog_id: str) -> DataFrame:
    """S3: the products (catalog_id) of one catalog; a catalog that doesn't exist is an error."""
    if catalogs.filter(F.col("catalog_id") == catalog_id).isEmpty():
        raise ValueError(f"the target's catalog {catalog_id} does not exist")
    return items.filter(F.col("catalog_id") == catalog_id)


def scan(items: DataFrame, masters: DataFrame, delta: bool, since: str | None = None, catalogs: DataFrame | None = None, catalog_id: str = "", purchased: DataFrame | None = None) -> DataFrame:
    """The roots that a run looks at: of the target's catalog where it names one, else of all; a delta run only those changed since, and with
    them those whose purchases changed (S5)."""
    here = scoped(items, catalogs, catalog_id) if catalog_id and catalogs is not None else items
    if not delta:
        return roots(here)
    if since is None:
        raise ValueError("a delta run needs the time of the run before")
    changed = modified_roots(here, masters, since)
    return changed if purchased is None else merged_roots(changed, purchased)


def modified_roots(items: DataFrame, masters: DataFrame, since: str) -> DataFrame:
    """Product or master modified, or product created, at the time or later; not the master's creation."""
    t = F.lit(since).cast("timestamp_ntz")
    joined = items.join(masters.select(F.col("id").alias("master_id"), F.col("modified").alias("m_modified")), "master_id", "left")
    return joined.filter((F.col("modified") >= t) | (F.col("created") >= t) | (F.col("m_modified") >= t)).select(root_id().alias("root_id")).distinct()


def merged_roots(base: DataFrame, extra: DataFrame) -> DataFrame:
    """S5, X1."""
    return base.union(extra).filter("root_id <> ''").distinct()


def with_eligibility(items: DataFrame, masters: DataFrame, mode: str = "online_and_searchable") -> DataFrame:
    """Online and searchable, and so is the master if there is one; in the other modes every product."""
    if mode.strip().lower() != "online_and_searchable":
        return items.withColumn("eligible", F.lit(True))
    m = masters.select(F.col("id").alias("master_id"), (F.col("online") & F.col("searchable")).alias("master_ok"))
    return items.join(m, "master_id", "left").withColumn("eligible", F.col("online") & F.col("searchable") & F.coalesce("master_ok", F.lit(True)))


def root_books(books: DataFrame) -> DataFrame:
    """(book_id, root_book) of books (book_id, parent_id); a book whose parent is not there is a top one, books in a circle are an error."""
    return hierarchy.tops(books.select(F.col("book_id").alias("id"), "parent_id")).select(F.col("id").alias("book_id"), F.col("top").alias("root_book"))


def book_prices(items: DataFrame, amounts: DataFrame, books: DataFrame) -> DataFrame:
    """(id, price, promo_price) of items (id, book_id, price, least, most); the sales price is the first of price,
    least and most, the base price that of the book's root (amounts: product_id, book_id, amount), else most."""
    top = items.join(root_books(books), "book_id", "left").join(amounts.select(F.col("product_id").alias("id"), F.col("book_id").alias("root_book"), "amount"), ["id", "root_book"], "left")
    price, promo = price_pair(F.coalesce("price", "least", "most"), F.coalesce("amount", "most"))
    return top.select("id", money(price).alias("price"), money(promo).alias("promo_price"))


def category_paths(spark: SparkSession, categories: DataFrame) -> DataFrame:
    """Root-to-leaf names per category, at any depth; an ancestor that is offline, unnamed or its own ancestor voids the path."""
    sound = F.col("online") & (F.coalesce("name", F.lit("")) != "")
    ways, _ = hierarchy.ways_up(categories.withColumn("step", F.struct("name", sound.alias("sound"))), "step")
    return ways.filter((F.col("above") == "root") & F.forall("values", lambda v: F.coalesce(v["sound"], F.lit(False)))).select(F.col("id").alias("category_id"), F.transform("values", lambda v: v["name"]).alias("path"))


def adjacent_roots(hits: DataFrame) -> DataFrame:
    """(pos, root_id) of hits (pos, root_id) in order of pos, without blank roots and without those that equal the one before.

    Hits lie in ranges of pos; the last root of each range is handed to the next, a row for each range."""
    spark = hits.sparkSession
    at = f"{shared_folder(spark)}/hits-{uuid.uuid4().hex}"
    ranged = hits.filter("root_id <> ''").select("pos", "root_id").repartitionByRange("pos").withColumn("range", F.spark_partition_id())
    ranged.write.parquet(at)  # what range a hit is in must not change
    rows = spark.read.schema(ranged.schema).parquet(at)
    lasts = rows.groupBy("range").agg(F.max_by("root_id", "pos").alias("last"))
    handed = lasts.select("range", F.lag("last").over(Window.orderBy("range")).alias("handed"))
    before = rows.withColumn("before", F.lag("root_id").over(Window.partitionBy("range").orderBy("pos"))).join(F.broadcast(handed), "range")
    return before.filter("not root_id <=> coalesce(before, handed)").select("pos", "root_id")


def product_categories(assigned: DataFrame, paths: DataFrame) -> DataFrame:
    """A product's hierarchy values in the order of its categories, the primary first, and the primary's own."""
    rows = assigned.join(paths, "category_id").select("product_id", F.struct((~F.col("is_primary")).alias("o"), "pos", hierarchy_prefixes(F.col("path")).alias("v")).alias("c"), "is_primary")
    own = rows.groupBy("product_id").agg(F.array_sort(F.collect_list("c")).alias("cs"), F.max(F.when(F.col("is_primary"), F.array_join("c.v", ";"))).alias("p"))
    values = F.array_distinct(F.flatten(F.transform("cs", lambda c: c["v"])))
    return own.select("product_id", F.array_join(values, ";").alias("hierarchies"), F.coalesce("p", F.lit("")).alias("primary_hierarchy"))


def prices(items: DataFrame) -> DataFrame:
    """The sale book's parent is the list book, so the base is the list price."""
    price, promo = price_pair(F.coalesce("sale_price", "list_price"), F.col("list_price"))
    return items.select("id", money(price).alias("price"), money(promo).alias("promo_price"))


def color_key() -> Column:
    """A variant's colour, else the product's own id."""
    return F.when(F.col("is_variant") & (F.coalesce("color", F.lit("")) != ""), F.col("color")).otherwise(F.col("id"))


def documents_product_only(eligible: DataFrame) -> DataFrame:
    """One document per eligible variant or standalone product."""
    rows = eligible.filter("eligible")
    group = F.when(F.col("is_variant"), F.concat_ws("-", "master_id", color_key())).otherwise(F.col("id"))
    price, promo = price_pair(F.coalesce("sale_price", "list_price"), F.col("list_price"))
    return rows.select(F.concat(F.lit("product://pid="), "id").alias("document_id"), root_id().alias("root_id"), group.alias("group_id"), F.lit("Product").alias("object_type"), "name", "brand", money(price).alias("price"), money(promo).alias("promo_price"), "color", "size")


def documents_product_variant(eligible: DataFrame) -> DataFrame:
    """A Product per colour group, from its first eligible variant, and a Variant per variant; one Product per standalone."""
    rows = eligible.filter("eligible").withColumn("group_key", color_key())
    w = Window.partitionBy("master_id", "group_key").orderBy("key")
    ranked = rows.withColumn("lead", F.first("id").over(w)).withColumn("n", F.row_number().over(w))
    product = F.concat(F.lit("product://pid="), "lead")
    group = F.when(F.col("is_variant"), F.concat_ws("-", "master_id", "group_key")).otherwise(F.col("id"))
    groups = ranked.filter("n = 1").select(product.alias("document_id"), F.lit("Product").alias("object_type"), root_id().alias("root_id"), group.alias("group_id"), F.lit(None).cast("string").alias("parent_id"))
    variants = ranked.filter("is_variant").select(F.concat(F.lit("product://pid=s"), "id"), F.lit("Variant"), root_id(), group, product)
    return groups.union(variants)


def descriptors(eligible: DataFrame, masters: DataFrame, structure: str = "product_only", mode: str = "online_and_searchable") -> DataFrame:
    """Per root the last modification to the millisecond, three signatures and the documents of eligible products.

    A root's records are its own, its master's and those of all variants, each in its role: a master is the root of its variants and their master."""
    variant = F.col("is_variant")
    own = eligible.select(root_id().alias("root_id"), F.when(variant, "variant").otherwise("root").alias("role"), "id", F.coalesce("master_id", F.lit("")).alias("master_id"), F.lit(False).alias("master"), variant.alias("variant"), "online", "searchable", "eligible", "created", "modified")
    roots_of = masters.join(eligible.select("master_id").distinct(), masters["id"] == F.col("master_id"), "left_semi")
    sound = F.col("online") & F.col("searchable") if mode.strip().lower() == "online_and_searchable" else F.lit(True)
    above = roots_of.select(F.col("id").alias("root_id"), F.explode(F.array(F.lit("root"), F.lit("master"))).alias("role"), "id", F.lit("").alias("master_id"), F.lit(True).alias("master"), F.lit(False).alias("variant"), "online", "searchable", sound.alias("eligible"), "created", "modified")
    text = lambda *c: F.concat_ws("|", *(F.col(x).cast("string") for x in c))
    rows = own.union(above).select("root_id", "role", "id", "master_id", "master", "eligible", "created", "modified", text("role", "id", "master_id", "master", "variant").alias("r"), text("id", "master_id", "online", "searchable").alias("e"))
    rows = rows.withColumn("m", F.concat_ws("|", "r", iso_time(F.col("created")), iso_time(F.col("modified"))))
    listed = lambda *c: F.array_sort(F.collect_list(F.struct(*c)))
    item = F.when(F.col("eligible") & ~F.col("master"), F.col("id"))
    found = rows.groupBy("root_id").agg(
        F.max(F.greatest("created", "modified")).alias("last"), listed("role", "id", "m").alias("ms"), listed("id", "master_id", "role", "e").alias("es"), F.max(F.when(F.col("role") == "root", F.col("eligible"))).alias("sound"),
        F.max("master").alias("master"), F.array_sort(F.collect_set(item)).alias("ids"),
    )
    head = F.concat_ws("|", F.lit("1"), "root_id", F.when(F.col("master"), "master").otherwise("standalone"))
    state = F.concat_ws("|", head, F.lit(structure), F.lit(mode), F.col("sound").cast("string"), F.array_join("ids", ","))
    digest = lambda first, rest: F.sha2(F.array_join(F.concat(F.array(first), rest), "\u0001"), 256)
    documents = F.transform("ids", lambda i: F.concat(F.lit("product://pid="), i))
    return found.select(
        "root_id", iso_time(F.col("last")).alias("modified_at"), digest(head, F.transform("ms", lambda x: x["m"])).alias("modification_signature"), digest(state, F.transform("es", lambda x: x["e"])).alias("eligibility_signature"),
        digest(state, documents).alias("ownership_signature"), documents.alias("document_ids"),
    )


def payload_checksums(documents: DataFrame) -> DataFrame:
    """Over the root's documents in order, from canonical text."""
    text = F.concat_ws("|", "document_id", "name", "brand", F.coalesce(F.round(F.col("price") * 100).cast("long").cast("string"), F.lit("")), F.coalesce(F.round(F.col("promo_price") * 100).cast("long").cast("string"), F.lit("")))
    return documents.groupBy("root_id").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(text)), "\n"), 256).alias("payload_checksum"), F.count(F.lit(1)).alias("n_documents"))
