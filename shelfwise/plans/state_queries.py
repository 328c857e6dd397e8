"""Queries of runs and what they leave behind: generations, publications, payload gates, uploads, the index; each with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import catalog, generations, packing, purchases, reconcile, state, uploads
from shelfwise.plans import config_queries as config
from shelfwise.plans import queries as base
from shelfwise.plans.queries import query
from shelfwise.plans.sql import CATALOG, DESCRIPTORS, DOCUMENTS, PURCHASES, STATE, _with
from shelfwise.sources import catalog as source
from shelfwise.sources.catalog import shared_folder, table

SQL: dict[str, str] = {}


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/runs-{uuid.uuid4().hex}"


def _kept(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The rows, written to shared storage and read back: what several outputs need is made once."""
    at = _folder(spark)
    rows.write.parquet(at)
    return spark.read.schema(rows.schema).parquet(at)


def _number(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("long")


@query
def delta_payload_gate(spark: SparkSession, d: str) -> DataFrame:
    """A12 in J8, J9: the last manifest is in storage, with checksums; dirty roots whose payload is what was sent last send nothing."""
    at, current, docs = _folder(spark), base._descriptors(spark, d), base.documents_product_only(spark, d)
    sent = catalog.payload_checksums(docs).select("root_id", F.when(_number(F.col("root_id")) % 3 == 0, "other").otherwise(F.col("payload_checksum")).alias("sent"))
    previous = reconcile.previous_manifest(current).join(sent, "root_id", "left")
    state.write_manifest(previous.select("root_id", *reconcile.SIGNATURES, "document_ids", F.coalesce("sent", F.sha2(F.lit(""), 256)).alias("payload_checksum")), at, "1", "2026-01-01T00:00:00.000Z")
    reasons = reconcile.dirty_reasons(current, state.read_manifest(spark, at), base._touched(spark, d))
    dirty = reasons.filter("reason not in ('clean', 'removed')").select("root_id")
    judged = reconcile.with_checksums(reasons, catalog.payload_checksums(docs.join(dirty, "root_id", "left_semi")))
    return reconcile.gated_operations(judged, current.select(F.explode("document_ids").alias("document_id")))


_PAID = """x AS (SELECT root_id, concat_ws('|', document_id, name, brand, coalesce(round(price * 100)::BIGINT::VARCHAR, ''), coalesce(round(promo_price * 100)::BIGINT::VARCHAR, '')) AS s FROM d),
paid AS (SELECT root_id, sha256(string_agg(s, chr(10) ORDER BY s)) AS now_, CASE WHEN ('0x' || substr(md5(root_id), 1, 6))::BIGINT % 3 = 0 THEN 'other' ELSE sha256(string_agg(s, chr(10) ORDER BY s)) END AS sent FROM x GROUP BY root_id),
"""
SQL["delta_payload_gate"] = _with(CATALOG + DOCUMENTS + DESCRIPTORS + _PAID, """SELECT DISTINCT 'addOrUpdate' AS op, unnest(document_ids) AS document_id FROM why LEFT JOIN paid USING (root_id)
    WHERE reason NOT IN ('clean', 'removed') AND (root_id NOT IN (SELECT root_id FROM prev) OR coalesce(now_, sha256('')) <> coalesce(sent, sha256(''))) UNION ALL SELECT op, document_id FROM ops WHERE op = 'delete'""")


@query
def generation_runs(spark: SparkSession, d: str) -> DataFrame:
    """What a reader finds after a deep run, one that is aborted, one whose roots changed meanwhile, a fast and another deep one."""
    at, rows = _folder(spark), base._descriptors(spark, d)
    generations.stage(generations.Run(f"{at}/source", "1", None), "rows", rows)
    rows = spark.read.schema(rows.schema).parquet(generations.Run(f"{at}/source", "1", None).path("rows"))
    seen: list[tuple] = []

    def look(step: str, outcome: str) -> None:
        record, totals = generations.active(spark, at), state.run_totals(state.read_manifest(spark, at)).first()
        seen.append((step, outcome, record["mode"], record["last_deep"], totals["n_roots"], totals["n_documents"], state.high_water(spark, at)))

    state.write_manifest(rows, at, "1", "s1", "deep", "c1")
    look("1 deep", "promoted")
    run = generations.begin(spark, at, "deep", "s2", "2")
    generations.stage(run, "manifest", rows.limit(0))
    look("2 deep", "aborted" if generations.abort(spark, run) else "nothing")
    changed = rows.withColumn("modification_signature", F.lit("later"))
    try:
        state.write_manifest(rows.limit(0), at, "3", "s3", "deep", "c3", check=lambda _: reconcile.assert_stable(rows, changed, rows))
    except ValueError:
        look("3 deep", "failed")
    state.write_manifest(rows.filter("length(root_id) % 2 = 0"), at, "4", "s4", "fast", "c4")
    look("4 fast", "promoted")
    state.write_manifest(rows.filter("length(root_id) % 2 = 1"), at, "5", "s5", "deep", "c5")
    look("5 deep", "promoted")
    return spark.createDataFrame(seen, "step string, outcome string, mode string, last_deep string, n_roots long, n_documents long, high_water string")


SQL["generation_runs"] = _with(CATALOG + DESCRIPTORS, """, runs(step, outcome, mode, last_deep, low, high, high_water) AS (VALUES ('1 deep', 'promoted', 'deep', 'c1', 0, 1, 's1'), ('2 deep', 'aborted', 'deep', 'c1', 0, 1, 's1'),
        ('3 deep', 'failed', 'deep', 'c1', 0, 1, 's1'), ('4 fast', 'promoted', 'fast', 'c1', 0, 0, 's4'), ('5 deep', 'promoted', 'deep', 'c5', 1, 1, 's5'))
    SELECT step, outcome, mode, last_deep, count(root_id) AS n_roots, coalesce(sum(len(document_ids)), 0)::BIGINT AS n_documents, high_water FROM runs LEFT JOIN sig ON length(root_id) % 2 BETWEEN low AND high GROUP BY ALL""".lstrip())


@query
def published_metrics(spark: SparkSession, d: str) -> DataFrame:
    """A snapshot and a target's state that are published together; a second publication fails when its outputs are
    written, and readers find the first one."""
    at = _folder(spark)
    alias = _kept(spark, purchases.aliases(base.documents_product_only(spark, d)))
    counts = _kept(spark, base.purchase_totals(spark, d))
    mapped, skipped = purchases.mapped(counts, alias), purchases.skipped(counts, alias)
    state.publish_metrics(counts, mapped, skipped, at, "tr1", 30, "2001-01-01", "en")

    def refuse(run: generations.Run) -> None:
        raise ValueError(f"refused after both outputs of {run.generation}")

    try:
        state.publish_metrics(counts.withColumn("units_sold", F.col("units_sold") + 1), mapped.limit(0), skipped, at, "tr1", 30, "2001-01-02", "en", check=refuse)
        raise AssertionError("published")
    except ValueError:
        generations.sweep(spark, at)
    snapshot = state.read_snapshots(spark, at, "tr1").select(F.concat(F.lit("snapshot "), "taken").alias("part"), "product_id", "units_sold")
    summary = state.target_summary(spark, at, "en").select(F.lit("summary").alias("part"), F.col("n_skipped").cast("string").alias("product_id"), F.col("n_mapped").alias("units_sold"))
    parts = [state.read_target_state(spark, at, "current", "en").select(F.lit("current").alias("part"), "product_id", "units_sold"), state.advance_full(spark, at, "en").select(F.lit("applied").alias("part"), "product_id", "units_sold")]
    return snapshot.union(summary).union(parts[0]).union(parts[1])


SQL["published_metrics"] = _with(CATALOG + DOCUMENTS + PURCHASES + STATE, """SELECT 'snapshot 2001-01-01' AS part, product_id, units_sold FROM n UNION ALL SELECT unnest(['current', 'applied']), product_id, units_sold FROM now_
    UNION ALL SELECT 'summary', (SELECT count(*) FROM n WHERE 'product://pid=' || product_id NOT IN (SELECT document_id FROM d))::VARCHAR, (SELECT count(*) FROM now_)""")


@query
def unstable_roots(spark: SparkSession, d: str) -> DataFrame:
    """The roots are read twice around their generation; some changed meanwhile, some made other documents."""
    before, k = base._descriptors(spark, d), _number(F.col("root_id"))
    new = before.filter(k % 37 == 0).withColumn("root_id", F.concat(F.lit("NEW-"), "root_id"))
    after = before.filter(k % 29 != 0).withColumn("modification_signature", F.when(k % 23 == 0, "later").otherwise(F.col("modification_signature"))).union(new)
    made = base.documents_product_only(spark, d).filter(k % 31 != 0).groupBy("root_id").agg(F.collect_list("document_id").alias("document_ids"))
    return reconcile.unstable_roots(before, after, made)


SQL["unstable_roots"] = _with(CATALOG + DESCRIPTORS, """SELECT * FROM (SELECT root_id, CASE WHEN k % 29 = 0 THEN 'disappeared' WHEN k % 23 = 0 THEN 'modification_signature differs' WHEN k % 31 = 0 AND len(document_ids) > 0 THEN 'other documents' END AS problem FROM h
    UNION ALL SELECT 'NEW-' || root_id, 'appeared' FROM h WHERE k % 37 = 0) WHERE problem IS NOT NULL""")


@query
def uploads_in_order(spark: SparkSession, d: str) -> DataFrame:
    """The batches of all roots in one order, then the deletes, packed into uploads over blocks of 64 rows."""
    items = config._batch_items(spark, d)
    costs = packing.root_batches(items, 4, 2000).join(items.select("root_id", "document_id", packing.estimated_bytes(F.col("payload")).alias("cost")), ["root_id", "document_id"])
    batches = costs.groupBy("root_id", "parent", "batch").agg(F.count(F.lit(1)).alias("n_items"), (90 + F.sum("cost") + 3 * (F.count(F.lit(1)) - 1)).alias("n_bytes"))
    deletes = reconcile.operations(base._reasons(spark, d)).filter("op = 'delete'").select("document_id")
    return uploads.delta_uploads(batches, deletes, ["root_id", "parent", "batch"], 20, 6000, 64)


SQL["uploads_in_order"] = _with("RECURSIVE " + CATALOG.lstrip() + config.VARIANT_DOCS + config._PACKED + DESCRIPTORS, """, ba AS (SELECT o.root_id, o.parent, o.batch, count(*) AS n, 90 + sum(cost)::BIGINT + 3 * (count(*) - 1) AS size FROM out_ o JOIN it ON it.root_id = o.root_id AND it.did = o.document_id GROUP BY ALL),
    al AS (SELECT 0 AS late, root_id, parent, batch, NULL::VARCHAR AS document_id, n, size FROM ba UNION ALL SELECT 1, NULL, NULL, NULL, document_id::VARCHAR, 1, 3 * (length(document_id) + 2) FROM ops WHERE op = 'delete'),
    od AS (SELECT *, row_number() OVER (ORDER BY late, root_id, parent, batch, document_id) AS i FROM al),
    up AS (SELECT i, 0::BIGINT AS upload, n, size FROM od WHERE i = 1 UNION ALL
        SELECT od.i, up.upload + CASE WHEN up.n + od.n > 20 OR up.size + od.size > 6000 THEN 1 ELSE 0 END, CASE WHEN up.n + od.n > 20 OR up.size + od.size > 6000 THEN od.n ELSE up.n + od.n END, CASE WHEN up.n + od.n > 20 OR up.size + od.size > 6000 THEN od.size ELSE up.size + od.size END
        FROM up JOIN od ON od.i = up.i + 1)
    SELECT root_id, parent, batch, document_id, od.n::BIGINT AS n_items, od.size::BIGINT AS n_bytes, upload FROM od JOIN up USING (i)""".lstrip())


@query
def index_after_runs(spark: SparkSession, d: str) -> DataFrame:
    """A full run, a delta, a full run that leaves nothing older, another delta, and what the index then holds."""
    at, k = f"{_folder(spark)}/index", F.substring("document_id", 16, 20).cast("long")
    docs = base.documents_product_only(spark, d).select("document_id").withColumn("k", k)

    def ops(rows: DataFrame, by: int, item: str, deletes: bool) -> DataFrame:
        gone = (F.col("k") % 2 == 0) & F.lit(deletes)
        return rows.select((F.col("k") % by).alias("upload"), "document_id", F.when(gone, "delete").otherwise("addOrUpdate").alias("op"), F.when(~gone, F.lit(item)).alias("item"))

    uploads.full_run(spark, at, ops(docs.filter("k % 2 = 0"), 5, "1", False))
    uploads.push(spark, at, ops(docs.filter("k % 3 = 0"), 4, "2", True))
    uploads.full_run(spark, at, ops(docs.filter("k % 5 <> 0"), 3, "3", False))
    uploads.push(spark, at, ops(docs.filter("k % 7 <> 0 and k % 3 <> 1"), 2, "4", True))
    return uploads.index(spark, at)


SQL["index_after_runs"] = _with(CATALOG + DOCUMENTS, """, k AS (SELECT document_id, substr(document_id, 16)::BIGINT AS k FROM d),
    st AS (SELECT 1 + max(k % 5) FILTER (WHERE k % 2 = 0) + 1 AS a, max(k % 4) FILTER (WHERE k % 3 = 0) + 1 AS b, max(k % 3) FILTER (WHERE k % 5 <> 0) + 1 AS c FROM k),
    op AS (SELECT document_id, a + b + k % 3 AS o, '3' AS item, false AS gone FROM k, st WHERE k % 5 <> 0 UNION ALL SELECT document_id, a + b + c + k % 2, '4', k % 2 = 0 FROM k, st WHERE k % 7 <> 0 AND k % 3 <> 1)
    SELECT document_id, o::BIGINT AS ordering_id, item FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY o DESC) AS r FROM op) WHERE r = 1 AND NOT gone""".lstrip())


@query
def roots_in_scan_order(spark: SparkSession, d: str) -> DataFrame:
    """Order lines as search hits; a root is dropped if the hit before it has the same one."""
    hits = table(spark, d, "lineitem").select(F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("pos"), F.concat(F.lit("P"), "l_partkey").alias("id"))
    return catalog.adjacent_roots(hits.join(source.products(spark, d).select("id", catalog.root_id().alias("root_id")), "id")).select("pos.*", "root_id")


SQL["roots_in_scan_order"] = _with(CATALOG, """SELECT l_orderkey, l_linenumber, l_partkey, root_id FROM (SELECT l_orderkey, l_linenumber, l_partkey, root_id, lag(root_id) OVER (ORDER BY l_orderkey, l_linenumber, l_partkey) AS before FROM lineitem JOIN e ON id = 'P' || l_partkey)
    WHERE before IS DISTINCT FROM root_id""")


@query
def payload_files(spark: SparkSession, d: str) -> DataFrame:
    """K1: the operations of a delta run, one validated JSON document for each batch, read back from the files."""
    at, ops = f"{_folder(spark)}/payloads", reconcile.operations(base._reasons(spark, d))
    item = F.to_json(F.struct(F.col("document_id").alias("documentId")))
    uploads.write_payloads(ops.select((_number(F.col("document_id")) % 7).alias("batch"), "op", F.col("document_id").alias("pos"), "document_id", F.when(F.col("op") == "addOrUpdate", item).alias("item")), at)
    return spark.read.text(at).select(F.col("batch").cast("long").alias("batch"), F.col("value").alias("payload"))


SQL["payload_files"] = _with(CATALOG + DESCRIPTORS, """SELECT ('0x' || substr(md5(document_id), 1, 6))::BIGINT % 7 AS batch, '{"addOrUpdate":[' || coalesce(string_agg('{"documentId":"' || document_id || '"}', ',' ORDER BY document_id) FILTER (WHERE op = 'addOrUpdate'), '')
    || '],"delete":[' || coalesce(string_agg('"' || document_id || '"', ',' ORDER BY document_id) FILTER (WHERE op = 'delete'), '') || ']}' AS payload FROM ops GROUP BY 1""")
