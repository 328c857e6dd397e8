"""SQL for DuckDB, written against the driver's tables, that computes what the queries compute."""

from __future__ import annotations

CATALOG = """
t AS (SELECT l_partkey, min(l_shipdate + to_milliseconds(l_orderkey * 7919 % 86400000)) AS created, max(l_shipdate + to_milliseconds(l_orderkey * 7919 % 86400000)) AS modified, max(l_discount) AS discount FROM lineitem GROUP BY l_partkey),
p AS (SELECT 'P' || p_partkey AS id, p_partkey AS key, p_partkey % 10 <> 0 AS is_variant,
        CASE WHEN p_partkey % 10 <> 0 THEN 'M-' || regexp_replace(p_brand, '[^0-9]', '', 'g') || '-' || p_type END AS master_id,
        p_name AS name, p_brand AS brand, p_type AS type, string_split(p_name, ' ')[1] AS color, p_size AS size, p_partkey % 7 <> 0 AS online, p_partkey % 11 <> 0 AS searchable,
        created, modified, p_retailprice AS list_price, CASE WHEN p_partkey % 3 = 0 THEN p_retailprice * (1 - discount) END AS sale_price FROM part LEFT JOIN t ON l_partkey = p_partkey),
m AS (SELECT master_id AS id, min(type) <> 'PROMO' AS online, min(created) - to_milliseconds(1) AS created, max(modified) + to_milliseconds(1) AS modified FROM p WHERE is_variant GROUP BY master_id),
e AS (SELECT p.*, p.online AND p.searchable AND coalesce(m.online, true) AS eligible, coalesce(p.master_id, p.id) AS root_id FROM p LEFT JOIN m ON m.id = p.master_id),
"""
CATEGORIES = """
c AS (SELECT 'R' || r_regionkey AS id, 'root' AS parent_id, r_name AS name, true AS online FROM region
    UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, n_name, n_nationkey % 12 <> 0 FROM nation
    UNION ALL SELECT 'S' || s_suppkey, 'N' || s_nationkey, s_name, s_suppkey % 9 <> 0 FROM supplier),
a AS (SELECT 'P' || l_partkey AS product_id, 'S' || l_suppkey AS category_id, l_suppkey AS pos, l_suppkey = min(l_suppkey) OVER (PARTITION BY l_partkey) AS is_primary FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)),
paths AS (SELECT s.id AS category_id, [r.name, n.name, s.name] AS path FROM c s JOIN c n ON n.id = s.parent_id JOIN c r ON r.id = n.parent_id WHERE s.id LIKE 'S%' AND s.online AND n.online
    UNION ALL SELECT n.id, [r.name, n.name] FROM c n JOIN c r ON r.id = n.parent_id WHERE n.id LIKE 'N%' AND n.online UNION ALL SELECT id, [name] FROM c WHERE parent_id = 'root'),
"""
PURCHASES = """
b AS (SELECT CASE WHEN l_orderkey % 101 = 0 THEN '' ELSE 'P' || l_partkey END AS product_id,
        CASE WHEN l_orderkey % 97 = 0 THEN '' WHEN l_orderkey % 89 = 0 THEN '-1' ELSE l_quantity::INT::VARCHAR END AS quantity, l_shipdate AS ts FROM lineitem),
q AS (SELECT *, CASE WHEN product_id = '' AND quantity = '' THEN 'skipped' WHEN product_id = '' THEN 'blank' WHEN quantity = '' OR quantity::DOUBLE <= 0 THEN 'invalid' ELSE 'processed' END AS state FROM b),
n AS (SELECT product_id, sum(quantity::BIGINT)::BIGINT AS units_sold FROM q WHERE state = 'processed' GROUP BY product_id),
"""
DOCUMENTS = """
d AS (SELECT 'product://pid=' || id AS document_id, root_id, CASE WHEN is_variant THEN master_id || '-' || color ELSE id END AS group_id, 'Product' AS object_type, name, brand,
        round(list_price, 2) AS price, round(CASE WHEN sale_price < list_price THEN sale_price END, 2) AS promo_price, color, size FROM e WHERE eligible),
"""
DESCRIPTORS = """
rec AS (SELECT root_id, CASE WHEN is_variant THEN 'variant' ELSE 'root' END AS role, id, coalesce(master_id, '') AS mid, false AS master, is_variant AS variant, online, searchable, eligible, created, modified FROM e
    UNION ALL SELECT id, role, id, '', true, false, online, true, online, created, modified FROM m, (VALUES ('root'), ('master')) v(role)),
txt AS (SELECT *, concat_ws('|', role, id, mid, master::VARCHAR, variant::VARCHAR, coalesce(strftime(created, '%Y-%m-%dT%H:%M:%S.%gZ'), ''), coalesce(strftime(modified, '%Y-%m-%dT%H:%M:%S.%gZ'), '')) AS mt, concat_ws('|', id, mid, online::VARCHAR, searchable::VARCHAR) AS et FROM rec),
agg AS (SELECT root_id, coalesce(strftime(max(greatest(created, modified)), '%Y-%m-%dT%H:%M:%S.%gZ'), '') AS modified_at, string_agg(mt, chr(1) ORDER BY role, id) AS ms, string_agg(et, chr(1) ORDER BY id, mid, role) AS es,
        concat_ws('|', '1', root_id, CASE WHEN max(master) THEN 'master' ELSE 'standalone' END) AS head, max(eligible) FILTER (WHERE role = 'root') AS sound, coalesce(list_sort(list(id) FILTER (WHERE eligible AND NOT master)), []) AS ids FROM txt GROUP BY root_id),
st AS (SELECT *, concat_ws('|', head, 'product_only', 'online_and_searchable', sound::VARCHAR, array_to_string(ids, ',')) AS state, list_transform(ids, lambda i: 'product://pid=' || i) AS document_ids FROM agg),
sig AS (SELECT root_id, modified_at, sha256(head || chr(1) || ms) AS modification_signature, sha256(state || chr(1) || es) AS eligibility_signature, sha256(array_to_string([state] || document_ids, chr(1))) AS ownership_signature, document_ids FROM st),
h AS (SELECT *, ('0x' || substr(md5(root_id), 1, 6))::BIGINT AS k FROM sig),
prev AS (SELECT root_id, CASE WHEN k % 5 = 0 THEN 'old' ELSE modification_signature END AS ms, CASE WHEN k % 11 = 0 THEN 'other' ELSE eligibility_signature END AS es, ownership_signature AS os,
        CASE WHEN k % 7 = 0 THEN list_append(document_ids, 'product://pid=OLD-' || root_id) ELSE document_ids END AS ids FROM h WHERE k % 13 <> 0
    UNION ALL SELECT 'GONE-' || root_id, modification_signature, eligibility_signature, ownership_signature, ['product://pid=GONE-' || root_id, document_ids[1]] FROM h WHERE k % 17 = 0),
touched AS (SELECT DISTINCT root_id FROM e WHERE key % 19 = 0),
why AS (SELECT coalesce(sig.root_id, prev.root_id) AS root_id, CASE WHEN sig.root_id IS NULL THEN 'removed' WHEN prev.root_id IS NULL THEN 'new' WHEN ms <> modification_signature THEN 'modified'
        WHEN es <> eligibility_signature OR os <> ownership_signature THEN 'eligibilityOwnership' WHEN touched.root_id IS NOT NULL THEN 'purchase' ELSE 'clean' END AS reason,
        document_ids, ids AS previous_ids FROM sig FULL JOIN prev ON sig.root_id = prev.root_id LEFT JOIN touched ON touched.root_id = sig.root_id),
cand AS (SELECT DISTINCT x AS document_id FROM (SELECT document_ids, unnest(previous_ids) AS x FROM why WHERE reason <> 'clean') WHERE x IS NOT NULL AND NOT list_contains(coalesce(document_ids, []), x)),
ops AS (SELECT DISTINCT 'addOrUpdate' AS op, unnest(document_ids) AS document_id FROM why WHERE reason NOT IN ('clean', 'removed')
    UNION ALL SELECT 'delete', document_id FROM cand WHERE document_id NOT IN (SELECT unnest(document_ids) FROM sig)),
"""
STATE = """
now_ AS (SELECT n.product_id, root_id, document_id, units_sold FROM n JOIN d ON document_id = 'product://pid=' || product_id),
old_ AS (SELECT product_id, root_id, document_id, CASE WHEN length(product_id) % 2 = 0 THEN units_sold + 1 ELSE units_sold END AS units_sold FROM now_ WHERE right(product_id, 1) <> '3' UNION ALL SELECT 'GONE', 'R-GONE', 'D-GONE', 1),
ch AS (SELECT DISTINCT coalesce(x.root_id, y.root_id) AS root_id FROM now_ x FULL JOIN old_ y ON x.product_id = y.product_id WHERE (x.root_id, x.document_id, x.units_sold) IS DISTINCT FROM (y.root_id, y.document_id, y.units_sold)),
ex AS (SELECT root_id FROM ch WHERE length(root_id) % 2 = 0),
"""
SLUG = "regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(translate(lower({x}), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), 'æ', 'ae'), 'œ', 'oe'), '&', ' and '), '[''’]', '', 'g'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
ENTRIES = """
ent AS (SELECT id AS category_id, id AS key_path, [name] AS names, name AS name_path, 1 AS depth FROM c WHERE parent_id = 'root' AND lower(name) <> 'asia'
    UNION ALL SELECT n.id, r.id || '|' || n.id, [r.name, n.name], r.name || '|' || n.name, 2 FROM c n JOIN c r ON r.id = n.parent_id WHERE n.id LIKE 'N%' AND n.online AND lower(r.name) <> 'asia'
    UNION ALL SELECT s.id, r.id || '|' || n.id || '|' || s.id, [r.name, n.name, s.name], r.name || '|' || n.name || '|' || s.name, 3
        FROM c s JOIN c n ON n.id = s.parent_id JOIN c r ON r.id = n.parent_id WHERE s.id LIKE 'S%' AND s.online AND n.online AND lower(r.name) <> 'asia'),
pth AS (SELECT *, '/' || array_to_string(list_transform(names, lambda x: """ + SLUG.format(x="x") + """), '/') AS path FROM ent),
pg AS (SELECT key_path, category_id, name_path AS filter_value, array_to_string(list_sort(list_distinct(['https://shop.example/en' || path, 'https://shop.example/fr' || path, path])), ' ') AS patterns, path AS primary_url, 2::BIGINT AS n_rules FROM pth),
exi AS (SELECT 'page-' || key_path AS page_id, CASE WHEN category_id LIKE 'N%' THEN filter_value ELSE 'other ' || key_path END AS name, CASE WHEN category_id LIKE 'R%' THEN patterns ELSE '/none/' || key_path END AS patterns FROM pg WHERE length(key_path) % 2 = 0),
"""


def _with(parts: str, select: str) -> str:
    parts = parts.rstrip().rstrip(",")
    return f"WITH {parts}{select}" if select.startswith(",") else f"WITH {parts} {select}"


ORACLE_SQL: dict[str, str] = {
    "roots_full": _with(CATALOG, "SELECT DISTINCT root_id FROM e"),
    "roots_catalog_scope": _with(CATALOG, "SELECT DISTINCT root_id FROM e WHERE brand = (SELECT min(p_brand) FROM part)"),
    "roots_modified_since": _with(CATALOG, "SELECT DISTINCT e.root_id FROM e LEFT JOIN m ON m.id = e.master_id WHERE e.modified >= TIMESTAMP '2001-10-20' OR e.created >= TIMESTAMP '2001-10-20' OR m.modified >= TIMESTAMP '2001-10-20'"),
    "roots_merged": _with(CATALOG, "SELECT root_id FROM e WHERE modified >= TIMESTAMP '2001-10-20' UNION SELECT root_id FROM e WHERE key % 19 = 0"),
    "eligible_variants": _with(CATALOG, "SELECT id, master_id FROM e WHERE is_variant AND eligible"),
    "eligible_roots": _with(CATALOG, "SELECT root_id, count(*) AS n_eligible FROM e WHERE eligible GROUP BY root_id"),
    "category_paths": _with(CATEGORIES, "SELECT category_id, array_to_string(path, '|') AS path FROM paths"),
    "product_categories": _with(CATEGORIES, """, x AS (SELECT product_id, is_primary, pos, path, unnest(range(1, len(path) + 1)) AS i FROM a JOIN paths USING (category_id)),
        v AS (SELECT product_id, is_primary, pos, i, array_to_string(path[1:i], '|') AS v FROM x),
        f AS (SELECT product_id, v, min(row_number) AS k FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY NOT is_primary, pos, i) AS row_number FROM v) GROUP BY product_id, v)
        SELECT f.product_id, string_agg(f.v, ';' ORDER BY k) AS hierarchies, coalesce(any_value(p.h), '') AS primary_hierarchy FROM f
        LEFT JOIN (SELECT product_id, string_agg(v, ';' ORDER BY i) AS h FROM v WHERE is_primary GROUP BY product_id) p USING (product_id) GROUP BY f.product_id""".lstrip()),
    "export_prices": _with(CATALOG, "SELECT id, round(list_price, 2) AS price, round(CASE WHEN sale_price < list_price THEN sale_price END, 2) AS promo_price FROM e"),
    "documents_product_only": _with(CATALOG + DOCUMENTS, "SELECT * FROM d"),
    "documents_product_variant": _with(CATALOG, """, g AS (SELECT *, CASE WHEN is_variant THEN color ELSE id END AS gk FROM e WHERE eligible),
        r AS (SELECT *, first_value(id) OVER w AS lead, row_number() OVER w AS n FROM g WINDOW w AS (PARTITION BY master_id, gk ORDER BY key))
        SELECT 'product://pid=' || lead AS document_id, 'Product' AS object_type, root_id, CASE WHEN is_variant THEN master_id || '-' || gk ELSE id END AS group_id, NULL::VARCHAR AS parent_id FROM r WHERE n = 1
        UNION ALL SELECT 'product://pid=s' || id, 'Variant', root_id, CASE WHEN is_variant THEN master_id || '-' || gk ELSE id END, 'product://pid=' || lead FROM r WHERE is_variant""".lstrip()),
    "root_descriptors": _with(CATALOG + DESCRIPTORS, "SELECT root_id, modified_at, modification_signature, eligibility_signature, ownership_signature, array_to_string(document_ids, ',') AS document_ids FROM sig"),
    "payload_checksums": _with(CATALOG + DOCUMENTS, """, x AS (SELECT root_id, concat_ws('|', document_id, name, brand, coalesce(round(price * 100)::BIGINT::VARCHAR, ''), coalesce(round(promo_price * 100)::BIGINT::VARCHAR, '')) AS s FROM d)
        SELECT root_id, sha256(string_agg(s, chr(10) ORDER BY s)) AS payload_checksum, count(*) AS n_documents FROM x GROUP BY root_id""".lstrip()),
    "dirty_reasons": _with(CATALOG + DESCRIPTORS, "SELECT root_id, reason FROM why"),
    "reconcile_stats": _with(CATALOG + DESCRIPTORS, "SELECT reason, count(*) AS n FROM why GROUP BY reason"),
    "delete_candidates": _with(CATALOG + DESCRIPTORS, "SELECT document_id FROM cand"),
    "delta_operations": _with(CATALOG + DESCRIPTORS, "SELECT op, document_id FROM ops"),
    "delta_microbatch": _with(CATALOG + DESCRIPTORS, "SELECT op, document_id FROM ops"),
    "operation_conflicts": _with(CATALOG + DOCUMENTS, "SELECT document_id FROM d WHERE size % 4 = 0"),
    "batches_fixed": _with(CATALOG + DOCUMENTS, "SELECT root_id, document_id, ((row_number() OVER (PARTITION BY root_id ORDER BY document_id) - 1) // 5)::BIGINT AS batch FROM d"),
    "batches_greedy": _with("RECURSIVE " + CATALOG.lstrip() + DOCUMENTS, """, o AS (SELECT root_id, document_id, length(name)::BIGINT AS cost, row_number() OVER (PARTITION BY root_id ORDER BY document_id) AS i FROM d),
        w AS (SELECT root_id, document_id, i, 0::BIGINT AS batch, cost AS used, 1 AS n FROM o WHERE i = 1
            UNION ALL SELECT o.root_id, o.document_id, o.i, w.batch + CASE WHEN w.n >= 4 OR w.used + o.cost > 40 THEN 1 ELSE 0 END, CASE WHEN w.n >= 4 OR w.used + o.cost > 40 THEN o.cost ELSE w.used + o.cost END,
                CASE WHEN w.n >= 4 OR w.used + o.cost > 40 THEN 1 ELSE w.n + 1 END FROM w JOIN o ON o.root_id = w.root_id AND o.i = w.i + 1)
        SELECT root_id, document_id, batch FROM w""".lstrip()),
    "validation_errors": _with(CATALOG, """, i AS (SELECT CASE WHEN key % 23 = 0 THEN '' ELSE 'product://pid=' || id END AS document_id, CASE WHEN key % 29 = 0 THEN '' WHEN key % 31 = 0 THEN 'fr' ELSE 'en' END AS language,
            CASE WHEN key % 37 = 0 THEN 'Variant' ELSE 'Product' END AS object_type, 'product://pid=' || CASE WHEN key % 2 = 0 THEN id ELSE 'none' END AS parent_id FROM e)
        SELECT document_id, 'missing_document_id' AS error FROM i WHERE document_id = '' UNION ALL SELECT document_id, 'missing_language' FROM i WHERE language = '' UNION ALL SELECT document_id, 'wrong_language' FROM i WHERE language = 'fr'
        UNION ALL SELECT document_id, 'duplicate_document' FROM i WHERE document_id IN (SELECT document_id FROM i GROUP BY document_id HAVING count(*) > 1)
        UNION ALL SELECT document_id, 'missing_parent' FROM i WHERE object_type = 'Variant' AND parent_id NOT IN (SELECT document_id FROM i WHERE object_type = 'Product')""".lstrip()),
    "purchase_totals": _with(PURCHASES, "SELECT product_id, units_sold FROM n"),
    "purchase_counters": _with(PURCHASES, "SELECT state, count(*) AS n FROM q GROUP BY state"),
    "units_sold_windows": _with(PURCHASES, "SELECT product_id, " + ", ".join(f"coalesce(sum(quantity::BIGINT) FILTER (WHERE ts >= (SELECT max(ts) FROM b) - INTERVAL {d} DAY), 0)::BIGINT AS units_{d}d" for d in (30, 90, 365)) + " FROM q WHERE state = 'processed' GROUP BY product_id"),
    "purchase_mapping": _with(CATALOG + DOCUMENTS + PURCHASES + STATE, "SELECT * FROM now_"),
    "purchase_skipped": _with(CATALOG + DOCUMENTS + PURCHASES, "SELECT product_id, units_sold, 'missing-product-mapping' AS reason FROM n WHERE 'product://pid=' || product_id NOT IN (SELECT document_id FROM d)"),
    "document_metrics": _with(CATALOG + DOCUMENTS + PURCHASES + STATE, "SELECT d.document_id, coalesce(now_.units_sold, 0) AS units_sold FROM d LEFT JOIN now_ USING (document_id)"),
    "changed_roots": _with(CATALOG + DOCUMENTS + PURCHASES + STATE, "SELECT root_id FROM ch"),
    "applied_after_delta": _with(CATALOG + DOCUMENTS + PURCHASES + STATE, "SELECT product_id, root_id, document_id, units_sold FROM now_ WHERE root_id IN (FROM ex) UNION ALL SELECT product_id, root_id, document_id, units_sold FROM old_ WHERE root_id NOT IN (FROM ex) AND product_id NOT IN (SELECT product_id FROM now_ WHERE root_id IN (FROM ex))"),
    "best_sellers": _with(PURCHASES, "SELECT product_id, units_sold FROM n ORDER BY units_sold DESC, product_id LIMIT 25"),
    "best_per_root": _with(CATALOG + DOCUMENTS + PURCHASES + STATE, "SELECT root_id, product_id, units_sold FROM now_ QUALIFY row_number() OVER (PARTITION BY root_id ORDER BY units_sold DESC, product_id) = 1"),
    "attribute_audit": """WITH x AS (SELECT doc_id AS id, lang AS type, attribute, value FROM (SELECT doc_id, lang, lang AS a1, source AS a2, quality::VARCHAR AS a3, toxic::VARCHAR AS a4 FROM documents LEFT JOIN labels USING (doc_id)),
            LATERAL (SELECT unnest(['lang', 'source', 'quality', 'toxic']) AS attribute, unnest([a1, a2, a3, a4]) AS value) WHERE value IS NOT NULL AND value <> ''),
        f AS (SELECT attribute, value, min(id) AS first_id FROM x GROUP BY ALL), s AS (SELECT *, row_number() OVER (PARTITION BY attribute ORDER BY first_id, value) AS n FROM f)
        SELECT attribute, count(*) AS n_objects, """ + ", ".join(f"count(*) FILTER (WHERE type = '{t}') AS n_{t}" for t in ("en", "de", "fr", "es")) + ", (SELECT string_agg(value, ' | ' ORDER BY n) FROM s WHERE s.attribute = x.attribute AND n <= 3) AS samples FROM x GROUP BY attribute",
    "category_audit": _with(CATEGORIES, "SELECT count(*) AS n_products, count(DISTINCT category_id) AS n_categories, count(*) FILTER (WHERE online) AS n_online FROM a JOIN c ON c.id = category_id WHERE is_primary"),
    "listing_entries": _with(CATEGORIES + ENTRIES, "SELECT category_id, key_path, name_path, depth FROM ent"),
    "listing_pages": _with(CATEGORIES + ENTRIES, "SELECT * FROM pg"),
    "listing_plan": _with(CATEGORIES + ENTRIES, "SELECT key_path, coalesce(u.page_id, v.page_id) AS page_id, CASE WHEN coalesce(u.page_id, v.page_id) IS NULL THEN 'create' ELSE 'update' END AS action FROM pg LEFT JOIN (SELECT page_id, unnest(string_split(patterns, ' ')) AS url FROM exi) u ON u.url = primary_url LEFT JOIN exi v ON v.name = filter_value"),
    "slugs": "SELECT doc_id, " + SLUG.format(x="coalesce(text, '')") + " AS slug FROM documents",
    "html_documents": "SELECT page_id AS id, CASE WHEN coalesce(html, '') = '' THEN '' WHEN regexp_matches(html, '(?i)<html[\\s>]') THEN html ELSE '<html><body>' || html || '</body></html>' END AS html FROM pages UNION ALL SELECT -1 - doc_id, CASE WHEN coalesce(text, '') = '' THEN '' WHEN regexp_matches(text, '(?i)<html[\\s>]') THEN text ELSE '<html><body>' || text || '</body></html>' END FROM documents",
    "ratings": _with(CATALOG, ", s AS (SELECT id, list_sum(list_transform(string_split(id, ''), lambda x: ascii(x)))::INT AS s FROM e), r AS (SELECT id, s, ceil((s % 3) + 2 + (s % 10) / 10 + 0.1) AS r FROM s) SELECT id, (CASE WHEN r < 5 THEN r + ((s % 10) * 0.1::DOUBLE + 0.1::DOUBLE) ELSE r END)::DOUBLE AS rating FROM r".lstrip()),
    "source_ownership": "SELECT s_nationkey AS organization, s_suppkey % 10 AS source, count(DISTINCT s_suppkey) AS n_targets FROM supplier GROUP BY ALL HAVING count(DISTINCT s_suppkey) > 1",
    "streamed_units_sold": "SELECT strftime(ts, '%Y-%m-%d') AS day, 'P' || json_extract_string(props, '$.k') AS product_id, sum(floor(value + 0.5))::BIGINT AS units, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY ALL",
}
#: Mappings come from the tables: one per nation, some faulty.
_MAPPINGS = "mp AS (SELECT 'map-' || n_nationkey AS mapping_id, n_nationkey % 6 <> 0 AS enabled, CASE WHEN n_nationkey % 7 = 0 THEN '' ELSE 'color' END AS source_attribute, CASE WHEN n_nationkey % 11 = 0 THEN 'EC_Name' WHEN n_nationkey % 5 = 0 THEN 'x_shared' ELSE 'x_' || n_nationkey END AS target_field, CASE WHEN n_nationkey % 4 = 0 THEN 'raw' WHEN n_nationkey % 4 = 1 THEN 'displayValue' WHEN n_nationkey % 4 = 2 THEN 'displayValueArray' ELSE 'odd' END AS value_mode FROM nation),"
ORACLE_SQL |= {
    "mapping_errors": _with(_MAPPINGS, ", o AS (SELECT *, lower(target_field) AS t, count(*) OVER (PARTITION BY lower(target_field)) AS n FROM mp WHERE enabled) SELECT mapping_id, 'missing_source' AS error FROM o WHERE source_attribute = '' UNION ALL SELECT mapping_id, 'unknown_mode' FROM o WHERE value_mode = 'odd' UNION ALL SELECT mapping_id, 'reserved_target' FROM o WHERE t = 'ec_name' UNION ALL SELECT mapping_id, 'repeated_target' FROM o WHERE n > 1".lstrip()),
    "mapping_upsert": _with(_MAPPINGS, "SELECT mapping_id, target_field, CASE WHEN right(mapping_id, 1) = '1' THEN 'created' WHEN enabled THEN 'updated' ELSE 'kept' END AS state FROM mp WHERE enabled OR right(mapping_id, 1) <> '1'"),
}
