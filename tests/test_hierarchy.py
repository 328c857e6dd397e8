"""Trees of any depth, circles, and ordered streams, against sequential rules."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import attributes, catalog, hierarchy


def walk(nodes):
    """id to its ids from the top, or None in a circle."""
    out = {}
    for i in nodes:
        way = [i]
        while nodes.get(way[-1]) in nodes and len(way) <= len(nodes):
            way.append(nodes[way[-1]])
        out[i] = way[::-1] if len(way) <= len(nodes) else None
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_ways_up_of_random_graphs(spark, seed):
    r = random.Random(seed)
    nodes = {f"n{i}": (f"n{r.randrange(150)}" if r.random() < 0.5 else f"n{max(0, i - 1)}") if r.random() < 0.9 else r.choice([None, "nowhere", "root"]) for i in range(130)}
    nodes["n0"] = "root"
    rows = spark.createDataFrame([(i, p, f"v-{i}") for i, p in nodes.items()] + [(None, "n1", "v")], "id string, parent_id string, v string")
    done, circles = hierarchy.ways_up(rows, "v")
    want = walk(nodes)
    got = {x["id"]: x for x in done.collect()}
    assert {i: x["ids"] for i, x in got.items()} == {i: w for i, w in want.items() if w}
    assert all(x["values"] == [f"v-{i}" for i in x["ids"]] and x["top"] == x["ids"][0] and x["above"] == nodes[x["top"]] for x in got.values())
    assert {x["id"] for x in circles.collect()} == {i for i, w in want.items() if w is None}


def test_chains_beyond_a_hundred_levels(spark):
    tree = [("c0", "root", "n0", True), *((f"c{i}", f"c{i - 1}", f"n{i}", i != 250) for i in range(1, 300)), ("x", "y", "x", True), ("y", "x", "y", True), ("z", "x", "z", True), ("u", "c1", "", True), ("w", "u", "w", True)]
    rows = spark.createDataFrame(tree, "id string, parent_id string, name string, online boolean")
    paths = {x["category_id"]: x["path"] for x in catalog.category_paths(spark, rows).collect()}
    assert set(paths) == {f"c{i}" for i in range(250)} and paths["c249"] == [f"n{i}" for i in range(250)]
    assert catalog.category_paths(spark, rows.limit(0)).count() == 0


def test_books_in_a_circle_are_an_error(spark):
    rows = spark.createDataFrame([("sale", "list"), ("list", None), ("eu", "gone"), ("deep", "sale")], "book_id string, parent_id string")
    assert {tuple(x) for x in catalog.root_books(rows).collect()} == {("sale", "list"), ("list", "list"), ("eu", "eu"), ("deep", "list")}
    with pytest.raises(ValueError, match="a leads in a circle"):
        catalog.root_books(rows.union(spark.createDataFrame([("c", "a"), ("b", "c"), ("a", "b"), ("below", "a")], rows.schema)))


def test_adjacent_roots_across_ranges(spark):
    r = random.Random(3)
    hits = [(3 * i, r.choice(["a", "a", "a", "b", "", None])) for i in range(400)]
    want, last = [], None
    for pos, root in hits:
        if root and root != last:
            want.append((pos, root))
            last = root
    rows = spark.createDataFrame(r.sample(hits, len(hits)), "pos long, root_id string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that a small table has several ranges
    try:
        got = catalog.adjacent_roots(rows)
        assert sorted(map(tuple, got.collect())) == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert catalog.adjacent_roots(rows.limit(0)).count() == 0


def test_samples_are_cut_before_they_meet(spark):
    """Of an attribute's distinct values each task passes on the first few only."""
    rows = spark.range(1000).select(F.col("id"), F.lit("t").alias("type"), F.concat(F.lit("a"), F.col("id") % 2).alias("attribute"), F.concat(F.lit("v"), "id").alias("value"))
    found = attributes.audit(rows, ["t"])
    assert {x["attribute"]: x["samples"] for x in found.collect()} == {"a0": "v0 | v2 | v4", "a1": "v1 | v3 | v5"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert any("WindowGroupLimit" in x and "Partial" in x for x in plan.splitlines())


def test_scans_and_imports_that_fail(spark, tmp_path):
    items = spark.createDataFrame([("a", None, "c1"), ("b", "m", "c2")], "id string, master_id string, catalog_id string")
    catalogs = items.select("catalog_id")
    assert [x["root_id"] for x in catalog.scan(items, items, False, catalogs=catalogs, catalog_id="c2").collect()] == ["m"]
    with pytest.raises(ValueError, match="c3 does not exist"):
        catalog.scan(items, items, False, catalogs=catalogs, catalog_id="c3")
    with pytest.raises(ValueError, match="the run before"):
        catalog.scan(items, items, True)
    for k, text in enumerate(["[1]", '{"profile": {}}', "no json"]):
        at = tmp_path / f"{k}.json"
        at.write_text(text)
        with pytest.raises(Exception, match="must be an object"):
            attributes.imported(attributes.read_imports(spark, f"file://{at}")).collect()
    good = tmp_path / "good.json"
    good.write_text('\n {"profile": {"profile_id": "p", "site_id": "s"},\n "mappings": [{"mapping_id": " m ", "target_field": "x"}, {"mapping_id": "n", "enabled": false}]}')
    assert [(x["mapping_id"], x["enabled"], x["site_id"], x["error"]) for x in attributes.imported(attributes.read_imports(spark, f"file://{good}")).collect()] == [("m", True, "s", "missing_applies_to"), ("n", False, "s", "missing_applies_to")]
