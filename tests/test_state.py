"""Generations, publications, batches against a manifest: runs that fail, come again or are replayed."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import generations, incremental, reconcile, state

DESCRIPTOR = "root_id string, modified_at string, modification_signature string, eligibility_signature string, ownership_signature string, document_ids array<string>"


@pytest.fixture
def at(tmp_path):
    return f"file://{tmp_path}/place"


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x long")


def failing(spark):
    return spark.range(1).select(F.raise_error(F.lit("lost")).cast("long").alias("x"))


def held(spark, at, name="a"):
    return sorted(r["x"] for r in generations.table(spark, at, name).collect())


def test_a_run_that_dies_leaves_the_old_generation(spark, at):
    assert generations.active(spark, at) is None and generations.sweep(spark, at) == []
    generations.publish(spark, at, {"a": numbers(spark, 1, 2)}, completed="t1")
    dead = generations.begin(spark, at)
    generations.stage(dead, "a", numbers(spark, 3))  # killed between data and pointer
    assert held(spark, at) == [1, 2]
    assert generations.sweep(spark, at) == [f"generation={dead.generation}"] and held(spark, at) == [1, 2]
    with pytest.raises(ValueError, match="not written whole"):
        generations.promote(spark, dead, ["a"])
    assert held(spark, at) == [1, 2]


def test_promotion_abort_and_inherited_times(spark, at):
    first = generations.publish(spark, at, {"a": numbers(spark, 1)}, completed="t1")
    old = first["tables"]["a"]
    run = generations.begin(spark, at, "fast", "t2")
    generations.stage(run, "a", numbers(spark, 5))
    other = generations.begin(spark, at)
    generations.stage(other, "a", numbers(spark, 6))
    record = generations.promote(spark, run, ["a"], "t3")
    assert (record["last_deep"], record["mode"], record["started"], record["completed"]) == ("t1", "fast", "t2", "t3")
    assert held(spark, at) == [5] and not generations.exists(spark, old)
    with pytest.raises(ValueError, match="meanwhile"):
        generations.promote(spark, other, ["a"], "t4")
    assert generations.abort(spark, other) and not generations.abort(spark, run) and held(spark, at) == [5]
    assert generations.publish(spark, at, {"a": numbers(spark, 7)}, completed="t5")["last_deep"] == "t5"
    generations.replace_text(spark, f"{at}/pointer.json", json.dumps({"schema": 99}))
    with pytest.raises(ValueError, match="unsupported version"):
        generations.active(spark, at)


def test_both_outputs_or_neither(spark, at):
    generations.publish(spark, at, {"a": numbers(spark, 1), "b": numbers(spark, 2)})
    with pytest.raises(Exception, match="lost"):
        generations.publish(spark, at, {"a": numbers(spark, 8), "b": failing(spark)})
    assert (held(spark, at), held(spark, at, "b")) == ([1], [2]) and generations.sweep(spark, at) == []

    def refuse(run):
        raise ValueError("refused")

    with pytest.raises(ValueError, match="refused"):
        generations.publish(spark, at, {"a": numbers(spark, 9)}, check=refuse)
    generations.publish(spark, at, {"b": numbers(spark, 3)})
    assert (held(spark, at), held(spark, at, "b")) == ([1], [3])
    with pytest.raises(ValueError, match="no table c"):
        generations.table(spark, at, "c")


def test_an_output_may_read_what_was_staged_before_it(spark, at):
    generations.publish(spark, at, {"a": numbers(spark, 1), "b": lambda staged: staged["a"]})
    assert (held(spark, at), held(spark, at, "b")) == ([1], [1])
    places = state._target_outputs(mapped(spark, ("P", "R", "D", 5)), counts(spark, ("S", 1)), "en")
    with pytest.raises(KeyError):  # the summary has no tables but the staged ones
        places["summary en"]({})


def counts(spark, *rows):
    return spark.createDataFrame(list(rows), "product_id string, units_sold long")


def mapped(spark, *rows):
    return spark.createDataFrame(list(rows), "product_id string, root_id string, document_id string, units_sold long")


def test_snapshot_and_target_state_are_published_together(spark, at):
    skipped = counts(spark, ("S", 1))
    state.publish_metrics(counts(spark, ("P", 5), ("S", 1)), mapped(spark, ("P", "R", "D", 5)), skipped, at, "tr", 30, "t1", "en")
    state.write_snapshot(counts(spark, ("P", 9)), at, "tr", 90, "t1")
    broken = mapped(spark, ("P", "R", "D", 6)).withColumn("units_sold", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        state.publish_metrics(counts(spark, ("P", 6)), broken, skipped, at, "tr", 30, "t2", "en")
    read = lambda: sorted(map(tuple, state.read_snapshots(spark, at, "tr").collect()))
    assert read() == [(30, "P", 5, "t1"), (30, "S", 1, "t1"), (90, "P", 9, "t1")]
    assert [tuple(r) for r in state.read_target_state(spark, at, target="en").collect()] == [("P", "R", "D", 5)]
    assert tuple(state.target_summary(spark, at, "en").first()) == (1, 1)
    state.publish_metrics(counts(spark, ("P", 7)), mapped(spark, ("P", "R", "D", None)), skipped, at, "tr", 30, "t3", "fr")
    assert read() == [(30, "P", 7, "t3"), (90, "P", 9, "t1")] and state.read_target_state(spark, at, target="fr").first()["units_sold"] == 0
    assert state.read_target_state(spark, at, "applied", "en").count() == 0
    assert [tuple(r) for r in state.advance_full(spark, at, "en").collect()] == [("P", "R", "D", 5)]
    state.advance_delta(spark, at, mapped(spark, ("Q", "R", "D", 1)), "en")
    assert state.read_target_state(spark, at, "applied", "en").first()["product_id"] == "Q" and state.read_target_state(spark, at, target="en").first()["product_id"] == "P"
    generations.removed(spark, generations.active(spark, at)["tables"]["counts 90 tr"])
    with pytest.raises(ValueError, match="counts are missing"):
        state.read_snapshots(spark, at, "tr")
    with pytest.raises(ValueError, match="no snapshot"):
        state.read_snapshots(spark, at, "other")


def test_manifest_knows_its_generation_and_start(spark, at):
    rows = spark.createDataFrame([("r", "t", "m", "e", "o", ["d"])], DESCRIPTOR)
    assert state.high_water(spark, at) is None
    state.write_manifest(rows, at, "1", "2026-01-01T00:00:00.000Z")
    assert state.read_manifest(spark, at, "1").count() == 1 and state.high_water(spark, at) == "2026-01-01T00:00:00.000Z"
    with pytest.raises(ValueError, match="no manifest 2"):
        state.read_manifest(spark, at, "2")

    def unstable(run):
        reconcile.assert_stable(rows, rows.withColumn("eligibility_signature", F.lit("other")), rows)

    with pytest.raises(ValueError, match="1 roots changed .* first r: eligibility_signature differs"):
        state.write_manifest(rows, at, "2", "later", check=unstable)
    assert state.read_manifest(spark, at).count() == 1 and state.high_water(spark, at) == "2026-01-01T00:00:00.000Z"


def test_unstable_roots(spark):
    rows = lambda *x: spark.createDataFrame([(r, "", m, "e", "o", ids) for r, m, ids in x], DESCRIPTOR)
    before = rows(("same", "m", ["b", "a"]), ("gone", "m", []), ("moved", "m", ["x"]), ("lost", "m", ["y"]), ("none", "m", []))
    after = rows(("same", "m", ["a", "b"]), ("new", "m", []), ("moved", "n", ["x"]), ("lost", "m", ["y"]), ("none", "m", []))
    items = rows(("same", "", ["a", "b"]), ("moved", "", ["x"]), ("lost", "", []))
    assert sorted(map(tuple, reconcile.unstable_roots(before, after, items).collect())) == [("gone", "disappeared"), ("lost", "other documents"), ("moved", "modification_signature differs"), ("new", "appeared")]


class Catalog:
    """Descriptors and payloads by root, as a test's rows."""

    def __init__(self, spark):
        self.spark, self.asked = spark, []
        self.payload = {}

    def rows(self, *roots):
        kind = f"{DESCRIPTOR}, removed boolean"
        return self.spark.createDataFrame([(r, "t", m, "e", "o", ids, m is None) for r, m, ids in roots], kind)

    def checksums(self, dirty):
        names = sorted(r["root_id"] for r in dirty.collect())
        self.asked.append(names)
        return self.spark.createDataFrame([(r, self.payload.get(r, "p")) for r in names], "root_id string, payload_checksum string")


def test_batches_against_the_manifest(spark, at):
    none = spark.createDataFrame([], "root_id string")
    c = Catalog(spark)
    step = lambda n, *roots, touched=none, **k: incremental.apply(spark, at, c.rows(*roots), n, touched, c.checksums, **k)
    ops = lambda n: sorted(tuple(r) for r in incremental.operations(spark, at).filter(f"batch = {n}").select("op", "document_id").collect())
    roots = lambda: {r["root_id"]: (r["modification_signature"], r["document_ids"], r["payload_checksum"]) for r in incremental.manifest(spark, at).collect()}
    assert step(0, ("A", "1", ["dA"]), ("B", "1", ["dB", "x"]), ("C", "1", ["dC"]))
    assert ops(0) == [("addOrUpdate", d) for d in ("dA", "dB", "dC", "x")]
    # roots that a batch doesn't name stay; a root that is touched but has the same payload sends nothing
    assert step(1, ("A", "1", ["dA"]), ("C", "1", ["dC"]), touched=spark.createDataFrame([("A",)], "root_id string"))
    assert ops(1) == [] and c.asked[-1] == ["A"] and set(roots()) == {"A", "B", "C"}
    # a document that moves to another root isn't deleted; one that no root has is
    c.payload = {"A": "p2", "B": "p2"}
    assert step(2, ("A", "2", ["dA", "x"]), ("B", "2", []))
    assert ops(2) == [("addOrUpdate", "dA"), ("addOrUpdate", "x"), ("delete", "dB")]
    before = roots()
    assert not step(2, ("A", "9", []), ("C", "9", [])) and not step(1, ("B", "9", ["q"])) and roots() == before  # replayed
    # removal is a row of its own
    assert step(3, ("C", None, None), ("new", "1", ["dC"]))
    assert ops(3) == [("addOrUpdate", "dC")] and set(roots()) == {"A", "B", "new"}
    # a batch that fails before its record changes nothing, and can come again
    calls = []

    def refuse(run):
        calls.append(run)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        step(4, ("A", None, None), check=refuse)
    assert calls and set(roots()) == {"A", "B", "new"} and incremental.last_batch(spark, at) == 3
    assert step(4, ("A", None, None)) and ops(4) == [("delete", "dA"), ("delete", "x")]
    # what a complete scan doesn't name is gone
    assert step(5, ("new", "1", ["dC"]), complete=True) and set(roots()) == {"new"} and ops(5) == []
    assert step(6, complete=True) and roots() == {} and ops(6) == [("delete", "dC")]
    net = {tuple(r) for r in incremental.net_operations(incremental.operations(spark, at)).collect()}
    assert net == {("delete", d) for d in ("dA", "dB", "dC", "x")}
    incremental.acknowledge(spark, at, 5)
    assert {r["batch"] for r in incremental.operations(spark, at).collect()} == {6} and incremental.last_batch(spark, at) == 6


def test_the_last_row_of_a_root_counts(spark):
    rows = spark.createDataFrame([("r", "a", 1), ("r", None, 3), ("r", "b", 2), ("s", "c", 1)], "root_id string, v string, seq long")
    assert sorted(map(tuple, incremental.latest(rows).collect())) == [("r", None), ("s", "c")]
