"""Packing over one order, payload files and the index, against sequential rules."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import generations, uploads


def sequential(rows, max_items, max_bytes):
    out, upload, n, size = [], 0, 0, 0
    for items, cost in rows:
        if n and (n + items > max_items or size + cost > max_bytes):
            upload, n, size = upload + 1, 0, 0
        n, size = n + items, size + cost
        out.append(upload)
    return out


@pytest.mark.parametrize(("rows", "max_items", "max_bytes", "block"), [(0, 5, 50, 8), (1, 5, 50, 8), (700, 5, 50, 8), (700, 9, 10**9, 9), (333, 40, 60, 1000), (256, 1, 50, 1), (500, 30, 100, 64)])
def test_uploads_over_the_whole_order(spark, rows, max_items, max_bytes, block):
    r = random.Random(rows + block)
    data = [(k, r.randint(1, max(1, max_items // r.randint(1, 4))), r.randint(0, min(max_bytes, 40))) for k in range(rows)]
    shuffled = r.sample(data, len(data))
    df = spark.createDataFrame(shuffled, "k long, n_items long, n_bytes long").repartition(3)
    got = [x["upload"] for x in sorted(uploads.uploads(df, [F.col("k")], max_items, max_bytes, block).collect(), key=lambda x: x["k"])]
    assert got == sequential([x[1:] for x in data], max_items, max_bytes)


def test_rows_beyond_the_limits_fail(spark):
    df = spark.createDataFrame([(1, 9, 1)], "k long, n_items long, n_bytes long")
    with pytest.raises(Exception, match="exceeds the limits"):
        uploads.uploads(df, [F.col("k")], 5, 50, 8).collect()
    with pytest.raises(Exception, match="without items"):
        uploads.uploads(df.withColumn("n_items", F.lit(0).cast("long")), [F.col("k")], 5, 50, 8).collect()
    with pytest.raises(ValueError, match="smaller than an upload"):
        uploads.uploads(df, [F.col("k")], 50, 50, 8)


def test_deletes_share_the_uploads(spark):
    batches = spark.createDataFrame([("b", 0, 2, 10), ("a", 1, 3, 10), ("a", 0, 3, 10)], "root_id string, batch long, n_items long, n_bytes long")
    deletes = spark.createDataFrame([('d"1',), ("c",), ("e",)], "document_id string")
    rows = uploads.delta_uploads(batches, deletes, ["root_id", "batch"], 6, 60, 10).collect()
    assert sorted((x["upload"], x["root_id"] or "", x["document_id"] or "", x["n_bytes"]) for x in rows) == [(0, "a", "", 10), (0, "a", "", 10), (1, "", "c", 9), (1, "", 'd"1', 18), (1, "", "e", 9), (1, "b", "", 10)]


OPS = "batch long, op string, pos long, document_id string, item string"


def test_one_payload_for_each_batch(spark, tmp_path):
    rows = [(0, "addOrUpdate", 2, "b", '{"x":2}'), (0, "addOrUpdate", 1, "a", '{"x":"é\\n"}'), (0, "delete", 3, 'c"', None), (1, "delete", 1, "a", None), (2, "addOrUpdate", 1, "z", '{"x":3}')]
    at = f"file://{tmp_path}/out"
    uploads.write_payloads(spark.createDataFrame(rows, OPS), at)
    got = {x["batch"]: json.loads(x["value"]) for x in spark.read.text(at).collect()}
    assert got == {0: {"addOrUpdate": [{"x": "é\n"}, {"x": 2}], "delete": ['c"']}, 1: {"addOrUpdate": [], "delete": ["a"]}, 2: {"addOrUpdate": [{"x": 3}], "delete": []}}


@pytest.mark.parametrize(("bad", "why"), [
    ([(0, "addOrUpdate", 1, "a", "{1}"), (0, "delete", 2, "a", None)], "batch 0: a document is added and deleted"),
    ([(5, "delete", 1, "a", None), (5, "delete", 2, "a", None)], "batch 5: a document comes twice"),
    ([(1, "addOrUpdate", 1, "a", " {} ")], "batch 1: an empty operation"),
    ([(1, "addOrUpdate", 1, "", "{1}")], "batch 1: an empty operation"),
    ([(1, "other", 1, "a", "{1}")], "batch 1: an empty operation"),
])
def test_a_refused_batch_writes_nothing(spark, tmp_path, bad, why):
    at = f"file://{tmp_path}/out"
    good = [(7, "delete", 1, "x", None)]
    with pytest.raises(Exception, match=why):
        uploads.write_payloads(spark.createDataFrame(good + bad, OPS), at)
    assert not generations.exists(spark, f"{at}/_SUCCESS")


def test_full_runs_leave_nothing_older(spark, tmp_path):
    at = f"file://{tmp_path}/index"
    ops = lambda *rows: spark.createDataFrame(list(rows), "upload long, document_id string, op string, item string")
    held = lambda: sorted(tuple(x) for x in uploads.index(spark, at).collect())
    assert uploads.index(spark, at).count() == 0
    assert uploads.push(spark, at, ops((0, "a", "addOrUpdate", "1"), (1, "b", "addOrUpdate", "1"), (1, "c", "addOrUpdate", "1"))) == 1
    assert uploads.push(spark, at, ops((0, "b", "delete", None), (0, "d", "addOrUpdate", "2"))) == 3
    assert held() == [("a", 1, "1"), ("c", 2, "1"), ("d", 3, "2")]
    assert uploads.full_run(spark, at, ops((0, "a", "addOrUpdate", "3"), (2, "d", "addOrUpdate", "3"))) == 4
    assert held() == [("a", 4, "3"), ("d", 6, "3")]
    assert [n for n in generations.active(spark, at)["tables"]] == ["index 4"]
    uploads.delete_older_than(spark, at, 5)  # a boundary inside a run
    assert held() == [("d", 6, "3")]
    uploads.delete_older_than(spark, at, 2)  # it never moves back
    assert held() == [("d", 6, "3")]
    assert uploads.push(spark, at, ops()) is None and held() == [("d", 6, "3")]
    assert uploads.full_run(spark, at, ops()) == 7 and held() == []
    assert uploads.push(spark, at, ops((0, "a", "addOrUpdate", "9"))) == 8 and held() == [("a", 8, "9")]
