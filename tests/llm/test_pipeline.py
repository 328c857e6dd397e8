"""The pipeline against a brute-force version of its stages."""

from __future__ import annotations

import itertools

import corpus_pipeline
from shelfwise.llm import decontam, mixing, ngram_join, quality

SF = "/root/testdata/sf0.001"


def test_run_follows_its_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r["doc_id"] for r in quality.apply_policy(quality.ledger(docs)).collect() if r["kept"]}
    now = docs.filter(docs.doc_id.isin(*kept))
    texts = {r["doc_id"]: r["text"] for r in now.collect()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, t in texts.items() for w in [t.encode().lower().split()]}
    root = {i: i for i in sets}
    for i, j in itertools.combinations(sorted(sets), 2):
        if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            old, new = sorted((root[i], root[j]), reverse=True)
            root = {k: new if v == old else v for k, v in root.items()}
    now = now.filter(now.doc_id.isin(*set(root.values())))
    leaks = {r["doc_id"] for r in decontam.contamination(now, spark.read.parquet(f"{sf}/benchmark.parquet")).collect() if r["contaminated"]}
    now = now.filter(~now.doc_id.isin(*leaks, -1))
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(now).collect() if r["copies"]}
    rows = corpus_pipeline.run(spark, sf).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [i for i in sorted(copies) for _ in range(copies[i])]
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:], strict=False))
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality rules" and len(corpus_pipeline.STAGES) == 5


def test_stages_on_odd_rows(spark):
    """Nulls in every column, repeated rows, a very long text, clashing names; then no rows at all. What each stage leaves, row by row."""
    good = " ".join(f"v{i}" for i in range(50_000, 50_120))
    long = " ".join(f"v{i}" for i in range(40_000))
    other = " ".join(f"v{i}" for i in range(60_000, 60_120))
    rows = [(1, good, "en", "a", 5, "x", 1, "k"), (1, good, "en", "a", 5, "x", 1, "k"), (None, other, None, None, None, None, None, None), (2, None, "en", "a", 0, "x", 1, "k"), (3, "", "en", None, 0, "x", 1, "k"), (4, long, "en", "b", 5, "x", 1, "k"), (None, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _sid string, root long, row string")
    left = [[1, 1, None, 4], [1, None, 4], [1, None, 4]]  # rules, Jaccard, decontamination; the mix may repeat
    for now, want in ((docs, left), (docs.limit(0), [[], [], []])):
        for (name, stage), ids in zip(corpus_pipeline.STAGES[:4], [*want, None], strict=True):
            now = spark.createDataFrame(stage(spark, now, SF).collect(), now.schema)
            assert now.columns == docs.columns, name
            got = [r["doc_id"] for r in now.collect()]
            if ids is None:
                # budgets are those of all three sources: each word of the mix is near its target
                assert set(got) == set(want[-1]) or len(want[-1]) > len(set(got)) > 0
            else:
                assert sorted(got, key=str) == sorted(ids, key=str), name
            assert {tuple(r) for r in now.collect()} <= set(rows)
        out = corpus_pipeline.STAGES[4][1](spark, now, SF).collect()
        assert sorted((r["doc_id"] for r in out), key=str) == sorted((r["doc_id"] for r in now.collect()), key=str)


def test_rows_that_differ_elsewhere_are_chosen_alike(spark):
    """Of rows with one id and text the same one stays, whatever order they come in."""
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(7, text, "en", f"s{i}") for i in range(9)] + [(None, text + " x", "en", f"t{i}") for i in range(9)]
    kept = [sorted(map(tuple, ngram_join.keep_one(spark.createDataFrame(r, "doc_id long, text string, lang string, source string").repartition(n)).collect())) for r, n in ((rows, 1), (rows[::-1], 3))]
    assert kept[0] == kept[1] and [x[0] for x in kept[0]] == [7]
