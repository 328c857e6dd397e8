"""Phrases, periodic runs and SimHash against brute force and edge cases, on small tables."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import tracemalloc
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfwise.llm import periodic_runs, phrases, simhash

DOCS = "doc_id long, text string, lang string, source string, phrase string, node string, group long"
LONG = " ".join(f"word{i}" for i in range(30_000))


def make_docs(spark, texts, langs=None):
    return spark.createDataFrame([(i, t, (langs or {}).get(i, "en"), "s", "clash", "clash", 1) for i, t in texts], DOCS)


def ascii_lower(t):
    return (t or "").encode().lower()


# 11 phrases
def brute_phrases(rows, least=10, share=50, top=2000):
    out, counts = [], {}
    for lang, text in rows:
        f = counts.setdefault(lang or "und", Counter())
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", ascii_lower(text)):
            w = [x for x in re.split(rb"[ \t]+", piece) if x]
            f.update(tuple(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in cands.items():
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if not any(len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cands.items()):
                found.append((-score, -a, b" ".join(p), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def phrase_rows(n=150):
    r = random.Random(3)
    common = ["ax", "aY", "bé", "a\x01b", "a\x00", "a", "a\x01", "\x1c", "\u00a0"]
    rows = [(r.choice(["en", "de", None, "a\x00b"]), "".join(r.choice(common) + r.choice([" ", " ", " ", " ", " ", "\t", "  ", ". ", "!", "\n"]) for _ in range(r.randint(0, 120)))) for _ in range(n)]
    return [*rows, ("en", None), (None, ""), ("fr", " \t. ,"), ("en", LONG)] + [("de", "New York City hall")] * 12 + [("de", "new york")] * 9


@pytest.mark.parametrize(("budget", "cells", "lot", "bits"), [(10**6, 1 << 16, 6_000_000, 24), (40, 32, 6_000_000, 16), (5, 4, 300, 24)])
def test_phrases_by_brute_force(spark, monkeypatch, budget, cells, lot, bits):
    """Also with so little memory that hot words, and pairs of words, are many groups, and a table that tells little."""
    monkeypatch.setattr(phrases, "CELLS", cells)
    rows = phrase_rows()
    docs = spark.createDataFrame([(i, t, lang, "s", "p", "n", 1) for i, (lang, t) in enumerate(rows)], DOCS)
    want = brute_phrases(rows)
    assert want and any(x[0] == "und" for x in want) and any(x[2] == "york city hall" for x in want) and not any(x[2] == "york city" for x in want)
    assert sorted(tuple(x) for x in phrases.collocations(phrases.phrase_counts(docs, budget=budget, bits=bits, lot=lot)).collect()) == want


def test_phrases_of_large_vocabularies_and_no_rows(spark):
    ids, names = phrases._marked([b"a b. a b c", b"B"])
    assert names == [b".", b"a", b"b", b"c"] and ids.tolist() == [1, 2, 0, 1, 2, 3, 0, 2]
    reach = np.array([2, 1, 0, 3, 2, 1, 0, 1])
    paths, counts = phrases.merged_paths(ids, len(names), reach)
    assert {tuple(names[i].decode() for i in p if i): c for p, c in zip(zip(*(x.tolist() for x in paths), strict=True), counts.tolist(), strict=True)} == {("a", "b"): 1, ("a", "b", "c"): 1, ("b",): 2, ("b", "c"): 1, ("c",): 1}
    wide, counts_ = phrases.merged_paths(ids, len(names), reach, most=40)  # too wide for one number
    assert sorted(counts_.tolist()) == sorted(counts.tolist()) and len(wide) == 40
    cut, _ = phrases.merged_paths(ids, len(names), np.array([1, 0, 0, 1, 0, 1, 0, 0]))
    assert {tuple(names[i].decode() for i in p if i) for p in zip(*(x.tolist() for x in cut), strict=True)} == {("a",), ("c",)}
    assert phrases.collocations(phrases.phrase_counts(make_docs(spark, []))).count() == 0
    assert phrases.collocations(phrases.phrase_counts(make_docs(spark, [(None, None), (1, "")]))).count() == 0


def test_tree_nodes_are_sums_of_leaves():
    r = random.Random(5)
    for _ in range(60):
        leaves = Counter(tuple([b"l", *(bytes([r.choice(b"\x02ab"), *r.choice([b"", b"a"])]) for _ in range(r.randint(0, 3)))]) for _ in range(r.randint(1, 60)))
        paths = sorted(b"\0".join(p) for p in leaves)
        counts = np.array([leaves[tuple(p.split(b"\0"))] for p in paths])
        want = Counter()
        for p, c in leaves.items():
            want.update({p[:k]: c for k in range(1, len(p) + 1)})
        for least in (1, 4):
            got = {tuple(p.split(b"\0")): n for p, n in phrases.tree_nodes(paths, counts, np.ones(len(paths), dtype=np.int64), least)}
            assert got == {p: n for p, n in want.items() if n >= least or len(p) == 1}


def test_nodes_take_little_memory_and_go_on_over_batches():
    """A very long word doesn't widen what other paths take; a word that starts all paths is read a few rows at a time."""
    long = sorted([b"l\0" + b"x" * 1_000_000, *(b"l\0w%03d" % k for k in range(300))])
    tracemalloc.start()
    got = phrases.tree_nodes(long, np.full(len(long), 10), np.ones(len(long), dtype=np.int64), 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == 302 and peak < 30_000_000
    r = random.Random(6)
    leaves = Counter(b"\0".join([b"l", *([b"hot"] if r.random() < 0.9 else []), *(r.choice([b"a", b"b", b"cc", b"d"]) for _ in range(r.randint(0, 2)))]) for _ in range(2000))
    paths = sorted(p for p, n in leaves.items() for _ in range(min(n, 40)))  # equal paths of several lots
    counts = np.array([r.randint(1, 9) for _ in paths])
    for depth, least in ((1, 10), (2, 500), (3, 10)):
        parted = np.full(len(paths), depth)
        want = sorted(phrases.tree_nodes(paths, counts, parted, least))
        for rows in (1, 7, 10**6):
            batches = [pa.RecordBatch.from_arrays([pa.array(paths[k : k + 5]), pa.array(counts[k : k + 5]), pa.array(parted[k : k + 5])], names=["path", "n", "depth"]) for k in range(0, len(paths), 5)]
            lots = list(phrases.nodes_of(iter(batches), least, rows))
            assert sorted(x for lot in lots for x in lot) == want and (rows > 7 or len(lots) > 50)


def test_counts_of_cells_end_at_the_least():
    rng = np.random.default_rng(1)
    counts, all_ = np.zeros(1 << 10, dtype=np.uint8), np.zeros(1 << 10, dtype=np.int64)
    for n in (0, 1, 50_000, 300):
        cells = rng.integers(0, 1 << 10, n) // rng.integers(1, 40, n)
        phrases._add(counts, cells, 255)
        all_ += np.bincount(cells, minlength=1 << 10)
    assert (counts == np.minimum(all_, 255)).all() and all_.max() > 255


def test_phrase_groups_respect_the_budget(spark):
    r = random.Random(4)
    docs = make_docs(spark, [(i, " ".join(r.choice(["the", f"w{r.randint(0, 200)}"]) for _ in range(300))) for i in range(60)])
    paths = phrases._paths(docs.select("lang", F.col("text").cast("binary").alias("text")), np.full(1 << phrases.BITS - 3, 255, dtype=np.uint8)).cache()
    dealt, groups = phrases.grouped(paths, 1000)
    sizes = [x["count"] for x in dealt.groupBy("group").count().collect()]
    assert sum(sizes) == paths.count() and max(sizes) <= 1000 and len(sizes) == groups
    assert dealt.filter("depth > 1").count() > 0  # a word that a third of the paths start with


def test_scores_are_exact_beyond_64_bits(spark):
    n = 10**14 + 7
    nodes = spark.createDataFrame([("en", "", 0, 10 * n), ("en", "a", 1, 2 * n), ("en", "b", 1, n + 1), ("en", "a b", 2, n)], "lang string, phrase string, n_words int, n long")
    assert [tuple(x) for x in phrases.collocations(nodes).collect()] == [("en", 1, "a b", n, 2 * n, n + 1, 10 * n, 10**6 * n * n // (2 * n * (n + 1)))]


# 12 periodic runs
def brute_runs(w, exponent=4, least=6):
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, exponent * q) and not any(all(w[k] == w[k + p] for k in range(i, i + size - p)) for p in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda x: (x[0], x[2]))


def test_lyndon_groups_are_longest_lyndon_words():
    r = random.Random(1)
    for _ in range(400):
        w = [r.randint(1, r.randint(1, 4)) for _ in range(r.randint(1, 40))]
        _, ranks = np.unique(w, return_inverse=True)
        for letters in (ranks + 1, ranks.max() + 1 - ranks):
            s, (length, group) = letters.tolist(), periodic_runs.lyndon_groups(letters)
            assert length.tolist() == [next((j - i for j in range(i + 1, len(s)) if s[j:] < s[i:]), len(s) - i) for i in range(len(s))]
            roots = {(tuple(s[i : i + k]), g) for i, (k, g) in enumerate(zip(length.tolist(), group.tolist(), strict=True))}
            assert len(roots) == len({x for x, _ in roots}) == len({g for _, g in roots})
            order = sorted(range(len(s)), key=lambda i: group[i])
            assert len(order) == len(s)


@pytest.mark.parametrize(("exponent", "least"), [(4, 6), (2, 2), (3, 5)])
def test_runs_by_brute_force(exponent, least):
    r = random.Random(2)
    texts = [[b"w%d" % r.randint(0, r.randint(0, 5)) for _ in range(r.randint(0, 60))] for _ in range(300)]
    assert periodic_runs.runs_of_texts(texts, exponent, least) == [brute_runs(t, exponent, least) for t in texts]


def test_runs_query_by_brute_force(spark, tmp_path):
    r = random.Random(6)
    period = [f"p{i}" for i in range(7)]
    texts = [(i, " ".join(f"w{r.randint(0, 6)}" for _ in range(r.randint(0, 90)))) for i in range(150)]
    texts += [(200, "a A a A a A a A"), (201, " ".join(period * 4)), (202, " ".join(period * 4)[:-1]), (203, "x " * 5), (204, "x\t" * 6), (205, "é " * 2000 + "z"), (206, LONG[:12_000]), (207, None), (208, "")]
    texts += [(None, "y " * 9), (None, None), (201, " ".join(period * 4)), (209, " ".join((period * 5 + ["q"]) * 5)), (210, "a a a a a a b b b b b b"), (211, "a\x00 " * 8 + " ")]
    make_docs(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(x) for x in periodic_runs.op12_runs(spark, str(tmp_path)).drop("n_words").collect()), key=str)
    want = []
    for i, t in texts:
        w = (t or "").encode().split()
        n, h = len(w), zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[a + (k - a) % p] if k >= a else w[k] for k in range(n)]
        runs = brute_runs(w)
        gone = {k for s, size, q in runs for k in range(s + q, s + size)}
        s, size, q = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None, None, None))
        digest = lambda b: hashlib.sha256(b).hexdigest()
        want.append((i, len(runs), s, size, q, 1000 * size // q if runs else None, digest("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()), digest(b" ".join(x for k, x in enumerate(w) if k not in gone))))
    assert got == sorted(want, key=str)
    assert sum(x[1] for x in want) > 20 and any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in texts)
    assert periodic_runs.periodic_runs(make_docs(spark, [])).count() == 0


def test_runs_of_lots_without_a_word_that_comes_often(spark):
    """A lot can be the few short documents that are left of a batch: then no word comes often enough, at once or once others have parted the text."""
    texts = ["a b", "one word more", "", "a b c a b c x a b c y a b c", "x"]
    for lot in [[t] for t in texts] + [texts]:
        lot = [t.encode().split() for t in lot]
        assert periodic_runs.runs_of_texts(lot) == [brute_runs(t) for t in lot] == [[]] * len(lot)
    rows = periodic_runs.periodic_runs(make_docs(spark, list(enumerate(texts))).coalesce(1)).collect()
    assert sorted(tuple(x) for x in rows) == [(i, len(t.split()), [], t) for i, t in enumerate(texts)]


def test_runs_take_linear_time():
    r = np.random.default_rng(1)
    s = np.tile(r.integers(0, 50, 1000), 60)
    assert periodic_runs.runs_of(s) == [(0, 60_000, 1000)]
    assert periodic_runs.runs_of(np.zeros(100_000, dtype=np.int64)) == [(0, 100_000, 1)]


# 13 SimHash
def brute_fingerprint(t):
    w = ascii_lower(t).split()
    k = min(3, len(w))
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), 42) for i in range(len(w) - k + 1)] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, prints, budget=2):
    kinds = sorted(set(prints))
    root = {x: x for x in kinds}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(kinds, 2):
        if (a ^ b).bit_count() <= budget:
            root[find(a)] = find(b)
    least = {}
    for i, x in zip(ids, prints, strict=True):
        least.setdefault(find(x), []).append(i)
    return [min((k for k in least[find(x)] if k is not None), default=None) for x in prints]


def test_trie_walk_finds_all_near_pairs():
    r = random.Random(1)

    def crowd(n):
        out = {0, (1 << 64) - 1}
        while len(out) < n:
            x = r.choice(base) if r.random() < 0.7 else r.getrandbits(64)
            for _ in range(r.randint(0, 4)):
                x ^= 1 << r.randrange(64)
            out.add(x)
        return np.array(sorted(out), dtype=np.uint64)

    for budget in (0, 1, 2, 3):
        base = [r.getrandbits(64) for _ in range(5)]
        a, b = crowd(200), crowd(150)
        pairs = lambda x: sorted(p for i, j in x for p in zip(i.tolist(), j.tolist(), strict=True))
        near = [(i, j) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count(a[i] ^ b) <= budget).tolist()]
        own = [(i, j) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count(a[i] ^ a) <= budget).tolist() if i < j]
        assert pairs(simhash.near_pairs(a, b, budget)) == near
        assert pairs(simhash.near_pairs(a, None, budget)) == own


@pytest.mark.parametrize("lot", [10**6, 40, 1])
def test_links_by_brute_force(spark, lot):
    """Leaves of any size, down to single fingerprints, and crowds below one long prefix."""
    r = random.Random(8)
    base = [r.getrandbits(64) for _ in range(4)]
    prints = [0, 1, (1 << 64) - 1, 1 << 63]
    for _ in range(500):
        x = r.choice(base) if r.random() < 0.8 else r.getrandbits(64)
        for _ in range(r.randint(0, 4)):
            x ^= 1 << r.choice([*range(12), *range(64)])
        prints.append(x)
    prints = sorted(set(prints))
    kinds = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in prints], "fp long")
    top = simhash.top_of(kinds, lot)
    root = {x: x for x in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in simhash._links(kinds, top, chunk=50).collect():
        assert u != v
        a, b = sorted((find(u % (1 << 64)), find(v % (1 << 64))))
        root[b] = a
    assert [find(x) for x in prints] == brute_components(prints, prints)


def test_simhash_by_brute_force(spark, tmp_path):
    r = random.Random(9)
    texts = []
    for i in range(60):
        w = [f"w{r.randint(0, 400)}" for _ in range(r.randint(1, 300))]
        texts.append((4 * i + 3, " ".join(w)))
        if i % 3 == 0 and len(w) > 5:
            w[r.randrange(len(w))] = "Changed"
            texts.append((4 * i, " ".join(w).upper()))
    texts += [(400, None), (401, ""), (399, " \t\r\n"), (402, "one"), (403, "ONE"), (404, "one two"), (None, "one two"), (None, "só this"), (405, LONG), (406, LONG), (405, "other text"), (None, None), (407, "a\x00b \x1c c d")]
    make_docs(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = simhash.op13_simhash(spark, str(tmp_path)).collect()
    prints = [brute_fingerprint(t) for _, t in texts]
    want = [(i, f"{x:016x}", c) for (i, _), x, c in zip(texts, prints, brute_components([i for i, _ in texts], prints), strict=True)]
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert len({c for _, _, c in want}) < len(texts) - 10
    assert simhash.near_duplicates(make_docs(spark, [])).count() == 0


def test_shingle_hash_is_that_of_the_engine(spark):
    text = "Ärger im Haus " * 3
    w = ascii_lower(text).split()
    rows = spark.createDataFrame([(b" ".join(w[i : i + 3]).decode(),) for i in range(len(w) - 2)], "s string").select(F.xxhash64("s").alias("h")).collect()
    assert simhash.fingerprint(text.encode()) == sum(1 << b for b in range(64) if 2 * sum((x["h"] >> b) & 1 for x in rows) > len(rows))
