"""SimHash near-duplicates: fingerprints that differ in at most `BUDGET` bits, by a self-join of their binary trie.

1. A fingerprint bit is set if over half of a text's 3-word shingles, repeats included, have it set in their XXH64.
   Equal fingerprints are one node of what follows, so copies of a text cost one row each and nothing more.
2. The trie's top: counts of fingerprints by prefix, 16 bits and then 8 more for full prefixes only, so that a leaf holds at most
   a lot of fingerprints, however they crowd. Two nodes are walked down together; a step to unlike sides costs a bit, and a
   pair goes once its bits exceed the budget. What is left are the pairs of leaves that can hold links.
3. Each leaf's fingerprints meet themselves and those of the later leaves it is paired with, in tasks: the same walk goes on
   below the leaf, over ranges of the sorted fingerprints, for all pairs of nodes of a level at once. A task keeps one leaf; the others pass by
   in chunks. A chunk's links leave as one star for each group that they join, so dense groups don't give squares of rows.
4. Components of the fingerprints, then of the documents.

A fingerprint has at most 2,080 others within two bits, so the work on a crowded leaf is linear in it. The driver holds the
trie's top only: at most 65,536 prefixes, 256 for each prefix that was too full, and the leaves, of which there are some `LEAVES` or one for
half a lot of fingerprints.

Nulls: a null or blank text has fingerprint zero and links like any other. A component's id is its least doc_id; null if it has none. Rows
that share an id stand for themselves, each with its own text. Repeated rows and ties are equal fingerprints. Texts of any length are hashed whole; an empty
table gives none. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import dropped, table, written
from shelfwise.llm.graph import components

WIDTH, BUDGET, BITS, SEED = 3, 2, 64, 42
#: Fingerprints of a leaf: the more there are, the larger, from LEAST to MOST.
LEAVES, LEAST_LOT, MOST_LOT = 256, 256, 1_000_000
#: Pairs of trie nodes, and fingerprints that pass by, that are handled at once.
_FRONT, CHUNK = 500_000, 200_000
#: Links that become stars at once.
_LINKS = 2_000_000
#: Pairs of fingerprints below two nodes that are compared without walking on.
_SMALL = 8


def fingerprint(text: bytes | None, width: int = WIDTH) -> int:
    """The fingerprint as an unsigned number; A-Z are lower-cased, white space is space and \\t to \\r."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    width = min(width, len(words))
    every = map(b" ".join, zip(*(words[k:] for k in range(width)), strict=False))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in every), dtype="<u8", count=len(words) - width + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(hashes), 1 << 14):
        ones += np.unpackbits(hashes[k : k + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """Per document: doc_id and fp, the fingerprint as a signed number."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), width) for t in batch.column(1)), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def _bit(values: np.ndarray, depth: np.ndarray | int) -> np.ndarray:
    return (values >> np.uint64(BITS - 1 - depth)) & np.uint64(1)


def near_pairs(a: np.ndarray, b: np.ndarray | None, budget: int = BUDGET) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places i in a and j in b (in a itself, i < j, if b is None) of fingerprints at most `budget` bits apart.

    Both are sorted unsigned numbers, without repeats. A node of the trie is a range of places; pairs of nodes are walked
    down together, level by level.
    """
    own = b is None
    b = a if own else b
    if not len(a) or not len(b):
        return
    start = tuple(np.array([v], dtype=np.int64) for v in (0, len(a), 0, len(b), 0))
    todo = [(0, start)]
    while todo:
        depth, (la, ha, lb, hb, bits) = todo.pop()
        small = ((ha - la) * (hb - lb) <= _SMALL) | (depth == BITS)
        if small.any():
            x0, nx, y0, ny = la[small], (ha - la)[small], lb[small], (hb - lb)[small]
            each = nx * ny
            k = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
            i, j = np.repeat(x0, each) + k // np.repeat(ny, each), np.repeat(y0, each) + k % np.repeat(ny, each)
            near = np.bitwise_count(a[i] ^ b[j]) <= budget
            if own:
                near &= i < j
            yield i[near], j[near]
            la, ha, lb, hb, bits = (v[~small] for v in (la, ha, lb, hb, bits))
        if not len(la):
            continue
        # places below are counted once for the level: how many of the fingerprints before a place have the bit
        ones_a, ones_b = (np.append(0, np.cumsum(_bit(v, depth).astype(np.int64))) for v in (a, b))
        ma, mb = (h - (ones[h] - ones[low]) for h, low, ones in ((ha, la, ones_a), (hb, lb, ones_b)))
        sides = [(la, ma, lb, mb, bits), (ma, ha, mb, hb, bits), (la, ma, mb, hb, bits + 1), (ma, ha, lb, mb, bits + 1)]
        if own:  # a node with itself: the two sides meet once
            same = la == lb
            sides[3] = tuple(v[~same] for v in sides[3])
        now = [np.concatenate(v) for v in zip(*sides, strict=True)]
        stays = (now[0] < now[1]) & (now[2] < now[3]) & (now[4] <= budget)
        now = [v[stays] for v in now]
        for k in range(0, len(now[0]), _FRONT):
            todo.append((depth + 1, tuple(v[k : k + _FRONT] for v in now)))


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links between u and v: each node but the least of its group, and that least."""
    nodes, inverse = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = inverse[: len(u)], inverse[len(u) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        while ((further := new[new]) != new).any():
            new = further
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


class Top:
    """The trie's top: leaves (first fingerprint, depth) in order, and for each the earlier leaves that it must meet."""

    def __init__(self, leaves: list[tuple[int, int]], budget: int = BUDGET) -> None:
        self.first = np.array([p for p, _ in leaves], dtype=np.uint64)
        self.depth = np.array([d for _, d in leaves], dtype=np.int64)
        self.budget = budget
        met: list[list[int]] = [[] for _ in leaves]
        end = len(leaves)
        # nodes are ranges of leaves at a depth; a leaf stays where it is while the other is walked down
        todo = [(0, 0, end, 0, end, 0)]
        while todo:
            depth, la, ha, lb, hb, bits = todo.pop()
            if ha - la == 1 and hb - lb == 1 and depth >= min(int(self.depth[la]), int(self.depth[lb])):
                if la < lb:
                    met[lb].append(la)
                continue
            sides = [self._split(lo, hi, depth) for lo, hi in ((la, ha), (lb, hb))]
            for x, (a0, a1) in enumerate(sides[0]):
                for y, (b0, b1) in enumerate(sides[1]):
                    # a leaf above this depth has fingerprints on both sides, so its step costs nothing
                    differ = bits + (x != y and not self._leaf(la, ha, depth) and not self._leaf(lb, hb, depth))
                    if a0 < a1 and b0 < b1 and differ <= budget and (a0 <= b0):
                        todo.append((depth + 1, a0, a1, b0, b1, differ))
        self.counts = np.array([len(set(m)) for m in met], dtype=np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        self.flat = np.array([x for m in met for x in sorted(set(m))], dtype=np.int64)

    def _leaf(self, lo: int, hi: int, depth: int) -> bool:
        return hi - lo == 1 and int(self.depth[lo]) <= depth

    def _split(self, lo: int, hi: int, depth: int) -> list[tuple[int, int]]:
        if self._leaf(lo, hi, depth):
            return [(lo, hi)]
        middle = lo + int((_bit(self.first[lo:hi], depth) == 0).sum())
        return [(lo, middle), (middle, hi)]

    def places(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where unsigned fingerprints must go: (leaf, which fingerprint, whether it is of another leaf)."""
        own = np.searchsorted(self.first, fp, side="right") - 1
        each = self.counts[own]
        k = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
        which = np.repeat(np.arange(len(fp)), each)
        leaf = self.flat[np.repeat(self.starts[own], each) + k]
        # only those that the budget lets into the leaf
        shift = (BITS - self.depth[leaf]).astype(np.uint64)
        apart = (fp[which] ^ self.first[leaf]) >> np.minimum(shift, np.uint64(BITS - 1))
        near = (np.bitwise_count(apart) <= self.budget) | (shift == BITS)
        return np.append(own, leaf[near]), np.append(np.arange(len(fp)), which[near]), np.append(np.zeros(len(fp), dtype=bool), np.ones(int(near.sum()), dtype=bool))


def _prefix(depth: int) -> Column:
    return F.shiftrightunsigned("fp", BITS - depth) if depth < BITS else F.col("fp")


def top_of(kinds: DataFrame, lot: int, budget: int = BUDGET) -> Top:
    """The trie's top over different fingerprints fp, leaves of at most `lot`."""
    spark = kinds.sparkSession
    leaves: list[tuple[int, int]] = []
    depth, full = 0, [0]
    rows = kinds.select("fp")
    while full:
        step = 16 if depth == 0 else 8
        if depth:
            known = spark.createDataFrame([(p - (1 << 64) if p >= 1 << 63 else p,) for p in full], "full long")
            rows = rows.join(F.broadcast(known), _prefix(depth) == F.col("full"), "left_semi")
        counted = {r["p"] % (1 << 64): r["n"] for r in rows.groupBy(_prefix(depth + step).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
        below: dict[int, list[int]] = {}
        for p in counted:
            below.setdefault(p >> step, []).append(p)
        next_: list[int] = []
        # split where a node is too full, bit by bit as far as the counts reach
        todo = [(below.get(p, []), p, depth) for p in full]
        while todo:
            cells, prefix, d = todo.pop()
            if not cells:  # nothing is there
                continue
            if sum(counted[c] for c in cells) <= lot or d == BITS:
                leaves.append(((prefix << (BITS - d)) % (1 << 64), d))
            elif d == depth + step:
                next_.append(prefix)
            else:
                bit = depth + step - d - 1
                todo += [([c for c in cells if (c >> bit) & 1 == side], 2 * prefix + side, d + 1) for side in (0, 1)]
        depth, full = depth + step, next_
    return Top(sorted(leaves) or [(0, 0)], budget)


def _links(kinds: DataFrame, top: Top, chunk: int = CHUNK) -> DataFrame:
    """(u, v): stars of linked fingerprints, for each leaf and chunk."""
    shared = kinds.sparkSession.sparkContext.broadcast(top)
    places = pa.schema([("leaf", pa.int32()), ("other", pa.bool_()), ("fp", pa.int64())])
    edges = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            leaf, which, other = shared.value.places(fp)
            yield pa.RecordBatch.from_arrays([pa.array(leaf.astype(np.int32)), pa.array(other), pa.array(fp[which].view(np.int64))], schema=places)

    def star(pairs: Iterator[tuple[np.ndarray, np.ndarray]], a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for pair in pairs:
            held.append(pair)
            size += len(pair[0])
            if size >= _LINKS:
                yield starred(held, a, b)
                held, size = [], 0
        if size:
            yield starred(held, a, b)

    def starred(held: list[tuple[np.ndarray, np.ndarray]], a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        i, j = (np.concatenate(x) for x in zip(*held, strict=True))
        u, v = stars(a[i].view(np.int64), b[j].view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=edges)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf, here, passing, waiting = None, None, [], []

        def done() -> Iterator[pa.RecordBatch]:
            nonlocal here, passing, waiting
            if waiting:  # the leaf's own are whole now
                here, waiting = np.sort(np.concatenate(waiting)), []
                yield from star(near_pairs(here, None, top_budget), here, here)
            if passing:
                b, passing = np.sort(np.concatenate(passing)), []
                yield from star(near_pairs(here, b, top_budget), here, b)

        for batch in batches:
            leaves, other, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            fp = fp.view(np.uint64)
            edge = np.flatnonzero((leaves[1:] != leaves[:-1]) | (other[1:] != other[:-1])) + 1
            for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), len(fp)], strict=True):
                if lo == hi:
                    continue
                if leaves[lo] != leaf:
                    yield from done()
                    leaf = leaves[lo]
                (passing if other[lo] else waiting).append(fp[lo:hi])
                if other[lo] and (waiting or sum(map(len, passing)) >= chunk):
                    yield from done()
        yield from done()

    top_budget = top.budget
    rows = kinds.select("fp").mapInArrow(dealt, "leaf int, other boolean, fp long")
    return rows.repartition("leaf").sortWithinPartitions("leaf", "other").mapInArrow(met, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, budget: int = BUDGET) -> DataFrame:
    """Per document: doc_id, fp (signed) and component_id, the least id of the documents that links reach."""
    rows = written(fingerprints(docs, id_col, text_col, width), "fingerprints")
    kinds = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "kinds")
    n = kinds.count()
    top = top_of(kinds, min(MOST_LOT, max(LEAST_LOT, n // LEAVES)), budget)
    links = written(_links(kinds, top), "links")
    roots = written(components(links), "roots")
    dropped(links)
    known = kinds.join(roots, kinds["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = known.groupBy("root").agg(F.min("least").alias("component_id"))
    of = known.join(named, "root").select(F.col("fp").alias("kind"), "component_id")
    return rows.join(of, rows["fp"] == of["kind"]).select("doc_id", "fp", "component_id")


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
