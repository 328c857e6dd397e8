"""Periodic runs of words by Lyndon roots, and texts with each run cut to one period.

1. Words become numbers, document by document. A word of a run comes at least `least_exponent` times in it, so words that are
   rarer in their stretch of text part the text; what is left are the stretches that can hold a run at all. No run crosses a gap.
2. Baier's grouping, the first phase of his suffix sorter, over all stretches of a lot at once: suffixes start in groups by first
   word; groups are taken from the highest down, and each suffix of a group lengthens the context of the nearest suffix
   before it that is in a lower group. At the end a suffix's group is its longest Lyndon prefix: its length is the Lyndon array,
   and equal groups are equal Lyndon words. It is done under an order of the words and under its reverse.
3. Each run has a Lyndon root under one of the two orders. The first of a chain of equal roots is extended to both sides by
   the longest common extension of the text and the text one period on.

A document is handled within one task, in time linear in its words; lots of documents are bounded by their words, so a very
long text is a lot of its own and is never cut. There is no shuffle.

Nulls: a null text has no words and no runs; ids are only carried along. An empty table gives none. Repeated rows each get their
result. Ties: runs of one start are told by their period. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import table, words

LEAST_EXPONENT, LEAST_LENGTH = 4, 6
#: Words of documents that are handled at a time.
_LOT = 1_000_000


def lyndon_groups(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per position the length of its longest Lyndon word, and its group: equal numbers are equal words.

    Letter 0 parts stretches: no word reaches it, and it has none itself.
    """
    n = len(letters)
    # position 0 stands before the text, in group 0 like all parting letters: these are never moved nor taken
    of = [0, *letters.tolist()]
    top = max(of)
    by_letter = np.argsort(letters, kind="stable") + 1
    ends = np.searchsorted(letters[by_letter - 1], np.arange(top + 1), side="right").tolist()
    members = [[], *(by_letter[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False))]
    length = [0, *([1] * top)]
    below = list(range(-1, top))
    above = [*range(1, top + 1), -1]
    # where to look on from a position: itself while its group hasn't been taken
    seen = list(range(n + 1))
    group = top
    while group > 0:
        times: dict[int, int] = {}
        for i in members[group]:
            if of[i] == group:
                j = i - 1
                while (k := seen[j]) != j:
                    j = k
                seen[i] = j
                if of[j]:
                    times[j] = times.get(j, 0) + 1
        members[group] = []
        if times:
            grown, made = length[group], {}
            # each new group stands right above the old one, so those with fewer repeats come last
            for j, t in sorted(times.items(), key=lambda x: (-x[1], x[0])) if max(times.values()) > 1 else times.items():
                old = of[j]
                if (new := made.get((old, t))) is None:
                    made[old, t] = new = len(length)
                    length.append(length[old] + t * grown)
                    members.append([])
                    up = above[old]
                    above[old], below[up] = new, new
                    above.append(up)
                    below.append(old)
                members[new].append(j)
                of[j] = new
        group = below[group]
    groups = np.array(of[1:], dtype=np.int64)
    return np.array(length, dtype=np.int64)[groups], groups


def _extension(s: np.ndarray, i: int, j: int) -> int:
    """How many places from i and from j > i on are equal."""
    total, step = 0, 32
    while j < len(s):
        width = min(step, len(s) - j)
        differ = s[i : i + width] != s[j : j + width]
        if differ.any():
            return total + int(differ.argmax())
        total, i, j, step = total + width, i + width, j + width, 2 * step
    return total


def runs_of(s: np.ndarray, exponent: int = LEAST_EXPONENT, least: int = LEAST_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of s; negative numbers part it and all differ. `exponent` is at least 2."""
    n, found = len(s), set()
    if not n:
        return []
    part = s < 0
    _, ranks = np.unique(s[~part], return_inverse=True)
    back = s[::-1]
    for order in (ranks + 1, ranks.max(initial=0) + 1 - ranks):
        letters = np.zeros(n, dtype=np.int64)
        letters[~part] = order
        period, group = lyndon_groups(letters)
        ahead = np.minimum(np.arange(n) + period, n - 1)
        equal = (group[ahead] == group) & (group > 0) & (np.arange(n) + period < n)
        again = np.zeros(n, dtype=bool)  # a root like the one before it belongs to that one's run
        again[ahead[equal]] = True
        # a run of exponent 3 has two whole roots in a row; shorter ones show the root's first word again
        open_ = equal if exponent >= 3 else (s[ahead] == s) & ~part & (np.arange(n) + period < n)
        for i in np.flatnonzero(open_ & ~again).tolist():
            p = int(period[i])
            left = _extension(back, n - i - p, n - i)
            size = left + p + _extension(s, i, i + p)
            if size >= max(least, exponent * p):
                found.add((i - left, size, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _stretches(ids: np.ndarray, doc: np.ndarray, exponent: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the stretches in which each word comes at least `exponent` times, and each place's stretch."""
    at, part = np.arange(len(ids)), doc
    while len(at):
        _, kind, count = np.unique(part * (int(ids.max()) + 1) + ids[at], return_inverse=True, return_counts=True)
        keep = count[kind] >= exponent
        at, part = at[keep], part[keep]
        if not len(at):
            break
        part = np.cumsum(np.append(0, (np.diff(at) != 1) | (np.diff(part) != 0)))
        long = np.bincount(part)[part] >= least
        if keep.all() and long.all():
            break
        at, part = at[long], part[long]
    return at, part


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def runs_of_texts(texts: list[list[bytes]], exponent: int = LEAST_EXPONENT, least: int = LEAST_LENGTH) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, given as its words."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    numbers = _Numbers()
    ids = np.fromiter((numbers[w] for t in texts for w in t), dtype=np.int64, count=int(sizes.sum()))
    doc = np.repeat(np.arange(len(texts)), sizes)
    at, part = _stretches(ids, doc, exponent, least)
    if not len(at):
        return out
    # the stretches one after another, each behind a number of its own
    place = np.arange(len(at)) + part + 1
    s = -1 - np.arange(len(at) + int(part[-1]) + 1)
    s[place] = ids[at]
    where = np.zeros(len(s), dtype=np.int64)
    where[place] = at
    begins = np.cumsum(sizes) - sizes
    for start, size, p in runs_of(s, exponent, least):
        first = int(where[start])
        out[int(doc[first])].append((first - int(begins[doc[first]]), size, p))
    return out


def collapsed(text: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that any run holds after its first period."""
    if not runs:
        return text
    gone = np.zeros(len(text) + 1, dtype=np.int64)
    for start, size, p in runs:
        gone[start + p] += 1
        gone[start + size] -= 1
    return [w for w, g in zip(text, np.cumsum(gone).tolist(), strict=False) if not g]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", exponent: int = LEAST_EXPONENT, least: int = LEAST_LENGTH) -> DataFrame:
    """Per document: doc_id, n_words, runs (start, length, period) by start and period, and collapsed, the words that stay, joined by a space."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def lot(ids: list, texts: list[list[bytes]], kind: pa.DataType) -> pa.RecordBatch:
        every = runs_of_texts(texts, exponent, least)
        kept = [b" ".join(collapsed(t, r)).decode("utf-8", "replace") for t, r in zip(texts, every, strict=True)]
        runs = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in every]
        columns = [pa.array(ids, type=kind), pa.array([len(t) for t in texts], type=pa.int64()), pa.array(runs, type=pa.list_(run_type)), pa.array(kept, type=pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, size = [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc)
                texts.append(text.as_py().encode().split())
                size += len(texts[-1])
                if size >= _LOT:
                    yield lot(ids, texts, batch.column(0).type)
                    ids, texts, size = [], [], 0
            if ids:
                yield lot(ids, texts, batch.column(0).type)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def _bound(value: Column, fn: Callable[[Column], Column]) -> Column:
    """fn of the value, which is computed once and not at each place where fn has it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def with_repeats(doc_id: Column, text: Column) -> Column:
    """The text in which every tenth document, by the checksum of its id, repeats a stretch of its words to its end."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i, v: F.when(i >= v["a"], v["a"] + (i - v["a"]) % v["p"]).otherwise(i).cast("int")
        every = lambda v: F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, place(i, v)))
        return F.when(n > 0, F.array_join(_bound(F.struct(a.alias("a"), p.alias("p")), every), " ")).otherwise("")

    return F.when(h % 10 == 0, _bound(words(text), repeated)).otherwise(text)


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs(docs.select("doc_id", with_repeats(F.col("doc_id"), F.col("text")).alias("text")))
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    # runs come by start and period: the first of the greatest exponent stays
    best = F.aggregate("runs", none, lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    out = found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat(lines, F.when(F.size("runs") > 0, "\n").otherwise("")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words",
    )
    return out
