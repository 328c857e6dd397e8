"""Removal of repeated 100-byte strings, by column-wise construction over many short documents at once.

1. Each 100-byte window is assigned to its anchor, the 32-byte string in it with the least hash (the leftmost of equals).
   Equal windows have equal anchors at the same place, so only anchors that occur twice can hold repeats.
2. Around each such anchor the bytes of its windows are cut out: a short document of at most 168 bytes.
   Equal ones of a task are met at once; the first of each stands for all, the others are repeats as a whole.
3. The short documents are dealt by anchor. In each bucket their symbols lie column by column in a sequential file,
   aligned on the anchor. A round reads one column from the right and inserts one symbol per document: the order of
   the suffixes (whose symbols in order are the round's part of the Burrows-Wheeler transform) follows from the last
   round's by a stable sort, the common prefixes by range minima. Neighbours with a common prefix of 100 share a window.
4. Of each window the first in (doc_id, start) stays; the others' bytes go.

The surroundings of an anchor with over `HOT` occurrences are dealt window by window, by the hash of all 100 bytes, so that no task
holds a whole anchor; only equal windows meet then.

All comparisons are of bytes; hashes only bring equal windows together. Memory of a round is one column and one
order; buckets are partitions of Spark.

Nulls: a null text is an empty one. Rows that share a doc_id and a text count as one document: what equals at the same place is
the same occurrence, so repeated rows keep what one would. Different texts of one doc_id, or without one, are different documents, in the order of
their SHA-256. Null ids come before all others. An empty table gives none; texts under 100 bytes lose nothing. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import dropped, numbered, table, written
from shelfwise.llm.shingles import mix

LENGTH, ANCHOR = 100, 32
#: Anchors of a window, and so the most bytes of a short document before its anchor plus one.
_PLACES = LENGTH - ANCHOR + 1
_COLUMNS = _PLACES - 1 + LENGTH
#: Occurrences of an anchor beyond which its windows are dealt by their whole content.
HOT = 100_000
_MULTIPLY = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLY, -1, 1 << 64)
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power(which: int, n: int) -> np.ndarray:
    if len(_powers[which]) < n:
        steps = np.full(2 * n, (_MULTIPLY, _INVERSE)[which], dtype=np.uint64)
        steps[0] = 1
        _powers[which] = np.multiply.accumulate(steps)
    return _powers[which][:n]


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per anchor of the text: its hash and place, and its first and last window's start."""
    n = len(text)
    if n < LENGTH:
        nothing = np.zeros(0, dtype=np.int64)
        return nothing.astype(np.uint64), nothing, nothing, nothing
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((np.frombuffer(text, dtype=np.uint8).astype(np.uint64) + np.uint64(1)) * _power(0, n), out=sums[1:])
    grams = mix((sums[ANCHOR:] - sums[:-ANCHOR]) * _power(1, n - ANCHOR + 1))
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width < _PLACES:  # running minima over _PLACES neighbours, by doubling
        step = min(width, _PLACES - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.append(first[1:], len(at)) - 1
    return grams[at[first]], at[first], first, last


def _anchor_rows(docs: DataFrame) -> DataFrame:
    schema = pa.schema([("anchor", pa.int64()), ("doc", pa.int64()), ("place", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 2000):
                some = batch.slice(k, 2000)
                out, count = [], []
                for text in some.column(1).to_pylist():
                    gram, at, first, last = anchors(text)
                    count.append(len(at))
                    out.append((gram.view(np.int64), at << 14 | (at - first) << 7 | (at - last)))
                docs_ = np.repeat(np.array(some.column(0).to_pylist(), dtype=np.int64), count)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[0] for x in out])), pa.array(docs_), pa.array(np.concatenate([x[1] for x in out]))], schema=schema)

    return docs.mapInArrow(run, "anchor long, doc long, place long")


def _cut(docs: DataFrame) -> DataFrame:
    """Short documents of the marked anchors, one of each kind per task (kind 0), and repeats found on the way (kind 1)."""
    schema = pa.schema([("anchor", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("left", pa.int32()), ("last", pa.int32()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            firsts: dict[tuple[int, bytes], tuple[int, int, int, int]] = {}
            repeats: list[tuple[int, int, int, int]] = []
            for doc, text, marks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for m in marks:
                    at, left, last = m["place"] >> 14, (m["place"] >> 7) & 127, m["place"] & 127
                    key = (m["anchor"], text[at - left : at - last + LENGTH])
                    now = (doc, at, left, last)
                    if (old := firsts.get(key)) is None:
                        firsts[key] = now
                    elif now[:2] < old[:2]:
                        firsts[key] = now
                        repeats.append(old)
                    elif now[:2] > old[:2]:
                        repeats.append(now)
            keys, rows = list(firsts), list(firsts.values())
            columns = [[k[0] for k in keys] + [None] * len(repeats), *([r[c] for r in rows] + [r[c] for r in repeats] for c in range(4)), [k[1] for k in keys] + [None] * len(repeats)]
            yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(columns, schema, strict=True)], schema=schema)

    return docs.mapInArrow(run, "anchor long, doc long, at long, left int, last int, bytes binary")


def repeated_windows(strings: list[bytes], left: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each aligned string and each of its windows, whether a string of lower rank has the same window there.

    A row per string, a column per window start, `left` places before the anchor being start _PLACES - 1 - left.
    """
    m = len(strings)
    lengths = np.array([len(s) for s in strings], dtype=np.int64)
    flat = np.frombuffer(b"".join(strings), dtype=np.uint8)
    begin = np.cumsum(lengths) - lengths
    from_, to = _PLACES - 1 - left, _PLACES - 1 - left + lengths
    out = np.zeros((m, _PLACES), dtype=bool)
    with tempfile.TemporaryFile() as file:
        for c in range(_COLUMNS - 1, -1, -1):  # the columns in the order in which the rounds read them
            inside = (from_ <= c) & (c < to)
            column = np.full(m, -1, dtype=np.int16)
            column[inside] = flat[(begin + c - from_)[inside]]
            column.tofile(file)
        file.seek(0)
        order, common = np.arange(m), np.zeros(m, dtype=np.int64)
        for c in range(_COLUMNS - 1, -1, -1):
            column = np.fromfile(file, dtype=np.int16, count=m)
            symbols = column[order]
            move = np.argsort(symbols, kind="stable")
            sorted_ = symbols[move]
            grown = np.zeros(m, dtype=np.int64)
            same = np.flatnonzero((sorted_[1:] == sorted_[:-1]) & (sorted_[1:] >= 0)) + 1
            if len(same):
                pairs = np.empty(2 * len(same), dtype=np.int64)
                pairs[0::2], pairs[1::2] = move[same - 1] + 1, move[same] + 1
                ranges = np.minimum.reduceat(np.append(common, 0), pairs)[0::2]
                grown[same] = ranges + 1
            order, common = order[move], np.minimum(grown, LENGTH)
            if c < _PLACES:
                groups = np.cumsum(common < LENGTH) - 1
                ranks = rank[order]
                least = np.full(groups[-1] + 1, np.iinfo(np.int64).max)
                np.minimum.at(least, groups, ranks)
                out[order, c] = ranks > least[groups]
    return out


def _judged(short: DataFrame) -> DataFrame:
    """(doc, first, last): runs of window starts that are repeats, from a partition's short documents."""
    schema = pa.schema([("doc", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])

    def lot(columns: list[list]) -> pa.RecordBatch:
        _, doc, at, left, last, data = columns
        doc, at, left, last = (np.array(x, dtype=np.int64) for x in (doc, at, left, last))
        place = np.lexsort((at, doc))
        rank = np.empty(len(doc), dtype=np.int64)
        # the same place of one document is one occurrence, however often it was read
        rank[place] = np.cumsum(np.append(False, (np.diff(doc[place]) != 0) | (np.diff(at[place]) != 0)))
        again = repeated_windows(data, left, rank)
        edges = np.diff(np.pad(again.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, begin = np.nonzero(edges == 1)
        _, end = np.nonzero(edges == -1)
        shift = at[row] - (_PLACES - 1)
        return pa.RecordBatch.from_arrays([pa.array(doc[row]), pa.array(shift + begin), pa.array(shift + end - 1)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by anchor: lots end where an anchor does
        held: list[list] = [[] for _ in range(6)]
        for batch in batches:
            for column, new in zip(held, batch.columns, strict=True):
                column += new.to_pylist()
            if len(held[0]) >= 200_000:
                cut = len(held[0])
                while cut and held[0][cut - 1] == held[0][-1]:
                    cut -= 1
                if cut:
                    yield lot([c[:cut] for c in held])
                    held = [c[cut:] for c in held]
        if held[0]:
            yield lot(held)

    return short.mapInArrow(run, "doc long, first long, last long")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc, spans) of documents (doc, text as bytes): the maximal runs of bytes to remove, sorted."""
    places = _anchor_rows(docs)
    counted = places.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    twice = written(counted.select("anchor", (F.col("n") > HOT).alias("hot")), "twice", "zstd")
    marks = written(places.join(twice.select("anchor"), "anchor").groupBy("doc").agg(F.collect_set(F.struct("anchor", "place")).alias("marks")), "anchors", "zstd")
    pieces = written(_cut(docs.join(marks, "doc").select("doc", "text", "marks")), "pieces", "zstd")
    dropped(marks)
    short = pieces.filter("bytes is not null")
    if not (hot := twice.filter("hot").select("anchor")).isEmpty():
        short = short.join(hot, "anchor", "left_anti").union(_single_windows(short.join(hot, "anchor", "left_semi")))
    short = short.repartition("anchor").sortWithinPartitions("anchor")
    whole = pieces.filter("bytes is null").select("doc", (F.col("at") - F.col("left")).alias("first"), (F.col("at") - F.col("last")).alias("last"))
    judged = _judged(short).union(whole).groupBy("doc").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("runs"))
    runs = written(judged, "runs", "zstd")
    dropped(pieces)
    dropped(twice)
    return runs


def _single_windows(short: DataFrame) -> DataFrame:
    """Each window of the short documents as one of its own, under its whole content's hash: surroundings of a hot anchor are many."""
    schema = pa.schema([("anchor", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("left", pa.int32()), ("last", pa.int32()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                rows = []
                for _, doc, at, left, last, data in zip(*(c.to_pylist() for c in batch.slice(k, 500).columns), strict=True):
                    for begin in range(left - last + 1):
                        window = data[begin : begin + LENGTH]
                        rows.append((xxhash.xxh3_64_intdigest(window) - (1 << 63), doc, at, left - begin, left - begin, window))
                yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return short.select("anchor", "doc", "at", "left", "last", "bytes").mapInArrow(run, "anchor long, doc long, at long, left int, last int, bytes binary")


def remove(text: bytes, runs: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left, and the maximal removed spans, from sorted runs of window starts."""
    spans: list[tuple[int, int]] = []
    for first, last in runs:
        end = min(last + LENGTH, len(text))
        if spans and first <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], end))
        elif first < end:
            spans.append((first, end))
    kept, at = [], 0
    for begin, end in spans:
        kept.append(text[at:begin])
        at = end
    return b"".join([*kept, text[at:]]), spans


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, kept (bytes), spans, n_bytes, n_removed, n_spans, kept_sha256."""
    rows, _ = numbered(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")))
    runs = repeated_spans(rows.select("doc", "text"))
    joined = rows.join(runs, "doc", "left").select("doc_id", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                some = batch.slice(k, 1000)
                kept, spans, sums = [], [], ([], [], [], [])
                for text, found in zip(some.column(1).to_pylist(), some.column(2).to_pylist(), strict=True):
                    left, gone = remove(text, [(r["first"], r["last"]) for r in found or []])
                    kept.append(left)
                    spans.append([{"begin": a, "end": b} for a, b in gone])
                    for column, v in zip(sums, (len(text), len(text) - len(left), len(gone), hashlib.sha256(left).hexdigest()), strict=True):
                        column.append(v)
                types = [pa.binary(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])), pa.int64(), pa.int64(), pa.int64(), pa.string()]
                names = ["doc_id", "kept", "spans", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                yield pa.RecordBatch.from_arrays([some.column(0), *(pa.array(v, type=t) for v, t in zip((kept, spans, *sums), types, strict=True))], names=names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {kind}, kept binary, spans array<struct<begin:long,end:long>>, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op4_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
