"""Jaccard join of the documents' 5-word shingle sets, with set-relation skipping.

1. Documents with equal sets are one set from here on, by a hash over all shingles.
2. Shingles get one global order, the rarer first, by a table of counts (`count_table`), each cell the number of times that any
   of its shingles occurs in a set. The table has the same size whatever the input; the order it gives changes the
   cost, never the results. Of each set only the prefix is indexed: two sets that reach the threshold share one of theirs.
3. An index list holds its sets by size, each with what its shingle's place leaves room for. Runs of sets that are too large, or
   in which the shingle stands too far back for the threshold, are skipped as a whole. If the pairs that remain are at most
   `SHORT` for each set of the list, they are candidates.
4. A list with more of them has highly similar sets. The set with the fewest uncommon shingles leads, such as the one that others are
   copies of. It is compared with each of the others, and their answers follow from what they have of a reference R: the leader's common shingles (by the count table), or all of them if
   those are less than half. With w_x = 4 |R - x| + 3 |x - R|, two sets x and y link exactly if they share at least
   (w_x + w_y - |R|) / 7 differences from R. So all sets with w_x + w <= |R|, w being the least weight, are in one class
   with the set that has it, and any other pair shares a difference in the differences' own prefixes, which are further
   index lists, keyed by the leader, with the places' room among the differences. There each set carries `MARKS` bits, one for each
   difference by its hash: two sets have at least as many differences from one another as their bits differ in, so pairs that can't share
   enough are no candidates. Sets that are in one class by then, whatever
   linked them, need no pair; so each set's prefix counts on the least weight among the other classes.
   x - y has at most a quarter of x if they link. So a set that has a quarter of its size more of R than a quarter of R can
   link only to sets that have a quarter of R. All those give differences; only sets with less than the former stay in
   the list, which comes back with a new leader. Each round takes four times `SHORT`, so that rounds end.
5. Verified links give components.

Every link is found: prefixes, places, references and their differences are exact filters, and each candidate is verified
on whole sets. Lists of shingles that over `HOT` sets may have are led by map-side minima and by a join whose large
partitions Spark splits; a task reads other lists in sorted order and holds one of them.

Nulls: a null text or one without words has the empty set, linked with nothing. Repeated rows, also of one
doc_id, each get a row. Null ids are kept; they never name a component that has other ids. Ties (sets of one size)
go by set id. A very long text is one set like any other, held by one task as long as its batch lasts. An empty table gives none.
Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import count_table, shingles
from shelfwise.llm.common import lean, table, written
from shelfwise.llm.graph import components

#: Links: 100 * intersection >= PERCENT * union. The filters' weights (4, 3, 7) and distances are those of 75.
PERCENT = 75
#: Pairs for each set of a list up to which the list is compared directly, at first; each round takes four times as many.
SHORT = 16
#: A shingle of a leader is common if so many more sets have it than is usual.
COMMON = 8
#: Shingles of sets that a verifying task keeps at hand: 32 MB.
HELD = 4_000_000
#: Lists that may be longer are led without being held by one task.
HOT = 100_000
#: Bits by which the differences of two sets are compared: longs.
MARKS = 256
_SIGN = np.uint64(0xA5A5A5A5A5A5A5A5)


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _ids_of(sets: list[np.ndarray]) -> np.ndarray:
    """A set's id: a 64-bit hash of its size and two sums over its shingles."""
    parts = [(len(s), s.sum(dtype=np.uint64), shingles.mix(s ^ _SIGN).sum(dtype=np.uint64)) for s in sets]
    n, f1, f2 = (np.array([p[i] for p in parts], dtype=np.uint64) for i in range(3))
    return _signed(shingles.mix(f1 ^ shingles.mix(f2 ^ shingles.mix(n + _SIGN))))


def _summary(docs: DataFrame) -> DataFrame:
    """kind 0: a row per document with its set's size and id; kinds 1 and 2: a task's count table by chunks (n), the counts'
    low bytes and what is above them."""
    schema = pa.schema([("kind", pa.int32()), ("doc_id", docs_type(docs)), ("n", pa.int64()), ("sid", pa.int64()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = count_table.empty(), set()
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                some = batch.slice(k, 1000)
                sets = [shingles.shingle_set(t) for t in some.column(1).to_pylist()]
                ids = _ids_of(sets)
                for sid, s in zip(ids.tolist(), sets, strict=True):
                    if sid not in seen:  # equal sets count once
                        seen.add(sid)
                        count_table.add(counts, s)
                m = len(sets)
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(m, dtype=np.int32)), some.column(0), pa.array([len(s) for s in sets], type=pa.int64()), pa.array(ids), pa.nulls(m, pa.binary())], schema=schema)
        kinds, chunks, data = count_table.pieces(counts)
        m = len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(kinds, type=pa.int32()), pa.nulls(m, schema.field(1).type), pa.array(chunks, type=pa.int64()), pa.nulls(m, pa.int64()), pa.array(data, type=pa.binary())], schema=schema)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(lean(run), f"kind int, doc_id {kind}, n long, sid long, counts binary")


def docs_type(docs: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema["doc_id"].dataType)


def _sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(sid, n, text) of the sets wanted, each from a document whose id stands for it, or by the set's own id where only
    documents without an id have it. Texts are shorter than their sets."""
    schema = pa.schema([("sid", pa.int64()), ("n", pa.int64()), ("text", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                some = batch.slice(k, 1000)
                sets = [shingles.shingle_set(t) for t in some.column(0).to_pylist()]
                ids = _ids_of(sets)
                # rows that share an id without sharing the set drop out here; rows without an id all stay
                sid = some.column(1)
                pick = np.flatnonzero((ids == sid.fill_null(0).to_numpy(zero_copy_only=False)) | sid.is_null().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([pa.array(ids[pick]), pa.array([len(sets[i]) for i in pick], type=pa.int64()), some.column(0).take(pa.array(pick))], schema=schema)

    out = "sid long, n long, text binary"
    named = docs.join(wanted, "doc_id").select("text", "sid").mapInArrow(lean(run), out)
    nameless = docs.filter("doc_id is null").select("text", F.lit(None).cast("long").alias("sid")).mapInArrow(lean(run), out)
    return named.union(nameless.join(wanted.filter("doc_id is null").select("sid"), "sid", "left_semi"))


def _prefixes(docs: DataFrame, logs: np.ndarray, common: np.ndarray, hot: bool) -> DataFrame:
    """(key, sid, need, slack, odd, comp): each shingle of each prefix, those of hot cells or the others; need and slack by the
    set's size and the shingle's place, odd is how many of its shingles are not common. A task emits equal sets once."""
    shared, often, least = docs.sparkSession.sparkContext.broadcast(logs), docs.sparkSession.sparkContext.broadcast(common), HOT
    schema = pa.schema([("key", pa.int64()), ("sid", pa.int64()), ("need", pa.int32()), ("slack", pa.int32()), ("odd", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = shared.value, set()
        apart = count_table.above(counts, least)
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                sets = [shingles.shingle_set(t) for t in batch.column(1).slice(k, 1000).to_pylist()]
                parts: list[tuple[np.ndarray, ...]] = []
                for sid, s in zip(_ids_of(sets).tolist(), sets, strict=True):
                    if sid in seen or not len(s):
                        continue
                    seen.add(sid)
                    cells = count_table.cells(s)
                    length = len(s) - -(-PERCENT * len(s) // 100) + 1
                    first = np.argsort(counts[cells], kind="stable")[:length]  # sets are sorted by hash, so ties go by it
                    place = np.flatnonzero(apart[cells[first]] == hot)
                    if len(place):
                        parts.append((s[first[place]], np.full(len(place), sid, dtype=np.int64), np.full(len(place), 6 * len(s), dtype=np.int32), (8 * len(s) - 14 * place).astype(np.int32), np.full(len(place), len(s) - int(often.value[cells].sum()), dtype=np.int32)))
                if parts:
                    key, ids, need, slack, odd = (np.concatenate(c) for c in zip(*parts, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(_signed(key)), pa.array(ids), pa.array(need), pa.array(slack), pa.array(odd)], schema=schema)

    return docs.mapInArrow(lean(run), "key long, sid long, need int, slack int, odd int").withColumn("comp", F.col("sid"))


def marks_of(keys: np.ndarray) -> np.ndarray:
    """`MARKS` bits as longs, those of the keys' hashes set."""
    bits = np.zeros(MARKS, dtype=np.uint8)
    bits[keys.view(np.uint64) >> np.uint64(64 - MARKS.bit_length() + 1)] = 1
    return np.packbits(bits).view(np.int64)


def can_share(i: np.ndarray | int, j: np.ndarray, need: np.ndarray, size: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Whether the sets i and j can share what both need, (need_i + need_j) / 14: they differ at least where their marks do. A size below 0 is unknown."""
    apart = np.bitwise_count((marks[i] ^ marks[j]).view(np.uint64)).sum(axis=-1, dtype=np.int64)
    return (7 * (size[i] + size[j] - apart) >= need[i] + need[j]) | (size[i] < 0) | (size[j] < 0)


def direct_pairs(need: np.ndarray, slack: np.ndarray, comp: np.ndarray, most: int, size: np.ndarray | None = None, marks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray] | None:
    """The pairs (i, j) of one list, sorted by need, that can link and are not in one class yet; None if there are over `most`.

    What two entries still have room for must reach what both need: with slack = 14 room - need, each one's slack must
    reach the other's need. Slack ends each entry's run of partners; the runs are met block by block, and a block whose
    slack is too small, be it by size or by place, is skipped."""
    m = len(need)
    ends = np.searchsorted(need, slack, side="right")
    out: list[tuple[np.ndarray, np.ndarray]] = []
    found, width = 0, 64
    best = np.maximum.reduceat(slack, np.arange(0, m, width))
    for i in np.flatnonzero(ends > np.arange(m) + 1).tolist():
        first, last = (i + 1) // width, -(-int(ends[i]) // width)
        for k in (np.flatnonzero(best[first:last] >= need[i]) + first).tolist():
            j = np.arange(max(i + 1, k * width), min(int(ends[i]), (k + 1) * width))
            j = j[(slack[j] >= need[i]) & (comp[j] != comp[i])]
            if size is not None and marks is not None:
                j = j[can_share(i, j, need, size, marks)]
            if len(j):
                found += len(j)
                if found > most:
                    return None
                out.append((np.full(len(j), i), j))
    if not out:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])


_CANDIDATE = "a long, b long, key long, need int, slack int, odd int"
_CANDIDATE_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())


#: What entries of differences have besides: how many there are, and their marks.
_MARKED = ("size", *(f"mark_{k}" for k in range(MARKS // 64)))


def _lists(entries: DataFrame, short: int) -> DataFrame:
    """Candidates (a, b) of the lists; where a leads a list, with its key and b's entry in it. Tasks read lists in sorted order."""
    schema = pa.schema([(f.split()[0], t) for f, t in zip(_CANDIDATE.split(", "), _CANDIDATE_TYPES, strict=True)])

    def listed(key: np.ndarray, sid: np.ndarray, need: np.ndarray, slack: np.ndarray, odd: np.ndarray, comp: np.ndarray, *marked: np.ndarray) -> pa.RecordBatch | None:
        """Whole lists, sorted by (key, need, sid)."""
        fresh = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])))  # equal sets of several tasks
        key, sid, need, slack, odd, comp = (v[fresh] for v in (key, sid, need, slack, odd, comp))
        size, marks = (marked[0][fresh], np.stack([v[fresh] for v in marked[1:]], axis=1)) if marked else (None, None)
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(starts, len(key)))
        two = starts[sizes == 2]
        two = two[(slack[two] >= need[two + 1]) & (slack[two + 1] >= need[two]) & (comp[two] != comp[two + 1])]
        if size is not None and marks is not None:
            two = two[can_share(two, two + 1, need, size, marks)]
        singles = [(two, two + 1)]
        leads: list[tuple[np.ndarray, np.ndarray]] = []
        for at, m in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            here = slice(at, at + m)
            if (pairs := direct_pairs(need[here], slack[here], comp[here], short * m, *(() if size is None or marks is None else (size[here], marks[here])))) is not None:
                singles.append((pairs[0] + at, pairs[1] + at))
            else:
                leader = at + int(np.argmin(odd[here]))
                leads.append((np.full(m - 1, leader), np.delete(np.arange(at, at + m), leader - at)))
        i, j = (np.concatenate(x) for x in zip(*singles, *leads, strict=True))
        plain = np.arange(len(i)) < sum(len(x) for x, _ in singles)
        if not len(i):
            return None
        own = (pa.array(v, type=t, mask=plain) for v, t in zip((key[j], need[j], slack[j], odd[j]), _CANDIDATE_TYPES[2:], strict=True))
        return pa.RecordBatch.from_arrays([pa.array(sid[i]), pa.array(sid[j]), *own], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(batch.num_columns)]
            now[2:5] = [x.astype(np.int64) for x in now[2:5]]
            if held:
                now = [np.concatenate(c) for c in zip(held, now, strict=True)]
            cut = int(np.searchsorted(now[0], now[0][-1]))  # the last list may go on
            if cut and (out := listed(*(c[:cut] for c in now))) is not None:
                yield out
            held = [c[cut:] for c in now]
        if held and (out := listed(*held)) is not None:
            yield out

    return entries.repartition("key").sortWithinPartitions("key", "need", "sid").select("key", "sid", "need", "slack", "odd", "comp", *(c for c in _MARKED if c in entries.columns)).mapInArrow(lean(run), _CANDIDATE)


def _hot_lists(entries: DataFrame) -> DataFrame:
    """The same for lists of any length."""
    leaders = entries.groupBy("key").agg(F.min(F.struct("odd", "sid")).alias("least"), F.min("comp").alias("first"), F.max("comp").alias("last"))
    leaders = leaders.filter("first <> last").select("key", F.col("least.sid").alias("a"))
    return entries.join(leaders, "key").filter("sid <> a").select("a", F.col("sid").alias("b"), "key", "need", "slack", "odd").distinct()


def _candidates(entries: DataFrame, short: int) -> DataFrame:
    """Candidates of a later round's lists, whose lengths are counted first if any can be long."""
    if entries.count() <= HOT:
        return _lists(entries, short)
    long = written(entries.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter(f"m > {HOT}").select("key"), "hot")
    if long.isEmpty():
        return _lists(entries, short)
    return _lists(entries.join(long, "key", "left_anti"), short).union(_hot_lists(entries.join(long, "key", "left_semi")))


def _verified(pairs: DataFrame, sets: DataFrame, common: np.ndarray) -> DataFrame:
    """Of pairs (a, b, star): whether they link; and under a leader a with reference R whether b stays in the list, and if b is
    near R its weight w, the leader's own, R's size c and b's differences from R in the order of their hashes."""
    shared = pairs.sparkSession.sparkContext.broadcast(common)
    left = pairs.join(sets.select(F.col("sid").alias("b"), F.col("text").alias("tb")), "b")
    both = left.join(sets.select(F.col("sid").alias("a"), F.col("text").alias("ta")), "a").select("a", "b", "star", "ta", "tb")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_()), ("stays", pa.bool_()), ("w", pa.int64()), ("wa", pa.int64()), ("c", pa.int64()), ("odd", pa.int32()), ("keys", pa.list_(pa.int64())), ("marks", pa.list_(pa.int64()))])

    def reference(x: np.ndarray) -> np.ndarray:
        r = x[shared.value[count_table.cells(x)]]
        return r if 2 * len(r) >= len(x) else x

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}  # sets met before
        size = 0

        def set_of(sid: int, text: pa.Scalar) -> np.ndarray:
            nonlocal size
            if (found := known.get(sid)) is None:
                if size > HELD:
                    known.clear()
                    size = 0
                known[sid] = found = shingles.shingle_set(text.as_py())
                size += len(found)
            return found

        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                out: list[list] = [[] for _ in schema]
                last: tuple[int, np.ndarray, np.ndarray] | None = None
                some = batch.slice(k, 500)
                for a, b, star, ta, tb in zip(*(some.column(c).to_pylist() for c in range(3)), some.column(3), some.column(4), strict=True):
                    if last is None or last[0] != a:
                        x = set_of(a, ta)
                        last = (a, x, reference(x))
                    _, x, r = last
                    y = set_of(b, tb)
                    inter = len(np.intersect1d(x, y, assume_unique=True))
                    row: tuple = (a, b, 100 * inter >= PERCENT * (len(x) + len(y) - inter), False, None, None, None, None, None, None)
                    if star:
                        held = np.intersect1d(r, y, assume_unique=True)
                        c, m = len(r), len(held)
                        if near := 4 * m >= c:
                            gone, new = np.setdiff1d(r, held, assume_unique=True), np.setdiff1d(y, held, assume_unique=True)
                            order = np.sort(np.concatenate([shingles.mix(gone ^ _SIGN), new]))
                            keys = _signed(shingles.mix(order ^ np.uint64(a & 0xFFFFFFFFFFFFFFFF)))
                            row = (*row[:4], 4 * len(gone) + 3 * len(new), 3 * (len(x) - c), c, len(y) - int(shared.value[count_table.cells(y)].sum()), keys, marks_of(keys))
                        row = (*row[:3], not near or 4 * m < c + len(y), *row[4:])
                    for column, v in zip(out, row, strict=True):
                        column.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(out, schema, strict=True)], schema=schema)

    return both.mapInArrow(lean(run), "a long, b long, linked boolean, stays boolean, w long, wa long, c long, odd int, keys array<long>, marks array<long>")


def _implied(judged: DataFrame) -> DataFrame:
    """Links (u, v) that follow from the references: of the least weight's set with all whose weights reach the threshold with it."""
    near = judged.filter("keys is not null")
    least = near.groupBy("a").agg(F.min(F.struct("w", "b")).alias("m"), F.first("wa").alias("wa"))
    own = F.col("wa") <= F.col("m.w")
    least = least.select("a", F.when(own, F.col("wa")).otherwise(F.col("m.w")).alias("least"), F.when(own, F.col("a")).otherwise(F.col("m.b")).alias("rep"))
    return near.join(least, "a").filter("w + least <= c and b <> rep").select(F.col("rep").alias("u"), F.col("b").alias("v"))


def _in_classes(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Adds comp, the class of the set sid so far."""
    return rows.join(roots.select(F.col("node").alias("sid"), "root"), "sid", "left").withColumn("comp", F.coalesce("root", "sid")).drop("root")


def _differences(judged: DataFrame, roots: DataFrame) -> DataFrame:
    """The entries of the differences that sets near one reference must share with those of other classes near it."""
    near = _in_classes(judged.filter("keys is not null").select("a", F.col("b").alias("sid"), "w", "c", "odd", "keys", "marks"), roots)
    by_class = near.groupBy("a", "comp").agg(F.min("w").alias("least"))
    first = by_class.groupBy("a").agg(F.min(F.struct("least", "comp")).alias("one"))
    lightest = by_class.join(first, "a").filter("comp <> one.comp").groupBy("a").agg(F.first("one").alias("one"), F.min("least").alias("second"))
    every = near.join(lightest, "a")
    partner = F.when(F.col("comp") == F.col("one.comp"), F.col("second")).otherwise(F.col("one.least"))
    length = F.size("keys") - F.greatest(F.ceil((F.col("w") + partner - F.col("c")) / 7), F.lit(1)) + 1
    prefix = F.slice("keys", F.lit(1), F.greatest(length, F.lit(0)).cast("int"))
    need = 2 * F.col("w") - F.col("c")
    keyed = every.select(F.posexplode(prefix).alias("p", "key"), "sid", need.cast("int").alias("need"), (14 * F.size("keys") - need).alias("slack"), "odd", "comp", F.size("keys").cast("long").alias("size"), "marks")
    marks = [F.col("marks")[k].alias(f"mark_{k}") for k in range(MARKS // 64)]
    return keyed.select("key", "sid", "need", (F.col("slack") - 14 * F.col("p")).cast("int").alias("slack"), "odd", "comp", "size", *marks)


def similar_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Per document (doc_id, sid, n), and the class (node, root) of each set that links."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    summary = written(_summary(rows), "sets")
    members = summary.filter("kind = 0").select("doc_id", "n", "sid")
    logs = count_table.gathered(summary.filter("kind > 0").select("kind", F.col("n").alias("chunk"), "counts"))
    common, short = count_table.above(logs, max(COMMON, 4 * count_table.usual(logs) ** 0.5)), SHORT
    found = _lists(_prefixes(rows, logs, common, False), short)
    if count_table.above(logs, HOT).any():
        found = found.union(_hot_lists(_prefixes(rows, logs, common, True)))
    links = docs.sparkSession.createDataFrame([], "u long, v long")
    needed: DataFrame | None = None
    while not (listed := written(found, "pairs")).isEmpty():
        pairs = listed.groupBy("a", "b").agg(F.max(F.col("key").isNotNull()).alias("star"))
        if needed is None:
            ids = listed.select(F.col("a").alias("sid")).union(listed.select("b")).distinct()
            first = members.join(ids, "sid", "left_semi").groupBy("sid").agg(F.min("doc_id").alias("doc_id"))
            needed = written(_sets_of(rows, first).dropDuplicates(["sid"]), "sets")
        judged = written(_verified(pairs, needed, common), "links")
        links = links.union(judged.filter("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))).union(_implied(judged))
        roots = components(links)
        led = listed.filter("key is not null")
        if led.isEmpty():
            return members, roots
        rest = led.join(judged.filter("stays").select("a", "b"), ["a", "b"], "left_semi").select("key", F.col("b").alias("sid"), "need", "slack", "odd")
        unmarked = [F.lit(-1 if c == "size" else 0).cast("long").alias(c) for c in _MARKED]
        entries = written(_in_classes(rest, roots).select("key", "sid", "need", "slack", "odd", "comp", *unmarked).union(_differences(judged, roots)), "entries")
        short *= 4
        found = _candidates(entries, short)
    return members, components(links)


def _rooted(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per document: doc_id, sid, n and root, its component's least set id."""
    members, roots = similar_sets(docs, id_col, text_col)
    return members.join(roots, members["sid"] == roots["node"], "left").select("doc_id", "sid", "n", F.coalesce("root", "sid").alias("root"))


def _named(rooted: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id."""
    least = rooted.filter("n > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    out = rooted.join(least, "root", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def join_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id."""
    return _named(_rooted(docs, id_col, text_col))


def _set_ids(texts: pd.Series) -> pd.Series:
    return pd.Series([int(_ids_of([shingles.shingle_set(t)])[0]) for t in texts], dtype="int64")


def keep_one(docs: DataFrame) -> DataFrame:
    """Of each component the documents with the least id, with all columns; of one without any id, a document with the
    least set. Rows that share an id are kept or dropped together, but each without an id stands for itself. Of rows that share id and text
    one stays, the least by a hash of all its columns. Columns may have any names: rows travel as one."""
    rooted = written(_rooted(docs, "doc_id", "text"), "rooted")
    rows = docs.select(F.struct("*").alias("row")).select("row", F.col("row.doc_id").alias("id"), F.col("row.text").alias("text"))
    once = lambda some: some.groupBy("id", "text").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row")
    kept = _named(rooted).filter("doc_id = component_id").select(F.col("doc_id").alias("id")).distinct()
    named = rows.join(kept, "id", "left_semi")
    alone = rooted.groupBy("root").agg(F.max("doc_id").alias("any"), F.min("sid").alias("sid"), F.max("n").alias("n")).filter("any is null and n > 0")
    set_ids = F.pandas_udf(_set_ids, "long")
    nameless = rows.filter("id is null").withColumn("sid", set_ids(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    first = nameless.join(alone.select("sid"), "sid", "left_semi").groupBy("sid").agg(F.min("text").alias("text"))
    chosen = nameless.join(first, ["sid", "text"], "left_semi")
    # texts without words are linked with nothing
    empty = nameless.filter(F.col("sid") == F.lit(int(_ids_of([shingles.shingle_set(b"")])[0])))
    return once(named).union(once(chosen.unionByName(empty))).select("row.*")


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_documents(table(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g FROM w),
s AS (SELECT doc_id, len(g)::BIGINT AS n, unnest(g) AS s FROM g),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id AND 4 * least(x.n, y.n) >= 3 * greatest(x.n, y.n) GROUP BY ALL),
l AS (SELECT a, b FROM o WHERE 100 * c >= 75 * (na + nb - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM g UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT g.doc_id, len(g.g)::BIGINT AS n_shingles, min(r.b)::BIGINT AS component_id FROM g JOIN r ON r.a = g.doc_id GROUP BY g.doc_id, g.g
"""
