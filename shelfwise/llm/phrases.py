"""Phrases that are more than chance, counted in suffix trees cut at a few words, by vertical partitioning.

1. Phrases of one to `MOST` words are counted by the cell of their hash, in a table of fixed size. What a cell with fewer than `LEAST`
   occurrences holds is no candidate and no part of one. Cells that hold several phrases let more through and lose nothing.
   Each place of a piece of text starts a suffix; its first words are a path below the language, which ends where the phrase would be too
   seldom. A task merges equal paths of a lot of documents, so what leaves it are paths with counts, in order.
2. Vertical partitioning: paths are counted by the cell of their first word's hash. Cells that hold more paths than `BUDGET`
   are told apart by two words, and if they still do, by three. Cells of hashed prefixes are packed into groups of at most
   `BUDGET` paths, in order; a cell of whole paths alone may hold more. A hot word is thus many groups, never one task.
3. Each group builds its subtrees by itself: its paths, sorted, are read once; a node is a run of paths that begin alike, and its
   count is the sum of the leaves there. What a group has of a prefix that is spread over several
   is added up, as is the number of words of each language.
4. Candidates, their parts, and the phrases that longer ones stand for are joined by phrase. Only nodes with `LEAST`
   occurrences take part: the parts of a phrase have no fewer.

Scores are whole numbers from decimals of 38 digits, which products of counts to 10^15 fit.

Nulls: a null text is empty; a null language is `und`. An empty table gives none. Documents without an id and repeated rows count
like any others. Ties go by count, then by phrase in byte order. A very long text is a lot of its own, read in one task. Only the named columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm import shingles
from shelfwise.llm.common import dropped, lean, table, written

#: What ends a piece, but for "." that all of them become.
ENDS = b".,;:!?\n\x0b\x0c\r"
MOST, LEAST, SHARE, TOP = 3, 10, 50, 2000
#: Merged paths of a group; hashed prefixes a level tells apart; groups at most, beyond which they grow.
BUDGET, CELLS, GROUPS = 1_000_000, 1 << 16, 1 << 16
#: Cells, as a power of two, by which phrases that come too seldom are told beforehand: 64 MB in a task, 8 MB broadcast.
BITS, _CHUNK = 26, 1 << 16
#: Sorted paths that become nodes at once.
_ROWS = 100_000
#: Bytes of documents whose paths are merged at once, and merged paths of several such lots that are merged again.
LOT, AGAIN = 6_000_000, 1_500_000
#: Parts of a language's candidates that are cut to the top each by itself, before fewer are.
_PARTS = (256, 16)
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_ONE_DOT = bytes.maketrans(ENDS, b"." * len(ENDS))


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _symbol(word: bytes) -> bytes:
    """The word without bytes 0 and 1 of its own: byte 0 parts the words of a path, so that sorted paths are a tree's order."""
    return word.replace(b"\1", b"\1\2").replace(b"\0", b"\1\1") if b"\0" in word or b"\1" in word else word


def _word(symbol: bytes) -> bytes:
    return re.sub(b"\x01(.)", lambda m: bytes([m[1][0] - 1]), symbol, flags=re.DOTALL) if b"\1" in symbol else symbol


def _marked(texts: list[bytes], ordered: bool = True) -> tuple[np.ndarray, list[bytes]]:
    """The numbers of all words of all pieces in order, 0 after each piece, and the words by number, in the order of their symbols if wanted."""
    numbers = _Numbers()
    numbers[b"."]  # number 0 ends pieces
    whole = b" . ".join(t.lower().translate(_ONE_DOT).replace(b".", b" . ") for t in texts)
    marked = whole.split()
    ids = np.fromiter(map(numbers.__getitem__, marked), dtype=np.int64, count=len(marked))
    names = list(numbers)
    if not ordered:
        return ids, names
    plain = b"\0" not in whole and b"\1" not in whole
    names = [b".", *sorted(names[1:], key=None if plain else _symbol)]
    rank = np.empty(len(names), dtype=np.int64)
    rank[np.fromiter(map(numbers.__getitem__, names), dtype=np.int64, count=len(names))] = np.arange(len(names))
    return rank[ids], names


def _hashes(lang: str, names: list[bytes]) -> np.ndarray:
    seed = zlib.crc32(lang.encode())
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in names), dtype=np.uint64, count=len(names))


def _cells_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (shingles.mix(hashes) >> np.uint64(64 - bits)).astype(np.int64)


def _grams(ids: np.ndarray, hashes: np.ndarray, most: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 1, 2, ... words: the places where so many stand in one piece, and the cells of what stands there."""
    at = np.flatnonzero(ids > 0)
    h = hashes[ids[at]]
    for k in range(1, most + 1):
        yield at, _cells_of(h, bits)
        longer = at + k < len(ids)
        longer[longer] = ids[at[longer] + k] > 0
        at, h = at[longer], h[longer]
        h = h * _MULTIPLY + hashes[ids[at + k]] if len(at) else h


def _lots(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[str, list[bytes]]]:
    """Texts by language, as many as make a lot of bytes; a text is never cut."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data = text.as_py()
            held.setdefault(lang, []).append(data)
            size += len(data)
            if size >= most:
                yield from held.items()
                held, size = {}, 0
    yield from held.items()


def _add(counts: np.ndarray, cells: np.ndarray, least: int) -> None:
    """Counts cells, each up to `least`, beyond which nothing needs to be told apart."""
    cells = np.sort(cells.astype(np.int32))
    first = np.flatnonzero(np.diff(cells, prepend=-1))
    some = cells[first]
    counts[some] = np.minimum(counts[some] + np.diff(first, append=len(cells)), least)


def _frequent(docs: DataFrame, least: int, bits: int = BITS, lot: int = LOT) -> np.ndarray:
    """A bit for each of 2^bits cells: whether the phrases of up to `MOST` words of that cell come at least so often in all. A task counts into a
    table of its own; Spark adds them up, and a bit for each cell reaches the driver, whatever the input."""
    least = min(least, 255)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, dtype=np.uint8)
        for lang, texts in _lots(batches, lot):
            ids, names = _marked(texts, ordered=False)
            for _, cells in _grams(ids, _hashes(lang, names), MOST, bits):
                _add(counts, cells, least)
        parts = [(k, zlib.compress(part.tobytes(), 1)) for k, part in enumerate(counts.reshape(-1, min(_CHUNK, 1 << bits))) if part.any()]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in parts], type=pa.int64()), pa.array([c for _, c in parts], type=pa.binary())], names=["chunk", "counts"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = np.frombuffer(zlib.decompress(data), dtype=np.uint8)
                sums[chunk] = np.minimum(sums.get(chunk, 0) + part.astype(np.uint16), least)
        marks = [np.packbits(v >= least).tobytes() for v in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), type=pa.int64()), pa.array(marks, type=pa.binary())], names=["chunk", "bits"])

    parts = docs.mapInArrow(lean(counted), "chunk long, counts binary").repartition("chunk")
    out = np.zeros(1 << bits >> 3, dtype=np.uint8)
    for chunk, marks in parts.mapInArrow(lean(added), "chunk long, bits binary").collect():
        out[chunk * len(marks) : (chunk + 1) * len(marks)] = np.frombuffer(marks, dtype=np.uint8)
    return out


def merged_paths(ids: np.ndarray, words: int, reach: np.ndarray, most: int = MOST) -> tuple[list[np.ndarray], np.ndarray]:
    """Different suffixes, each as far as `reach` says, at most `most` words: each word's numbers (0: none), and counts."""
    begins = np.flatnonzero(reach > 0)
    padded = np.append(ids, np.zeros(most, dtype=np.int64))
    columns = [np.where(reach[begins] > k, padded[begins + k], 0) for k in range(most)]
    bits = max(words - 1, 1).bit_length()
    if most * bits > 62:  # a text of millions of different words
        paths, counts = np.unique(np.stack(columns), axis=1, return_counts=True)
        return list(paths), counts
    key, counts = np.unique(reduce(lambda a, c: a << bits | c, columns), return_counts=True)
    return [key >> bits * (most - 1 - k) & ((1 << bits) - 1) for k in range(most)], counts


def _paths(docs: DataFrame, frequent: np.ndarray, lot: int = LOT) -> DataFrame:
    """(path, n) of documents (lang, text): language and words with byte 0 between them, merged by lot. Suffixes that no frequent word starts
    count for the language alone."""
    shared, bits = docs.sparkSession.sparkContext.broadcast(frequent), (8 * len(frequent)).bit_length() - 1
    schema = pa.schema([("path", pa.binary()), ("n", pa.int64())])

    def merged(lang: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        ids, names = _marked(texts)
        hashes = _hashes(lang, names)
        reach = np.zeros(len(ids), dtype=np.int64)  # how many words from here on may be a candidate or a part of one
        for k, (at, cells) in enumerate(_grams(ids, hashes, MOST, bits)):
            held = (shared.value[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 1
            at = at[held & (reach[at] == k)]
            reach[at] = k + 1
        columns, counts = merged_paths(ids, len(names), reach)
        symbols = pa.array([None, *map(_symbol, names[1:])], type=pa.binary())
        first = pa.array([_symbol(lang.encode())], type=pa.binary())
        if rest := int(((reach == 0) & (ids > 0)).sum()):
            yield pa.RecordBatch.from_arrays([first, pa.array([rest])], schema=schema)
        for k in range(0, len(counts), 1 << 18):
            some = [symbols.take(pa.array(c[k : k + (1 << 18)])) for c in columns]
            start = first.take(pa.array(np.zeros(len(some[0]), dtype=np.int64)))
            path = pc.binary_join_element_wise(start, *some, pa.scalar(b"\0", type=pa.binary()), null_handling="skip")
            yield pa.RecordBatch.from_arrays([path, pa.array(counts[k : k + (1 << 18)])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for lang, texts in _lots(batches, lot):
            for batch in merged(lang, texts):
                held.append(batch)
                size += batch.num_rows
            if size >= AGAIN:
                yield from _merged_again(held)
                size = 0
        if held:
            yield from _merged_again(held)

    return docs.mapInArrow(lean(run), "path binary, n long")


def _merged_again(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal paths of several lots as one, in order: neighbours that begin alike take little room. The list is emptied."""
    one = pa.Table.from_batches(parts)
    parts.clear()
    one = one.group_by("path", use_threads=False).aggregate([("n", "sum")]).rename_columns(["path", "n"])
    one = one.take(pc.sort_indices(one, [("path", "ascending")]))
    yield from one.to_batches(max_chunksize=1 << 17)


def _cell(depth: int) -> Column:
    """The cell of a path's prefix of so many words below the language."""
    text = F.col("path").cast("string")
    return F.pmod(F.xxhash64(F.lit(depth), F.substring_index(text, "\0", depth + 1)), F.lit(CELLS)).cast("int")


def packed(sizes: dict[int, int], budget: int, first: int) -> tuple[dict[int, int], int]:
    """Cells to groups of at most `budget`, filled in order, with numbers from `first` on; the next free number."""
    out, group, room = {}, first - 1, 0
    for cell in sorted(sizes):
        if sizes[cell] > room:
            group, room = group + 1, budget
        room -= sizes[cell]
        out[cell] = group
    return out, group + 1


def grouped(paths: DataFrame, budget: int = BUDGET) -> tuple[DataFrame, int]:
    """(path, n, group, depth) with the group of each path's prefix of `depth` words, and how many groups there are. The driver holds
    a number per cell, whatever the input."""
    spark = paths.sparkSession
    rows, here, groups = None, paths, 0
    for depth in range(1, MOST + 1):
        here = here.withColumn("cell", _cell(depth))
        sizes = {r["cell"]: r["n"] for r in here.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
        if depth == 1:
            budget = max(budget, sum(sizes.values()) // GROUPS)
        full = {c for c, n in sizes.items() if n > budget and depth < MOST}
        of, groups = packed({c: n for c, n in sizes.items() if c not in full}, budget, groups)
        known = F.broadcast(spark.createDataFrame([*of.items(), *((c, None) for c in full)], "cell int, group int"))
        here = here.join(known, "cell")
        part = here.filter("group is not null").select("path", "n", "group", F.lit(depth).alias("depth"))
        rows = part if rows is None else rows.union(part)
        if not full:
            break
        here = here.filter("group is null").drop("cell", "group")
    return rows, max(groups, 1)


def _common(paths: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """How many symbols each path has in common with the one before it, and how many it has."""
    parts = pc.split_pattern(paths, pattern="\0")
    offsets = parts.offsets.to_numpy().astype(np.int64)
    symbols = np.diff(offsets)
    numbers = parts.flatten().dictionary_encode().indices.to_numpy()
    rows = np.full((len(paths), int(symbols.max())), -1, dtype=np.int32)
    rows[np.repeat(np.arange(len(paths)), symbols), np.arange(len(numbers)) - np.repeat(offsets[:-1] - offsets[0], symbols)] = numbers
    alike = (rows[1:] == rows[:-1]) & (rows[1:] >= 0)
    return np.append(0, np.logical_and.accumulate(alike, axis=1).sum(axis=1)), symbols


def _nodes(paths: pa.Array, counts: np.ndarray, parted: np.ndarray, least: int, ended: bool) -> tuple[list[tuple[bytes, int]], list[tuple[bytes, int]]]:
    """The nodes of sorted paths as `tree_nodes` says. Unless the paths have ended, those above the last path are still open: they are no
    nodes yet but paths with what they have so far, for the next ones to begin with."""
    same, symbols = _common(paths)
    out: list[tuple[bytes, int]] = []
    still: list[int] = []
    for depth in range(1, int(symbols.max()) + 1):
        start = np.flatnonzero((same < depth) & (symbols >= depth))
        if not len(start):
            continue
        sums = np.add.reduceat(np.where(symbols >= depth, counts, 0), start)
        keep = (sums >= least) | (depth - 1 < parted[start])
        if not ended and symbols[-1] >= depth:
            still.append(int(sums[-1]))
            keep[-1] = False
        found = paths.take(pa.array(start[keep])).to_pylist()
        out += [(b"\0".join(p.split(b"\0")[:depth]), n) for p, n in zip(found, sums[keep].tolist(), strict=True)]
    last = paths[-1].as_py().split(b"\0")
    return out, [(b"\0".join(last[: k + 1]), n - below) for k, (n, below) in enumerate(zip(still, [*still, 0][1:], strict=True))]


def tree_nodes(paths: list[bytes], counts: np.ndarray, parted: np.ndarray, least: int) -> list[tuple[bytes, int]]:
    """Nodes of the tree of sorted paths with their counts, the sums of what is below them: those with at least `least`, and all
    of at most as many words as `parted` says minus one, which have other parts elsewhere."""
    return _nodes(pa.array(paths, type=pa.binary()), counts, parted, least, True)[0] if paths else []


def nodes_of(batches: Iterator[pa.RecordBatch], least: int, rows: int = _ROWS) -> Iterator[list[tuple[bytes, int]]]:
    """The nodes of sorted paths (path, n, depth), so many rows at a time; a node that goes on is carried, whatever its size."""
    held: list[pa.RecordBatch] = []
    still: list[tuple[bytes, int]] = []
    size, depth = 0, 0

    def made(ended: bool) -> list[tuple[bytes, int]]:
        nonlocal still, depth, size
        path = pa.concat_arrays([pa.array([p for p, _ in still], type=pa.binary()), *(b.column(0) for b in held)])
        n, parted = (np.concatenate([first, *(b.column(c).to_numpy() for b in held)]) for c, first in ((1, [n for _, n in still]), (2, [depth] * len(still))))
        held.clear()
        out, still = _nodes(path, n.astype(np.int64), parted.astype(np.int64), least, ended)
        depth, size = int(parted[-1]), 0
        return out

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= rows:
            yield made(False)
    if held or still:
        yield made(True)


def _counted(rows: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, n_words, n) of the subtrees of each partition, whose paths come sorted; a phrase of no words is the language."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n_words", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in nodes_of(batches, least):
            names = [[_word(s).decode() for s in path.split(b"\0")] for path, _ in found]
            columns = [[p[0] for p in names], [" ".join(p[1:]) for p in names], [len(p) - 1 for p in names], [n for _, n in found]]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return rows.mapInArrow(lean(run), "lang string, phrase string, n_words int, n long")


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, budget: int = BUDGET, bits: int = BITS, lot: int = LOT) -> DataFrame:
    """(lang, phrase, n_words, n): how often phrases of up to `MOST` words come, those with `least` occurrences, and with n_words 0 the words of each language."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    paths = written(_paths(rows, _frequent(rows, least, bits, lot), lot), "paths", "zstd")
    dealt, groups = grouped(paths, budget)
    trees = _counted(dealt.repartitionById(groups, "group").sortWithinPartitions("path").select("path", "n", "depth"), least)
    nodes = written(trees.groupBy("lang", "phrase", "n_words").agg(F.sum("n").alias("n")).filter(f"n >= {least} or n_words = 0"), "nodes")
    dropped(paths)
    return nodes


def _score(a: Column, part: Column, rest: Column) -> Column:
    wide = [c.cast("decimal(18,0)") for c in (a, part, rest)]
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * wide[0] * wide[0], wide[1] * wide[2])


def collocations(nodes: DataFrame, share: int = SHARE, top: int = TOP) -> DataFrame:
    """Per language the best `top` phrases of two words and more: lang, rank, phrase, a, l, r, n, score."""
    known = nodes.filter(f"n_words between 1 and {MOST - 1}").select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    candidates = nodes.filter("n_words > 1")
    space = F.split("phrase", " ")
    cuts = candidates.select("lang", "phrase", "n_words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"), space.alias("w"))
    sides = cuts.select("lang", "phrase", "n_words", "a", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("first"), F.array_join(F.slice("w", F.col("k") + 1, F.col("n_words")), " ").alias("rest"))
    left = sides.join(known.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    both = left.join(known.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    scored = both.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    best = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), lowest)
    # phrases inside a longer candidate, with the most that one of these has
    inner = [(size, at) for size in range(2, MOST) for at in range(1, MOST - size + 2)]
    longer = [candidates.filter(F.col("n_words") >= max(size + 1, at + size - 1)).select("lang", F.array_join(F.slice(space, at, size), " ").alias("phrase"), F.col("n").alias("most")) for size, at in inner]
    inside = reduce(DataFrame.union, longer).groupBy("lang", "phrase").agg(F.max("most").alias("most"))
    rows = best.join(inside, ["lang", "phrase"], "left").filter(f"most is null or 100 * most < {share} * a").select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    for parts in (*_PARTS, 1):
        window = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(parts))).orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(window).cast("long")).filter(f"rank <= {top}")
    totals = nodes.filter("n_words = 0").select("lang", "n")
    return rows.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(phrase_counts(table(spark, sf_dir, "documents")))


OP11_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) v(k))),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS n FROM g GROUP BY ALL),
t AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND n >= 10),
cut AS (SELECT c.lang, c.phrase, c.n AS a, j AS k, array_to_string(string_split(c.phrase, ' ')[1:j], ' ') AS x, array_to_string(string_split(c.phrase, ' ')[j + 1:], ' ') AS y FROM c, (VALUES (1), (2)) v(j) WHERE j < c.k),
s AS (SELECT cut.lang, cut.phrase, a, cut.k, l.n AS l, r.n AS r, (1000000 * a * a) // (l.n * r.n) AS score FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = x JOIN f r ON r.lang = cut.lang AND r.phrase = y),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT lang, x AS phrase, max(n) AS most FROM (SELECT lang, n, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS x FROM c WHERE k = 3) GROUP BY ALL),
k AS (SELECT b.* FROM b LEFT JOIN o USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * a),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM k)
SELECT z.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, t.n, score::BIGINT AS score FROM z JOIN t USING (lang) WHERE rank <= 2000
"""
