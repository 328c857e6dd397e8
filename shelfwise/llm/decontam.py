"""Benchmark decontamination: a BM25 inverted index of the test items, searched by every passage of every document
with block-max WAND; what it retrieves is verified by question and answer overlap.

Scores are BM25 divided by the item's score for its own words, so that one threshold fits all items: 1 means that the
passage has every term of the item. Passages are windows of twice the longest item's words, half overlapping, so an
item always lies in one of them. Bounds from the blocks' largest shares, for all passages at once, rule out those that reach no
item at all; each of the others runs WAND over the whole shard, whose cursors pass the blocks of items that the same bounds rule out
in one step. All items above the threshold are retrieved, none is cut off by rank.

The index is broadcast in shards of bounded size (`SHARD_POSTINGS`); more items mean more shards, each searched by all passages, one
after another. Term statistics always cover all items.

Nulls: a null text has no passage, a null item no term. Repeated documents each get a row, repeated items count once. Ties: of a
document's passages with the same item the best counts. A very long text is searched `WINDOWS` passages at a time, all of them.
Without items nothing is contaminated. Only the named columns are read.
"""

import math
import re
from bisect import bisect_left
from collections import defaultdict
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import table, words, written

K1, B = 1.2, 0.75
#: Share of an item's own score that a passage must reach to be verified.
THRESHOLD = 0.6
#: Shares of the question's and the answer's word triples that the passage must hold.
QUESTION_OVERLAP, ANSWER_OVERLAP = 0.6, 0.5
BLOCK_ITEMS = 8
#: Windows of one text whose bounds are computed together.
WINDOWS = 256
SHARD_POSTINGS = 2_000_000
_LEAST_HALF = 32


#: Punctuation is dropped, so that marks around a word don't hide it.
_MARKS = ".,;:!?#*$%&|<>()[]{}\"'"


def _plain(text):
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _MARKS, "abcdefghijklmnopqrstuvwxyz")


def plain_words(text: bytes) -> list[bytes]:
    return text.lower().translate(None, _MARKS.encode()).split()


def postings(items: DataFrame) -> DataFrame:
    """(item_id, text, terms: array of (term, tf, df)) with the statistics n_items, mean_length and max_length."""
    rows = items.select("item_id", "text").distinct().select("item_id", "text", words(_plain(F.col("text"))).alias("w")).filter(F.size("w") > 0)
    stats = rows.agg(F.count(F.lit(1)).alias("n_items"), F.avg(F.size("w")).alias("mean_length"), F.max(F.size("w")).alias("max_length"))
    counts = rows.select("item_id", "text", F.size("w").alias("length"), F.explode("w").alias("term")).groupBy("item_id", "text", "length", "term").agg(F.count(F.lit(1)).alias("tf"))
    df = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    gathered = counts.join(df, "term").groupBy("item_id", "text", "length").agg(F.collect_list(F.struct("term", "tf", "df")).alias("terms"))
    return gathered.join(F.broadcast(stats))  # one row


def halves(text: str) -> tuple[list[bytes], list[bytes]]:
    """Question and answer words: the answer is the last sentence, and at least the last quarter and five words."""
    w = plain_words(text.encode())
    sentences = re.split(r"(?<=[.?!])\s+", text.strip())
    last = len(plain_words(sentences[-1].encode()))
    cut = max(0, len(w) - max(last if len(sentences) > 1 else 0, len(w) // 4, 5))
    return w[:cut], w[cut:]


def _grams(w: list[bytes], n: int = 3) -> set[tuple[bytes, ...]]:
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


class Index:
    """One shard of the inverted index, with impacts as shares of an item's own score."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: r["length"])  # alike lengths in a block make its bounds tight
        self.ids = [r["item_id"] for r in rows]
        self.terms: dict[bytes, int] = {}
        lists: dict[int, list[tuple[int, float]]] = defaultdict(list)
        self.parts = []
        for i, r in enumerate(rows):
            impact = {}
            for t in r["terms"]:
                idf = math.log(1 + (r["n_items"] - t["df"] + 0.5) / (t["df"] + 0.5))
                impact[t["term"]] = idf * t["tf"] * (K1 + 1) / (t["tf"] + K1 * (1 - B + B * r["length"] / r["mean_length"]))
            whole = sum(impact.values())
            for term, v in impact.items():
                lists[self.terms.setdefault(term.encode(), len(self.terms))].append((i, v / whole))
            self.parts.append([(n := min(3, len(p)), _grams(p, n) if n else set()) for p in halves(r["text"])])
        self.items = [[i for i, _ in lists[t]] for t in range(len(self.terms))]
        self.impacts = [[v for _, v in lists[t]] for t in range(len(self.terms))]
        self.blocks = [[max(v[k : k + BLOCK_ITEMS]) for k in range(0, len(v), BLOCK_ITEMS)] for v in self.impacts]
        self.bound = [max(v) for v in self.impacts]
        # per term the numbers of the item blocks that hold it and its largest impact there, for bounds of many passages at once
        held = [sorted({i // BLOCK_ITEMS: 0 for i in x}) for x in self.items]
        self.n_blocks = -(-len(rows) // BLOCK_ITEMS)
        self.term_lengths = np.array([len(x) for x in held], dtype=np.int64)
        self.term_starts = np.cumsum(self.term_lengths) - self.term_lengths
        self.term_blocks = np.array([k for x in held for k in x], dtype=np.int64)
        self.term_bounds = np.array([max(v for i, v in zip(x, y, strict=True) if i // BLOCK_ITEMS == k) for x, y, h in zip(self.items, self.impacts, held, strict=True) for k in h])
        self.half = max([_LEAST_HALF, *(r["max_length"] for r in rows[:1])])

    def search(self, query: list[int], threshold: float = THRESHOLD, blocks: list[int] | None = None) -> list[tuple[int, float]]:
        """Block-max WAND: every item whose share reaches the threshold. `blocks` are those of the items, ascending, whose bounds reach it: cursors
        pass the others at once."""
        found, n = [], len(self.ids)
        cursors = [[self.items[t][0], 0, t] for t in query]
        while True:
            cursors.sort()
            total, pivot = 0.0, -1
            for k, (item, _, t) in enumerate(cursors):
                if item >= n:
                    break
                total += self.bound[t]
                if total >= threshold - 1e-9:
                    pivot = k
                    break
            if pivot < 0:
                return found
            target = cursors[pivot][0]
            if blocks is not None:
                k = bisect_left(blocks, target // BLOCK_ITEMS)
                begin = blocks[k] * BLOCK_ITEMS if k < len(blocks) else n
                if begin > target:
                    if begin == n:
                        return found
                    for c in cursors:
                        if c[0] < begin:
                            self._seek(c, begin)
                    continue
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == target:
                pivot += 1
            # the blocks that hold the target must be able to reach the threshold
            total, after = 0.0, n
            for c in cursors[: pivot + 1]:
                items, at = self.items[c[2]], c[1]
                while at < len(items) and items[min(len(items), (at // BLOCK_ITEMS + 1) * BLOCK_ITEMS) - 1] < target:
                    at = (at // BLOCK_ITEMS + 1) * BLOCK_ITEMS
                if at < len(items):
                    block = at // BLOCK_ITEMS
                    total += self.blocks[c[2]][block]
                    after = min(after, items[min(len(items), (block + 1) * BLOCK_ITEMS) - 1] + 1)
            if total >= threshold - 1e-9:
                score = 0.0
                for c in cursors[: pivot + 1]:
                    self._seek(c, target)
                    if c[0] == target:
                        score += self.impacts[c[2]][c[1]]
                        self._seek(c, target + 1)
                if score >= threshold - 1e-9:
                    found.append((target, score))
            else:
                if pivot + 1 < len(cursors):
                    after = min(after, cursors[pivot + 1][0])
                for c in cursors[: pivot + 1]:
                    self._seek(c, max(after, target + 1))

    def _seek(self, cursor: list[int], item: int) -> None:
        items = self.items[cursor[2]]
        at = bisect_left(items, item, cursor[1])
        cursor[0], cursor[1] = (items[at] if at < len(items) else len(self.ids)), at

    def _possible(self, window: np.ndarray, term: np.ndarray) -> dict[int, list[int]]:
        """Windows of which some block's bound reaches the threshold, with these blocks; no other can have a hit."""
        first = int(window[0])
        lengths = self.term_lengths[term]
        ends = np.cumsum(lengths)
        entry = np.repeat(self.term_starts[term] - (ends - lengths), lengths) + np.arange(ends[-1])
        cell = np.repeat(window - first, lengths) * self.n_blocks + self.term_blocks[entry]
        bounds = np.bincount(cell, weights=self.term_bounds[entry])
        out: dict[int, list[int]] = {}
        for hit in np.flatnonzero(bounds >= THRESHOLD - 1e-9).tolist():
            out.setdefault(hit // self.n_blocks + first, []).append(hit % self.n_blocks)
        return out

    def find(self, text: bytes) -> list[tuple[int, float, float, float]]:
        """(item, best share, question overlap, answer overlap) of the verified items of one document."""
        row = plain_words(text)
        ids = np.fromiter(map(self.terms.get, row, repeat(-1)), dtype=np.int64, count=len(row))
        at = np.nonzero(ids >= 0)[0]
        if not len(at):
            return []
        best: dict[int, tuple[int, float, float, float]] = {}
        size, v = 2 * self.half, len(self.terms)
        for shift in (0, self.half):
            if shift and len(row) <= self.half:
                break
            every = np.unique((at + shift) // size * v + ids[at])  # each window's distinct terms
            cuts = np.searchsorted(every // v, np.arange(0, int(every[-1]) // v + 1 + WINDOWS, WINDOWS))
            for keys in (every[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True) if j > i):
                window, term = np.divmod(keys, v)
                for w, blocks in self._possible(window, term).items():
                    begin, end = max(0, w * size - shift), (w + 1) * size - shift
                    query = term[np.searchsorted(window, w) : np.searchsorted(window, w + 1)].tolist()
                    for item, score in self.search(query, THRESHOLD, blocks):
                        question, answer = (len(p & _grams(row[begin:end], n)) / len(p) if p else 1.0 for n, p in self.parts[item])
                        if question >= QUESTION_OVERLAP and answer >= ANSWER_OVERLAP and score > best.get(item, (0, 0.0))[1]:
                            best[item] = (item, score, question, answer)
        return list(best.values())


def contamination(docs: DataFrame, items: DataFrame, carry: bool = False) -> DataFrame:
    """Per document: doc_id, contaminated, the verified items' ids and the best score. `carry` keeps a column `row`."""
    index = written(postings(items), "bm25")
    total = index.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    shards = max(1, -(-total // SHARD_POSTINGS))
    out = docs
    for k in range(shards):
        rows = index.filter(F.pmod(F.xxhash64("item_id"), F.lit(shards)) == k).orderBy("item_id", "text").collect()  # at most about SHARD_POSTINGS postings
        out = _with_shard(out, rows, k)
        if shards > 1:  # one index at a time in the workers
            out = written(out, "searched")
    parts = [F.col(f"hits_{k}") for k in range(shards)]
    hits = F.concat(*parts)
    found = out.select("doc_id", *(["row"] if carry else []), hits.alias("hits"))
    return found.select(
        "doc_id", *(["row"] if carry else []), (F.size("hits") > 0).alias("contaminated"), F.array_sort(F.transform("hits", lambda h: h["item"])).alias("items"),
        F.coalesce(F.array_max(F.transform("hits", lambda h: h["score"])), F.lit(0.0)).alias("best_score"),
    )


def _with_shard(docs: DataFrame, rows: list, number: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast([r.asDict(recursive=True) for r in rows])
    built: dict[str, Index] = {}

    @F.pandas_udf("array<struct<item:long,score:double,question:double,answer:double>>")
    def search(texts: pd.Series) -> pd.Series:
        if "index" not in built:
            built["index"] = Index(shared.value)
        index = built["index"]
        return texts.map(lambda t: [{"item": index.ids[i], "score": s, "question": q, "answer": a} for i, s, q, a in index.find((t or "").encode())])

    return docs.withColumn(f"hits_{number}", search("text"))


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    rows = docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return contamination(rows, items, carry=True).filter("not contaminated").select("row.*")


def op6_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
