"""Language-model scoring with a hidden Markov model.

Latent states follow a Markov chain over tokens; each state emits word classes, and a class emits its words. Classes are
a fixed number of hash buckets of words, so the model has a fixed size, while the words' own counts, gathered over the
whole corpus, say how a class spreads over its words:
    P(word | state) = P(class | state) * count(word) / count(class)
Words never seen form a class of their own, whose weight in a state is learned from the words seen once (they were new
when they came). Class probabilities are smoothed towards the unigram ones, so every word has a probability and they
sum to 1.

Baum-Welch: each round, tasks run forward and backward over their whole documents and emit expected counts and the
likelihood, which Spark sums; states start from random tilts that hash each class. Scoring: the scaled forward recursion over the whole
document gives its exact likelihood. Long documents are cut into blocks whose transfer matrices are multiplied in order,
which is the same recursion.

Texts are tokenized once. Chunks of documents are written as token numbers with the chunk's vocabulary; word counts reach a
chunk by a join on words. Hot words are pre-aggregated by chunk.

Nulls: a null text is an empty one, which has the end token only. A null doc_id trains. Repeated rows count as
often as they occur. An empty table gives none; with no training rows all words are new. Only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import dropped, table, written

STATES = 6
ROUNDS = 4
#: Word classes; the model's size is STATES times this, whatever the corpus.
CLASSES = 1 << 14
STAY = 0.95
#: Weight of the unigram distribution in each state, in tokens.
PRIOR = 200.0
#: Tokens of a chunk, of documents that are trained together, of a block of the forward recursion.
CHUNK, LOT, BLOCK = 4_000_000, 400_000, 64
FOLDS, HELD = 5, 1
_END = b"\n"


class _Numbers(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def is_held_out(doc_id: object) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD


def packed_numbers(numbers: np.ndarray) -> bytes:
    """Numbers below 2^31, all low bytes first, then the next ones: high bytes repeat much and take little room."""
    planes = np.ascontiguousarray(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.compress(planes.tobytes(), 3)


def unpacked_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def _chunks(docs: DataFrame) -> DataFrame:
    """Rows of chunks (word null): doc_ids, lengths, numbers; and rows of their vocabularies: word, number, count in training."""
    schema = pa.schema([("chunk", pa.int64()), ("word", pa.binary()), ("number", pa.int32()), ("n", pa.int64()), ("doc_ids", pa.list_(pa.string())), ("lengths", pa.list_(pa.int64())), ("numbers", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        words, ids, lengths, tokens, size = _Numbers({_END: 0}), [], [], [], 0

        def full() -> Iterator[pa.RecordBatch]:
            nonlocal made, words, ids, lengths, tokens, size
            chunk, flat = (part << 24) + made, np.concatenate(tokens)
            trains = np.repeat([not is_held_out(i) for i in ids], lengths)
            counts = np.bincount(flat[trains], minlength=len(words))
            n = len(words)
            nothing = [pa.nulls(n, schema.field(k).type) for k in (4, 5, 6)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, chunk)), pa.array(list(words), type=pa.binary()), pa.array(np.arange(n, dtype=np.int32)), pa.array(counts.astype(np.int64)), *nothing], schema=schema)
            values = [chunk, None, None, int(counts.sum()), ids, lengths, packed_numbers(flat)]
            yield pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(values, schema, strict=True)], schema=schema)
            words, ids, lengths, tokens, size, made = _Numbers({_END: 0}), [], [], [], 0, made + 1

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                row = (text or b"").lower().split()
                row.append(_END)
                ids.append(doc_id)
                lengths.append(len(row))
                tokens.append(np.fromiter(map(words.__getitem__, row), dtype=np.int32, count=len(row)))
                size += len(row)
                if size >= CHUNK:
                    yield from full()
        if ids:
            yield from full()

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "chunk long, word binary, number int, n long, doc_ids array<string>, lengths array<long>, numbers binary")


def _classes(word: str = "word"):
    return F.pmod(F.xxhash64(word), F.lit(CLASSES)).cast("int")


class Model:
    """start (K), move (K, K) and emit (K, CLASSES + 1): the last class is that of new words."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    @staticmethod
    def initial(unigram: np.ndarray) -> Model:
        tilt = np.random.default_rng(11).lognormal(0.0, 0.7, (STATES, len(unigram)))
        emit = tilt * unigram
        move = np.full((STATES, STATES), (1 - STAY) / (STATES - 1)) + np.eye(STATES) * (STAY - (1 - STAY) / (STATES - 1))
        return Model(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=1, keepdims=True))

    @staticmethod
    def estimated(start: np.ndarray, move: np.ndarray, emit: np.ndarray, unigram: np.ndarray) -> Model:
        emit = emit + PRIOR * unigram
        move = move + 1.0
        return Model((start + 1.0) / (start + 1.0).sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))


def expected_counts(model: Model, cls: np.ndarray, once: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, moves and emissions over whole documents, by the scaled forward and backward recursions, and the log10
    likelihood. Documents of like lengths advance together, at most about LOT tokens at a time; none is cut."""
    k = STATES
    start, move, emit, total = np.zeros(k), np.zeros((k, k)), np.zeros((k, model.emit.shape[1])), 0.0
    weights = np.ascontiguousarray(model.emit.T)
    order = np.argsort(-lengths, kind="stable")
    begin, size = (np.cumsum(lengths) - lengths)[order], lengths[order]
    lots = (np.cumsum(size) - size) // LOT
    for lot in np.split(np.arange(len(size)), np.flatnonzero(np.diff(lots)) + 1):
        b, s = begin[lot], size[lot]
        if not len(s) or not s[0]:
            continue
        active = np.searchsorted(-s, -np.arange(int(s[0])), side="left")  # documents longer than t, the first ones
        off = np.append(0, np.cumsum(active))
        lane = np.arange(off[-1]) - np.repeat(off[:-1], active)
        at = b[lane] + np.repeat(np.arange(len(active)), active)
        seen = weights[cls[at]]
        alphas, scales = np.empty_like(seen), np.empty((len(at), 1))
        alpha = np.broadcast_to(model.start, (len(b), k))
        for t, n in enumerate(active.tolist()):
            here = slice(off[t], off[t] + n)
            now = (alpha[:n] if t == 0 else alpha[:n] @ model.move) * seen[here]
            scales[here] = c = now.sum(axis=1, keepdims=True)
            alphas[here] = alpha = now / c
        total += float(np.log10(scales).sum())
        seen /= scales
        beta = np.ones((int(active[-1]), k))
        for t in range(len(active) - 1, -1, -1):
            n = int(active[t])
            here = slice(off[t], off[t] + n)
            if t + 1 < len(active):
                m = int(active[t + 1])
                ahead = seen[off[t + 1] : off[t + 1] + m] * beta
                move += model.move * (alphas[off[t] : off[t] + m].T @ ahead)
                beta = np.concatenate([ahead @ model.move.T, np.ones((n - m, k))]) if n > m else ahead @ model.move.T
            alphas[here] *= beta
        tokens, fresh = cls[at], once[at]
        for i in range(k):
            emit[i] += np.bincount(tokens, weights=alphas[:, i], minlength=emit.shape[1])
            emit[i, -1] += alphas[fresh, i].sum()
        start += alphas[: len(b)].sum(axis=0)
    return start, move, emit, total


def log_likelihood(model: Model, cls: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """log10 of each document's class sequence: exact, by products of the blocks' transfer matrices."""
    k = STATES
    ends = np.cumsum(lengths)
    pieces = -(-lengths // BLOCK)
    owner = np.repeat(np.arange(len(lengths)), pieces)
    part = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = (ends - lengths)[owner] + part * BLOCK
    size = np.minimum(ends[owner] - begin, BLOCK)
    weights = np.ascontiguousarray(model.emit.T)
    whole, logs = np.empty((len(begin), k, k)), np.empty(len(begin))
    order = np.argsort(-size, kind="stable")
    for lot in range(0, len(begin), 8192):
        pick = order[lot : lot + 8192]
        b, s = begin[pick], size[pick]
        transfer, log = np.repeat(np.eye(k)[None], len(b), axis=0), np.zeros(len(b))
        for t in range(int(s[0])):
            n = int((s > t).sum())
            w = weights[cls[b[:n] + t]]
            now = transfer[:n] if t == 0 else (transfer[:n].reshape(-1, k) @ model.move).reshape(n, k, k)
            now = now * w[:, None, :]
            c = now.max(axis=(1, 2))
            transfer[:n] = now / c[:, None, None]
            log[:n] += np.log10(c)
        whole[pick], logs[pick] = transfer, log
    # all documents step through their blocks together
    out, state = np.zeros(len(lengths)), np.broadcast_to(model.start, (len(lengths), k)).copy()
    first = np.cumsum(pieces) - pieces
    by_length = np.argsort(-pieces, kind="stable")
    for t in range(int(pieces.max(initial=0))):
        docs = by_length[: int((pieces > t).sum())]
        at = first[docs] + t
        now = state[docs] if t == 0 else state[docs] @ model.move
        now = np.einsum("ni,nij->nj", now, whole[at])
        c = now.sum(axis=1)
        state[docs] = now / c[:, None]
        out[docs] += np.log10(c) + logs[at]
    return out


def _decoded(batch: pa.RecordBatch, k: int) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, lengths, and per token the class, the word's count; the vocabulary in order of its numbers."""
    doc_ids, lengths, numbers, cls, counts = (batch.column(c)[k].as_py() for c in ("doc_ids", "lengths", "numbers", "cls", "counts"))
    at = unpacked_numbers(numbers)
    counts = np.array(counts, dtype=np.int64)
    classes = np.where(counts > 0, np.array(cls, dtype=np.int64), CLASSES)
    return doc_ids, np.array(lengths, dtype=np.int64), classes[at], counts[at], np.array([not is_held_out(i) for i in doc_ids], dtype=bool)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", history: list[float] | None = None) -> DataFrame:
    """Per document: held_out, n_tokens, n_known, train_tokens, base_score and score. `history` takes the training texts' log10
    likelihood (of classes) before each round."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    made = written(_chunks(rows), "lm-chunks")
    entries = made.filter("word is not null")
    vocabulary = written(entries.groupBy("word").agg(F.sum("n").alias("c")), "lm-words")
    totals = vocabulary.filter("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    n_train, n_words = int(totals[0]), int(totals[1])
    space = n_train + 0.5 * (n_words + 1)
    mass = np.zeros(CLASSES + 1)
    for r in vocabulary.filter("c > 0").groupBy(_classes().alias("k")).agg(F.sum("c").alias("n")).collect():  # at most CLASSES rows
        mass[r["k"]] = r["n"]
    unigram = mass.copy()
    unigram[-1] = 0.5
    unigram /= unigram.sum()
    per_chunk = entries.select("chunk", "number", "word").join(vocabulary, "word").groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("number", _classes().alias("k"), "c"))).alias("v"))
    per_chunk = per_chunk.select("chunk", F.transform("v", lambda x: x["k"]).alias("cls"), F.transform("v", lambda x: x["c"]).alias("counts"))
    per_chunk = written(per_chunk, "lm-counts")
    chunks = written(made.filter("word is null").select("chunk", "doc_ids", "lengths", "numbers").join(per_chunk, "chunk"), "lm-coded")
    dropped(made)
    dropped(per_chunk)

    model = Model.initial(unigram)
    for _ in range(ROUNDS):
        model, total = _trained(spark, chunks, model, unigram)
        if history is not None:
            history.append(total)

    shared = spark.sparkContext.broadcast((model, mass))
    schema = pa.schema([("doc_id", pa.string()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, class_mass = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                doc_ids, lengths, cls, counts, trains = _decoded(batch, k)
                first = np.cumsum(lengths) - lengths
                known = np.add.reduceat((counts > 0).astype(np.int64), first)
                base = np.add.reduceat(np.log10((counts + 0.5) / space), first)
                # of a known word, its share of the class; new words are one symbol
                share = np.where(counts > 0, np.log10(np.maximum(counts, 1) / np.maximum(class_mass[cls], 1)), 0.0)
                total = log_likelihood(fitted, cls, lengths) + np.add.reduceat(share, first)
                columns = [doc_ids, ~trains, lengths, known, base, total]
                yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(columns, schema, strict=True)], schema=schema)

    scored = chunks.mapInArrow(run, "doc_id string, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    kind = rows.schema["doc_id"].dataType
    return scored.select(F.col("doc_id").cast(kind).alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score")


def _trained(spark: SparkSession, chunks: DataFrame, model: Model, unigram: np.ndarray) -> tuple[Model, float]:
    """One Baum-Welch round: expected counts from every chunk, summed by Spark; and the log10 likelihood under the model before."""
    shared = spark.sparkContext.broadcast(model)
    schema = pa.schema([("kind", pa.int32()), ("at", pa.int32()), ("counts", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                _, lengths, cls, counts, trains = _decoded(batch, k)
                keep = np.repeat(trains, lengths)
                if not keep.any():
                    continue
                start, move, emit, total = expected_counts(shared.value, cls[keep], counts[keep] == 1, lengths[trains])
                used = np.nonzero(emit.sum(axis=0))[0]
                kinds = np.concatenate([[0], np.ones(STATES), np.full(len(used), 2), [3]]).astype(np.int32)
                at = np.concatenate([[0], np.arange(STATES), used, [0]]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(at), pa.array([start, *move, *emit.T[used], [total] + [0.0] * (STATES - 1)], type=schema.field(2).type)], schema=schema)

    emitted = chunks.select("doc_ids", "lengths", "numbers", "cls", "counts").mapInArrow(run, "kind int, at int, counts array<double>")
    summed = emitted.groupBy("kind", "at").agg(*(F.sum(F.col("counts")[i]).alias(f"s{i}") for i in range(STATES)))
    start, move, emit, total = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, CLASSES + 1)), 0.0
    for r in summed.collect():  # at most CLASSES + STATES + 3 rows
        v = np.array(r[2:], dtype=float)
        if r["kind"] == 0:
            start = v
        elif r["kind"] == 1:
            move[r["at"]] = v
        elif r["kind"] == 2:
            emit[:, r["at"]] = v
        else:
            total = float(v[0])
    return Model.estimated(start, move, emit, unigram), total


def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
