"""Token-ID output: documents are tokenized in ascending doc_id order and written as coded binary segments.

Documents are dealt by range of doc_id, each partition is sorted, and consecutive documents fill segments
of about `SEGMENT_IDS` ids, never splitting one, and are tokenized `BATCH_BYTES` of text at a time. A segment is one row: partition, number, the documents' ids and
lengths, and the payload of `token_coder`: independent, checksummed blocks. Rows lie in Parquet in shared storage.

Reading decodes each segment once, in parallel; a document's start is its place in the segment after all earlier ones'
totals, which are summed first by segment and then by partition.

Nulls: a null text is an end id alone; null doc_ids come first. Repeated doc_ids keep all their rows, ordered by a hash
of the text; ties of that too are equal rows. A very long text is one batch and one part of a segment, held whole by its
task. An empty table writes no segment. Only the named columns are read. Other tokenizers than the one of `_Encoder`'s shortcuts are
noticed by a probe and encode whole texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm import token_coder
from shelfwise.llm.common import lean, table, written

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
SEGMENT_IDS = 4_000_000
BATCH_BYTES, BATCH_TEXTS = 4_000_000, 2000
#: Words that a worker keeps encoded between batches.
CACHE_WORDS = 500_000

#: What shows whether a tokenizer may be run word by word: letter cases, punctuation, digits, white space, other scripts.
_PROBE = "The quick, brown (fox)  Jumps!? over\t3.14 dogs; it's na\u00efve\u2014\u4e2d\u6587 re-use end.\nNew Line: A1b2 #tag $5 ...Ok "

_encoders: dict[str, _Encoder | _WholeTexts] = {}


class _WholeTexts:
    """Any tokenizer, one text after another."""

    def __init__(self, tokenizer: Any):
        self.tokenizer = tokenizer

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids + [END_ID] for e in self.tokenizer.encode_batch([t.decode() for t in texts], add_special_tokens=False)]
        return np.array([i for x in found for i in x], dtype=np.int64), np.array([len(x) for x in found], dtype=np.int64)


class _Encoder:
    """Encodes by white-space words, each different one once: this tokenizer drops white space and splits on it, so no token spans two words.

    It lower-cases, so ASCII letters are lower-cased first, and it parts letters from the closing punctuation that follows them, so
    these are words of their own here. Words of letters alone are encoded many at a time: each is one piece there, and its last
    id is one that ends words. Splitting and numbering words is Arrow's. Texts in which a special token shows up by lower-casing
    are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.clear()

    def _pieces(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The words' ids one after another, and how many each has."""
        joined = np.array(self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, dtype=np.int64)
        last = np.nonzero(self.ends[joined])[0]
        if len(last) == len(words):
            return joined, np.diff(last, prepend=-1)
        return self._each(words)

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        new = [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]
        lengths = np.array([len(x) for x in new], dtype=np.int64)
        return np.fromiter((i for x in new for i in x), dtype=np.int64, count=int(lengths.sum())), lengths

    def _add(self, words: list[str]) -> None:
        """Encodes words that are not known yet."""
        for alone, encode in ((True, self._pieces), (False, self._each)):
            some = [w for w in words if w.isalpha() == alone]
            parts = [encode(some[k : k + 2000]) for k in range(0, len(some), 2000)]
            if parts:
                ids, lengths = (np.concatenate(x) for x in zip(*parts, strict=True))
                self.index.update(zip(some, range(len(self.starts), len(self.starts) + len(some)), strict=True))
                self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
                self.lengths, self.ids = np.concatenate([self.lengths, lengths]), np.concatenate([self.ids, ids])

    def clear(self) -> None:
        # word 0 is empty
        self.index, self.ids = {"": 0}, np.zeros(0, dtype=np.int64)
        self.starts, self.lengths = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, an end id after each text, and the number of ids of each text."""
        if len(self.index) > CACHE_WORDS:
            self.clear()
        lower = pc.ascii_lower(pa.array(texts, type=pa.large_binary()).cast(pa.large_string()))
        whole = np.zeros(len(texts), dtype=bool)
        for token in self.special:
            whole |= pc.match_substring(lower, token).to_numpy(zero_copy_only=False)
        marked = pc.replace_substring_regex(pc.binary_join_element_wise(lower, *(pa.scalar(x, pa.large_string()) for x in ("\n", ""))), r"([a-z])([.,;:!?]+)([\t-\r ])", r"\1 \2\3")
        words = pc.ascii_split_whitespace(marked)
        coded = words.flatten().dictionary_encode()
        unique = coded.dictionary.to_pylist()
        self._add([w for w in unique if w not in self.index])
        known = np.fromiter(map(self.index.__getitem__, unique), dtype=np.int64, count=len(unique))
        word = known[coded.indices.to_numpy()]
        lengths = self.lengths[word]
        ends = np.append(0, np.cumsum(lengths))
        ids = self.ids[np.repeat(self.starts[word] - ends[:-1], lengths) + np.arange(ends[-1])]
        offsets = words.offsets.to_numpy().astype(np.int64)
        made = np.diff(ends[offsets - offsets[0]])
        if whole.any():
            parts = np.split(ids, np.cumsum(made)[:-1])
            for k in np.flatnonzero(whole).tolist():
                parts[k] = np.array(self.tokenizer.encode(texts[k].decode(), add_special_tokens=False).ids, dtype=np.int64)
            ids, made = np.concatenate(parts), np.array([len(x) for x in parts], dtype=np.int64)
        out = np.full(len(ids) + len(texts), END_ID, dtype=np.int32)
        inner = np.ones(len(out), dtype=bool)
        inner[np.cumsum(made + 1) - 1] = False
        out[inner] = ids
        return out, made + 1


def _encoder(path: str) -> _Encoder | _WholeTexts:
    if path not in _encoders:
        made = _Encoder(path)
        if made.encode([_PROBE.encode()])[0].tolist() != [*made.tokenizer.encode(_PROBE, add_special_tokens=False).ids, END_ID]:
            made = _WholeTexts(made.tokenizer)
        _encoders[path] = made
    return _encoders[path]


def _lots(batch: pa.RecordBatch) -> Iterator[tuple[list[Any], list[bytes]]]:
    """Ids and texts of a batch, so many or so many bytes at a time."""
    ids, texts, size = [], [], 0
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        ids.append(doc_id)
        texts.append(text.as_py())
        size += len(texts[-1])
        if size >= BATCH_BYTES or len(texts) >= BATCH_TEXTS:
            yield ids, texts
            ids, texts, size = [], [], 0
    if texts:
        yield ids, texts


def write_tokens(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The segments as written to shared storage: part, segment, doc_ids, lengths, n_ids, payload."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    keys = (F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment = TaskContext.get().partitionId(), 0
        held: list[tuple[list[Any], np.ndarray, np.ndarray]] = []

        def full() -> pa.RecordBatch:
            nonlocal segment, held
            ids = np.concatenate([x[1] for x in held])
            row = [part, segment, [i for x in held for i in x[0]], np.concatenate([x[2] for x in held]), len(ids), token_coder.encode(ids)]
            segment, held = segment + 1, []
            return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            for doc_ids, texts in _lots(batch):
                held.append((doc_ids, *_encoder(path).encode(texts)))
                if sum(len(x[1]) for x in held) >= SEGMENT_IDS:
                    yield full()
        if held:
            yield full()

    return written(ordered.mapInArrow(lean(run), "part int, segment int, doc_ids array<long>, lengths array<long>, n_ids long, payload binary"), "tokens")


def read_tokens(segments: DataFrame) -> DataFrame:
    """Per document, from the written segments: doc_id, start, n_tokens and the checksum of its ids."""
    schema = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("doc_id", pa.int64()), ("local", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _encoders.clear()  # words that this worker kept encoded; decoding needs the room
        for batch in batches:
            for k in range(batch.num_rows):
                part, segment, doc_ids, lengths, payload = (batch.column(c)[k].as_py() for c in range(5))
                ids = token_coder.decode(payload).astype("<u4")
                ends = np.cumsum(np.array(lengths, dtype=np.int64))
                if len(ids) != ends[-1]:
                    raise ValueError(f"segment {part}/{segment}: {len(ids)} ids instead of {ends[-1]}")
                starts, view = ends - lengths, memoryview(ids.tobytes())
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(starts, ends, strict=True)]
                n = len(doc_ids)
                yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(([part] * n, [segment] * n, doc_ids, starts, lengths, crc), schema, strict=True)], schema=schema)

    decoded = segments.select("part", "segment", "doc_ids", "lengths", "payload").mapInArrow(lean(run), "part int, segment int, doc_id long, local long, n_tokens long, ids_crc32 long")
    decoded = written(decoded, "decoded")  # a join that is planned anew would decode again
    zero = F.lit(0).cast("long")
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), zero).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    places = segments.select("part", "segment", F.coalesce(F.sum("n_ids").over(inside), zero).alias("segment_start")).join(parts, "part")
    return decoded.join(places, ["part", "segment"]).select("doc_id", (F.col("part_start") + F.col("segment_start") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_tokens(write_tokens(table(spark, sf_dir, "documents")))
