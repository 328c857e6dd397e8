"""How often shingles occur, as a table of fixed size: a shingle's cell, by its hash, counts all shingles of that cell.

A task counts into a table of its own and gives it out in compressed chunks; Spark sums them. What reaches the driver and
is broadcast has the table's size, whatever the input. Cells of large inputs hold many rare shingles; a frequent one
stands out above what is usual. Operators take an order from it, which changes their cost and never lets a result go.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwise.llm.common import lean

#: Cells: 16 MB in a task, 8 MB broadcast.
BITS = 22
_CHUNK = 1 << 16
_SCALE = 64  # counts are broadcast as _SCALE * log2(1 + count)


def empty() -> np.ndarray:
    return np.zeros(1 << BITS, dtype=np.uint32)


def cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def add(counts: np.ndarray, hashes: np.ndarray) -> None:
    np.add.at(counts, cells(hashes), 1)


def pieces(counts: np.ndarray) -> tuple[list[int], list[int], list[bytes]]:
    """Kinds (1: the counts' low bytes, 2: what is above them), chunk numbers and compressed chunks that are not all 0."""
    out: tuple[list[int], list[int], list[bytes]] = ([], [], [])
    for kind, part in ((1, (counts & 255).astype(np.uint8)), (2, counts >> 8)):
        for number, chunk in enumerate(part.reshape(-1, _CHUNK)):
            if chunk.any():
                for column, value in zip(out, (kind, number, zlib.compress(chunk.tobytes(), 1)), strict=True):
                    column.append(value)
    return out


def gathered(parts: DataFrame) -> np.ndarray:
    """The sum of all tasks' pieces (kind, chunk, counts), as _SCALE * log2(1 + count)."""
    schema = pa.schema([("chunk", pa.int64()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for kind, chunk, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = np.frombuffer(zlib.decompress(data), dtype=np.uint8 if kind == 1 else np.uint32).astype(np.int64)
                total = sums.setdefault(chunk, np.zeros(len(part), dtype=np.int64))
                total += part << 8 * (kind - 1)
        logs = [np.rint(_SCALE * np.log2(1 + v)).astype(np.uint16).tobytes() for v in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), type=pa.int64()), pa.array(logs, type=pa.binary())], schema=schema)

    out = np.zeros(1 << BITS, dtype=np.uint16)
    for chunk, data in parts.repartition("chunk").mapInArrow(lean(run), "chunk long, counts binary").collect():
        out[chunk * _CHUNK : (chunk + 1) * _CHUNK] = np.frombuffer(data, dtype=np.uint16)
    return out


def usual(logs: np.ndarray) -> float:
    """What the middle cell holds."""
    return 2.0 ** (float(np.median(logs)) / _SCALE) - 1


def above(logs: np.ndarray, least: float) -> np.ndarray:
    """Cells with at least so many more than is usual: all that hold a shingle of at least so many occurrences, and few others."""
    return 2.0 ** (logs / _SCALE) - 1 - usual(logs) >= least
