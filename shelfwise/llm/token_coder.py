"""Adaptive context-mixing range coder for token ids.

Ids are cut into blocks that are coded independently: each starts with empty models and carries its own checksum, so any
block can be read alone. A block's ids lie in lanes of up to `STEPS` consecutive ids. All lanes of a call advance in
lockstep, one id per step, as numpy arrays; the lanes of a block share its models, and no other block's.

Three predictions of the next id x are mixed:
    P(x) = w2 [x = p2] + w1 [x = p1] + w0 P0(x)
p2 and p1 are the ids that last followed the same two and the same one ids, each with a confidence. The weights are learned:
for each pair of confidences they follow how often order 2, order 1 or neither was right. P0 is order 0: the frequencies
of the ids so far, with an escape for ids that are new, whose share follows how many ids have been new. The frequencies are
counted anew whenever the ids have grown by a part. All arithmetic is on integers, so every machine codes alike.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Ids of a block and of a lane, at most.
BLOCK, STEPS = 1 << 20, 2048
MAX_ID = 65535
_MAGIC = b"TKR2"
_IDS = MAX_ID + 1
_PAIR_BITS = 18  # contexts of order 2
_MIX_BITS, _ID_BITS = 12, 20
_MIX, _ID = 1 << _MIX_BITS, 1 << _ID_BITS
_STATES = 32
_LOW32, _U32 = np.uint64((1 << 32) - 1), np.uint64(32)
_FULL = np.uint64((1 << 64) - 1)
#: Weights follow their counts each step at first, then each so many steps; counts are halved beyond the limit.
_EVERY, _LIMIT = 8, 1 << 16


def shape(n: int) -> tuple[int, int, int]:
    """Blocks, lanes of each and steps for n ids; all blocks have the same, and ids 0 fill the end up."""
    blocks = -(-n // BLOCK)
    lanes = -(-n // (blocks * STEPS))
    return blocks, lanes, -(-n // (blocks * lanes))


class _Model:
    """The models of all blocks. A context's entry is its predicted id times 4 plus a confidence, 0 while empty."""

    def __init__(self, blocks: int, lanes: int):
        self.blocks, self.lanes = blocks, lanes
        self.block = np.repeat(np.arange(blocks, dtype=np.int64), lanes)
        self.entries = [np.full(blocks << bits, _IDS << 2, dtype=np.int64) for bits in (_PAIR_BITS, 16)]
        self.base = [self.block << _PAIR_BITS, self.block << 16]
        self.state_base = self.block * _STATES
        self.wins = np.tile(np.array([1, 1, 2], dtype=np.int64), (blocks * _STATES, 1))
        self.counts = np.zeros((blocks, _IDS), dtype=np.int64)
        self.last, self.before = np.zeros(blocks * lanes, dtype=np.int64), np.zeros(blocks * lanes, dtype=np.int64)
        self.step, self.counted, self.next = 0, 0, 0
        self.begin, self.size = np.zeros(blocks << 16, dtype=np.int64), np.zeros(blocks << 16, dtype=np.int64)

    def predict(self, grid: np.ndarray) -> None:
        """Guesses of orders 2 and 1 and the parts of the code space that they have; `grid` holds the ids so far."""
        if self.step >= self.next:
            self._count(grid)
        if self.step < 64 or self.step % _EVERY == 0:
            self.wins[self.wins.sum(axis=1) > _LIMIT] >>= 1
            share = self.wins * (_MIX - 3) // np.maximum(self.wins.sum(axis=1, keepdims=True), 1) + 1
            self.share2, self.share1 = share[:, 0].copy(), share[:, 1].copy()
        self.slots = (self.base[0] + ((self.last * 40503 + self.before * 179424673 >> 7) & ((1 << _PAIR_BITS) - 1)), self.base[1] + self.last)
        self.found = (self.entries[0].take(self.slots[0]), self.entries[1].take(self.slots[1]))
        self.guess = (self.found[0] >> 2, self.found[1] >> 2)
        self.state = self.state_base + (self.guess[0] == self.guess[1]) * 16 + (self.found[0] & 3) * 4 + (self.found[1] & 3)
        self.part2, self.part1 = self.share2.take(self.state), self.share1.take(self.state)
        self.head = self.part2 + self.part1

    def _count(self, grid: np.ndarray) -> None:
        """Order 0 anew, from all ids before this step; a new time is set when they have grown by an eighth."""
        for k in range(self.blocks):
            fresh = grid[self.counted : self.step, k * self.lanes : (k + 1) * self.lanes]
            if fresh.size:
                self.counts[k] += np.bincount(fresh.ravel(), minlength=_IDS)
        self.counted = self.step
        self.next = self.step + max(1, self.step // 8)
        ids, limits = [], []
        for k in range(self.blocks):
            known = np.flatnonzero(self.counts[k])
            c = self.counts[k][known]
            n, d = int(c.sum()), len(known)
            escape = max(_ID // 4096, _ID * d // (n + d)) if n else _ID
            size = 1 + c * (_ID - escape - d) // max(n, 1)
            end = np.cumsum(size)
            at = slice(k << 16, (k + 1) << 16)
            self.begin[at], self.size[at] = 0, 0
            self.begin[(k << 16) + known], self.size[(k << 16) + known] = end - size, size
            top = int(end[-1]) if d else 0
            # for decoding: ids and where they begin, with the escape as a last one
            ids.append(np.append(known, -1))
            limits.append((k << _ID_BITS) + np.append(end - size, top))
        self.ids, self.limits = np.concatenate(ids), np.concatenate(limits)
        self.tops = np.array([int(x[-1]) & (_ID - 1) for x in limits], dtype=np.int64)

    def update(self, ids: np.ndarray, kind: np.ndarray) -> None:
        fresh = (ids << 2) + 1
        for k in (0, 1):
            entry = self.found[k]
            conf = entry & 3
            self.entries[k][self.slots[k]] = np.where(self.guess[k] == ids, entry + (conf < 3), np.where(conf > 1, entry - 1, fresh))
        self.wins += np.bincount(self.state * 3 + kind, minlength=self.wins.size).reshape(-1, 3) * 2
        self.before, self.last = self.last, ids
        self.step += 1


def encode(ids: np.ndarray) -> bytes:
    """All ids (0 to 65535) as one string of independent blocks."""
    n = len(ids)
    if not n:
        return _MAGIC + struct.pack("<Q", 0)
    if int(ids.max()) > MAX_ID or int(ids.min()) < 0:
        raise ValueError("ids must lie between 0 and 65535")
    blocks, lanes, steps = shape(n)
    every = blocks * lanes
    grid = np.zeros(every * steps, dtype=np.int32)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(every, steps).T)
    model = _Model(blocks, lanes)
    low, span = np.zeros(every, dtype=np.uint64), np.full(every, _FULL, dtype=np.uint64)
    width = steps + 8
    out, used, at = np.zeros(every * width, dtype="<u4"), np.zeros(every, dtype=np.int64), np.arange(every) * width
    new: list[tuple[np.ndarray, np.ndarray]] = []
    for t in range(steps):
        x = grid[t].astype(np.int64)
        model.predict(grid)
        second = x == model.guess[0]
        kind = np.where(second, 0, 2 - (x == model.guess[1]))
        part = span >> np.uint64(_MIX_BITS)
        low = low + part * np.where(second, 0, np.where(kind == 1, model.part2, model.head)).astype(np.uint64)
        span = part * np.where(second, model.part2, np.where(kind == 1, model.part1, _MIX - model.head)).astype(np.uint64)
        if len(miss := np.flatnonzero(kind == 2)):
            cell = model.base[1][miss] + x[miss]
            begin, size = model.begin[cell], model.size[cell]
            if len(fresh := np.flatnonzero(size == 0)):
                top = model.tops[model.block[miss[fresh]]]
                begin[fresh], size[fresh] = top, _ID - top
                new.append((model.block[miss[fresh]], x[miss[fresh]]))
            part = span[miss] >> np.uint64(_ID_BITS)
            low[miss] += part * begin.astype(np.uint64)
            span[miss] = part * size.astype(np.uint64)
        if len(short := np.flatnonzero(span <= _LOW32)):
            a, s = low[short], span[short]
            s = np.where((a ^ (a + s - np.uint64(1))) >> _U32 != 0, (~a + np.uint64(1)) & _LOW32, s)
            out[at[short] + used[short]] = a >> _U32
            used[short] += 1
            low[short], span[short] = a << _U32, s << _U32
        model.update(x, kind)
    for shift in (32, 0):
        out[at + used] = (low >> np.uint64(shift)) & _LOW32
        used += 1
    which, values = (np.concatenate(v) for v in zip(*new, strict=True))
    heads, bodies = [], []
    for k in range(blocks):
        mine = range(k * lanes, (k + 1) * lanes)
        raw = values[which == k].astype("<u2")
        body = used[k * lanes : (k + 1) * lanes].astype("<u4").tobytes() + b"".join(out[at[j] : at[j] + used[j]].tobytes() for j in mine) + raw.tobytes()
        heads.append(struct.pack("<QII", len(body), len(raw), zlib.crc32(body)))
        bodies.append(body)
    return _MAGIC + struct.pack("<Q", n) + b"".join(heads) + b"".join(bodies)


def decode(data: bytes) -> np.ndarray:
    """The ids; a damaged block is an error."""
    if data[:4] != _MAGIC:
        raise ValueError("not a token segment")
    n = struct.unpack_from("<Q", data, 4)[0]
    if not n:
        return np.zeros(0, dtype=np.int32)
    blocks, lanes, steps = shape(n)
    every, at = blocks * lanes, 12 + 16 * blocks
    bodies, raws = [], []
    for k in range(blocks):
        length, n_raw, crc = struct.unpack_from("<QII", data, 12 + 16 * k)
        body = data[at : at + length]
        if len(body) != length or zlib.crc32(body) != crc:
            raise ValueError(f"block {k}: wrong checksum")
        bodies.append(body)
        raws.append(np.frombuffer(body, dtype="<u2", count=n_raw, offset=length - 2 * n_raw).astype(np.int64))
        at += length
    used = np.concatenate([np.frombuffer(b, dtype="<u4", count=lanes) for b in bodies]).astype(np.int64)
    words = np.concatenate([*(np.frombuffer(b, dtype="<u4", count=(len(b) - 2 * len(r)) // 4 - lanes, offset=4 * lanes) for b, r in zip(bodies, raws, strict=True)), np.zeros(2, dtype="<u4")]).astype(np.uint64)
    raw, raw_at = np.concatenate(raws), np.cumsum([0, *(len(r) for r in raws)])[:-1]
    model = _Model(blocks, lanes)
    place = np.cumsum(used) - used
    low, span = np.zeros(every, dtype=np.uint64), np.full(every, _FULL, dtype=np.uint64)
    code = words[place] << _U32 | words[place + 1]
    place = place + 2
    grid = np.zeros((steps, every), dtype=np.int32)
    for t in range(steps):
        model.predict(grid)
        part = span >> np.uint64(_MIX_BITS)
        value = np.minimum((code - low) // part, np.uint64(_MIX - 1)).astype(np.int64)
        kind = (value >= model.part2).astype(np.int64) + (value >= model.head)
        low = low + part * np.where(kind == 0, 0, np.where(kind == 1, model.part2, model.head)).astype(np.uint64)
        span = part * np.where(kind == 0, model.part2, np.where(kind == 1, model.part1, _MIX - model.head)).astype(np.uint64)
        x = np.where(kind == 0, model.guess[0], model.guess[1])
        if len(miss := np.flatnonzero(kind == 2)):
            block = model.block[miss]
            part = span[miss] >> np.uint64(_ID_BITS)
            value = np.minimum((code[miss] - low[miss]) // part, np.uint64(_ID - 1)).astype(np.int64)
            hit = np.searchsorted(model.limits, (block << _ID_BITS) + value, side="right") - 1
            ids = model.ids[hit]
            begin = model.limits[hit] & (_ID - 1)
            size = model.size[(block << 16) + np.maximum(ids, 0)]
            if len(fresh := np.flatnonzero(ids < 0)):
                size[fresh] = _ID - begin[fresh]
                own = block[fresh]  # in ascending order
                rank = np.arange(len(own)) - np.searchsorted(own, own)
                ids[fresh] = raw[raw_at[own] + rank]
                raw_at += np.bincount(own, minlength=blocks)
            low[miss] += part * begin.astype(np.uint64)
            span[miss] = part * size.astype(np.uint64)
            x[miss] = ids
        grid[t] = x
        if len(short := np.flatnonzero(span <= _LOW32)):
            a, s = low[short], span[short]
            s = np.where((a ^ (a + s - np.uint64(1))) >> _U32 != 0, (~a + np.uint64(1)) & _LOW32, s)
            code[short] = code[short] << _U32 | words[np.minimum(place[short], len(words) - 1)]
            place[short] += 1
            low[short], span[short] = a << _U32, s << _U32
        model.update(x, kind)
    return grid.T.ravel()[:n]
