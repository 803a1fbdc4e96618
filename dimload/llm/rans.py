"""Static range asymmetric numeral coding of 16-bit ids with interleaved lanes (numpy).

One frequency table is shared by all blocks. A block's ids are dealt to ``lanes`` coders in turn
(id ``i`` goes to lane ``i % lanes``), so one numpy step codes ``lanes`` ids. Each block is independent;
its checkpoints hold the states and the place in the words at some steps, so that what lies between two
checkpoints is decoded by itself, with a checksum of its own.
"""

from __future__ import annotations

import zlib

import numpy as np

BITS = 20  # frequencies sum to 2**BITS
LOW = 1 << 21
WORD = 32
LANES = 2048
CHECKPOINT_STEPS = 128


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to sum to ``2**BITS``; an id that occurs keeps one at least, others get none."""
    counts = np.asarray(counts, dtype=np.float64)
    total, size = counts.sum(), 1 << BITS
    out = np.where(counts > 0, np.maximum(1, np.floor(counts * (size / max(total, 1)))), 0).astype(np.int64)
    order = np.argsort(-out, kind="stable")
    rest = size - int(out.sum())
    if total == 0:
        out[0] = size
        return out
    if rest > 0:
        out[order[0]] += rest
    for i in order:  # too much was given to rare ids: the most frequent ones pay
        if rest >= 0:
            break
        take = min(-rest, int(out[i]) // 2)
        out[i] -= take
        rest += take
    return out


class Table:
    """Frequencies, their running sums and the id of every slot."""

    def __init__(self, freq: np.ndarray):
        self.freq = np.asarray(freq, dtype=np.int64)
        self.below = np.cumsum(self.freq) - self.freq
        self.slot = np.repeat(np.arange(len(self.freq), dtype=np.uint16), self.freq)


def lanes_for(n: int) -> int:
    """Fewer lanes for short blocks, so that their final states weigh little."""
    lanes = 1
    while lanes < LANES and lanes * 64 <= n:
        lanes *= 2
    return lanes


def encode(ids: np.ndarray, table: Table, lanes: int | None = None) -> dict:
    """One block: ``words`` (uint32), ``checkpoints`` [(step, word, states)], the first at step 0."""
    n = len(ids)
    lanes = lanes or lanes_for(n)
    steps = -(-n // lanes)
    states = np.full(lanes, LOW, dtype=np.int64)
    chunks: list[np.ndarray] = [np.empty(0, np.uint32)] * steps
    marks = []
    freq, below = table.freq[ids], table.below[ids]
    limit, spare = freq << (LOW.bit_length() - 1 - BITS + WORD), (1 << BITS) - freq
    for step in range(steps - 1, -1, -1):
        part = slice(step * lanes, min((step + 1) * lanes, n))
        x = states[: part.stop - part.start]
        full = np.flatnonzero(x >= limit[part])
        if len(full):
            high = x[full]
            chunks[step] = high.astype(np.uint32)  # the low word
            x[full] = high >> WORD
        q = (x / freq[part]).astype(np.int64)
        q *= spare[part]  # x // f * size + x % f = x + x // f * (size - f)
        x += q
        x += below[part]
        if step % CHECKPOINT_STEPS == 0:
            marks.append((step, states.copy()))
    sizes = np.fromiter(map(len, chunks), np.int64, steps)
    before = np.concatenate([[0], np.cumsum(sizes)])
    words = np.concatenate(chunks) if steps else np.empty(0, np.uint32)
    return {"n": n, "lanes": lanes, "words": words, "checkpoints": [(s, int(before[s]), x) for s, x in reversed(marks)]}


def decode(block: dict, table: Table, checkpoint: int = 0, steps: int | None = None) -> np.ndarray:
    """The ids from a checkpoint on: of ``steps`` steps, or to the block's end."""
    n, lanes, words = block["n"], block["lanes"], block["words"]
    if not n:
        return np.empty(0, np.uint16)
    step, at, states = block["checkpoints"][checkpoint]
    last = -(-n // lanes) if steps is None else min(step + steps, -(-n // lanes))
    out = np.empty(min(n, last * lanes) - step * lanes, dtype=np.uint16)
    x_all, mask, base = states.copy(), (1 << BITS) - 1, step * lanes
    for s in range(step, last):
        size = min(lanes, n - s * lanes)
        x = x_all[:size]
        slot = x & mask
        got = table.slot.take(slot)
        out[s * lanes - base : s * lanes - base + size] = got
        x >>= BITS
        x *= table.freq.take(got)
        x += slot
        x -= table.below.take(got)
        low = np.flatnonzero(x < LOW)
        if len(low):
            x[low] = (x[low] << WORD) | words[at : at + len(low)]
            at += len(low)
    return out


def packed(block: dict) -> dict:
    """The block's columns as stored; ``crc32`` covers each checkpoint and the words up to the next."""
    marks = block["checkpoints"]
    ends = [p for _, p, _ in marks[1:]] + [len(block["words"])]
    states = [x.astype("<i8").tobytes() for _, _, x in marks]
    words = [block["words"][p:e].astype("<u4").tobytes() for (_, p, _), e in zip(marks, ends, strict=True)]
    crc = [checksum(block["n"], block["lanes"], m[0], w, x) for m, w, x in zip(marks, words, states, strict=True)]
    return {"n": block["n"], "lanes": block["lanes"], "steps": [m[0] for m in marks], "words": words, "states": states, "crc32": crc}


def checksum(n: int, lanes: int, step: int, words: bytes, states: bytes) -> int:
    return zlib.crc32(repr((n, lanes, step)).encode(), zlib.crc32(states, zlib.crc32(words)))


def decode_stored(n: int, lanes: int, step: int, words: bytes, states: bytes, crc32: int, table: Table) -> np.ndarray:
    """The ids from a stored checkpoint up to the next one; a ValueError if it is damaged."""
    if checksum(n, lanes, step, words, states) != crc32:
        raise ValueError("a block's checksum does not match its bytes")
    block = {"n": n, "lanes": lanes, "words": np.frombuffer(words, "<u4"), "checkpoints": [(step, 0, np.frombuffer(states, "<i8").astype(np.int64))]}
    return decode(block, table, 0, CHECKPOINT_STEPS)


def crc32_joined(first: int, second: int, size: int) -> int:
    """The crc32 of two byte strings strung together, of theirs and the second one's size: appending a zero
    bit is a linear map, whose powers of two carry ``first`` over ``size`` bytes."""
    if not size:
        return first
    step = [0xEDB88320, *(1 << k for k in range(31))]  # one zero bit

    def times(m: list[int], x: int) -> int:
        out, k = 0, 0
        while x:
            if x & 1:
                out ^= m[k]
            x, k = x >> 1, k + 1
        return out

    for _ in range(3):
        step = [times(step, c) for c in step]  # eight bits at last
    while size:
        if size & 1:
            first = times(step, first)
        size >>= 1
        if size:
            step = [times(step, c) for c in step]
    return first ^ second
