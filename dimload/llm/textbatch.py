"""Arrow helpers for operators that read whole texts inside tasks.

Texts come in Arrow record batches. They are re-cut into slices of bounded bytes, split into words
and dictionary-encoded with Arrow kernels, so that Python work is done once per distinct word of a
slice and numpy does the rest. A null text counts as empty everywhere.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

#: Word separators of `[^\x20\x09-\x0D]+`; every other byte belongs to a word.
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
#: Separators of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` (after lower-casing A-Z).
NON_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def byte_table(separators: bytes = b"", lower: bool = False) -> bytes:
    """A 256-byte translation: A-Z lower-cased if asked for, separators turned into blanks."""
    table = bytearray(range(256))
    if lower:
        for b in range(ord("A"), ord("Z") + 1):
            table[b] = b + 32
    for b in separators:
        if not (lower and ord("A") <= b <= ord("Z")):
            table[b] = 0x20
    return bytes(table)


def as_string(column: pa.Array) -> pa.Array:
    """Nulls as empty strings, one contiguous int32-offset string array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.string()), "")
    return pa.concat_arrays([column]) if column.offset == 0 else pa.concat_arrays([column, column.slice(0, 0)])


def release_memory() -> None:
    """Give freed memory back to the system: workers serve many tasks and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in order, in batches of at most ``limit`` text bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        block = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
        cuts = np.flatnonzero(np.diff(block)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(int(lo), int(hi - lo))
    release_memory()


def buffers(text: pa.Array) -> tuple[np.ndarray, bytes]:
    """Offsets (from 0) and UTF-8 bytes of a contiguous string array."""
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int32)[text.offset : text.offset + len(text) + 1]
    data = text.buffers()[2]
    raw = memoryview(data)[int(offsets[0]) : int(offsets[-1])].tobytes() if data is not None and len(text) else b""
    return (offsets - offsets[0]).astype(np.int64), raw


def rebuilt(offsets: np.ndarray, raw: bytes) -> pa.Array:
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(raw))


def fresh_name(columns: list[str], name: str) -> str:
    """``name``, with underscores added until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


class Words:
    """The words of a slice: ``codes`` into ``vocabulary`` in text order; document ``i`` owns
    ``codes[bounds[i]:bounds[i + 1]]``. Documents without a word own an empty range."""

    def __init__(self, column: pa.Array, table: bytes | None = None):
        text = as_string(column)
        offsets, raw = buffers(text)
        if table is not None:
            text = rebuilt(offsets, raw.translate(table))
        parts = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(text))
        flat = parts.flatten()
        counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        encoded = flat.dictionary_encode()
        codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        vocabulary = encoded.dictionary
        blank = pc.index(vocabulary, "").as_py() if len(vocabulary) else -1
        if blank >= 0:  # a text without a word splits into one empty string
            owner = np.repeat(np.arange(len(counts)), counts)
            keep = codes != blank
            counts = np.bincount(owner[keep], minlength=len(counts)).astype(np.int64)
            codes = codes[keep]
        self.codes = codes
        self.vocabulary = vocabulary
        self.counts = counts
        self.bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)

    def owners(self) -> np.ndarray:
        """For each word, the row of its document."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (uint64 in and out): each input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(vocabulary: pa.Array) -> np.ndarray:
    """A 64-bit hash of each distinct word's bytes, alike on every machine."""
    import xxhash

    h = xxhash.xxh3_64_intdigest
    offsets, raw = buffers(as_string(vocabulary))
    ends = offsets.tolist()
    return np.fromiter((h(raw[a:b]) for a, b in zip(ends, ends[1:], strict=False)), dtype=np.uint64, count=len(ends) - 1)


def window_hashes(words: Words, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width``-word windows inside documents, with their documents' rows."""
    owner = words.owners()
    if len(owner) < width:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    w = hashes[words.codes]
    n = len(w) - width + 1
    acc = np.full(n, np.uint64(width), dtype=np.uint64)
    for k in range(width):
        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + w[k : k + n])
    inside = owner[:n] == owner[width - 1 :]
    return acc[inside], owner[:n][inside]
