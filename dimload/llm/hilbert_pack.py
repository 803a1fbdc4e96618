"""Packing documents into training sequences along a Hilbert curve.

Each document's ids are hashed to a signed vector and projected to four dimensions; the corpus mean,
which Spark takes over all ids, is subtracted, and what is left is scaled to length one, so that the
key depends on content alike at every length and no document lies beyond the grid. The grid cell's
place on the Hilbert curve is its key. Documents are range-sorted by that key
(ties by doc_id), so neighbours on the curve share a partition, and each partition strings its
documents together and cuts the stream into sequences of ``size`` ids. The stream's last, shorter
sequence is cut into sequences whose lengths are powers of two, which need no padding.

``pack`` returns one row for each piece of a document: doc_id, start (the document's ids before
it), length, tokens (the piece's ids, 16-bit little-endian), ids_crc32, doc_tokens, sequence_id,
offset (place in the sequence), and hilbert_key. Documents are cut freely, none is dropped. A null
text counts as empty and yields its end id alone; repeated rows are packed as often as they occur;
very long texts are cut over as many sequences as they need, by one task; ties on the curve go by
doc_id; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimload.llm.textbatch import mix, slices
from dimload.llm.token_store import binaries
from dimload.llm.tokens import TOKEN_SLICE, ids_crc32, tokenizer_at, with_end
from dimload.session import bound_batches, scratch_path

DIMS, GRID_BITS, HASHED = 4, 12, 64
_SUMS = [f"x{k}" for k in range(DIMS)]
_SUMMED = "doc_id long, doc_tokens long, ids binary, " + ", ".join(f"{c} double" for c in _SUMS)
_PIECE = "doc_id long, start long, length long, tokens binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long, hilbert_key long"


@cache
def _projection(vocabulary: int = 1 << 16) -> np.ndarray:
    """For each id its hashed, signed coordinate projected to ``DIMS`` dimensions."""
    h = mix(np.arange(1, vocabulary + 1, dtype=np.uint64))
    sign = np.where(h >> np.uint64(63) == 1, 1.0, -1.0)
    rows = np.random.default_rng(7).normal(size=(HASHED, DIMS))
    return (rows[(h % np.uint64(HASHED)).astype(np.int64)] * sign[:, None]).astype(np.float32)


def hilbert_keys(cells: np.ndarray, bits: int = GRID_BITS) -> np.ndarray:
    """Places on the Hilbert curve of grid cells (n, dims), by exchanging and inverting axes from
    the highest bit down (Skilling, 2004) and interleaving the bits of the Gray-decoded axes."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        q = 1 << b
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = np.where(high, x[0] ^ (q - 1), x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[dims - 1] & (1 << b)) != 0, (1 << b) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def vector_sums(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of documents' projected id vectors (each document owns one id at least)."""
    return np.add.reduceat(_projection()[ids], bounds[:-1], axis=0, dtype=np.float64)


def cells(sums: np.ndarray, sizes: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Grid cells of the directions in which documents' mean vectors lie from the corpus mean."""
    away = sums / np.maximum(sizes, 1)[:, None] - mean
    size = np.sqrt((away**2).sum(axis=1))
    unit = away / np.where(size > 1e-12, size, 1.0)[:, None]
    return np.minimum((unit + 1.0) * (1 << (GRID_BITS - 1)), (1 << GRID_BITS) - 1).astype(np.int64)


def _key_column(mean: np.ndarray):
    @F.arrow_udf("long")
    def key(n: pa.Array, x0: pa.Array, x1: pa.Array, x2: pa.Array, x3: pa.Array) -> pa.Array:
        sums, sizes = (np.column_stack([c.to_numpy(zero_copy_only=False) for c in some]) for some in ((x0, x1, x2, x3), (n,)))
        return pa.array(hilbert_keys(cells(sums, sizes[:, 0], mean)))

    return key("doc_tokens", *_SUMS)


def _summed(tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=TOKEN_SLICE):
            ids, bounds = with_end(*tokenizer_at(tokenizer).encode(batch.column("text")), end_id)
            sums = vector_sums(ids, bounds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(bounds)), binaries(ids, bounds), *(pa.array(x) for x in sums.T)],
                names=["doc_id", "doc_tokens", "ids", *_SUMS],
            )

    return run


def powers_of_two(n: int) -> list[int]:
    """Powers of two that sum to ``n``, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def _packed(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        number, filled = 0, 0
        open_pieces: list[list] = []  # of the sequence being filled
        done: list[list] = []

        def close(pieces: list[list], lengths: list[int]) -> None:
            """Cut consecutive pieces into sequences of the given lengths."""
            nonlocal number
            left, offset, lengths = 0, 0, iter(lengths)
            for doc_id, start, ids, doc_tokens, key in pieces:
                while len(ids):
                    if not left:
                        left, offset = next(lengths), 0
                        number += 1
                    take = ids[:left]
                    done.append([doc_id, start, len(take), take.tobytes(), ids_crc32(take), doc_tokens, (part << 40) + number - 1, offset, key])
                    start, offset, left, ids = start + len(take), offset + len(take), left - len(take), ids[len(take) :]

        def out() -> pa.RecordBatch:
            rows = list(zip(*done, strict=True))
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(rows, _PIECE_ARROW, strict=True)], schema=_PIECE_ARROW)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "ids", "doc_tokens", "hilbert_key")]
            for doc_id, raw, doc_tokens, key in zip(*columns, strict=True):
                ids, start = np.frombuffer(raw, "<u2"), 0
                while len(ids) - start >= size - filled:
                    take = ids[start : start + size - filled]
                    open_pieces.append([doc_id, start, take, doc_tokens, key])
                    close(open_pieces, [size])
                    start, filled, open_pieces = start + len(take), 0, []
                if start < len(ids):
                    open_pieces.append([doc_id, start, ids[start:], doc_tokens, key])
                    filled += len(ids) - start
                if len(done) >= 2000:
                    yield out()
        close(open_pieces, powers_of_two(filled))
        if done:
            yield out()

    return run


_PIECE_ARROW = pa.schema(
    [(c, pa.binary() if c == "tokens" else pa.int64()) for c in "doc_id start length tokens ids_crc32 doc_tokens sequence_id offset hilbert_key".split()]
)


def pack(docs: DataFrame, tokenizer: str, size: int = 4096, end_id: int = 2) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text), packed along the curve; see the module's text."""
    spark = docs.sparkSession
    bound_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    path = scratch_path(spark, "hilbert-ids")
    texts.mapInArrow(_summed(tokenizer, end_id), _SUMMED).write.option("compression", "zstd").parquet(path)
    summed = spark.read.schema(_SUMMED).parquet(path)
    total = summed.agg(F.sum("doc_tokens"), *(F.sum(c) for c in _SUMS)).head()
    mean = np.round(np.array([x or 0.0 for x in total[1:]]) / max(total[0] or 0, 1), 9)
    keyed = summed.withColumn("hilbert_key", _key_column(mean)).drop(*_SUMS)
    along = keyed.repartitionByRange("hilbert_key", "doc_id").sortWithinPartitions("hilbert_key", "doc_id")
    return along.mapInArrow(_packed(size), _PIECE)
