"""Token-id files: documents' ids as independent rANS blocks, in ascending doc_id order.

``write_tokens`` encodes whole texts, ``read_tokens`` decodes the files again. A store is a folder
with two Parquet tables, written by Spark's own committer, so a lost executor's task is simply run
again and half-written files are never seen:

* ``table``: the shared frequency table, one row (``freq``, int32 little-endian, summing to 2**20),
  from the counts of all ids of all documents.
* ``blocks``: one row for each block of ``BLOCK_TOKENS`` ids or fewer. ``part``, ``block`` and ``skip``
  order the blocks; ``doc_ids`` and ``doc_tokens`` list the documents, of which the first may have begun
  ``skip`` ids before and the last may go on in the next block. ``steps``, ``words``, ``states`` and
  ``crc32`` are its checkpoints: the coded ids from each to the next, the states there, a checksum.

A document may lie in many blocks, however long it is. Reading decodes from checkpoint to checkpoint, each
a row that Spark deals to a task.

Documents are range-sorted by doc_id once; ids are made once and kept, in order, until the table of
counts is known. A null text counts as empty and gets the end id alone. Rows that repeat a doc_id
are all kept and stand together, in the order of their texts; rows without a doc_id come first.
An empty table gives an empty store. Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimload.llm import rans
from dimload.llm.textbatch import slices
from dimload.llm.tokens import TOKEN_SLICE, ids_crc32, tokenizer_at, with_end
from dimload.session import scratch_path

BLOCK_TOKENS = 1 << 19
_BLOCK = "part int, block long, skip long, n long, lanes int, doc_ids array<long>, doc_tokens array<long>, steps array<long>, words array<binary>, states array<binary>, crc32 array<long>"
_PIECE = "part int, seq long, doc_id long, first long, place long, n_tokens long, ids binary"


def binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary value for each range of a contiguous array."""
    width = values.dtype.itemsize
    return pa.Array.from_buffers(
        pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * width).astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(values))]
    )


def _encoded(tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in slices(batches, limit=TOKEN_SLICE):
            ids, bounds = with_end(*tokenizer_at(tokenizer).encode(batch.column("text")), end_id)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(seq, seq + n)), batch.column("doc_id"), binaries(ids, bounds)],
                names=["part", "seq", "doc_id", "ids"],
            )
            seq += n

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << 16, dtype=np.int64)
    for batch in batches:
        ids = b"".join(batch.column("ids").to_pylist())
        counts += np.bincount(np.frombuffer(ids, "<u2"), minlength=1 << 16)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(counts[seen])], names=["id", "n"])


def _blocked(freq: bytes, block_tokens: int):
    """Runs of ids cut into blocks of ``block_tokens``, also inside documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Table(np.frombuffer(freq, "<i4"))
        held: list[tuple] = []  # (place in the part, doc_id, ids, the document's ids before them)
        size, part = 0, None

        def flush() -> pa.RecordBatch:
            row = rans.packed(rans.encode(np.concatenate([x[2] for x in held]), table))
            row |= {"part": part, "block": held[0][0], "skip": held[0][3], "doc_ids": [x[1] for x in held], "doc_tokens": [len(x[2]) for x in held]}
            return pa.RecordBatch.from_pylist([row], schema=_BLOCK_ARROW)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("part", "seq", "doc_id", "ids")]
            for p, seq, doc, raw in zip(*columns, strict=True):
                if held and (p != part or seq != held[-1][0] + 1):
                    yield flush()
                    held, size = [], 0
                ids, start, part = np.frombuffer(raw, "<u2"), 0, p
                while start < len(ids):
                    if size == block_tokens:
                        yield flush()
                        held, size = [], 0
                    some = ids[start : start + block_tokens - size]
                    held.append((seq, doc, some, start))
                    start, size = start + len(some), size + len(some)
        if held:
            yield flush()

    return run


_BLOCK_ARROW = pa.schema(
    [("part", pa.int32()), ("block", pa.int64()), ("skip", pa.int64()), ("n", pa.int64()), ("lanes", pa.int32())]
    + [("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("steps", pa.list_(pa.int64()))]
    + [("words", pa.list_(pa.binary())), ("states", pa.list_(pa.binary())), ("crc32", pa.list_(pa.int64()))]
)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, block_tokens: int = BLOCK_TOKENS) -> None:
    """Write the ids of all ``docs`` (doc_id, text) to the store ``path``."""
    spark = docs.sparkSession
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = ordered.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    ids_path = scratch_path(spark, "token-ids")
    ordered.mapInArrow(_encoded(tokenizer, end_id), "part int, seq long, doc_id long, ids binary").write.option("compression", "zstd").parquet(ids_path)
    ids = spark.read.parquet(ids_path)
    counted = ids.select("ids").mapInArrow(_counted, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(1 << 16, dtype=np.int64)
    for row in counted.collect():  # one row an id of the vocabulary: 65,536 at most
        counts[row["id"]] = row["n"]
    freq = rans.frequencies(counts).astype("<i4").tobytes()
    spark.createDataFrame([(bytearray(freq),)], "freq binary").coalesce(1).write.parquet(f"{path}/table")
    ids.mapInArrow(_blocked(freq, block_tokens), _BLOCK).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def _decoded(freq: bytes):
    """The documents' pieces between two checkpoints: ``seq`` is a document's place in its part, ``first`` the
    ids of the store before the piece, ``place`` those of its document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Table(np.frombuffer(freq, "<i4"))
        for batch in batches:
            for row in batch.to_pylist():
                ids = rans.decode_stored(row["n"], row["lanes"], row["step"], row["words"], row["states"], row["crc32"], table)
                lo = row["step"] * row["lanes"]
                bounds = np.concatenate([[0], np.cumsum(np.asarray(row["doc_tokens"], np.int64))])
                docs = np.arange(np.searchsorted(bounds, lo, "right") - 1, np.searchsorted(bounds, lo + len(ids)))
                cuts = np.concatenate([[lo], bounds[docs[1:]], [lo + len(ids)]])
                place = cuts[:-1] - bounds[docs] + np.where(docs == 0, row["skip"], 0)
                columns = [np.full(len(docs), row["part"], np.int32), row["block"] + docs, None, row["base"] + cuts[:-1], place, np.diff(cuts)]
                arrays = [pa.array([row["doc_ids"][d] for d in docs], pa.int64()) if c is None else pa.array(c) for c in columns]
                yield pa.RecordBatch.from_arrays([*arrays, binaries(ids, cuts - lo)], names=["part", "seq", "doc_id", "first", "place", "n_tokens", "ids"])

    return run


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crc = [ids_crc32(np.frombuffer(x, "<u2")) for x in batch.column("ids").to_pylist()]
        at = batch.schema.get_field_index("ids")
        yield batch.set_column(at, "ids", pa.array(crc, pa.int64()))


def _joined(crcs, sizes) -> int:
    """The crc32 of pieces strung together, of theirs and their numbers of ids."""
    out = int(crcs[0])
    for crc, n in zip(crcs[1:], sizes[1:], strict=True):
        out = rans.crc32_joined(out, int(crc), 4 * int(n))
    return out


def _joined_crc(crcs: str, sizes: str) -> Column:
    @F.arrow_udf("long")
    def joined(c: pa.Array, n: pa.Array) -> pa.Array:
        return pa.array([_joined(x, y) for x, y in zip(c.to_pylist(), n.to_pylist(), strict=True)], pa.int64())

    return joined(crcs, sizes)


def block_starts(blocks: DataFrame) -> DataFrame:
    """``base``: the ids of all blocks before each block, from sums by part and then within parts."""
    narrow = blocks.select("part", "block", "skip", "n")
    parts = narrow.groupBy("part").agg(F.sum("n").alias("total"))  # a row for each written file
    parts = parts.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("part").orderBy("block", "skip")) - F.col("n")
    return narrow.withColumn("inside", inside).join(parts, "part").select("part", "block", "skip", (F.col("before") + F.col("inside")).alias("base"))


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    """What lies between two checkpoints of a store, decoded piece by piece: part, seq, doc_id, first, place,
    n_tokens and ids of each document's share."""
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    freq = bytes(spark.read.parquet(f"{path}/table").head()["freq"])  # 65,536 numbers
    marks = F.arrays_zip(F.col("steps").alias("step"), "words", "states", "crc32")
    whole = blocks.join(block_starts(blocks), ["part", "block", "skip"])
    return whole.select("part", "block", "skip", "base", "n", "lanes", "doc_ids", "doc_tokens", F.inline(marks)).mapInArrow(_decoded(freq), _PIECE)


def read_tokens(spark: SparkSession, path: str, digests: bool = False) -> DataFrame:
    """The documents of a store: doc_id, start (ids of all documents before), n_tokens and ids
    (16-bit little-endian), or ids_crc32 in place of ids with ``digests``.

    Only documents that lie in several pieces are put together again; their digests are joined from those
    of their pieces, so that no task holds more than a piece."""
    pieces = read_pieces(spark, path)
    if digests:
        pieces = pieces.mapInArrow(_digested, _PIECE.replace("ids binary", "ids long"))
    piece = F.struct("place", "first", "n_tokens", "ids")
    whole = pieces.groupBy("part", "seq", "doc_id").agg(F.sort_array(F.collect_list(piece)).alias("p"))
    last = _joined_crc("p.ids", "p.n_tokens").alias("ids_crc32") if digests else F.array_join(F.transform("p.ids", F.hex), "")
    last = last if digests else F.unhex(last).alias("ids")
    size = F.aggregate("p", F.lit(0).cast("long"), lambda n, x: n + x["n_tokens"])
    return whole.select("doc_id", F.col("p")[0]["first"].alias("start"), size.alias("n_tokens"), last)
