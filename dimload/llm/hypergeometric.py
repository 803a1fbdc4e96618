"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Row counts of the input's partitions and the exact sizes of the targets fix the margins of a
matrix: how many rows each partition sends to each target. A uniform shuffle makes its rows
multivariate hypergeometric. The matrix is never held: the range of partitions is halved again and
again, each half's share of every target is drawn with a seed of its own, and a task walks only the
path to its own partition. Partitions deal their rows to targets in a random order (permute
locally), rows move to their targets (exchange), and each target orders its rows at random (permute
again). A target is a run of slots of one shard, of about ``TARGET_BYTES`` of text or ``TARGET_ROWS``
rows, and goes to a task of its own, so no task ever holds a shard.

``shuffle_into_shards`` returns all columns of its input with ``shard`` and ``slot`` (replaced if
the input has such columns). Shard counts are at most one apart and slots are gapless from 0. Null
texts, ties and repeated rows are rows like any other; an empty table gives no rows. Equal input
files and settings give the same result; a lost task draws the same numbers again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimload.llm.textbatch import fresh_name
from dimload.session import scratch_path

NUMPY_LIMIT = 500_000_000  # numpy draws hypergeometric numbers up to twice this population
TARGET_BYTES, TARGET_ROWS = 32 << 20, 50_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` rows without replacement come from ``good``; exact for any size.

    Beyond numpy's range, each row is first taken with probability draws / population; the taken
    set, given its size, is uniform. Its surplus (or lack), about the root of the population, is
    then given back (or taken) row by row.
    """
    if good + bad <= NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, draws))
    share = draws / (good + bad)
    a, b = int(rng.binomial(good, share)), int(rng.binomial(bad, share))
    surplus = a + b - draws
    if surplus > 0:
        return a - int((rng.choice(a + b, surplus, replace=False, shuffle=False) < a).sum())
    if surplus < 0:
        pool = good - a
        return a + int((rng.choice(pool + bad - b, -surplus, replace=False, shuffle=False) < pool).sum())
    return a


def split(rng: np.random.Generator, targets: np.ndarray, draws: int) -> np.ndarray:
    """Of each target's open slots, how many fall to the ``draws`` rows of one half."""
    ends = np.cumsum(targets)
    out = np.zeros_like(targets)
    todo = [(0, len(targets), draws)] if len(targets) else []  # runs of targets, halved until numpy can draw a run at once
    while todo:
        lo, hi, draws = todo.pop()
        before = int(ends[lo - 1]) if lo else 0
        total = int(ends[hi - 1]) - before
        if draws in (0, total):
            out[lo:hi] = targets[lo:hi] if draws else 0
        elif total <= NUMPY_LIMIT:
            out[lo:hi] = rng.multivariate_hypergeometric(targets[lo:hi], draws, method="marginals")
        elif hi - lo == 1:
            out[lo] = draws
        else:
            mid = int(np.clip(np.searchsorted(ends, before + total // 2), lo + 1, hi - 1))
            good = int(ends[mid - 1]) - before
            left = hypergeometric(rng, good, total - good, draws)
            todo += [(lo, mid, left), (mid, hi, draws - left)]
    return out


def matrix_row(counts: np.ndarray, targets: np.ndarray, partition: int, seed: int) -> np.ndarray:
    """The row of ``partition``: drawn down the path of halves that leads to it. Targets that have no
    room left in a half are left out below it, so the work follows the rows that are still to deal."""
    before = np.concatenate([[0], np.cumsum(counts)])
    lo, hi = 0, len(counts)
    row = np.zeros_like(targets)
    live = np.flatnonzero(targets)
    targets = targets[live]
    while hi - lo > 1:
        mid = (lo + hi) // 2
        left = split(np.random.default_rng([seed, lo, hi]), targets, int(before[mid] - before[lo]))
        if partition < mid:
            hi, targets = mid, left
        else:
            lo, targets = mid, targets - left
        some = targets > 0
        live, targets = live[some], targets[some]
    row[live] = targets
    return row


def shard_targets(rows: int, shards: int, target_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each target its shard, first slot and size: shard sizes are at most one apart."""
    sizes = [rows // shards + (k < rows % shards) for k in range(shards)]
    out = [(k, a, min(target_rows, n - a)) for k, n in enumerate(sizes) for a in range(0, n, target_rows)]
    return tuple(np.array(c, dtype=np.int64) for c in zip(*out, strict=True)) if out else (np.empty(0, np.int64),) * 3


def _dealt(counts: dict[int, int], shards: int, target_rows: int, seed: int, target: str, order: str):
    parts = sorted(counts)
    sizes = np.array([counts[p] for p in parts], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        me = TaskContext.get().partitionId()
        labels, at, rng = None, 0, np.random.default_rng([seed, 1, me])
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if labels is None:
                _, _, room = shard_targets(int(sizes.sum()), shards, target_rows)
                row = matrix_row(sizes, room, parts.index(me), seed)
                labels = rng.permutation(np.repeat(np.arange(len(room)), row))
            if at + n > len(labels):
                raise RuntimeError("the input's partitions changed while it was being dealt")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(labels[at : at + n]), pa.array(rng.integers(0, 1 << 62, n))], names=[*batch.schema.names, target, order]
            )
            at += n
        if labels is not None and at != len(labels):
            raise RuntimeError("the input's partitions changed while it was being dealt")

    return run


def shuffle_into_shards(docs: DataFrame, shards: int = 16, seed: int = 1, target_rows: int | None = None) -> DataFrame:
    """``docs`` shuffled uniformly into ``shards``; see the module's text. ``target_rows`` is the size of
    a target, if not told by the rows' text."""
    spark = docs.sparkSession
    docs = docs.drop("shard", "slot")
    target, order = (fresh_name(docs.columns, c) for c in ("_target", "_order"))
    path = scratch_path(spark, "shuffle-input")
    docs.write.parquet(path)  # fixed files: both passes see the same partitions
    fixed = spark.read.schema(docs.schema).parquet(path)
    text = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)).cast("long") for f in docs.schema.fields if isinstance(f.dataType, T.StringType)]
    size = sum(text, F.lit(8 * len(docs.columns)).cast("long"))
    counted = fixed.select(F.spark_partition_id().alias("p"), size.alias("b")).groupBy("p").agg(F.count("*").alias("n"), F.sum("b").alias("b"))
    counted = counted.collect()  # two numbers for each input split
    counts = {r["p"]: r["n"] for r in counted}
    n = sum(counts.values())
    mean = sum(r["b"] for r in counted) / max(n, 1)
    target_rows = target_rows or max(1, min(TARGET_ROWS, int(TARGET_BYTES / max(mean, 1))))
    schema = T.StructType([*docs.schema.fields, T.StructField(target, T.LongType()), T.StructField(order, T.LongType())])
    dealt = fixed.mapInArrow(_dealt(counts, shards, target_rows, seed, target, order), schema)
    per, rest = n // shards, n % shards
    small = max(1, -(-per // target_rows)) if per else 0
    large = -(-(per + 1) // target_rows)
    t = F.col(target)
    shard = F.when(t < rest * large, F.floor(t / large)).otherwise(rest + F.floor((t - rest * large) / max(small, 1)))
    first = F.when(t < rest * large, t % large).otherwise((t - rest * large) % max(small, 1)) * target_rows
    targets = rest * large + (shards - rest) * small
    dealt = dealt.repartitionById(max(targets, 1), t.cast("int")).sortWithinPartitions(order)  # a partition is a target
    rank = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return dealt.withColumn("slot", (first + rank).cast("long")).withColumn("shard", shard.cast("int")).drop(target, order)
