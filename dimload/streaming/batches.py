"""Run the batch loads on a stream: each micro-batch is one ledger-guarded load.

The original has no streaming; its unit of re-run safety is the completion ledger (S10). Here a
Structured Streaming query hands every micro-batch to ``foreachBatch``; the batch is loaded with the
same DataFrame operators as a batch job and recorded in the ledger under ``<prefix>_<batch_id>``.
A micro-batch replayed after a failure (same ``batch_id``) finds its ledger row and is skipped, so
the target sees each micro-batch once even though the sink itself is not transactional.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimload.sources.ledger import LEDGER_SCHEMA, ledger_rows, value_exists


def _ledger(spark, ledger_path: str) -> DataFrame:
    from dimload.operators.publish import read_or_none

    ledger = read_or_none(spark, ledger_path, LEDGER_SCHEMA)
    return spark.createDataFrame([], LEDGER_SCHEMA) if ledger is None else ledger


def ledger_guarded(
    load_batch: Callable[[DataFrame, int], None],
    ledger_path: str,
    prefix: str,
    as_of_of: Callable[[int], str],
    related: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: skip batches already in the ledger, else load and record.

    ``load_batch(df, batch_id)`` performs the load (e.g. ``loads.load`` + a publish);
    ``as_of_of(batch_id)`` gives the batch time recorded in the ledger (no clock calls here).
    """

    def run(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        update_id = f"{prefix}_{batch_id}"
        if value_exists(_ledger(spark, ledger_path), "update_id", update_id).first()["value_exists"]:
            return
        load_batch(df, batch_id)
        done = spark.range(1).select(F.lit(update_id).alias("update_id"))
        ledger_rows(done, "update_id", as_of_of(batch_id), related).write.mode("append").parquet(ledger_path)

    return run


def start_stream_load(
    stream: DataFrame,
    foreach: Callable[[DataFrame, int], None],
    checkpoint_location: str,
    available_now: bool = True,
    processing_time: str | None = None,
):
    """Start a streaming query that calls ``foreach`` per micro-batch (``availableNow`` by default)."""
    writer = stream.writeStream.foreachBatch(foreach).option("checkpointLocation", checkpoint_location)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
