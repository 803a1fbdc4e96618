"""Batch ledger (S10) and data-exists probe.

The ledger is an append-only table ``(update_id, related, inserted)``: a unit of work with a row
there is done. Work lists are filtered with ``left_anti`` joins, never by fetching the ledger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimload.functions.columns import ts_ntz

LEDGER_SCHEMA = "update_id string, related string, inserted timestamp_ntz"


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER_SCHEMA)


def ledger_rows(done: DataFrame, id_col: str, as_of, related: str | Column | None = None) -> DataFrame:
    """S10 ``touch``: ledger rows for the finished units of work in ``done``."""
    rel = related if isinstance(related, Column) else F.lit(related)
    return done.select(
        F.col(id_col).cast("string").alias("update_id"),
        rel.cast("string").alias("related"),
        ts_ntz(as_of).alias("inserted"),
    ).dropDuplicates(["update_id"])


def mark_done(ledger_path: str, done: DataFrame, id_col: str, as_of, related=None) -> None:
    """Append the ledger rows of ``done`` to the ledger table at ``ledger_path``."""
    ledger_rows(done, id_col, as_of, related).write.mode("append").parquet(ledger_path)


def pending_only(work: DataFrame, ledger: DataFrame, id_col: str) -> DataFrame:
    """S10 ``exists`` for a whole work list: units of ``work`` that have no ledger row."""
    done = ledger.select(F.col("update_id").alias("_done_id"))
    return work.join(done, F.col(id_col).cast("string") == F.col("_done_id"), "left_anti")


def is_done(ledger: DataFrame, update_id: str) -> DataFrame:
    """S10 ``exists`` for one unit: a one-row frame ``done`` (boolean)."""
    return value_exists(ledger, "update_id", update_id).withColumnRenamed("value_exists", "done")


def value_exists(df: DataFrame, column: str, value) -> DataFrame:
    """One row ``value_exists`` -- whether any row has ``column = value``.

    Each partition stops at its first match (limit 1), so the probe never scans past it.
    """
    hit = df.filter(F.col(f"`{column}`") == F.lit(value)).select(F.lit(1).alias("_h")).limit(1)
    return hit.agg((F.count(F.lit(1)) > 0).alias("value_exists"))
