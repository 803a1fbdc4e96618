"""Daily snapshots (L9) and date-range backfill.

A snapshot day is one partition ``snapshot_date=<d>`` of a versioned table: re-running a day replaces
exactly that partition, and an empty source clears it (a dynamic partition overwrite would leave the
old rows of a day with no new rows, so it is not used). A run that fails leaves the day as it was.

A backfill is one job over all missing days, not one job per day: the day list is generated by
``sequence`` (at most ``days_back`` rows -- bounded by the parameter, so it is broadcast), days
already in the ledger are removed with ``left_anti``, and the daily load runs once over the
union of the remaining days, written with one partitioned write.
"""

from __future__ import annotations

import datetime as _dt
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimload import constants as C
from dimload.sources.versions import read_or_none, replace_partitions
from dimload.sources.ledger import LEDGER_SCHEMA, ledger_rows, pending_only

SNAPSHOT_COL = "snapshot_date"


def _date_lit(d) -> Column:
    if isinstance(d, Column):
        return d.cast("date")
    if isinstance(d, (_dt.date, _dt.datetime)):
        d = d.strftime("%Y-%m-%d")
    return F.to_date(F.lit(str(d)))


def snapshot_rows(source: DataFrame, day) -> DataFrame:
    """L9 rows of one day: the source stamped with ``snapshot_date = to_date(day)``."""
    return source.withColumn(SNAPSHOT_COL, _date_lit(day))


def daily_snapshot(snapshots: DataFrame | None, source: DataFrame, day) -> DataFrame:
    """L9 on frames: delete the day's rows, append the source for the day (re-run safe)."""
    new = snapshot_rows(source, day)
    if snapshots is None:
        return new
    return snapshots.filter(~F.col(SNAPSHOT_COL).eqNullSafe(_date_lit(day))).unionByName(new)


def write_daily_snapshot(source: DataFrame, base_path: str, day) -> None:
    """L9 on storage: the partition ``snapshot_date=<day>`` replaced (empty source -> no rows of the day)."""
    d = day.strftime("%Y-%m-%d") if isinstance(day, (_dt.date, _dt.datetime)) else str(day)
    replace_partitions(snapshot_rows(source, day), base_path, SNAPSHOT_COL, [_dt.date.fromisoformat(d[:10])])


def backfill_window(spark: SparkSession, today, days_back: int) -> DataFrame:
    """L10 day list ``[today - days_back, today)`` (today excluded), column ``day`` (date).

    ``today`` is a date / text, or a one-row DataFrame whose first column is the day (e.g. derived
    from the data, so that no value is fetched to the driver).
    """
    if isinstance(today, DataFrame):
        base = today.select(F.col(f"`{today.columns[0]}`").cast("date").alias("_today"))
        t = F.col("_today")
    else:
        base = spark.range(1)
        t = _date_lit(today)
    if days_back <= 0:
        return base.select(F.lit(None).cast("date").alias("day")).filter(F.lit(False))
    return base.select(F.explode(F.sequence(F.date_sub(t, days_back), F.date_sub(t, 1))).alias("day"))


def default_days_back(production: bool) -> int:
    """Backfill horizon: 30 days in production, 2 elsewhere."""
    return C.BACKFILL_DAYS_PROD if production else C.BACKFILL_DAYS_OTHER


def day_update_id(prefix: str, day: Column) -> Column:
    """Ledger id of a daily unit of work: ``<prefix>_<yyyy-MM-dd>``."""
    return F.concat(F.lit(prefix + "_"), F.date_format(day, "yyyy-MM-dd"))


def pending_days(spark: SparkSession, today, days_back: int, ledger: DataFrame, prefix: str) -> DataFrame:
    """L10 + S10: days of the window without a ledger row: ``(day, update_id)``."""
    days = backfill_window(spark, today, days_back).withColumn("update_id", day_update_id(prefix, F.col("day")))
    return pending_only(days, ledger, "update_id")


def backfill(
    data: DataFrame,
    day_of: Column,
    pending: DataFrame,
    daily_load: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Run ``daily_load`` once over the rows of every pending day.

    ``day_of`` maps a row of ``data`` to its day; ``pending`` has at most ``days_back`` rows (a
    parameter bound), so it is broadcast into the scan of ``data``. ``daily_load`` receives rows
    with a ``day`` column and must keep ``day`` in its grouping so the days stay independent.
    """
    rows = data.withColumn("day", day_of.cast("date"))
    days = F.broadcast(pending.select("day").distinct())
    return daily_load(rows.join(days, "day", "left_semi"))


def backfill_into(
    spark: SparkSession,
    data: DataFrame,
    day_of: Column,
    daily_load: Callable[..., DataFrame],
    base_path: str,
    ledger_path: str,
    prefix: str,
    today,
    days_back: int,
    as_of,
    ordered: bool = False,
) -> DataFrame:
    """L10 on storage: load every pending day into its partition ``day=<d>`` and mark it done.

    By default one job loads all pending days and commits them together. With ``ordered``, for loads
    that read the day before, days run and commit one after the other, oldest first:
    ``daily_load(rows, before)`` gets the table as of the day before (``None`` when nothing is
    stored). Days are marked after their commit, so a crash repeats a day and never skips one; a
    repeated day replaces its rows, also by none. Returns the days that were loaded.
    """
    ledger = read_or_none(spark, ledger_path, LEDGER_SCHEMA)
    if ledger is None:
        ledger = spark.createDataFrame([], LEDGER_SCHEMA)
    rows = pending_days(spark, today, days_back, ledger, prefix).orderBy("day").collect()  # days_back rows at most
    pending = spark.createDataFrame([(r["day"], r["update_id"]) for r in rows], "day date, update_id string")

    def write(out: DataFrame, days: DataFrame, of: list) -> None:
        replace_partitions(out, base_path, "day", of)
        ledger_rows(days, "update_id", as_of, prefix).write.mode("append").parquet(ledger_path)

    if not ordered:
        if rows:
            write(backfill(data, day_of, pending, daily_load), pending, [r["day"] for r in rows])
        return pending
    for r in rows:
        one = pending.filter(F.col("day") == F.lit(r["day"]))
        stored = read_or_none(spark, base_path)
        before = None if stored is None else stored.filter(F.col("day") < F.lit(r["day"]))
        write(backfill(data, day_of, one, lambda day_rows, before=before: daily_load(day_rows, before)), one, [r["day"]])
    return pending
