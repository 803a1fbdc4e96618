"""Load strategies (L1-L5) and keyed loads.

Contract: ``(target, source, strategy, join_keys, delete_condition, load_constraint, as_of) ->``
the new target as a lazy DataFrame (publish it with :mod:`dimload.operators.quality`'s gate or
:func:`dimload.sources.scripts.refresh_table`).

* The delete of upsert / refresh_by_keys / full is a ``left_anti`` join against the *distinct*
  source keys: the distinct is a partial (map-side) aggregate, so repeated source keys shrink
  before the shuffle, and its output is already partitioned for the join.
* Target rows with a NULL key can never match; they are salted over the join's partitions, so
  the target is scanned once and no NULL-key hot partition arises. Target rows outside
  ``delete_condition`` (P8) find no match either.
* The target is aligned first (E3): it gains the columns that only the source has.
* The source is never de-duplicated: two source rows with one key are both inserted.
* The broadcast-or-shuffle choice for the anti-join is Catalyst's (size statistics) and AQE's
  (runtime sizes, skew split); no unchecked broadcast hint is given.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimload import constants as C
from dimload.functions.columns import local_time, ts_ntz
from dimload.operators.predicates import common_columns, load_stamp

JoinKeys = Sequence[Sequence[str]]
NULL_KEY_SALTS = 1024


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _expr(cond: Column | str | None) -> Column | None:
    if cond is None or (isinstance(cond, str) and not cond.strip()):
        return None
    return F.expr(cond) if isinstance(cond, str) else cond


def insert_rows(
    target: DataFrame,
    source: DataFrame,
    as_of,
    load_constraint: Column | str | None = None,
    source_columns: Sequence[str] | None = None,
    target_columns: Sequence[str] | None = None,
) -> DataFrame:
    """L1 rows: the source projected onto the target (P1 or P2), stamped (P3), filtered (P5).

    Inserted rows get ``etl_updated_timestamp`` = the batch stamp (whole seconds) and
    ``etl_deleted_flag`` = false; target columns the source does not feed are NULL.
    """
    lc = _expr(load_constraint)
    if lc is not None:
        source = source.filter(lc)
    if target_columns is None:
        target_columns = common_columns(target.columns, source.columns)
        src_map = {c.lower(): c for c in source.columns}
        source_columns = [src_map[c.lower()] for c in target_columns]
    elif source_columns is None:
        source_columns = list(target_columns)
    fed = {t.lower(): s for t, s in zip(target_columns, source_columns)}
    out = []
    for f in target.schema.fields:
        low = f.name.lower()
        if low == C.ETL_UPDATED:
            col = load_stamp(as_of)
        elif low == C.ETL_DELETED:
            col = F.lit(False)
        elif low in fed:
            col = _q(fed[low])
        else:
            col = F.lit(None)
        out.append(col.cast(f.dataType).alias(f.name))
    return source.select(*out)


def distinct_keys(source: DataFrame, join_keys: JoinKeys, as_text: bool = False) -> DataFrame:
    """A2: ``select distinct`` of the source-side join keys (text when ``as_text``, as in ``full``)."""
    cols = []
    for i, key in enumerate(join_keys):
        c = _q(key[0])
        cols.append((c.cast("string") if as_text else c).alias(f"_dk{i}"))
    return source.select(*cols).distinct()


def delete_matches(
    target: DataFrame,
    delete_source: DataFrame,
    join_keys: JoinKeys,
    delete_condition: Column | str | None = None,
    as_text: bool = False,
) -> DataFrame:
    """J5 + J6 + P8: target rows that survive ``DELETE ... USING (distinct keys) WHERE keys match``.

    ``join_keys`` = ``[(source_key, target_key[, cast]), ...]``; the cast applies to both sides.
    ``delete_condition`` restricts the delete to target rows where it holds.
    """
    t, s, cond = _matched_sides(target, delete_source, join_keys, as_text)
    dc = _expr(delete_condition)
    if dc is not None:
        # P8 as part of the match, so the target is scanned once: a row outside the condition
        # (or where it is NULL) finds no match and survives.
        cond = cond & dc
    return t.join(s, cond, "left_anti").select(*[_q(c) for c in target.columns])


def key_matches(target: DataFrame, source: DataFrame, join_keys: JoinKeys, delete_condition: Column | str | None = None) -> DataFrame:
    """The target rows that :func:`delete_matches` would delete."""
    t, s, cond = _matched_sides(target, source, join_keys, False)
    dc = _expr(delete_condition)
    if dc is not None:
        cond = cond & dc
    return t.join(s, cond, "left_semi").select(*[_q(c) for c in target.columns])


def _matched_sides(target: DataFrame, source: DataFrame, join_keys: JoinKeys, as_text: bool) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides with their compared keys, and the join condition. Target rows with a NULL key match
    nothing; a salt spreads them, so the target is scanned once and they do not meet in one task."""

    def compared(column: Column, key) -> Column:
        column = column.cast("string") if as_text else column
        return column.cast(key[2]) if len(key) == 3 and key[2] else column

    n = range(len(join_keys))
    tkeys = [compared(_q(key[1]), key).alias(f"_tk{i}") for i, key in enumerate(join_keys)]
    skeys = [compared(F.col(f"_dk{i}"), key).alias(f"_sk{i}") for i, key in enumerate(join_keys)]
    t = target.select("*", *tkeys)
    null_key = reduce(lambda a, b: a | b, [F.col(f"_tk{i}").isNull() for i in n])
    salt = 1 + F.pmod(F.xxhash64(*[_q(c) for c in target.columns]), F.lit(NULL_KEY_SALTS).cast("bigint"))
    t = t.withColumn("_tsalt", F.when(null_key, salt).otherwise(F.lit(0).cast("bigint")))
    s = distinct_keys(source, join_keys, as_text).select(*skeys, F.lit(0).cast("bigint").alias("_ssalt"))
    cond = reduce(lambda a, b: a & b, [F.col(f"_tk{i}") == F.col(f"_sk{i}") for i in n])
    return t, s, cond & (F.col("_tsalt") == F.col("_ssalt"))


def align_target(target: DataFrame, source: DataFrame, target_columns: Sequence[str] | None = None) -> DataFrame:
    """E3 before a load: the target gains the source's new columns (not with a mapped projection)."""
    from dimload.operators.schema import align_columns

    return target if target_columns is not None else align_columns(target, source)


def mark_deleted(target: DataFrame, as_of, tz: str = C.LOCAL_TZ) -> DataFrame:
    """L4's flag step: rows with ``etl_deleted_flag = false`` become true, stamped with the
    business-local time of ``as_of``; rows already true -- or NULL -- keep flag and stamp."""
    live = _q(C.ETL_DELETED) == F.lit(False)
    stamp_type = target.schema[C.ETL_UPDATED].dataType
    return target.withColumns(
        {
            C.ETL_DELETED: F.when(live, F.lit(True)).otherwise(_q(C.ETL_DELETED)),
            C.ETL_UPDATED: F.when(live, local_time(ts_ntz(as_of), tz).cast(stamp_type)).otherwise(_q(C.ETL_UPDATED)),
        }
    )


def load(
    target: DataFrame,
    source: DataFrame,
    strategy: str = "upsert",
    join_keys: JoinKeys | None = None,
    as_of=None,
    delete_condition: Column | str | None = None,
    load_constraint: Column | str | None = None,
    full_record_comparison_source: DataFrame | None = None,
    source_columns: Sequence[str] | None = None,
    target_columns: Sequence[str] | None = None,
    tz: str = C.LOCAL_TZ,
) -> DataFrame:
    """The new target after loading ``source`` with ``strategy``.

    * ``insert``: append the source.
    * ``upsert`` / ``refresh_by_keys``: delete target rows whose keys occur in the source (and
      satisfy ``delete_condition``), then append the source.
    * ``full``: as upsert against ``full_record_comparison_source`` (default: the source, keys as
      text); every other live row is soft-deleted (flag true, local-time stamp); then append.
    * ``refresh``: replace the target with the source.

    ``load_constraint`` filters only the appended rows, never the delete. Without mapped columns the
    target first gains the source's new columns (NULL, or false for flags, on old rows).
    """
    if strategy not in C.STRATEGIES:
        raise ValueError(f"unknown load strategy {strategy!r}; expected one of {C.STRATEGIES}")
    if as_of is None:
        raise ValueError("as_of (the batch time) is required")
    if strategy in ("upsert", "refresh_by_keys", "full") and not join_keys:
        raise ValueError(f"join keys are required for the {strategy} strategy")
    target = align_target(target, source, target_columns)
    ins = insert_rows(target, source, as_of, load_constraint, source_columns, target_columns)
    if strategy == "insert":
        kept = target
    elif strategy == "refresh":
        return ins
    elif strategy == "full":
        comparison = full_record_comparison_source if full_record_comparison_source is not None else source
        kept = mark_deleted(delete_matches(target, comparison, join_keys, delete_condition, as_text=True), as_of, tz)
    else:
        kept = delete_matches(target, source, join_keys, delete_condition)
    return kept.unionByName(ins)


# ------------------------------------------------------------------------------------------------
# Keyed loads
# ------------------------------------------------------------------------------------------------


def keyed_load(
    target: DataFrame,
    source: DataFrame,
    keys: DataFrame,
    key_map: DataFrame,
    sk: str,
    business_key: str,
    key_name: str,
    source_system: str,
    as_of,
    strategy: str = "upsert",
    key_source: DataFrame | None = None,
    load_source: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
):
    """K1 (new keys) -> K4 (source with key) -> load strategy keyed on ``[[sk, sk]]``.

    ``key_source`` (L8) is the frame keys are generated from when it differs from the loaded
    source; ``load_source`` is either the frame to load (already carrying ``sk``) or a function of
    the updated key map returning it (a script view that does its own key lookup).
    Returns ``(new_target, new_keys, new_map_rows)``.
    """
    from dimload.operators.keys import generate_keys, keys_to_map, with_key

    ks = key_source if key_source is not None else source
    new_keys = generate_keys(ks, business_key, keys, sk, as_of, key_name, source_system)
    new_map = keys_to_map(new_keys, sk)
    full_map = key_map.unionByName(new_map)
    if load_source is None:
        loaded = with_key(source, full_map, sk, business_key, key_name, source_system)
    elif callable(load_source):
        loaded = load_source(full_map)
    else:
        loaded = load_source
    new_target = load(target, loaded, strategy, [[sk, sk]], as_of)
    return new_target, new_keys, new_map
