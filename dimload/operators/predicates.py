"""Projections and predicates (P1-P3, P5-P10) and the join-condition builder."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimload import constants as C
from dimload.functions.columns import truncate_to_second, ts_ntz


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def common_columns(target_columns: Sequence[str], source_columns: Sequence[str], exclude: Sequence[str] = (C.ETL_UPDATED, C.ETL_DELETED)) -> list[str]:
    """Target ∩ source column names in target order, case-insensitive, metadata excluded."""
    src = {c.lower() for c in source_columns}
    skip = {e.lower() for e in exclude}
    return [c for c in target_columns if c.lower() in src and c.lower() not in skip]


def common_projection(target: DataFrame, source: DataFrame) -> DataFrame:
    """P1 applied: the source restricted to the columns it shares with the target (target names)."""
    cols = common_columns(target.columns, source.columns)
    src = {c.lower(): c for c in source.columns}
    return source.select(*[_q(src[c.lower()]).alias(c) for c in cols])


def mapped_projection(source: DataFrame, source_columns: Sequence[str], target_columns: Sequence[str]) -> DataFrame:
    """Positional rename ``source_columns[i] -> target_columns[i]``."""
    if len(source_columns) != len(target_columns):
        raise ValueError("source_columns and target_columns differ in length")
    return source.select(*[_q(s).alias(t) for s, t in zip(source_columns, target_columns)])


def load_stamp(as_of) -> Column:
    """Batch stamp of the load strategies (whole seconds)."""
    return truncate_to_second(ts_ntz(as_of))


def stamp(df: DataFrame, as_of, deleted: bool = False) -> DataFrame:
    """``etl_updated_timestamp`` = batch stamp, ``etl_deleted_flag`` = ``deleted``."""
    return df.withColumns({C.ETL_UPDATED: load_stamp(as_of), C.ETL_DELETED: F.lit(deleted)})


def row_cap(df: DataFrame, n: int | None, order_by: Sequence[str] | None = None) -> DataFrame:
    """At most ``n`` rows (test mode); ordered first when ``order_by`` is given."""
    if n is None:
        return df
    if order_by:
        df = df.orderBy(*[_q(c) for c in order_by])
    return df.limit(n)


def not_default_rows(df: DataFrame, business_keys: Sequence[str]) -> DataFrame:
    """Drop rows whose business keys are all negative (default / unknown members).

    The sign test only exists for numeric keys; text keys have no default rows to leave out, but a
    NULL text key drops its row as a NULL number does.
    """
    numeric = [k for k in business_keys if isinstance(df.select(_q(k)).schema[0].dataType, T.NumericType)]
    text = [k for k in business_keys if k not in numeric]
    rows = df.dropna(subset=text) if text else df
    if not numeric:
        return rows
    return rows.filter(~reduce(lambda a, b: a & b, [_q(k) < 0 for k in numeric]))


def default_rows(df: DataFrame, surrogate_key: str) -> DataFrame:
    """Rows kept as they are by a publish (surrogate key negative or NULL)."""
    sk = _q(surrogate_key)
    return df.filter((sk < 0) | sk.isNull())


def exclude_deleted(df: DataFrame) -> DataFrame:
    """Only rows not soft-deleted (``etl_deleted_flag = false``; NULL flags are dropped too)."""
    return df.filter(_q(C.ETL_DELETED) == F.lit(False))


def join_condition(
    keys_definition: Sequence[Sequence[str]],
    left: DataFrame,
    right: DataFrame,
    delete_condition: Column | str | None = None,
    use_left_key_only: bool = False,
) -> Column:
    """AND of ``left.lk[::cast] = right.rk[::cast]`` for ``[(right_key, left_key[, cast]), ...]``.

    The cast applies to both sides. ``delete_condition`` (P8) is ANDed and is evaluated against
    the *left* frame (the target of a delete). NULL keys never match (plain equality).
    """
    cond = None
    for key in keys_definition:
        right_key, left_key = key[0], key[1]
        if use_left_key_only:
            right_key = left_key
        lcol, rcol = left[f"`{left_key}`"], right[f"`{right_key}`"]
        if len(key) == 3 and key[2]:
            lcol, rcol = lcol.cast(key[2]), rcol.cast(key[2])
        term = lcol == rcol
        cond = term if cond is None else cond & term
    if delete_condition is not None:
        dc = F.expr(delete_condition) if isinstance(delete_condition, str) else delete_condition
        cond = cond & dc
    return cond
