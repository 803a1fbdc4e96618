"""Column expressions (F1-F12, P4) built only from Spark's own functions.

Everything here returns a ``Column`` so that it stays inside whole-stage codegen; nothing runs
row by row in Python.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Iterable, Sequence, Union

from pyspark.sql import Column
from pyspark.sql import functions as F

from dimload import constants as C

TimeLike = Union[str, _dt.datetime, _dt.date, Column]


def ts_ntz(value: TimeLike) -> Column:
    """A ``timestamp_ntz`` literal (the load time ``as_of`` and the default dates).

    Strings are parsed by Spark, so microseconds survive: ``'2024-06-01 12:00:00.123456'``.
    """
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def default_start() -> Column:
    """F1's fallback start of validity, 1970-01-01."""
    return ts_ntz(C.DEFAULT_START)


def default_end() -> Column:
    """the open end of validity, parsed from its legacy text form (01012400, ddMMyyyy)."""
    return F.to_timestamp_ntz(F.lit(C.DEFAULT_END_TEXT), F.lit(C.DEFAULT_END_PATTERN))


def plus_one_microsecond(ts: Column) -> Column:
    """``ts + 1 µs``."""
    return ts + F.expr("INTERVAL '0.000001' SECOND")


def next_start(max_expiry: Column) -> Column:
    """F1 + F2: start of a new version = latest expiry + 1 µs, or 1970-01-01 for a new key."""
    return F.coalesce(plus_one_microsecond(max_expiry), default_start())


def key_timestamp_text(ts: Column) -> Column:
    """Timestamp rendered with microseconds, as used inside derived keys and checked outputs."""
    return F.date_format(ts, C.KEY_TS_PATTERN)


def derived_key(business_keys: Sequence[str], start_col: str) -> Column:
    """``bk || start`` text key of one dimension version.

    A single key column concatenates exactly like the original (``'42' || '1970-01-01 ...'``);
    several key columns are joined with ``'|'`` before the start, with ``'|'`` and ``'\\'`` inside a
    part escaped by ``'\\'``, so different keys never share a text. Any NULL part makes the key
    NULL, so rows with a NULL business key never receive a surrogate key.
    """
    return F.concat(business_key_text(business_keys), key_timestamp_text(F.col(start_col)))


def business_key_text(business_keys: Sequence[str]) -> Column:
    """Text form of a (possibly compound) business key, NULL if any part is NULL."""
    texts = [F.col(k).cast("string") for k in business_keys]
    if len(texts) == 1:
        return texts[0]
    parts: list[Column] = []
    for i, text in enumerate(texts):
        if i:
            parts.append(F.lit("|"))
        parts.append(F.regexp_replace(text, r"([|\\])", r"\\$1"))
    return F.concat(*parts)


def differs(left: Column, right: Column) -> Column:
    """P4 for one column: values differ, treating NULL as a value (never NULL itself)."""
    return ~left.eqNullSafe(right)


def any_differs(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """OR of null-safe differences; ``False`` when there are no columns to compare."""
    terms = [differs(a, b) for a, b in pairs]
    if not terms:
        return F.lit(False)
    return reduce(lambda x, y: x | y, terms)


def local_time(ts: Column, tz: str = C.LOCAL_TZ) -> Column:
    """a UTC wall-clock ``timestamp_ntz`` seen in the business time zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), ts)


def truncate_to_second(ts: Column) -> Column:
    """Load stamps of the load strategies carry whole seconds only."""
    return F.date_trunc("second", ts).cast("timestamp_ntz")


def date_text(ts: Column) -> Column:
    """F8: ``YYYY-MM-DD`` from a timestamp (first ten characters of its text form)."""
    return F.substring(ts.cast("string"), 1, 10)


def hour_text(ts: Column) -> Column:
    """F8: ``YYYY-MM-DD HH:00:00`` from a timestamp."""
    return F.concat(F.substring(ts.cast("string"), 1, 13), F.lit(":00:00"))


def bucket_of_url(url: Column) -> Column:
    """bucket (authority) of an object-store URL ``scheme://bucket/path``."""
    return F.regexp_extract(url, r"(?i)^[a-z0-9]+://([^/]+)/(.*)$", 1)


def path_of_url(url: Column) -> Column:
    """object path of an object-store URL (empty when the URL names only a bucket)."""
    return F.regexp_extract(url, r"(?i)^[a-z0-9]+://([^/]+)/(.*)$", 2)


def directory_of_key(key: Column) -> Column:
    """directory part (with trailing '/') of a storage key; '' when there is no '/'."""
    return F.regexp_extract(key, r"^(.*/)(.*)$", 1)


def file_of_key(key: Column) -> Column:
    """file-name part of a storage key; the whole key when there is no '/'."""
    return F.when(key.contains("/"), F.regexp_extract(key, r"^(.*/)(.*)$", 2)).otherwise(key)


def is_compressed(path: Column) -> Column:
    """gzip-looking name (``.gz`` optionally followed by digits)."""
    return path.rlike(C.COMPRESSED_PATTERN)


def table_of_name(name: Column) -> Column:
    """table part of ``schema.table`` (the name itself without a dot)."""
    return F.element_at(F.split(name, r"\."), -1)
