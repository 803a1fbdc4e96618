"""Surrogate keys (K1-K4).

K1 gives every business key that is not yet in the keys table the next dense number. The order of
the new numbers is ``(md5(key), key)``, offset by the largest key already handed out. It is
computed without a single-partition sort of the data: the md5 prefix splits the new keys into
hash buckets (balanced by construction, whatever the key distribution), each bucket is ranked on
its own, and a per-bucket offset table of at most ``16**bucket_hex + 1`` rows -- a proven size
bound, independent of the data -- is broadcast back.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimload import constants as C
from dimload.functions.columns import ts_ntz

# Hex digits of md5 used as the ranking bucket: 16**3 = 4096 buckets. Raise it for very large
# batches of new keys (each bucket is ranked inside one task).
DEFAULT_BUCKET_HEX = 3
MAX_BUCKET_HEX = 4  # 65,537 offset rows


#: A stored keys table is partitioned by the first hex digit of the key's md5; joins that name it read
#: only the partitions that the new keys fall into.
KEY_PREFIX = "key_prefix"


def key_prefix(key: Column) -> Column:
    return F.substring(F.md5(key.cast("string")), 1, 1)


def keys_schema_columns(sk: str) -> list[str]:
    """K2 column order of a keys table."""
    return [sk, C.KEYS_BUSINESS_KEY, C.KEYS_KEY_NAME, C.KEYS_SYSTEM, C.KEYS_ACTIVE, C.ETL_UPDATED, C.ETL_DELETED]


def map_schema_columns(sk: str) -> list[str]:
    """K3 column order of a key map table."""
    return [sk, C.MAP_KEY_NAME, C.MAP_BUSINESS_KEY, C.MAP_SYSTEM, C.ETL_UPDATED, C.ETL_DELETED]


def empty_keys(spark: SparkSession, sk: str) -> DataFrame:
    """An empty K2 keys table."""
    return spark.createDataFrame(
        [],
        f"{sk} bigint, {C.KEYS_BUSINESS_KEY} string, {C.KEYS_KEY_NAME} string, "
        f"{C.KEYS_SYSTEM} string, {C.KEYS_ACTIVE} boolean, {C.ETL_UPDATED} timestamp_ntz, "
        f"{C.ETL_DELETED} boolean",
    )


def max_key(keys: DataFrame, sk: str) -> DataFrame:
    """One-row frame ``max_sk``: the largest surrogate key handed out so far (0 when there is none;
    default members have negative ones)."""
    return keys.agg(F.greatest(F.max(F.col(sk)), F.lit(0)).cast("bigint").alias("max_sk"))


def assign_numbers(
    df: DataFrame,
    key_col: str,
    base: DataFrame | None,
    out_col: str,
    tie_cols: Sequence[str] = (),
    bucket_hex: int = DEFAULT_BUCKET_HEX,
    exclude: Column | None = None,
    one_row_per_key: bool = True,
) -> DataFrame:
    """Add ``out_col = base + dense_rank() over (order by md5(key), key, *tie_cols)``.

    Rows with equal ``(key, *tie_cols)`` get equal numbers. Rows with a NULL key, or where
    ``exclude`` holds (e.g. keys that already have a number), get NULL and take no number.
    ``base`` is a one-row frame with column ``max_sk`` (``None`` = 0).

    Plan: one shuffle by hash bucket (md5 prefix) for the ranking window; the bucket sizes are an
    aggregate over the window's own partitioning (no second shuffle); the only global step is a
    running sum over the bucket-size table (at most ``16**bucket_hex + 1`` rows), which is then
    broadcast back -- its size is bounded by ``bucket_hex``, not by the data.
    """
    if not 1 <= bucket_hex <= MAX_BUCKET_HEX:
        raise ValueError(f"bucket_hex must be 1 to {MAX_BUCKET_HEX}: the offsets are broadcast")
    if not one_row_per_key:
        # A key repeated on many rows (one key may hold a third of all rows) must not become one
        # window group: number the distinct keys (combined map-side) and join the numbers back.
        ident = [key_col, *tie_cols]
        ex = F.coalesce(exclude, F.lit(False)) if exclude is not None else F.lit(False)
        tagged = df.withColumn("_nb_ex", ex)
        distinct = tagged.select(*ident, "_nb_ex").dropDuplicates([*ident, "_nb_ex"])
        numbers = assign_numbers(distinct, key_col, base, out_col, tie_cols, bucket_hex, F.col("_nb_ex"))
        return tagged.join(numbers, [*ident, "_nb_ex"], "left").drop("_nb_ex")
    skip = F.col(key_col).isNull()
    if exclude is not None:
        skip = skip | F.coalesce(exclude, F.lit(False))
    # Rows that take no number stay out of the ranking: they may be many, and NULL keys would
    # all meet in one group.
    rest = df.filter(skip).withColumn(out_col, F.lit(None).cast("bigint"))
    h = F.md5(F.col(key_col).cast("string"))
    keyed = df.filter(~skip).select("*", h.alias("_nb_h"), F.substring(h, 1, bucket_hex).alias("_nb_b"))
    order = ["_nb_h", key_col, *tie_cols]
    ranked = keyed.select("*", F.dense_rank().over(Window.partitionBy("_nb_b").orderBy(*order)).alias("_nb_r"))
    sizes = ranked.groupBy("_nb_b").agg(F.max("_nb_r").cast("bigint").alias("_nb_n"))
    if base is not None:
        # The base sorts before every hex bucket, so it offsets all of them.
        sizes = sizes.unionByName(base.select(F.lit("").alias("_nb_b"), F.col("max_sk").cast("bigint").alias("_nb_n")))
    running = Window.orderBy("_nb_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_nb_b", F.coalesce(F.sum("_nb_n").over(running), F.lit(0)).alias("_nb_o"))
    numbered = ranked.join(F.broadcast(offsets), "_nb_b", "left")
    value = (F.col("_nb_o") + F.col("_nb_r")).cast("bigint").alias(out_col)
    columns = [c for c in df.columns if c != out_col]
    return numbered.select(*[F.col(f"`{c}`") for c in columns], value).unionByName(rest.select(*[F.col(f"`{c}`") for c in columns], F.col(out_col)))


def _const_or_col(v: str | Column | None) -> Column:
    if isinstance(v, Column):
        return v
    return F.lit(v)


def generate_keys(
    candidates: DataFrame,
    key_col: str,
    keys: DataFrame,
    sk: str,
    as_of,
    key_name: str | Column,
    source_system: str | Column,
    bucket_hex: int = DEFAULT_BUCKET_HEX,
    materialize: bool = True,
    highest: int | None = None,
) -> DataFrame:
    """K1: rows to append to the keys table for keys of ``candidates`` it does not hold yet.

    The key identity is (value, key name, source system); name and system are constants or
    columns of ``candidates`` (several source systems in one batch). New identities are numbered
    in ``(md5(value), value, name, system)`` order after the table's current maximum; existing
    keys never change.

    Ranking reads the new identities twice (bucket sizes, then numbers). With ``materialize``
    (default) they are checkpointed first, so the candidates are read and deduplicated once. The join
    with the keys table is on the value alone where name and system are constants, so that a keys table
    bucketed on it (:func:`add_keys`) is not shuffled. ``highest`` is the largest number in use, where it
    is known: nothing is scanned for it.
    """
    ident = [C.KEYS_BUSINESS_KEY, C.KEYS_KEY_NAME, C.KEYS_SYSTEM]
    cand = candidates.select(
        F.col(key_col).cast("string").alias(C.KEYS_BUSINESS_KEY),
        F.coalesce(_const_or_col(key_name).cast("string"), F.lit("")).alias(C.KEYS_KEY_NAME),
        F.coalesce(_const_or_col(source_system).cast("string"), F.lit("")).alias(C.KEYS_SYSTEM),
    ).filter(F.col(C.KEYS_BUSINESS_KEY).isNotNull())
    existing = keys.select(
        F.col(C.KEYS_BUSINESS_KEY),
        F.coalesce(F.col(C.KEYS_KEY_NAME), F.lit("")).alias(C.KEYS_KEY_NAME),
        F.coalesce(F.col(C.KEYS_SYSTEM), F.lit("")).alias(C.KEYS_SYSTEM),
        *([KEY_PREFIX] if KEY_PREFIX in keys.columns else []),
    )
    if isinstance(key_name, str):
        existing = existing.filter(F.col(C.KEYS_KEY_NAME) == F.lit(key_name))
    if isinstance(source_system, str):
        existing = existing.filter(F.col(C.KEYS_SYSTEM) == F.lit(source_system))
    constant = {C.KEYS_KEY_NAME: isinstance(key_name, str), C.KEYS_SYSTEM: isinstance(source_system, str)}
    varying = [c for c in ident if not constant.get(c)]
    new_ids = cand.dropDuplicates(varying)
    if KEY_PREFIX in keys.columns:
        new_ids = new_ids.withColumn(KEY_PREFIX, key_prefix(F.col(C.KEYS_BUSINESS_KEY)))
        varying.append(KEY_PREFIX)
    new_ids = new_ids.join(existing, varying, "left_anti").select(*ident)
    if materialize:
        from dimload.session import materialize as _mat

        new_ids = _mat(new_ids)
    if highest is None:
        base = max_key(keys, sk)
    else:
        base = candidates.sparkSession.range(1).select(F.lit(highest).cast("bigint").alias("max_sk"))
    numbered = assign_numbers(
        new_ids, C.KEYS_BUSINESS_KEY, base, sk, (C.KEYS_KEY_NAME, C.KEYS_SYSTEM), bucket_hex
    )
    return numbered.select(
        F.col(sk),
        C.KEYS_BUSINESS_KEY,
        C.KEYS_KEY_NAME,
        C.KEYS_SYSTEM,
        F.lit(False).alias(C.KEYS_ACTIVE),
        ts_ntz(as_of).alias(C.ETL_UPDATED),
        F.lit(False).alias(C.ETL_DELETED),
    )


KEYS_BUCKETS = 64
_HIGHEST = "dimload.highest_key"


def highest_key(spark: SparkSession, table: str) -> int | None:
    """The largest number of a keys table by its property (``None``: not known)."""
    held = {r["key"]: r["value"] for r in spark.sql(f"show tblproperties {table}").collect()}
    return int(held[_HIGHEST]) if _HIGHEST in held else None


def add_keys(
    candidates: DataFrame,
    key_col: str,
    table: str,
    sk: str,
    as_of,
    key_name: str | Column,
    source_system: str | Column,
    buckets: int = KEYS_BUCKETS,
) -> DataFrame:
    """K1 and K2 on a catalog table: the keys that ``table`` lacks are numbered and appended to it;
    returns their rows.

    The table is bucketed on the key's value (``buckets`` of them when it is made), so old keys are not
    shuffled when a batch is looked up, and its property holds the largest number handed out, so none
    are scanned for it. The property is raised before the keys are appended: a crash in between leaves a
    gap in the numbers and never a number twice.
    """
    from dimload.session import materialize

    spark = candidates.sparkSession
    stored = spark.catalog.tableExists(table)
    keys = spark.table(table) if stored else empty_keys(spark, sk)
    highest = highest_key(spark, table) if stored else 0
    new = materialize(generate_keys(candidates, key_col, keys, sk, as_of, key_name, source_system, highest=highest))
    newest = new.agg(F.max(sk)).head()[0]

    def append(rows: DataFrame) -> None:
        rows.write.mode("append").bucketBy(buckets, C.KEYS_BUSINESS_KEY).saveAsTable(table)

    if not stored:
        append(new.limit(0))
    if newest is not None:
        spark.sql(f"alter table {table} set tblproperties ('{_HIGHEST}' = '{newest}')")
        append(new)
    return new


def keys_to_map(new_keys: DataFrame, sk: str) -> DataFrame:
    """K3: the key map rows that go with newly generated keys."""
    return new_keys.select(
        F.col(sk),
        F.col(C.KEYS_KEY_NAME).alias(C.MAP_KEY_NAME),
        F.col(C.KEYS_BUSINESS_KEY).alias(C.MAP_BUSINESS_KEY),
        F.col(C.KEYS_SYSTEM).alias(C.MAP_SYSTEM),
        F.col(C.ETL_UPDATED),
        F.col(C.ETL_DELETED),
    )


def with_key(
    source: DataFrame,
    key_map: DataFrame,
    sk: str,
    business_key: str,
    key_name: str | Column,
    source_system: str | Column,
) -> DataFrame:
    """``select map.sk, source.*`` joined on (key value, key name, source system).

    Name and system are constants for a single source or columns of ``source`` for several.
    Rows without a key drop out (inner join). With constants the map is filtered before the join,
    so the filter reaches the map's scan.
    """
    m = key_map.select(
        F.col(sk).alias("_k_sk"),
        F.col(C.MAP_BUSINESS_KEY).alias("_k_v"),
        F.col(C.MAP_KEY_NAME).alias("_k_n"),
        F.col(C.MAP_SYSTEM).alias("_k_s"),
    )
    src = source.withColumn("_k_v", F.col(business_key).cast("string"))
    on = ["_k_v"]
    if isinstance(key_name, Column):
        src = src.withColumn("_k_n", key_name.cast("string"))
        on.append("_k_n")
    else:
        m = m.filter(F.col("_k_n") == F.lit(key_name)).drop("_k_n")
    if isinstance(source_system, Column):
        src = src.withColumn("_k_s", source_system.cast("string"))
        on.append("_k_s")
    else:
        m = m.filter(F.col("_k_s") == F.lit(source_system)).drop("_k_s")
    joined = src.join(m, on, "inner")
    return joined.select(F.col("_k_sk").alias(sk), *[F.col(f"`{c}`") for c in source.columns])
