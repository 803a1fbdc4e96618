"""Registered load-strategy queries (L1-L5, A2, P3, P5, P8, P9, J5, J6) and their SQL oracles.

Load fixture over ``orders``: the target holds the orders with ``o_orderkey % 3 <> 0`` (some
already soft-deleted, some with a NULL flag); the source holds the orders divisible by 2 or 3 with a
new price, plus a second copy of every ``% 10 = 0`` order (duplicates must survive the load). Target
and source together hold every order; the refresh, which reads no target, loads all orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimload import constants as C
from dimload.functions.columns import key_timestamp_text, ts_ntz
from dimload.operators.loads import load
from dimload.operators.predicates import exclude_deleted
from dimload.plans import fixtures as fx

LOAD_AS_OF = "2024-03-15 08:30:45.678901"
TARGET_STAMP = "2024-01-01 00:00:00"
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
OUT_COLS = ORDER_COLS + [C.ETL_UPDATED, C.ETL_DELETED]
KEYS = [("o_orderkey", "o_orderkey")]


def load_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return fx.table(spark, sf_dir, "orders").filter(k % 3 != 0).select(
        *ORDER_COLS,
        ts_ntz(TARGET_STAMP).alias(C.ETL_UPDATED),
        F.when(k % 7 == 0, F.lit(True)).when(k % 11 == 0, F.lit(None).cast("boolean")).otherwise(F.lit(False)).alias(C.ETL_DELETED),
    )


def load_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return _repriced(fx.table(spark, sf_dir, "orders").filter((k % 2 == 0) | (k % 3 == 0)))


def _repriced(o: DataFrame) -> DataFrame:
    o = o.withColumn("o_totalprice", F.col("o_totalprice") + 1).select(*ORDER_COLS)
    return o.unionByName(o.filter(F.col("o_orderkey") % 10 == 0))


def _out(df: DataFrame) -> DataFrame:
    ts = {"o_orderdate", C.ETL_UPDATED}
    return df.select(*[key_timestamp_text(F.col(c)).alias(c) if c in ts else F.col(c) for c in OUT_COLS])


def _run(strategy: str, **kw):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = _repriced(fx.table(spark, sf_dir, "orders")) if strategy == "refresh" else load_source(spark, sf_dir)
        return _out(load(load_target(spark, sf_dir), source, strategy, KEYS if strategy not in ("insert", "refresh") else None, LOAD_AS_OF, **kw))

    q.__doc__ = f"L: {strategy} load of the orders fixture"
    return q


def q_exclude_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live rows of the full load's result."""
    return exclude_deleted(_run("full")(spark, sf_dir))


def q_load_upsert_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2 on a table partitioned by order status: only touched partitions are rewritten."""
    from dimload.operators.publish import load_into
    from dimload.session import scratch_path

    path = scratch_path(spark, "orders_by_status")
    load_target(spark, sf_dir).write.partitionBy("o_orderstatus").parquet(path)
    out = load_into(path, load_source(spark, sf_dir), "upsert", KEYS, LOAD_AS_OF, partition_cols=["o_orderstatus"])
    return _out(out)


def q_load_into_new_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 / E3 / L1 / L2 on storage: orders partitioned by status; an upsert brings a flag and a text that
    the table lacks, a column is added with a default, and an insert follows. Rows that no load has
    written again read the defaults."""
    from dimload.operators.publish import load_into
    from dimload.session import scratch_path
    from dimload.sources.versions import add_stored_column, read_table

    path = scratch_path(spark, "orders_new_flag")
    load_target(spark, sf_dir).write.partitionBy("o_orderstatus").parquet(path)
    k = F.col("o_orderkey")
    source = load_source(spark, sf_dir)
    some = source.filter(k % 4 != 1).withColumns({"is_big": F.col("o_totalprice") > 200000, "remark": F.lit("seen")})
    load_into(path, some, "upsert", KEYS, LOAD_AS_OF, partition_cols=["o_orderstatus"])
    add_stored_column(spark, path, "priority", "int", 5)
    late = source.filter(k % 4 == 1).withColumns({"is_big": F.lit(None).cast("boolean"), "priority": F.lit(1)})
    load_into(path, late, "insert", None, LOAD_AS_OF)
    return read_table(spark, path).select("o_orderkey", "o_orderstatus", "o_totalprice", C.ETL_DELETED, "is_big", "remark", "priority")


FILE_ROWS = 500_000  # of each parity in a file of orders_by_range, about


def _by_range(rows: DataFrame, batch: DataFrame) -> DataFrame:
    """``rows`` in partitions by ranges of o_orderkey, two for each range (odd or not). A range begins with a key
    of ``batch`` (the first one: with the smallest), so that every file of odd keys holds one of them."""
    n, least = rows.count(), batch.agg(F.min("o_orderkey")).head()[0]
    wanted = -(-n // (2 * FILE_ROWS))
    cuts = []
    if wanted > 1 and least is not None:
        shares = [k / wanted for k in range(1, wanted)]
        at = batch.select("o_orderkey").distinct().agg(F.percentile_approx("o_orderkey", F.array(*map(F.lit, shares)), F.lit(100 * wanted))).head()[0]
        cuts = sorted({k for k in at if k > least})  # keys of the batch, one for each file
    key = F.coalesce(F.col("o_orderkey"), F.lit(least))
    place = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut <= key)) if cuts else F.lit(0)
    return rows.repartitionById(2 * (len(cuts) + 1), 2 * place + F.coalesce(F.col("odd"), F.lit(False)).cast("int"))


def q_load_upsert_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3 on storage: all orders in files by the parity and range of their key; a batch of odd keys replaces
    the files that hold them. Returns the rows, and of each whether its file is an old one."""
    from dimload.operators.publish import load_into
    from dimload.session import scratch_path
    from dimload.sources.versions import FILE_COL, current_version, read_version

    path = scratch_path(spark, "orders_by_range")
    o = fx.table(spark, sf_dir, "orders").select(*ORDER_COLS, ts_ntz(TARGET_STAMP).alias(C.ETL_UPDATED), F.lit(False).alias(C.ETL_DELETED))
    odd = (F.col("o_orderkey") % 2 == 1).alias("odd")
    source = fx.table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 50 == 1).withColumn("o_totalprice", F.lit(1.5))
    _by_range(o.select("*", odd), source).write.partitionBy("odd").parquet(path)
    load_into(path, source.select(*ORDER_COLS, odd), "refresh_by_keys", KEYS, LOAD_AS_OF, partition_cols=["odd"])
    rows = read_version(spark, path, current_version(spark, path), files=True)
    return rows.select("o_orderkey", "o_totalprice", F.col(FILE_COL).startswith("odd=").alias("old_file"))


QUERIES = {
    "load_into_new_flag": q_load_into_new_flag,
    "load_upsert_files": q_load_upsert_files,
    "load_insert": _run("insert"),
    "load_upsert": _run("upsert"),
    "load_refresh_by_keys": _run("refresh_by_keys"),
    "load_full": _run("full"),
    "load_refresh": _run("refresh"),
    "load_upsert_conditional": _run("upsert", delete_condition="o_orderstatus = 'O'", load_constraint="o_orderstatus <> 'P'"),
    "exclude_deleted": q_exclude_deleted,
    "load_upsert_partitioned": q_load_upsert_partitioned,
}

_TS = "'%Y-%m-%d %H:%M:%S.%f'"
LOAD_CTE = f"""
with t as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
    timestamp '{TARGET_STAMP}' as etl_updated_timestamp,
    case when o_orderkey % 7 = 0 then true when o_orderkey % 11 = 0 then null else false end as etl_deleted_flag
  from orders where o_orderkey % 3 <> 0),
s0 as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 as o_totalprice, o_orderdate, o_orderpriority
  from orders where o_orderkey % 2 = 0 or o_orderkey % 3 = 0),
s as (select * from s0 union all select * from s0 where o_orderkey % 10 = 0),
ins as (select *, date_trunc('second', timestamp '{LOAD_AS_OF}') as etl_updated_timestamp, false as etl_deleted_flag from s)
"""
_SEL = (
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, " + _TS + ") as o_orderdate, "
    "o_orderpriority, strftime(etl_updated_timestamp, " + _TS + ") as etl_updated_timestamp, etl_deleted_flag from "
)
_SYD = f"(timestamp '{LOAD_AS_OF}' at time zone 'UTC') at time zone '{C.LOCAL_TZ}'"
_FULL = f"""
, kept as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
    case when etl_deleted_flag = false then {_SYD} else etl_updated_timestamp end as etl_updated_timestamp,
    case when etl_deleted_flag = false then true else etl_deleted_flag end as etl_deleted_flag
  from t where cast(o_orderkey as varchar) not in (select distinct cast(o_orderkey as varchar) from s)),
r as (select * from kept union all select * from ins)
"""
_UPSERT = """
, r as (select * from t where o_orderkey not in (select distinct o_orderkey from s) union all select * from ins)
"""
ORACLES = {
    "load_insert": LOAD_CTE + ", r as (select * from t union all select * from ins) " + _SEL + "r",
    "load_upsert": LOAD_CTE + _UPSERT + _SEL + "r",
    "load_refresh_by_keys": LOAD_CTE + _UPSERT + _SEL + "r",
    "load_full": LOAD_CTE + _FULL + _SEL + "r",
    "load_refresh": LOAD_CTE.replace("where o_orderkey % 2 = 0 or o_orderkey % 3 = 0", "") + _SEL + "ins",
    "load_upsert_conditional": LOAD_CTE
    + """, r as (select * from t where not (o_orderstatus = 'O' and o_orderkey in (select distinct o_orderkey from s))
        union all select * from ins where o_orderstatus <> 'P') """
    + _SEL
    + "r",
    "exclude_deleted": LOAD_CTE + _FULL + _SEL + "r where etl_deleted_flag = false",
    "load_upsert_partitioned": LOAD_CTE + _UPSERT + _SEL + "r",
    "load_into_new_flag": LOAD_CTE
    + """, r as (select *, false as is_big, cast(null as varchar) as remark, 5 as priority from t
    where o_orderkey not in (select o_orderkey from s where o_orderkey % 4 <> 1)
  union all select *, o_totalprice > 200000, 'seen', 5 from ins where o_orderkey % 4 <> 1
  union all select *, null, null, 1 from ins where o_orderkey % 4 = 1)
select o_orderkey, o_orderstatus, o_totalprice, etl_deleted_flag, is_big, remark, priority from r""",
    "load_upsert_files": """select o_orderkey, case when o_orderkey % 50 = 1 then 1.5 else o_totalprice end as o_totalprice,
  o_orderkey % 2 = 0 as old_file from orders""",
}
