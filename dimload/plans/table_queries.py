"""Registered queries for projections, schema operators, join keys, checks, functions and
multi-table operators (P1, P2, P6, E2-E5, F5-F8, J6, Q1-Q5, A3, A4, S11, M1, M2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimload import constants as C
from dimload.functions.columns import date_text, hour_text, key_timestamp_text, local_time
from dimload.operators.loads import load
from dimload.operators.multi import for_each_table, row_count, table_stats
from dimload.operators.predicates import common_projection, join_condition, mapped_projection, row_cap
from dimload.operators.quality import combine_checks, duplicate_keys, expect_no_rows, expect_rows, null_key_report, unique_columns
from dimload.operators.schema import add_column, clean_names, conform, schema_from_specs
from dimload.plans import fixtures as fx
from dimload.sources.ledger import value_exists

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
_TS = "'%Y-%m-%d %H:%M:%S.%f'"
AS_OF = "2024-03-15 08:30:45"


def q_common_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source columns shared with a mixed-case target, in target order, target names."""
    o = fx.table(spark, sf_dir, "orders")
    target = o.select(
        F.col("o_orderkey").alias("O_OrderKey"),
        F.col("o_custkey").alias("O_CUSTKEY"),
        F.col("o_orderstatus").alias("o_OrderStatus"),
        F.col("o_totalprice").alias("O_TotalPrice"),
        F.lit(None).cast("string").alias("o_extra_note"),
        F.lit(None).cast("timestamp_ntz").alias(C.ETL_UPDATED),
    ).limit(0)
    return common_projection(target, o)


def q_mapped_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional source -> target renames."""
    return mapped_projection(fx.table(spark, sf_dir, "orders"), ["o_orderkey", "o_totalprice", "o_orderstatus"], ["order_id", "amount", "status"])


def q_align_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 in L2: the upsert gives a narrower target the source's missing columns."""
    o = fx.table(spark, sf_dir, "orders")
    target = o.filter(F.col("o_orderkey") % 3 != 0).select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias(C.ETL_UPDATED), F.lit(False).alias(C.ETL_DELETED)
    )
    source = o.filter((F.col("o_orderkey") % 5 == 0) | (F.col("o_orderkey") % 3 == 0)).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    out = load(target, source, "upsert", [("o_orderkey", "o_orderkey")], AS_OF)
    return out.withColumn(C.ETL_UPDATED, key_timestamp_text(F.col(C.ETL_UPDATED)))


def q_add_column_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New columns on part; booleans default to false, a given default fills old rows."""
    p = fx.table(spark, sf_dir, "part")
    p = add_column(p, "p_is_valid", "boolean")
    p = add_column(p, "p_note", "string", "n/a")
    return add_column(p, "p_rank", "int")


SPECS = [
    {"name": "o_orderkey", "datatype": "bigint", "mandatory": True},
    {"name": "o_custkey"},
    {"name": "o_totalprice", "datatype": "currency"},
    {"name": "o_orderdate", "datatype": "epochsec"},
    {"name": "o_orderstatus", "datatype": "VARCHAR(1)"},
]
FILE_SPECS = [{"source_column": {"name": "o_extra", "datatype": "bigint"}}]  # a file's declared type is not the table's
NAME_ONLY = ["o_orderpriority", "o_ship_ok"]


def q_conform_to_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema from column specs (aliases, default text type, name-only booleans), applied."""
    s1 = schema_from_specs(SPECS, None, add_etl_metadata=False)
    s2 = schema_from_specs(NAME_ONLY, "name_only", add_etl_metadata=True)
    from pyspark.sql.types import StructType

    s3 = schema_from_specs(FILE_SPECS, "use_spec_file", add_etl_metadata=False)
    schema = StructType(s1.fields + s3.fields + s2.fields)
    orders = fx.table(spark, sf_dir, "orders").withColumn("o_extra", F.col("o_custkey"))
    out = conform(orders, schema, as_of=AS_OF)
    return out.withColumn("o_orderdate", key_timestamp_text(F.col("o_orderdate"))).withColumn(
        C.ETL_UPDATED, key_timestamp_text(F.col(C.ETL_UPDATED))
    )


def q_clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: odd column names cleaned (trim, invalid characters -> '_')."""
    o = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(" order key "),
        F.col("o_custkey").alias("cust-key"),
        F.col("o_orderstatus").alias("user"),
        F.col("o_totalprice").alias("total$price"),
    )
    return clean_names(o)


def q_join_with_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders to customers on keys cast to text on both sides."""
    o = fx.table(spark, sf_dir, "orders")
    c = fx.table(spark, sf_dir, "customer")
    cond = join_condition([("c_custkey", "o_custkey", "string")], o, c)
    return o.join(c, cond, "inner").select("o_orderkey", "o_custkey", "c_custkey", "c_name")


def _events_with_null_users(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    return e.withColumn("user_id", F.when(F.col("event_id") % 9 == 0, F.lit(None)).otherwise(F.col("user_id")))


def q_null_key_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5 / A3: NULL join keys counted on both sides in one pass per side."""
    return null_key_report(
        _events_with_null_users(spark, sf_dir),
        fx.table(spark, sf_dir, "customer"),
        [("c_custkey", "user_id"), ("c_mktsegment", "event_type")],
    )


def q_time_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event time -> date text, hour text, business-local (Sydney) time."""
    e = fx.table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        date_text(F.col("ts")).alias("day"),
        hour_text(F.col("ts")).alias("hour"),
        key_timestamp_text(local_time(F.col("ts"))).alias("local_ts"),
    )


def q_row_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test-mode row cap (first 100 orders by key)."""
    return row_cap(fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), 100, ["o_orderkey"])


def q_value_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probes for a present and an absent market segment."""
    c = fx.table(spark, sf_dir, "customer")
    a = value_exists(c, "c_mktsegment", "BUILDING").select(F.lit("BUILDING").alias("value"), "value_exists")
    b = value_exists(c, "c_mktsegment", "NO_SUCH_SEGMENT").select(F.lit("NO_SUCH_SEGMENT").alias("value"), "value_exists")
    return a.unionByName(b)


def q_uniqueness_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 / Q2 / Q3 / Q4: several checks on lineitem as one report."""
    li = fx.table(spark, sf_dir, "lineitem")
    return combine_checks(
        [
            unique_columns("unique_l_orderkey", li, ["l_orderkey"]),
            unique_columns("unique_l_orderkey_l_linenumber", li, ["l_orderkey", "l_linenumber"]),
            expect_no_rows("no_nonpositive_quantity", li.filter(F.col("l_quantity") <= 0)),
            expect_rows("records_exist", li),
        ]
    )


def q_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: order keys of lineitem that occur more than once, with their counts."""
    return duplicate_keys(fx.table(spark, sf_dir, "lineitem"), ["l_orderkey"])


def q_count_per_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: the same query (row count) for every table."""
    return for_each_table({t: fx.table(spark, sf_dir, t) for t in TABLES}, row_count)


def q_table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: row count, NULL count, min / max per column of every table."""
    return for_each_table({t: fx.table(spark, sf_dir, t) for t in TABLES}, table_stats)


QUERIES = {
    "common_projection": q_common_projection,
    "mapped_projection": q_mapped_projection,
    "align_columns": q_align_columns,
    "add_column_default": q_add_column_default,
    "conform_to_spec": q_conform_to_spec,
    "clean_names": q_clean_names,
    "join_with_cast": q_join_with_cast,
    "null_key_report": q_null_key_report,
    "time_buckets": q_time_buckets,
    "row_cap": q_row_cap,
    "value_exists": q_value_exists,
    "uniqueness_report": q_uniqueness_report,
    "duplicate_keys": q_duplicate_keys,
    "count_per_table": q_count_per_table,
    "table_stats": q_table_stats,
}

# --------------------------------------------------------------------------- oracles

# Column kinds of the driver's tables (num / text / time / other), for the table_stats oracle.
_SCHEMAS = {
    "region": [("r_regionkey", "num"), ("r_name", "text")],
    "nation": [("n_nationkey", "num"), ("n_name", "text"), ("n_regionkey", "num")],
    "customer": [("c_custkey", "num"), ("c_name", "text"), ("c_nationkey", "num"), ("c_acctbal", "num"), ("c_mktsegment", "text")],
    "supplier": [("s_suppkey", "num"), ("s_name", "text"), ("s_nationkey", "num"), ("s_acctbal", "num")],
    "part": [("p_partkey", "num"), ("p_name", "text"), ("p_brand", "text"), ("p_type", "text"), ("p_size", "num"), ("p_retailprice", "num")],
    "orders": [("o_orderkey", "num"), ("o_custkey", "num"), ("o_orderstatus", "text"), ("o_totalprice", "num"), ("o_orderdate", "time"), ("o_orderpriority", "text")],
    "lineitem": [
        ("l_orderkey", "num"), ("l_partkey", "num"), ("l_suppkey", "num"), ("l_linenumber", "num"), ("l_quantity", "num"),
        ("l_extendedprice", "num"), ("l_discount", "num"), ("l_tax", "num"), ("l_returnflag", "text"), ("l_linestatus", "text"), ("l_shipdate", "time"),
    ],
    "events": [("event_id", "num"), ("ts", "time"), ("user_id", "num"), ("event_type", "text"), ("value", "num"), ("props", "text")],
    "documents": [("doc_id", "num"), ("text", "text"), ("lang", "text"), ("source", "text"), ("n_chars", "num")],
    "embeddings": [("vec_id", "num"), ("embedding", "other"), ("label", "num")],
    "pages": [("page_id", "num"), ("url", "text"), ("html", "text")],
    "benchmark": [("item_id", "num"), ("text", "text")],
    "labels": [("doc_id", "num"), ("quality", "num"), ("toxic", "num")],
    "conversations": [("conv_id", "num"), ("turn", "num"), ("role", "text"), ("text", "text")],
}


def _stats_sql() -> str:
    parts = []
    for t, cols in _SCHEMAS.items():
        for c, k in cols:
            q = f'"{c}"'
            if k == "num":
                mn, mx = f"min(cast({q} as double))", f"max(cast({q} as double))"
                tn, tx = "cast(null as varchar)", "cast(null as varchar)"
            elif k == "text":
                mn = mx = "cast(null as double)"
                tn, tx = f"min({q})", f"max({q})"
            elif k == "time":
                mn = mx = "cast(null as double)"
                tn, tx = f"strftime(min({q}), {_TS})", f"strftime(max({q}), {_TS})"
            else:
                mn = mx = "cast(null as double)"
                tn = tx = "cast(null as varchar)"
            parts.append(
                f"select '{t}' as table_name, '{c}' as column_name, count(*) as row_count, "
                f"count(*) - count({q}) as null_count, {mn} as min_num, {mx} as max_num, {tn} as min_text, {tx} as max_text from {t}"
            )
    return "\nunion all ".join(parts)


_SYD = "strftime((ts at time zone 'UTC') at time zone 'Australia/Sydney', " + _TS + ")"
_EV = "(select event_id, case when event_id % 9 = 0 then null else user_id end as user_id, event_type from events)"

ORACLES = {
    "common_projection": 'select o_orderkey as "O_OrderKey", o_custkey as "O_CUSTKEY", o_orderstatus as "o_OrderStatus", o_totalprice as "O_TotalPrice" from orders',
    "mapped_projection": "select o_orderkey as order_id, o_totalprice as amount, o_orderstatus as status from orders",
    "align_columns": f"""with t as (select o_orderkey, o_custkey, o_orderstatus, timestamp '2024-01-01 00:00:00' as etl_updated_timestamp,
    false as etl_deleted_flag, cast(null as double) as o_totalprice, cast(null as varchar) as o_orderpriority from orders where o_orderkey % 3 <> 0),
s as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders where o_orderkey % 5 = 0 or o_orderkey % 3 = 0),
r as (select * from t where o_orderkey not in (select o_orderkey from s)
  union all select o_orderkey, o_custkey, o_orderstatus, timestamp '{AS_OF}', false, o_totalprice, o_orderpriority from s)
select o_orderkey, o_custkey, o_orderstatus, strftime(etl_updated_timestamp, {_TS}) as etl_updated_timestamp, etl_deleted_flag, o_totalprice, o_orderpriority from r""",
    "add_column_default": "select *, false as p_is_valid, 'n/a' as p_note, cast(null as integer) as p_rank from part",
    "conform_to_spec": f"""select o_orderkey, cast(o_custkey as varchar) as o_custkey, cast(o_totalprice as decimal(18,2)) as o_totalprice,
  strftime(o_orderdate, {_TS}) as o_orderdate, o_orderstatus, cast(o_custkey as varchar) as o_extra, o_orderpriority, false as o_ship_ok,
  strftime(timestamp '{AS_OF}', {_TS}) as etl_updated_timestamp, false as etl_deleted_flag from orders""",
    "clean_names": 'select o_orderkey as order_key, o_custkey as cust_key, o_orderstatus as "user", o_totalprice as total_price from orders',
    "join_with_cast": "select o.o_orderkey, o.o_custkey, c.c_custkey, c.c_name from orders o join customer c on cast(o.o_custkey as varchar) = cast(c.c_custkey as varchar)",
    "null_key_report": f"""select 'left' as side, 'user_id' as key_column, count(*) - count(user_id) as null_rows from {_EV}
union all select 'left', 'event_type', count(*) - count(event_type) from {_EV}
union all select 'right', 'c_custkey', count(*) - count(c_custkey) from customer
union all select 'right', 'c_mktsegment', count(*) - count(c_mktsegment) from customer""",
    "time_buckets": f"select event_id, substr(cast(ts as varchar), 1, 10) as day, substr(cast(ts as varchar), 1, 13) || ':00:00' as hour, {_SYD} as local_ts from events",
    "row_cap": "select o_orderkey, o_custkey, o_totalprice from orders order by o_orderkey limit 100",
    "value_exists": """select 'BUILDING' as value, count(*) > 0 as value_exists from customer where c_mktsegment = 'BUILDING'
union all select 'NO_SUCH_SEGMENT', count(*) > 0 from customer where c_mktsegment = 'NO_SUCH_SEGMENT'""",
    "uniqueness_report": """select 'unique_l_orderkey' as test, count(*) = 0 as passed, count(*) as violations from (select l_orderkey from lineitem group by l_orderkey having count(*) > 1)
union all select 'unique_l_orderkey_l_linenumber', count(*) = 0, count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
union all select 'no_nonpositive_quantity', count(*) = 0, count(*) from lineitem where l_quantity <= 0
union all select 'records_exist', count(*) > 0, case when count(*) = 0 then 1 else 0 end from lineitem""",
    "duplicate_keys": "select l_orderkey, count(*) as n from lineitem group by l_orderkey having count(*) > 1",
    "count_per_table": "\nunion all ".join(f"select '{t}' as table_name, count(*) as row_count from {t}" for t in TABLES),
    "table_stats": _stats_sql(),
}
