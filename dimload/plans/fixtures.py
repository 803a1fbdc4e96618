"""Fixtures derived from the driver's tables (customer, orders, ...), shared by queries and tests.

Every fixture is a projection / filter of a whole driver table, so its work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimload.functions.columns import ts_ntz
from dimload.operators.scd import ScdSpec

AS_OF_1 = "2024-01-01 00:00:00.000001"
AS_OF_2 = "2024-06-01 12:00:00.123456"
LOAD_AS_OF = "2024-03-15 08:30:45"

SCD_SPEC = ScdSpec(
    business_keys=("cid",),
    scd2_columns=("seg",),
    surrogate_key="sk",
    current_col="cur",
    start_col="st",
    end_col="en",
    update_col="up",
)
SCD_OUT = ["cid", "name", "seg", "bal", "cur", "st", "en", "up", "sk"]
SCD_TS = ("st", "en", "up")


_READERS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table (read-only input). The reader is reused within a session so its parquet
    footer / schema is resolved once, not once per query."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _READERS:
        _READERS[key] = spark.read.parquet(path)
    return _READERS[key]


def scd_source_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 1: every 4th customer left out, so batch 2 has new keys."""
    return scd_source_all(spark, sf_dir).filter(F.col("cid") % 4 != 0)


def scd_source_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer: a first load."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cid"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("seg"),
        F.col("c_acctbal").alias("bal"),
    )


def scd_source_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 2: type-2 changes (%7, %17 -> NULL), type-1 changes (%5, %19 -> NULL), %11 absent (but for those
    that batch 1 left out), %13 re-keyed. The two batches together read every customer."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").filter((k % 11 != 0) | (k % 4 == 0)).select(
        F.when(k % 13 == 0, k + 1000000).otherwise(k).alias("cid"),
        F.col("c_name").alias("name"),
        F.when(k % 17 == 0, F.lit(None).cast("string"))
        .when(k % 7 == 0, F.concat(F.col("c_mktsegment"), F.lit("_X")))
        .otherwise(F.col("c_mktsegment"))
        .alias("seg"),
        F.when(k % 5 == 0, F.col("c_acctbal") + 1)
        .when(k % 19 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("c_acctbal"))
        .alias("bal"),
    )


def default_member(spark: SparkSession, dim: DataFrame) -> DataFrame:
    """The unknown member (cid -1, sk -1) shaped like ``dim``."""
    values = {
        "cid": F.lit(-1).cast("bigint"),
        "name": F.lit("n/a"),
        "seg": F.lit("n/a"),
        "bal": F.lit(0.0).cast("double"),
        "cur": F.lit(True),
        "st": ts_ntz("1970-01-01 00:00:00"),
        "en": ts_ntz("2400-01-01 00:00:00"),
        "sk": F.lit(-1).cast("bigint"),
    }
    one = spark.range(1)
    return one.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in dim.schema.fields])


def history_rows(spark: SparkSession, sf_dir: str, dim: DataFrame) -> DataFrame:
    """History variant: an expired 'OLD' version (1960-01-01 .. 1969-12-31) for every customer % 3 = 0."""
    c = table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 3 == 0)
    values = {
        "cid": F.col("c_custkey"),
        "name": F.col("c_name"),
        "seg": F.lit("OLD"),
        "bal": F.col("c_acctbal"),
        "cur": F.lit(False),
        "st": ts_ntz("1960-01-01 00:00:00"),
        "en": ts_ntz("1969-12-31 00:00:00"),
    }
    return c.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in dim.schema.fields])


def ts_text(df: DataFrame, cols=SCD_TS, out=None) -> DataFrame:
    """Render timestamp columns as text (microseconds) for checked outputs."""
    from dimload.functions.columns import key_timestamp_text

    sel = []
    for c in (out or df.columns):
        sel.append(key_timestamp_text(F.col(c)).alias(c) if c in cols else F.col(c))
    return df.select(*sel)


LINE_SPEC = ScdSpec(
    business_keys=("l_orderkey", "l_linenumber"),
    scd2_columns=("l_returnflag", "l_linestatus"),
    surrogate_key="line_sk",
)
LINE_OUT = [
    "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
    "etl_updated_timestamp", "row_effective_timestamp", "row_expiry_timestamp", "row_update_timestamp",
    "row_current_flag", "line_sk",
]
LINE_TS = ("etl_updated_timestamp", "row_effective_timestamp", "row_expiry_timestamp", "row_update_timestamp")


def line_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a core table: one row per (l_orderkey, l_linenumber), derived from the whole
    lineitem table (the generated lineitem repeats that pair, a core table may not)."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey", "l_linenumber").agg(
        F.sum("l_quantity").alias("l_quantity"),
        F.round(F.sum("l_extendedprice"), 2).alias("l_extendedprice"),
        F.max("l_returnflag").alias("l_returnflag"),
        F.max("l_linestatus").alias("l_linestatus"),
        F.max("l_shipdate").alias("l_shipdate"),
    )


def line_source_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-line dimension, batch 1: orders with o_orderkey % 5 = 0 not yet known."""
    li = line_core(spark, sf_dir)
    return li.filter(F.col("l_orderkey") % 5 != 0).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
        F.col("l_shipdate").alias("etl_updated_timestamp"),
    )


def line_source_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 2: first lines of even orders change return flag (type 2), second lines change
    quantity (type 1), every etl stamp moves (ignored), orders % 7 = 0 absent (but for those that
    batch 1 left out)."""
    li = line_core(spark, sf_dir)
    return li.filter((F.col("l_orderkey") % 7 != 0) | (F.col("l_orderkey") % 5 == 0)).select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") == 2, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")).alias("l_quantity"),
        "l_extendedprice",
        F.when((F.col("l_linenumber") == 1) & (F.col("l_orderkey") % 2 == 0), F.lit("X")).otherwise(F.col("l_returnflag")).alias("l_returnflag"),
        "l_linestatus",
        F.date_add(F.col("l_shipdate"), 1).cast("timestamp_ntz").alias("etl_updated_timestamp"),
    )
