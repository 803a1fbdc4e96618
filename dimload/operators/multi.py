"""Multi-table operators (M1, M2): the same query for every table, table statistics.

Each table is aggregated by its own distributed pass; the per-table results (one or a few rows
each) are combined with ``unionByName`` into one small frame.
"""

from __future__ import annotations

from typing import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def for_each_table(tables: Mapping[str, DataFrame], sql_to_run: Callable[[str, DataFrame], DataFrame]) -> DataFrame:
    """M1: ``sql_to_run(name, table)`` for every table, results combined (union by name)."""
    out = None
    for name, df in tables.items():
        r = sql_to_run(name, df)
        out = r if out is None else out.unionByName(r, allowMissingColumns=True)
    return out


def catalog_tables(spark: SparkSession, databases: str | list[str] | None = None) -> dict[str, DataFrame]:
    """Tables of the given catalog databases (comma list) as DataFrames, keyed by ``db.table``."""
    if databases is None:
        dbs = [spark.catalog.currentDatabase()]
    elif isinstance(databases, str):
        dbs = [d.strip() for d in databases.split(",") if d.strip()]
    else:
        dbs = list(databases)
    out = {}
    for db in dbs:
        for t in spark.catalog.listTables(db):
            if not t.isTemporary:  # session views are listed with every database
                out[f"{db}.{t.name}"] = spark.table(f"{db}.{t.name}")
    return out


def for_each_catalog_table(
    spark: SparkSession,
    databases: str | list[str] | None,
    sql_to_run: Callable[[str, DataFrame], DataFrame],
    pre_sql: str | None = None,
) -> DataFrame | None:
    """M1 over a catalog: optional statement first (``pre_sql``), then ``sql_to_run`` for every
    table of the comma-separated ``databases``; results combined."""
    if pre_sql:
        spark.sql(pre_sql)
    tables = catalog_tables(spark, databases)
    return for_each_table(tables, sql_to_run) if tables else None


def row_count(name: str, df: DataFrame) -> DataFrame:
    """M1 example: ``(table_name, row_count)``."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_TEXT = (T.StringType,)
_TIME = (T.TimestampType, T.TimestampNTZType, T.DateType)


def table_stats(name: str, df: DataFrame) -> DataFrame:
    """M2: per column ``(table_name, column_name, row_count, null_count, min_num, max_num,
    min_text, max_text)`` in one aggregation pass over the table.

    Numbers are compared as doubles, text and times as text (times rendered with microseconds);
    other types (arrays, structs) get counts only.
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    kinds = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        aggs.append(F.sum(F.when(c.isNull(), 1).otherwise(0)).alias(f"_n{i}"))
        if isinstance(f.dataType, _NUMERIC):
            v = c.cast("double")
            aggs += [F.min(v).alias(f"_a{i}"), F.max(v).alias(f"_b{i}")]
            kinds.append("num")
        elif isinstance(f.dataType, _TEXT):
            aggs += [F.min(c).alias(f"_a{i}"), F.max(c).alias(f"_b{i}")]
            kinds.append("text")
        elif isinstance(f.dataType, _TIME):
            aggs += [F.min(c).alias(f"_a{i}"), F.max(c).alias(f"_b{i}")]
            kinds.append("time")
        else:
            kinds.append("other")
    wide = df.agg(*aggs)
    rows = []
    for i, f in enumerate(df.schema.fields):
        k = kinds[i]
        num_a = F.col(f"_a{i}") if k == "num" else F.lit(None).cast("double")
        num_b = F.col(f"_b{i}") if k == "num" else F.lit(None).cast("double")
        if k == "text":
            txt_a, txt_b = F.col(f"_a{i}"), F.col(f"_b{i}")
        elif k == "time":
            txt_a = F.date_format(F.col(f"_a{i}"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
            txt_b = F.date_format(F.col(f"_b{i}"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
        else:
            txt_a = txt_b = F.lit(None).cast("string")
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.coalesce(F.col(f"_n{i}"), F.lit(0)).cast("bigint").alias("null_count"),
                num_a.alias("min_num"),
                num_b.alias("max_num"),
                txt_a.alias("min_text"),
                txt_b.alias("max_text"),
            )
        )
    return wide.select(F.col("_rows").alias("row_count"), F.explode(F.array(*rows)).alias("s")).select(
        F.lit(name).alias("table_name"),
        "s.column_name",
        "row_count",
        "s.null_count",
        "s.min_num",
        "s.max_num",
        "s.min_text",
        "s.max_text",
    )
