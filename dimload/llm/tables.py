"""Tables in the shared folder, and rows numbered in order."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimload.session import scratch_path


#: Since Spark 4.1 the name without "classic" is one of Spark Connect alone and does nothing here.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def without_leftovers(spark: SparkSession) -> Iterator[None]:
    """Queries run inside remove their shuffle files as they end; else those stay until the driver happens to
    collect its garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def saved(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder (at ``path``, if given): lineage ends there, so the shuffle files
    behind it are removed."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    with without_leftovers(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, tree: str, *order: Column) -> DataFrame:
    """``rows`` with idx, the place in its tree's order, and n, the tree's size.

    Rows are range-partitioned and sorted; the sizes of a tree's pieces give each piece its base, so
    no tree is sorted by one task."""
    ordered = rows.repartitionByRange(F.col(tree), *order).sortWithinPartitions(F.col(tree), *order)
    placed = saved(ordered.withColumn("at", F.monotonically_increasing_id()).withColumn("piece", F.spark_partition_id()), "ordered")
    pieces = placed.groupBy(tree, "piece").agg(F.count("*").alias("size"), F.min("at").alias("first"))  # pieces and trees at most
    whole = Window.partitionBy(tree)
    base = F.sum("size").over(whole.orderBy("piece")) - F.col("size") - F.col("first")
    pieces = saved(pieces.select(tree, "piece", base.alias("base"), F.sum("size").over(whole).alias("n")), "pieces")
    return placed.join(pieces, [tree, "piece"]).withColumn("idx", F.col("at") + F.col("base")).drop("at", "piece", "base")
