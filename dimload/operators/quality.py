"""Data checks and gated publish (Q1-Q7, A3, A4).

A check is a one-row DataFrame ``(test string, passed boolean, violations bigint)``; checks are
combined with ``unionByName`` so a whole gate is one small result (one row per test) computed by
distributed aggregates -- duplicate detection is a partial (map-side) aggregate, so a hot key
costs one row per partition before the shuffle.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimload import constants as C


class CheckFailed(RuntimeError):
    """Raised when a gate's checks fail; the target is left unchanged."""


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _report(name: str, violations: DataFrame, passed: Column) -> DataFrame:
    return violations.select(F.lit(name).alias("test"), passed.alias("passed"), F.col("violations").cast("bigint"))


def expect_no_rows(name: str, df: DataFrame) -> DataFrame:
    """Q1: passes when ``df`` is empty; ``violations`` = its row count."""
    v = df.agg(F.count(F.lit(1)).alias("violations"))
    return _report(name, v, F.col("violations") == 0)


def expect_rows(name: str, df: DataFrame) -> DataFrame:
    """Q2: passes when ``df`` has at least one row; ``violations`` is 1 when it is empty."""
    v = df.agg(F.count(F.lit(1)).alias("n")).select(F.when(F.col("n") == 0, 1).otherwise(0).alias("violations"))
    return _report(name, v, F.col("violations") == 0)


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A4: key combinations that occur more than once, with their count ``n``."""
    return df.groupBy(*[_q(c) for c in columns]).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def unique_columns(name: str, df: DataFrame, columns: Sequence[str], exclude_deleted: bool = False) -> DataFrame:
    """Q4: the column set is unique; ``violations`` = number of duplicated key combinations.

    ``exclude_deleted`` (P9) ignores soft-deleted rows.
    """
    if exclude_deleted:
        df = df.filter(_q(C.ETL_DELETED) == F.lit(False))
    v = duplicate_keys(df, columns).agg(F.count(F.lit(1)).alias("violations"))
    return _report(name, v, F.col("violations") == 0)


def combine_checks(checks: Sequence[DataFrame]) -> DataFrame:
    """Q3: several checks as one report; all must pass."""
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def null_key_counts(side: str, df: DataFrame, keys: Sequence[str], condition: Column | str | None = None) -> DataFrame:
    """A3: NULL count per key column in one pass: rows ``(side, key_column, null_rows)``."""
    if condition is not None:
        df = df.filter(F.expr(condition) if isinstance(condition, str) else condition)
    aggs = [F.sum(F.when(_q(k).isNull(), 1).otherwise(0)).cast("bigint").alias(f"k{i}") for i, k in enumerate(keys)]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{k}', coalesce(k{i}, 0)" for i, k in enumerate(keys))
    return wide.selectExpr(f"stack({len(keys)}, {stack}) as (key_column, null_rows)").select(
        F.lit(side).alias("side"), "key_column", F.col("null_rows").cast("bigint")
    )


def null_key_report(left: DataFrame, right: DataFrame, keys_definition: Sequence[Sequence[str]], condition=None) -> DataFrame:
    """Q5 / A3: NULL join keys on both sides of a J6 key list; nonzero ``null_rows`` = failure."""
    left_keys = [k[1] for k in keys_definition]
    right_keys = [k[0] for k in keys_definition]
    return null_key_counts("left", left, left_keys, condition).unionByName(null_key_counts("right", right, right_keys, condition))


def assert_no_null_keys(left: DataFrame, right: DataFrame, keys_definition, condition=None) -> None:
    """Q5 as a gate (opt-in): raise when any join key is NULL."""
    bad = null_key_report(left, right, keys_definition, condition).filter(F.col("null_rows") > 0).collect()
    if bad:
        raise CheckFailed("NULL join keys: " + ", ".join(f"{r.side}.{r.key_column}={r.null_rows}" for r in bad))


def assert_unique(df: DataFrame, columns: Sequence[str], what: str = "frame") -> None:
    """Q4 as an assertion: fail fast when ``columns`` repeat in ``df`` (one row fetched at most).
    Rows with a NULL in ``columns`` have no key and are not compared."""
    if duplicate_keys(df.dropna(subset=list(columns)), columns).limit(1).count() > 0:
        raise CheckFailed(f"{what}: columns {list(columns)} are not unique")


def run_checks(report: DataFrame) -> list:
    """Evaluate a check report (one small row per test) and return the failures."""
    return [r for r in report.collect() if not r.passed]


def standard_checks(
    df: DataFrame,
    unique_columnsets: Sequence[Sequence[str]] = (),
    records_exist: bool = False,
    exclude_deleted: bool = False,
    custom: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame | None:
    """Q6's list: custom test, uniqueness of each column set, records exist."""
    checks = []
    if custom is not None:
        checks.append(custom(df))
    for i, cols in enumerate(unique_columnsets):
        checks.append(unique_columns(f"unique_{'_'.join(cols)}", df, cols, exclude_deleted))
    if records_exist:
        checks.append(expect_rows("records_exist", df))
    return combine_checks(checks) if checks else None


def gated_publish(
    staged: DataFrame,
    publish: Callable[[DataFrame], object] | str,
    checks: Callable[[DataFrame], DataFrame | None] | None = None,
    post_step: Callable[[DataFrame], DataFrame] | None = None,
    stage_path: str | None = None,
) -> DataFrame:
    """Q6 + Q7: stage -> post step -> check -> publish, or leave the target alone and raise.

    The rows are written once to ``stage_path`` (default: under the shared checkpoint folder) after
    the post step, so that the checks and the publish read the same rows and never the target being
    replaced, also when the post step reads it. ``publish`` is a function of the rows, or the path of the
    stored table that they replace: then a publish that fails leaves the table as it was.
    """
    from dimload.session import scratch_path
    from dimload.sources.versions import replace_table

    spark = staged.sparkSession
    path = stage_path or scratch_path(spark, "gate")
    rows = staged if post_step is None else post_step(staged)
    rows.write.mode("overwrite").parquet(path)
    result = spark.read.schema(rows.schema).parquet(path)
    if checks is not None:
        report = checks(result)
        if report is not None:
            failed = run_checks(report)
            if failed:
                raise CheckFailed("checks failed: " + ", ".join(f"{r.test} ({r.violations})" for r in failed))
    if callable(publish):
        publish(result)
    else:
        replace_table(result, publish)
    return result
