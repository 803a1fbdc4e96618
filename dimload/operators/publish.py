"""Loads on storage: SCD batches, load strategies and keyed loads over versioned Parquet tables.

All of them write through :mod:`dimload.sources.versions`: the files of a load count from the moment its
commit is there, and a load that fails at any step leaves the table as it was.

A dimension is partitioned by the current flag and by a hash of the business key into buckets
(``dim_bucket``; their number is kept with the table). A batch reads the buckets that its keys fall
into, and replaces only files of current rows that it changed: their other rows are written again, with
the retired rows and the new versions. History files are never replaced.

Order of the steps in :func:`run_scd_batch` and why a re-run after a crash is safe:

1. keys are appended first: a re-run looks the same ``bk || start`` up, finds them and reuses their
   numbers, so no key is handed out twice;
2. key-map rows are whatever the keys table has and the map lacks, so rows lost to a crash between
   the two appends come with the next run;
3. the batch's rows are written and committed: the switch;
4. the ledger row marks the batch done; a batch found in the ledger is skipped.

A crash between 3 and 4 leaves the batch in effect and unmarked; loading it again changes nothing.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimload import constants as C
from dimload.operators.keys import KEY_PREFIX, empty_keys, generate_keys, key_prefix, keys_to_map, with_key
from dimload.operators.quality import CheckFailed, combine_checks, run_checks, unique_columns
from dimload.operators.schema import align_columns
from dimload.operators.scd import ScdResult, ScdSpec, scd_checks, scd_load
from dimload.session import materialize, remove_path, scratch_path
from dimload.sources.ledger import LEDGER_SCHEMA, ledger_rows, value_exists
from dimload.sources.versions import FILE_COL, MAX_REPLACED, Version, commit_load, current_version, read_or_none, read_table, read_version

BUCKET_COL, BUCKETS = "dim_bucket", 64


def bucket_of(spec: ScdSpec, types: dict[str, T.DataType], buckets: int) -> Column:
    """The bucket of a business key, as the dimension's types write it."""
    keys = [F.col(f"`{k}`").cast(types[k.lower()]).cast("string") for k in spec.business_keys]
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _types(schema: T.StructType) -> dict[str, T.DataType]:
    return {f.name.lower(): f.dataType for f in schema.fields}


def read_dimension(spark: SparkSession, path: str, spec: ScdSpec) -> DataFrame | None:
    """The dimension as of its newest batch, with the columns of all batches."""
    dim = read_or_none(spark, path)
    return None if dim is None else dim.drop(BUCKET_COL)


def _write_dimension(rows: DataFrame, spec: ScdSpec, path: str, before: Version | None, replaced: Sequence[str] | None, buckets: int, highest: int | None) -> None:
    """Commit rows of a dimension, each bucket's current rows and history rows by one task."""
    flag = F.coalesce(F.col(f"`{spec.current_col}`"), F.lit(False))
    types = _types(before.schema if before else rows.schema)
    rows = rows.withColumn(spec.current_col, flag).withColumn(BUCKET_COL, bucket_of(spec, types, buckets))
    parts = [spec.current_col, BUCKET_COL]
    commit_load(rows.repartition(*parts), path, before, parts, replaced, {"buckets": buckets, "highest": highest})


def initialize_dimension(dim: DataFrame, spec: ScdSpec, dim_path: str, buckets: int = BUCKETS) -> None:
    """Write an existing dimension (e.g. just the default member) as a stored one."""
    _write_dimension(dim, spec, dim_path, current_version(dim.sparkSession, dim_path), None, buckets, None)


def publish_dimension(result: ScdResult, spec: ScdSpec, dim_path: str, before: Version | None, buckets: int, highest: int | None = None) -> None:
    """Write one SCD batch over version ``before``: the files that hold rows the batch changed are
    replaced by their other rows, and the retired rows and new versions come with them."""
    steps = result.steps
    if before is None or not before.notes or FILE_COL not in steps.dim.columns:
        _write_dimension(result.dimension.drop(FILE_COL), spec, dim_path, before, None, buckets, highest)
        return
    spark = result.dimension.sparkSession
    names = steps.joined.filter(F.col("_c1") | F.col("_c2")).select(FILE_COL).distinct()
    names = [r[0] for r in names.limit(MAX_REPLACED + 1).collect()]
    if len(names) > MAX_REPLACED:  # so many that the table's rows are written once more, all of them
        whole = read_version(spark, dim_path, before, files=True).join(steps.dim.select(FILE_COL).distinct(), FILE_COL, "left_anti")
        rows = result.dimension.drop(FILE_COL)
        rows = rows.unionByName(align_columns(whole.drop(BUCKET_COL, FILE_COL), rows, exclude=()))
        _write_dimension(rows, spec, dim_path, before, None, buckets, highest)
        return
    sk = F.col(f"`{spec.surrogate_key}`")
    inside = F.col(FILE_COL).isin(names) if names else F.lit(False)
    defaults = steps.dim.filter(((sk < 0) | sk.isNull()) & inside)
    current = steps.kept.filter((sk >= 0) & F.col(f"`{spec.current_col}`") & inside)
    retired = steps.retired.filter(sk >= 0)
    rows = defaults.unionByName(current).unionByName(retired).unionByName(result.versions)
    _write_dimension(rows.drop(FILE_COL), spec, dim_path, before, names, buckets, highest)


def read_keys(spark: SparkSession, path: str, version: Version | None) -> DataFrame | None:
    """A stored keys table, with the prefix that it is partitioned by if all of its files are."""
    if version is None:
        return None
    keys = read_version(spark, path, version)
    return keys.drop(KEY_PREFIX) if version.plain else keys


def highest_stored(keys: DataFrame | None, version: Version | None, sk: str) -> int:
    """The largest number of a stored keys table: what its commit says, or by a scan where none does."""
    if version is not None and version.notes:
        return version.notes["highest"]
    return (keys.agg(F.max(sk)).head()[0] or 0) if keys is not None else 0


def append_keys(spark: SparkSession, new_keys: DataFrame, sk: str, keys_path: str, map_path: str) -> None:
    """K2 + K3 on storage: append the keys, then the map rows that the map lacks: those of the keys' loads
    that the map's last commit doesn't know of, so neither table is read for it."""
    before = current_version(spark, keys_path)
    newest = new_keys.agg(F.max(sk)).head()[0]
    after = before
    if newest is not None or before is None:
        highest = max(highest_stored(read_keys(spark, keys_path, before), before, sk), newest or 0)
        tagged = new_keys.withColumn(KEY_PREFIX, key_prefix(F.col(C.KEYS_BUSINESS_KEY)))
        after = commit_load(tagged.repartition(KEY_PREFIX), keys_path, before, [KEY_PREFIX], (), {"highest": highest})
    have = current_version(spark, map_path)
    if have is not None and have.notes:
        missing = keys_to_map(read_version(spark, keys_path, after, after=have.notes["keys"]), sk)
    else:
        missing = keys_to_map(read_version(spark, keys_path, after), sk)
        if have is not None:
            missing = missing.join(read_version(spark, map_path, have).select(sk), sk, "left_anti")
    if have is None or not have.notes or have.notes["keys"] != after.number:
        commit_load(missing, map_path, have, (), (), {"keys": after.number})


def is_done(spark: SparkSession, ledger_path: str, update_id: str) -> bool:
    ledger = read_or_none(spark, ledger_path, LEDGER_SCHEMA)
    return ledger is not None and value_exists(ledger, "update_id", update_id).first()["value_exists"]


def record_done(spark: SparkSession, ledger_path: str, update_id: str, as_of, related: str) -> None:
    done = spark.range(1).select(F.lit(update_id).alias("update_id"))
    ledger_rows(done, "update_id", as_of, related).write.mode("append").parquet(ledger_path)


def run_scd_batch(
    spark: SparkSession,
    source: DataFrame,
    spec: ScdSpec,
    as_of,
    batch_id: str,
    dim_path: str,
    keys_path: str,
    map_path: str,
    ledger_path: str,
    checks: bool = True,
    buckets: int = BUCKETS,
) -> str:
    """D8 end to end on storage: skip if done, load, check, append keys, publish, record.

    ``buckets`` is the number of buckets of a dimension that is stored for the first time. Returns
    ``'skipped'`` or ``'published'``; raises :class:`CheckFailed` (nothing published, keys untouched)
    when the batch breaks a dimension invariant, when a new version would share a surrogate key, or
    when the dimension has surrogate keys but the keys table is gone.
    """
    update_id = f"scd_{spec.surrogate_key}_{batch_id}"
    if is_done(spark, ledger_path, update_id):
        return "skipped"
    sk = F.col(f"`{spec.surrogate_key}`")
    before = current_version(spark, dim_path)
    stored_keys = current_version(spark, keys_path)
    keys = read_keys(spark, keys_path, stored_keys)
    dim = None if before is None else read_version(spark, dim_path, before, files=True)
    if keys is None and dim is not None and not dim.filter(sk >= 0).isEmpty():
        raise CheckFailed(f"the dimension has surrogate keys, but there is no keys table at {keys_path}")
    source = materialize(source)
    highest = _highest(spec, before, dim, keys, stored_keys)
    if before is not None and before.notes:
        buckets = before.notes["buckets"]
        bucket = bucket_of(spec, _types(before.schema), buckets)
        read = [r[0] for r in source.select(bucket.alias("b")).distinct().collect()]  # as many as buckets at most
        dim = dim.filter(F.col(BUCKET_COL).isin(read)) if read else dim.filter(F.lit(False))
    dim = None if dim is None else dim.drop(BUCKET_COL)
    result = scd_load(dim, source, spec, as_of, keys=keys, highest=highest, source_staged=True)
    result.versions = materialize(result.versions)
    if checks:
        _check_batch(result, spec)
    append_keys(spark, materialize(result.new_keys), spec.surrogate_key, keys_path, map_path)
    newest = result.versions.agg(F.max(sk)).head()[0]
    publish_dimension(result, spec, dim_path, before, buckets, max(highest or 0, newest or 0))
    record_done(spark, ledger_path, update_id, as_of, spec.surrogate_key)
    return "published"


def _highest(spec: ScdSpec, before: Version | None, dim: DataFrame | None, keys: DataFrame | None, stored_keys: Version | None) -> int | None:
    """The largest surrogate key handed out, of keys table and dimension: their commits tell, and a table
    without one is scanned."""
    if before is None and stored_keys is None:
        return None
    known = (before.notes or {}).get("highest") if before else 0
    if known is None:
        known = dim.agg(F.max(F.col(f"`{spec.surrogate_key}`"))).head()[0] or 0
    return max(0, known, highest_stored(keys, stored_keys, spec.surrogate_key))


def _check_batch(result: ScdResult, spec: ScdSpec) -> None:
    """The dimension's invariants over what the batch can have broken."""
    touched = materialize(result.steps.touched)
    sk = F.col(f"`{spec.surrogate_key}`")
    live = touched.filter(F.col(f"`{spec.current_col}`") & (sk >= 0)).select(sk).unionByName(result.versions.select(sk))
    report = combine_checks([scd_checks(touched, spec), unique_columns("unique_current_surrogate_key", live, [spec.surrogate_key])])
    failed = run_checks(report)
    if failed:
        raise CheckFailed("dimension checks failed: " + ", ".join(f"{r.test} ({r.violations})" for r in failed))


# ------------------------------------------------------------------------------------------------
# Load strategies on storage: rewrite only what a load touches
# ------------------------------------------------------------------------------------------------


def load_into(
    target_path: str,
    source: DataFrame,
    strategy: str,
    join_keys,
    as_of,
    partition_cols=None,
    delete_condition=None,
    load_constraint=None,
    full_record_comparison_source: DataFrame | None = None,
    source_columns=None,
    target_columns=None,
) -> DataFrame:
    """L1-L5 applied to a parquet table at ``target_path``; returns the table as read back.

    * ``insert`` adds the new rows in files of their own (nothing is rewritten).
    * ``upsert`` / ``refresh_by_keys``: the files that hold a row whose key the source replaces are
      found first; only their rows are read whole, and only those files are replaced. A partition
      whose rows all move away is gone with its files.
    * ``full`` and ``refresh`` touch every row and rewrite the table.

    The load counts from its commit on; if it fails before, the table is as it was. Columns that only
    the source has come with the load: rows of older files read NULL, or false for flags. The source
    is staged once; staging folders are removed afterwards.
    """
    from dimload.operators.loads import align_target, insert_rows, key_matches, load

    spark = source.sparkSession
    stage = scratch_path(spark, "load_into")
    source.write.parquet(f"{stage}/source")
    source = spark.read.schema(source.schema).parquet(f"{stage}/source")
    parts = list(partition_cols or [])
    before = current_version(spark, target_path, parts, source.schema)
    if before is None:
        raise FileNotFoundError(f"no table at {target_path}")
    columns = dict(source_columns=source_columns, target_columns=target_columns)

    def aligned(rows: DataFrame) -> DataFrame:
        return align_target(rows, source, target_columns)

    target = aligned(read_version(spark, target_path, before))
    replaced: list[str] | None = None
    if strategy == "insert":
        rows, replaced = insert_rows(target, source, as_of, load_constraint, **columns), []
    elif strategy in ("upsert", "refresh_by_keys"):
        holding = key_matches(read_version(spark, target_path, before, files=True), source, join_keys, delete_condition)
        names = [r[0] for r in holding.select(FILE_COL).distinct().limit(MAX_REPLACED + 1).collect()]
        if len(names) <= MAX_REPLACED:
            replaced = names
            target = aligned(read_version(spark, target_path, before, only=names))
        rows = load(target, source, strategy, join_keys, as_of, delete_condition, load_constraint, **columns)
    else:
        rows = load(target, source, strategy, join_keys, as_of, delete_condition, load_constraint, full_record_comparison_source, **columns)
    commit_load(rows, target_path, before, parts, replaced)
    remove_path(spark, stage)
    return read_table(spark, target_path)


def keyed_load_into(
    spark: SparkSession,
    update_id: str,
    target_path: str,
    keys_path: str,
    map_path: str,
    ledger_path: str,
    source: DataFrame | None,
    sk: str,
    business_key: str,
    key_name: str,
    source_system: str,
    as_of,
    strategy: str = "upsert",
    key_source: DataFrame | None = None,
    load_source: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
) -> str:
    """L6-L8 on storage: new keys are appended, then the map rows the map lacks, then the load
    strategy rewrites the target, then the ledger marks the load done.

    A re-run after a crash finds the appended keys and reuses them, adds missing map rows, and loads
    again with the same result; a load found in the ledger is skipped. Returns ``'skipped'`` or
    ``'published'``.
    """
    if is_done(spark, ledger_path, update_id):
        return "skipped"
    stored = current_version(spark, keys_path)
    keys = read_keys(spark, keys_path, stored)
    highest = highest_stored(keys, stored, sk)
    keys = empty_keys(spark, sk) if keys is None else keys
    candidates = key_source if key_source is not None else source
    new = materialize(generate_keys(candidates, business_key, keys, sk, as_of, key_name, source_system, highest=highest))
    append_keys(spark, new, sk, keys_path, map_path)
    key_map = read_table(spark, map_path)
    if load_source is None:
        rows = with_key(source, key_map, sk, business_key, key_name, source_system)
    else:
        rows = load_source(key_map) if callable(load_source) else load_source
    load_into(target_path, rows, strategy, [[sk, sk]], as_of)
    record_done(spark, ledger_path, update_id, as_of, sk)
    return "published"
