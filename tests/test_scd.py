"""SCD type 1 + type 2 on small hand-made frames: edge cases and invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dimload.operators.quality import CheckFailed
from dimload.operators.scd import ScdSpec, cluster_by_key, publish_with_keys, scd_checks, scd_load, scd_steps
from dimload.session import staged

SPEC = ScdSpec(business_keys=("id",), scd2_columns=("seg",), surrogate_key="sk")
T1 = "2024-01-01 00:00:00"
T2 = "2024-02-01 10:00:00.5"
T3 = "2024-03-01 00:00:00"
END = dt.datetime(2400, 1, 1)


def src(spark, rows):
    return spark.createDataFrame(rows, "id bigint, name string, seg string, etl_updated_timestamp timestamp_ntz")


def first(spark, rows):
    r = scd_load(None, src(spark, rows), SPEC, T1)
    return r.dimension.cache(), r.new_keys.cache()


def by_id(df):
    return sorted([r.asDict() for r in df.collect()], key=lambda r: (r["id"] is None, r["id"] or 0, r["row_effective_timestamp"]))


def test_first_load_starts_1970_and_keys_are_dense(spark):
    dim, keys = first(spark, [(1, "a", "x", None), (2, "b", "y", None), (3, "c", "z", None)])
    rows = by_id(dim)
    assert [r["id"] for r in rows] == [1, 2, 3]
    assert {r["row_effective_timestamp"] for r in rows} == {dt.datetime(1970, 1, 1)}
    assert {r["row_expiry_timestamp"] for r in rows} == {END}
    assert all(r["row_current_flag"] for r in rows)
    assert sorted(r["sk"] for r in rows) == [1, 2, 3]
    # etl_updated_timestamp of inserted rows is the batch time
    assert {r["etl_updated_timestamp"] for r in rows} == {dt.datetime(2024, 1, 1)}
    assert keys.count() == 3


def test_type2_change_retires_and_inserts(spark):
    dim, keys = first(spark, [(1, "a", "x", None), (2, "b", "y", None)])
    r = scd_load(dim, src(spark, [(1, "a", "x2", None), (2, "b", "y", None)]), SPEC, T2, keys=keys)
    rows = by_id(r.dimension)
    one = [x for x in rows if x["id"] == 1]
    assert len(one) == 2
    old, new = one
    assert not old["row_current_flag"] and old["row_expiry_timestamp"] == dt.datetime(2024, 2, 1, 10, 0, 0, 500000)
    assert new["row_current_flag"] and new["seg"] == "x2"
    assert new["row_effective_timestamp"] == dt.datetime(2024, 2, 1, 10, 0, 0, 500001)
    assert new["sk"] == 3 and old["sk"] in (1, 2)
    assert [x["sk"] for x in rows if x["id"] == 2] == [y["sk"] for y in by_id(dim) if y["id"] == 2]


def test_type1_change_overwrites_in_place(spark):
    dim, keys = first(spark, [(1, "a", "x", None)])
    r = scd_load(dim, src(spark, [(1, "A", "x", None)]), SPEC, T2, keys=keys)
    rows = by_id(r.dimension)
    assert len(rows) == 1
    assert rows[0]["name"] == "A" and rows[0]["row_update_timestamp"] == dt.datetime(2024, 2, 1, 10, 0, 0, 500000)
    assert rows[0]["sk"] == by_id(dim)[0]["sk"]


def test_type1_and_type2_change_only_retires_new_version_carries_all(spark):
    dim, keys = first(spark, [(1, "a", "x", None)])
    r = scd_load(dim, src(spark, [(1, "A", "x2", None)]), SPEC, T2, keys=keys)
    old, new = by_id(r.dimension)
    assert old["name"] == "a" and old["row_update_timestamp"] is None and not old["row_current_flag"]
    assert new["name"] == "A" and new["seg"] == "x2"


def test_null_values_are_changes(spark):
    dim, keys = first(spark, [(1, "a", "x", None), (2, "b", None, None)])
    r = scd_load(dim, src(spark, [(1, None, "x", None), (2, "b", "y", None)]), SPEC, T2, keys=keys)
    rows = by_id(r.dimension)
    assert [x["name"] for x in rows if x["id"] == 1] == [None]
    assert len([x for x in rows if x["id"] == 2]) == 2


def test_etl_updated_only_change_is_ignored(spark):
    dim, keys = first(spark, [(1, "a", "x", dt.datetime(2020, 1, 1))])
    r = scd_load(dim, src(spark, [(1, "a", "x", dt.datetime(2023, 5, 5))]), SPEC, T2, keys=keys)
    assert by_id(r.dimension) == by_id(dim)


def test_absent_key_stays_current_and_rerun_is_idempotent(spark):
    dim, keys = first(spark, [(1, "a", "x", None), (2, "b", "y", None)])
    s2 = src(spark, [(1, "a", "x2", None)])
    r2 = scd_load(dim, s2, SPEC, T2, keys=keys)
    d2, k2 = r2.dimension.cache(), keys.unionByName(r2.new_keys).cache()
    assert [x["row_current_flag"] for x in by_id(d2) if x["id"] == 2] == [True]
    r3 = scd_load(d2, s2, SPEC, T3, keys=k2)
    assert by_id(r3.dimension) == by_id(d2)
    assert r3.new_keys.count() == 0


def test_key_with_only_expired_rows_comes_back(spark):
    hist = spark.createDataFrame(
        [(7, "h", "old", None, False, dt.datetime(1960, 1, 1), dt.datetime(1969, 12, 31), None, 5)],
        "id bigint, name string, seg string, etl_updated_timestamp timestamp_ntz, row_current_flag boolean, "
        "row_effective_timestamp timestamp_ntz, row_expiry_timestamp timestamp_ntz, row_update_timestamp timestamp_ntz, sk bigint",
    )
    r = scd_load(hist, src(spark, [(7, "h", "new", None)]), SPEC, T2, keys=None)
    rows = by_id(r.dimension)
    assert len(rows) == 2
    assert rows[1]["row_effective_timestamp"] == dt.datetime(1969, 12, 31, 0, 0, 0, 1)
    assert rows[1]["row_current_flag"] and rows[1]["sk"] == 6


def test_default_row_kept_and_null_key_dropped(spark):
    dim, keys = first(spark, [(1, "a", "x", None)])
    default = dim.limit(1).select(*[F.lit(-1).cast("bigint").alias("id") if c == "id" else (F.lit(-1).cast("bigint").alias("sk") if c == "sk" else F.col(c)) for c in dim.columns])
    dim = dim.unionByName(default).cache()
    r = scd_load(dim, src(spark, [(1, "a", "x", None), (None, "n", "x", None), (-1, "d", "x", None)]), SPEC, T2, keys=keys)
    rows = by_id(r.dimension)
    ids = [x["id"] for x in rows]
    assert None not in ids
    assert ids.count(-1) == 2  # the default row, untouched, plus a new version of key -1
    steps = scd_steps(dim, src(spark, [(None, "n", "x", None)]), SPEC, T2)
    assert steps.inserted.count() == 1  # staged, never published


def test_duplicate_source_keys_fail_fast(spark):
    dim, keys = first(spark, [(1, "a", "x", None)])
    with pytest.raises(CheckFailed):
        scd_load(dim, src(spark, [(1, "a", "x", None), (1, "b", "y", None)]), SPEC, T2, keys=keys, check_source_unique=True)


def test_compound_business_key(spark):
    spec = ScdSpec(business_keys=("a", "b"), scd2_columns=("v",), surrogate_key="sk")
    s1 = spark.createDataFrame([(1, "x", 10), (1, "y", 20)], "a int, b string, v int")
    r1 = scd_load(None, s1, spec, T1)
    s2 = spark.createDataFrame([(1, "x", 11), (1, "y", 20), (2, "x", 5)], "a int, b string, v int")
    r2 = scd_load(r1.dimension.cache(), s2, spec, T2, keys=r1.new_keys.cache())
    out = r2.dimension.collect()
    assert len(out) == 4
    assert sorted(x["sk"] for x in out) == [1, 2, 3, 4]


def test_invariants_and_checks(spark):
    dim, keys = first(spark, [(i, f"n{i}", f"s{i % 3}", None) for i in range(50)])
    s2 = src(spark, [(i, f"n{i}", f"s{(i + (i % 4 == 0)) % 3}", None) for i in range(10, 70)])
    r = scd_load(dim, s2, SPEC, T2, keys=keys)
    d = r.dimension.cache()
    cur = d.filter("row_current_flag").groupBy("id").count()
    assert cur.filter("count > 1").count() == 0
    # no overlapping intervals per key
    rows = by_id(d)
    by = {}
    for x in rows:
        by.setdefault(x["id"], []).append((x["row_effective_timestamp"], x["row_expiry_timestamp"]))
    for spans in by.values():
        spans.sort()
        for (s1, e1), (s2_, e2) in zip(spans, spans[1:]):
            assert e1 < s2_
    assert d.select("sk").distinct().count() == d.count()
    checks = scd_checks(r.steps.staged, SPEC).collect()
    assert all(c.passed for c in checks)


def test_lazy_and_materialized_agree_and_match_reference_publish(spark):
    dim, keys = first(spark, [(i, f"n{i}", f"s{i % 3}", None) for i in range(30)])
    dim = cluster_by_key(dim, SPEC).cache()
    s2 = src(spark, [(i, f"m{i}" if i % 5 == 0 else f"n{i}", f"s{(i + (i % 7 == 0)) % 3}", None) for i in range(5, 40)])
    a = scd_load(dim, s2, SPEC, T2, keys=keys, materialize=False)
    b = scd_load(dim, s2, SPEC, T2, keys=keys, materialize=True)
    assert by_id(a.dimension) == by_id(b.dimension)
    ref = publish_with_keys(a.steps.dim, a.steps.staged, keys.unionByName(a.new_keys), SPEC)
    assert by_id(ref) == by_id(a.dimension)


def test_new_versions_are_numbered_once(spark):
    """The dimension and the new keys read the same staged numbers, and only the columns that they use."""
    result = scd_load(None, src(spark, [(i, f"n{i}", "s", None) for i in range(500)]), SPEC, T1)
    for df in (result.versions, result.new_keys):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Window [" not in plan and "FileScan parquet" in plan
    read = result.new_keys._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    assert "_vkey" in read and "name:" not in read.splitlines()[0]
    numbers = {r["id"]: r["sk"] for r in result.dimension.collect()}
    assert sorted(numbers.values()) == list(range(1, 501))
    assert sorted(r["sk"] for r in result.new_keys.collect()) == list(range(1, 501))


def test_staged_types_that_parquet_has_not(spark):
    df = spark.sql("select 1 as a, null as b, interval '1' day as c")
    assert [tuple(r) for r in staged(df, "odd").select("a", "b").collect()] == [(1, None)]
    plain = staged(df.select("b", "a"), "odd")
    assert plain.dtypes == [("b", "void"), ("a", "int")] and plain.collect() == [(None, 1)]
