"""Dense surrogate keys: md5 order, offsets, stability, several source systems."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from dimload.operators.keys import assign_numbers, empty_keys, generate_keys, keys_to_map, with_key


def md5_order(values):
    return sorted(values, key=lambda v: (hashlib.md5(v.encode()).hexdigest(), v))


@pytest.mark.parametrize("bucket_hex", [1, 2, 3])
def test_numbering_equals_global_md5_order(spark, bucket_hex):
    random.seed(bucket_hex)
    vals = [str(random.randint(0, 10**9)) for _ in range(400)]
    df = spark.createDataFrame([(v,) for v in vals + vals[:50]], "k string")
    out = assign_numbers(df, "k", None, "n", bucket_hex=bucket_hex).collect()
    got = {r.k: r.n for r in out}
    want = {v: i + 1 for i, v in enumerate(md5_order(set(vals)))}
    assert got == want


def test_generate_keys_only_new_and_after_max(spark):
    k0 = generate_keys(spark.createDataFrame([(i,) for i in range(10)], "c int"), "c", empty_keys(spark, "sk"), "sk", "2024-01-01", "c", "core").cache()
    assert sorted(r.sk for r in k0.collect()) == list(range(1, 11))
    k1 = generate_keys(spark.createDataFrame([(i,) for i in range(5, 20)], "c int"), "c", k0, "sk", "2024-01-02", "c", "core").collect()
    assert sorted(r.originating_source_business_key for r in k1) == sorted(str(i) for i in range(10, 20))
    assert [r.originating_source_business_key for r in sorted(k1, key=lambda r: r.sk)] == md5_order([str(i) for i in range(10, 20)])
    assert sorted(r.sk for r in k1) == list(range(11, 21))
    assert all(r.active_flag is False for r in k1)


def test_several_source_systems(spark):
    u = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "v int, sys string")
    keys = generate_keys(u, "v", empty_keys(spark, "sk"), "sk", "2024-01-01", "v", F.col("sys")).cache()
    assert keys.count() == 3
    out = with_key(u, keys_to_map(keys, "sk"), "sk", "v", "v", F.col("sys")).collect()
    assert len({r.sk for r in out}) == 3


def test_with_key_drops_rows_without_key(spark):
    keys = generate_keys(spark.createDataFrame([(1,)], "c int"), "c", empty_keys(spark, "sk"), "sk", "2024-01-01", "c", "core")
    src = spark.createDataFrame([(1, "x"), (2, "y")], "c int, d string")
    out = with_key(src, keys_to_map(keys, "sk"), "sk", "c", "c", "core").collect()
    assert [(r.sk, r.c) for r in out] == [(1, 1)]


def test_numbering_with_hot_repeated_key(spark):
    rows = [("hot",)] * 300 + [(str(i),) for i in range(50)] + [(None,)]
    df = spark.createDataFrame(rows, "k string")
    out = assign_numbers(df, "k", None, "n", one_row_per_key=False).collect()
    assert len(out) == len(rows)
    got = {r.k: r.n for r in out}
    want = {v: i + 1 for i, v in enumerate(md5_order(set(r[0] for r in rows if r[0] is not None)))}
    assert {k: v for k, v in got.items() if k is not None} == want and got[None] is None


def table_name():
    import uuid

    return "keys_" + uuid.uuid4().hex[:10]


def test_keys_of_a_bucketed_table(spark):
    """Batches are numbered one after the other; old keys keep their numbers, also those of another name."""
    from dimload.operators.keys import add_keys, highest_key

    name = table_name()
    for k, (values, key_name) in enumerate(((range(10), "c"), (range(5, 20), "c"), (range(0), "c"), (range(3), "other"), ([None, 1], "c"))):
        add_keys(spark.createDataFrame([(v,) for v in values], "c int"), "c", name, "sk", f"2024-01-0{k + 1}", key_name, "core", buckets=4)
    rows = spark.table(name).collect()
    assert sorted(r.sk for r in rows) == list(range(1, 24)) and highest_key(spark, name) == 23
    first = [r for r in rows if r.sk <= 10]
    assert sorted(int(r.originating_source_business_key) for r in first) == list(range(10))
    assert [r.originating_source_business_key for r in sorted(first, key=lambda r: r.sk)] == md5_order([str(i) for i in range(10)])
    assert {r.originating_business_key_name for r in rows if r.sk > 20} == {"other"}


def test_a_crash_before_the_keys_are_appended_hands_no_number_out_twice(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from dimload.operators.keys import add_keys

    name = table_name()
    args = ("c", name, "sk", "2024-01-01", "c", "core")
    add_keys(spark.createDataFrame([(1,), (2,)], "c int"), *args)
    real = DataFrameWriter.saveAsTable
    with monkeypatch.context() as m:
        m.setattr(DataFrameWriter, "saveAsTable", lambda *a, **kw: (_ for _ in ()).throw(RuntimeError()))
        with pytest.raises(RuntimeError):
            add_keys(spark.createDataFrame([(3,), (4,)], "c int"), *args)
    assert real is DataFrameWriter.saveAsTable and spark.table(name).count() == 2
    add_keys(spark.createDataFrame([(3,), (4,), (5,)], "c int"), *args)
    keys = [r.sk for r in spark.table(name).collect()]
    assert len(keys) == len(set(keys)) == 5 and sorted(keys)[:2] == [1, 2] and min(k for k in keys if k > 2) > 4


def test_old_keys_are_not_shuffled(spark):
    """The plan of a batch: the scan of the bucketed keys meets the candidates without an exchange of its own."""
    from dimload.operators.keys import add_keys

    name = table_name()
    add_keys(spark.range(1000), "id", name, "sk", "2024-01-01", "id", "core", buckets=8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = generate_keys(spark.range(500, 1500), "id", spark.table(name), "sk", "2024-01-02", "id", "core", materialize=False, highest=1000)
        plan = new._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan
    lines = plan.split("\n")
    for at in [k for k, line in enumerate(lines) if "FileScan parquet" in line and name in line]:
        depth, above = lines[at].index("FileScan"), []  # the scan's ancestors, nearest first
        for line in reversed(lines[:at]):
            here = len(line) - len(line.lstrip(" :+-*()0123456789"))
            if here < depth:
                depth = here
                above.append(line)
        assert "SortMergeJoin" in next(line for line in above if "Exchange" in line or "SortMergeJoin" in line)
    assert new.count() == 500
