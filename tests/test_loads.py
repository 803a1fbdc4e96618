"""Load strategies on hand-made frames with duplicate and NULL keys, with and without the
delete condition and the load constraint."""

import datetime as dt
import itertools

import pytest

from pyspark.sql import functions as F

from dimload.operators.loads import load

AS_OF = "2024-03-15 08:30:45.9"
STAMP = dt.datetime(2024, 3, 15, 8, 30, 45)
OLD = dt.datetime(2024, 1, 1)
SYDNEY = dt.datetime(2024, 3, 15, 19, 30, 45, 900000)
KEYS = [("k", "k")]


def target(spark):
    rows = [
        (1, "a", "A", OLD, False),
        (2, "b", "B", OLD, False),
        (3, "c", "A", OLD, True),
        (4, "d", "B", OLD, None),
        (None, "n", "A", OLD, False),
        (5, "e", "A", OLD, False),
    ]
    return spark.createDataFrame(rows, "k bigint, v string, grp string, etl_updated_timestamp timestamp_ntz, etl_deleted_flag boolean")


def source(spark):
    rows = [(1, "a2", "A"), (1, "a3", "A"), (2, "b2", "B"), (None, "n2", "A"), (9, "z", "B")]
    return spark.createDataFrame(rows, "k bigint, v string, grp string")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def expected(strategy, delete_condition, load_constraint):
    t = [(1, "a", "A", OLD, False), (2, "b", "B", OLD, False), (3, "c", "A", OLD, True), (4, "d", "B", OLD, None), (None, "n", "A", OLD, False), (5, "e", "A", OLD, False)]
    s = [(1, "a2", "A"), (1, "a3", "A"), (2, "b2", "B"), (None, "n2", "A"), (9, "z", "B")]
    ins = [(k, v, g, STAMP, False) for k, v, g in s if not load_constraint or g == "B"]
    if strategy == "refresh":
        return sorted(ins, key=repr)
    if strategy == "insert":
        return sorted(t + ins, key=repr)
    skeys = {k for k, _, _ in s if k is not None}
    kept = [r for r in t if not (r[0] in skeys and (not delete_condition or r[2] == "A"))]
    if strategy == "full":
        kept = [(k, v, g, SYDNEY, True) if f is False else (k, v, g, ts, f) for k, v, g, ts, f in kept]
    return sorted(kept + ins, key=repr)


@pytest.mark.parametrize(
    "strategy,dc,lc",
    list(itertools.product(["insert", "upsert", "refresh_by_keys", "full", "refresh"], [False, True], [False, True])),
)
def test_strategies(spark, strategy, dc, lc):
    out = load(
        target(spark),
        source(spark),
        strategy,
        KEYS if strategy not in ("insert", "refresh") else None,
        AS_OF,
        delete_condition="grp = 'A'" if dc else None,
        load_constraint="grp = 'B'" if lc else None,
    )
    assert sorted([tuple(r) for r in out.collect()], key=repr) == expected(strategy, dc, lc)


def test_keys_required(spark):
    with pytest.raises(ValueError):
        load(target(spark), source(spark), "upsert", None, AS_OF)
    with pytest.raises(ValueError):
        load(target(spark), source(spark), "merge", KEYS, AS_OF)


def test_mapped_columns_and_cast_keys(spark):
    t = spark.createDataFrame([("1", "x", OLD, False)], "id string, val string, etl_updated_timestamp timestamp_ntz, etl_deleted_flag boolean")
    s = spark.createDataFrame([(1, "y")], "k bigint, v string")
    out = load(t, s, "upsert", [("k", "id", "string")], AS_OF, source_columns=["k", "v"], target_columns=["id", "val"])
    assert rows(out) == [("1", "y", STAMP, False)]


def test_files_by_range_all_hold_a_key_of_the_batch(spark, tmp_path, monkeypatch):
    """No task takes all rows of a parity, and the batch still replaces every file of odd keys."""
    from dimload.plans import load_queries as lq

    monkeypatch.setattr(lq, "FILE_ROWS", 400)
    keys = [*range(3000), *range(1500), *[7] * 50, *[51] * 50, None, None]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    orders = spark.createDataFrame([(k, 1, "O", 2.0, None, "x") for k in keys], schema)
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    rows = orders.withColumn("odd", F.col("o_orderkey") % 2 == 1)
    batch = orders.where("o_orderkey % 50 = 1")
    placed = lq._by_range(rows, batch).withColumn("part", F.spark_partition_id())
    sizes = {(r["part"], r["odd"]): (r["n"], r["hits"]) for r in placed.groupBy("part", "odd").agg(F.count("*").alias("n"), F.count_if(F.expr("o_orderkey % 50 = 1")).alias("hits")).collect()}
    assert sum(n for n, _ in sizes.values()) == len(keys) and max(n for n, _ in sizes.values()) < 700
    assert sum(odd is True for _, odd in sizes) > 4 and all(hits for (_, odd), (_, hits) in sizes.items() if odd)
    got = lq.q_load_upsert_files(spark, str(tmp_path)).collect()
    want = [(k, 1.5 if k is not None and k % 50 == 1 else 2.0, k is None or k % 2 == 0) for k in keys]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert lq._by_range(rows, batch.limit(0)).count() == len(keys) and lq._by_range(rows.limit(0), batch).count() == 0
