"""Versioned tables: a load counts as a whole or not at all; columns that come later have defaults."""

import os

import pytest
from pyspark.sql import functions as F

from dimload.operators import publish
from dimload.operators.loads import load
from dimload.operators.publish import load_into, read_dimension, run_scd_batch
from dimload.operators.quality import CheckFailed, expect_rows, gated_publish
from dimload.operators.scd import ScdSpec, scd_load
from dimload.operators.snapshots import backfill_into, write_daily_snapshot
from dimload.sources import versions
from dimload.sources.scripts import refresh_into
from dimload.sources.versions import add_stored_column, current_version, read_table, replace_partitions, replace_table

AS_OF = "2024-02-01 00:00:00"
STRATEGIES = ["insert", "upsert", "refresh_by_keys", "full", "refresh"]


def stamped(df):
    return df.withColumns({"etl_updated_timestamp": F.lit(None).cast("timestamp_ntz"), "etl_deleted_flag": F.lit(False)})


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def stored(spark, path, parts=("p",)):
    df = stamped(spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "01"), (4, "d", None)], "k bigint, v string, p string"))
    df.repartition(2).write.partitionBy(*parts).parquet(path)
    return df


def source(spark):
    return spark.createDataFrame([(1, "a2", "01", True), (9, "z", "new", None)], "k bigint, v string, p string, flag boolean")


def fail_at(monkeypatch, step):
    """Let the named step of a load fail."""

    def crash(*a, **kw):
        raise RuntimeError("lost")

    if step == "write":
        from pyspark.sql import DataFrameWriter

        real = DataFrameWriter.parquet
        monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **kw: crash() if "_loads" in path else real(self, path, *a, **kw))
    elif step == "half written":
        from pyspark.sql import DataFrameWriter

        real = DataFrameWriter.parquet
        monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **kw: (real(self, path, *a, **kw), crash() if "_loads" in path else None))
    elif step == "task":  # a task of the write fails, as it would on bad data
        real = versions.commit_load
        bad = F.udf(lambda x: 1 / 0, "string")
        for module in (versions, publish):
            monkeypatch.setattr(module, "commit_load", lambda df, *a, **kw: real(df.withColumn(df.columns[1], bad(F.lit(1))), *a, **kw))
    elif step == "commit":
        monkeypatch.setattr(versions._Folder, "create", crash)
    elif step == "tidy":
        real_settle, calls = versions.settle, []
        monkeypatch.setattr(versions, "settle", lambda *a: (calls.append(1), real_settle(*a) if len(calls) == 1 else crash()))


STEPS = ["write", "half written", "task", "commit", "tidy"]


@pytest.mark.parametrize("strategy", STRATEGIES)
@pytest.mark.parametrize("step", STEPS)
def test_load_into_that_fails_leaves_the_table(spark, tmp_path, monkeypatch, strategy, step):
    path, keys = f"{tmp_path}/t", None if strategy in ("insert", "refresh") else [("k", "k")]
    target = stored(spark, path)
    old = rows(read_table(spark, path), "k", "v", "p")
    want = rows(load(target, source(spark), strategy, keys, AS_OF), "k", "v", "p", "flag", "etl_deleted_flag")
    with monkeypatch.context() as m:
        fail_at(m, step)
        with pytest.raises(Exception):  # noqa: B017 - the task's error is Spark's
            load_into(path, source(spark), strategy, keys, AS_OF, partition_cols=["p"])
    now = read_table(spark, path, ["p"], source(spark).schema)
    if step == "tidy":  # committed: the new rows count, whatever lies around
        assert rows(now, "k", "v", "p", "flag", "etl_deleted_flag") == want
        return
    assert rows(now, "k", "v", "p") == old
    out = load_into(path, source(spark), strategy, keys, AS_OF, partition_cols=["p"])
    assert rows(out, "k", "v", "p", "flag", "etl_deleted_flag") == want


@pytest.mark.parametrize("step", STEPS)
def test_refresh_and_gate_that_fail_leave_the_table(spark, tmp_path, monkeypatch, step):
    for k, publish_it in enumerate((lambda df, path: refresh_into(df, path), lambda df, path: gated_publish(df, path, lambda d: expect_rows("rows", d)))):
        path = f"{tmp_path}/{k}"
        spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").write.parquet(path)
        new = read_table(spark, path).withColumn("k", F.col("k") + 10)  # reads what it replaces
        with monkeypatch.context() as m:
            fail_at(m, step)
            with pytest.raises(Exception):  # noqa: B017
                publish_it(new, path)
        assert rows(read_table(spark, path), "k") == ([(11,), (12,)] if step == "tidy" else [(1,), (2,)])
    with pytest.raises(CheckFailed):
        gated_publish(new.limit(0), path, lambda d: expect_rows("rows", d))


@pytest.mark.parametrize("strategy", STRATEGIES)
@pytest.mark.parametrize("parts", [[], ["p"]])
def test_new_columns_read_alike_on_storage_and_on_frames(spark, tmp_path, strategy, parts):
    """A new flag is false, any other new column NULL, on rows that no load has written again."""
    path, keys = f"{tmp_path}/t", None if strategy in ("insert", "refresh") else [("k", "k")]
    target = stamped(spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "01")], "k bigint, v string, p string"))
    (target.write.partitionBy(*parts) if parts else target.write).parquet(path)
    new = source(spark).withColumn("extra", F.lit(7))
    frame = load(target, new, strategy, keys, AS_OF)
    out = load_into(path, new, strategy, keys, AS_OF, partition_cols=parts)
    assert rows(out, "k", "v", "p", "flag", "extra") == rows(frame, "k", "v", "p", "flag", "extra")
    later = spark.createDataFrame([(9, "y", "new")], "k bigint, v string, p string")
    frame = load(frame, later, "upsert", [("k", "k")], AS_OF)
    out = load_into(path, later, "upsert", [("k", "k")], AS_OF, partition_cols=parts)
    assert rows(out, "k", "v", "p", "flag", "extra") == rows(frame, "k", "v", "p", "flag", "extra")


def data_files(path):
    found = {}
    for base, _, names in os.walk(path):
        found |= {os.path.join(base, n): os.path.getsize(os.path.join(base, n)) for n in names if n.endswith(".parquet")}
    return found


def test_an_upsert_replaces_only_files_that_hold_its_keys(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = stamped(spark.range(100_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")))
    df.repartitionByRange(50, "k").write.parquet(path)
    old = data_files(path)
    new = spark.range(40_000, 41_000).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    out = load_into(path, new, "upsert", [("k", "k")], AS_OF)
    now = data_files(path)
    written = sum(size for name, size in now.items() if name not in old)
    assert len(old) == 50 and len(set(old) - set(now)) <= 2
    assert written < 0.05 * sum(old.values())
    assert out.count() == 100_000 and out.filter("v = 'new'").count() == 1_000 and out.select("k").distinct().count() == 100_000


def test_more_replaced_files_than_the_bound_rewrite_the_table(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    target = stored(spark, path)
    want = rows(load(target, source(spark), "upsert", [("k", "k")], AS_OF), "k", "v", "p", "flag")
    monkeypatch.setattr(publish, "MAX_REPLACED", 0)
    out = load_into(path, source(spark), "upsert", [("k", "k")], AS_OF, partition_cols=["p"])
    assert rows(out, "k", "v", "p", "flag") == want and not current_version(spark, path).plain


def test_hard_partition_values_and_paths(spark, tmp_path):
    path = f"{tmp_path}/a b%é"
    df = stamped(spark.createDataFrame([(1, "p/1"), (2, None), (3, "x y=é%"), (4, "1"), (5, "01"), (6, "{*}")], "k bigint, p string"))
    df.write.partitionBy("p").parquet(path)
    new = spark.createDataFrame([(1, "p/1"), (2, None), (3, "moved"), (6, "{*}")], "k bigint, p string")
    out = load_into(path, new, "upsert", [("k", "k")], AS_OF, partition_cols=["p"])
    assert rows(out, "k", "p") == rows(spark.createDataFrame([(1, "p/1"), (2, None), (3, "moved"), (4, "1"), (5, "01"), (6, "{*}")], "k bigint, p string"), "k", "p")
    out = load_into(path, new.withColumn("p", F.lit("gone")), "upsert", [("k", "k")], AS_OF, partition_cols=["p"])
    assert rows(out, "k", "p") == [(1, "gone"), (2, "gone"), (3, "gone"), (4, "1"), (5, "01"), (6, "gone")]


def test_add_column_writes_no_row(spark, tmp_path):
    path = f"{tmp_path}/t"
    stored(spark, path)
    old = data_files(path)
    add_stored_column(spark, path, "checked", "boolean")
    add_stored_column(spark, path, "level", "int", 3)
    add_stored_column(spark, path, "LEVEL", "string", "no")
    out = add_stored_column(spark, path, "note")
    assert rows(out, "checked", "level", "note") == [(False, 3, None)] * 4 and data_files(path) == old
    load_into(path, spark.createDataFrame([(5, "e", "x")], "k bigint, v string, p string"), "insert", None, AS_OF)
    assert rows(read_table(spark, path).filter("k > 3"), "k", "checked", "level") == [(4, False, 3), (5, None, None)]


def test_partitions_and_whole_tables(spark, tmp_path):
    path = f"{tmp_path}/t"
    day = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "k int, day string")
    replace_partitions(day, path, "day", ["a", "b"])
    replace_partitions(day.filter("k = 1"), path, "day", ["a"])
    out = replace_partitions(day.filter("false"), path, "day", ["b"])
    assert rows(out, "k", "day") == [(1, "a")]
    assert rows(replace_table(out.withColumn("n", F.lit(1)), path), "k", "day", "n") == [(1, "a", 1)]
    assert rows(replace_table(spark.createDataFrame([], "k int"), path), "k") == []
    with pytest.raises(FileNotFoundError):
        read_table(spark, f"{tmp_path}/none")


def test_a_commit_in_between_is_refused(spark, tmp_path):
    path = f"{tmp_path}/t"
    replace_table(spark.range(3), path)
    known = current_version(spark, path)
    replace_table(spark.range(4), path)
    with pytest.raises(versions.ConcurrentLoad):
        versions.commit_load(spark.range(5), path, known, replaced=None)
    assert read_table(spark, path).count() == 4


# --- dimensions ------------------------------------------------------------------------------------

SPEC = ScdSpec(business_keys=("id",), scd2_columns=("seg",), surrogate_key="sk")


def paths(root):
    return dict(dim_path=f"{root}/dim", keys_path=f"{root}/keys", map_path=f"{root}/map", ledger_path=f"{root}/ledger")


def test_a_new_flag_is_false_on_earlier_versions(spark, tmp_path):
    p = paths(tmp_path)
    one = spark.createDataFrame([(i, f"s{i % 3}") for i in range(12)], "id bigint, seg string")
    two = one.filter("id < 8").withColumn("seg", F.when(F.col("id") < 4, "t").otherwise(F.col("seg")))
    three = two.withColumns({"seg": F.when(F.col("id") == 5, "u").otherwise(F.col("seg")), "vip": F.col("id") > 6})
    dim, keys = None, None
    for k, batch in enumerate((one, two, three)):
        as_of = f"2024-0{k + 1}-01 00:00:00"
        run_scd_batch(spark, batch, SPEC, as_of, str(k), **p)
        r = scd_load(dim, batch, SPEC, as_of, keys=keys)
        dim, keys = r.dimension.checkpoint(), (r.new_keys if keys is None else keys.unionByName(r.new_keys)).checkpoint()
    cols = ("id", "seg", "vip", "row_current_flag", "row_effective_timestamp", "row_expiry_timestamp", "sk")
    assert rows(read_dimension(spark, p["dim_path"], SPEC), *cols) == rows(dim, *cols)
    assert read_dimension(spark, p["dim_path"], SPEC).filter("vip is null").isEmpty()


def test_a_batch_writes_only_files_of_rows_it_changes(spark, tmp_path):
    p = paths(tmp_path)
    one = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("name"), F.lit("s").alias("seg"))
    run_scd_batch(spark, one, SPEC, "2024-01-01 00:00:00", "1", **p)
    old = data_files(p["dim_path"])
    few = one.filter(F.col("id").isin(17, 4711, 19_999)).withColumn("seg", F.lit("t")).unionByName(one.filter("id = 3"))
    run_scd_batch(spark, few, SPEC, "2024-02-01 00:00:00", "2", **p)
    now = data_files(p["dim_path"])
    assert len(old) == 64 and len(set(old) - set(now)) == 3
    assert sum(size for name, size in now.items() if name not in old) < 0.1 * sum(old.values())
    dim = read_dimension(spark, p["dim_path"], SPEC)
    assert dim.count() == 20_003 and dim.filter("row_current_flag").count() == 20_000 and dim.filter("seg = 't' and row_current_flag").count() == 3
    middle = data_files(p["dim_path"])
    run_scd_batch(spark, one.filter("id < 5000"), SPEC, "2024-03-01 00:00:00", "3", **p)  # only one key changes back
    assert len(set(middle) - set(data_files(p["dim_path"]))) == 2
    run_scd_batch(spark, one.limit(0), SPEC, "2024-04-01 00:00:00", "4", **p)
    assert read_dimension(spark, p["dim_path"], SPEC).count() == 20_005


def test_dimension_with_more_changed_files_than_the_bound(spark, tmp_path, monkeypatch):
    one = spark.range(200).select("id", F.lit("n").alias("name"), F.lit("s").alias("seg"))
    two = one.filter("id < 100").withColumn("seg", F.lit("t")).withColumn("vip", F.lit(True))
    got = []
    for bound in (20_000, 1):
        p = paths(tmp_path / str(bound))
        monkeypatch.setattr(publish, "MAX_REPLACED", bound)
        run_scd_batch(spark, one, SPEC, "2024-01-01 00:00:00", "1", **p)
        run_scd_batch(spark, two, SPEC, "2024-02-01 00:00:00", "2", **p)
        got.append(rows(read_dimension(spark, p["dim_path"], SPEC), "id", "seg", "vip", "row_current_flag", "sk"))
    assert got[0] == got[1] and len(got[0]) == 300


def test_key_types_of_later_batches_find_their_bucket(spark, tmp_path):
    p = paths(tmp_path)
    one = spark.createDataFrame([(i, "s") for i in range(40)], "id bigint, seg string")
    run_scd_batch(spark, one, SPEC, "2024-01-01 00:00:00", "1", **p)
    for k, kind in enumerate(("int", "decimal(10,2)", "double", "string")):
        run_scd_batch(spark, one.withColumns({"id": F.col("id").cast(kind), "seg": F.lit(kind)}), SPEC, f"2024-02-0{k + 1} 00:00:00", f"2{k}", **p)
    dim = read_dimension(spark, p["dim_path"], SPEC)
    assert dim.filter("row_current_flag").count() == 40 and dim.count() == 200


# --- days ------------------------------------------------------------------------------------------


def test_a_repeated_day_without_rows_has_none(spark, tmp_path, monkeypatch):
    from dimload.operators import snapshots

    events = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-02", 3)], "d string, v int").withColumn("ts", F.to_timestamp("d"))

    def daily(day_rows, before=None):
        return day_rows.groupBy("day").agg(F.sum("v").alias("s"))

    for k, ordered in enumerate((False, True)):
        args = (F.to_date("ts"), daily, f"{tmp_path}/{k}/days", f"{tmp_path}/{k}/ledger", "p", "2024-01-03", 2, AS_OF, ordered)
        with monkeypatch.context() as m:  # rows are committed, the days are not marked
            m.setattr(snapshots, "ledger_rows", lambda *a: (_ for _ in ()).throw(RuntimeError()))
            with pytest.raises(RuntimeError):
                backfill_into(spark, events, *args)
        assert read_table(spark, args[2]).count() > 0
        backfill_into(spark, events.filter("d <> '2024-01-01'"), *args)
        assert [(str(r.day), r.s) for r in read_table(spark, args[2]).collect()] == [("2024-01-02", 5)]


def test_a_snapshot_that_fails_keeps_the_day(spark, tmp_path):
    base = f"{tmp_path}/snap"
    write_daily_snapshot(spark.range(3), base, "2024-01-01")
    with pytest.raises(Exception):  # noqa: B017
        write_daily_snapshot(spark.range(5).withColumn("id", F.udf(lambda x: 1 // 0, "bigint")("id")), base, "2024-01-01")
    assert read_table(spark, base).count() == 3
