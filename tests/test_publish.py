"""SCD batches on storage: history appended per batch, current rows rewritten, re-runs safe."""

from pyspark.sql import functions as F

from dimload.operators.publish import read_dimension, run_scd_batch
from dimload.operators.scd import ScdSpec, scd_load
from dimload.sources.versions import FILE_COL, current_version, read_table, read_version

SPEC = ScdSpec(business_keys=("id",), scd2_columns=("seg",), surrogate_key="sk")


def src(spark, rows):
    return spark.createDataFrame(rows, "id bigint, name string, seg string")


def canon(df):
    cols = ["id", "name", "seg", "row_current_flag", "row_effective_timestamp", "row_expiry_timestamp", "row_update_timestamp", "sk"]
    return sorted(tuple(r) for r in df.select(*cols).collect())


def history_files(spark, path):
    rows = read_version(spark, path, current_version(spark, path), files=True).filter("not row_current_flag")
    return {r[0] for r in rows.select(FILE_COL).distinct().collect()}


def test_three_batches_and_rerun(spark, tmp_out):
    paths = dict(dim_path=f"{tmp_out}/dim", keys_path=f"{tmp_out}/keys", map_path=f"{tmp_out}/map", ledger_path=f"{tmp_out}/ledger")
    b1 = src(spark, [(i, f"n{i}", f"s{i % 3}") for i in range(20)])
    b2 = src(spark, [(i, f"m{i}" if i % 4 == 0 else f"n{i}", f"s{(i + (i % 5 == 0)) % 3}") for i in range(5, 30)])
    assert run_scd_batch(spark, b1, SPEC, "2024-01-01 00:00:00", "1", **paths) == "published"
    assert run_scd_batch(spark, b2, SPEC, "2024-02-01 00:00:00", "2", **paths) == "published"
    assert run_scd_batch(spark, b2, SPEC, "2024-02-01 00:00:00", "2", **paths) == "skipped"
    stored = read_dimension(spark, paths["dim_path"], SPEC)
    stored_rows, stored_n = canon(stored), stored.count()  # evaluate before the next batch rewrites files
    # same as running the two batches in memory
    r1 = scd_load(None, b1, SPEC, "2024-01-01 00:00:00")
    d1, k1 = r1.dimension.cache(), r1.new_keys.cache()
    r2 = scd_load(d1, b2, SPEC, "2024-02-01 00:00:00", keys=k1)
    assert stored_rows == canon(r2.dimension)
    before = history_files(spark, paths["dim_path"])
    assert before
    assert read_table(spark, paths["keys_path"]).count() == stored_n
    # a third batch with the same source changes nothing (idempotent), keys unchanged
    assert run_scd_batch(spark, b2, SPEC, "2024-03-01 00:00:00", "3", **paths) == "published"
    assert canon(read_dimension(spark, paths["dim_path"], SPEC)) == stored_rows
    assert read_table(spark, paths["keys_path"]).count() == stored_n
    assert history_files(spark, paths["dim_path"]) == before  # written once


def test_load_into_partitioned_upsert_rewrites_only_touched_partitions(spark, tmp_out):
    import os

    from dimload.operators.loads import load
    from dimload.operators.publish import load_into

    t = spark.createDataFrame(
        [(1, "a", "p1"), (2, "b", "p1"), (3, "c", "p2"), (4, "d", "p3")], "k bigint, v string, part string"
    ).withColumns({"etl_updated_timestamp": F.lit(None).cast("timestamp_ntz"), "etl_deleted_flag": F.lit(False)})
    path = f"{tmp_out}/t"
    t.write.partitionBy("part").parquet(path)
    untouched = sorted(os.listdir(f"{path}/part=p3"))
    src = spark.createDataFrame([(1, "a2", "p2"), (5, "e", "p4")], "k bigint, v string, part string")
    expected = load(spark.read.parquet(path), src, "upsert", [("k", "k")], "2024-01-01 00:00:00")
    want = sorted(tuple(r) for r in expected.select("k", "v", "part", "etl_deleted_flag").collect())
    out = load_into(path, src, "upsert", [("k", "k")], "2024-01-01 00:00:00", partition_cols=["part"])
    assert sorted(tuple(r) for r in out.select("k", "v", "part", "etl_deleted_flag").collect()) == want
    assert sorted(os.listdir(f"{path}/part=p3")) == untouched  # partition without changes not rewritten
    load_into(path, spark.createDataFrame([(9, "z", "p3")], "k bigint, v string, part string"), "insert", None, "2024-01-02 00:00:00", partition_cols=["part"])
    assert read_table(spark, path).filter("k = 9").count() == 1


def test_load_into_clears_partition_emptied_by_a_moved_key(spark, tmp_out):
    from dimload.operators.publish import load_into

    t = spark.createDataFrame([(1, "a", "p/1"), (2, "b", "p2")], "k bigint, v string, part string").withColumns(
        {"etl_updated_timestamp": F.lit(None).cast("timestamp_ntz"), "etl_deleted_flag": F.lit(False)}
    )
    path = f"{tmp_out}/t2"
    t.write.partitionBy("part").parquet(path)
    src = spark.createDataFrame([(1, "a2", "p2")], "k bigint, v string, part string")
    out = load_into(path, src, "upsert", [("k", "k")], "2024-01-01 00:00:00", partition_cols=["part"])
    assert sorted((r.k, r.v, r.part) for r in out.collect()) == [(1, "a2", "p2"), (2, "b", "p2")]


def stamped(df):
    return df.withColumns({"etl_updated_timestamp": F.lit(None).cast("timestamp_ntz"), "etl_deleted_flag": F.lit(False)})


def test_load_into_null_and_zero_padded_partitions_with_a_cast_key(spark, tmp_out):
    from dimload.operators.publish import load_into

    path = f"{tmp_out}/t3"
    rows = [("2024-01-01 10:00:00", "a", None), ("2024-01-02 10:00:00", "b", None), ("2024-01-03 10:00:00", "c", "01"), ("2024-01-04 10:00:00", "d", "1")]
    stamped(spark.createDataFrame(rows, "k string, v string, p string")).write.partitionBy("p").parquet(path)
    source = spark.createDataFrame([("2024-01-01 23:00:00", "a2", None), ("2024-01-03 23:00:00", "c2", "01"), ("2024-01-05 00:00:00", "e", "02")], "k string, v string, p string")
    out = load_into(path, source, "upsert", [("k", "k", "date")], "2024-02-01 00:00:00", partition_cols=["p"])
    assert sorted((r.v, r.p or "-") for r in out.collect()) == [("a2", "-"), ("b", "-"), ("c2", "01"), ("d", "1"), ("e", "02")]


def test_load_into_keeps_new_columns_and_maps_columns(spark, tmp_out):
    from dimload.operators.publish import load_into

    path = f"{tmp_out}/t4"
    stamped(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")).write.parquet(path)
    load_into(path, spark.createDataFrame([(2, "b2", 7)], "k int, v string, extra int"), "upsert", [("k", "k")], "2024-02-01 00:00:00")
    out = load_into(path, spark.createDataFrame([(3, "c", 8)], "k int, v string, other int"), "insert", None, "2024-02-02 00:00:00")
    assert sorted((r.k, r.v, r.extra or 0, r.other or 0) for r in out.collect()) == [(1, "a", 0, 0), (2, "b2", 7, 0), (3, "c", 0, 8)]
    mapped = spark.createDataFrame([(1, "z")], "key int, value string")
    out = load_into(path, mapped, "upsert", [("key", "k")], "2024-02-03 00:00:00", source_columns=["key", "value"], target_columns=["k", "v"])
    assert {r.k: r.v for r in out.collect()} == {1: "z", 2: "b2", 3: "c"}
    kept = load_into(path, spark.createDataFrame([(9, "n")], "k int, v string"), "full", [("k", "k")], "2024-02-04 00:00:00", full_record_comparison_source=spark.createDataFrame([(1,), (2,)], "k int"))
    assert sorted((r.k, r.etl_deleted_flag) for r in kept.collect()) == [(3, True), (9, False)]


def storage(tmp_out):
    return dict(dim_path=f"{tmp_out}/dim", keys_path=f"{tmp_out}/keys", map_path=f"{tmp_out}/map", ledger_path=f"{tmp_out}/ledger")


def batches(spark):
    one = src(spark, [(i, f"n{i}", f"s{i % 3}") for i in range(10)])
    two = src(spark, [(i, f"n{i}", f"s{(i + (i % 2)) % 3}") for i in range(5, 15)])
    return one, two


def test_a_crash_after_any_step_is_mended_by_the_next_run(spark, tmp_path, monkeypatch):
    from dimload.operators import publish
    from dimload.sources import versions

    one, two = batches(spark)
    want = None
    steps = [None, "append_keys", "keys only", "written only", "publish_dimension", "record_done"]
    for k, step in enumerate(steps):
        paths = storage(tmp_path / str(k))
        assert run_scd_batch(spark, one, SPEC, "2024-01-01 00:00:00", "1", **paths) == "published"
        before = canon(read_dimension(spark, paths["dim_path"], SPEC))
        with monkeypatch.context() as m:

            def crash(*a, **kw):
                raise RuntimeError("lost")

            if step == "keys only":
                real = publish.current_version
                m.setattr(publish, "current_version", lambda s, p, *a: crash() if p == paths["map_path"] else real(s, p, *a))
            elif step == "written only":
                m.setattr(versions._Folder, "create", crash)
            elif step:
                m.setattr(publish, step, crash)
            if step:
                try:
                    run_scd_batch(spark, two, SPEC, "2024-02-01 00:00:00", "2", **paths)
                    raise AssertionError("no crash")
                except RuntimeError:
                    pass
        if step not in (None, "record_done"):
            assert canon(read_dimension(spark, paths["dim_path"], SPEC)) == before
        run_scd_batch(spark, two, SPEC, "2024-02-01 00:00:00", "2", **paths)
        now = canon(read_dimension(spark, paths["dim_path"], SPEC))
        want = want or now
        assert now == want
        keys, key_map = (read_table(spark, paths[p]) for p in ("keys_path", "map_path"))
        assert keys.count() == keys.select("sk").distinct().count() == key_map.count() == len(now)


def test_history_of_a_batch_that_never_took_effect_stays_unseen(spark, tmp_path, monkeypatch):
    from dimload.sources import versions

    one, two = batches(spark)
    paths = storage(tmp_path)
    run_scd_batch(spark, one, SPEC, "2024-01-01 00:00:00", "1", **paths)
    with monkeypatch.context() as m:
        m.setattr(versions._Folder, "create", lambda *a: (_ for _ in ()).throw(RuntimeError()))
        try:
            run_scd_batch(spark, two, SPEC, "2024-02-01 00:00:00", "2", **paths)
        except RuntimeError:
            pass
    run_scd_batch(spark, one, SPEC, "2024-02-01 00:00:00", "other", **paths)
    stored = read_dimension(spark, paths["dim_path"], SPEC)
    assert stored.count() == 10 and stored.filter("not row_current_flag").isEmpty()


def test_a_missing_keys_table_is_refused(spark, tmp_path):
    import pytest

    from dimload.operators.quality import CheckFailed

    one, two = batches(spark)
    paths = storage(tmp_path)
    run_scd_batch(spark, one, SPEC, "2024-01-01 00:00:00", "1", **paths)
    with pytest.raises(CheckFailed):
        run_scd_batch(spark, two, SPEC, "2024-02-01 00:00:00", "2", **(paths | {"keys_path": f"{tmp_path}/mistyped"}))


def test_a_column_that_comes_later_is_kept(spark, tmp_path):
    paths = storage(tmp_path)
    one, _ = batches(spark)
    run_scd_batch(spark, one, SPEC, "2024-01-01 00:00:00", "1", **paths)
    two = one.withColumns({"seg": F.concat("seg", F.lit("x")), "extra": F.col("id") + 100})
    run_scd_batch(spark, two, SPEC, "2024-02-01 00:00:00", "2", **paths)
    run_scd_batch(spark, two, SPEC, "2024-03-01 00:00:00", "3", **paths)
    stored = read_dimension(spark, paths["dim_path"], SPEC)
    assert stored.filter("row_current_flag and extra = id + 100").count() == 10 and stored.filter("not row_current_flag and extra is null").count() == 10


def test_text_keys_and_null_keys_on_storage(spark, tmp_path):
    spec = ScdSpec(business_keys=("a", "b"), scd2_columns=("v",), surrogate_key="sk")
    paths = storage(tmp_path)
    rows = [("x|y", "z", 1), ("x", "y|z", 1), ("x\\", "|z", 1), ("gone", "g", 1), (None, "n", 1), (None, "n", 2)]
    run_scd_batch(spark, spark.createDataFrame(rows, "a string, b string, v int"), spec, "2024-01-01 00:00:00", "1", **paths)
    two = spark.createDataFrame([("x|y", "z", 2), ("x", "y|z", 1)], "a string, b string, v int")
    run_scd_batch(spark, two, spec, "2024-02-01 00:00:00", "2", **paths)
    got = sorted((r.a, r.b, r.v, r.row_current_flag) for r in read_dimension(spark, paths["dim_path"], spec).collect())
    assert got == [("gone", "g", 1, True), ("x", "y|z", 1, True), ("x\\", "|z", 1, True), ("x|y", "z", 1, False), ("x|y", "z", 2, True)]
    keys = read_table(spark, paths["keys_path"])
    assert keys.count() == keys.select("sk").distinct().count() == 5


def test_faulty_batches_are_refused(spark):
    import pytest

    from dimload.operators.quality import CheckFailed

    twice = src(spark, [(1, "a", "x"), (1, "b", "y")])
    with pytest.raises(CheckFailed):
        scd_load(None, twice, SPEC, "2024-01-01 00:00:00")
    with pytest.raises(ValueError):
        scd_load(None, src(spark, [(1, "a", "x")]), ScdSpec(business_keys=("id",), scd2_columns=("sge",), surrogate_key="sk"), "2024-01-01 00:00:00")


def test_keyed_load_on_storage_after_a_crash(spark, tmp_path, monkeypatch):
    from dimload.operators import publish

    root = str(tmp_path)
    stamped(spark.createDataFrame([], "sk bigint, id bigint, v string")).write.parquet(f"{root}/target")
    source = spark.createDataFrame([(i, f"v{i}") for i in range(6)], "id bigint, v string")
    args = ("u1", f"{root}/target", f"{root}/keys", f"{root}/map", f"{root}/ledger", source, "sk", "id", "id", "core", "2024-01-01 00:00:00")
    with monkeypatch.context() as m:
        m.setattr(publish, "load_into", lambda *a, **kw: (_ for _ in ()).throw(RuntimeError()))
        try:
            publish.keyed_load_into(spark, *args)
        except RuntimeError:
            pass
    assert [publish.keyed_load_into(spark, *args) for _ in range(2)] == ["published", "skipped"]
    out = read_table(spark, f"{root}/target")
    assert out.count() == 6 and read_table(spark, f"{root}/map").count() == 6 and out.select("sk").distinct().count() == 6
