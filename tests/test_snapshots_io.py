"""Snapshots, backfill, ledger, scripts and file sources/sinks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dimload.operators.snapshots import backfill, backfill_window, daily_snapshot, pending_days, write_daily_snapshot
from dimload.sources.io import file_manifest, load_delimited, read_delimited, unload
from dimload.sources.ledger import empty_ledger, ledger_rows, mark_done, pending_only, value_exists
from dimload.sources.scripts import render_script, run_script, statements, view_from_script
from dimload.sources.versions import read_table


def test_daily_snapshot_frames_rerun_safe(spark):
    s1 = spark.createDataFrame([(1,), (2,)], "id int")
    snap = daily_snapshot(None, s1, "2024-01-01")
    snap = daily_snapshot(snap, s1, "2024-01-02")
    snap = daily_snapshot(snap, s1.filter("id = 1"), "2024-01-01")
    got = sorted((r.id, str(r.snapshot_date)) for r in snap.collect())
    assert got == [(1, "2024-01-01"), (1, "2024-01-02"), (2, "2024-01-02")]


def test_daily_snapshot_files_empty_source_clears_day(spark, tmp_out):
    s1 = spark.createDataFrame([(1,), (2,)], "id int")
    write_daily_snapshot(s1, tmp_out, "2024-01-01")
    write_daily_snapshot(s1, tmp_out, "2024-01-02")
    write_daily_snapshot(s1.filter(F.lit(False)), tmp_out, "2024-01-02")
    got = sorted((r.id, str(r.snapshot_date)) for r in read_table(spark, tmp_out).collect())
    assert got == [(1, "2024-01-01"), (2, "2024-01-01")]


def test_backfill_window_excludes_today(spark):
    days = [r.day for r in backfill_window(spark, "2024-01-31", 3).collect()]
    assert days == [dt.date(2024, 1, 28), dt.date(2024, 1, 29), dt.date(2024, 1, 30)]
    assert backfill_window(spark, "2024-01-31", 0).count() == 0


def test_pending_days_and_backfill(spark):
    ledger = ledger_rows(spark.createDataFrame([("d_2024-01-29",)], "u string"), "u", "2024-02-01", "x")
    p = pending_days(spark, "2024-01-31", 3, ledger, "d")
    assert sorted(str(r.day) for r in p.collect()) == ["2024-01-28", "2024-01-30"]
    data = spark.createDataFrame([(dt.datetime(2024, 1, d, 5), 1.0) for d in (27, 28, 29, 30, 30)], "ts timestamp_ntz, v double")
    out = backfill(data, F.to_date("ts"), p, lambda r: r.groupBy("day").agg(F.sum("v").alias("s")))
    assert sorted((str(r.day), r.s) for r in out.collect()) == [("2024-01-28", 1.0), ("2024-01-30", 2.0)]


def test_ledger_append_and_pending(spark, tmp_out):
    work = spark.createDataFrame([("a",), ("b",)], "id string")
    mark_done(f"{tmp_out}/ledger", work.filter("id = 'a'"), "id", "2024-01-01")
    led = spark.read.parquet(f"{tmp_out}/ledger")
    assert [r.id for r in pending_only(work, led, "id").collect()] == ["b"]
    assert value_exists(led, "update_id", "a").first().value_exists is True
    assert value_exists(empty_ledger(spark), "update_id", "a").first().value_exists is False


def test_statements_end_outside_of_quotes_and_comments():
    assert statements("select 'a;\nb' as x; -- note;") == ["select 'a;\nb' as x"]
    assert statements("/* one; two */ select 1; select `a;b`, 'it''s;', 'c\\';d' -- end; \n from t;\n;;") == [
        "/* one; two */ select 1",
        "select `a;b`, 'it''s;', 'c\\';d' -- end; \n from t",
    ]
    assert statements('select 1;select "x;""y";\r\nselect 2') == ["select 1", 'select "x;""y"', "select 2"]
    assert statements(" ; -- nothing\n") == []


def test_a_value_is_bound_where_its_name_is_not_quoted(spark):
    sql = "create or replace temporary view bound_v as select id from range(9) where id > :m; select id, ':n' as t from bound_v where id < :top -- :other"
    assert [(r.id, r.t) for r in run_script(spark, sql, {"m": 5, "top": 8, "n": 1, "other": 2}).collect()] == [(6, ":n"), (7, ":n")]


def test_scripts_bind_values_and_check_identifiers(spark):
    spark.createDataFrame([(1,), (5,)], "x int").createOrReplaceTempView("core_t")
    assert run_script(spark, "select x from {core}_t where x > :m", {"m": 2}, {"core": "core"}).collect()[0].x == 5
    with pytest.raises(ValueError):
        render_script("select * from {core}_t", {"core": "core; drop"})
    v = view_from_script(spark, "v_t", "select count(*) as n from {core}_t", None, {"core": "core"})
    assert v.first().n == 2


def test_unload_reload_single_and_parallel(spark, tmp_out):
    df = spark.createDataFrame([(i, f"n|{i}" if i % 2 else f"n,{i}") for i in range(20)], "id int, name string")
    unload(df, f"{tmp_out}/single", delimiter="|", single=True)
    unload(df.repartition(3), f"{tmp_out}/par", delimiter=",")
    assert len([p for p in __import__("os").listdir(f"{tmp_out}/single") if p.startswith("part-")]) == 1
    a = load_delimited(spark, f"{tmp_out}/single", "id int, name string", f"{tmp_out}/ta", truncate=True, delimiter="|")
    b = load_delimited(spark, f"{tmp_out}/par", "id int, name string", f"{tmp_out}/tb", truncate=True)
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in df.collect()) == sorted(tuple(r) for r in b.collect())


def test_delimited_text_comes_back_as_it_was(spark, tmp_out):
    hard = ["a\nb", "", None, " pad ", 'say "hi"', "a,b", "/", '/"', '"/', "//", "\\Nx", "\\", "\r\n", '""', "/,\n\"", " "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(hard)], "id int, name string")
    for k, kw in enumerate(({}, {"delimiter": "|"}, {"header": True})):
        unload(df, f"{tmp_out}/u{k}", single=True, **kw)
        back = load_delimited(spark, f"{tmp_out}/u{k}", "id int, name string", f"{tmp_out}/t{k}", truncate=True, **kw)
        assert {r.id: r.name for r in back.collect()} == dict(enumerate(hard))


def parts(path):
    import os

    return sorted(os.path.getsize(f"{path}/{n}") for n in os.listdir(path) if n.startswith("part-"))


def test_a_single_file_is_cut_at_its_cap(spark, tmp_out):
    rows = [(i, ("x" * (i % 90)) + '"/,\n' if i % 3 else None, i / 7) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, name string, v double").repartition(7)
    for k, kw in enumerate(({}, {"header": True}, {"encode_line_ends": True})):
        unload(df, f"{tmp_out}/whole{k}", single=True, **kw)
        unload(df, f"{tmp_out}/cut{k}", single=True, max_bytes=10_000, **kw)
        whole, cut = parts(f"{tmp_out}/whole{k}"), parts(f"{tmp_out}/cut{k}")
        assert len(whole) == 1 and max(cut) <= 10_000 and len(cut) <= 1.3 * whole[0] / 10_000 + 1
        assert "header" in kw or sum(cut) == whole[0]
        back = read_delimited(spark, f"{tmp_out}/cut{k}", "id int, name string, v double", **kw)
        assert sorted((tuple(r) for r in back.collect()), key=repr) == sorted(rows, key=repr)
    with pytest.raises(ValueError):
        unload(df, f"{tmp_out}/none", single=True, max_bytes=50)
    unload(df.limit(0), f"{tmp_out}/empty", single=True)
    assert read_delimited(spark, f"{tmp_out}/empty", "id int, name string, v double").count() == 0


def test_a_single_file_is_written_by_many_tasks(spark, tmp_out, monkeypatch):
    import os

    from dimload.sources import io

    rows = [(i, ("x" * (i % 90)) + '"/,\n' if i % 3 else None, i / 7) for i in range(3000)]
    df = spark.createDataFrame(rows, "_piece int, name string, _of double")
    schema = "_piece int, name string, _of double"

    def unloaded(name, **kw):
        unload(df, f"{tmp_out}/{name}", single=True, **kw)
        names = sorted(n for n in os.listdir(f"{tmp_out}/{name}") if not n.endswith(".crc"))
        assert names[0] == "_SUCCESS" and all(n.startswith("part-") for n in names[1:])
        return [open(f"{tmp_out}/{name}/{n}", "rb").read() for n in names[1:]]

    kinds = ({}, {"header": True}, {"encode_line_ends": True}, {"max_bytes": 20_000}, {"max_bytes": 20_000, "header": True})
    by_one = [unloaded(f"one{k}", **kw) for k, kw in enumerate(kinds)]
    assert [len(f) for f in by_one[:3]] == [1, 1, 1] and len(by_one[3]) > 9 and b"".join(by_one[3]) == by_one[0][0]
    monkeypatch.setattr(io, "PART_BYTES", 2_000)
    for k, kw in enumerate(kinds):
        assert unloaded(f"one{k}", **kw) == by_one[k]  # in place of what was there
        back = read_delimited(spark, f"{tmp_out}/one{k}", schema, **{x: y for x, y in kw.items() if x != "max_bytes"})
        assert sorted((tuple(r) for r in back.collect()), key=repr) == sorted(rows, key=repr)
    options = io._format(",", False, '"', "/", "\\N") | {"quoteAll": "true", "lineSep": "\n"}
    parts, per_file = io._in_parts(df, options, 10**9, 2_000, f"{tmp_out}/stage")
    sizes = [r[1] for r in parts.groupBy(F.spark_partition_id()).agg(F.sum(F.octet_length(F.to_csv(F.struct("*"), options)) + 1)).collect()]
    assert len(sizes) == per_file > 50 and max(sizes) < 2_000 + 150 and sum(sizes) == len(by_one[0][0])
    monkeypatch.setattr(io, "local_path", lambda *_: None)  # a file system that takes no bytes at a place
    assert unloaded("elsewhere") == by_one[0]


def test_encoded_line_ends_let_files_be_split(spark, tmp_out):
    hard = ["a\nb", "%0A", "%", "%25", "\r\n%", None, "", '"\n"', "/\n", "%0\nA"] * 3000
    df = spark.createDataFrame(list(enumerate(hard)), "id int, name string")
    unload(df, f"{tmp_out}/u", single=True, encode_line_ends=True)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        back = read_delimited(spark, f"{tmp_out}/u", "id int, name string", encode_line_ends=True)
        assert back.rdd.getNumPartitions() > 4
        assert [r.name for r in back.orderBy("id").collect()] == hard
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_file_manifest_filters(spark, tmp_out):
    import os

    os.makedirs(f"{tmp_out}/m/sub")
    for n in ("a.csv", "b.csv.gz", "sub/c.csv.gz1", "d.txt"):
        open(f"{tmp_out}/m/{n}", "w").write("x")
    names = sorted(r.url.rsplit("/", 1)[1] for r in file_manifest(spark, [f"{tmp_out}/m"], ".csv").collect())
    assert names == ["a.csv", "b.csv.gz", "c.csv.gz1"]
    assert file_manifest(spark, [f"{tmp_out}/m"], "None").count() == 4


def test_catalog_tables_and_for_each(spark):
    from dimload.operators.multi import catalog_tables, for_each_table, row_count

    spark.sql("create database if not exists m1_tables")
    spark.createDataFrame([(1,), (2,)], "x int").write.mode("overwrite").saveAsTable("m1_tables.m1_a")
    spark.createDataFrame([(1,)], "y int").write.mode("overwrite").saveAsTable("m1_tables.m1_b")
    tables = {k.partition(".")[2]: v for k, v in catalog_tables(spark, "m1_tables").items()}
    got = {r.table_name: r.row_count for r in for_each_table(tables, row_count).collect()}
    assert got == {"m1_a": 2, "m1_b": 1}


def test_script_file_manifest_writer_and_is_done(spark, tmp_out):
    import json
    import os

    from dimload.sources.io import write_manifest
    from dimload.sources.ledger import is_done
    from dimload.sources.scripts import load_script

    os.makedirs(f"{tmp_out}/scripts/core")
    open(f"{tmp_out}/scripts/core/q.sql", "w").write("select count(*) as n from {0}_t where x > :m")
    spark.createDataFrame([(1,), (5,), (7,)], "x int").createOrReplaceTempView("stage_t")
    text = load_script(f"{tmp_out}/scripts", "core", "q")
    assert run_script(spark, text, {"m": 2}, positional=("stage",)).first().n == 2
    os.makedirs(f"{tmp_out}/files")
    open(f"{tmp_out}/files/a.csv", "w").write("1")
    write_manifest(file_manifest(spark, [f"{tmp_out}/files"], None), f"{tmp_out}/manifest")
    lines = [json.loads(l) for p in os.listdir(f"{tmp_out}/manifest") if p.endswith(".json") for l in open(f"{tmp_out}/manifest/{p}")]
    assert len(lines) == 1 and lines[0]["mandatory"] is True and lines[0]["url"].endswith("a.csv")
    led = ledger_rows(spark.createDataFrame([("u1",)], "id string"), "id", "2024-01-01")
    assert is_done(led, "u1").first().done is True and is_done(led, "u2").first().done is False


def test_for_each_catalog_table_with_pre_sql(spark):
    from dimload.operators.multi import for_each_catalog_table, row_count

    spark.sql("create database if not exists m1_pre")
    spark.createDataFrame([(1,), (2,), (3,)], "x int").write.mode("overwrite").saveAsTable("m1_pre.m1_src")
    spark.sql("drop table if exists m1_pre.m1_c")
    out = for_each_catalog_table(
        spark, "m1_pre", lambda n, df: row_count(n, df), pre_sql="create table m1_pre.m1_c using parquet as select * from m1_pre.m1_src where x > 1"
    )
    got = {r.table_name.partition(".")[2]: r.row_count for r in out.collect()}
    assert got["m1_c"] == 2 and got["m1_src"] == 3
