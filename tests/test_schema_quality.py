"""Schema operators, predicates, checks and the gated publish."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimload.operators import predicates as P
from dimload.operators import schema as S
from dimload.operators.quality import CheckFailed, gated_publish, null_key_report, unique_columns
from dimload.operators.scd import ScdSpec


def test_empty_like_strips_and_adds_metadata(spark):
    src = spark.createDataFrame([], "id bigint, name string, etl_updated_timestamp timestamp, etl_deleted_flag boolean, originating_business_key_name string, originating_source_system_code string")
    spec = ScdSpec(business_keys=("id",), scd2_columns=("name",), surrogate_key="dim_x_sk")
    cols = S.empty_like(src, add_dim_metadata=True, spec=spec).columns
    assert cols == ["id", "name", "etl_updated_timestamp", "etl_deleted_flag", "row_effective_timestamp", "row_expiry_timestamp",
                    "row_update_timestamp", "row_current_flag", "etl_inserted_timestamp", "dim_x_sk"]


def test_add_and_align_columns(spark):
    t = spark.createDataFrame([(1,)], "id int")
    t2 = S.add_column(S.add_column(t, "ok", "boolean"), "note", "string", "n/a")
    assert tuple(t2.first()) == (1, False, "n/a")
    s = spark.createDataFrame([], "id int, Extra double, etl_deleted_flag boolean")
    a = S.align_columns(t, s)
    assert a.columns == ["id", "Extra"] and a.first()["Extra"] is None


def test_clean_names_and_specs(spark):
    assert S.clean_name(" a b-c$ ") == "a_b_c_"
    assert S.quoted_name("user") == "`user`"
    f = S.spec_field({"name": "amt", "datatype": "currency", "mandatory": True})
    assert f.dataType == T.DecimalType(18, 2) and not f.nullable
    assert S.spec_field("row_valid", "name_only").dataType == T.BooleanType()
    assert S.spec_field("plain", "name_only").dataType == T.StringType()
    assert S.spec_field({"target_column": {"name": "t", "datatype": "ticks"}}, "target").dataType == T.TimestampNTZType()


def test_conform_mandatory_raises(spark):
    schema = S.schema_from_specs([{"name": "id", "datatype": "int", "mandatory": True}], add_etl_metadata=False)
    df = spark.createDataFrame([(None,)], "id int")
    with pytest.raises(Exception):
        S.conform(df, schema, fail_on_mandatory=True).collect()


def test_common_columns_case_insensitive():
    assert P.common_columns(["A", "b", "etl_updated_timestamp", "C"], ["a", "c", "etl_updated_timestamp"]) == ["A", "C"]


def test_join_condition_with_cast_and_delete_condition(spark):
    l = spark.createDataFrame([(1, "x"), (2, "y")], "a int, t string")
    r = spark.createDataFrame([("1",), ("2",)], "b string")
    cond = P.join_condition([("b", "a", "string")], l, r, delete_condition="t = 'x'")
    assert [x.a for x in l.join(r, cond).collect()] == [1]


def test_unique_and_null_key_report(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (None, 3)], "a int, b int")
    assert unique_columns("u", df, ["a"]).first().violations == 1
    rep = {(r.side, r.key_column): r.null_rows for r in null_key_report(df, df, [("b", "a")]).collect()}
    assert rep == {("left", "a"): 1, ("right", "b"): 1}


def test_gated_publish_rejects_and_keeps_target(spark, tmp_out):
    target = f"{tmp_out}/t"
    spark.createDataFrame([(1,)], "id int").write.parquet(target)
    new = spark.createDataFrame([(1,), (1,)], "id int")
    with pytest.raises(CheckFailed):
        gated_publish(new, lambda d: d.write.mode("overwrite").parquet(target), lambda d: unique_columns("u", d, ["id"]), stage_path=f"{tmp_out}/stage")
    assert spark.read.parquet(target).count() == 1
    ok = spark.createDataFrame([(2,), (3,)], "id int")
    gated_publish(ok, lambda d: d.write.mode("overwrite").parquet(target), lambda d: unique_columns("u", d, ["id"]), post_step=lambda d: d.withColumn("id", F.col("id") * 10), stage_path=f"{tmp_out}/stage2")
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [20, 30]


def test_spec_file_types_are_the_tables_default():
    from dimload.operators.schema import spec_field

    entry = {"source_column": {"name": "n", "datatype": "bigint", "mandatory": True}}
    for kind in ("use_spec_file", "use_spec_file_but_ignoreheader"):
        assert spec_field(entry, kind).dataType.simpleString() == "string"
        assert spec_field(entry, kind, default_type="double").dataType.simpleString() == "double"
    assert spec_field({"mine": {"name": "n", "datatype": "bigint"}}, "mine").dataType.simpleString() == "bigint"


def test_catalog_tables_leaves_session_views_out(spark):
    from dimload.operators.multi import catalog_tables

    spark.sql("create database if not exists only_views")
    spark.range(3).createOrReplaceTempView("a_view")
    assert catalog_tables(spark, "only_views") == {}


def test_post_step_runs_once_and_may_read_the_target(spark, tmp_out):
    from dimload.operators.quality import expect_rows, gated_publish

    path = f"{tmp_out}/target"
    spark.range(5).write.parquet(path)
    rows = spark.range(3)
    gated_publish(rows, lambda df: df.write.mode("overwrite").parquet(path), lambda df: expect_rows("r", df), lambda df: df.unionByName(spark.read.parquet(path)))
    assert spark.read.parquet(path).count() == 8
