"""Column functions F1-F12 and P4 evaluated by Spark."""

import datetime as dt

from pyspark.sql import functions as F

from dimload.functions import columns as X


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


def test_time_functions(spark):
    assert one(spark, X.default_end()) == dt.datetime(2400, 1, 1)
    assert one(spark, X.next_start(F.lit(None).cast("timestamp_ntz"))) == dt.datetime(1970, 1, 1)
    assert one(spark, X.next_start(X.ts_ntz("2024-01-01 00:00:00.999999"))) == dt.datetime(2024, 1, 1, 0, 0, 1)
    assert one(spark, X.key_timestamp_text(X.ts_ntz("2024-01-02 03:04:05"))) == "2024-01-02 03:04:05.000000"
    assert one(spark, X.truncate_to_second(X.ts_ntz("2024-01-02 03:04:05.9"))) == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, X.local_time(X.ts_ntz("2024-07-01 00:00:00"))) == dt.datetime(2024, 7, 1, 10, 0)
    assert one(spark, X.date_text(X.ts_ntz("2024-07-01 13:14:15"))) == "2024-07-01"
    assert one(spark, X.hour_text(X.ts_ntz("2024-07-01 13:14:15"))) == "2024-07-01 13:00:00"


def test_keys_and_differences(spark):
    df = spark.createDataFrame([(1, "a", dt.datetime(1970, 1, 1))], "k bigint, j string, st timestamp_ntz")
    assert df.select(X.derived_key(["k"], "st")).first()[0] == "11970-01-01 00:00:00.000000"
    assert df.select(X.derived_key(["k", "j"], "st")).first()[0] == "1|a1970-01-01 00:00:00.000000"
    pairs = spark.createDataFrame([(1, 1), (1, None), (None, None), (1, 2)], "a int, b int")
    assert [r[0] for r in pairs.select(X.differs(F.col("a"), F.col("b"))).collect()] == [False, True, False, True]
    assert one(spark, X.any_differs([])) is False


def test_path_functions(spark):
    df = spark.createDataFrame(
        [("s3://my-bucket/a/b/file.csv.gz",), ("S3://B/",), ("plain.txt",), ("dir/x.gz12",), ("dir/xgz",)], "u string"
    )
    out = df.select(
        X.bucket_of_url(F.col("u")).alias("b"),
        X.path_of_url(F.col("u")).alias("p"),
        X.directory_of_key(F.col("u")).alias("d"),
        X.file_of_key(F.col("u")).alias("f"),
        X.is_compressed(F.col("u")).alias("z"),
    ).collect()
    assert (out[0].b, out[0].p, out[0].d, out[0].f, out[0].z) == ("my-bucket", "a/b/file.csv.gz", "s3://my-bucket/a/b/", "file.csv.gz", True)
    assert (out[1].b, out[1].p) == ("B", "")
    assert (out[2].d, out[2].f, out[2].z) == ("", "plain.txt", False)
    assert out[3].z is True and out[4].z is True  # unescaped dot: 'xgz' matches too
    names = spark.createDataFrame([("core.customer",), ("orders",)], "n string")
    assert [r[0] for r in names.select(X.table_of_name(F.col("n"))).collect()] == ["customer", "orders"]
