"""Micro-batches loaded with the batch operators; a replayed batch is skipped by the ledger."""

from pyspark.sql import functions as F

from dimload.operators.loads import load
from dimload.streaming.batches import ledger_guarded, start_stream_load


def test_stream_upserts_each_batch_once(spark, tmp_out):
    src_dir, target, ledger = f"{tmp_out}/in", f"{tmp_out}/target", f"{tmp_out}/ledger"
    schema = "k bigint, v string"
    spark.createDataFrame([], schema + ", etl_updated_timestamp timestamp_ntz, etl_deleted_flag boolean").write.parquet(target)
    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.mode("append").parquet(src_dir)

    def load_batch(df, batch_id):
        current = spark.read.parquet(target)
        new = load(current, df, "upsert", [("k", "k")], f"2024-01-01 00:00:{batch_id:02d}").cache()
        new.count()
        new.write.mode("overwrite").parquet(f"{tmp_out}/stage_{batch_id}")
        spark.read.parquet(f"{tmp_out}/stage_{batch_id}").write.mode("overwrite").parquet(target)

    fn = ledger_guarded(load_batch, ledger, "upsert_t", lambda b: "2024-01-01 00:00:00")
    stream = spark.readStream.schema(schema).parquet(src_dir)
    q = start_stream_load(stream, fn, f"{tmp_out}/ckpt")
    q.awaitTermination(120)
    spark.createDataFrame([(2, "b2"), (3, "c")], schema).write.mode("append").parquet(src_dir)
    q = start_stream_load(spark.readStream.schema(schema).parquet(src_dir), fn, f"{tmp_out}/ckpt")
    q.awaitTermination(120)
    got = sorted((r.k, r.v) for r in spark.read.parquet(target).collect())
    assert got == [(1, "a"), (2, "b2"), (3, "c")]
    # replaying batch 0 is a no-op
    fn(spark.createDataFrame([(1, "zzz")], schema), 0)
    assert sorted((r.k, r.v) for r in spark.read.parquet(target).collect()) == got
    assert sorted(r.update_id for r in spark.read.parquet(ledger).collect()) == ["upsert_t_0", "upsert_t_1"]
