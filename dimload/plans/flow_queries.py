"""Registered queries for keyed loads, snapshots, backfill, scripts, files and gated publish
(K3, K4, J3, L6-L10, S2-S6, S8, S10, Q2, Q6, Q7, F9-F12)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimload import constants as C
from dimload.functions.columns import bucket_of_url, directory_of_key, file_of_key, is_compressed, key_timestamp_text, path_of_url, table_of_name, ts_ntz
from dimload.operators.keys import add_keys, empty_keys, generate_keys, highest_key, keys_to_map, with_key
from dimload.operators.loads import keyed_load, load
from dimload.operators.quality import CheckFailed, expect_no_rows, expect_rows, combine_checks, unique_columns
from dimload.operators.publish import keyed_load_into, load_into
from dimload.operators.snapshots import backfill, backfill_into, pending_days, write_daily_snapshot
from dimload.plans import fixtures as fx
from dimload.plans import load_queries as lq
from dimload.session import scratch_path
from dimload.sources.io import file_manifest, load_delimited, manifest_names, mirror, unload
from dimload.sources.ledger import ledger_rows
from dimload.sources.versions import read_table, replace_table
from dimload.sources.scripts import refresh_into, refresh_table, run_script, view_from_script

AS_OF = "2024-03-15 08:30:45"
_TS = "'%Y-%m-%d %H:%M:%S.%f'"
CUST_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
KEYED_OUT = ["sk"] + CUST_COLS + [C.ETL_UPDATED, C.ETL_DELETED]


# --------------------------------------------------------------------------- K3 / K4 / J3


def q_keyed_view_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 -> K3 -> K4: customers with their surrogate key from a single source system."""
    c = fx.table(spark, sf_dir, "customer")
    keys = generate_keys(c, "c_custkey", empty_keys(spark, "dim_customer_sk"), "dim_customer_sk", AS_OF, "c_custkey", "core")
    return with_key(c, keys_to_map(keys, "dim_customer_sk"), "dim_customer_sk", "c_custkey", "c_custkey", "core")


def _two_systems(spark, sf_dir):
    c = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cid"), F.col("c_name").alias("name"), F.lit("cust").alias("sys"))
    s = fx.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("cid"), F.col("s_name").alias("name"), F.lit("supp").alias("sys"))
    return c.unionByName(s)


def q_keyed_view_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 / K4 / J3 with the source system as a row column (customer ∪ supplier)."""
    u = _two_systems(spark, sf_dir)
    keys = generate_keys(u, "cid", empty_keys(spark, "sk"), "sk", AS_OF, "cid", F.col("sys"))
    return with_key(u, keys_to_map(keys, "sk"), "sk", "cid", "cid", F.col("sys"))


def _lineitem_keys(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    return li.select(F.concat_ws("|", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("k"), "l_orderkey")


_STATE: dict = {}


def _lineitem_keys0(spark, sf_dir) -> str:
    """The bucketed keys table after a first batch (even orders), stored once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STATE:
        cand = _lineitem_keys(spark, sf_dir).filter(F.col("l_orderkey") % 2 == 0)
        _STATE[key] = table = "line_keys_" + uuid.uuid4().hex[:12]
        add_keys(cand, "k", table, "sk", "2024-01-01 00:00:00", "l_orderkey|l_linenumber", "core")
    return _STATE[key]


def q_keys_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 on a compound key (l_orderkey | l_linenumber): a second batch numbered after the first, whose
    keys lie in a bucketed table."""
    table = _lineitem_keys0(spark, sf_dir)
    highest = highest_key(spark, table)
    new = generate_keys(_lineitem_keys(spark, sf_dir), "k", spark.table(table), "sk", AS_OF, "l_orderkey|l_linenumber", "core", highest=highest)
    return new.select("sk", F.col("originating_source_business_key").alias("k"))


def q_keys_lineitem_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 / K2 on a bucketed catalog table: both batches numbered and appended, all keys read back."""
    table = "line_keys_" + uuid.uuid4().hex[:12]
    every = _lineitem_keys(spark, sf_dir)
    for cand, as_of in ((every.filter(F.col("l_orderkey") % 2 == 0), "2024-01-01 00:00:00"), (every, AS_OF)):
        add_keys(cand, "k", table, "sk", as_of, "l_orderkey|l_linenumber", "core")
    return spark.table(table).select("sk", F.col("originating_source_business_key").alias("k"))


# --------------------------------------------------------------------------- L6 / L7 / L8


def _keyed_start(spark, sf_dir):
    """Previous run: keys for the even customers and a target keyed on them."""
    c = fx.table(spark, sf_dir, "customer")
    even = c.filter(F.col("c_custkey") % 2 == 0)
    keys0 = generate_keys(even, "c_custkey", empty_keys(spark, "sk"), "sk", "2024-01-01 00:00:00", "c_custkey", "core")
    map0 = keys_to_map(keys0, "sk")
    target0 = with_key(even, map0, "sk", "c_custkey", "c_custkey", "core").select(
        "sk", *CUST_COLS, ts_ntz(lq.TARGET_STAMP).alias(C.ETL_UPDATED), F.lit(False).alias(C.ETL_DELETED)
    )
    return keys0, map0, target0


def _keyed_source(spark, sf_dir):
    k = F.col("c_custkey")
    c = fx.table(spark, sf_dir, "customer").filter((k % 3 != 0) | (k % 2 != 0))
    return c.withColumn("c_acctbal", F.col("c_acctbal") + 1).select(*CUST_COLS)


def _keyed_out(df: DataFrame) -> DataFrame:
    return df.select(*[key_timestamp_text(F.col(c)).alias(c) if c == C.ETL_UPDATED else F.col(c) for c in KEYED_OUT])


def q_keyed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New keys (K1) -> source with key (K4) -> upsert on the surrogate key."""
    keys0, map0, target0 = _keyed_start(spark, sf_dir)
    out, _, _ = keyed_load(target0, _keyed_source(spark, sf_dir), keys0, map0, "sk", "c_custkey", "c_custkey", "core", AS_OF)
    return _keyed_out(out)


def _register_core(spark, sf_dir, *names):
    for n in names:
        fx.table(spark, sf_dir, n).createOrReplaceTempView(f"core_{n}")


SOURCE_SCRIPT = """
select c_custkey, c_name, c_nationkey, c_acctbal + :bump as c_acctbal, c_mktsegment
from {core}_customer where c_custkey % 3 <> 0 or c_custkey % 2 <> 0
"""


def q_keyed_load_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source is a view made from a parameterised script (S6), then L6 with upsert."""
    _register_core(spark, sf_dir, "customer")
    src = view_from_script(spark, "v_keyed_customer_src", SOURCE_SCRIPT, {"bump": 1}, {"core": "core"})
    keys0, map0, target0 = _keyed_start(spark, sf_dir)
    out, _, _ = keyed_load(target0, src, keys0, map0, "sk", "c_custkey", "c_custkey", "core", AS_OF)
    return _keyed_out(out)


KEY_SCRIPT = "select c_custkey from {core}_customer where c_custkey % 3 <> 0 or c_custkey % 2 <> 0"
LOAD_SCRIPT = """
select m.sk, c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal + :bump as c_acctbal, c.c_mktsegment
from {core}_customer c
join {keys}_map_customer m
  on cast(c.c_custkey as string) = m.source_business_key
 and m.source_business_key_name = 'c_custkey' and m.source_system_code = 'core'
where c.c_custkey % 3 <> 0 or c.c_custkey % 2 <> 0
"""


def q_keyed_load_two_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys from script view A; the load reads script view B that looks its keys up itself."""
    _register_core(spark, sf_dir, "customer")
    key_src = view_from_script(spark, "v_customer_keys", KEY_SCRIPT, None, {"core": "core"})
    keys0, map0, target0 = _keyed_start(spark, sf_dir)

    def load_view(full_map: DataFrame) -> DataFrame:
        full_map.createOrReplaceTempView("keys_map_customer")
        return view_from_script(spark, "v_customer_with_key", LOAD_SCRIPT, {"bump": 1}, {"core": "core", "keys": "keys"})

    out, _, _ = keyed_load(target0, None, keys0, map0, "sk", "c_custkey", "c_custkey", "core", AS_OF, key_source=key_src, load_source=load_view)
    return _keyed_out(out)


# --------------------------------------------------------------------------- L9 snapshots


def _snap_base(spark, sf_dir, name):
    c = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    base = scratch_path(spark, name)
    write_daily_snapshot(c.filter(F.col("c_custkey") % 2 == 0), base, "2024-01-01")
    write_daily_snapshot(c.filter((F.col("c_custkey") % 3 == 0) | (F.col("c_custkey") % 2 != 0)), base, "2024-01-02")
    return c, base


def _snap_read(spark, base):
    df = read_table(spark, base)
    return df.select("c_custkey", "c_name", "c_acctbal", F.date_format("snapshot_date", "yyyy-MM-dd").alias("snapshot_date"))


def q_daily_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily snapshots of customer, one static partition per day."""
    _, base = _snap_base(spark, sf_dir, "snap")
    return _snap_read(spark, base)


def q_daily_snapshot_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L9 re-run: day 1 loaded again from a different source replaces only day 1."""
    c, base = _snap_base(spark, sf_dir, "snap_rerun")
    write_daily_snapshot(c.filter(F.col("c_custkey") % 5 == 0), base, "2024-01-01")
    return _snap_read(spark, base)


def q_daily_snapshot_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L9 with an empty source: the day is cleared (not left with its old rows)."""
    c, base = _snap_base(spark, sf_dir, "snap_empty")
    write_daily_snapshot(c.filter(F.lit(False)), base, "2024-01-02")
    return _snap_read(spark, base)


# --------------------------------------------------------------------------- L10 / S10 backfill


def _events_ledger(spark, sf_dir):
    """Ledger of earlier runs: every event day whose day of month is a multiple of 3 is done."""
    e = fx.table(spark, sf_dir, "events")
    done = e.select(F.to_date("ts").alias("day")).filter(F.dayofmonth("day") % 3 == 0).distinct()
    done = done.withColumn("update_id", F.concat(F.lit("daily_events_"), F.date_format("day", "yyyy-MM-dd")))
    return e, ledger_rows(done, "update_id", AS_OF, "events")


def _pending(spark, sf_dir):
    e, ledger = _events_ledger(spark, sf_dir)
    today = e.agg(F.date_add(F.max(F.to_date("ts")), 1).alias("today"))
    return e, pending_days(spark, today, 30, ledger, "daily_events")


def q_ledger_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the 30-day window (today excluded) that the ledger has not seen."""
    _, p = _pending(spark, sf_dir)
    return p.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "update_id")


def q_backfill_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily load for every pending day in one job (days stay separate groups)."""
    e, p = _pending(spark, sf_dir)

    def daily(rows: DataFrame) -> DataFrame:
        return rows.groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))

    out = backfill(e, F.to_date("ts"), p, daily)
    return out.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "event_type", "n", "total")


# --------------------------------------------------------------------------- S5 / S6 / S8


SUMMARY_SCRIPT = """
select o_orderstatus, count(*) as n, round(sum(o_totalprice), 2) as total
from {core}_orders where o_orderdate >= cast(:since as timestamp_ntz)
group by o_orderstatus
"""


def q_script_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregate script with a layer name and a bound parameter."""
    _register_core(spark, sf_dir, "orders")
    return run_script(spark, SUMMARY_SCRIPT, {"since": "1996-01-01 00:00:00"}, {"core": "core"})


VIEW_SCRIPT = "select c_nationkey, c_mktsegment, count(*) as n from {core}_customer group by c_nationkey, c_mktsegment"


def q_script_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view created from a script, then read."""
    _register_core(spark, sf_dir, "customer")
    view_from_script(spark, "v_customers_per_nation", VIEW_SCRIPT, None, {"core": "core"}, drop_first=True)
    return spark.table("v_customers_per_nation")


def q_refresh_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An orders summary refreshed into an existing table's columns via staging."""
    o = fx.table(spark, sf_dir, "orders")
    summary = o.groupBy("o_orderstatus").agg(
        F.round(F.sum("o_totalprice"), 2).alias("TOTAL_PRICE"),
        F.count(F.lit(1)).alias("order_count"),
        F.max("o_orderdate").alias("last_order"),
    )
    target = spark.createDataFrame([], "o_orderstatus string, order_count bigint, total_price double")
    rows = refresh_table(target, summary)
    return replace_table(rows, scratch_path(spark, "refresh_target"))


# --------------------------------------------------------------------------- S2 / S4 / S3


def q_unload_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 + S2: nation unloaded as one file ('|'), region in parallel (','); both loaded back."""
    n_path, r_path = scratch_path(spark, "unload_nation"), scratch_path(spark, "unload_region")
    unload(fx.table(spark, sf_dir, "nation"), n_path, delimiter="|", single=True)
    unload(fx.table(spark, sf_dir, "region"), r_path, delimiter=",")
    n = load_delimited(spark, n_path, "n_nationkey int, n_name string, n_regionkey int", scratch_path(spark, "nation_t"), truncate=True, delimiter="|")
    r = load_delimited(spark, r_path, "r_regionkey int, r_name string", scratch_path(spark, "region_t"), truncate=True)
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "n_regionkey", "r_name")


DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def q_unload_reload_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 + S2 on whole texts with line ends, quotes, delimiters, padding, '' and NULL."""
    d = fx.table(spark, sf_dir, "documents")
    k = F.col("doc_id") % 10
    hard = F.when(k == 1, F.lit("")).when(k == 2, F.concat(F.lit(' "/", \\N'), "text", F.lit('/" '))).when(k == 3, F.lit(None).cast("string")).otherwise(F.col("text"))
    path = scratch_path(spark, "unload_documents")
    unload(d.select("doc_id", hard.alias("text"), "lang", "source", "n_chars"), path)
    return load_delimited(spark, path, DOC_SCHEMA, scratch_path(spark, "documents_t"), truncate=True)


def q_unload_reload_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 + S2 with encoded line ends: the same texts in one file, read back in parallel splits."""
    d = fx.table(spark, sf_dir, "documents")
    k = F.col("doc_id") % 10
    hard = F.when(k == 1, F.lit("")).when(k == 2, F.concat(F.lit(' "/", \\N%0A'), "text", F.lit('/" \r%'))).when(k == 3, F.lit(None).cast("string")).otherwise(F.col("text"))
    path = scratch_path(spark, "unload_split")
    unload(d.select("doc_id", hard.alias("text"), "lang", "source", "n_chars"), path, single=True, encode_line_ends=True)
    return load_delimited(spark, path, DOC_SCHEMA, scratch_path(spark, "documents_s"), truncate=True, encode_line_ends=True)


def q_url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F9-F12 over the pages' urls and table names derived from them."""
    p = fx.table(spark, sf_dir, "pages")
    path = F.concat(path_of_url(F.col("url")), F.when(F.col("page_id") % 2 == 0, F.lit(".gz")).otherwise(F.lit(".txt")))
    name = F.concat(F.lit("core."), F.regexp_replace(bucket_of_url(F.col("url")), r"\.", "_"))
    return p.select(
        "page_id",
        bucket_of_url(F.col("url")).alias("bucket"),
        path_of_url(F.col("url")).alias("path"),
        directory_of_key(path).alias("directory"),
        file_of_key(path).alias("file"),
        is_compressed(path).alias("compressed"),
        table_of_name(name).alias("table_name"),
    )


STEPS_SCRIPT = """
create or replace temporary view steps_orders as
  select o_orderstatus, o_totalprice from {core}_orders where o_totalprice >= :least;
create or replace temporary view steps_sums as
  select o_orderstatus, count(*) as n, max(o_totalprice) as top from steps_orders group by o_orderstatus;
select o_orderstatus, n, top from steps_sums where n > 0
"""


def q_script_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A script of three statements, the last one's rows."""
    _register_core(spark, sf_dir, "orders")
    return run_script(spark, STEPS_SCRIPT, {"least": 1000}, {"core": "core"})


def q_permanent_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A permanent view over a stored catalog table."""
    name = "stored_" + uuid.uuid4().hex[:12]
    fx.table(spark, sf_dir, "customer").write.saveAsTable(name)
    script = "select c_mktsegment, count(*) as n, min(c_custkey) as least from {table} group by c_mktsegment"
    return view_from_script(spark, f"default.v_{name}", script, layers={"table": name}, permanent=True)


def q_refresh_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table of the old orders refreshed with all orders, in its own columns."""
    o = fx.table(spark, sf_dir, "orders")
    path = scratch_path(spark, "refresh_existing")
    mirror(o.filter(F.col("o_orderkey") % 2 == 0).select("o_orderkey", F.col("o_totalprice").cast("float").alias("o_totalprice")), path)
    return refresh_into(o.select("O_TOTALPRICE", "o_orderkey", "o_custkey").withColumn("O_TOTALPRICE", F.lit(2.5)), path)


def q_keyed_load_on_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6 on storage: keys and map appended, target rewritten, ledger marked; a re-run is skipped."""
    keys0, map0, target0 = _keyed_start(spark, sf_dir)
    root = scratch_path(spark, "keyed_storage")
    for name, df in (("keys", keys0), ("map", map0), ("target", target0)):
        df.write.parquet(f"{root}/{name}")
    for _ in range(2):
        keyed_load_into(
            spark, "customers_1", f"{root}/target", f"{root}/keys", f"{root}/map", f"{root}/ledger",
            _keyed_source(spark, sf_dir), "sk", "c_custkey", "c_custkey", "core", AS_OF,
        )
    return _keyed_out(read_table(spark, f"{root}/target"))


def q_load_into_text_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2 on storage over a nullable text partition with leading zeros, matched on a cast key."""
    e = fx.table(spark, sf_dir, "events")
    k = F.col("event_id")
    part = F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(F.lpad((k % 5).cast("string"), 2, "0"))
    old = e.filter(k % 3 != 0).select("event_id", "ts", "value", part.alias("part"), ts_ntz(AS_OF).alias(C.ETL_UPDATED), F.lit(False).alias(C.ETL_DELETED))
    path = scratch_path(spark, "events_by_part")
    old.write.partitionBy("part").parquet(path)
    new = e.filter((k % 2 == 0) | (k % 3 == 0)).select(F.col("event_id").cast("string").alias("event_id"), "ts", (k % 100).cast("double").alias("value"), part.alias("part"))
    new = new.withColumn("part", F.when(k % 4 == 0, F.lit("09")).otherwise(F.col("part")))
    out = load_into(path, new, "upsert", [("event_id", "event_id", "bigint")], AS_OF, partition_cols=["part"])
    return out.select("event_id", "value", "part")


def q_backfill_on_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L10 on storage, ordered: each pending day carries the running count of the days before."""
    e = fx.table(spark, sf_dir, "events")
    root = scratch_path(spark, "backfill_storage")
    today = e.agg(F.date_add(F.max(F.to_date("ts")), 1).alias("today"))
    _events_ledger(spark, sf_dir)[1].write.parquet(f"{root}/ledger")

    def daily(rows: DataFrame, before: DataFrame | None) -> DataFrame:
        day = rows.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
        if before is None:
            return day.withColumn("running", F.col("n"))
        return day.crossJoin(before.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("_n"))).select("day", "n", (F.col("n") + F.col("_n")).alias("running"))

    for _ in range(2):  # the second run finds nothing pending
        backfill_into(spark, e, F.to_date("ts"), daily, f"{root}/days", f"{root}/ledger", "daily_events", today, 5, AS_OF, ordered=True)
    return read_table(spark, f"{root}/days").select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n", "running")


def q_backfill_repeated_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L10 on storage: pending days loaded, then loaded again (their marks were lost) from events without
    those of every second day: the repeated days without rows have none, the others are as they were."""
    e = fx.table(spark, sf_dir, "events")
    root = scratch_path(spark, "backfill_repeated")
    today = e.agg(F.date_add(F.max(F.to_date("ts")), 1).alias("today"))

    def daily(rows: DataFrame) -> DataFrame:
        return rows.groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n"))

    for k, events in enumerate((e, e.filter(F.dayofmonth("ts") % 2 == 0))):
        backfill_into(spark, events, F.to_date("ts"), daily, f"{root}/days", f"{root}/ledger{k}", "daily_events", today, 10, AS_OF)
    return read_table(spark, f"{root}/days").select(F.date_format("day", "yyyy-MM-dd").alias("day"), "event_type", "n")


def q_file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of the data folder filtered on '.parquet', file names only."""
    m = file_manifest(spark, [sf_dir], ".parquet")
    return manifest_names(m).select("file_name", "mandatory", is_compressed(F.col("file_name")).alias("compressed"))


# --------------------------------------------------------------------------- Q2 / Q6 / Q7


def _stored_target(spark, sf_dir, name):
    path = scratch_path(spark, name)
    mirror(lq.load_target(spark, sf_dir), path)
    return path, spark.read.parquet(path)


def _gate(spark, sf_dir, name, checks, post_step=None):
    from dimload.operators.quality import gated_publish

    path, target = _stored_target(spark, sf_dir, name)
    new = load(target, lq.load_source(spark, sf_dir), "upsert", lq.KEYS, lq.LOAD_AS_OF)
    try:
        gated_publish(new, path, checks, post_step)
    except CheckFailed:
        pass
    return lq._out(read_table(spark, path))


def q_gated_load_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 / Q6: an upsert whose checks pass is published."""

    def checks(df):
        return combine_checks([expect_rows("records_exist", df), expect_no_rows("no_null_key", df.filter(F.col("o_orderkey").isNull()))])

    return _gate(spark, sf_dir, "gate_ok", checks)


def q_gated_load_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: the duplicated source keys break uniqueness, so the target stays as it was."""
    return _gate(spark, sf_dir, "gate_rejected", lambda df: unique_columns("unique_o_orderkey", df, ["o_orderkey"]))


def q_load_with_post_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: a post step (soft-delete cheap orders) runs after the load and before the checks."""

    def post(df: DataFrame) -> DataFrame:
        return df.withColumn(C.ETL_DELETED, F.when(F.col("o_totalprice") < 1000, F.lit(True)).otherwise(F.col(C.ETL_DELETED)))

    return _gate(spark, sf_dir, "post_step", lambda df: expect_rows("records_exist", df), post)


QUERIES = {
    "keyed_view_single": q_keyed_view_single,
    "keyed_view_multi": q_keyed_view_multi,
    "keys_lineitem": q_keys_lineitem,
    "keys_lineitem_stored": q_keys_lineitem_stored,
    "keyed_load": q_keyed_load,
    "keyed_load_script": q_keyed_load_script,
    "keyed_load_two_scripts": q_keyed_load_two_scripts,
    "daily_snapshot": q_daily_snapshot,
    "daily_snapshot_rerun": q_daily_snapshot_rerun,
    "daily_snapshot_empty": q_daily_snapshot_empty,
    "ledger_pending": q_ledger_pending,
    "backfill_days": q_backfill_days,
    "script_query": q_script_query,
    "script_view": q_script_view,
    "refresh_table": q_refresh_table,
    "unload_reload": q_unload_reload,
    "unload_reload_documents": q_unload_reload_documents,
    "unload_reload_split": q_unload_reload_split,
    "url_parts": q_url_parts,
    "script_statements": q_script_statements,
    "permanent_view": q_permanent_view,
    "refresh_existing": q_refresh_existing,
    "keyed_load_on_storage": q_keyed_load_on_storage,
    "load_into_text_partitions": q_load_into_text_partitions,
    "backfill_on_storage": q_backfill_on_storage,
    "backfill_repeated_day": q_backfill_repeated_day,
    "file_manifest": q_file_manifest,
    "gated_load_ok": q_gated_load_ok,
    "gated_load_rejected": q_gated_load_rejected,
    "load_with_post_step": q_load_with_post_step,
}

# --------------------------------------------------------------------------- oracles

_KEYED = f"""
with k0 as (select row_number() over (order by md5(cast(c_custkey as varchar)), cast(c_custkey as varchar)) as sk,
    cast(c_custkey as varchar) as v from customer where c_custkey % 2 = 0),
s as (select c_custkey, c_name, c_nationkey, c_acctbal + 1 as c_acctbal, c_mktsegment from customer where c_custkey % 3 <> 0 or c_custkey % 2 <> 0),
nv as (select distinct cast(c_custkey as varchar) as v from s where cast(c_custkey as varchar) not in (select v from k0)),
k1 as (select (select max(sk) from k0) + row_number() over (order by md5(v), v) as sk, v from nv),
m as (select * from k0 union all select * from k1),
t0 as (select k0.sk, c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment,
    timestamp '{lq.TARGET_STAMP}' as etl_updated_timestamp, false as etl_deleted_flag
  from customer c join k0 on cast(c.c_custkey as varchar) = k0.v),
sk_src as (select m.sk, s.* from s join m on cast(s.c_custkey as varchar) = m.v),
r as (select * from t0 where sk not in (select sk from sk_src)
  union all select *, timestamp '{AS_OF}', false from sk_src)
select sk, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, strftime(etl_updated_timestamp, {_TS}) as etl_updated_timestamp, etl_deleted_flag from r
"""

_SNAP = """
with snap as (select c_custkey, c_name, c_acctbal, '2024-01-01' as snapshot_date from customer where c_custkey % {d1} = 0
  union all select c_custkey, c_name, c_acctbal, '2024-01-02' from customer where (c_custkey % 3 = 0 or c_custkey % 2 <> 0) {and_d2})
select * from snap
"""

_PENDING = """
with ev as (select cast(ts as date) as day, event_type, value from events),
win as (select cast(d as date) as day from generate_series((select max(day) from ev) - interval 29 day, (select max(day) from ev), interval 1 day) t(d)),
ledger as (select distinct 'daily_events_' || strftime(day, '%Y-%m-%d') as update_id from ev where dayofmonth(day) % 3 = 0),
pending as (select day, 'daily_events_' || strftime(day, '%Y-%m-%d') as update_id from win
  where 'daily_events_' || strftime(day, '%Y-%m-%d') not in (select update_id from ledger))
"""

ORACLES = {
    "keyed_view_single": """with k as (select row_number() over (order by md5(cast(c_custkey as varchar)), cast(c_custkey as varchar)) as dim_customer_sk,
    cast(c_custkey as varchar) as v from (select distinct c_custkey from customer))
select k.dim_customer_sk, c.* from customer c join k on cast(c.c_custkey as varchar) = k.v""",
    "keyed_view_multi": """with u as (select c_custkey as cid, c_name as name, 'cust' as sys from customer
  union all select s_suppkey, s_name, 'supp' from supplier),
k as (select row_number() over (order by md5(cast(cid as varchar)), cast(cid as varchar), sys) as sk, cast(cid as varchar) as v, sys
  from (select distinct cid, sys from u))
select k.sk, u.cid, u.name, u.sys from u join k on cast(u.cid as varchar) = k.v and u.sys = k.sys""",
    "keys_lineitem": """with c as (select distinct cast(l_orderkey as varchar) || '|' || cast(l_linenumber as varchar) as k, l_orderkey % 2 = 0 as first_batch from lineitem),
k0 as (select row_number() over (order by md5(k), k) as sk, k from c where first_batch)
select (select max(sk) from k0) + row_number() over (order by md5(k), k) as sk, k from c where k not in (select k from k0)""",
    "keys_lineitem_stored": """with c as (select distinct cast(l_orderkey as varchar) || '|' || cast(l_linenumber as varchar) as k, l_orderkey % 2 = 0 as first_batch from lineitem)
select row_number() over (order by first_batch desc, md5(k), k) as sk, k from c""",
    "keyed_load": _KEYED,
    "keyed_load_script": _KEYED,
    "keyed_load_two_scripts": _KEYED,
    "daily_snapshot": _SNAP.format(d1=2, and_d2=""),
    "daily_snapshot_rerun": _SNAP.format(d1=5, and_d2=""),
    "daily_snapshot_empty": _SNAP.format(d1=2, and_d2="and false"),
    "ledger_pending": _PENDING + "select strftime(day, '%Y-%m-%d') as day, update_id from pending",
    "backfill_days": _PENDING
    + """select strftime(day, '%Y-%m-%d') as day, event_type, count(*) as n, round(sum(value), 4) as total
from ev where day in (select day from pending) group by day, event_type""",
    "script_query": """select o_orderstatus, count(*) as n, round(sum(o_totalprice), 2) as total from orders
where o_orderdate >= timestamp '1996-01-01 00:00:00' group by o_orderstatus""",
    "script_view": "select c_nationkey, c_mktsegment, count(*) as n from customer group by c_nationkey, c_mktsegment",
    "refresh_table": "select o_orderstatus, count(*) as order_count, round(sum(o_totalprice), 2) as total_price from orders group by o_orderstatus",
    "file_manifest": """select parse_filename(file) as file_name, true as mandatory,
  regexp_matches(parse_filename(file), '.*(.gz)\\d*$') as compressed
from glob('/root/testdata/sf0.01/*') where file like '%.parquet%'""",
    "unload_reload": "select n.n_nationkey, n.n_name, n.n_regionkey, r.r_name from nation n join region r on n.n_regionkey = r.r_regionkey",
    "unload_reload_documents": """select doc_id, case doc_id % 10 when 1 then '' when 2 then ' "/", \\N' || text || '/" ' when 3 then null else text end as text,
  lang, source, n_chars from documents""",
    "unload_reload_split": """select doc_id, case doc_id % 10 when 1 then '' when 2 then ' "/", \\N%0A' || text || '/" ' || chr(13) || '%' when 3 then null else text end as text,
  lang, source, n_chars from documents""",
    "url_parts": """with u as (select page_id, regexp_extract(url, '(?i)^[a-z0-9]+://([^/]+)/(.*)$', 1) as bucket,
    regexp_extract(url, '(?i)^[a-z0-9]+://([^/]+)/(.*)$', 2) as path from pages),
k as (select *, path || case when page_id % 2 = 0 then '.gz' else '.txt' end as key from u)
select page_id, bucket, path, regexp_extract(key, '^(.*/)(.*)$', 1) as directory,
  case when contains(key, '/') then regexp_extract(key, '^(.*/)(.*)$', 2) else key end as file,
  regexp_matches(key, '.*(.gz)\\d*$') as compressed, replace(bucket, '.', '_') as table_name from k""",
    "script_statements": "select o_orderstatus, count(*) as n, max(o_totalprice) as top from orders where o_totalprice >= 1000 group by o_orderstatus",
    "permanent_view": "select c_mktsegment, count(*) as n, min(c_custkey) as least from customer group by c_mktsegment",
    "refresh_existing": "select o_orderkey, cast(2.5 as float) as o_totalprice from orders",
    "keyed_load_on_storage": _KEYED,
    "load_into_text_partitions": """with e as (select event_id, value, case when event_id % 7 = 0 then null else lpad(cast(event_id % 5 as varchar), 2, '0') end as part from events),
s as (select event_id, cast(event_id % 100 as double) as value, case when event_id % 4 = 0 then '09' else part end as part from e where event_id % 2 = 0 or event_id % 3 = 0)
select * from e where event_id % 3 <> 0 and event_id not in (select event_id from s) union all select * from s""",
    "backfill_on_storage": _PENDING
    + """, d as (select day, count(*) as n from ev where day in (select day from pending where day > (select max(day) from ev) - interval 5 day) group by day)
select strftime(day, '%Y-%m-%d') as day, n, cast(sum(n) over (order by day) as bigint) as running from d""",
    "backfill_repeated_day": """with e as (select cast(ts as date) as day, event_type from events)
select strftime(day, '%Y-%m-%d') as day, event_type, count(*) as n from e
where day > (select max(day) from e) - interval 10 day and dayofmonth(day) % 2 = 0 group by all""",
    "gated_load_ok": lq.LOAD_CTE + lq._UPSERT + lq._SEL + "r",
    "gated_load_rejected": lq.LOAD_CTE + lq._SEL + "t",
    "load_with_post_step": lq.LOAD_CTE
    + lq._UPSERT
    + ", p as (select * replace (case when o_totalprice < 1000 then true else etl_deleted_flag end as etl_deleted_flag) from r) "
    + lq._SEL
    + "p",
}
