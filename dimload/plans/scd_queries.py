"""Registered SCD queries (D0-D8, K1/K2 through the SCD) and their SQL oracles.

Two chained batches over ``customer`` (see ``fixtures``): batch 1 is a first load, batch 2 brings
type-2 changes, type-1 changes, NULLs, absent and new keys. Batch-1 state (dimension + keys) is
written once per session to the shared checkpoint folder, as a real first load would be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimload.operators.schema import describe_schema, empty_like
from dimload.operators.scd import ScdResult, ScdSpec, publish_with_keys, scd_checks, scd_load, scd_steps
from dimload.plans import fixtures as fx
from dimload.session import materialize, materialize_clustered, scratch_path
from dimload.sources.io import mirror
from dimload.sources.versions import read_table

AS_OF_3 = "2024-09-01 00:00:00"
_STATE: dict = {}


def _state_key(spark: SparkSession, sf_dir: str, name: str):
    return (spark.sparkContext.applicationId, sf_dir, name)


def dim0(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty dimension shaped like the batch-1 source, plus the default member."""
    empty = empty_like(fx.scd_source_1(spark, sf_dir), add_dim_metadata=True, spec=fx.SCD_SPEC)
    return empty.unionByName(fx.default_member(spark, empty))


def batch1(spark: SparkSession, sf_dir: str) -> ScdResult:
    """First load of batch 1 with its state materialised (dimension and keys)."""
    key = _state_key(spark, sf_dir, "batch1")
    if key not in _STATE:
        r = scd_load(dim0(spark, sf_dir), fx.scd_source_1(spark, sf_dir), fx.SCD_SPEC, fx.AS_OF_1, keys=None)
        # Stored clustered by business key, as a dimension table should be (bucketed on it), so
        # the next batch joins it without shuffling it.
        dim = materialize_clustered(r.dimension, list(fx.SCD_SPEC.business_keys))
        keys = materialize(r.new_keys)
        _STATE[key] = ScdResult(dim, keys, r.new_map, r.steps)
    return _STATE[key]


def batch2(spark: SparkSession, sf_dir: str) -> ScdResult:
    b1 = batch1(spark, sf_dir)
    return scd_load(b1.dimension, fx.scd_source_2(spark, sf_dir), fx.SCD_SPEC, fx.AS_OF_2, keys=b1.new_keys)


def line_batch1(spark: SparkSession, sf_dir: str) -> ScdResult:
    """First load of the order-line dimension, stored clustered by its compound key."""
    key = _state_key(spark, sf_dir, "line_batch1")
    if key not in _STATE:
        r = scd_load(None, fx.line_source_1(spark, sf_dir), fx.LINE_SPEC, fx.AS_OF_1)
        dim = materialize_clustered(r.dimension, list(fx.LINE_SPEC.business_keys))
        _STATE[key] = ScdResult(dim, materialize(r.new_keys), r.new_map, r.steps)
    return _STATE[key]


def q_scd_load_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D8 with a compound business key and two type-2 columns over the whole lineitem table."""
    b1 = line_batch1(spark, sf_dir)
    r = scd_load(b1.dimension, fx.line_source_2(spark, sf_dir), fx.LINE_SPEC, fx.AS_OF_2, keys=b1.new_keys)
    return fx.ts_text(r.dimension.select(*fx.LINE_OUT), cols=fx.LINE_TS, out=fx.LINE_OUT)


def _out(df: DataFrame, cols=fx.SCD_OUT) -> DataFrame:
    return fx.ts_text(df.select(*cols), out=cols)


# --------------------------------------------------------------------------- queries


def q_scd_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole SCD batch 2 on top of batch 1 -> the published dimension."""
    return _out(batch2(spark, sf_dir).dimension)


def q_scd_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D0 + E1 + D5 + D7 from no table: every row starts 1970-01-01, keys 1..n in md5 order."""
    r = scd_load(None, fx.scd_source_all(spark, sf_dir), fx.SCD_SPEC, fx.AS_OF_1, materialize=False)
    return _out(r.dimension)


def q_dim_create_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema of the empty dimension created from the source, one row per field."""
    return describe_schema(empty_like(fx.scd_source_1(spark, sf_dir), add_dim_metadata=True, spec=fx.SCD_SPEC))


def q_mirror_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer mirrored to a staging path and read back."""
    path = scratch_path(spark, "mirror_customer")
    return mirror(fx.table(spark, sf_dir, "customer"), path)


def _steps2(spark, sf_dir):
    b1 = batch1(spark, sf_dir)
    return scd_steps(b1.dimension, fx.scd_source_2(spark, sf_dir), fx.SCD_SPEC, fx.AS_OF_2)


def q_scd2_retire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows closed by batch 2."""
    return _out(_steps2(spark, sf_dir).retired)


def q_scd1_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 / P10: current rows whose type-1 columns batch 2 overwrote."""
    return _out(_steps2(spark, sf_dir).scd1_updated)


def q_scd_consume_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch-2 source rows left after removing keys that still have a current row."""
    return _steps2(spark, sf_dir).remaining.select("cid", "name", "seg", "bal")


def q_scd_insert_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New versions of batch 2 over batch 1 plus an expired history."""
    b1 = batch1(spark, sf_dir)
    dim = b1.dimension.unionByName(fx.history_rows(spark, sf_dir, b1.dimension))
    steps = scd_steps(dim, fx.scd_source_2(spark, sf_dir), fx.SCD_SPEC, fx.AS_OF_2)
    return _out(steps.inserted, fx.SCD_OUT[:-1])


def q_scd_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension invariants on what batch 2 wrote and the versions of its keys."""
    return scd_checks(_steps2(spark, sf_dir).touched, fx.SCD_SPEC)


def q_scd_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged batch published through the keys table (bk || start)."""
    b1 = batch1(spark, sf_dir)
    r = batch2(spark, sf_dir)
    keys = b1.new_keys.unionByName(r.new_keys)
    return _out(publish_with_keys(r.steps.dim, r.steps.staged, keys, fx.SCD_SPEC))


def q_keys_generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 / K2: keys of a first load of all customers (value, number), md5 order."""
    r = scd_load(None, fx.scd_source_all(spark, sf_dir), fx.SCD_SPEC, fx.AS_OF_1)
    return r.new_keys.select("sk", "originating_source_business_key", "originating_business_key_name", "originating_source_system_code", "active_flag")


def q_keys_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 on a second batch: only new keys, numbered after the current maximum."""
    return batch2(spark, sf_dir).new_keys.select("sk", "originating_source_business_key", "originating_business_key_name", "originating_source_system_code", "active_flag")


def q_scd_on_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D8 on storage: both batches through the ledger-guarded publish, dimension read back."""
    from dimload.operators.publish import initialize_dimension, read_dimension, run_scd_batch

    root = scratch_path(spark, "scd_storage")
    paths = dict(dim_path=f"{root}/dim", keys_path=f"{root}/keys", map_path=f"{root}/map", ledger_path=f"{root}/ledger")
    initialize_dimension(dim0(spark, sf_dir), fx.SCD_SPEC, paths["dim_path"])
    run_scd_batch(spark, fx.scd_source_1(spark, sf_dir), fx.SCD_SPEC, fx.AS_OF_1, "1", **paths)
    run_scd_batch(spark, fx.scd_source_2(spark, sf_dir), fx.SCD_SPEC, fx.AS_OF_2, "2", **paths)
    return _out(read_dimension(spark, paths["dim_path"], fx.SCD_SPEC))


EVENT_SPEC = ScdSpec(business_keys=("event_type", "user_id"), scd2_columns=("n",), surrogate_key="sk", current_col="cur", start_col="st", end_col="en", update_col="up")
EVENT_OUT = ["event_type", "user_id", "n", "last_id", "first_id", "cur", "st", "en", "up", "sk"]


def _event_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three batches of event counts by a compound key with a text part: new keys come with the
    second batch, and the third one brings a new column."""
    e = fx.table(spark, sf_dir, "events").groupBy("event_type", "user_id")
    core = e.agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_id"), F.min("event_id").alias("first_id"))
    user = F.col("user_id")
    second = core.withColumn("n", F.when(user % 3 == 0, F.col("n") + 1).otherwise(F.col("n"))).withColumn("last_id", F.when(user % 7 == 0, F.col("last_id") + 1).otherwise(F.col("last_id")))
    return [core.drop("first_id").filter(user % 5 != 0), second.drop("first_id"), second]


def _event_batches(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    from dimload.operators.publish import run_scd_batch

    root = scratch_path(spark, "scd_events")
    paths = dict(dim_path=f"{root}/dim", keys_path=f"{root}/keys", map_path=f"{root}/map", ledger_path=f"{root}/ledger")
    for k, (source, as_of) in enumerate(zip(_event_sources(spark, sf_dir), (fx.AS_OF_1, fx.AS_OF_2, AS_OF_3))):
        run_scd_batch(spark, source, EVENT_SPEC, as_of, str(k + 1), **paths)
    return paths


def q_scd_events_on_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D8 / F3 on storage: three batches on a compound key with a text part, one gains a column."""
    from dimload.operators.publish import read_dimension

    return _out(read_dimension(spark, _event_batches(spark, sf_dir)["dim_path"], EVENT_SPEC), EVENT_OUT)


def q_scd_events_keys_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 / K3 on storage: every key of the stored batches with its map row (null: an orphan)."""
    paths = _event_batches(spark, sf_dir)
    keys = read_table(spark, paths["keys_path"]).select("sk", F.col("originating_source_business_key").alias("k"))
    return keys.join(read_table(spark, paths["map_path"]).select("sk", F.col("source_business_key").alias("mapped")), "sk", "left")


QUERIES = {
    "scd_events_on_storage": q_scd_events_on_storage,
    "scd_events_keys_map": q_scd_events_keys_map,
    "scd_load": q_scd_load,
    "scd_on_storage": q_scd_on_storage,
    "scd_load_lines": q_scd_load_lines,
    "scd_first_load": q_scd_first_load,
    "dim_create_empty": q_dim_create_empty,
    "mirror_customer": q_mirror_customer,
    "scd2_retire": q_scd2_retire,
    "scd1_update": q_scd1_update,
    "scd_consume_source": q_scd_consume_source,
    "scd_insert_versions": q_scd_insert_versions,
    "scd_checks": q_scd_checks,
    "scd_publish": q_scd_publish,
    "keys_generate": q_keys_generate,
    "keys_incremental": q_keys_incremental,
}

# --------------------------------------------------------------------------- oracles

_TS = "'%Y-%m-%d %H:%M:%S.%f'"
AS1 = "timestamp '2024-01-01 00:00:00.000001'"
AS3 = "timestamp '2024-09-01 00:00:00'"
AS2 = "timestamp '2024-06-01 12:00:00.123456'"

SCD_CTE = f"""
with s1 as (select c_custkey as cid, c_name as name, c_mktsegment as seg, c_acctbal as bal from customer where c_custkey % 4 <> 0),
s2 as (select case when c_custkey % 13 = 0 then c_custkey + 1000000 else c_custkey end as cid, c_name as name,
  case when c_custkey % 17 = 0 then null when c_custkey % 7 = 0 then concat(c_mktsegment, '_X') else c_mktsegment end as seg,
  case when c_custkey % 5 = 0 then c_acctbal + 1 when c_custkey % 19 = 0 then null else c_acctbal end as bal
  from customer where c_custkey % 11 <> 0 or c_custkey % 4 = 0),
d1 as (select *, true as cur, timestamp '1970-01-01' as st, timestamp '2400-01-01' as en, cast(null as timestamp) as up,
  row_number() over (order by md5(cast(cid as varchar) || strftime(timestamp '1970-01-01', {_TS})), cid) as sk from s1),
j as (select d1.*, s2.cid is not null as m, s2.seg is distinct from d1.seg as x2,
  (s2.name is distinct from d1.name or s2.bal is distinct from d1.bal) as x1, s2.name as sn, s2.bal as sb
  from d1 left join s2 on d1.cid = s2.cid),
kept as (select cid, case when m and not x2 and x1 then sn else name end as name, seg,
  case when m and not x2 and x1 then sb else bal end as bal, not (m and x2) as cur, st,
  case when m and x2 then {AS2} else en end as en,
  case when m and not x2 and x1 then {AS2} end as up, sk from j),
mx as (select cid, max(en) as m, bool_or(cur) as has from kept group by cid),
ins as (select s2.cid, s2.name, s2.seg, s2.bal, true as cur,
  coalesce(mx.m + interval 1 microsecond, timestamp '1970-01-01') as st, timestamp '2400-01-01' as en,
  cast(null as timestamp) as up from s2 left join mx on s2.cid = mx.cid where not coalesce(mx.has, false)),
insk as (select *, (select max(sk) from d1) + row_number() over (order by md5(cast(cid as varchar) || strftime(st, {_TS})), cid) as sk from ins),
fin as (select * from kept union all select * from insk
  union all select -1, 'n/a', 'n/a', 0.0, true, timestamp '1970-01-01', timestamp '2400-01-01', null, -1)
"""


def _sel(src: str, cols=fx.SCD_OUT, where: str = "") -> str:
    parts = [f"strftime({c}, {_TS}) as {c}" if c in fx.SCD_TS else c for c in cols]
    return f"select {', '.join(parts)} from {src} {where}"


HIST_CTE = SCD_CTE.replace(
    "mx as (select cid, max(en) as m, bool_or(cur) as has from kept group by cid),",
    """h as (select c_custkey as cid, c_name as name, 'OLD' as seg, c_acctbal as bal, false as cur,
  timestamp '1960-01-01' as st, timestamp '1969-12-31' as en, cast(null as timestamp) as up, cast(null as bigint) as sk
  from customer where c_custkey % 3 = 0),
mx as (select cid, max(en) as m, bool_or(cur) as has from (select * from kept union all select * from h) group by cid),""",
)

ALL_CTE = SCD_CTE.replace("from customer where c_custkey % 4 <> 0)", "from customer)")
KEY_COLS = "sk, originating_source_business_key, originating_business_key_name, originating_source_system_code, active_flag"

ORACLES = {
    "scd_load": SCD_CTE + _sel("fin"),
    "scd_first_load": ALL_CTE + _sel("d1"),
    "mirror_customer": "select * from customer",
    "scd2_retire": SCD_CTE + _sel("kept", where="where not cur"),
    "scd1_update": SCD_CTE + _sel("kept", where="where up is not null"),
    "scd_consume_source": SCD_CTE
    + "select cid, name, seg, bal from s2 where not exists (select 1 from kept where kept.cid = s2.cid and kept.cur)",
    "scd_insert_versions": HIST_CTE + _sel("ins", fx.SCD_OUT[:-1]),
    "scd_checks": SCD_CTE
    + """, staged as (select * from kept union all select * from insk)
select 'current_start_before_default_end' as test, count(*) = 0 as passed, count(*) as violations
  from staged where cur and st >= timestamp '2400-01-01'
union all select 'current_end_is_default_end', count(*) = 0, count(*) from staged where cur and en <> timestamp '2400-01-01'
union all select 'unique_cid_st', count(*) = 0, count(*) from (select cid, st from staged group by cid, st having count(*) > 1)""",
    "scd_publish": SCD_CTE + _sel("fin"),
    "scd_on_storage": SCD_CTE + _sel("fin"),
    "keys_generate": ALL_CTE
    + f"select sk, cast(cid as varchar) || strftime(st, {_TS}) as originating_source_business_key, 'cid||st' as originating_business_key_name, 'core' as originating_source_system_code, false as active_flag from d1",
    "keys_incremental": SCD_CTE
    + f"select sk, cast(cid as varchar) || strftime(st, {_TS}) as originating_source_business_key, 'cid||st' as originating_business_key_name, 'core' as originating_source_system_code, false as active_flag from insk",
}

_LK = "cast(l_orderkey as varchar) || '|' || cast(l_linenumber as varchar)"
LINE_SQL = f"""
with core as (select l_orderkey, l_linenumber, sum(l_quantity) as l_quantity, round(sum(l_extendedprice), 2) as l_extendedprice,
    max(l_returnflag) as l_returnflag, max(l_linestatus) as l_linestatus from lineitem group by l_orderkey, l_linenumber),
s1 as (select * from core where l_orderkey % 5 <> 0),
s2 as (select l_orderkey, l_linenumber, case when l_linenumber = 2 then l_quantity + 1 else l_quantity end as l_quantity, l_extendedprice,
    case when l_linenumber = 1 and l_orderkey % 2 = 0 then 'X' else l_returnflag end as l_returnflag, l_linestatus
  from core where l_orderkey % 7 <> 0 or l_orderkey % 5 = 0),
d1 as (select *, {AS1} as etl_updated_timestamp, timestamp '1970-01-01' as st, timestamp '2400-01-01' as en, cast(null as timestamp) as up, true as cur,
    row_number() over (order by md5({_LK} || strftime(timestamp '1970-01-01', {_TS})), {_LK} || strftime(timestamp '1970-01-01', {_TS})) as sk from s1),
j as (select d1.*, s2.l_orderkey is not null as m,
    (s2.l_returnflag is distinct from d1.l_returnflag or s2.l_linestatus is distinct from d1.l_linestatus) as x2,
    (s2.l_quantity is distinct from d1.l_quantity or s2.l_extendedprice is distinct from d1.l_extendedprice) as x1,
    s2.l_quantity as sq, s2.l_extendedprice as sp
  from d1 left join s2 on d1.l_orderkey = s2.l_orderkey and d1.l_linenumber = s2.l_linenumber),
kept as (select l_orderkey, l_linenumber, case when m and not x2 and x1 then sq else l_quantity end as l_quantity,
    case when m and not x2 and x1 then sp else l_extendedprice end as l_extendedprice, l_returnflag, l_linestatus, etl_updated_timestamp, st,
    case when m and x2 then {AS2} else en end as en, case when m and not x2 and x1 then {AS2} end as up, not (m and x2) as cur, sk from j),
mx as (select l_orderkey, l_linenumber, max(en) as m, bool_or(cur) as has from kept group by l_orderkey, l_linenumber),
ins as (select s2.*, {AS2} as etl_updated_timestamp, coalesce(mx.m + interval 1 microsecond, timestamp '1970-01-01') as st,
    timestamp '2400-01-01' as en, cast(null as timestamp) as up, true as cur
  from s2 left join mx on s2.l_orderkey = mx.l_orderkey and s2.l_linenumber = mx.l_linenumber where not coalesce(mx.has, false)),
insk as (select *, (select max(sk) from d1) + row_number() over (order by md5({_LK} || strftime(st, {_TS})), {_LK} || strftime(st, {_TS})) as sk from ins),
fin as (select * from kept union all select * from insk)
select l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_linestatus,
  strftime(etl_updated_timestamp, {_TS}) as etl_updated_timestamp, strftime(st, {_TS}) as row_effective_timestamp,
  strftime(en, {_TS}) as row_expiry_timestamp, strftime(up, {_TS}) as row_update_timestamp, cur as row_current_flag, sk as line_sk from fin
"""
ORACLES["scd_load_lines"] = LINE_SQL

_EK = f"event_type || '|' || cast(user_id as varchar) || strftime(st, {_TS})"
_EVENTS = f"""
with core as (select event_type, user_id, count(*) as n, max(event_id) as last_id, min(event_id) as first_id from events group by event_type, user_id),
s2 as (select event_type, user_id, case when user_id % 3 = 0 then n + 1 else n end as n,
    case when user_id % 7 = 0 then last_id + 1 else last_id end as last_id, first_id from core),
d1 as (select event_type, user_id, n, last_id, true as cur, timestamp '1970-01-01' as st, timestamp '2400-01-01' as en, cast(null as timestamp) as up
  from core where user_id % 5 <> 0),
k1 as (select *, row_number() over (order by md5({_EK}), {_EK}) as sk from d1),
kept as (select event_type, user_id, k1.n, case when s2.n = k1.n then s2.last_id else k1.last_id end as last_id, s2.n = k1.n as cur, st,
    case when s2.n = k1.n then en else {AS2} end as en, case when s2.n = k1.n and s2.last_id <> k1.last_id then {AS2} end as up, sk
  from k1 join s2 using (event_type, user_id)),
ins as (select s2.event_type, s2.user_id, s2.n, s2.last_id, true as cur, coalesce(kept.en + interval 1 microsecond, timestamp '1970-01-01') as st,
    timestamp '2400-01-01' as en, cast(null as timestamp) as up
  from s2 left join kept on s2.event_type = kept.event_type and s2.user_id = kept.user_id where kept.cur is distinct from true),
insk as (select *, (select max(sk) from k1) + row_number() over (order by md5({_EK}), {_EK}) as sk from ins),
d2 as (select * from kept union all select * from insk),
fin as (select d2.event_type, d2.user_id, d2.n, d2.last_id, case when cur then s2.first_id end as first_id, cur, st, en,
    case when cur and s2.first_id is not null then {AS3} else up end as up, sk
  from d2 join s2 on d2.event_type = s2.event_type and d2.user_id = s2.user_id)
"""
ORACLES["scd_events_on_storage"] = _EVENTS + _sel("fin", EVENT_OUT)
ORACLES["scd_events_keys_map"] = _EVENTS + f"select sk, {_EK} as k, {_EK} as mapped from fin"

ORACLES["dim_create_empty"] = """
with d as (select * from (describe select c_custkey as cid, c_name as name, c_mktsegment as seg, c_acctbal as bal,
    cast(null as timestamp) as etl_updated_timestamp, cast(null as boolean) as etl_deleted_flag,
    cast(null as timestamp) as st, cast(null as timestamp) as en, cast(null as timestamp) as up, cast(null as boolean) as cur,
    cast(null as timestamp) as etl_inserted_timestamp, cast(null as bigint) as sk from customer))
select cast(row_number() over () as integer) as position, column_name,
  case column_type when 'BIGINT' then 'bigint' when 'VARCHAR' then 'string' when 'DOUBLE' then 'double'
    when 'TIMESTAMP' then 'timestamp_ntz' when 'BOOLEAN' then 'boolean' when 'INTEGER' then 'int' else lower(column_type) end as data_type,
  "null" = 'YES' as nullable
from d
"""
