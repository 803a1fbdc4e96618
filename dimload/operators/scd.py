"""Slowly changing dimensions, type 1 and type 2 in one pass.

Plan shape (one batch):

* ``cur`` (current rows, at most one per key) FULL OUTER JOIN ``source`` (one row per key) on the
  business key -- the only join of wide rows; neither side can be skewed on a key.
* The join gives both the updated current rows (D2 retire, D3 type-1 overwrite) and the source
  rows that still need a new version (D4); no second join over the source is needed.
* The latest expiry per key (A1) is an aggregate over the *history* rows only, combined map-side
  before its shuffle, so a key with a very long history costs one row per input partition.
* New versions (D5) are the only rows that need surrogate keys (D7): existing rows keep theirs,
  so the dimension is never joined to the keys table; only the new versions are looked up.
* Source rows with a NULL business key never match anything; they are split off before the join
  (no NULL-key hot partition) and, like the original, never reach the published dimension.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimload import constants as C
from dimload.functions.columns import any_differs, default_end, derived_key, next_start, ts_ntz
from dimload.operators.keys import KEY_PREFIX, assign_numbers, key_prefix, keys_to_map, max_key
from dimload.operators.predicates import not_default_rows

_S = "_src_"  # prefix of source columns inside the joined frame


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _split(cols: str | Sequence[str] | None) -> tuple[str, ...]:
    if cols is None:
        return ()
    if isinstance(cols, str):
        cols = cols.split(",")
    return tuple(c.strip() for c in cols if c and c.strip())


@dataclass(frozen=True)
class ScdSpec:
    """What to load and how the dimension's columns are called.

    ``scd1_columns=None`` derives them (P10): every source column except the business key, the
    surrogate key, the type-2 columns and ``etl_updated_timestamp``.
    """

    business_keys: tuple[str, ...]
    scd2_columns: tuple[str, ...]
    surrogate_key: str
    scd1_columns: tuple[str, ...] | None = None
    current_col: str = C.ROW_CURRENT
    start_col: str = C.ROW_EFFECTIVE
    end_col: str = C.ROW_EXPIRY
    update_col: str | None = C.ROW_UPDATE
    key_name: str | None = None
    source_system: str = "core"

    @classmethod
    def for_entity(cls, entity: str, scd2_columns: str | Sequence[str], **kw) -> "ScdSpec":
        """Defaults named after the entity: key ``<entity>_cid``, surrogate key ``dim_<entity>_sk``."""
        bk = _split(kw.pop("business_keys", f"{entity}_cid"))
        return cls(
            business_keys=bk,
            scd2_columns=_split(scd2_columns),
            surrogate_key=kw.pop("surrogate_key", f"dim_{entity}_sk"),
            **kw,
        )

    def __post_init__(self):
        object.__setattr__(self, "business_keys", _split(self.business_keys))
        object.__setattr__(self, "scd2_columns", _split(self.scd2_columns))
        if self.scd1_columns is not None:
            object.__setattr__(self, "scd1_columns", _split(self.scd1_columns))
        if not self.business_keys:
            raise ValueError("ScdSpec needs at least one business key column")

    @property
    def originating_key_name(self) -> str:
        """Name recorded with each key: ``<bk>||<start column>`` unless given."""
        if self.key_name:
            return self.key_name
        return ",".join(self.business_keys) + "||" + self.start_col

    def metadata_columns(self) -> tuple[str, ...]:
        cols = [self.current_col, self.start_col, self.end_col, self.surrogate_key]
        if self.update_col:
            cols.append(self.update_col)
        return tuple(cols)


# ------------------------------------------------------------------------------------------------
# P10 and schema preparation
# ------------------------------------------------------------------------------------------------


def scd1_columns(source_columns: Sequence[str], spec: ScdSpec) -> list[str]:
    """P10: source columns minus etl_updated, type-2 columns, surrogate key and business key.

    Compared case-insensitively after trimming; ``etl_deleted_flag`` therefore *is* type 1.
    """
    if spec.scd1_columns is not None:
        return list(spec.scd1_columns)
    drop = {c.lower() for c in (C.ETL_UPDATED, spec.surrogate_key, *spec.scd2_columns, *spec.business_keys)}
    return [c for c in source_columns if c.strip().lower() not in drop]


def _has(df_cols: Sequence[str], name: str) -> str | None:
    low = name.lower()
    for c in df_cols:
        if c.lower() == low:
            return c
    return None


def prepare_dimension(source: DataFrame, spec: ScdSpec, dim: DataFrame | None = None) -> DataFrame:
    """An empty dimension shaped like the source, or the dimension with missing columns added.

    Empty dimension = source columns without ``etl_*`` / ``originating_*`` + etl metadata + validity
    metadata + the surrogate key (E1 with dimension metadata). An existing dimension gains the
    source's non-metadata columns it lacks (E3) so every source column has a home.
    """
    from dimload.operators.schema import align_columns, empty_like

    if dim is None:
        return empty_like(source, add_dim_metadata=True, spec=spec)
    return align_columns(dim, source)


# ------------------------------------------------------------------------------------------------
# The batch: D1-D5
# ------------------------------------------------------------------------------------------------


@dataclass
class ScdSteps:
    """Lazy frames of one SCD batch; each is one of the reference's steps."""

    spec: ScdSpec
    as_of: object
    dim: DataFrame  # dimension aligned to the source (D0)
    history: DataFrame  # working-copy rows that are not current (untouched)
    kept: DataFrame  # current rows after D2 (retire) and D3 (type-1 overwrite)
    remaining: DataFrame  # source rows not consumed by D4
    inserted: DataFrame  # D5: new versions, surrogate key NULL
    joined: DataFrame  # current rows and source rows side by side; _c2: retired, _c1: overwritten

    @property
    def retired(self) -> DataFrame:
        """D2 result: rows closed by this batch."""
        return self.kept.filter(~_q(self.spec.current_col))

    @property
    def scd1_updated(self) -> DataFrame:
        """D3 result: still-current rows whose type-1 columns this batch overwrote."""
        if not self.spec.update_col:
            raise ValueError("spec has no update column")
        return self.kept.filter((_q(self.spec.update_col) == ts_ntz(self.as_of)) & _q(self.spec.current_col))

    @property
    def staged(self) -> DataFrame:
        """Working dimension before keys: history ∪ kept ∪ inserted."""
        return self.history.unionByName(self.kept).unionByName(self.inserted)

    @property
    def touched(self) -> DataFrame:
        """The rows of ``staged`` that this batch wrote, and all other versions of the keys that got a
        new one: what the batch can have broken. The history is reduced to those keys first."""
        bks = list(self.spec.business_keys)
        keys = self.inserted.select(*bks).dropna().distinct()
        written = self.joined.filter(F.col("_c2") | F.col("_c1")).select(*[_q(k) for k in bks]).unionByName(keys).distinct()
        kept = self.kept.join(written, bks, "left_semi")
        history = self.history.join(keys, bks, "left_semi")
        return history.select(*self.dim.columns).unionByName(kept.select(*self.dim.columns)).unionByName(self.inserted)


def scd_steps(dim: DataFrame, source: DataFrame, spec: ScdSpec, as_of, materialize: bool = False) -> ScdSteps:
    """D1-D5 for one batch as lazy DataFrames. With ``materialize`` the joined rows are staged,
    so that the join of dimension and source runs once for all of them."""
    bks = list(spec.business_keys)
    dim = prepare_dimension(source, spec, dim)
    dcols = dim.columns
    scols = [c for c in source.columns]
    t1 = [c for c in scd1_columns(scols, spec) if _has(dcols, c)]
    unknown = [c for c in spec.scd2_columns if not (_has(scols, c) and _has(dcols, c))]
    if unknown:
        raise ValueError(f"type-2 columns {unknown} are not in the source and the dimension")
    t2 = list(spec.scd2_columns)
    asof = ts_ntz(as_of)

    # Working copy without default rows (all business keys < 0; NULL keys drop out too).
    work = not_default_rows(dim, bks)
    history = work.filter(~F.coalesce(_q(spec.current_col), F.lit(False)))
    cur = work.filter(_q(spec.current_col))

    key_null = reduce(lambda a, b: a | b, [_q(k).isNull() for k in bks])
    src_keyed = source.filter(~key_null)
    src_nullkey = source.filter(key_null)

    src_ren = src_keyed.select(*[_q(c).alias(_S + c) for c in scols], F.lit(True).alias("_src_hit"))
    cur_tag = cur.select("*", F.lit(True).alias("_cur_hit"))
    on = reduce(lambda a, b: a & b, [cur_tag[k] == src_ren[_S + k] for k in bks])
    j = cur_tag.join(src_ren, on, "full_outer")

    matched = F.coalesce(F.col("_cur_hit"), F.lit(False)) & F.coalesce(F.col("_src_hit"), F.lit(False))
    c2 = matched & any_differs([(_q(c), F.col(f"`{_S}{c}`")) for c in t2])
    c1 = matched & ~c2 & any_differs([(_q(c), F.col(f"`{_S}{c}`")) for c in t1])
    j = j.select("*", c2.alias("_c2"), c1.alias("_c1"))
    if materialize:
        from dimload.session import staged

        j = staged(j, "scd-joined")

    # D2 + D3 on the current rows.
    t1_low = {c.lower() for c in t1}
    kept_cols = []
    for c in dcols:
        cl = c.lower()
        if cl in t1_low:
            kept_cols.append(F.when(F.col("_c1"), F.col(f"`{_S}{_has(scols, c)}`")).otherwise(_q(c)).alias(c))
        elif c == spec.current_col:
            kept_cols.append((~F.col("_c2")).alias(c))
        elif c == spec.end_col:
            kept_cols.append(F.when(F.col("_c2"), asof).otherwise(_q(c)).alias(c))
        elif spec.update_col and c == spec.update_col:
            kept_cols.append(F.when(F.col("_c1"), asof).otherwise(_q(c)).alias(c))
        else:
            kept_cols.append(_q(c))
    kept = j.filter(F.col("_cur_hit")).select(*kept_cols)

    # Source rows with no still-current row: unmatched, or matched and just retired.
    rem = j.filter(F.col("_src_hit") & (~F.coalesce(F.col("_cur_hit"), F.lit(False)) | F.col("_c2")))
    retired_at = F.when(F.col("_c2"), asof).alias("_retired_at")
    remaining_keyed = rem.select(*[F.col(f"`{_S}{c}`").alias(c) for c in scols], retired_at)
    remaining = remaining_keyed.drop("_retired_at").unionByName(src_nullkey)

    # A1 + J1: latest expiry over history, of the keys that need a version only (the history is reduced
    # to them before it is aggregated), then the retired row's new expiry.
    wanted = remaining_keyed.select(*[_q(k) for k in bks])
    hist_max = history.join(wanted, bks, "left_semi").groupBy(*bks).agg(F.max(_q(spec.end_col)).alias("_hist_max"))
    cand = remaining_keyed.join(hist_max, bks, "left")
    latest = F.greatest(F.col("_hist_max"), F.col("_retired_at"))
    ins_keyed = cand.select(*[_q(c) for c in scols], next_start(latest).alias("_start"))
    ins_null = src_nullkey.select(*[_q(c) for c in scols], next_start(F.lit(None).cast("timestamp_ntz")).alias("_start"))
    inserted = ins_keyed.unionByName(ins_null).select(*_insert_columns(dcols, scols, spec, asof))
    return ScdSteps(spec, as_of, dim, history, kept, remaining, inserted, j)


def _insert_columns(dcols: Sequence[str], scols: Sequence[str], spec: ScdSpec, asof: Column) -> list[Column]:
    """D5 projection in dimension column order."""
    out = []
    for c in dcols:
        sc = _has(scols, c)
        if c == spec.surrogate_key:
            out.append(F.lit(None).cast("bigint").alias(c))
        elif c == spec.current_col:
            out.append(F.lit(True).alias(c))
        elif c == spec.start_col:
            out.append(F.col("_start").alias(c))
        elif c == spec.end_col:
            out.append(default_end().alias(c))
        elif spec.update_col and c == spec.update_col:
            out.append(F.lit(None).cast("timestamp_ntz").alias(c))
        elif c.lower() == C.ETL_UPDATED and sc is not None:
            out.append(asof.alias(c))
        elif sc is not None:
            out.append(_q(sc).alias(c))
        else:
            out.append(F.lit(None).alias(c))
    return out


# ------------------------------------------------------------------------------------------------
# D6-D8
# ------------------------------------------------------------------------------------------------


def scd_checks(staged: DataFrame, spec: ScdSpec) -> DataFrame:
    """``(test, passed, violations)`` for the three dimension invariants of staged rows: of a whole
    dimension (:attr:`ScdSteps.staged`), or of what a batch can have broken (:attr:`ScdSteps.touched`),
    the rest having been checked by the batches that wrote it. Rows with a NULL business key are never
    published, so they are not compared with each other.
    """
    from dimload.operators.quality import combine_checks, expect_no_rows, unique_columns

    cur = _q(spec.current_col)
    bad_start = staged.filter(cur & (_q(spec.start_col) >= default_end()))
    bad_end = staged.filter(cur & (_q(spec.end_col) != default_end()))
    keyed = staged.dropna(subset=list(spec.business_keys))
    return combine_checks(
        [
            expect_no_rows("current_start_before_default_end", bad_start),
            expect_no_rows("current_end_is_default_end", bad_end),
            unique_columns(f"unique_{'_'.join(spec.business_keys)}_{spec.start_col}", keyed, [*spec.business_keys, spec.start_col]),
        ]
    )


@dataclass
class ScdResult:
    dimension: DataFrame  # the new dimension (publish it)
    new_keys: DataFrame  # rows to append to the keys table (K2)
    new_map: DataFrame  # rows to append to the key map table (K3)
    steps: ScdSteps
    versions: DataFrame | None = None  # the new versions with their keys, part of ``dimension``


def assign_version_keys(
    inserted: DataFrame,
    keys: DataFrame | None,
    spec: ScdSpec,
    as_of,
    floor: DataFrame | None = None,
    highest: int | None = None,
) -> DataFrame:
    """D7 for the new versions: the existing key of ``bk || start`` or the next dense number.

    Rows whose derived key is NULL (NULL business key) are dropped: they never get a key. Numbers
    start after the largest one of the keys table and of ``floor`` (a frame with the surrogate key,
    e.g. the dimension), so a number in use is never handed out again; ``highest`` gives that number
    where it is known, and nothing is scanned for it. The lookup is a left join planned by Catalyst
    and AQE.
    """
    sk = spec.surrogate_key
    vkey = derived_key(spec.business_keys, spec.start_col)
    ins = inserted.select(*[_q(c) for c in inserted.columns if c != sk], vkey.alias("_vkey")).filter(F.col("_vkey").isNotNull())
    if keys is None:
        looked = ins.select("*", F.lit(None).cast("bigint").alias("_old_sk"))
        base = None
    else:
        lookup = keys.filter(
            (F.col(C.KEYS_KEY_NAME) == F.lit(spec.originating_key_name))
            & (F.col(C.KEYS_SYSTEM) == F.lit(spec.source_system))
        )
        prefix = [KEY_PREFIX] if KEY_PREFIX in keys.columns else []
        lookup = lookup.select(F.col(C.KEYS_BUSINESS_KEY).alias("_vkey"), F.col(sk).cast("bigint").alias("_old_sk"), *prefix)
        tagged = ins.withColumn(KEY_PREFIX, key_prefix(F.col("_vkey"))) if prefix else ins
        looked = tagged.join(lookup, ["_vkey", *prefix], "left").drop(*prefix)
        base = max_key(keys, sk) if highest is None else None
    if highest is not None:
        base = ins.sparkSession.range(1).select(F.lit(highest).cast("bigint").alias("max_sk"))
    elif floor is not None:
        highest = floor.select(_q(sk)) if keys is None else floor.select(_q(sk)).unionByName(keys.select(_q(sk)))
        base = max_key(highest, sk)
    numbered = assign_numbers(looked, "_vkey", base, "_new_sk", exclude=F.col("_old_sk").isNotNull())
    return numbered.select("*", F.coalesce(F.col("_old_sk"), F.col("_new_sk")).alias(sk))


def scd_load(
    dim: DataFrame | None,
    source: DataFrame,
    spec: ScdSpec,
    as_of,
    keys: DataFrame | None = None,
    materialize: bool = True,
    check_source_unique: bool = True,
    highest: int | None = None,
    source_staged: bool = False,
) -> ScdResult:
    """One SCD batch from ``(dimension, source, keys)`` to the new dimension and new keys.

    ``dim=None`` is a first load (D0 builds an empty dimension). With ``materialize`` (default) the
    source is computed once and staged in the shared folder, for the check of its keys, the join
    and the rows without a key; the joined rows of dimension and source are staged once and feed
    the retired, kept and new rows, so the wide join runs once for all readers; the new versions are
    staged as well, since dense numbering reads them twice (bucket sizes, then numbers), and so are their
    numbers, which the dimension and the new keys read. Staged as columns, each reader reads its own.
    ``materialize=False`` keeps everything lazy (one plan, for inspection). Duplicate source keys
    raise unless ``check_source_unique`` is off. ``highest`` is the largest surrogate key handed out,
    where it is known. A source that is stored already (``source_staged``) is read as it is.
    """
    if materialize:
        from dimload.session import staged

        source = source if source_staged else staged(source, "scd-source")
    if check_source_unique:
        from dimload.operators.quality import assert_unique

        assert_unique(source, list(spec.business_keys), what="SCD source")
    if dim is None:
        dim = prepare_dimension(source, spec, None)
    steps = scd_steps(dim, source, spec, as_of, materialize)
    sk = spec.surrogate_key
    inserted = steps.inserted
    if materialize:
        inserted = staged(inserted, "scd-inserted")
        steps.inserted = inserted  # later readers (staged view, checks) reuse it
    keyed = assign_version_keys(inserted, keys, spec, as_of, floor=steps.dim, highest=highest)
    if materialize:
        keyed = staged(keyed.drop("_new_sk"), "scd-keyed")

    dcols = steps.dim.columns
    skc = _q(sk)
    retained = steps.dim.filter((skc < 0) | skc.isNull())
    existing = steps.history.unionByName(steps.kept).filter(skc >= 0)
    new_versions = keyed.select(*[_q(c) for c in dcols])
    dimension = retained.unionByName(existing).unionByName(new_versions)

    new_keys = (
        keyed.filter(F.col("_old_sk").isNull())
        .select(
            F.col(sk).cast("bigint").alias(sk),
            F.col("_vkey").alias(C.KEYS_BUSINESS_KEY),
            F.lit(spec.originating_key_name).alias(C.KEYS_KEY_NAME),
            F.lit(spec.source_system).alias(C.KEYS_SYSTEM),
            F.lit(False).alias(C.KEYS_ACTIVE),
            ts_ntz(as_of).alias(C.ETL_UPDATED),
            F.lit(False).alias(C.ETL_DELETED),
        )
        .dropDuplicates([C.KEYS_BUSINESS_KEY])
    )
    return ScdResult(dimension, new_keys, keys_to_map(new_keys, sk), steps, new_versions)


def publish_with_keys(dim: DataFrame, staged: DataFrame, keys: DataFrame, spec: ScdSpec) -> DataFrame:
    """D7 as the original states it (J2 + P7): rows with a negative / NULL surrogate key are kept
    as they are; every staged row takes its surrogate key from the keys table by ``bk || start``
    (inner join, so rows without a key -- NULL business key -- drop out).

    :func:`scd_load` gives the same result without joining the whole dimension to the keys table
    (existing rows already carry their key); this form is for auditing a staged batch.
    """
    sk = spec.surrogate_key
    skc = _q(sk)
    retained = dim.filter((skc < 0) | skc.isNull())
    lookup = keys.select(F.col(C.KEYS_BUSINESS_KEY).alias("_vkey"), F.col(sk).cast("bigint").alias("_key_sk"))
    joined = staged.withColumn("_vkey", derived_key(spec.business_keys, spec.start_col)).join(lookup, "_vkey", "inner")
    cols = [F.col("_key_sk").alias(c) if c == sk else _q(c) for c in dim.columns]
    return retained.unionByName(joined.select(*cols))


def cluster_by_key(dim: DataFrame, spec: ScdSpec, partitions: int | None = None) -> DataFrame:
    """The dimension hash-partitioned by business key (``spark.sql.shuffle.partitions`` parts).

    Stored this way (or bucketed on the key, see :func:`write_dimension_table`), the next batch's
    join with the source and the latest-expiry aggregate need no shuffle of the dimension: only
    the source is shuffled to match.
    """
    n = partitions or int(dim.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dim.repartition(n, *[_q(k) for k in spec.business_keys])


def write_dimension_table(dim: DataFrame, spec: ScdSpec, table: str, buckets: int, mode: str = "overwrite") -> None:
    """Publish a dimension as a catalog table bucketed and sorted by business key, so later batches
    read it already partitioned for the business-key join (no dimension-side shuffle)."""
    bks = list(spec.business_keys)
    dim.write.mode(mode).bucketBy(buckets, *bks).sortBy(*bks).saveAsTable(table)
