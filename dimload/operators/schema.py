"""Schema operators (E1-E5): empty table like a source, add / align columns, column specs, names.

All of them only edit the plan's schema (``StructType``) and projections; none reads data.
"""

from __future__ import annotations

import re
from typing import Any, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimload import constants as C


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _stripped_on_create(name: str) -> bool:
    low = name.lower()
    return low in (C.ETL_DELETED, C.ETL_UPDATED) or low.startswith("originating_business_key") or low == C.ORIGINATING_SYSTEM


def empty_like_schema(source_schema: T.StructType, add_etl_metadata: bool = True, add_dim_metadata: bool = False, spec=None) -> T.StructType:
    """E1 (+ D0): source fields without etl/originating columns, then the metadata fields."""
    fields = [f for f in source_schema.fields if not _stripped_on_create(f.name)]
    if add_etl_metadata:
        fields += [T.StructField(C.ETL_UPDATED, T.TimestampNTZType()), T.StructField(C.ETL_DELETED, T.BooleanType())]
    if add_dim_metadata:
        start = spec.start_col if spec else C.ROW_EFFECTIVE
        end = spec.end_col if spec else C.ROW_EXPIRY
        upd = (spec.update_col if spec else C.ROW_UPDATE) or C.ROW_UPDATE
        cur = spec.current_col if spec else C.ROW_CURRENT
        fields += [
            T.StructField(start, T.TimestampNTZType()),
            T.StructField(end, T.TimestampNTZType()),
            T.StructField(upd, T.TimestampNTZType()),
            T.StructField(cur, T.BooleanType()),
            T.StructField(C.ETL_INSERTED, T.TimestampNTZType()),
        ]
        if spec is not None:
            fields.append(T.StructField(spec.surrogate_key, T.LongType()))
    return T.StructType(fields)


def empty_like(source: DataFrame, add_etl_metadata: bool = True, add_dim_metadata: bool = False, spec=None) -> DataFrame:
    """An empty DataFrame with the target schema derived from ``source``."""
    schema = empty_like_schema(source.schema, add_etl_metadata, add_dim_metadata, spec)
    return source.sparkSession.createDataFrame([], schema)


def describe_schema(df: DataFrame) -> DataFrame:
    """One row per field ``(position, column_name, data_type, nullable)``: the schema as data."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")


def _default_for(dtype: str, default: Any) -> Column:
    if default is None and dtype.strip().lower() in ("boolean", "bool"):
        default = False
    return F.lit(default).cast(dtype)


def add_column(df: DataFrame, column: str, dtype: str = "string", default: Any = None) -> DataFrame:
    """Add ``column`` typed ``dtype``; existing rows get ``default`` (boolean: false, else NULL)."""
    if column.lower() in (c.lower() for c in df.columns):
        return df
    return df.withColumn(column, _default_for(dtype, default))


def align_columns(target: DataFrame, source: DataFrame, exclude: Iterable[str] = (C.ETL_UPDATED, C.ETL_DELETED)) -> DataFrame:
    """Add every source column the target lacks (by name, case-insensitive), typed like the source.

    Type drift of existing columns is ignored, as in the original.
    """
    have = {c.lower() for c in target.columns}
    skip = {e.lower() for e in exclude}
    cols = {}
    for f in source.schema.fields:
        if f.name.lower() in have or f.name.lower() in skip:
            continue
        dtype = f.dataType.simpleString()
        cols[f.name] = _default_for(dtype, None)
    return target.withColumns(cols) if cols else target


def clean_name(name: str) -> str:
    """E5: trim, replace characters outside ``[A-Za-z0-9_"]`` by ``_``; reserved names are quoted.

    Spark quotes with backticks, so a reserved name comes back unchanged (Spark accepts it as a
    column name); :func:`clean_names` therefore only rewrites characters.
    """
    return re.sub(C.NAME_PATTERN, "_", name.strip())


def quoted_name(name: str) -> str:
    """E5 quoting for SQL text: reserved names in backticks."""
    n = clean_name(name)
    return f"`{n}`" if n.lower() in C.RESERVED_COLUMN_NAMES else n


def clean_names(df: DataFrame) -> DataFrame:
    """E5 on a whole frame: rename every column to its cleaned form (a projection, no data read)."""
    return df.toDF(*[clean_name(c) for c in df.columns])


# ------------------------------------------------------------------------------------------------
# Column specs
# ------------------------------------------------------------------------------------------------


#: How the entry of each kind of spec is read; any other kind names the entry's own key.
_ENTRY = {
    None: lambda column: column,
    "target": lambda column: column["target_column"],
    "name_only": lambda column: {"name": column},
    "use_spec_file": lambda column: column["source_column"],
    "use_spec_file_but_ignoreheader": lambda column: column["source_column"],
}
#: Kinds whose declared types describe the file, not the table: the table takes the default type.
_FILE_KINDS = ("use_spec_file", "use_spec_file_but_ignoreheader")


def spec_type(entry: Mapping, kind: str | None = None, default_type: str = C.DEFAULT_SPEC_TYPE) -> str:
    """The type of a column spec's entry: declared (by alias), told by its name, or the default."""
    declared = None if kind in _FILE_KINDS else entry.get("datatype")
    if declared:
        return C.TYPE_ALIASES.get(declared, declared)
    flag = kind == "name_only" and any(part in entry["name"] for part in C.BOOLEAN_NAME_FRAGMENTS)
    return "boolean" if flag else default_type


def spec_field(column: Mapping | str, kind: str | None = None, default_type: str = C.DEFAULT_SPEC_TYPE) -> T.StructField:
    """One column spec -> ``StructField``.

    ``kind``: ``'target'`` / ``'use_spec_file'`` / ``'use_spec_file_but_ignoreheader'`` / ``'name_only'``
    or a custom key; the entry is ``{'name', 'datatype'?, 'mandatory'?}``.
    """
    entry = _ENTRY[kind](column) if kind in _ENTRY else column[kind]
    data_type = T._parse_datatype_string(_spark_type_name(spec_type(entry, kind, default_type)))
    return T.StructField(entry["name"], data_type, not entry.get("mandatory"))


def _spark_type_name(dtype: str) -> str:
    d = dtype.strip().lower()
    if d.startswith("varchar") or d.startswith("character varying") or d == "text":
        return "string"
    if d.startswith("number(") or d.startswith("numeric("):
        return "decimal" + d[d.index("("):].replace(" ", "")
    if d in ("timestamp", "timestamp_ntz", "datetime"):
        return "timestamp_ntz"
    if d in ("float", "float8", "double precision"):
        return "double"
    if d in ("bool",):
        return "boolean"
    return d


def schema_from_specs(
    columns: Sequence, kind: str | None = None, add_etl_metadata: bool = True, default_type: str = C.DEFAULT_SPEC_TYPE
) -> T.StructType:
    """The table schema a list of column specs describes (+ etl metadata)."""
    fields = [spec_field(c, kind, default_type) for c in columns]
    if add_etl_metadata:
        fields += [
            T.StructField(C.ETL_UPDATED, T.TimestampNTZType()),
            T.StructField(C.ETL_DELETED, T.BooleanType()),
        ]
    return T.StructType(fields)


def conform(df: DataFrame, schema: T.StructType, as_of=None, fail_on_mandatory: bool = False) -> DataFrame:
    """E4 applied: project ``df`` onto ``schema`` (cast by name, missing -> default).

    Missing booleans default to false, ``etl_updated_timestamp`` to ``as_of`` (when given),
    ``etl_deleted_flag`` to false; other missing columns are NULL. With ``fail_on_mandatory`` a
    NULL in a mandatory column raises at run time (``raise_error`` inside the projection).
    """
    from dimload.functions.columns import ts_ntz

    have = {c.lower(): c for c in df.columns}
    out = []
    for f in schema.fields:
        src = have.get(f.name.lower())
        if src is not None:
            col = _q(src).cast(f.dataType)
        elif f.name == C.ETL_UPDATED and as_of is not None:
            col = ts_ntz(as_of)
        elif isinstance(f.dataType, T.BooleanType):
            col = F.lit(False)
        else:
            col = F.lit(None).cast(f.dataType)
        if fail_on_mandatory and not f.nullable:
            col = F.when(col.isNull(), F.raise_error(F.lit(f"mandatory column {f.name} is NULL"))).otherwise(col)
        out.append(col.cast(f.dataType).alias(f.name))
    return df.select(*out)
