"""Parquet tables that a load changes as a whole or not at all.

A load writes its files into a folder of its own, and then one small marker, the commit::

    <table>/...                             files from before the first load, in place ("load 0")
    <table>/_loads/_load_no=<n>/...         files written by load n, below its partition folders
    <table>/_commits/<n>.json               the commit of load n: created last, never changed

A commit names the loads that the table is made of, the files among them that load n replaced, and the
table's columns. Readers (:func:`read_table`) go by the newest commit, so a load that fails at any
step leaves the rows as they were; what it wrote is seen by nobody and removed by the next load. After
the commit, replaced files and loads that are no longer part of the table are removed; if that is cut
short, readers pass them over and the next load removes them. Two loads of one table must not run at
the same time; one that finds a commit it doesn't know is refused.

The commit also keeps the column ledger: a column's type, its default and the load it came with. Files
of earlier loads don't hold the column; their rows read the default. Adding a column writes no row.

Only names of files that a load replaces, loads and columns pass the driver. A load that would replace
more than ``MAX_REPLACED`` files rewrites the table instead, with the same rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, replace
from typing import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimload.session import remove_path

LOAD_COL, FILE_COL = "_load_no", "_stored_file"
MAX_REPLACED = 20_000


@dataclass(frozen=True)
class Column:
    """A column of a stored table: rows of files older than load ``since`` read ``default``."""

    name: str
    type: str
    default: str | None = None
    since: int = 0


@dataclass(frozen=True)
class Version:
    """One state of a table: what the newest commit says, or its plain files if there is none."""

    number: int
    columns: tuple[Column, ...]
    partitions: tuple[str, ...] = ()
    loads: tuple[int, ...] = ()
    plain: bool = False  # whether files from before the first load are part of the table
    replaced: tuple[str, ...] = ()  # files of those loads that the newest load replaced
    notes: dict | None = None  # what a load wants to know of the table later, such as its largest key

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, T._parse_datatype_string(c.type)) for c in self.columns])


class ConcurrentLoad(RuntimeError):
    """Another load of the same table has committed in the meantime; nothing was changed."""


# --- files -----------------------------------------------------------------------------------------


class _Folder:
    """A table's folder on Hadoop's file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        where = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self.fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
        uri = self.fs.makeQualified(where).toUri()
        self.url, self.raw = uri.toString(), uri.getRawPath()

    def at(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        where = self.at(name)
        return [s.getPath().getName() for s in self.fs.listStatus(where)] if self.fs.exists(where) else []

    def plain(self) -> list[str]:
        """What lies in the folder beside loads and commits."""
        return [n for n in self.names() if not n.startswith((".", "_")) or "=" in n]

    def loads(self) -> list[int]:
        return sorted(int(n.partition("=")[2]) for n in self.names("_loads") if n.startswith(f"{LOAD_COL}="))

    def commits(self) -> list[int]:
        return sorted(int(n[: -len(".json")]) for n in self.names("_commits") if n.endswith(".json") and not n.startswith("."))

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Write a file under another name and rename it, so that it is there whole or not at all."""
        parent, _, last = name.rpartition("/")
        draft = self.at(f"{parent}/.{last}-{uuid.uuid4().hex}")
        stream = self.fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.fs.exists(self.at(name)) or not self.fs.rename(draft, self.at(name)):
            self.fs.delete(draft, False)
            raise ConcurrentLoad(f"{self.path}: {name} is there already")

    def file(self, name: str):
        """The path of a file by its name as Spark gives it (URL-encoded), below the folder."""
        return self.spark._jvm.org.apache.spark.paths.SparkPath.fromUrlString(f"{self.url}/{name}").toPath()

    def name_of(self, url):
        """The column of names below the folder, of a column of Spark's file paths."""
        return url.substr(F.instr(url, self.raw + "/") + F.lit(len(self.raw) + 1), F.length(url))


# --- versions --------------------------------------------------------------------------------------


def current_version(spark: SparkSession, path: str, partition_cols: Sequence[str] = (), like: T.StructType | None = None) -> Version | None:
    """The newest version of the table, or ``None`` where nothing is stored.

    A plain Parquet folder is a table of load 0, with the columns of all its files. Its partition
    columns have the type that they have in ``like``: by inference, a text ``01`` becomes a number.
    """
    folder = _Folder(spark, path)
    commits = folder.commits()
    if commits:
        kept = json.loads(folder.read(f"_commits/{commits[-1]:09d}.json"))
        kept["columns"] = tuple(Column(**c) for c in kept["columns"])
        return Version(**{k: tuple(v) if isinstance(v, list) else v for k, v in kept.items()})
    if not folder.plain():
        return None
    stored = spark.read.option("mergeSchema", "true").parquet(folder.path).schema
    types = {f.name.lower(): f.dataType for f in like.fields} if like is not None else {}
    parts = {p.lower() for p in partition_cols}
    fields = [types.get(f.name.lower(), f.dataType) if f.name.lower() in parts else f.dataType for f in stored.fields]
    columns = tuple(Column(f.name, t.simpleString()) for f, t in zip(stored.fields, fields))
    return Version(0, columns, tuple(partition_cols), plain=True)


def _rows(spark: SparkSession, folder: _Folder, version: Version, only: Iterable[str] | None = None) -> DataFrame:
    """The version's rows with the load and the file that they are in; of files ``only`` if given."""
    fields = list(version.schema.fields)
    load = T.StructField(LOAD_COL, T.LongType())
    sources = []
    names = None if only is None else {n: folder.file(n).toString() for n in only}

    def part(below: str, schema: T.StructType, inside: bool) -> None:
        """Files of load 0, or of all later ones (``inside``), if there are any to read."""
        reader = spark.read.schema(schema)
        if names is None:
            rows = reader.parquet(below)
        else:
            paths = [p for n, p in names.items() if n.startswith("_loads/") == inside]
            if not paths:
                return
            rows = reader.option("basePath", below).parquet(*paths)
        file = folder.name_of(F.col("_metadata.file_path"))
        number = F.col(LOAD_COL) if inside else F.lit(0).cast("long")
        sources.append(rows.select(*[F.col(f"`{f.name}`") for f in fields], number.alias(LOAD_COL), file.alias(FILE_COL)))

    if version.plain:
        part(folder.path, T.StructType(fields), False)
    if version.loads:
        part(f"{folder.path}/_loads", T.StructType([*fields, load]), True)
    if not sources:
        empty = spark.createDataFrame([], T.StructType([*fields, load]))
        return empty.withColumn(FILE_COL, F.lit(None).cast("string"))
    rows = sources[0] if len(sources) == 1 else sources[0].unionByName(sources[1])
    if version.loads and set(version.loads) != set(folder.loads()):  # a failed load's files, or files left by a cut tidying
        rows = rows.where(F.col(LOAD_COL).isin(0, *version.loads))
    if version.replaced and names is None and not _settled(folder, version):
        rows = rows.where(~F.col(FILE_COL).isin(*version.replaced))
    since = {c.name: F.when(F.col(LOAD_COL) < c.since, F.lit(c.default).cast(c.type)).otherwise(F.col(f"`{c.name}`")) for c in version.columns if c.since and c.default is not None}
    return rows.withColumns(since) if since else rows


def _settled(folder: _Folder, version: Version) -> bool:
    """Whether the files that the version replaced are gone: the last one is removed last."""
    return not folder.fs.exists(folder.file(version.replaced[-1]))


def read_version(
    spark: SparkSession, path: str, version: Version, only: Iterable[str] | None = None, files: bool = False, after: int | None = None
) -> DataFrame:
    """The rows of a version; with ``files``, and the file of each in column ``_stored_file``. Of the files
    ``only``, or of the loads ``after`` one, if given."""
    rows = _rows(spark, _Folder(spark, path), version, only)
    rows = rows if after is None else rows.where(F.col(LOAD_COL) > after)
    return rows.drop(LOAD_COL) if files else rows.drop(LOAD_COL, FILE_COL)


def read_table(spark: SparkSession, path: str, partition_cols: Sequence[str] = (), like: T.StructType | None = None) -> DataFrame:
    """The table as of its newest version, old rows with the defaults of later columns."""
    version = current_version(spark, path, partition_cols, like)
    if version is None:
        raise FileNotFoundError(f"no table at {path}")
    return read_version(spark, path, version)


def read_or_none(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """A table, or ``None`` when nothing is stored there; with ``schema``, of plain files only."""
    if schema is None:
        version = current_version(spark, path)
        return None if version is None else read_version(spark, path, version)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def settle(spark: SparkSession, path: str, version: Version | None) -> None:
    """Remove what is no part of the table: files of loads that failed, and what the newest replaced."""
    folder = _Folder(spark, path)
    for n in folder.loads():
        if version is None or n not in version.loads:
            remove_path(spark, f"{folder.path}/_loads/{LOAD_COL}={n}")
    if version is None:
        return
    for name in version.replaced:
        folder.fs.delete(folder.file(name), False)
    if version.number and not version.plain:
        for name in folder.plain():
            remove_path(spark, f"{folder.path}/{name}")
    for n in folder.commits()[:-1]:
        folder.fs.delete(folder.at(f"_commits/{n:09d}.json"), False)


def _columns(schema: T.StructType, before: Version | None, number: int) -> tuple[Column, ...]:
    """The column ledger after a load: known columns stay as they are, new ones come with this load,
    flags with false for the rows before it."""
    known = {c.name.lower(): c for c in before.columns} if before else {}
    new = [f for f in schema.fields if f.name.lower() not in known]
    fresh = [Column(f.name, f.dataType.simpleString(), "false" if isinstance(f.dataType, T.BooleanType) else None, number) for f in new]
    return (*known.values(), *fresh)


def commit_load(
    rows: DataFrame,
    path: str,
    before: Version | None,
    partition_cols: Sequence[str] = (),
    replaced: Sequence[str] | None = (),
    notes: dict | None = None,
) -> Version:
    """Write ``rows`` as the next load of the table and commit it, on top of version ``before``.

    ``replaced`` are the files (names as in column ``_stored_file``) that the load takes the place of;
    ``None`` stands for all. ``rows`` may read the table itself. Unless all is replaced, columns keep the
    table's types.
    """
    spark = rows.sparkSession
    if before is not None and replaced is not None:
        types = {c.name.lower(): c.type for c in before.columns}
        rows = rows.select(*[F.col(f"`{f.name}`").cast(types.get(f.name.lower(), f.dataType)).alias(f.name) for f in rows.schema.fields])
    folder = _Folder(spark, path)
    _known(folder, before)
    settle(spark, path, before)
    number = max((before.number if before else 0, *folder.loads(), *folder.commits())) + 1
    parts = tuple(before.partitions if before and before.partitions else partition_cols)
    target = f"{folder.path}/_loads/{LOAD_COL}={number}"
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(*parts) if parts else writer).parquet(target)
    if replaced is None:
        fields = tuple(Column(f.name, f.dataType.simpleString()) for f in rows.schema.fields)
        after = Version(number, fields, parts, (number,), notes=notes)
    else:
        columns = _columns(rows.schema, before, number)
        loads = (*(before.loads if before else ()), number)
        after = Version(number, columns, parts, loads, bool(before and before.plain), tuple(replaced), notes)
    _commit(folder, after, before)
    settle(spark, path, after)
    return after


def _known(folder: _Folder, before: Version | None) -> None:
    if max(folder.commits(), default=0) != (before.number if before else 0):
        raise ConcurrentLoad(f"{folder.path}: another load has committed")


def _commit(folder: _Folder, version: Version, before: Version | None) -> None:
    _known(folder, before)
    folder.create(f"_commits/{version.number:09d}.json", json.dumps(asdict(version)))


def replace_table(rows: DataFrame, path: str, partition_cols: Sequence[str] = ()) -> DataFrame:
    """The whole table replaced by ``rows`` (which may read it), or created; returns it as stored."""
    spark = rows.sparkSession
    before = current_version(spark, path, partition_cols, rows.schema)
    parts = before.partitions if before and before.partitions else partition_cols
    if before and not set(p.lower() for p in before.partitions) <= {c.lower() for c in rows.columns}:
        before = replace(before, partitions=())
        parts = partition_cols
    return read_version(spark, path, commit_load(rows, path, before, parts, None))


def replace_partitions(rows: DataFrame, path: str, column: str, values: Sequence) -> DataFrame:
    """The partitions ``column`` = one of ``values`` replaced by ``rows``, which belong to them; a value
    without rows is left without a partition. The table is created where there is none."""
    spark = rows.sparkSession
    before = current_version(spark, path, [column], rows.schema)
    replaced: list[str] = []
    if before is not None:
        stored = read_version(spark, path, before, files=True).where(F.col(f"`{column}`").isin(list(values)))
        replaced = [r[0] for r in stored.select(FILE_COL).distinct().collect()]  # a name for each file of those partitions
    return read_version(spark, path, commit_load(rows, path, before, [column], replaced))


def add_stored_column(spark: SparkSession, path: str, column: str, dtype: str = "string", default=None) -> DataFrame:
    """E2 on storage: the column with its default (flags: false) on every row there is, by a commit
    alone. A column that is there already stays as it is."""
    before = current_version(spark, path)
    if before is None:
        raise FileNotFoundError(f"no table at {path}")
    if column.lower() not in (c.name.lower() for c in before.columns):
        kind = T._parse_datatype_string(dtype)
        if default is None and isinstance(kind, T.BooleanType):
            default = False
        folder = _Folder(spark, path)
        _known(folder, before)
        settle(spark, path, before)
        number = max((before.number, *folder.loads(), *folder.commits())) + 1
        text = None if default is None else (str(default).lower() if isinstance(default, bool) else str(default))
        after = replace(before, number=number, columns=(*before.columns, Column(column, kind.simpleString(), text, number)), replaced=())
        _commit(folder, after, before)
        settle(spark, path, after)
    return read_table(spark, path)
