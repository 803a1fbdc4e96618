"""Sources and sinks (S1-S4): mirror, delimited load, file manifest, unload.

All reads are Spark scans; all writes are parallel unless a single file is explicitly asked for.

Values may hold line ends. Written as they are, a file can only be read by one task; with
``encode_line_ends`` on both sides no value holds one, and files are read in parallel: text columns have
``%`` written as ``%25``, line feed as ``%0A`` and carriage return as ``%0D``.
"""

from __future__ import annotations

import os
import shutil
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimload import constants as C
from dimload.functions.columns import file_of_key
from dimload.session import fresh_name, local_path, remove_path, scratch_path

#: Bytes of delimited text that a task writes of a single file.
PART_BYTES = 64 << 20


def mirror(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Replace ``path`` with a copy of ``df`` (drop + create-as-select) and read it back."""
    df.write.mode("overwrite").format(fmt).save(path)
    return df.sparkSession.read.format(fmt).load(path)


def _format(delimiter: str, header: bool, quote: str, escape: str, null_value: str) -> dict[str, str]:
    """Options that both sides share, so that text comes back as it was: NULL and the empty text have
    markers of their own, blanks at the ends stay, and quoted values may hold line ends."""
    return {
        "sep": delimiter,
        "header": str(header).lower(),
        "quote": quote,
        "escape": escape,
        "charToEscapeQuoteEscaping": escape,
        "nullValue": null_value,
        "emptyValue": quote * 2,
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }


_ENCODED = (("%", "%25"), ("\n", "%0A"), ("\r", "%0D"))


def _text_columns(schema: T.StructType, change) -> list[Column]:
    """All columns, text ones changed."""
    return [(change(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")).alias(f.name) for f in schema.fields]


def _without_line_ends(c: Column) -> Column:
    for raw, code in _ENCODED:
        c = F.replace(c, F.lit(raw), F.lit(code))
    return c


def _with_line_ends(c: Column) -> Column:
    for raw, code in reversed(_ENCODED):
        c = F.replace(c, F.lit(code), F.lit(raw))
    return c


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    delimiter: str = C.UNLOAD_DELIMITER,
    header: bool = False,
    quote: str = '"',
    escape: str = C.UNLOAD_ESCAPE,
    null_value: str = C.UNLOAD_NULL,
    compression: str | None = None,
    multi_line: bool = True,
    encode_line_ends: bool = False,
) -> DataFrame:
    """S2 read side: delimited text with an explicit schema (no inference).

    A text that equals the NULL marker ``null_value`` reads as NULL; choose a marker that no text
    equals. With ``multi_line`` (default) values may hold line ends; a file is then one split. Without it,
    or with ``encode_line_ends`` (if the files were unloaded so), files are split and read in parallel.
    """
    multi_line = multi_line and not encode_line_ends
    options = _format(delimiter, header, quote, escape, null_value) | {"mode": "FAILFAST", "multiLine": str(multi_line).lower(), "lineSep": "\n"}
    options["emptyValue"] = ""
    if compression:
        options["compression"] = compression
    rows = spark.read.schema(schema).options(**options).csv(path)
    return rows.select(*_text_columns(rows.schema, _with_line_ends)) if encode_line_ends else rows


def load_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    target_path: str,
    truncate: bool = False,
    delimiter: str = C.UNLOAD_DELIMITER,
    header: bool = False,
    fmt: str = "parquet",
    encode_line_ends: bool = False,
) -> DataFrame:
    """Bulk-load delimited files into a table at ``target_path``.

    The table is created when missing (first write), emptied first when ``truncate``, otherwise
    appended to. Returns the table as read back.
    """
    rows = read_delimited(spark, path, schema, delimiter, header, encode_line_ends=encode_line_ends)
    rows.write.mode("overwrite" if truncate else "append").format(fmt).save(target_path)
    return spark.read.format(fmt).load(target_path)


def unload(
    df: DataFrame,
    path: str,
    delimiter: str = C.UNLOAD_DELIMITER,
    single: bool = False,
    header: bool = False,
    quote: str = '"',
    escape: str = C.UNLOAD_ESCAPE,
    null_value: str = C.UNLOAD_NULL,
    encode_line_ends: bool = False,
    max_bytes: int = C.UNLOAD_MAX_BYTES,
) -> None:
    """Write ``df`` as uncompressed delimited text, every text value quoted.

    Parallel by default (one file per partition). ``single=True`` writes one file of at most
    ``max_bytes``, in the order of the rows; what goes beyond comes in further files. A row longer than
    that raises. In a ``file:`` folder, which all tasks share, a file's parts are written by tasks of their own and
    copied to their places in it, also by tasks; elsewhere one task writes a file.
    """
    rows = df.select(*_text_columns(df.schema, _without_line_ends)) if encode_line_ends else df
    options = _format(delimiter, header, quote, escape, null_value) | {"compression": "none", "quoteAll": "true", "lineSep": "\n"}
    if not single:
        rows.write.mode("overwrite").options(**options).csv(path)
        return
    spark = df.sparkSession
    stage = scratch_path(spark, "unload")
    head = sum(2 * len(c.encode()) + 3 for c in df.columns) if header else 0
    local = local_path(spark, path) is not None and local_path(spark, stage) is not None
    parts, per_file = _in_parts(rows, options, max_bytes - head, PART_BYTES if local else max_bytes, f"{stage}/rows")
    if per_file == 1:
        parts.write.mode("overwrite").options(**options).csv(path)
    else:
        parts.write.options(**options | {"header": "false"}).csv(f"{stage}/parts")
        if header:
            rows.limit(0).coalesce(1).write.options(**options).csv(f"{stage}/head")
        remove_path(spark, f"{stage}/rows")
        _join_parts(spark, stage, per_file, path)
    remove_path(spark, stage)


def _in_parts(rows: DataFrame, options: dict[str, str], limit: int, part_bytes: int, stage: str) -> tuple[DataFrame, int]:
    """``rows`` in partitions, so many to a file of at most ``limit`` bytes as delimited text, by a running byte
    total; and that number. A partition's rows begin within ``part_bytes``.

    Rows are staged with their sizes. The totals add up over those sizes alone, staged piece by staged piece;
    rows move once, to the part that the order of their piece gives them. A file's rows begin within ``limit``
    less the largest row, so that the last of them ends within ``limit``.
    """
    size, at, piece, of, part, low, high = (fresh_name(rows.columns, n) for n in ("_size", "_at", "_piece", "_of", "_part", "_low", "_high"))
    text = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {k: v for k, v in options.items() if k not in ("header", "compression")})
    sized = rows.withColumns({size: F.octet_length(text).cast("long") + 1, at: F.monotonically_increasing_id(), piece: F.spark_partition_id()})
    sized.write.parquet(stage)
    sized = rows.sparkSession.read.schema(sized.schema).parquet(stage)
    total, largest = sized.agg(F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.max(size), F.lit(0))).head()
    if largest > limit:
        raise ValueError(f"a row takes {largest} bytes, a file {limit} at most")
    width = max(total if total <= limit else limit - largest + 1, 1)
    files, per_file = max(1, -(-total // width)), -(-width // part_bytes)
    pieces = sized.groupBy(piece).agg(F.sum(size).alias("_total"))
    pieces = pieces.select(piece, (F.sum("_total").over(Window.orderBy(piece)) - F.col("_total")).alias("_before"))
    start = F.sum(size).over(Window.partitionBy(piece).orderBy(at)) - F.col(size) + F.col("_before")
    starts = sized.select(piece, at, size).join(pieces, piece).select(piece, at, start.alias("_start"))
    of_file, in_file = F.floor(F.col("_start") / F.lit(width)), F.floor(F.col("_start") % F.lit(width) / F.lit(part_bytes))
    ranges = starts.groupBy(F.col(piece).alias(of), (of_file * per_file + in_file).cast("int").alias(part)).agg(F.min(at).alias(low), F.max(at).alias(high))
    placed = sized.join(F.broadcast(ranges), (F.col(piece) == F.col(of)) & F.col(at).between(F.col(low), F.col(high)))  # ranges: as many as pieces and parts
    parts = placed.repartitionById(files * per_file, F.col(part)).sortWithinPartitions(at)
    return parts.select(*[F.col(f"`{c}`") for c in rows.columns]), per_file


def _join_parts(spark: SparkSession, stage: str, per_file: int, path: str) -> None:
    """Replace ``path`` by files of ``per_file`` of the parts in ``stage`` each. The driver sees names and sizes; a
    task copies a part to its place, which a second attempt of it fills with the same bytes. Names that
    readers skip are given up when all is there."""
    head = [(f, n) for _, f, n in _part_files(f"{local_path(spark, stage)}/head")]
    remove_path(spark, path)
    folder = local_path(spark, path)
    os.makedirs(folder)
    copies, ends = [], {}
    for number, file, n in _part_files(f"{local_path(spark, stage)}/parts"):
        target = f"part-{number // per_file:05d}-{os.path.basename(stage)}.csv"
        for source, length in [(file, n)] if target in ends else [*head, (file, n)]:
            copies.append((source, f"{folder}/_{target}", ends.get(target, 0), length))
            ends[target] = ends.get(target, 0) + length
    for target, end in ends.items():
        with open(f"{folder}/_{target}", "wb") as f:
            f.truncate(end)
    spark.sparkContext.parallelize(copies, len(copies)).foreach(_copy)
    for target in ends:
        os.rename(f"{folder}/_{target}", f"{folder}/{target}")
    open(f"{folder}/_SUCCESS", "wb").close()


def _part_files(folder: str) -> list[tuple[int, str, int]]:
    """Number of the partition, file and size of what Spark wrote to a local folder, in the order of the rows."""
    names = [n for n in os.listdir(folder) if n.startswith("part-")] if os.path.isdir(folder) else []
    return sorted((int(n.split("-")[1]), f"{folder}/{n}", os.path.getsize(f"{folder}/{n}")) for n in names)


def _copy(copy: tuple[str, str, int, int]) -> None:
    """Copy a whole file into another one, which is there, at a byte of it."""
    source, target, at, length = copy
    with open(source, "rb") as a, open(target, "r+b") as b:
        b.seek(at)
        shutil.copyfileobj(a, b, 4 << 20)
        if b.tell() != at + length:
            raise OSError(f"{source} has {b.tell() - at} bytes, not {length}")


def file_manifest(spark: SparkSession, folders: Iterable[str], substring: str | None = None, recursive: bool = True) -> DataFrame:
    """S3: every file under ``folders`` whose path contains ``substring`` (``None``/''/'None' = all).

    Rows ``(url, mandatory, size, modified)``. Uses the ``binaryFile`` source with only its
    metadata columns selected, so file contents are never read.
    """
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    files = reader.load(list(folders)).select("path", "length", "modificationTime")
    if substring and substring != "None":
        files = files.filter(F.col("path").contains(substring))
    return files.select(
        F.col("path").alias("url"),
        F.lit(True).alias("mandatory"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def write_manifest(manifest: DataFrame, path: str) -> None:
    """S3 sink: the manifest as JSON lines ``{"url": ..., "mandatory": true}``."""
    manifest.select("url", "mandatory").write.mode("overwrite").json(path)


def manifest_names(manifest: DataFrame) -> DataFrame:
    """File names of a manifest (F10), independent of the machine's folder layout."""
    return manifest.select(file_of_key(F.col("url")).alias("file_name"), "mandatory", "size")
