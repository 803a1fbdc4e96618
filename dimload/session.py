"""Session helpers: a local session for tests/bench and the shared checkpoint folder.

On a cluster the checkpoint folder must be the shared one the cluster names in
``spark.checkpoint.dir``; a machine-local temporary folder is only used when that setting is
unset and Spark runs in local mode (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "false",
}


def local_session(cpus: int | str = "*", app: str = "dimload", extra: dict | None = None) -> SparkSession:
    """A local session configured like the tests expect (UTC, AQE, UI off)."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(_LOCAL_DEFAULTS)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.driver.memory", os.environ.get("DIMLOAD_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint folder, setting a local one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a shared folder (HDFS/object store) for it"
        )
    path = tempfile.mkdtemp(prefix="dimload-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


#: Bytes of an Arrow batch on its way to or from a Python worker: whole texts take Spark's 10,000 rows far beyond it.
BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """End Arrow batches at ``BATCH_BYTES``: every running task holds some, in the JVM and in its Python
    worker. A size that the session names itself stays."""
    if spark.conf.get(_BATCH_CONF, None) is None:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def fresh_name(columns, name: str) -> str:
    """``name``, with underscores added until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for staged tables written by a job."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/staged/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint (survives executor loss; never ``localCheckpoint``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet files in the shared folder. Like a checkpoint it is computed once, but its readers
    read only the columns that they use, and plans know its size. Columns that are NULL without a type are
    left out and come back; other types that Parquet has not are checkpointed."""
    spark = df.sparkSession
    void = {c for c, kind in df.dtypes if kind == "void"}
    rows = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in void])
    if not rows.columns or any(word in kind for _, kind in rows.dtypes for word in ("void", "interval", "variant")):
        return materialize(df)
    path = scratch_path(spark, name)
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    return rows.select(*[F.lit(None).alias(c) if c in void else F.col(f"`{c}`") for c in df.columns]) if void else rows


def materialize_clustered(df: DataFrame, columns, partitions: int | None = None) -> DataFrame:
    """``df`` hash-partitioned by ``columns`` and checkpointed: rows of a key lie together."""
    ensure_checkpoint_dir(df.sparkSession)
    n = [partitions] if partitions else []
    return df.repartition(*n, *columns).checkpoint(eager=True)


def _folder(spark: SparkSession, path: str):
    """Hadoop's file system and path of a folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def sub_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path`` (none when it does not exist)."""
    fs, where = _folder(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()] if fs.exists(where) else []


def sub_folders_or_files(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there and holds anything."""
    fs, where = _folder(spark, path)
    return fs.exists(where) and len(fs.listStatus(where)) > 0


def local_path(spark: SparkSession, path: str) -> str | None:
    """The plain path of a folder that lies in a ``file:`` file system, else None."""
    fs, where = _folder(spark, path)
    uri = fs.makeQualified(where).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that a load no longer needs (staged copies, replaced partitions)."""
    fs, where = _folder(spark, path)
    fs.delete(where, True)
