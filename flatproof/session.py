"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "flatproof", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects (UTC, AQE, skew joins)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Look-ups by the same key follow each other; split a hot key even if the next one shuffles again for it.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.ui.enabled", "false")
        # The rules of a layout make long generated methods. Above this size the JVM would not compile
        # them to machine code; Spark then generates shorter ones, operator by operator.
        .config("spark.sql.codegen.hugeMethodLimit", str(METHOD_BYTES))
        # Call-site capture costs several JVM round trips per column operation.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for staged tables, as named by the session.

    A cluster sets ``spark.checkpoint.dir`` to storage every executor can see. Only
    where it is unset (a local test) is a folder of this machine used.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="flatproof-")
        spark.conf.set(CHECKPOINT_CONF, root)
    return root.rstrip("/")


def session_scratch(spark: SparkSession) -> str:
    """The folder of this application under :func:`scratch_root`."""
    return f"{scratch_root(spark)}/{spark.sparkContext.applicationId}"


_SCOPE: ContextVar[str] = ContextVar("scratch scope", default="")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder under :func:`session_scratch`."""
    return f"{session_scratch(spark)}/{_SCOPE.get()}{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """What this thread stages inside is removed at the end. Results must have been written elsewhere by then."""
    outer = _SCOPE.get()
    own = f"{outer}scope-{uuid.uuid4().hex}/"
    token = _SCOPE.set(own)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        remove(spark, f"{session_scratch(spark)}/{own}")


def _file_system(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a pattern, in order; one call for all of them."""
    fs, found = _file_system(spark, pattern)
    return sorted(str(status.getPath()) for status in fs.globStatus(found) or [])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all that is in it, if it is there."""
    fs, found = _file_system(spark, path)
    fs.delete(found, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove everything this application has staged. Results that were not written elsewhere are lost."""
    remove(spark, session_scratch(spark))


def pin_splits(spark: SparkSession) -> None:
    """Fix how files are cut into splits for the rest of the session.

    Spark derives the split size from the number of cores at planning time, which changes
    when executors come and go. Line numbering scans the same files twice and needs the
    same cut both times.
    """
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))


#: Above this size of a generated method the JVM interprets it.
METHOD_BYTES = 8000


def compile_methods(spark: SparkSession) -> None:
    """Let the JVM compile what is generated for the rest of the session, as :func:`build_session` sets it, in a
    session that others built: for wide work like the rules of all layouts."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key)) > METHOD_BYTES:
        spark.conf.set(key, str(METHOD_BYTES))


def spread(df: DataFrame) -> DataFrame:
    """Deal rows evenly over the session's shuffle partitions, whatever their number.

    For raw rows before work that is heavy per row: files that can't be cut (one row group, a
    compressed text) would otherwise keep all of it in one task each.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def stage(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a table to the shared scratch folder and read it back.

    Used where one result feeds several joins: the work before it runs once, a lost executor
    only costs a re-read, and Spark knows the true size of what it joins, so that it sends a small
    table along by its own limit and shuffles a large one. :func:`clear_scratch` removes all that
    a session has staged.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
