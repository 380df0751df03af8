"""Session settings and the shared folder for tables that one job writes and the next one reads."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app_name: str = "priceflow") -> SparkSession:
    """A local session for tests and the benchmark; on a cluster use the session you are given."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster it would be a different
    folder on each machine, and its contents would be lost with the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = _local_dir(spark.sparkContext.applicationId)
    return named.rstrip("/")


@lru_cache
def _local_dir(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"priceflow-{application_id}-")


_SCOPE: ContextVar[str | None] = ContextVar("scratch_scope", default=None)


def application_dir(spark: SparkSession) -> str:
    """This application's folder in the shared one. It is deleted when the driver's JVM ends in order."""
    path = f"{shared_dir(spark)}/priceflow/{spark.sparkContext.applicationId}"
    _delete_on_exit(path)
    return path


@lru_cache
def _delete_on_exit(path: str) -> None:
    spark = SparkSession.getActiveSession()
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(target)  # only what is there can be marked
    store.deleteOnExit(target)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; never one that another plan may still read.

    What is written there lasts until the innermost ``scratch_scope`` ends, or the application.
    """
    return f"{_SCOPE.get() or application_dir(spark)}/{name}-{uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end, also after a failure, every table written under a ``scratch_path`` of the block.

    No plan may read them afterwards: a result that is read later goes to a path taken before the block.
    """
    folder = scratch_path(spark, "scope")
    outer = _SCOPE.set(folder)
    try:
        yield
    finally:
        _SCOPE.reset(outer)
        remove_path(spark, folder)


def hand_off(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and read it back.

    Cuts the lineage with a table that outlives its executors. Catalyst then also knows the size of
    the data, so it broadcasts it only when it is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of Parquet that a task reads at once. Prices take 10 to 14 bytes a row there and 300 to 400 in memory, so splits of the usual
#: 128 MB are nine million rows, more than a task can sort or fold without spilling.
SPLIT_BYTES = 16 << 20


def bound_splits(spark: SparkSession) -> None:
    """Lower the session's limit of a file split to ``SPLIT_BYTES``, so that what a task holds does not grow with the tables."""
    key = "spark.sql.files.maxPartitionBytes"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)) > SPLIT_BYTES:
        spark.conf.set(key, str(SPLIT_BYTES))


#: Columns of whole paths, equal in all rows of a file: comparing them for the least and greatest value costs more than other columns, and serves nothing.
_PATHS = ("row_seq.file", "_source_file")


def store_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a large table and read it back in splits of at most ``SPLIT_BYTES``: a row group is never read in parts, so none is larger."""
    bound_splits(df.sparkSession)
    options = {f"parquet.column.statistics.enabled#{path}": False for path in _PATHS}
    writer = df.write.mode("overwrite").options(**options, **{"parquet.block.size": SPLIT_BYTES, "compression": "zstd"})
    writer.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def list_folders(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """Name and time of last change (seconds since 1970) of the folders in ``path``; none if it isn't there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(target):
        return []
    found = [f for f in store.listStatus(target) if f.isDirectory()]
    return [(f.getPath().getName(), f.getModificationTime() / 1000) for f in found]


def remove_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file under a name that nobody has taken; whether that went well.

    The file is written under a hidden name and then renamed, without replacing, so readers see it whole or not at all.
    Of two writers one gets the name where the store decides that in one step, as HDFS does.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    settings = spark._jsc.hadoopConfiguration()
    target = hadoop.Path(path)
    store = target.getFileSystem(settings)
    target = store.makeQualified(target)
    draft = hadoop.Path(target.getParent(), f"_draft-{uuid4().hex}")
    stream = store.create(draft, False)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    rename = getattr(hadoop, "Options$Rename")
    keep_existing = spark.sparkContext._gateway.new_array(rename, 1)
    keep_existing[0] = rename.NONE
    try:
        hadoop.FileContext.getFileContext(target.toUri(), settings).rename(draft, target, keep_existing)
    except Py4JJavaError as failure:
        store.delete(draft, False)
        if "FileAlreadyExistsException" in failure.java_exception.getClass().getName():
            return False
        raise
    return True
