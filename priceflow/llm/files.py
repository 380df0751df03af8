"""Files that tasks write and read by themselves, in a folder that all executors share.

A task writes under a name of its own and returns it; only names that reach the written list of files count.
So a task that runs twice leaves a file that nobody reads, and nothing is renamed or replaced.
"""

from __future__ import annotations

from uuid import uuid4

from pyarrow import fs
from pyspark.sql import SparkSession

#: Hadoop's schemes and Arrow's names for them; a folder of another scheme is refused on the driver.
SCHEMES = {"hdfs": "hdfs", "s3a": "s3", "s3": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def task_folder(spark: SparkSession, path: str) -> str:
    """``path`` as tasks must name it: with the scheme of Spark's default file system where it has none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toUri()
    if uri.getScheme() == "file":
        return uri.getPath()
    if uri.getScheme() not in SCHEMES:
        raise ValueError(f"tasks can't write files under {uri.toString()}: known are folders of {', '.join(['file', *SCHEMES])}")
    return f"{SCHEMES[uri.getScheme()]}://{uri.getAuthority()}{uri.getPath()}"


def _resolved(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def new_file(folder: str, suffix: str) -> str:
    return f"{folder}/{uuid4().hex}{suffix}"


def write_file(path: str):
    """An open output stream; folders are made as needed."""
    system, name = _resolved(path)
    system.create_dir(name.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(name, compression=None)


def read_file(path: str):
    """An open input stream with random access."""
    system, name = _resolved(path)
    return system.open_input_file(name)
