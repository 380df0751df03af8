"""Tables that are replaced together."""

from __future__ import annotations

import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, types as T

from priceflow.session import list_folders, remove_path, store_table
from priceflow.sources.commits import CommitLog

VERSIONS = T.StructType(
    [
        T.StructField("version", T.StringType()),
        T.StructField("committed_at", T.TimestampType()),
    ]
)


class Version:
    """A folder of tables that nobody reads until it is published."""

    def __init__(self, path: str):
        self.path = path

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[1]

    def write(self, table: str, rows: DataFrame) -> DataFrame:
        """Store a table and read it back."""
        return store_table(rows, f"{self.path}/{table}")


class VersionedTables:
    """The tables of the version published last. Publishing writes one small file, so readers find either all old or
    all new tables, and those that opened the old ones keep them until a vacuum. A failed run leaves what was there.
    A version takes the place of the one before as a whole: a table that it lacks is gone."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._log = CommitLog(spark, f"{self.root}/published", VERSIONS)

    def new_version(self) -> Version:
        return Version(f"{self.root}/versions/{uuid4().hex}")

    def publish(self, version: Version) -> None:
        """Of several writers, the last one's tables stay."""
        self._log.rows()
        while not self._log.add({"version": version.name}):
            self._log.rows()

    def read(self, table: str) -> DataFrame:
        published = self._log.rows()
        if not published:
            raise FileNotFoundError(f"nothing is published in {self.root}")
        return self.spark.read.parquet(f"{self.root}/versions/{published[-1].version}/{table}")

    def vacuum(self, older_than: datetime.timedelta = datetime.timedelta(days=7)) -> list[str]:
        """Delete the versions replaced, or left unpublished, longer than ``older_than`` ago, and name them."""
        now = datetime.datetime.now()
        published = self._log.rows()
        replaced = {
            row.version for row, after in zip(published, published[1:]) if now - after.committed_at >= older_than
        }
        names = {row.version for row in published}
        removed = []
        for name, changed in list_folders(self.spark, f"{self.root}/versions"):
            old = now.timestamp() - changed >= older_than.total_seconds()
            if name in replaced or (name not in names and old):
                remove_path(self.spark, f"{self.root}/versions/{name}")
                removed.append(name)
        return sorted(removed)
