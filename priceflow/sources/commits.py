"""A folder of numbered files of one row each, in which a number is given out once."""

from __future__ import annotations

import datetime
import json

from pyspark.errors import AnalysisException
from pyspark.sql import Row, SparkSession, types as T

from priceflow.session import put_if_absent


class CommitLog:
    """Rows in the order of their numbers. ``add`` takes the number after the last one read, so of writers that
    have read the same rows only the first succeeds. The schema needs ``committed_at``."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType):
        self.spark = spark
        self.folder = folder
        self.schema = schema
        self._last = 0

    def rows(self) -> list[Row]:
        try:
            rows = self.spark.read.schema(self.schema).json(self.folder)
            read = rows.select("*", "_metadata.file_name").collect()
        except AnalysisException as failure:
            if failure.getCondition() != "PATH_NOT_FOUND":
                raise
            read = []
        read.sort(key=lambda row: row.file_name)
        self._last = int(read[-1].file_name.split(".")[0]) if read else 0
        return read

    def add(self, row: dict) -> bool:
        committed = row | {"committed_at": datetime.datetime.now(datetime.timezone.utc).isoformat()}
        path = f"{self.folder}/{self._last + 1:012d}.json"
        return put_if_absent(self.spark, path, json.dumps(committed, default=str) + "\n")
