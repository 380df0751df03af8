"""The tables of one warehouse folder.

Every load writes its rows to its own ``load_id=`` folder of each table and then one row to ``loads``.
That row publishes the load: readers see the loads listed there and no others, so a load that stopped
half-way is invisible and can simply be run again. Fact and staging are further split by year, which
together with sorted files takes the place of an index on the date.

Rows of ``loads`` are numbered, and a number is given once: a writer publishes under the number after the last
one it has read, so it learns when another writer was first. Writers must use different load ids. A compaction is
a load that ``replaces`` the folders of others; those stay until a vacuum, for readers that opened them.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from priceflow import schemas
from priceflow.session import list_folders, remove_path
from priceflow.sources.commits import CommitLog

LOADS = T.StructType(
    [
        T.StructField("load_id", T.StringType()),
        T.StructField("full_reload", T.BooleanType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("staging", T.LongType()),
        T.StructField("dim_date", T.LongType()),
        T.StructField("dim_commodity", T.LongType()),
        T.StructField("dim_market", T.LongType()),
        T.StructField("fact_prices", T.LongType()),
        T.StructField("rejected", T.LongType()),
        T.StructField("last_date", T.DateType()),
        T.StructField("last_id", T.LongType()),
        T.StructField("last_fact_id", T.LongType()),
        T.StructField("replaces", T.ArrayType(T.StringType())),
    ]
)

TABLES = {
    "stg_cleaned_prices": schemas.STAGING,
    "dim_date": schemas.DIM_DATE,
    "dim_commodity": schemas.DIM_COMMODITY,
    "dim_market": schemas.DIM_MARKET,
    "fact_prices": schemas.FACT,
}
DIMENSIONS = {"dim_date": "date_id", "dim_commodity": "commodity_id", "dim_market": "market_id"}

_LOAD_ID = T.StructField("load_id", T.StringType())
_YEAR = T.StructField("year", T.IntegerType())


class Warehouse:
    """Looks up the published loads once and reads all tables as of then; a load through the same
    object, or ``refresh``, moves it on."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._log = CommitLog(spark, self.path("loads"), LOADS)
        self._loads: list | None = None

    def refresh(self) -> None:
        self._loads = None

    def path(self, table: str, load_id: str | None = None) -> str:
        folder = f"{self.root}/{table}"
        return folder if load_id is None else f"{folder}/load_id={load_id}"

    def loads(self) -> list:
        """The published loads, oldest first: one small row for each."""
        if self._loads is None:
            self._loads = self._published()
        return self._loads

    def _published(self) -> list:
        first = {}
        for row in self._log.rows():
            first.setdefault(row.load_id, row)
        return list(first.values())

    def current_loads(self) -> list:
        """The loads whose facts count: those from the last full reload on."""
        loads = self.loads()
        restarts = [i for i, load in enumerate(loads) if load.full_reload]
        return loads[restarts[-1] :] if restarts else loads

    def live_loads(self, table: str) -> list[str]:
        """The loads whose folders hold the rows of ``table``. Dimensions outlive a full reload, the other tables
        restart with it."""
        loads = self.loads()
        replaced = {name for load in loads for name in load.replaces or ()}
        counting = loads if table in DIMENSIONS else self.current_loads()
        return [load.load_id for load in counting if load.load_id not in replaced]

    def read(self, table: str) -> DataFrame:
        """The published rows."""
        return self.read_folders(table, [self.path(table, i) for i in self.live_loads(table)])

    def year_folders(self, table: str) -> dict[str, list[str]]:
        """The folders that hold the published rows of a table split by year, by the name of the year's folder."""
        found: dict[str, list[str]] = {}
        for load in (self.path(table, i) for i in self.live_loads(table)):
            for name, _ in list_folders(self.spark, load):
                if name.startswith("year="):
                    found.setdefault(name, []).append(f"{load}/{name}")
        return found

    def read_folders(self, table: str, folders: list[str]) -> DataFrame:
        """The rows in some of the table's folders."""
        schema = TABLES[table]
        names = schema.names
        if table not in DIMENSIONS:
            schema = T.StructType([f for f in schema.fields if f.name != "year"])
            schema = schemas.storage_schema(schema, _LOAD_ID, _YEAR)
        else:
            schema = schemas.storage_schema(schema, _LOAD_ID)
        if not folders:
            return self.spark.createDataFrame([], schema).select(*names)
        stored = self.spark.read.schema(schema).option("basePath", self.path(table))
        return stored.parquet(*folders).select(*names)

    def high_water_mark(self):
        """The last date in the staging table, from the list of loads; None before the first load."""
        dates = [load.last_date for load in self.current_loads() if load.last_date is not None]
        return max(dates, default=None)

    def register_views(self, prefix: str = "") -> None:
        for table in TABLES:
            self.read(table).createOrReplaceTempView(prefix + table)

    def read_rejected(self) -> DataFrame:
        """The rows that published loads have set apart, with the rules they break and their load_id."""
        held = {name.removeprefix("load_id=") for name, _ in list_folders(self.spark, self.path("rejected"))}
        parts = [
            self.spark.read.parquet(f"{self.path('rejected', i)}/{part}").withColumn("load_id", F.lit(i))
            for i in (load.load_id for load in self.loads())
            if i in held
            for part, _ in list_folders(self.spark, self.path("rejected", i))
        ]
        if not parts:
            schema = schemas.storage_schema(schemas.STAGING, T.StructField("broken", T.ArrayType(T.StringType())), _LOAD_ID)
            return self.spark.createDataFrame([], schema)
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part, allowMissingColumns=True)
        return rows

    def vacuum(self, older_than: datetime.timedelta = datetime.timedelta(days=7)) -> list[str]:
        """Delete the folders of loads that no reader may still need, and name them.

        These are facts and staging rows that a full reload replaced longer than ``older_than`` ago, folders that a
        compaction replaced that long ago, and folders that long unchanged whose load was never published. Readers that
        opened the tables before keep working until then: reloads and compactions delete nothing.
        """
        now = datetime.datetime.now()
        self.refresh()
        loads = self.loads()
        current = self.current_loads()
        reloaded = {load.load_id for load in loads} - {load.load_id for load in current}
        if not current or now - current[0].committed_at < older_than:
            reloaded = set()
        compacted = {
            name for load in loads if now - load.committed_at >= older_than for name in load.replaces or ()
        }
        published = {load.load_id for load in loads}
        removed = []
        for table in [*TABLES, "rejected", "broken_records"]:
            replaced = set() if table in DIMENSIONS else set(reloaded)
            replaced |= compacted if table in TABLES else set()
            for name, changed in list_folders(self.spark, self.path(table)):
                load_id = name.removeprefix("load_id=")
                old = now.timestamp() - changed >= older_than.total_seconds()
                if load_id in replaced or (load_id not in published and old):
                    remove_path(self.spark, f"{self.path(table)}/{name}")
                    removed.append(f"{table}/{name}")
        return sorted(removed)

    def publish(self, row: dict) -> bool:
        """Publish a load as the next one after those that this object has read. False if another writer has
        published since: ``refresh``, and bring the load up to date."""
        self.loads()
        taken = self._log.add(row)
        if taken:
            self.refresh()
        return taken
