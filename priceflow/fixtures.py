"""Price observations made of the order tables in a test data folder, and the tables that follow.

Each derived table is written once per application to the shared folder and then read from Parquet, as
a user's queries read stored tables.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from priceflow.operators.enrich import clean_without_derived
from priceflow.operators.strict import clean_strict
from priceflow.plans.pipeline import run_pipeline, store_cleaned
from priceflow.schemas import RAW
from priceflow.session import application_dir, bound_splits, path_exists, store_table
from priceflow.sources.prices import WIDE, read_raw, scan_named, type_columns, write_csv
from priceflow.sources.warehouse import Warehouse

# The unit of sale by part size; the last one is in no conversion table.
UNITS = (
    "KG", "90 KG", "50 KG", "13 KG", "64 KG", "126 KG", "400 G", "200 G", "L", "500 ML", "200 ML",
    "Unit", "Bunch", "Head", "Crate",
)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per order line, some of them twice, with the flaws that cleaning must find.

    The copies come from one pass over the lines. All joins are left to Catalyst: it broadcasts the
    small tables by their size.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    lines = (
        table("lineitem")
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    copies = F.when(F.col("l_partkey") % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    no_place = F.col("s_suppkey") % 47 == 0
    return lines.withColumn("copy", F.explode(copies)).select(
        F.when(F.col("l_orderkey") % 211 == 0, F.lit("n/a"))
        .when(F.col("l_orderkey") % 2 == 0, F.date_format("l_shipdate", "dd/MM/yyyy"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
        .alias("date"),
        F.when(~no_place, F.col("r_name")).alias("admin1"),
        F.when(~no_place, F.col("n_name")).alias("admin2"),
        F.concat(F.lit("  "), F.col("s_name")).alias("market"),
        F.col("s_suppkey").cast("int").alias("market_id"),
        _coordinate(no_place, F.col("n_nationkey") - 5).alias("latitude"),
        _coordinate(no_place, F.col("n_nationkey") + 30).alias("longitude"),
        F.col("p_type").alias("category"),
        F.when(F.col("p_size") % 5 == 0, F.concat(F.col("p_name"), F.lit(" (white)")))
        .otherwise(F.col("p_name"))
        .alias("commodity"),
        F.col("l_partkey").cast("int").alias("commodity_id"),
        F.element_at(F.array(*[F.lit(u) for u in UNITS]), (F.col("p_size") % len(UNITS) + 1).cast("int")).alias(
            "unit"
        ),
        F.when(F.col("l_linenumber") == 7, "actual,aggregate")
        .when(F.col("l_linestatus") == "O", "actual")
        .otherwise("aggregate")
        .alias("priceflag"),
        F.when(F.col("l_returnflag") == "N", "Wholesale").otherwise("Retail").alias("pricetype"),
        F.lit(" kes").alias("currency"),
        F.when(F.col("l_quantity") != 13, F.col("l_extendedprice").cast("decimal(8,2)")).alias("price"),
        (F.col("l_quantity") + F.col("l_tax")).cast("decimal(8,2)").alias("usdprice"),
    )


def _coordinate(no_place: Column, value: Column) -> Column:
    return F.when(~no_place & (F.col("l_linenumber") != 3), value.cast("decimal(8,4)"))


_SCHEMAS: dict[str, T.StructType] = {}


class Inputs:
    """The stored tables of one test data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        folder = hashlib.sha1(sf_dir.encode()).hexdigest()[:12]
        self.root = f"{application_dir(spark)}/inputs-{folder}"

    def _made(self, name: str) -> tuple[str, bool]:
        path = f"{self.root}/{name}"
        return path, path_exists(self.spark, f"{path}/_SUCCESS")

    def _read(self, path: str) -> DataFrame:
        """Looks at the files for the schema once, not in every query."""
        bound_splits(self.spark)
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def csv(self) -> str:
        """The observations as a CSV source, compressed: plain text is five times as large."""
        path, made = self._made("csv")
        if not made:
            write_csv(observations(self.spark, self.sf_dir), path, compression="gzip")
        return path

    def raw(self) -> DataFrame:
        """The raw table: all columns typed."""
        path, made = self._made("raw")
        if not made:
            store_table(read_raw(self.spark, self.csv(), ("iso", "dmy")), path)
        return self._read(path).select(*RAW.names)

    def cleaned(self) -> DataFrame:
        """The strictly cleaned table."""
        path, made = self._made("cleaned")
        if not made:
            store_table(clean_strict(self.raw()), path)
        return self._read(path)

    def extracted(self) -> DataFrame:
        """What the pipeline hands from extraction to cleaning: dates still text, with row order."""
        path, made = self._made("extracted")
        if not made:
            source = scan_named(self.spark, self.csv(), row_seq=True)
            typed = type_columns(source, price=WIDE, date_formats=None, coordinate=WIDE)
            store_table(typed, path)
        return self._read(path)

    def enriched(self) -> DataFrame:
        """The cleaned, enriched prices that checks and loads read."""
        path, made = self._made("enriched")
        if not made:
            return store_cleaned(clean_without_derived(self.extracted(), f"{self.root}/enriched_work"), path)
        return self._read(path)

    def warehouse(self) -> Warehouse:
        """Staging table and star schema, loaded by the pipeline; undated rows are set apart."""
        warehouse = Warehouse(self.spark, f"{self.root}/warehouse")
        if not warehouse.loads():
            run_pipeline(self.spark, [self.csv()], warehouse.root, load_id="first", on_violation="reject")
            warehouse.refresh()
        return warehouse


def comparable(df: DataFrame) -> DataFrame:
    """Types on which other engines agree: bigint, double, and dates as ISO text."""
    kinds = {"int": "bigint", "date": "string"}
    casts = {name: kinds.get(kind, "double" if kind.startswith("decimal") else None) for name, kind in df.dtypes}
    return df.select(*[F.col(f"`{n}`").cast(t).alias(n) if t else F.col(f"`{n}`") for n, t in casts.items()])
