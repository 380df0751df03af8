"""Load cleaned prices into the staging table and the star schema."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from uuid import uuid4

from pyspark.sql import Column, DataFrame, functions as F, types as T

from priceflow import schemas
from priceflow.operators import dimensions
from priceflow.operators.constraints import declared_rules, required
from priceflow.session import SPLIT_BYTES, hand_off, remove_path, store_table, stored_bytes
from priceflow.sources.warehouse import DIMENSIONS, TABLES, Warehouse

COUNTED = ("staging", "dim_date", "dim_commodity", "dim_market", "fact_prices", "rejected")


class ConstraintViolation(Exception):
    """Rows break a constraint that a table declares."""


def load_star(
    cleaned: DataFrame,
    warehouse: Warehouse,
    work_dir: str,
    load_id: str | None = None,
    full_reload: bool = False,
    on_violation: str = "fail",
    incremental: bool = False,
) -> dict[str, int]:
    """Append ``cleaned`` as one load and return the rows per table; dimensions count what the batch
    holds, also where the key was there before.

    ``cleaned`` is read several times and should be a stored table, best with the column of ``mark_broken``: the rules read all columns. ``on_violation="fail"`` stops when
    a row breaks a declared constraint; ``"reject"`` keeps such rows, with the rules, in the table ``rejected`` instead.
    A ``load_id`` that is already published is not loaded again.

    When another writer publishes first, the load is brought up to date and tried again: its keys follow the other's, its
    dimensions hold only keys that are still new, and with ``incremental`` it drops rows up to the new last date.
    """
    load_id = load_id or uuid4().hex
    done = _published_counts(warehouse, load_id)
    if done:
        return done

    def set_apart(rows: DataFrame, part: str) -> int:
        return _store(rows, f"{warehouse.path('rejected', load_id)}/part={part}").count()

    if BROKEN not in cleaned.columns:
        cleaned = mark_broken(cleaned)
    breaking = cleaned.where(F.col(BROKEN).isNotNull()).withColumn("broken", F.split(BROKEN, ",")).drop(BROKEN)
    failing = {r.rule: r["count"] for r in breaking.select(F.explode("broken").alias("rule")).groupBy("rule").count().collect()}
    rejected_rows = 0
    if failing and on_violation != "reject":
        raise ConstraintViolation("rows break declared constraints: " + _listed(failing))
    if failing:
        rejected_rows += set_apart(breaking, "rows")
        cleaned = cleaned.where(F.col(BROKEN).isNull())
    cleaned = cleaned.drop(BROKEN)

    candidates = {
        "dim_date": dimensions.date_dimension,
        "dim_commodity": lambda rows: dimensions.commodity_dimension(rows, work_dir),
        "dim_market": lambda rows: dimensions.market_dimension(rows, work_dir),
    }

    def write(cleaned: DataFrame) -> dict:
        """Write the load's folders against the loads that the warehouse object has read; the row that publishes them."""
        counts = {"rejected": rejected_rows}
        for table, key in DIMENSIONS.items():
            batch = _store(candidates[table](cleaned), f"{work_dir}/{table}")
            new = dimensions.insert_if_absent(warehouse.read(table), batch, key)
            # The first row of a key gives its attributes. A new key whose first row lacks one can't be loaded.
            lacking = reduce(or_, [F.col(c).isNull() for c in required(TABLES[table])])
            n_lacking = new.where(lacking).count() if table != "dim_date" else 0
            if n_lacking and on_violation != "reject":
                raise ConstraintViolation(f"{n_lacking} new keys of {table} lack a required attribute in their first row")
            if n_lacking:
                keys = hand_off(new.where(lacking).select(key), f"{work_dir}/{table}-lacking")
                lost = cleaned.join(keys, key, "left_semi").withColumn("broken", F.array(F.lit(f"{table}.attributes")))
                counts["rejected"] += set_apart(lost, table)
                cleaned = cleaned.join(keys, key, "left_anti")
                new = new.where(~lacking)
            _store(conform(new, TABLES[table]), warehouse.path(table, load_id))
            counts[table] = batch.count() - n_lacking

        current = [] if full_reload else warehouse.current_loads()
        facts = _store_by_year(
            conform(fact_rows(cleaned), schemas.FACT, "fact_id", _next_id(current, "last_fact_id")),
            "date_id",
            warehouse.path("fact_prices", load_id),
        )
        staged = _store_by_year(
            conform(cleaned, schemas.STAGING, "id", _next_id(current, "last_id")),
            "date",
            warehouse.path("stg_cleaned_prices", load_id),
        )
        fact_end = facts.agg(F.count("*").alias("rows"), F.max("fact_id").alias("last_id")).first()
        staged_end = staged.agg(
            F.count("*").alias("rows"), F.max("id").alias("last_id"), F.max("date").alias("last_date")
        ).first()
        return counts | {
            "staging": staged_end.rows,
            "fact_prices": fact_end.rows,
            "load_id": load_id,
            "full_reload": full_reload,
            "last_date": staged_end.last_date,
            "last_id": staged_end.last_id,
            "last_fact_id": fact_end.last_id,
        }

    row = write(cleaned)
    while not warehouse.publish(row):
        warehouse.refresh()
        done = _published_counts(warehouse, load_id)
        if done:
            return done
        for table in DIMENSIONS:
            remove_path(warehouse.spark, f"{warehouse.path('rejected', load_id)}/part={table}")
        mark = warehouse.high_water_mark() if incremental and not full_reload else None
        row = write(cleaned if mark is None else cleaned.where(F.col("date") > F.lit(mark)))
    return {table: row[table] for table in COUNTED}


def _published_counts(warehouse: Warehouse, load_id: str) -> dict[str, int] | None:
    return next(({t: done[t] for t in COUNTED} for done in warehouse.loads() if done.load_id == load_id), None)


def compact(warehouse: Warehouse, load_id: str | None = None) -> int:
    """Write the rows of all loads into the folders of one new load, and return how many loads it replaces.

    A scan opens one folder for each load; after this it opens one, and one for each later load. Rows, keys and load
    times stay as they are. Readers are not disturbed, as ``Warehouse.vacuum`` removes the old folders later. Loads that
    others publish meanwhile stay beside the new one; after a full reload or another compaction the rows are gathered again.
    """
    load_id = load_id or f"compact-{uuid4().hex}"
    warehouse.refresh()
    while True:
        read = {table: warehouse.live_loads(table) for table in TABLES}
        replaced = sorted({name for names in read.values() for name in names})
        if len(replaced) < 2:
            return 0
        for table in TABLES:
            path = warehouse.path(table, load_id)
            if table in DIMENSIONS:
                _store(warehouse.read(table).hint("rebalance"), path)
            else:
                _store_by_year(gathered_by_year(warehouse, table), "date_id" if table == "fact_prices" else "date", path)
        row = dict.fromkeys(COUNTED, 0) | {"load_id": load_id, "full_reload": False, "replaces": replaced}
        while all(set(names) <= set(warehouse.live_loads(table)) for table, names in read.items()):
            if warehouse.publish(row):
                return len(replaced)
            warehouse.refresh()


def gathered_by_year(warehouse: Warehouse, table: str) -> DataFrame:
    """The published rows of a table that is split by year, in tasks of one year each and about ``SPLIT_BYTES`` of files.

    The folders hold one year each already, so small files are read together and nothing is shuffled. A year gets two tasks
    at least: Spark makes a union of single partitions one task."""
    parts = []
    for _, folders in sorted(warehouse.year_folders(table).items()):
        tasks = -(-sum(stored_bytes(warehouse.spark, folder) for folder in folders) // SPLIT_BYTES)
        parts.append(warehouse.read_folders(table, folders).coalesce(max(tasks, 2)))
    return reduce(DataFrame.unionAll, parts) if parts else warehouse.read(table)


#: What every row needs: the keys of the fact table, and the date of the staging table.
ROW_KEYS = ("date", "commodity_id", "market_id")


def broken_rules(columns: Sequence[str]) -> dict[str, Column]:
    """Whether a cleaned row breaks a rule of the staging or fact table, by "column.rule".

    Dimension attributes may be missing in a row: a key takes them from its first row.
    """
    rules = {f"{name}.{rule}": broken for name, rule, broken in declared_rules(schemas.STAGING, columns)}
    return {f"{c}.not_null": F.col(c).isNull() for c in ROW_KEYS} | rules


#: The names of the rules that a cleaned row breaks, with commas between them; null if it breaks none.
BROKEN = "_broken"


def mark_broken(cleaned: DataFrame) -> DataFrame:
    """``cleaned`` with the column ``BROKEN``."""
    # The length of a null is null, and breaks nothing. Each rule stands in the plan once: the generated method has to stay
    # below the 8,000 bytes from which on the JVM does not compile it.
    names = F.concat_ws(",", *[F.when(rule, F.lit(name)) for name, rule in broken_rules(cleaned.columns).items()])
    return cleaned.withColumn(BROKEN, names).withColumn(BROKEN, F.nullif(BROKEN, F.lit("")))


def violates_required() -> Column:
    """Whether a cleaned row lacks a key that the fact table requires."""
    return reduce(or_, [F.col(c).isNull() for c in ROW_KEYS])


def _listed(failing: dict[str, int]) -> str:
    return ", ".join(f"{name} ({n} rows)" for name, n in sorted(failing.items()))


def fact_rows(cleaned: DataFrame) -> DataFrame:
    return cleaned.withColumnRenamed("date", "date_id").select(
        *[c for c in schemas.FACT.names if c not in ("fact_id", "loaded_at")]
    )


def conform(
    df: DataFrame, schema: T.StructType, id_column: str | None = None, first_id: int = 1
) -> DataFrame:
    """The table's columns in order and type, with its surrogate key and load time.

    The keys are unique and rise from load to load but have gaps, as each task counts in a range of
    its own; closing them would need the number of rows in all earlier tasks first. A load of a million
    tasks uses up a thousandth of all keys, and running out of them is an error under ANSI rules.
    """
    columns = []
    for field in schemas.storage_schema(schema).fields:
        if field.name == id_column:
            value = F.lit(first_id) + F.monotonically_increasing_id()
        elif field.name == "loaded_at":
            value = F.current_timestamp()
        else:
            value = F.col(field.name)
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def flat_copy(cleaned: DataFrame) -> DataFrame:
    """The staging columns without the key, with doubles for decimals: the shape of the second warehouse."""
    flat = conform(cleaned, T.StructType([f for f in schemas.STAGING.fields if f.name != "id"]))
    measures = {f.name: F.col(f.name).cast("double") for f in flat.schema if isinstance(f.dataType, T.DecimalType)}
    return flat.withColumns(measures)


def _next_id(loads: list, column: str) -> int:
    return max((load[column] for load in loads if load[column] is not None), default=0) + 1


def _store(df: DataFrame, path: str) -> DataFrame:
    return store_table(df, path)


def _store_by_year(df: DataFrame, date: str, path: str) -> DataFrame:
    """Split by year and, inside the files, sorted by date. The tasks keep the split of the stored
    input, which is by year already, so nothing is shuffled."""
    dated = df.withColumn("year", F.year(date))
    return store_table(dated.sortWithinPartitions("year", date), path, ["year"])
