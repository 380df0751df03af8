
from __future__ import annotations

import datetime
import importlib.util
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from oracle_queries import oracles
from priceflow import schemas
from priceflow.fixtures import Inputs, comparable
from priceflow.operators import constraints, dimensions, enrich, quality, strict
from priceflow.operators.geofill import geo_fill
from priceflow.plans import load, models, pipeline, star_queries, strict_queries
from priceflow.session import hand_off, put_if_absent, scratch_path
from priceflow.sources import prices
from priceflow.sources.versions import VersionedTables
from priceflow.sources.warehouse import TABLES, Warehouse

# An optional part, which nothing else imports. Where it is there, a failing import of it is an error.
_llm = importlib.util.find_spec("priceflow.llm")
if _llm and _llm.origin and importlib.util.find_spec("corpus_pipeline"):
    import corpus_pipeline
    from priceflow.llm import oracle as llm_oracle, queries as llm_queries
else:
    corpus_pipeline = llm_oracle = llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]

# Names and years that occur in the test data, in place of the defaults.
COMMODITY = "red gear (white)"
PATTERN = "%gear%"
YEARS = {"from_year": 1996, "to_year": 2000, "exclude": ("red%", "blue%", "old bolt")}
MARK = datetime.date(2000, 12, 31)
STANDARD = [schemas.STANDARD_RENAMES.get(c, c) for c in schemas.RAW.names]
STAGED = [c for c in schemas.STAGING.names if c not in ("id", "loaded_at")]
FACTS = [c for c in schemas.FACT.names if c not in ("fact_id", "loaded_at")]


def entry(spark: SparkSession) -> DataFrame:
    """Yearly averages per commodity and price type, from the raw observations on."""
    return queries()["q1_avg_price_per_commodity_year"](spark, "/root/testdata/sf0.001")


# --- sources and sinks -----------------------------------------------------------------------------


def s1_scan_parse(inputs: Inputs) -> DataFrame:
    return prices.read_raw(inputs.spark, inputs.csv(), ("iso", "dmy"))


def s2_typed_scan(inputs: Inputs) -> DataFrame:
    return prices.type_columns(prices.scan_named(inputs.spark, inputs.csv()), date_formats=("iso",))


def s2_quoted_line_breaks(inputs: Inputs) -> DataFrame:
    """A source of which some files have line breaks inside quotes: every record is one row."""
    root = scratch_path(inputs.spark, "line-breaks")
    text = prices.scan_named(inputs.spark, inputs.csv())
    chosen = F.coalesce(F.col("commodity_id").try_cast("int") % 7 == 0, F.lit(False))
    prices.write_csv(text.where(~chosen), f"{root}/plain")
    prices.write_csv(text.where(chosen).withColumn("market", F.concat("market", F.lit("\nsecond line"))), f"{root}/quoted")

    def scan(files: list[str], multi_line: bool = False) -> DataFrame:
        return prices.scan_named(inputs.spark, files, multi_line=multi_line, mark_ragged=True)

    rows, _, _ = prices.route_ragged(
        hand_off(scan([f"{root}/plain", f"{root}/quoted"]), f"{root}/first"),
        lambda files: scan(files, multi_line=True),
        lambda again: hand_off(again, f"{root}/again"),
    )
    two_lines = F.count_if(F.col("market").endswith("\nsecond line")).alias("two_lines")
    return rows.groupBy("priceflag").agg(F.count("*").alias("rows"), two_lines)


def s3_source_with_fallback(inputs: Inputs) -> DataFrame:
    missing = f"{inputs.root}/no-such-source"
    source = prices.first_readable(inputs.spark, [missing, inputs.csv()])
    return source.groupBy("priceflag").agg(F.count("*").alias("rows"))


def s3_damaged_source(inputs: Inputs) -> DataFrame:
    """A first source that breaks off while it is read: the rows are those of the second one, and of no other."""
    root = scratch_path(inputs.spark, "sources")
    prices.write_csv(prices.scan_named(inputs.spark, inputs.csv()), f"{root}/damaged")
    put_if_absent(inputs.spark, f"{root}/damaged/part-damaged.csv.gz", "not compressed")
    source = prices.extract_first(
        inputs.spark, [f"{root}/damaged", inputs.csv()], lambda rows, name: hand_off(rows, f"{root}/{name}")
    )
    tried = F.lit(len(source.failures)).alias("failed_sources")
    return source.rows.groupBy("priceflag").agg(F.count("*").alias("rows"), tried)


def s4_parquet_hand_off(inputs: Inputs) -> DataFrame:
    return hand_off(s1_scan_parse(inputs), scratch_path(inputs.spark, "hand-off"))


def s5_source_tables(inputs: Inputs) -> DataFrame:
    inputs.warehouse().register_views()
    counts = [f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in TABLES]
    return inputs.spark.sql(" UNION ALL ".join(counts))


def s5_compacted_tables(inputs: Inputs) -> DataFrame:
    """The tables after one load for each year and a compaction of them all."""
    root = scratch_path(inputs.spark, "compacted")
    warehouse, enriched = Warehouse(inputs.spark, root), inputs.enriched()
    years = [r.year for r in enriched.select("year").distinct().orderBy(F.col("year").asc_nulls_last()).collect()]
    for year in years:
        rows = enriched.where(F.col("year").eqNullSafe(year))
        load.load_star(rows, warehouse, f"{root}/_work/{year}", f"year-{year}", on_violation="reject")
    load.compact(warehouse)
    counts = [warehouse.read(t).agg(F.lit(t).alias("table_name"), F.count("*").alias("rows")) for t in TABLES]
    folders = F.lit(max(len(warehouse.live_loads(t)) for t in TABLES))
    return reduce(DataFrame.unionAll, counts).withColumn("folders", folders)


def _rows_by_type(df: DataFrame) -> DataFrame:
    return df.groupBy("pricetype").agg(F.count("*").alias("rows"))


def k1_replace_raw(inputs: Inputs) -> DataFrame:
    tables = VersionedTables(inputs.spark, scratch_path(inputs.spark, "replaced"))
    for _ in range(2):
        version = tables.new_version()
        version.write("raw", inputs.raw())
        tables.publish(version)
    return _rows_by_type(tables.read("raw"))


def k2_append_raw(inputs: Inputs) -> DataFrame:
    path = scratch_path(inputs.spark, "appended")
    prices.append_table(inputs.raw(), path)
    prices.append_table(inputs.raw(), path)
    return _rows_by_type(inputs.spark.read.parquet(path))


def _strict_table(name: str) -> Callable[[Inputs], DataFrame]:
    """A table that the strict pipeline stores."""

    def run(inputs: Inputs) -> DataFrame:
        root = scratch_path(inputs.spark, "strict")
        pipeline.run_strict(inputs.spark, [f"{root}/none", inputs.csv()], root)
        return VersionedTables(inputs.spark, root).read(name)

    return run


def k4_load_staging(inputs: Inputs) -> DataFrame:
    return inputs.warehouse().read("stg_cleaned_prices").select(*STAGED)


def _table_counts(warehouse: Warehouse) -> DataFrame:
    """The counts of the last load, one row for each table."""
    loads = warehouse.spark.read.schema("load_id string, committed_at timestamp, " + ", ".join(
        f"{t} bigint" for t in load.COUNTED)).json(warehouse.path("loads"))
    last = loads.orderBy(F.desc("committed_at")).limit(1)
    rows = [F.struct(F.lit(t).alias("table_name"), F.col(t).alias("rows")) for t in load.COUNTED]
    return last.select(F.inline(F.array(*rows)))


def k6_full_reload(inputs: Inputs) -> DataFrame:
    """The second run replaces staging and facts: the tables hold each row once."""
    root = scratch_path(inputs.spark, "reloaded")
    for _ in range(2):
        pipeline.run_pipeline(inputs.spark, [inputs.csv()], root, full_reload=True, on_violation="reject")
    warehouse = Warehouse(inputs.spark, root)
    names = {"staging": "stg_cleaned_prices"}
    held = [
        warehouse.read(names.get(t, t)).agg(F.lit(t).alias("table_name"), F.count("*").alias("rows"))
        for t in load.COUNTED
        if t != "rejected"
    ]
    held.append(_table_counts(warehouse).where("table_name = 'rejected'"))
    result = held[0]
    for other in held[1:]:
        result = result.unionAll(other)
    return result


def k7_csv_cleaned(inputs: Inputs) -> DataFrame:
    path = scratch_path(inputs.spark, "cleaned-csv")
    prices.write_csv(inputs.cleaned(), path, compression="gzip")
    text = prices.scan_named(inputs.spark, path)
    back = {"region": "admin1", "county": "admin2"}
    return prices.type_columns(text.withColumnsRenamed(back)).withColumnsRenamed(schemas.STRICT_RENAMES)


def k7_csv_rows_with_nulls(inputs: Inputs) -> DataFrame:
    path = scratch_path(inputs.spark, "nulls-csv")
    prices.write_csv(strict.rows_with_nulls(inputs.raw()), path)
    return prices.read_raw(inputs.spark, path, ("iso",))


def k8_published_views(inputs: Inputs) -> DataFrame:
    models.publish_models(inputs.warehouse())
    observations = {
        "agg_monthly_avg_price": "observation_count",
        "agg_price_trends": "observations",
        "agg_commodity_summary": "total_observations",
    }
    counts = [
        f"SELECT '{view}' AS model, count(*) AS rows, sum({column}) AS observations FROM {view}"
        for view, column in observations.items()
    ]
    return inputs.spark.sql(" UNION ALL ".join(counts))


def k9_flat_copy(inputs: Inputs) -> DataFrame:
    path = scratch_path(inputs.spark, "flat")
    prices.append_table(load.flat_copy(_dated(inputs.enriched())), path)
    return inputs.spark.read.parquet(path).select(*STAGED)


def _dated(enriched: DataFrame) -> DataFrame:
    return enriched.where(~load.violates_required())


# --- cleaning --------------------------------------------------------------------------------------


def c5_parse_dates(inputs: Inputs) -> DataFrame:
    dated = enrich.parse_dates(inputs.extracted())
    return dated.groupBy("year", "month").agg(
        F.count("*").alias("rows"), F.count_if(F.col("date").isNull()).alias("bad_dates")
    )


def c6_handle_missing(inputs: Inputs) -> DataFrame:
    standard = enrich.standardize_columns(inputs.extracted())
    filled = enrich.handle_missing(standard, scratch_path(inputs.spark, "missing"))
    return filled.select(*[c for c in STANDARD if c != "date"])


def c7_geo_fill(inputs: Inputs) -> DataFrame:
    filled = geo_fill(inputs.extracted(), scratch_path(inputs.spark, "geo"))
    return filled.groupBy("market", "latitude", "longitude").agg(F.count("*").alias("rows"))


def c7_geo_fill_moving(inputs: Inputs) -> DataFrame:
    """Values that differ inside a market: the order of the rows decides. The blocks are ranges of the
    order key, and the place in a block is the rank there."""
    return _moving(inputs, F.expr("l_orderkey div 512"), "l_suppkey")


def c7_geo_fill_one_block(inputs: Inputs) -> DataFrame:
    """The same order of all rows as one market in one block, as in a file that can't be split."""
    return _moving(inputs, F.lit(0), "one_market")


def _moving(inputs: Inputs, block: Column, market: str) -> DataFrame:
    order = [
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ]
    lines = inputs.spark.read.parquet(f"{inputs.sf_dir}/lineitem.parquet")
    known = ~F.col("l_linenumber").isin(1, 3) & (F.col("l_suppkey") % 7 != 0)
    place = F.struct(
        F.lit("lineitem").alias("file"),
        block.alias("block"),
        F.struct(*order).alias("row"),
    )
    moving = lines.select(
        *order,
        F.least("l_linenumber", F.lit(0)).alias("one_market"),  # no literal: joins on one would be cross joins
        F.when(known, (F.col("l_partkey") % 90).cast("decimal(8,4)")).alias("latitude"),
        place.alias("row_seq"),
    )
    filled = geo_fill(moving, scratch_path(inputs.spark, "geo"), market=market, coordinates=("latitude",))
    return filled.select(*order[:6], "latitude")


def c8_standardize_names(inputs: Inputs) -> DataFrame:
    names = ["region", "county", "market", "category", "commodity", "currency"]
    uniform = enrich.standardize_names(enrich.standardize_columns(inputs.extracted()))
    return uniform.groupBy(*names).agg(F.count("*").alias("rows"))


def c9_price_per_kg(inputs: Inputs) -> DataFrame:
    priced = enrich.drop_unpriced(enrich.standardize_columns(inputs.extracted()))
    return enrich.price_per_kg(priced).select(
        "commodity_id", "market_id", "unit", "price", "usd_price", "price_per_kg", "usd_price_per_kg"
    )


def c10_clean(inputs: Inputs) -> DataFrame:
    return enrich.clean(inputs.extracted(), scratch_path(inputs.spark, "clean")).select(*STAGED)


# --- star schema -----------------------------------------------------------------------------------


def _model(name: str) -> Callable[[Inputs], DataFrame]:
    return lambda inputs: models.build_models(inputs.warehouse())[name]


def _over_star(query: Callable[..., DataFrame], *tables: str, **literals) -> Callable[[Inputs], DataFrame]:
    def run(inputs: Inputs) -> DataFrame:
        warehouse = inputs.warehouse()
        return query(*[warehouse.read(t) for t in tables], **literals)

    return run


def u2_dim_commodity(inputs: Inputs) -> DataFrame:
    work = scratch_path(inputs.spark, "dim")
    return dimensions.commodity_dimension(_dated(inputs.enriched()), work)


def u3_dim_market(inputs: Inputs) -> DataFrame:
    return dimensions.market_dimension(_dated(inputs.enriched()), scratch_path(inputs.spark, "dim"))


def u7_two_batches(inputs: Inputs) -> DataFrame:
    """A first batch of some years, then the whole source: what is older than the mark stays out."""
    root = scratch_path(inputs.spark, "batches")
    date = F.col("parsed")
    first = prices.scan_named(inputs.spark, inputs.csv())
    first = first.withColumn("parsed", prices.parse_date(F.col("date")))
    first = first.where((date >= "1997-01-01") & (date <= F.lit(MARK))).drop("parsed")
    prices.write_csv(first, f"{root}-source", compression="gzip")
    for source in (f"{root}-source", inputs.csv()):
        pipeline.run_pipeline(inputs.spark, [source], root, on_violation="reject")
    warehouse = Warehouse(inputs.spark, root)
    held = [
        warehouse.read(table).agg(
            F.lit("staging" if table == "stg_cleaned_prices" else table).alias("table_name"),
            F.count("*").alias("rows"),
        )
        for table in TABLES
    ]
    result = held[0]
    for other in held[1:]:
        result = result.unionAll(other)
    return result


def u8_surrogate_keys(inputs: Inputs) -> DataFrame:
    keys = {"stg_cleaned_prices": "id", "fact_prices": "fact_id"}
    warehouse = inputs.warehouse()
    counts = [
        warehouse.read(table).agg(
            F.lit(table).alias("table_name"),
            F.count("*").alias("rows"),
            F.count_distinct(key).alias("keys"),
            (F.min(key) >= 1).alias("positive"),
        )
        for table, key in keys.items()
    ]
    return counts[0].unionAll(counts[1])


def _suppliers(inputs: Inputs, origin: str) -> DataFrame:
    lines = inputs.spark.read.parquet(f"{inputs.sf_dir}/lineitem.parquet")
    if origin == "old":
        lines = lines.where("l_shipdate < timestamp_ntz'1995-02-01'")
    return lines.select("l_suppkey", F.lit(origin).alias("origin")).distinct()


def j4_insert_if_absent(inputs: Inputs) -> DataFrame:
    old, new = _suppliers(inputs, "old"), _suppliers(inputs, "new")
    return dimensions.merge_if_absent(old, new, "l_suppkey")


def w4_first_row_per_key(inputs: Inputs) -> DataFrame:
    """Keys with several versions of their attributes, many of them on one day."""
    order = [
        "ship_day", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    ]
    lines = inputs.spark.read.parquet(f"{inputs.sf_dir}/lineitem.parquet")
    lines = lines.withColumn("ship_day", F.col("l_shipdate").cast("date"))
    return dimensions.first_per_key(
        lines, "l_partkey", ["l_returnflag", "l_linestatus"], order, scratch_path(inputs.spark, "first")
    )


# --- quality ---------------------------------------------------------------------------------------


def d10_referential(inputs: Inputs) -> DataFrame:
    warehouse = inputs.warehouse()
    keys = {"date_id": "dim_date", "commodity_id": "dim_commodity", "market_id": "dim_market"}
    return constraints.referential(
        warehouse.read("fact_prices"), {key: warehouse.read(table) for key, table in keys.items()}
    )


def d10_orphans_of_older_dimensions(inputs: Inputs) -> DataFrame:
    """Keys first seen after January 1995 are missing in dimensions of that time."""
    lines = inputs.spark.read.parquet(f"{inputs.sf_dir}/lineitem.parquet")
    old = lines.where("l_shipdate < timestamp_ntz'1995-02-01'")
    return constraints.referential(lines, {k: old.select(k).distinct() for k in ("l_partkey", "l_suppkey")})


def d12_gate(inputs: Inputs) -> DataFrame:
    """Whether each gate lets the batch pass."""
    report = quality.quality_report(inputs.enriched()).collect()

    def lets_pass(gate: str) -> bool:
        try:
            quality.apply_gate(report, gate)
        except quality.QualityCheckError:
            return False
        return True

    rows = [
        F.struct(F.lit(gate).alias("gate"), F.lit(lets_pass(gate)).alias("lets_pass")) for gate in ("critical", "strict")
    ]
    return inputs.spark.range(1).select(F.inline(F.array(*rows)))


def _over_enriched(check: Callable[..., DataFrame], **options) -> Callable[[Inputs], DataFrame]:
    return lambda inputs: check(inputs.enriched(), **options)


def _over_cleaned(query: Callable[..., DataFrame], **literals) -> Callable[[Inputs], DataFrame]:
    return lambda inputs: query(inputs.cleaned(), **literals)


def _over_raw(query: Callable[..., DataFrame], **literals) -> Callable[[Inputs], DataFrame]:
    return lambda inputs: query(inputs.raw(), **literals)


PLANS: dict[str, Callable[[Inputs], DataFrame]] = {
    "s1_scan_parse": s1_scan_parse,
    "s2_typed_scan": s2_typed_scan,
    "s2_quoted_line_breaks": s2_quoted_line_breaks,
    "s3_source_with_fallback": s3_source_with_fallback,
    "s3_damaged_source": s3_damaged_source,
    "s4_parquet_hand_off": s4_parquet_hand_off,
    "s5_source_tables": s5_source_tables,
    "s5_compacted_tables": s5_compacted_tables,
    "k1_replace_raw": k1_replace_raw,
    "k2_append_raw": k2_append_raw,
    "k3_create_table_as": _strict_table("avg_price_per_category"),
    "k3_cleaned": _strict_table("cleaned"),
    "k3_avg_price_per_commodity_year": _strict_table("avg_price_per_commodity_year"),
    "k4_load_staging": k4_load_staging,
    "k6_full_reload": k6_full_reload,
    "k7_csv_cleaned": k7_csv_cleaned,
    "k7_csv_rows_with_nulls": k7_csv_rows_with_nulls,
    "k8_published_views": k8_published_views,
    "k9_flat_copy": k9_flat_copy,
    "c1_clean_strict": _over_raw(strict.clean_strict),
    "c2_clean_strict_typed": lambda i: strict.clean_strict_typed(prices.scan_named(i.spark, i.csv())),
    "c3_null_profile": _over_raw(strict.null_profile),
    "c3_rows_with_nulls": _over_raw(strict.rows_with_nulls),
    "c4_standardize_columns": _over_raw(enrich.standardize_columns),
    "c5_parse_dates": c5_parse_dates,
    "c6_handle_missing": c6_handle_missing,
    "c7_geo_fill": c7_geo_fill,
    "c7_geo_fill_moving": c7_geo_fill_moving,
    "c7_geo_fill_one_block": c7_geo_fill_one_block,
    "c8_standardize_names": c8_standardize_names,
    "c9_price_per_kg": c9_price_per_kg,
    "c10_clean": c10_clean,
    "q1_avg_price_per_commodity_year": _over_cleaned(strict_queries.avg_price_per_commodity_year),
    "q2_avg_price_per_category": _over_cleaned(strict_queries.avg_price_per_category),
    "q3_commodity_trend_by_year_type": _over_cleaned(
        strict_queries.commodity_trend_by_year_type, commodity=COMMODITY
    ),
    "q4_wholesale_vs_retail": _over_raw(strict_queries.wholesale_vs_retail, commodity=PATTERN),
    "q5_sharpest_increase": _over_raw(strict_queries.sharpest_increase, **YEARS),
    "q6_commodity_yearly_wholesale": _over_cleaned(
        strict_queries.commodity_yearly_wholesale, commodity=COMMODITY
    ),
    "q7_widely_tracked_commodities": _over_cleaned(strict_queries.widely_tracked_commodities, more_than=90),
    "q8_market_variety_top10": _over_cleaned(strict_queries.market_variety_top),
    "q9_agg_monthly_avg_price": _model("agg_monthly_avg_price"),
    "q10_agg_price_trends": _model("agg_price_trends"),
    "q11_agg_commodity_summary": _model("agg_commodity_summary"),
    "q12_panel_monthly_retail_trend": _over_star(
        star_queries.panel_monthly_retail_trend, "stg_cleaned_prices", commodity=PATTERN
    ),
    "q13_panel_top15_usd": _over_star(star_queries.panel_top_usd, "fact_prices", "dim_commodity"),
    "q14_panel_observations_by_county": _over_star(
        star_queries.panel_observations_by_county, "fact_prices", "dim_market"
    ),
    "q15_monthly_commodity_usd": _over_star(
        star_queries.monthly_commodity_usd, "fact_prices", "dim_commodity"
    ),
    "q16_monthly_top5_commodities": _over_star(star_queries.monthly_top_commodities, "stg_cleaned_prices"),
    "q17_high_water_mark": _over_star(star_queries.high_water_mark, "stg_cleaned_prices"),
    "u1_dim_date": lambda i: dimensions.date_dimension(_dated(i.enriched())),
    "u2_dim_commodity": u2_dim_commodity,
    "u3_dim_market": u3_dim_market,
    "u4_fact_prices": _over_star(lambda fact: fact.select(*FACTS), "fact_prices"),
    "u5_load_counts": lambda i: _table_counts(i.warehouse()),
    "u6_incremental_filter": _over_raw(pipeline.incremental_filter, mark=MARK),
    "u7_two_batches": u7_two_batches,
    "u8_surrogate_keys": u8_surrogate_keys,
    "j4_insert_if_absent": j4_insert_if_absent,
    "w4_first_row_per_key": w4_first_row_per_key,
    "d1_not_empty": _over_enriched(quality.check_not_empty),
    "d2_duplicate_keys": _over_enriched(quality.check_duplicate_keys),
    "d3_date_range": _over_enriched(quality.check_date_range),
    "d4_positive_prices": _over_enriched(quality.check_positive_prices),
    "d5_null_critical": _over_enriched(quality.check_null_critical),
    "d6_price_outliers": _over_enriched(quality.check_price_outliers),
    "d6_price_outliers_low_threshold": _over_enriched(quality.check_price_outliers, threshold=1.5),
    "d7_quality_report": _over_enriched(quality.quality_report),
    "d8_not_null": lambda i: constraints.not_null(models.tested_tables(i.warehouse()), models.NOT_NULL),
    "d9_unique": lambda i: constraints.unique(models.tested_tables(i.warehouse()), models.UNIQUE),
    "d10_referential": d10_referential,
    "d10_orphans_of_older_dimensions": d10_orphans_of_older_dimensions,
    "d11_column_constraints": _over_enriched(constraints.column_constraints, schema=schemas.STAGING),
    "d12_gate": d12_gate,
}


def _query(plan: Callable[[Inputs], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(plan(Inputs(spark, sf_dir)))


def queries() -> dict[str, Query]:
    """One entry per operator and query; each reads ``sf_dir`` or tables that Spark made of it."""
    found = {name: _query(plan) for name, plan in PLANS.items()}
    if llm_queries:
        found |= llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    """SQL over the same tables, for every key of ``queries()`` that SQL can express."""
    found = oracles()
    if llm_oracle:
        found |= llm_oracle.SQL
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
