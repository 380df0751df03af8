"""The same queries as ``__spark_entry__.queries()`` in SQL, to check results against.

Averages are integer arithmetic, rounded half up, so that they are exact here too.
"""

from __future__ import annotations

UNITS = "['KG','90 KG','50 KG','13 KG','64 KG','126 KG','400 G','200 G','L','500 ML','200 ML','Unit','Bunch','Head','Crate']"
# Tenths of a kilogram per unit.
UNIT_KG10 = (
    "CASE unit WHEN 'KG' THEN 10 WHEN '90 KG' THEN 900 WHEN '50 KG' THEN 500 WHEN '13 KG' THEN 130 "
    "WHEN '64 KG' THEN 640 WHEN '126 KG' THEN 1260 WHEN '400 G' THEN 4 WHEN '200 G' THEN 2 "
    "WHEN 'L' THEN 10 WHEN '500 ML' THEN 5 WHEN '200 ML' THEN 2 END"
)
RAW_COLUMNS = (
    "date", "admin1", "admin2", "market", "market_id", "latitude", "longitude", "category", "commodity",
    "commodity_id", "unit", "priceflag", "pricetype", "currency", "price", "usdprice",
)

# How each kind of column leaves a query.
_DATES = {"date", "date_id", "price_month", "time", "first_observed", "last_observed", "last_processed_date"}
_DOUBLES = {"latitude", "longitude", "price", "usdprice", "usd_price"}
_LONGS = {"market_id", "commodity_id", "year", "month", "quarter", "day_of_week"}


def out(*columns: str) -> str:
    done = []
    for c in columns:
        kind = "VARCHAR" if c in _DATES else "DOUBLE" if c in _DOUBLES else "BIGINT" if c in _LONGS else None
        if c in ("price_per_kg", "usd_price_per_kg"):
            done.append(f"CAST({c}4 AS DOUBLE) / 10000 AS {c}")
        else:
            done.append(f"CAST({c} AS {kind}) AS {c}" if kind else c)
    return ", ".join(done)


def avg(units: str, scale: int, digits: int) -> str:
    """Half-up average of integers that count 10**-scale, to ``digits`` places."""
    up, down = 10 ** max(digits - scale, 0), 10 ** max(scale - digits, 0)
    total = f"CAST(sum({units}) AS HUGEINT) * {2 * up}"
    n = f"count({units}) * {down}"
    return f"CAST(({total} + {n}) // (2 * {n}) AS DOUBLE) / {10**digits}"


def title(text: str) -> str:
    return (
        rf"array_to_string(list_transform(regexp_extract_all({text}, '\p{{L}}+|\P{{L}}+'), "
        "lambda x: upper(x[1]) || lower(x[2:])), '')"
    )


PARSED = "coalesce(try_strptime(date, '%Y-%m-%d'), try_strptime(date, '%d/%m/%Y'))::DATE"
CENTS = "CAST(price * 100 AS BIGINT)"
USD_CENTS = "CAST(usdprice * 100 AS BIGINT)"

CTES = {
    "obs": f"""
        SELECT CASE WHEN l_orderkey % 211 = 0 THEN 'n/a'
                    WHEN l_orderkey % 2 = 0 THEN strftime(l_shipdate, '%d/%m/%Y')
                    ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date,
               CASE WHEN s_suppkey % 47 <> 0 THEN r_name END AS admin1,
               CASE WHEN s_suppkey % 47 <> 0 THEN n_name END AS admin2,
               '  ' || s_name AS market, CAST(s_suppkey AS INT) AS market_id,
               CASE WHEN s_suppkey % 47 <> 0 AND l_linenumber <> 3 THEN CAST(n_nationkey - 5 AS DECIMAL(8,4)) END AS latitude,
               CASE WHEN s_suppkey % 47 <> 0 AND l_linenumber <> 3 THEN CAST(n_nationkey + 30 AS DECIMAL(8,4)) END AS longitude,
               p_type AS category,
               p_name || CASE WHEN p_size % 5 = 0 THEN ' (white)' ELSE '' END AS commodity,
               CAST(l_partkey AS INT) AS commodity_id, {UNITS}[p_size % 15 + 1] AS unit,
               CASE WHEN l_linenumber = 7 THEN 'actual,aggregate' WHEN l_linestatus = 'O' THEN 'actual'
                    ELSE 'aggregate' END AS priceflag,
               CASE WHEN l_returnflag = 'N' THEN 'Wholesale' ELSE 'Retail' END AS pricetype,
               ' kes' AS currency,
               CASE WHEN l_quantity <> 13 THEN CAST(l_extendedprice AS DECIMAL(8,2)) END AS price,
               CAST(l_quantity + l_tax AS DECIMAL(8,2)) AS usdprice
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
             JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "source": "SELECT * FROM obs UNION ALL SELECT * FROM obs WHERE commodity_id % 50 = 0",
    "raw": f"SELECT * REPLACE ({PARSED} AS date) FROM source",
    "cleaned": "SELECT DISTINCT * RENAME (admin1 AS region, admin2 AS county) FROM raw WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in RAW_COLUMNS),
    "filled": f"""
        SELECT {PARSED} AS date, coalesce(admin1, 'Unknown') AS region, coalesce(admin2, 'Unknown') AS county, market, market_id,
               coalesce(latitude, max(latitude) OVER (PARTITION BY market), 0) AS latitude,
               coalesce(longitude, max(longitude) OVER (PARTITION BY market), 0) AS longitude,
               category, commodity, commodity_id, unit, priceflag AS price_flag, pricetype AS price_type,
               currency, price, usdprice AS usd_price
        FROM source""",
    "enriched": f"""
        SELECT date, {title("region")} AS region, {title("county")} AS county, {title("trim(market)")} AS market,
               market_id, latitude, longitude, {title("category")} AS category, {title("commodity")} AS commodity,
               commodity_id, unit, price_flag, price_type, upper(trim(currency)) AS currency, price, usd_price,
               year(date) AS year, month(date) AS month,
               (CAST(price * 100 AS BIGINT) * 2000 + {UNIT_KG10}) // (2 * {UNIT_KG10}) AS price_per_kg4,
               (CAST(usd_price * 100 AS BIGINT) * 2000 + {UNIT_KG10}) // (2 * {UNIT_KG10}) AS usd_price_per_kg4
        FROM filled WHERE price IS NOT NULL AND usd_price IS NOT NULL""",
    "staging": "SELECT * FROM enriched WHERE date IS NOT NULL",
    "dim_date": """
        SELECT DISTINCT date AS date_id, year, month, monthname(date) AS month_name, quarter(date) AS quarter,
               isodow(date) - 1 AS day_of_week, isodow(date) >= 6 AS is_weekend FROM staging""",
    "dim_commodity": "SELECT DISTINCT commodity_id, commodity, category, unit FROM staging",
    "dim_market": "SELECT DISTINCT market_id, market, region, county, latitude, longitude FROM staging",
    "fact": """
        SELECT date AS date_id, commodity_id, market_id, price_type, price_flag, currency, price, usd_price,
               price_per_kg4, usd_price_per_kg4 FROM staging""",
}
_NEEDS = {
    "obs": [],
    "source": ["obs"],
    "raw": ["source"],
    "cleaned": ["raw"],
    "filled": ["source"],
    "enriched": ["filled"],
    "staging": ["enriched"],
    "dim_date": ["staging"],
    "dim_commodity": ["staging"],
    "dim_market": ["staging"],
    "fact": ["staging"],
}


def over(tables: str, query: str, **more: str) -> str:
    """``query`` with the named tables, and those they are made of, as common table expressions."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS[name]:
            add(need)
        if name not in order:
            order.append(name)

    for name in tables.split():
        add(name)
    parts = [f"{name} AS ({CTES[name]})" for name in order] + [f"{k} AS ({v})" for k, v in more.items()]
    return f"WITH {', '.join(parts)} {query}"


CLEANED_COLUMNS = tuple({"admin1": "region", "admin2": "county"}.get(c, c) for c in RAW_COLUMNS)
STANDARD_COLUMNS = tuple(
    {"priceflag": "price_flag", "pricetype": "price_type", "usdprice": "usd_price"}.get(c, c)
    for c in CLEANED_COLUMNS
)
STAGING_COLUMNS = (*STANDARD_COLUMNS, "year", "month", "price_per_kg", "usd_price_per_kg")
FACT_COLUMNS = (
    "date_id", "commodity_id", "market_id", "price_type", "price_flag", "currency", "price", "usd_price",
    "price_per_kg", "usd_price_per_kg",
)

YEARLY = f"""SELECT year(date) AS price_year, commodity, pricetype, count(*) AS num_observations,
    {avg(CENTS, 2, 2)} AS avg_price_kes, {avg(USD_CENTS, 2, 4)} AS avg_price_usd FROM cleaned"""
CATEGORY = f"""SELECT category, count(DISTINCT commodity) AS num_commodities, count(*) AS num_observations,
    {avg(CENTS, 2, 2)} AS avg_price_kes, {avg(USD_CENTS, 2, 4)} AS avg_price_usd,
    CAST(min(price) AS DOUBLE) AS min_price_kes, CAST(max(price) AS DOUBLE) AS max_price_kes
    FROM cleaned GROUP BY category"""
STG_CENTS, STG_USD_CENTS = CENTS, "CAST(usd_price * 100 AS BIGINT)"

MONTHLY = f"""SELECT d.year, d.month, date_trunc('month', f.date_id)::DATE AS price_month, county, commodity, category,
    count(*) AS observation_count, {avg(STG_CENTS, 2, 2)} AS avg_price_kes, {avg(STG_USD_CENTS, 2, 4)} AS avg_usd_price,
    {avg("price_per_kg4", 4, 2)} AS avg_price_per_kg, CAST(min(price) AS DOUBLE) AS min_price, CAST(max(price) AS DOUBLE) AS max_price
    FROM fact f JOIN dim_date d ON f.date_id = d.date_id JOIN dim_commodity USING (commodity_id)
    JOIN dim_market USING (market_id) GROUP BY 1, 2, 3, 4, 5, 6"""
TRENDS_YEARLY = f"""SELECT d.year, commodity, category, {avg(STG_USD_CENTS, 2, 4)} AS avg_usd_price,
    {avg("price_per_kg4", 4, 4)} AS avg_price_per_kg_kes, count(*) AS observations
    FROM fact f JOIN dim_date d ON f.date_id = d.date_id JOIN dim_commodity USING (commodity_id) GROUP BY 1, 2, 3"""
TRENDS_PREVIOUS = """SELECT *, lag(avg_usd_price) OVER (PARTITION BY commodity ORDER BY year, category) AS prev_year_usd_price,
    CAST(round(avg_usd_price * 10000) AS HUGEINT) AS a, CAST(round(lag(avg_usd_price) OVER (PARTITION BY commodity
    ORDER BY year, category) * 10000) AS HUGEINT) AS b FROM yearly"""
TRENDS = """SELECT year, commodity, category, avg_usd_price, avg_price_per_kg_kes, observations, prev_year_usd_price,
    sign(a - b) * CAST((2 * abs(a - b) * 10000 + b) // (2 * b) AS DOUBLE) / 100 AS yoy_change_pct FROM previous"""
SUMMARY = f"""SELECT commodity, category, unit, count(*) AS total_observations, {avg(STG_CENTS, 2, 2)} AS avg_price_kes,
    {avg(STG_USD_CENTS, 2, 4)} AS avg_usd_price, round(stddev_samp(CAST(usd_price AS DOUBLE)), 4) AS stddev_usd_price,
    CAST(min(usd_price) AS DOUBLE) AS min_usd_price, CAST(max(usd_price) AS DOUBLE) AS max_usd_price,
    CAST(min(date_id) AS VARCHAR) AS first_observed, CAST(max(date_id) AS VARCHAR) AS last_observed
    FROM fact JOIN dim_commodity USING (commodity_id) GROUP BY 1, 2, 3"""

COUNTS = """SELECT 'staging' AS table_name, count(*) AS rows FROM staging
    UNION ALL SELECT 'dim_date', count(*) FROM dim_date UNION ALL SELECT 'dim_commodity', count(*) FROM dim_commodity
    UNION ALL SELECT 'dim_market', count(*) FROM dim_market UNION ALL SELECT 'fact_prices', count(*) FROM fact
    UNION ALL SELECT 'rejected', (SELECT count(*) FROM enriched) - (SELECT count(*) FROM staging)"""


def check(name: str, metric: str, value: str, passed: str, source: str) -> str:
    return f"SELECT '{name}' AS \"check\", '{metric}' AS metric, CAST({value} AS VARCHAR) AS value, {passed} AS passed FROM {source}"


PROFILE = """SELECT count(*) AS n, min(date) AS lo, max(date) AS hi, count(*) FILTER (price <= 0) AS neg,
    count(*) FILTER (usd_price <= 0) AS neg_usd, count(*) FILTER (date IS NULL) AS no_date,
    count(*) FILTER (market IS NULL) AS no_market, count(*) FILTER (commodity IS NULL) AS no_commodity,
    count(*) FILTER (price IS NULL) AS no_price, count(*) FILTER (usd_price IS NULL) AS no_usd,
    avg(price_per_kg4 / 10000.0) AS mean, stddev_samp(price_per_kg4 / 10000.0) AS std FROM enriched"""
DUPLICATES = """SELECT coalesce(sum(n), 0)::BIGINT AS n FROM (SELECT count(*) AS n FROM enriched
    GROUP BY date, market_id, commodity_id, price_type) WHERE n > 1"""


def outliers(threshold: str) -> str:
    return f"""SELECT count(*) FILTER (abs(price_per_kg4 / 10000.0 - mean) / std > {threshold}) AS n, count(*) AS total
        FROM enriched, profile"""


_IN_RANGE = "lo >= DATE '2000-01-01' AND hi <= DATE '2030-12-31'"
_POSITIVE = "neg = 0 AND neg_usd = 0"
_COMPLETE = "no_date + no_market + no_commodity + no_price + no_usd = 0"
_FEW = "n < total * 0.01"
NULL_METRICS = {
    "date": "no_date", "market": "no_market", "commodity": "no_commodity", "price": "no_price", "usd_price": "no_usd"
}

NOT_EMPTY = check("not_empty", "rows", "n", "n > 0", "profile")
DATE_RANGE = " UNION ALL ".join(
    check("date_range", m, v, _IN_RANGE, "profile") for m, v in (("min_date", "lo"), ("max_date", "hi"))
)
POSITIVE = " UNION ALL ".join(
    check("positive_prices", m, v, _POSITIVE, "profile")
    for m, v in (("negative_prices", "neg"), ("negative_usd_prices", "neg_usd"))
)
NULL_CRITICAL = " UNION ALL ".join(
    check("null_critical", f"null_{c}", v, _COMPLETE, "profile") for c, v in NULL_METRICS.items()
)
DUPLICATE_KEYS = check("duplicate_keys", "duplicates", "n", "n = 0", "duplicates")
PRICE_OUTLIERS = check("price_outliers", "outliers", "n", _FEW, "outliers")
OVERALL = f"""(SELECT {_IN_RANGE} AND {_POSITIVE} AND {_COMPLETE} AND n > 0 FROM profile)
    AND (SELECT n = 0 FROM duplicates) AND (SELECT {_FEW} FROM outliers)"""
REPORT = f"""SELECT * FROM report_rows UNION ALL SELECT 'overall', 'passed', CAST(ok AS VARCHAR), ok FROM (SELECT {OVERALL} AS ok)"""

# The test with coordinates that differ inside a market: order of the lines, and the values.
LINE_ORDER = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)
MOVING_LATITUDE = "CASE WHEN l_linenumber NOT IN (1, 3) AND l_suppkey % 7 <> 0 THEN CAST(l_partkey % 90 AS DECIMAL(8,4)) END"


def moving_latitude(market: str) -> str:
    """The latitude filled in the order of the lines of a market."""
    return f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
        CAST(coalesce(last_value(latitude IGNORE NULLS) OVER before_or_at, first_value(latitude IGNORE NULLS) OVER anywhere, 0)
        AS DOUBLE) AS latitude FROM (SELECT *, 1 AS one_market, {MOVING_LATITUDE} AS latitude FROM lineitem)
        WINDOW before_or_at AS (PARTITION BY {market} ORDER BY {LINE_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        anywhere AS (PARTITION BY {market} ORDER BY {LINE_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""


def _not_null() -> str:
    models = {
        "monthly": ("agg_monthly_avg_price", ("price_month", "commodity", "avg_price_kes")),
        "trends": ("agg_price_trends", ("year", "commodity")),
        "summary": ("agg_commodity_summary", ("commodity",)),
        "fact": ("fact_prices", ("date_id", "commodity_id", "market_id")),
        "dim_date": ("dim_date", ("date_id",)),
        "dim_commodity": ("dim_commodity", ("commodity_id",)),
        "dim_market": ("dim_market", ("market_id",)),
    }
    rows = [
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS failures FROM {cte}"
        for cte, (name, columns) in models.items()
        for c in columns
    ]
    rows.append("SELECT 'fact_prices', 'fact_id', 0")
    return over(
        "fact dim_date dim_commodity dim_market",
        " UNION ALL ".join(rows),
        monthly=MONTHLY,
        yearly=TRENDS_YEARLY,
        trends="SELECT * FROM yearly",
        summary=SUMMARY,
    )


def _unique() -> str:
    rows = [
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) AS failures FROM (SELECT {c} FROM {cte} "
        f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
        for name, cte, c in (
            ("agg_commodity_summary", "summary", "commodity"),
            ("dim_date", "dim_date", "date_id"),
            ("dim_commodity", "dim_commodity", "commodity_id"),
            ("dim_market", "dim_market", "market_id"),
        )
    ]
    rows.append("SELECT 'fact_prices', 'fact_id', 0")
    return over("fact dim_date dim_commodity dim_market", " UNION ALL ".join(rows), summary=SUMMARY)


def _constraints() -> str:
    lengths = {
        "region": 80, "county": 80, "market": 120, "category": 80, "commodity": 120, "unit": 20, "price_flag": 30,
        "price_type": 20, "currency": 10,
    }
    numbers = {
        "market_id": 2**31, "commodity_id": 2**31, "latitude": 10**4, "longitude": 10**4, "price": 10**8,
        "usd_price": 10**8, "year": 2**31, "month": 2**31,
    }
    rows = ["SELECT 'date' AS column_name, 'not_null' AS rule, count(*) FILTER (date IS NULL) AS violations FROM enriched"]
    rows += [
        f"SELECT '{c}', 'max_length', count(*) FILTER (length({c}) > {n}) FROM enriched" for c, n in lengths.items()
    ]
    rows += [f"SELECT '{c}', 'fits_type', count(*) FILTER (abs({c}) >= {n}) FROM enriched" for c, n in numbers.items()]
    rows += [
        f"SELECT '{c}', 'fits_type', count(*) FILTER ({c}4 >= 1000000000000) FROM enriched"
        for c in ("price_per_kg", "usd_price_per_kg")
    ]
    return over("enriched", " UNION ALL ".join(rows))


def _sharpest() -> str:
    def cents(year: int) -> str:
        return f"CASE WHEN year(date) = {year} THEN {CENTS} END"

    sums = f"""SELECT commodity, CAST(sum({cents(1996)}) AS HUGEINT) AS s1, count({cents(1996)}) AS n1,
        CAST(sum({cents(2000)}) AS HUGEINT) AS s2, count({cents(2000)}) AS n2,
        {avg(cents(1996), 2, 2)} AS price_1996, {avg(cents(2000), 2, 2)} AS price_2000
        FROM raw WHERE year(date) IN (1996, 2000) AND commodity NOT LIKE 'red%' AND commodity NOT LIKE 'blue%'
        AND commodity NOT LIKE 'old bolt' GROUP BY commodity"""
    return over(
        "raw",
        """SELECT commodity, price_1996, price_2000, sign(num) * CAST((2 * abs(num) * 10000 + den) // (2 * den) AS DOUBLE) / 100
        AS percentage_increase FROM (SELECT *, s2 * n1 - s1 * n2 AS num, s1 * n2 AS den FROM sums WHERE s1 > 0)""",
        sums=sums,
    )


def oracles() -> dict[str, str]:
    every_staging = over("staging", f"SELECT {out(*STAGING_COLUMNS)} FROM staging")
    every_cleaned = over("cleaned", f"SELECT {out(*CLEANED_COLUMNS)} FROM cleaned")
    model_rows = over(
        "fact dim_date dim_commodity dim_market",
        """SELECT 'agg_monthly_avg_price' AS model, count(*) AS rows, CAST(sum(observation_count) AS BIGINT) AS observations FROM monthly
        UNION ALL SELECT 'agg_price_trends', count(*), CAST(sum(observations) AS BIGINT) FROM yearly
        UNION ALL SELECT 'agg_commodity_summary', count(*), CAST(sum(total_observations) AS BIGINT) FROM summary""",
        monthly=MONTHLY,
        yearly=TRENDS_YEARLY,
        summary=SUMMARY,
    )
    late = "staging2 AS (SELECT * FROM staging WHERE date >= DATE '1997-01-01')"
    two_batches = over("staging", "").strip() + f""", {late}
        SELECT 'staging' AS table_name, count(*) AS rows FROM staging2
        UNION ALL SELECT 'dim_date', count(DISTINCT date) FROM staging2
        UNION ALL SELECT 'dim_commodity', count(DISTINCT commodity_id) FROM staging2
        UNION ALL SELECT 'dim_market', count(DISTINCT market_id) FROM staging2
        UNION ALL SELECT 'fact_prices', count(*) FROM staging2"""
    return {
        "s1_scan_parse": over("raw", f"SELECT {out(*RAW_COLUMNS)} FROM raw"),
        "s2_typed_scan": over(
            "source",
            "SELECT CAST(try_strptime(date, '%Y-%m-%d')::DATE AS VARCHAR) AS date, "
            f"{out(*RAW_COLUMNS[1:])} FROM source",
        ),
        "s2_quoted_line_breaks": over(
            "raw", "SELECT priceflag, count(*) AS rows, CAST(count_if(commodity_id % 7 = 0) AS BIGINT) AS two_lines FROM raw GROUP BY priceflag"
        ),
        "s3_source_with_fallback": over("source", "SELECT priceflag, count(*) AS rows FROM source GROUP BY priceflag"),
        "s3_damaged_source": over("source", "SELECT priceflag, count(*) AS rows, CAST(1 AS BIGINT) AS failed_sources FROM source GROUP BY priceflag"),
        "s4_parquet_hand_off": over("raw", f"SELECT {out(*RAW_COLUMNS)} FROM raw"),
        "s5_source_tables": over(
            "staging dim_date dim_commodity dim_market fact",
            """SELECT 'stg_cleaned_prices' AS table_name, count(*) AS rows FROM staging
            UNION ALL SELECT 'dim_date', count(*) FROM dim_date UNION ALL SELECT 'dim_commodity', count(*) FROM dim_commodity
            UNION ALL SELECT 'dim_market', count(*) FROM dim_market UNION ALL SELECT 'fact_prices', count(*) FROM fact""",
        ),
        "s5_compacted_tables": over(
            "staging dim_date dim_commodity dim_market fact",
            """SELECT *, CAST(1 AS BIGINT) AS folders FROM (SELECT 'stg_cleaned_prices' AS table_name, count(*) AS rows FROM staging
            UNION ALL SELECT 'dim_date', count(*) FROM dim_date UNION ALL SELECT 'dim_commodity', count(*) FROM dim_commodity
            UNION ALL SELECT 'dim_market', count(*) FROM dim_market UNION ALL SELECT 'fact_prices', count(*) FROM fact)""",
        ),
        "k1_replace_raw": over("raw", "SELECT pricetype, count(*) AS rows FROM raw GROUP BY pricetype"),
        "k2_append_raw": over("raw", "SELECT pricetype, 2 * count(*) AS rows FROM raw GROUP BY pricetype"),
        "k3_create_table_as": over("cleaned", CATEGORY),
        "k3_cleaned": every_cleaned,
        "k3_avg_price_per_commodity_year": over("cleaned", f"{YEARLY} GROUP BY 1, 2, 3"),
        "k4_load_staging": every_staging,
        "k6_full_reload": over("enriched staging dim_date dim_commodity dim_market fact", COUNTS),
        "k7_csv_cleaned": every_cleaned,
        "k7_csv_rows_with_nulls": over(
            "raw",
            f"SELECT {out(*RAW_COLUMNS)} FROM raw WHERE " + " OR ".join(f"{c} IS NULL" for c in RAW_COLUMNS),
        ),
        "k8_published_views": model_rows,
        "k9_flat_copy": every_staging,
        "c1_clean_strict": every_cleaned,
        "c2_clean_strict_typed": over(
            "cleaned",
            f"SELECT {out(*CLEANED_COLUMNS)} FROM (SELECT * REPLACE (trim(market) AS market, trim(currency) AS currency) FROM cleaned)",
        ),
        "c3_null_profile": over(
            "raw",
            "SELECT column_name, nulls FROM (SELECT "
            + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in RAW_COLUMNS)
            + ", "
            + " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in RAW_COLUMNS)
            + " AS total FROM raw) UNPIVOT (nulls FOR column_name IN (*))",
        ),
        "c3_rows_with_nulls": over(
            "raw",
            f"SELECT {out(*RAW_COLUMNS)} FROM raw WHERE " + " OR ".join(f"{c} IS NULL" for c in RAW_COLUMNS),
        ),
        "c4_standardize_columns": over(
            "raw",
            f"""SELECT {out(*STANDARD_COLUMNS)} FROM (SELECT * RENAME (admin1 AS region, admin2 AS county,
            priceflag AS price_flag, pricetype AS price_type, usdprice AS usd_price) FROM raw)""",
        ),
        "c5_parse_dates": over(
            "raw",
            """SELECT year(date) AS year, month(date) AS month, count(*) AS rows, count(*) FILTER (date IS NULL) AS bad_dates
            FROM raw GROUP BY 1, 2""",
        ),
        "c6_handle_missing": over(
            "filled",
            f"""SELECT {out(*[c for c in STANDARD_COLUMNS if c != "date"])} FROM filled
            WHERE price IS NOT NULL AND usd_price IS NOT NULL""",
        ),
        "c7_geo_fill": over("filled", "SELECT market, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, count(*) AS rows FROM filled GROUP BY 1, 2, 3"),
        "c7_geo_fill_moving": moving_latitude("l_suppkey"),
        "c7_geo_fill_one_block": moving_latitude("one_market"),
        "c8_standardize_names": over(
            "source",
            f"""SELECT {title("admin1")} AS region, {title("admin2")} AS county, {title("trim(market)")} AS market,
            {title("category")} AS category, {title("commodity")} AS commodity, upper(trim(currency)) AS currency, count(*) AS rows
            FROM source GROUP BY ALL""",
        ),
        "c9_price_per_kg": over(
            "enriched",
            f"SELECT commodity_id, market_id, unit, {out('price', 'usd_price', 'price_per_kg', 'usd_price_per_kg')} FROM "
            "(SELECT * REPLACE (CAST(commodity_id AS BIGINT) AS commodity_id, CAST(market_id AS BIGINT) AS market_id) FROM enriched)",
        ),
        "c10_clean": over("enriched", f"SELECT {out(*STAGING_COLUMNS)} FROM enriched"),
        "q1_avg_price_per_commodity_year": over("cleaned", f"{YEARLY} GROUP BY 1, 2, 3"),
        "q2_avg_price_per_category": over("cleaned", CATEGORY),
        "q3_commodity_trend_by_year_type": over(
            "cleaned", f"{YEARLY} WHERE commodity LIKE 'red gear (white)' GROUP BY 1, 2, 3"
        ),
        "q4_wholesale_vs_retail": over(
            "raw",
            f"""SELECT year(date) AS observation_year,
            {avg(f"CASE WHEN lower(pricetype) = 'wholesale' THEN {CENTS} END", 2, 2)} AS avg_wholesale_price,
            {avg(f"CASE WHEN lower(pricetype) = 'retail' THEN {CENTS} END", 2, 2)} AS avg_retail_price
            FROM raw WHERE lower(commodity) LIKE '%gear%' GROUP BY 1""",
        ),
        "q5_sharpest_increase": _sharpest(),
        "q6_commodity_yearly_wholesale": over(
            "cleaned",
            f"""SELECT year(date) AS price_year, commodity, {avg(CENTS, 2, 2)} AS avg_yearly_price FROM cleaned
            WHERE commodity = 'red gear (white)' AND pricetype = 'Wholesale' GROUP BY 1, 2""",
        ),
        "q7_widely_tracked_commodities": over(
            "cleaned",
            """SELECT commodity, count(DISTINCT market) AS number_of_markets FROM cleaned GROUP BY commodity
            HAVING count(DISTINCT market) > 90""",
        ),
        "q8_market_variety_top10": over(
            "cleaned",
            """SELECT county, market, count(DISTINCT category) AS total_categories, count(DISTINCT commodity) AS unique_commodities_sold
            FROM cleaned GROUP BY county, market ORDER BY unique_commodities_sold DESC, county, market LIMIT 10""",
        ),
        "q9_agg_monthly_avg_price": over(
            "fact dim_date dim_commodity dim_market",
            "SELECT * REPLACE (CAST(price_month AS VARCHAR) AS price_month) FROM monthly",
            monthly=MONTHLY,
        ),
        "q10_agg_price_trends": over(
            "fact dim_date dim_commodity", TRENDS, yearly=TRENDS_YEARLY, previous=TRENDS_PREVIOUS
        ),
        "q11_agg_commodity_summary": over("fact dim_commodity", SUMMARY),
        "q12_panel_monthly_retail_trend": over(
            "staging",
            f"""SELECT CAST(date_trunc('month', date)::DATE AS VARCHAR) AS time, {avg(STG_CENTS, 2, 2)} AS "Avg Maize Price (KES)"
            FROM staging WHERE commodity ILIKE '%Gear%' AND price_type = 'Retail' GROUP BY 1""",
        ),
        "q13_panel_top15_usd": over(
            "fact dim_commodity",
            f"""SELECT commodity, {avg(STG_USD_CENTS, 2, 4)} AS "Avg USD Price" FROM fact JOIN dim_commodity USING (commodity_id)
            GROUP BY commodity ORDER BY "Avg USD Price" DESC, commodity LIMIT 15""",
        ),
        "q14_panel_observations_by_county": over(
            "fact dim_market",
            'SELECT county, count(*) AS "Observations" FROM fact JOIN dim_market USING (market_id) GROUP BY county',
        ),
        "q15_monthly_commodity_usd": over(
            "fact dim_commodity",
            f"""SELECT CAST(date_trunc('month', date_id)::DATE AS VARCHAR) AS price_month, commodity, {avg(STG_USD_CENTS, 2, 4)} AS avg_usd_price
            FROM fact JOIN dim_commodity USING (commodity_id) GROUP BY 1, 2""",
        ),
        "q16_monthly_top5_commodities": over(
            "staging",
            f"""SELECT price_month, commodity, avg_usd_price, price_rank FROM (SELECT *, rank() OVER (PARTITION BY price_month
            ORDER BY mean DESC) AS price_rank FROM averages) WHERE price_rank <= 5""",
            averages=f"""SELECT CAST(date_trunc('month', date)::DATE AS VARCHAR) AS price_month, commodity,
            {avg(STG_USD_CENTS, 2, 4)} AS avg_usd_price, CAST(sum({STG_USD_CENTS}) AS DOUBLE) / count(*) AS mean
            FROM staging GROUP BY 1, 2""",
        ),
        "q17_high_water_mark": over("staging", "SELECT CAST(max(date) AS VARCHAR) AS last_processed_date FROM staging"),
        "u1_dim_date": over(
            "dim_date", f"SELECT {out('date_id', 'year', 'month', 'month_name', 'quarter', 'day_of_week', 'is_weekend')} FROM dim_date"
        ),
        "u2_dim_commodity": over("dim_commodity", f"SELECT {out('commodity_id', 'commodity', 'category', 'unit')} FROM dim_commodity"),
        "u3_dim_market": over(
            "dim_market", f"SELECT {out('market_id', 'market', 'region', 'county', 'latitude', 'longitude')} FROM dim_market"
        ),
        "u4_fact_prices": over("fact", f"SELECT {out(*FACT_COLUMNS)} FROM fact"),
        "u5_load_counts": over("enriched staging dim_date dim_commodity dim_market fact", COUNTS),
        "u6_incremental_filter": over(
            "raw", f"SELECT {out(*RAW_COLUMNS)} FROM raw WHERE date > DATE '2000-12-31'"
        ),
        "u7_two_batches": two_batches,
        "u8_surrogate_keys": over(
            "staging",
            """SELECT 'stg_cleaned_prices' AS table_name, count(*) AS rows, count(*) AS keys, true AS positive FROM staging
            UNION ALL SELECT 'fact_prices', count(*), count(*), true FROM staging""",
        ),
        "j4_insert_if_absent": """SELECT l_suppkey, 'old' AS origin FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-02-01' GROUP BY l_suppkey
            UNION ALL SELECT l_suppkey, 'new' FROM lineitem WHERE l_suppkey NOT IN
            (SELECT l_suppkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-02-01') GROUP BY l_suppkey""",
        "w4_first_row_per_key": f"""SELECT l_partkey, l_returnflag, l_linestatus FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey
            ORDER BY CAST(l_shipdate AS DATE), {LINE_ORDER}) AS place FROM lineitem) WHERE place = 1""",
        "d1_not_empty": over("enriched", NOT_EMPTY, profile=PROFILE),
        "d2_duplicate_keys": over("enriched", DUPLICATE_KEYS, duplicates=DUPLICATES),
        "d3_date_range": over("enriched", DATE_RANGE, profile=PROFILE),
        "d4_positive_prices": over("enriched", POSITIVE, profile=PROFILE),
        "d5_null_critical": over("enriched", NULL_CRITICAL, profile=PROFILE),
        "d6_price_outliers": over("enriched", PRICE_OUTLIERS, profile=PROFILE, outliers=outliers("5.0")),
        "d6_price_outliers_low_threshold": over("enriched", PRICE_OUTLIERS, profile=PROFILE, outliers=outliers("1.5")),
        "d7_quality_report": over(
            "enriched",
            REPORT,
            profile=PROFILE,
            duplicates=DUPLICATES,
            outliers=outliers("5.0"),
            report_rows=" UNION ALL ".join([NOT_EMPTY, DUPLICATE_KEYS, DATE_RANGE, POSITIVE, NULL_CRITICAL, PRICE_OUTLIERS]),
        ),
        "d8_not_null": _not_null(),
        "d9_unique": _unique(),
        "d10_referential": over(
            "fact",
            """SELECT 'date_id' AS column_name, 0::BIGINT AS orphans UNION ALL SELECT 'commodity_id', 0 UNION ALL SELECT 'market_id', 0""",
        ),
        "d10_orphans_of_older_dimensions": """SELECT 'l_partkey' AS column_name, count(*) AS orphans FROM lineitem WHERE l_partkey NOT IN
            (SELECT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-02-01')
            UNION ALL SELECT 'l_suppkey', count(*) FROM lineitem WHERE l_suppkey NOT IN
            (SELECT l_suppkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-02-01')""",
        "d11_column_constraints": _constraints(),
        "d12_gate": over(
            "enriched",
            """SELECT 'critical' AS gate, n > 0 AS lets_pass FROM profile UNION ALL SELECT 'strict', ok FROM (SELECT
            """ + OVERALL + """ AS ok)""",
            profile=PROFILE,
            duplicates=DUPLICATES,
            outliers=outliers("5.0"),
        ),
    }
