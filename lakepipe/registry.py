"""Registered queries: each Spark query next to its DuckDB oracle SQL.

Every query reads the test tables (through the fixture adapters when a job
expects another input schema) and runs over the whole tables. The oracle is
written independently in SQL over the same parquet tables; column names are
aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from .plans.job import RunContext
from .sources.fixtures import adapters, with_adapters

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

# Fixed job time for reproducible results (jobs never read the clock inside a query).
AS_OF = datetime(2024, 1, 31, 6, 0, 0)
MONITORING_AS_OF = datetime(2024, 1, 30, 23, 58, 0)


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# --------------------------------------------------------------------- X1
_X1_ORACLE = with_adapters(["stock_quantities", "products", "product_prices"], """,
alive AS (SELECT product_id AS pid, created_at, total_qty AS bought, available_qty AS open_qty, total_qty * cost AS spent
          FROM stock_quantities WHERE deleted_at IS NULL AND total_qty > 0),
per_product AS (SELECT pid, MIN(created_at) AS since, SUM(spent) AS spent, SUM(bought) AS bought, SUM(open_qty) AS open_qty
                FROM alive GROUP BY pid HAVING SUM(open_qty) > 0),
-- cents of the average cost, rounded half up in whole numbers
costed AS (SELECT *, CAST(CAST((2 * CAST(spent * 10000 AS HUGEINT) + 100 * bought) // (200 * bought) AS DECIMAL(18,0))
                          * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(7,2)) AS each_cost FROM per_product)
SELECT CAST(20240131 AS BIGINT) AS date_id, CAST(pid AS BIGINT) AS product_id,
       CAST(products.warehouse_id AS SMALLINT) AS warehouse_id, CAST(products.system_id AS SMALLINT) AS entity_id,
       CAST(products.status_id AS SMALLINT) AS status_id, CAST(open_qty AS INTEGER) AS quantity,
       each_cost AS avg_unit_cost, CAST(ROUND(each_cost * open_qty, 2) AS DECIMAL(10,2)) AS total_cost,
       CAST(COALESCE(price.regular_price, 0) AS DECIMAL(7,2)) AS unit_price,
       CAST(COALESCE(ROUND(price.regular_price * open_qty, 2), 0) AS DECIMAL(10,2)) AS total_value,
       since AS stock_creation_date
FROM costed
JOIN products ON products.id = pid AND NOT products.status_id = 6
LEFT JOIN product_prices price ON price.product_id = pid AND price.entity_id = products.system_id""")


@register("inventory_snapshot", _X1_ORACLE)
def q_inventory_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 J1 A1–A3 F3 J2 P7–P10 M1 over lineitem/part adapters."""
    from .plans.inventory_snapshot import InventorySnapshot
    srcs = adapters(spark, sf_dir, ["stock_quantities", "products", "product_prices"])
    return InventorySnapshot(srcs).build(spark, ctx=RunContext(as_of=AS_OF))


# ------------------------------------------------------------ oracle helpers
# Python's str.strip() whitespace set, as literal characters for RE2 (DuckDB).
_PY_WS = ("[\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0  - "
          "    　]")


def _sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_PY_WS}+|{_PY_WS}+$', '', 'g')"


def _sql_clean(x: str) -> str:
    s = _sql_strip(x)
    return (f"CASE WHEN {s} IN ('None','NONE','nan','NaN','<NA>','null','NULL','') "
            f"THEN NULL ELSE {s} END")


# --------------------------------------------------------------------- X4
_X4_ORACLE = """
WITH b AS (
  SELECT LEAST((SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders),
               (SELECT MIN(CAST(l_shipdate AS DATE)) FROM lineitem)) AS lo,
         GREATEST((SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders),
                  (SELECT MAX(CAST(l_shipdate AS DATE)) FROM lineitem)) AS hi),
d AS (SELECT CAST(g.ts AS DATE) AS date
      FROM b, generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY) AS g(ts))
SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS id,
       date,
       CAST(day(date) AS INTEGER) AS day_num,
       strftime(date, '%A') AS week_day_name,
       CAST(isodow(date) AS INTEGER) AS week_day_num,
       CAST(month(date) AS INTEGER) AS month_num,
       strftime(date, '%B') AS month_name,
       CAST(day(date) = 1 AS INTEGER) AS is_month_start,
       CAST(date = last_day(date) AS INTEGER) AS is_month_end,
       CAST(quarter(date) AS INTEGER) AS quarter_num,
       CAST(year(date) AS INTEGER) AS year,
       CAST(weekofyear(date) AS INTEGER) AS week_num,
       CAST(epoch(CAST(date AS TIMESTAMP)) AS BIGINT) AS start_unix,
       CAST(epoch(CAST(date AS TIMESTAMP)) AS BIGINT) + 86399 AS end_unix
FROM d"""


@register("date_dimension", _X4_ORACLE)
def q_date_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 D2–D8 — calendar covering every day from the first order to the last shipment."""
    from .plans.date_dimension import DateDimension, DateDimensionParameters
    from .sources.calendar import data_date_bounds
    from .sources.tables import table
    lo, hi = data_date_bounds([(table(spark, sf_dir, "orders"), "o_orderdate"),
                               (table(spark, sf_dir, "lineitem"), "l_shipdate")])
    params = DateDimensionParameters(lo.isoformat(), hi.isoformat())
    return DateDimension().build(spark, params, RunContext(as_of=AS_OF))


# --------------------------------------------------------- T1 P1 P10 Q7 Q2
_DOC_SCHEMA_DEFAULTS = {"lang": "und", "source": "unknown"}


def _documents_schema():
    from pyspark.sql import types as T

    from .schema import ColumnSpec, OutputSchema
    return OutputSchema(
        "documents_clean",
        ColumnSpec("doc_id", T.LongType(), primary_key=True),
        ColumnSpec("text", T.StringType()),
        ColumnSpec("lang", T.StringType(), default="und", nullable=False),
        ColumnSpec("source", T.StringType(), default="unknown", nullable=False),
        ColumnSpec("n_chars", T.LongType(), default=0, min_value=0),
    )


_T1_ORACLE = f"""
SELECT doc_id,
       {_sql_clean('text')} AS text,
       COALESCE({_sql_clean('lang')}, 'und') AS lang,
       COALESCE({_sql_clean('source')}, 'unknown') AS source,
       COALESCE(n_chars, 0) AS n_chars
FROM documents"""


@register("clean_strings_defaults", _T1_ORACLE)
def q_clean_strings_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The output tail over whole documents (strip, sentinels → null, defaults)."""
    from .operators.tail import output_tail
    from .sources.tables import table
    return output_tail(table(spark, sf_dir, "documents"), _documents_schema())


_Q7_ORACLE = f"""
WITH c AS ({_T1_ORACLE})
SELECT column_name, position, null_count, non_null FROM (
  SELECT 'doc_id' AS column_name, 0 AS position, COUNT(*) - COUNT(doc_id) AS null_count, COUNT(doc_id) AS non_null FROM c
  UNION ALL SELECT 'text', 1, COUNT(*) - COUNT(text), COUNT(text) FROM c
  UNION ALL SELECT 'lang', 2, COUNT(*) - COUNT(lang), COUNT(lang) FROM c
  UNION ALL SELECT 'source', 3, COUNT(*) - COUNT(source), COUNT(source) FROM c
  UNION ALL SELECT 'n_chars', 4, COUNT(*) - COUNT(n_chars), COUNT(n_chars) FROM c)"""


@register("null_profile", _Q7_ORACLE)
def q_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2/Q7: per column null and non-null counts of the cleaned documents, one pass."""
    from .operators.quality import null_counts
    return null_counts(q_clean_strings_defaults(spark, sf_dir))


# ---------------------------------------------------------------------- T2
# Query parameters: two dictionaries; "small" is redefined by the second one
# (later wins), "blue" is replaced by another key ("red") which must not be
# replaced again (single pass).
ABBREVIATIONS = [{"small": "sm", "blue": "red", "ring": "rg"},
                 {"red": "r", "widget": "wdg", "small": "S"}]

_T2_ORACLE = """
SELECT p_partkey, p_name,
       trim(array_to_string(list_transform(string_split(COALESCE(p_name, ''), ' '),
            lambda w: CASE w WHEN 'small' THEN 'S' WHEN 'blue' THEN 'red' WHEN 'ring' THEN 'rg'
                        WHEN 'red' THEN 'r' WHEN 'widget' THEN 'wdg' ELSE w END), ' ')) AS p_name_short
FROM part"""


@register("abbreviate", _T2_ORACLE)
def q_abbreviate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-word, single-pass abbreviation of part names."""
    from .functions.text import abbreviate
    from .sources.tables import table
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", "p_name",
                       abbreviate("p_name", ABBREVIATIONS).alias("p_name_short"))


_T2_TABLE_ORACLE = """
SELECT p_partkey, p_name, array_to_string(list_transform(string_split(p_name, ' '), lambda w: CASE
         WHEN regexp_matches(w, '^[a-zA-Z0-9_]{5,}$') THEN left(w, 3) ELSE w END), ' ') AS p_name_short
FROM part"""


@register("abbreviate_table", _T2_TABLE_ORACLE)
def q_abbreviate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names abbreviated by a dictionary table of their own: every word of five characters or more, and its first three."""
    from pyspark.sql import functions as F

    from .operators.abbreviations import abbreviate_with
    from .sources.tables import table
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    words = part.select(F.explode(F.split("p_name", " ")).alias("entry")).where(F.col("entry").rlike("^[a-zA-Z0-9_]{5,}$"))
    entries = words.distinct().select("entry", F.left("entry", F.lit(3)).alias("short"), F.xxhash64("entry").alias("rank"))
    return abbreviate_with(part, "p_name", entries, "p_name_short")


# ---------------------------------------------------------------------- T3
def _sql_titlecase(x: str) -> str:
    cleaned = (f"regexp_replace({_sql_strip(f'COALESCE({x}, {chr(39)}{chr(39)})')}, "
               "'[^a-zA-ZÀ-ÖØ-öø-ÿ0-9\\-''./ ]+', '', 'g')")
    part = ("CASE WHEN length(p) > 1 AND upper(p) = p AND lower(p) <> p THEN p "
            "ELSE (CASE WHEN substr(p, 1, 1) = 'ß' THEN 'Ss' ELSE upper(substr(p, 1, 1)) END) "
            "|| lower(substr(p, 2)) END")
    word = f"array_to_string(list_transform(string_split(w, '-'), lambda p: {part}), '-')"
    return (f"array_to_string(list_transform(list_filter(string_split_regex({cleaned}, ' +'), "
            f"lambda w: w <> ''), lambda w: {word}), ' ')")


_T3_ORACLE = f"""
SELECT doc_id, {_sql_titlecase('text')} AS title_text FROM documents"""


@register("titlecase", _T3_ORACLE)
def q_titlecase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean and title-case whole document texts."""
    from .functions.text import clean_titlecase
    from .sources.tables import table
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", clean_titlecase("text").alias("title_text"))


# ---------------------------------------------------------------------- T4
_T4_ORACLE = with_adapters(["postal_inputs"], """,
c AS (SELECT *, upper(regexp_replace(postal_code, '[^0-9A-Za-z]', '', 'g')) AS kept FROM postal_inputs),
-- how many digits a code has, for the countries whose codes are digits only
d AS (SELECT * FROM (VALUES (3, 'IS'), (4, 'DK AT BE CH NO LU HU AU NZ PH'),
                            (5, 'FR DE ES FI EE SE CZ PL IT MX ZA MY TH KR'), (6, 'SG'), (7, 'PT JP')) AS t(n, names)),
f AS (SELECT n, UNNEST(string_split(names, ' ')) AS country FROM d),
v AS (SELECT c.*, CASE
        WHEN f.n IS NOT NULL THEN length(kept) = f.n AND translate(kept, '0123456789', '') = ''
        WHEN country_code = 'US' THEN length(kept) IN (5, 9) AND translate(kept, '0123456789', '') = ''
        WHEN country_code = 'CA' THEN regexp_full_match(kept, '([A-Z][0-9]){3}')
        WHEN country_code = 'NL' THEN regexp_full_match(kept, '[0-9]{4}[A-Z][A-Z]')
        WHEN country_code = 'IE' THEN length(kept) = 7
        WHEN country_code IN ('GG', 'JE', 'IM')
          THEN regexp_full_match(kept, CASE country_code WHEN 'GG' THEN 'GY' ELSE country_code END || '[0-9][0-9]?[A-Z][A-Z]')
        WHEN country_code = 'GB' THEN kept = 'GIR0AA' OR regexp_full_match(kept, '[A-Z][A-Z]?[0-9][0-9]?[A-Z]?[0-9][A-Z][A-Z]')
        ELSE TRUE END AS fits
      FROM c LEFT JOIN f ON f.country = country_code)
SELECT c_custkey, country_code, postal_code, CASE WHEN fits THEN kept END AS postal_code_clean FROM v""")


@register("postal_codes", _T4_ORACLE)
def q_postal_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: clean customer postal codes and null the invalid ones per country pattern."""
    from .functions.postal import clean_postal_code
    from .sources.fixtures import adapter
    src = adapter(spark, sf_dir, "postal_inputs")
    return src.select("c_custkey", "country_code", "postal_code",
                      clean_postal_code("postal_code", "country_code").alias("postal_code_clean"))


# ---------------------------------------------------------------------- T5
_T5_ORACLE = """
WITH p AS (
  SELECT l_orderkey, l_linenumber,
         o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)) AS start_ts,
         l_shipdate + to_minutes(CAST(l_linenumber * 97 % 1440 AS BIGINT)) AS end_ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
q AS (
  SELECT *, CAST(start_ts AS DATE) AS ds, CAST(end_ts AS DATE) AS de FROM p)
SELECT l_orderkey, l_linenumber, start_ts, end_ts,
  CASE
    WHEN start_ts IS NULL OR end_ts IS NULL THEN NULL
    WHEN start_ts > end_ts THEN 0
    WHEN ds = de THEN CASE WHEN isodow(ds) <= 5
                           THEN (epoch_us(end_ts) - epoch_us(start_ts)) // 60000000 ELSE 0 END
    ELSE ((CASE WHEN isodow(ds) <= 5
                THEN epoch_us(CAST(ds + 1 AS TIMESTAMP)) - epoch_us(start_ts) ELSE 0 END)
        + (CASE WHEN isodow(de) <= 5
                THEN epoch_us(end_ts) - epoch_us(CAST(de AS TIMESTAMP)) ELSE 0 END)) // 60000000
       + 1440 * len(list_filter(range(CAST(ds + 1 AS TIMESTAMP), CAST(de AS TIMESTAMP), INTERVAL 1 DAY),
                                lambda x: isodow(x) <= 5))
  END AS working_minutes
FROM q"""


@register("working_minutes", _T5_ORACLE)
def q_working_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: working minutes from order time to ship time for every line item (UTC)."""
    from pyspark.sql import functions as F

    from .functions.worktime import working_minutes
    from .sources.tables import table
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    pairs = li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_linenumber",
        F.timestamp_add("MINUTE", F.col("o_orderkey") % 1440, F.col("o_orderdate")).alias("start_ts"),
        F.timestamp_add("MINUTE", (F.col("l_linenumber") * 97) % 1440, F.col("l_shipdate")).alias("end_ts"))
    return pairs.withColumn("working_minutes", working_minutes("start_ts", "end_ts", "UTC"))


# --------------------------------------------------------------------- X3
# The registered run covers the whole date span of the tables.
KPI_WINDOW = ("1992-01-01", "2030-12-31")

_X3_GROUPS = f"""
s AS (SELECT CAST(order_date AS DATE) AS time, region_type, region, country,
             SUM(net_subtotal) AS net_subtotal, COUNT(DISTINCT order_id) AS sales_orders
      FROM customer_sales
      WHERE CAST(order_date AS DATE) BETWEEN DATE '{KPI_WINDOW[0]}' AND DATE '{KPI_WINDOW[1]}'
      GROUP BY 1, 2, 3, 4),
p AS (SELECT CAST(order_date AS DATE) AS time, region_type, region, country,
             SUM(total) AS total, COUNT(DISTINCT po_id) AS purchase_orders
      FROM customer_purchases
      WHERE CAST(order_date AS DATE) BETWEEN DATE '{KPI_WINDOW[0]}' AND DATE '{KPI_WINDOW[1]}'
      GROUP BY 1, 2, 3, 4),
m AS (SELECT COALESCE(s.time, p.time) AS time, COALESCE(s.region_type, p.region_type) AS region_type,
             COALESCE(s.region, p.region) AS region, COALESCE(s.country, p.country) AS country,
             s.net_subtotal, s.sales_orders, p.total, p.purchase_orders
      FROM s FULL OUTER JOIN p
        ON s.time IS NOT DISTINCT FROM p.time AND s.region_type IS NOT DISTINCT FROM p.region_type
       AND s.region IS NOT DISTINCT FROM p.region AND s.country IS NOT DISTINCT FROM p.country)"""

_X3_ORACLE = with_adapters(["customer_sales", "customer_purchases"], f""",{_X3_GROUPS},
u AS (SELECT time, region_type, region, country, k.kpi_name, k.value
      FROM m, (VALUES ('net_subtotal', CAST(m.net_subtotal AS DECIMAL(18,2))),
                      ('sales_orders', CAST(m.sales_orders AS DECIMAL(18,2))),
                      ('total', CAST(m.total AS DECIMAL(18,2))),
                      ('purchase_orders', CAST(m.purchase_orders AS DECIMAL(18,2)))) AS k(kpi_name, value))
SELECT time, COALESCE(region_type, 'N/A') AS region_type, COALESCE(region, 'N/A') AS region,
       COALESCE(country, 'N/A') AS country, kpi_name, CAST(ROUND(value, 2) AS DECIMAL(18,2)) AS value
FROM u WHERE value IS NOT NULL AND value <> 0""")


@register("kpi_export", _X3_ORACLE)
def q_kpi_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 → per-group KPIs (null labels → N/A) → full outer merge on the group keys
    → unpivot (R1) → M1 → F4."""
    from .plans.kpi_export import KpiExport, KpiExportParameters
    srcs = adapters(spark, sf_dir, ["customer_sales", "customer_purchases"])
    return KpiExport(srcs).build(spark, KpiExportParameters(*KPI_WINDOW), RunContext(as_of=AS_OF))


_X3_LAST_WEEK = "(SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders)"
_X3_JOB_ORACLE = (_X3_ORACLE.replace(f"DATE '{KPI_WINDOW[0]}'", f"{_X3_LAST_WEEK} - 7")
                  .replace(f"DATE '{KPI_WINDOW[1]}'", _X3_LAST_WEEK)
                  .replace("SELECT time, COALESCE(region_type", "SELECT d.delivery, time, COALESCE(region_type")
                  .replace("FROM u WHERE value", "FROM u, (VALUES ('csv'), ('csv.gz'), ('debug'), ('hook')) AS d(delivery) WHERE value"))


@register("kpi_export_job", _X3_JOB_ORACLE)
def q_kpi_export_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The KPI job run for the last week of the orders (its default window), its two
    deliveries, its debug file, and what a subclass with a write hook of its own delivers, all read back."""
    from dataclasses import replace

    from pyspark.sql import functions as F

    from .plans.kpi_export import SCHEMA, KpiExport
    from .session import shared_dir
    from .sinks.export import debug_path
    from .sources.tables import table
    last = table(spark, sf_dir, "orders").agg(F.max(F.to_date("o_orderdate")).alias("d")).first()["d"]
    root = shared_dir(spark, "exports")
    ctx = RunContext(as_of=datetime(last.year, last.month, last.day), export_root=root)
    srcs = adapters(spark, sf_dir, ["customer_sales", "customer_purchases"])

    class ToParquet(KpiExport):
        def write(self, spark, output, dest, ctx):
            output.write.parquet(f"{root}/hook")
            return []

    KpiExport(srcs).run(spark, ctx=ctx)
    debug = shared_dir(spark, "debug")
    KpiExport(srcs).run(spark, ctx=replace(ctx, debug=True, debug_root=debug))
    ToParquet(srcs).run(spark, ctx=ctx)
    name = f"{root}/year={last:%Y}/month={last:%m}/kpi_{last:%Y-%m-%d}.csv"
    schema = ", ".join(f"{c.name} {c.dtype.simpleString()}" for c in SCHEMA.columns)
    read = spark.read.schema(schema).option("header", True)
    found = [("csv", read.csv(name)), ("csv.gz", read.csv(f"{name}.gz")),
             ("debug", read.csv(debug_path(debug, KpiExport(srcs).job_name))), ("hook", spark.read.parquet(f"{root}/hook"))]
    rows = [df.select(F.lit(d).alias("delivery"), *SCHEMA.names) for d, df in found]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


_J3_ORACLE = with_adapters(["customer_sales", "customer_purchases"], """,
s AS (SELECT CAST(order_date AS DATE) AS time, region_type, region, country,
             COUNT(*) AS n_rows, SUM(net_subtotal) AS amount, MAX(entity_id) AS entity_id
      FROM customer_sales GROUP BY 1, 2, 3, 4),
p AS (SELECT CAST(order_date AS DATE) AS time, region_type, region, country,
             COUNT(*) AS n_rows, SUM(total) AS amount, MAX(customer_type) AS customer_type
      FROM customer_purchases GROUP BY 1, 2, 3, 4),
m AS (SELECT COALESCE(s.time, p.time) AS time, COALESCE(s.region_type, p.region_type) AS region_type,
             COALESCE(s.region, p.region) AS region, COALESCE(s.country, p.country) AS country,
             s.n_rows AS n_rows_x, s.amount AS amount_x, s.entity_id,
             p.n_rows AS n_rows_y, p.amount AS amount_y, p.customer_type
      FROM s FULL OUTER JOIN p
        ON s.time IS NOT DISTINCT FROM p.time AND s.region_type IS NOT DISTINCT FROM p.region_type
       AND s.region IS NOT DISTINCT FROM p.region AND s.country IS NOT DISTINCT FROM p.country)
SELECT time, region_type, region, country, k.variable, k.value
FROM m, (VALUES ('n_rows_x', CAST(m.n_rows_x AS VARCHAR)), ('amount_x', CAST(m.amount_x AS VARCHAR)),
                ('entity_id', CAST(m.entity_id AS VARCHAR)), ('n_rows_y', CAST(m.n_rows_y AS VARCHAR)),
                ('amount_y', CAST(m.amount_y AS VARCHAR)),
                ('customer_type', CAST(m.customer_type AS VARCHAR))) AS k(variable, value)""")


@register("outer_merge_unpivot", _J3_ORACLE)
def q_outer_merge_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 + R1 as operators: null-safe full outer merge with ``_x``/``_y`` suffixes
    on overlapping columns (null regions match), then every non-key column
    unpivoted with values as text. Inputs are one row per group on each side."""
    from pyspark.sql import functions as F

    from .operators.merge import merge
    from .operators.reshape import unpivot
    a = adapters(spark, sf_dir, ["customer_sales", "customer_purchases"])
    keys = ["time", "region_type", "region", "country"]
    s = (a["customer_sales"].withColumn("time", F.to_date("order_date")).groupBy(*keys)
         .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("net_subtotal").alias("amount"),
              F.max("entity_id").alias("entity_id")))
    p = (a["customer_purchases"].withColumn("time", F.to_date("order_date")).groupBy(*keys)
         .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total").alias("amount"),
              F.max("customer_type").alias("customer_type")))
    return unpivot(merge(s, p, keys, "outer"), keys, value_type="string")


# --------------------------------------------------------------------- X2
_X2_DIMS = ["fact_inventory_current", "dim_warehouse", "dim_product_status", "dim_product_type",
            "dim_entity", "dim_product", "dim_model", "dim_brand", "dim_dexterity",
            "dim_standard_flex", "dim_standard_loft", "dim_shaft_material",
            "dim_product_condition", "dim_purchase_channel"]

_X2_ORACLE = with_adapters(_X2_DIMS, """,
attributes AS (
  SELECT id AS pid, condition_id, club_count, loft_degree, length AS club_length, length_difference,
         (SELECT name FROM dim_dexterity WHERE id = p.dexterity_id) AS dexterity,
         (SELECT name FROM dim_standard_flex WHERE id = p.standard_flex_id) AS flex,
         (SELECT name FROM dim_standard_loft WHERE id = p.standard_loft_id) AS loft,
         (SELECT name FROM dim_shaft_material WHERE id = p.shaft_material_id) AS shaft,
         (SELECT name FROM dim_product_condition WHERE id = p.condition_id) AS state
  FROM dim_product p),
models AS (SELECT id AS mid, name AS model, (SELECT name FROM dim_brand WHERE id = m.brand_id) AS brand FROM dim_model m),
stock AS (
  SELECT *, ROUND(cost * fx_rate, 2) AS landed,
         (SELECT code FROM dim_entity WHERE id = entity_id) AS entity,
         (SELECT name FROM dim_purchase_channel WHERE id = channel_id) AS channel
  FROM fact_inventory_current),
-- the margin in hundredths of a percent, rounded half away from zero in whole numbers
priced AS (SELECT *, CAST(final_resale_price * 100 AS HUGEINT) AS ask,
                  CAST(final_resale_price * 100 AS HUGEINT) - CAST(landed * 100 AS HUGEINT) AS gain FROM stock)
SELECT entity AS "Entity", stock_id AS "Stock ID", product_id AS "Product ID",
       purchase_order_id AS "PO ID", purchase_order_item_id AS "PO Item ID",
       place.code AS "Warehouse", place.country_code AS "Country", location_name AS "Location",
       status.name AS "Status", kind.name AS "Type", IF(kind.is_golf_club, 'No', 'Yes') AS "Is Accessory",
       channel AS "Purchase Channel", stock_creation_date AS "Stock Creation",
       product_creation_date AS "Product Creation", product_change_date AS "Product Update",
       last_verification_date AS "Last Verification", sku AS "SKU", IFNULL(brand, 'N/A') AS "Brand",
       model_id AS "Model ID", IFNULL(model, 'N/A') AS "Model", IFNULL(dexterity, 'N/A') AS "Dexterity",
       IFNULL(state, 'N/A') AS "Condition",
       CASE IFNULL(condition_id, 0) WHEN 0 THEN 'N/A' WHEN 1 THEN 'New' ELSE 'Used' END AS "Condition Category",
       IFNULL(shaft, 'N/A') AS "Shaft Material", IFNULL(flex, 'N/A') AS "Flex", IFNULL(loft, 'N/A') AS "Loft",
       IFNULL(club_count, 1) AS "Pieces", loft_degree AS "Loft Degree", club_length AS "Length",
       length_difference AS "Length Difference", IF(is_available_for_sale, 'Yes', 'No') AS "Is Available for Sale",
       IF(is_vat_margin_scheme_eligible, 'Yes', 'No') AS "Is VAT Margin Schema Eligible",
       currency AS "Original Currency", total_qty AS "Total Quantity", available_qty AS "Available Quantity",
       sold_qty AS "Sold Quantity", paid_qty AS "Paid Quantity", landed AS "Cost",
       CASE WHEN expected_resale_price <> 0 THEN ROUND(fx_rate * expected_resale_price, 2) END AS "Expected Resale Price",
       regular_resale_price AS "Regular Resale Price", final_resale_price AS "Final Resale Price",
       CASE WHEN LEAST(cost, final_resale_price, fx_rate) > 0
            THEN CAST(sign(gain) * ((2 * abs(gain) * 10000 + ask) // (2 * ask)) AS DECIMAL(18,0))
                 * CAST(0.0001 AS DECIMAL(5,4)) END AS "Expected Resale Margin"
FROM priced
JOIN dim_product_type kind ON kind.id = product_type_id
JOIN dim_product_status status ON status.id = product_status_id
JOIN dim_warehouse place ON place.id = warehouse_id
LEFT JOIN models ON mid = model_id
LEFT JOIN attributes ON pid = product_id""")


@register("inventory_export", _X2_ORACLE)
def q_inventory_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """14-table star/snowflake join (J4–J6) with P2–P6 derived columns, 42 columns."""
    from .plans.inventory_export import InventoryExport
    srcs = adapters(spark, sf_dir, _X2_DIMS)
    return InventoryExport(srcs).build(spark, ctx=RunContext(as_of=AS_OF))


# --------------------------------------------------------------------- X5
_X5_ORACLE = with_adapters(["run_log"], f""",
clock AS (SELECT TIMESTAMP '{MONITORING_AS_OF:%Y-%m-%d %H:%M:%S}' AS now),
begun AS (SELECT uuid, MIN(created_at) AS began, COUNT(*) - 1 AS again FROM run_log WHERE status_id = 0 GROUP BY uuid),
ended AS (SELECT uuid, MAX(created_at) AS finished, MAX(duration) AS secs, MAX(extracted_rows) AS n_in, MAX(loaded_rows) AS n_out,
                 MAX(dataframes_memory) AS mb, MIN(status_id) AS best FROM run_log WHERE status_id <> 0 GROUP BY uuid),
told AS (SELECT uuid, bool_or(manual_trigger) AS by_hand,
                list_sort(list_distinct(list(split_part(pipe_name, '.', -1)))) AS jobs,
                list_sort(list_distinct(list(error) FILTER (WHERE error IS NOT NULL))) AS errors
         FROM run_log GROUP BY uuid)
SELECT ROW_NUMBER() OVER (ORDER BY began, uuid) AS "ID", array_to_string(jobs, ',') AS "Pipe name",
       again AS "Retry", by_hand AS "Manual trigger", began AS "Starting date", finished AS "Ending date",
       CASE WHEN secs IS NOT NULL
            THEN format('{{:02d}}:{{:02d}}:{{:02d}}', secs // 3600, secs // 60 % 60, secs % 60) END AS "Duration",
       CASE best WHEN 1 THEN 'Success' WHEN 2 THEN 'Error'
                 ELSE IF(began + INTERVAL 45 MINUTE < now, 'Timed out', 'Running') END AS "Status",
       n_in AS "Extracted rows", n_out AS "Loaded rows", mb AS "Memory used",
       IF(len(errors) > 0, array_to_string(errors, ','), NULL) AS "Error message"
FROM begun JOIN told USING (uuid) LEFT JOIN ended USING (uuid), clock
WHERE began >= date_trunc('day', now) - INTERVAL 1 DAY
ORDER BY began DESC""")


@register("run_monitoring", _X5_ORACLE)
def q_run_monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-run roll-up of the run log (A4–A7 D9 D10 T6 F5), distributed row number (W1), newest first (O1)."""
    from .plans.monitoring import monitoring_report
    from .sources.fixtures import adapter
    return monitoring_report(adapter(spark, sf_dir, "run_log"), MONITORING_AS_OF)


@register("run_report_stream", ORACLES["run_monitoring"])
def q_run_report_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report from run summaries kept as streaming state, over the log's files in several batches."""
    from pyspark.sql import functions as F

    from .plans.runlog import RUN_LOG_SCHEMA
    from .session import shared_dir
    from .sources.fixtures import adapter
    from .streaming.run_report import current_summaries, report_from, run_summaries_stream
    base = shared_dir(spark, "run_report")
    log = adapter(spark, sf_dir, "run_log")
    records = log.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RUN_LOG_SCHEMA.fields])
    records.repartition(3, "created_at").write.parquet(f"{base}/log")
    run_summaries_stream(spark, f"{base}/log", f"{base}/out", max_files_per_trigger=1).awaitTermination()
    report = report_from(current_summaries(spark, f"{base}/out"), MONITORING_AS_OF)
    return report.select(*[F.col(c).cast("int").alias(c) if c in ("Extracted rows", "Loaded rows", "Memory used") else c
                           for c in report.columns])


# ------------------------------------------------------------ X7 JSON rows
_JSON_ZIP_ORACLE = with_adapters(["json_docs"], """,
p AS (SELECT CAST(json_extract(doc, '$.id') AS BIGINT) AS id,
             json_extract_string(doc, '$.kind') AS kind,
             CAST(json_extract(doc, '$.user.id') AS BIGINT) AS "user.id",
             CAST(json_extract(doc, '$.user.flag.odd') AS BOOLEAN) AS "user.flag.odd",
             CAST(json_extract(doc, '$.tags') AS VARCHAR[]) AS tags,
             CAST(json_extract(doc, '$.scores') AS BIGINT[]) AS scores
      FROM json_docs),
z AS (SELECT id, kind, "user.id", "user.flag.odd", UNNEST(tags) AS tags, UNNEST(scores) AS scores FROM p)
SELECT DISTINCT * FROM z""")


@register("json_zip", _JSON_ZIP_ORACLE)
def q_json_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects with two equal-length lists → positional zip, nested
    objects flattened to dotted columns, duplicates removed."""
    from .sources.fixtures import adapter
    from .sources.json_docs import json_rows
    return json_rows(adapter(spark, sf_dir, "json_docs"), "doc")


_JSON_EXPLODE_ORACLE = with_adapters(["json_tag_docs"], """,
p AS (SELECT CAST(json_extract(doc, '$.id') AS BIGINT) AS id,
             json_extract_string(doc, '$.kind') AS kind,
             CAST(json_extract(doc, '$.tags') AS VARCHAR[]) AS tags
      FROM json_tag_docs)
SELECT DISTINCT id, kind, UNNEST(tags) AS tags FROM p""")


@register("json_explode", _JSON_EXPLODE_ORACLE)
def q_json_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects with one list field → one row per element (empty list → no row)."""
    from .sources.fixtures import adapter
    from .sources.json_docs import json_rows
    return json_rows(adapter(spark, sf_dir, "json_tag_docs"), "doc")


_JSON_LIST_ORACLE = with_adapters(["json_list_docs"], """,
m AS (SELECT UNNEST(CAST(json_extract(doc, '$') AS JSON[])) AS e FROM json_list_docs)
SELECT DISTINCT
       CASE WHEN json_type(e) = 'OBJECT' THEN CAST(json_extract(e, '$.k') AS BIGINT) END AS k,
       CASE WHEN json_type(e) <> 'OBJECT' THEN CAST(e AS BIGINT) END AS value
FROM m""")


@register("json_list_rows", _JSON_LIST_ORACLE)
def q_json_list_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List documents → one row per member; object members give
    their fields, scalar members the ``value`` column; duplicates removed."""
    from .sources.fixtures import adapter
    from .sources.json_docs import json_rows
    return json_rows(adapter(spark, sf_dir, "json_list_docs"), "doc")


_JSON_DOCUMENTS_ORACLE = with_adapters(["json_docs", "json_tag_docs"], """,
p AS (SELECT CAST(json_extract(doc, '$.id') AS BIGINT) AS id, json_extract_string(doc, '$.kind') AS kind,
             CAST(json_extract(doc, '$.user.id') AS BIGINT) AS "user.id",
             CAST(json_extract(doc, '$.user.flag.odd') AS BOOLEAN) AS "user.flag.odd",
             CAST(json_extract(doc, '$.tags') AS VARCHAR[]) AS tags,
             CAST(json_extract(doc, '$.scores') AS BIGINT[]) AS scores FROM json_docs),
t AS (SELECT -1 - CAST(json_extract(doc, '$.id') AS BIGINT) AS id, json_extract_string(doc, '$.kind') AS kind,
             CAST(json_extract(doc, '$.tags') AS VARCHAR[]) AS tags FROM json_tag_docs)
SELECT id, kind, "user.id", "user.flag.odd", UNNEST(tags) AS tags, UNNEST(scores) AS scores, CAST(NULL AS BIGINT) AS value FROM p
UNION SELECT id, kind, NULL, NULL, UNNEST(tags), NULL, NULL FROM t
UNION SELECT NULL, NULL, NULL, NULL, NULL, NULL, c_custkey FROM customer
UNION SELECT NULL, NULL, NULL, NULL, NULL, NULL, COUNT(*) FROM nation""")


@register("json_documents", _JSON_DOCUMENTS_ORACLE)
def q_json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of mixed files. The event documents as one array in a ``.json`` file that is
    read by ranges, the tag documents in ``.jsonl`` files, the customers' ids as lines of scalars in ``.ndjson``
    files, the number of nations as a document of its own, and lines of objects in a ``.json`` file."""
    from pyspark.sql import functions as F

    from .session import rename_parts, shared_dir
    from .sources.fixtures import adapter
    from .sources.json_docs import json_rows, read_json_files
    from .sources.tables import table
    base = shared_dir(spark, "json_documents")
    docs = adapter(spark, sf_dir, "json_docs").select("doc")
    # one file holds one array, so one task writes it; the ranges of the reader are what is shown here
    one = docs.coalesce(1).select(F.concat(F.when(F.monotonically_increasing_id() == 0, "[").otherwise(","), "doc").alias("value"))
    one.unionByName(spark.range(1).select(F.lit("]").alias("value"))).coalesce(1).write.text(f"{base}/a")
    tags = adapter(spark, sf_dir, "json_tag_docs").select(F.regexp_replace("doc", r'^\{"id":(\d+)', r'{"id":$1').alias("value"),
                                                          F.get_json_object("doc", "$.id").cast("long").alias("id"))
    # ids of their own, so that these rows are no duplicates of the others
    tags = tags.select(F.concat(F.lit('{"id":'), (-1 - F.col("id")).cast("string"),
                                F.regexp_replace("value", r'^\{"id":\d+', "")).alias("value"))
    tags.write.text(f"{base}/b")
    table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("value")).write.text(f"{base}/c")
    table(spark, sf_dir, "nation").agg(F.count(F.lit(1)).cast("string").alias("value")).write.text(f"{base}/d")
    tags.limit(3).coalesce(1).write.text(f"{base}/e")  # again, as NDJSON in a .json file: duplicates
    for folder, extension in (("a", "json"), ("b", "jsonl"), ("c", "ndjson"), ("d", "json"), ("e", "json")):
        rename_parts(spark, f"{base}/{folder}", extension)
    found = read_json_files(spark, [f"{base}/{x}" for x in "abcde"], split_above=1 << 16)
    return json_rows(found, "doc", explode_lists="record")


# ------------------------------------------------------------ quality checks
_Q1_ORACLE = """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1"""


@register("pk_violations", _Q1_ORACLE)
def q_pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1: repeated (l_orderkey, l_linenumber) keys in lineitem, with their counts."""
    from .operators.quality import pk_violations
    from .sources.tables import table
    return pk_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _null_violation_oracle() -> str:
    from .plans.inventory_export import COLUMNS
    parts = [f"SELECT '{c}' AS column_name, {i} AS position, COUNT(*) - COUNT(\"{c}\") AS null_count FROM x"
             for i, c in enumerate(COLUMNS)]
    return (f"WITH x AS ({_X2_ORACLE}\n)\nSELECT * FROM (" + "\nUNION ALL ".join(parts)
            + ") WHERE null_count > 0")


@register("null_violations", _null_violation_oracle())
def q_null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2: which of the 42 inventory-export columns hold nulls, and how many (one pass)."""
    from .operators.quality import null_violations
    out = q_inventory_export(spark, sf_dir)
    return null_violations(out, out.columns)


def _documents_range_schema():
    from .schema import OutputSchema, unsigned_int, unsigned_smallint, varchar
    return OutputSchema("documents_ranges", unsigned_int("doc_id"), varchar("text", 16383),
                        varchar("lang", 2), varchar("source", 4), unsigned_smallint("n_chars"))


_Q13_ORACLE = """
SELECT * FROM (
  SELECT 'doc_id' AS column_name, 0 AS position,
         COUNT(*) FILTER (WHERE doc_id < 0 OR doc_id > 4294967295) AS out_of_range FROM documents
  UNION ALL SELECT 'text', 1, COUNT(*) FILTER (WHERE length(text) > 16383) FROM documents
  UNION ALL SELECT 'lang', 2, COUNT(*) FILTER (WHERE length(lang) > 2) FROM documents
  UNION ALL SELECT 'source', 3, COUNT(*) FILTER (WHERE length(source) > 4) FROM documents
  UNION ALL SELECT 'n_chars', 4, COUNT(*) FILTER (WHERE n_chars < 0 OR n_chars > 65535) FROM documents)
WHERE out_of_range > 0"""


@register("range_violations", _Q13_ORACLE)
def q_range_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q13: documents against declared database types (unsigned ints, text lengths)."""
    from .operators.quality import range_violations
    from .sources.tables import table
    return range_violations(table(spark, sf_dir, "documents"),
                            _documents_range_schema())


_Q9_ORACLE = """
WITH b AS (SELECT MIN(CAST(o_orderdate AS DATE)) AS lo, MAX(CAST(o_orderdate AS DATE)) AS hi FROM orders),
d AS (SELECT CAST(g.ts AS DATE) AS missing_date
      FROM b, generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY) AS g(ts))
SELECT missing_date FROM d
WHERE missing_date NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)"""


@register("daily_completeness", _Q9_ORACLE)
def q_daily_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9: days between the first and last order without any order (calendar anti join)."""
    from .operators.quality import daily_completeness
    from .sources.calendar import date_range_of
    from .sources.tables import table
    orders = table(spark, sf_dir, "orders")
    return daily_completeness(orders, "o_orderdate", date_range_of(spark, [(orders, "o_orderdate")]))


_Q11_ORACLE = f"""
WITH x AS ({_X1_ORACLE}
),
s AS (SELECT CAST(stock_creation_date AS DATE) AS date, SUM(quantity) AS s0,
             SUM(unit_price) AS s1, SUM(total_value) AS s2
      FROM x GROUP BY 1)
SELECT date, list_filter([CASE WHEN s0 = 0 THEN 'quantity' END,
                          CASE WHEN s1 = 0 THEN 'unit_price' END,
                          CASE WHEN s2 = 0 THEN 'total_value' END], lambda c: c IS NOT NULL)
       AS zero_sum_columns
FROM s WHERE s0 = 0 OR s1 = 0 OR s2 = 0"""


@register("zero_sum_days", _Q11_ORACLE)
def q_zero_sum_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q11: stock-creation days of the inventory snapshot whose quantity, price
    or value columns sum to zero (e.g. only unpriced products that day)."""
    from .operators.quality import zero_sum_days
    return zero_sum_days(q_inventory_snapshot(spark, sf_dir), "stock_creation_date",
                         ["quantity", "unit_price", "total_value"])


# Query parameter: the event types a consumer accepts ("error" is not one of them).
ALLOWED_EVENT_TYPES = ["click", "view", "purchase", "signup"]

_Q12_ORACLE = f"""
SELECT event_type AS value, COUNT(*) AS n FROM events
WHERE event_type IS NOT NULL AND event_type NOT IN ({', '.join(repr(x) for x in ALLOWED_EVENT_TYPES)})
GROUP BY event_type"""


@register("invalid_options", _Q12_ORACLE)
def q_invalid_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12: event types outside the allowed options, with their counts."""
    from .operators.quality import invalid_options
    from .sources.tables import table
    return invalid_options(table(spark, sf_dir, "events"), "event_type", ALLOWED_EVENT_TYPES)


_Q4_ORACLE = with_adapters(["json_mixed_docs"], """,
t AS (SELECT json_type(doc, '$.id') AS id, json_type(doc, '$.n') AS n, json_type(doc, '$.s') AS s,
             json_type(doc, '$.f') AS f, json_type(doc, '$.user.id') AS u, doc FROM json_mixed_docs)
SELECT 'id' AS column_name, 0 AS position,
       COUNT(*) FILTER (WHERE id NOT IN ('BIGINT', 'UBIGINT', 'BOOLEAN', 'NULL')) AS mismatches FROM t
UNION ALL SELECT 'n', 1, COUNT(*) FILTER (WHERE n NOT IN ('BIGINT', 'UBIGINT', 'BOOLEAN', 'NULL')) FROM t
UNION ALL SELECT 's', 2, COUNT(*) FILTER (WHERE s NOT IN ('VARCHAR', 'NULL')) FROM t
UNION ALL SELECT 'f', 3, COUNT(*) FILTER (WHERE f NOT IN ('DOUBLE', 'NULL')) FROM t
UNION ALL SELECT 'user.id', 4, COUNT(*) FILTER (WHERE u NOT IN ('BIGINT', 'UBIGINT', 'BOOLEAN', 'NULL')) FROM t
UNION ALL SELECT 'tags', 5, COUNT(*) FROM (SELECT UNNEST(CAST(json_extract(doc, '$.tags') AS JSON[])) AS e FROM t)
          WHERE json_type(e) NOT IN ('VARCHAR', 'NULL')""")


@register("type_mismatches", _Q4_ORACLE)
def q_type_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3/Q4/U4: per declared column of the JSON documents, values of another JSON type
    (text numbers, fractions, booleans as integers, list elements)."""
    from .sources.fixtures import adapter
    from .sources.json_docs import json_type_mismatches
    return json_type_mismatches(adapter(spark, sf_dir, "json_mixed_docs"),
                                {"id": int, "n": int, "s": str, "f": float, "user.id": int, "tags": str})


_MISFIT_ORACLE = with_adapters(["json_docs", "json_list_docs"], """,
m AS (SELECT UNNEST(CAST(json_extract(doc, '$') AS JSON[])) AS e FROM json_list_docs),
r AS (SELECT 'value' AS reason FROM m WHERE json_type(e) <> 'OBJECT'
      UNION ALL
      SELECT 'fields ' || array_to_string(list_sort(list_concat(
               list_filter(json_keys(doc), lambda k: k NOT IN ('id', 'kind', 'user', 'tags')),
               list_transform(list_filter(json_keys(doc, '$.user'), lambda k: k <> 'id'), lambda k: 'user.' || k))), ',')
      FROM json_docs)
SELECT reason, COUNT(*) AS n FROM r WHERE reason <> 'fields ' GROUP BY reason""")


@register("json_shape_misfits", _MISFIT_ORACLE)
def q_json_shape_misfits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X7 with a declared shape: items of an undeclared kind and undeclared (nested) fields, counted by reason."""
    from pyspark.sql import functions as F

    from .sources.fixtures import adapter
    from .sources.json_docs import JsonShape, shape_misfits
    lists = shape_misfits(adapter(spark, sf_dir, "json_list_docs"), JsonShape("STRUCT<k: BIGINT>", None, True))
    objects = shape_misfits(adapter(spark, sf_dir, "json_docs"), JsonShape(
        "STRUCT<id: BIGINT, kind: STRING, user: STRUCT<id: BIGINT>, tags: ARRAY<STRING>>", None, False))
    return lists.unionByName(objects).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------- sinks
def _scratch_table(spark: SparkSession, base: str) -> str:
    """A fresh catalog table name for one query run (data in the shared folder)."""
    import uuid
    return f"{base}_{uuid.uuid4().hex[:12]}"


_K123_ORACLE = """
SELECT 'part' AS src, p_partkey AS id, upper(p_name) AS name FROM part
UNION ALL
SELECT 'supplier' AS src, s_suppkey AS id, s_name AS name FROM supplier"""


@register("load_modes_roundtrip", _K123_ORACLE)
def q_load_modes_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1–K3: DROP_INSERT parts, TRUNCATE_INSERT them again with upper-case names
    (definition kept, rows replaced), INSERT suppliers after a key-conflict
    check on (src, id); the table is read back."""
    from pyspark.sql import functions as F

    from .sinks.loaders import LoadMode, load_table
    from .sources.tables import table
    name = _scratch_table(spark, "lp_items")
    part = table(spark, sf_dir, "part")
    rows = part.select(F.lit("part").alias("src"), F.col("p_partkey").alias("id"),
                       F.col("p_name").alias("name"))
    load_table(rows, name, LoadMode.DROP_INSERT)
    load_table(rows.withColumn("name", F.upper("name")), name, LoadMode.TRUNCATE_INSERT)
    sup = table(spark, sf_dir, "supplier").select(
        F.lit("supplier").alias("src"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    load_table(sup, name, LoadMode.INSERT, key=["src", "id"])
    return spark.table(name)


_K3_CONFLICT_ORACLE = """
SELECT p_partkey AS id FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)"""


@register("insert_key_conflicts", _K3_CONFLICT_ORACLE)
def q_insert_key_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 check: the sold parts (from lineitem) are loaded first; appending the
    whole part table then conflicts on every part id already present."""
    from pyspark.sql import functions as F

    from .sinks.loaders import LoadMode, key_conflicts, load_table
    from .sources.tables import table
    name = _scratch_table(spark, "lp_sold_parts")
    sold = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id")).distinct()
    load_table(sold, name, LoadMode.DROP_INSERT)
    new = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"))
    return key_conflicts(new, spark.table(name), ["id"])


_K4_ORACLE = "SELECT * FROM orders"


@register("csv_export_roundtrip", _K4_ORACLE)
def q_csv_export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders exported as CSV (parallel part files, dated layout) and read back."""
    from .sinks.export import dated_key, export_csv
    from .session import shared_dir
    from .sources.tables import table
    orders = table(spark, sf_dir, "orders")
    path = dated_key(shared_dir(spark, "exports"), "orders", AS_OF)
    export_csv(orders, path)
    return spark.read.schema(orders.schema).option("header", True) \
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)


_K5_ORACLE = f"""
SELECT 'orders' AS export_name, 'orders_{AS_OF:%Y-%m-%d}.csv' AS file_name, 'Orders' AS category,
       '{KPI_WINDOW[0]} to {KPI_WINDOW[1]}' AS period, COUNT(*) AS row_count,
       COUNT(*) > 0 AS has_bytes
FROM orders"""


@register("export_manifest", _K5_ORACLE)
def q_export_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gzip CSV export of orders (parallel part files under the dated
    key) and its manifest (observed row count, period label, byte size)."""
    from pyspark.sql import functions as F

    from .sinks.export import dated_key, export_csv, export_manifest
    from .session import shared_dir
    from .sources.tables import table
    orders = table(spark, sf_dir, "orders")
    path = dated_key(shared_dir(spark, "exports"), "orders", AS_OF)
    res = export_csv(orders, path, compression="gzip")
    man = export_manifest(spark, res, export_name="orders", category="Orders",
                          min_date=KPI_WINDOW[0], max_date=KPI_WINDOW[1], as_of=AS_OF)
    return man.select("export_name", "file_name", "category", "period", "row_count",
                      # gzip keeps more than a byte a row: a lost or empty export shows here
                      (F.col("bytes") > F.col("row_count")).alias("has_bytes"))


_PARTS_ORACLE = "SELECT *, TRUE AS below_limit FROM orders"
PART_LIMIT = 200_000


@register("export_parts", _PARTS_ORACLE)
def q_export_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 Q14: orders exported as CSV files below a byte limit (cut by a prefix sum of rendered bytes) and read
    back, each row with whether its file, by its manifest row, is below the limit and holds as many rows."""
    from pyspark.sql import functions as F

    from .session import shared_dir
    from .sinks.parts import export_csv_parts
    from .sources.tables import table
    orders = table(spark, sf_dir, "orders")
    path = shared_dir(spark, "exports")
    manifest = export_csv_parts(orders, path, PART_LIMIT)
    back = (spark.read.schema(orders.schema).option("header", True).option("recursiveFileLookup", True)
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
            .withColumn("part", F.regexp_extract(F.col("_metadata.file_path"), r"/part=(\d+)/", 1).cast("long")))
    read = back.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    fine = manifest.join(read, "part").select(
        "part", ((F.col("bytes") <= PART_LIMIT) & (F.col("n") == F.col("row_count"))).alias("below_limit"))
    return back.join(fine, "part").drop("part")


_X6_ORACLE = """
SELECT 'customer' AS table_name, COUNT(*) AS source_rows, COUNT(*) AS target_rows, SUM(c_custkey) AS key_sum,
       SUM(c_custkey % 1000 * length(c_name)) AS name_sum FROM customer
UNION ALL SELECT 'part', COUNT(*), COUNT(*), SUM(p_partkey), SUM(p_partkey % 1000 * length(p_name)) FROM part
UNION ALL SELECT 'supplier', COUNT(*), COUNT(*), SUM(s_suppkey), SUM(s_suppkey % 1000 * length(s_name)) FROM supplier"""

# Table groups per source system (query parameter).
MIRROR_GROUPS = {"erp": {"tables": ["customer", "part", "supplier"], "dims": ["part"]}}


@register("mirror_tables", _X6_ORACLE)
def q_mirror_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X6 (S12 K8 F6): mirror a table group into catalog tables (generated column
    left out), then reconcile source and target row counts and sum up the targets' keys and names."""
    from pyspark.sql import functions as F

    from .sinks.mirror import mirror_tables, select_tables
    from .sources.tables import table
    names = select_tables(MIRROR_GROUPS, "erp")
    sources = {n: table(spark, sf_dir, n) for n in names}
    # a derived column the target computes itself (F6): excluded from the copy
    sources["part"] = sources["part"].withColumn("p_name_upper", F.upper("p_name"))
    prefix = _scratch_table(spark, "mirror") + "_"
    counts = mirror_tables(spark, sources, target_prefix=prefix,
                           generated_columns={"part": ["p_name_upper"]})
    content = None
    for n, (key, text) in {"customer": ("c_custkey", "c_name"), "part": ("p_partkey", "p_name"),
                           "supplier": ("s_suppkey", "s_name")}.items():
        one = spark.table(prefix + n).agg(
            F.lit(n).alias("table_name"), F.sum(key).alias("key_sum"),
            F.sum(F.col(key) % 1000 * F.char_length(text)).alias("name_sum"))
        content = one if content is None else content.unionByName(one)
    return counts.join(content, "table_name")


_OUTCOMES_ORACLE = """
WITH n AS (SELECT COUNT(*) AS orders, COUNT(*) FILTER (o_totalprice < 0) AS negative, COUNT(DISTINCT o_orderstatus) AS states FROM orders)
SELECT 'rows' AS "check", CASE WHEN negative = 0 THEN 'failed' ELSE 'passed' END AS outcome, negative AS "rows" FROM n
UNION ALL SELECT 'rows', CASE WHEN orders = 0 THEN 'failed' ELSE 'passed' END, orders FROM n
UNION ALL SELECT 'table', 'failed', orders FROM n
UNION ALL SELECT 'table_name', 'failed', orders FROM n
UNION ALL SELECT 'size', CASE WHEN orders > 0 THEN 'failed' ELSE 'passed' END, orders FROM n
UNION ALL SELECT 'empty_input', CASE WHEN negative = 0 THEN 'warned' ELSE 'passed' END, negative FROM n"""


@register("check_outcomes", _OUTCOMES_ORACLE)
def q_check_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6 Q8 Q10 Q14 Q15: what the checks that end a load or a job say about the orders: orders without value (none) and all
    orders as not empty, a load into a table that is not there, a bad table name, an export above its limit, and a job that is
    given the orders without value as an input."""
    import warnings

    from pyspark.sql import functions as F

    from .errors import CheckFailed, NotFound
    from .operators.quality import enforce_not_empty, validate_table_name
    from .plans.job import BatchJob, Destination
    from .schema import ColumnSpec, OutputSchema
    from .session import shared_dir
    from .sinks.export import export_csv
    from .sinks.loaders import LoadMode, load_table
    from .sources.tables import table
    orders = table(spark, sf_dir, "orders")
    negative = orders.where("o_totalprice < 0")

    def outcome(run) -> str:
        try:
            run()
        except (CheckFailed, NotFound):
            return "failed"
        return "passed"

    class Keys(BatchJob):
        schema = OutputSchema("keys", ColumnSpec("o_orderkey", primary_key=True))

        def extract(self, spark, params, ctx):
            return {"data": orders, "negative": negative}

        def transform(self, inputs, params, ctx):
            return inputs["data"].select("o_orderkey").unionByName(inputs["negative"].select("o_orderkey"))

    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        Keys().run(spark, None, RunContext(as_of=AS_OF), Destination(csv_path=shared_dir(spark, "exports")))
    warned = any("input negative has no rows" in str(w.message) for w in caught)
    found = [("rows", outcome(lambda: enforce_not_empty(negative, "orders")), negative),
             ("rows", outcome(lambda: enforce_not_empty(orders, "orders")), orders),
             ("table", outcome(lambda: load_table(orders, _scratch_table(spark, "lp_no_such_table"), LoadMode.TRUNCATE_INSERT)), orders),
             ("table_name", outcome(lambda: validate_table_name("orders; --")), orders),
             ("size", outcome(lambda: export_csv(orders, shared_dir(spark, "exports"), size_limit=100)), orders),
             ("empty_input", "warned" if warned else "passed", negative)]
    rows = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(c).alias("check"), F.lit(o).alias("outcome"), "rows")
            for c, o, df in found]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


_MIRROR_CHANGES_ORACLE = """
SELECT *, CAST(1 AS BIGINT) AS rewritten, CAST((SELECT COUNT(*) FROM customer) AS BIGINT) AS reconciled FROM customer"""


@register("mirror_changes", _MIRROR_CHANGES_ORACLE)
def q_mirror_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mirror of the customers in which one row differs, brought up to date: the ranges that were rewritten (one),
    the rows that the comparison counted in the source, and the mirror's rows."""
    from pyspark.sql import functions as F

    from .sinks.mirror import RANGE, mirror_changes
    from .sources.tables import table
    customer, name = table(spark, sf_dir, "customer"), _scratch_table(spark, "lp_mirror_changes")
    one = customer.agg(F.max("c_custkey").alias("k")).first()["k"]
    old = customer.withColumn("c_name", F.when(F.col("c_custkey") == one, F.lit("before")).otherwise(F.col("c_name")))
    mirror_changes(spark, old, name, ["c_custkey"], ranges=64)
    done = mirror_changes(spark, customer, name, ["c_custkey"], ranges=64).agg(
        F.count_if("changed").alias("rewritten"), F.sum("source_rows").alias("reconciled")).first()
    return spark.table(name).drop(RANGE).select("*", F.lit(done["rewritten"]).cast("long").alias("rewritten"),
                                                F.lit(done["reconciled"]).cast("long").alias("reconciled"))


_EMB_ORACLE = "SELECT vec_id, embedding, COALESCE(label, -1) AS label FROM embeddings"


@register("embedding_passthrough", _EMB_ORACLE)
def q_embedding_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1/P10 on a frame with a vector column: cleaning touches strings only,
    the float arrays pass through unchanged."""
    from pyspark.sql import types as T

    from .operators.tail import output_tail
    from .schema import ColumnSpec, OutputSchema
    from .sources.tables import table
    schema = OutputSchema("embeddings_out", ColumnSpec("vec_id", T.LongType(), primary_key=True),
                          ColumnSpec("embedding", T.ArrayType(T.FloatType())),
                          ColumnSpec("label", T.IntegerType(), default=-1))
    return output_tail(table(spark, sf_dir, "embeddings"), schema)


_RUN_ORACLE = f"""
WITH b AS (
  SELECT LEAST((SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders),
               (SELECT MIN(CAST(l_shipdate AS DATE)) FROM lineitem)) AS lo,
         GREATEST((SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders),
                  (SELECT MAX(CAST(l_shipdate AS DATE)) FROM lineitem)) AS hi)
SELECT 'lakepipe.plans.date_dimension.DateDimension' AS pipe_name, 0 AS status_id,
       CAST(0 AS BIGINT) AS extracted_rows, CAST(0 AS BIGINT) AS loaded_rows, 0 AS dataframes_memory,
       CAST(NULL AS VARCHAR) AS error
UNION ALL
SELECT 'lakepipe.plans.date_dimension.DateDimension', 1, CAST(hi - lo + 1 AS BIGINT), CAST(hi - lo + 1 AS BIGINT), 1, NULL FROM b"""

_REPORT_ORACLE = """
SELECT 'DateDimension' AS "Pipe name", CAST(0 AS BIGINT) AS "Retry", FALSE AS "Manual trigger", 'Success' AS "Status",
       CAST(days AS BIGINT) AS "Extracted rows", CAST(days AS BIGINT) AS "Loaded rows", 1 AS "Memory used"
FROM (SELECT GREATEST((SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders), (SELECT MAX(CAST(l_shipdate AS DATE)) FROM lineitem))
             - LEAST((SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders), (SELECT MIN(CAST(l_shipdate AS DATE)) FROM lineitem))
             + 1 AS days)"""


@register("job_run_log", _RUN_ORACLE)
def q_job_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the date-dimension job end to end (checks before
    the write, DROP_INSERT into a catalog table) and return its run-log records."""
    return _logged_run(spark, sf_dir).select("pipe_name", "status_id", "extracted_rows", "loaded_rows",
                                             "dataframes_memory", "error")


@register("job_run_report", _REPORT_ORACLE)
def q_job_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monitoring report over the log that a job run has just written."""
    from datetime import timedelta, timezone

    from .plans.monitoring import monitoring_report
    now = datetime.now(timezone.utc).replace(tzinfo=None) + timedelta(minutes=1)
    return monitoring_report(_logged_run(spark, sf_dir), now).select(
        "Pipe name", "Retry", "Manual trigger", "Status", "Extracted rows", "Loaded rows", "Memory used")


def _logged_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run-log records of one run of the date-dimension job over the tables' whole date span."""
    from pyspark.sql import functions as F

    from .plans.date_dimension import DateDimension, DateDimensionParameters
    from .plans.job import Destination
    from .sinks.loaders import LoadMode
    from .sources.calendar import data_date_bounds
    from .sources.tables import table
    lo, hi = data_date_bounds([(table(spark, sf_dir, "orders"), "o_orderdate"),
                               (table(spark, sf_dir, "lineitem"), "l_shipdate")])
    log_table = _scratch_table(spark, "lp_run_log")
    ctx = RunContext(as_of=AS_OF, run_log_table=log_table, manual_trigger=False)
    DateDimension().run(spark, DateDimensionParameters(lo.isoformat(), hi.isoformat()), ctx,
                        Destination(table=_scratch_table(spark, "lp_dim_date"),
                                    load_mode=LoadMode.DROP_INSERT))
    return spark.table(log_table).where(F.col("uuid") == ctx.run_id)


# ----------------------------------------------------------- S1/S2 SQL text
_SALES_SQL = """
WITH days AS (SELECT *, to_date(order_date) AS time FROM {customer_sales})
SELECT time, region_type, region, country, customer_type, entity_id, order_id, net_subtotal
FROM days WHERE time >= :min_date AND time <= :max_date"""

_S2_ORACLE = with_adapters(["customer_sales"], f"""
SELECT * EXCLUDE (order_date), CAST(order_date AS DATE) AS time FROM customer_sales
WHERE CAST(order_date AS DATE) BETWEEN DATE '{KPI_WINDOW[0]}' AND DATE '{KPI_WINDOW[1]}'""")


@register("sales_extract_sql", _S2_ORACLE)
def q_sales_extract_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extract written as SQL text; the frame is bound as ``{customer_sales}``
    and the window as named parameters ``:min_date`` / ``:max_date``."""
    from datetime import date

    from .sources.fixtures import adapter
    from .sources.sql import run_sql
    return run_sql(spark, _SALES_SQL,
                   {"min_date": date.fromisoformat(KPI_WINDOW[0]),
                    "max_date": date.fromisoformat(KPI_WINDOW[1])},
                   customer_sales=adapter(spark, sf_dir, "customer_sales"))


# ------------------------------------------------------------ S6–S8 files
_JSON_FILES_ORACLE = _JSON_ZIP_ORACLE


@register("json_files", _JSON_FILES_ORACLE)
def q_json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6–S8 + R2–R6 + A8: the event documents written as line-delimited files
    (several part files) in the shared folder, read back by the directory reader
    and reshaped with the list rule applied to every record (``explode_lists="record"``)."""
    from .session import shared_dir
    from .sources.fixtures import adapter
    from .sources.json_docs import json_rows, read_json_files
    folder = shared_dir(spark, "json_files")
    adapter(spark, sf_dir, "json_docs").select("doc").write.mode("overwrite").text(folder)
    docs = read_json_files(spark, folder, document_globs=(), line_globs=("*.txt",))
    return json_rows(docs, "doc", explode_lists="record")


@register("json_stream_ingest", _JSON_ZIP_ORACLE)
def q_json_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured Streaming ingest of the event documents: Spark writes them as
    line-delimited part files, a file stream (``availableNow``) reshapes each
    micro-batch with the JSON rules into parquet, and the ingested rows are read back."""
    from .session import shared_dir
    from .sources.fixtures import adapter
    from .streaming.json_ingest import ingest_json_folder, read_ingested
    base = shared_dir(spark, "json_stream")
    adapter(spark, sf_dir, "json_docs").select("doc").write.mode("overwrite").text(f"{base}/in")
    q = ingest_json_folder(spark, f"{base}/in", f"{base}/out", pattern="*.txt",
                           line_delimited=True, explode_lists="record")
    q.awaitTermination()
    return read_ingested(spark, f"{base}/out").drop("batch")
