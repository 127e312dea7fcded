"""Adapter views: the input schemas the jobs expect, built from the test tables.

Each adapter is one SQL text valid in both Spark and DuckDB, so the Spark
job and its DuckDB oracle read identical inputs. Adapters only rename,
cast and derive columns row by row (plus the star joins that give sales and
purchases their geography); none of them does a job's work. Money is DECIMAL
from the first step. Base tables are referenced as ``{name}`` and bound to
DataFrames through ``spark.sql(sql, name=df)``, so no global view is needed.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .tables import table

ADAPTERS: dict[str, str] = {
    "stock_quantities": """
SELECT l_partkey AS product_id,
       CAST(l_quantity AS INT) AS total_qty,
       CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS INT) ELSE 0 END AS available_qty,
       CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(4,2)) AS cost,
       l_shipdate AS created_at,
       CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS deleted_at
FROM {lineitem}""",
    "products": """
SELECT p_partkey AS id,
       CAST(p_size % 3 + 1 AS INT) AS system_id,
       CAST(p_size % 7 + 1 AS INT) AS warehouse_id,
       CAST(p_size % 8 AS INT) AS status_id
FROM {part}""",
    "product_prices": """
SELECT CASE WHEN p_partkey % 5 = 0 THEN -p_partkey ELSE p_partkey END AS product_id,
       CAST(p_size % 3 + 1 AS INT) AS entity_id,
       CAST(p_retailprice AS DECIMAL(12,2)) AS regular_price
FROM {part}""",
    "customer_sales": """
SELECT CAST(o_custkey % 3 + 1 AS INT) AS entity_id,
       o_orderkey AS order_id,
       o_orderdate AS order_date,
       n_name AS country,
       CASE WHEN n_nationkey % 2 = 0 THEN 'Market' ELSE 'State' END AS region_type,
       CASE WHEN n_nationkey % 10 = 9 THEN NULL ELSE r_name END AS region,
       c_mktsegment AS customer_type,
       CAST(o_totalprice AS DECIMAL(14,2)) AS net_subtotal
FROM {orders}
JOIN {customer} ON o_custkey = c_custkey
JOIN {nation} ON c_nationkey = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey""",
    "customer_purchases": """
SELECT CAST(l_suppkey % 3 + 1 AS INT) AS entity_id,
       l_orderkey AS po_id,
       l_shipdate AS order_date,
       n_name AS country,
       CASE WHEN n_nationkey % 2 = 0 THEN 'Market' ELSE 'State' END AS region_type,
       CASE WHEN n_nationkey % 10 = 9 THEN NULL ELSE r_name END AS region,
       'SUPPLIER' AS customer_type,
       CAST(l_extendedprice AS DECIMAL(14,2)) AS total
FROM {lineitem}
JOIN {supplier} ON l_suppkey = s_suppkey
JOIN {nation} ON s_nationkey = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey""",
    "fact_inventory_current": """
SELECT o_orderkey AS stock_id,
       o_custkey AS product_id,
       o_custkey AS purchase_order_id,
       o_orderkey % 11 AS purchase_order_item_id,
       CAST(o_custkey % 26 + 1 AS INT) AS warehouse_id,
       CAST(o_orderkey % 6 AS INT) AS product_status_id,
       CAST(o_orderkey % 5 AS INT) AS product_type_id,
       CAST(o_custkey % 7 AS INT) AS entity_id,
       CAST(FLOOR(o_custkey / 15.0) AS BIGINT) + 1 AS model_id,
       CAST(o_orderkey % 8 AS INT) AS channel_id,
       o_orderpriority AS location_name,
       CONCAT('SKU-', CAST(o_orderkey AS VARCHAR(20))) AS sku,
       CASE WHEN o_orderkey % 2 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
       o_orderdate AS stock_creation_date,
       o_orderdate AS product_creation_date,
       o_orderdate AS product_change_date,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderdate END AS last_verification_date,
       o_orderkey % 3 = 0 AS is_available_for_sale,
       o_orderkey % 4 = 0 AS is_vat_margin_scheme_eligible,
       CAST(o_orderkey % 9 AS INT) AS total_qty,
       CAST(o_orderkey % 5 AS INT) AS available_qty,
       CAST(o_orderkey % 4 AS INT) AS sold_qty,
       CAST(o_orderkey % 3 AS INT) AS paid_qty,
       CASE WHEN o_orderkey % 2 = 0 THEN CAST(1.00 AS DECIMAL(6,2)) ELSE CAST(0.92 AS DECIMAL(6,2)) END AS fx_rate,
       CASE WHEN o_orderkey % 10 = 0 THEN CAST(0 AS DECIMAL(12,2)) ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS cost,
       CASE WHEN o_orderkey % 7 = 0 THEN CAST(0 AS DECIMAL(12,2)) ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS expected_resale_price,
       CAST(o_totalprice AS DECIMAL(12,2)) AS regular_resale_price,
       CASE WHEN o_orderkey % 13 = 0 THEN CAST(0 AS DECIMAL(12,2)) ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS final_resale_price
FROM {orders}""",
    "dim_warehouse": """
SELECT n_nationkey + 1 AS id, n_name AS code,
       CONCAT('C', CAST(n_regionkey AS VARCHAR(10))) AS country_code
FROM {nation}""",
    "dim_product_type": """
SELECT r_regionkey AS id, CONCAT('Type ', r_name) AS name, r_regionkey % 2 = 0 AS is_golf_club
FROM {region}""",
    "dim_entity": """
SELECT r_regionkey AS id, CONCAT('E', CAST(r_regionkey AS VARCHAR(10))) AS code FROM {region}""",
    "dim_product": """
SELECT p_partkey AS id,
       CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_size % 4 END AS condition_id,
       p_size % 6 AS dexterity_id,
       p_size % 7 AS standard_flex_id,
       p_size % 8 AS standard_loft_id,
       p_size % 9 AS shaft_material_id,
       CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size % 5 END AS club_count,
       CAST(p_size AS DECIMAL(5,1)) AS loft_degree,
       CAST(p_size + 20 AS DECIMAL(5,1)) AS length,
       CAST(p_size % 3 - 1 AS DECIMAL(5,1)) AS length_difference
FROM {part}""",
    "dim_model": """
SELECT s_suppkey AS id, s_name AS name, s_nationkey AS brand_id FROM {supplier}""",
    "dim_brand": """
SELECT n_nationkey + 5 AS id, n_name AS name FROM {nation}""",
    "run_log": """
SELECT CONCAT('pipes.facts.', event_type, '.Pipe', CAST((event_id - event_id % 3) % 7 AS VARCHAR(10))) AS pipe_name,
       (event_id - event_id % 3) % 2 = 0 AS manual_trigger,
       CASE WHEN event_id % 3 = 0 THEN 0
            WHEN event_type IN ('view', 'signup') THEN 0
            WHEN event_type = 'error' THEN 2
            ELSE 1 END AS status_id,
       CAST(event_id % 5000 AS INT) AS duration,
       CAST(event_id % 1000 AS INT) AS extracted_rows,
       CAST(event_id % 64 AS INT) AS dataframes_memory,
       CAST(event_id % 900 AS INT) AS loaded_rows,
       CONCAT('run-', CAST(event_id - event_id % 3 AS VARCHAR(20))) AS uuid,
       CASE WHEN event_type = 'error' AND event_id % 3 <> 0 THEN CONCAT('E', CAST(user_id % 5 AS VARCHAR(10))) END AS error,
       ts AS created_at
FROM {events}""",
    "postal_inputs": """
SELECT c_custkey,
       NULLIF(split_part('CA GB US FR DE ES FI EE SE CZ PL NL DK AT BE CH NO LU HU IE IT MX ZA MY TH PT AU NZ PH JP KR SG GG JE IM IS ZZ -',
                         ' ', CAST(c_custkey % 38 AS INT) + 1), '-') AS country_code,
       CASE WHEN c_custkey % 17 = 0 THEN NULL
            WHEN c_custkey % 5 = 0 THEN CONCAT(' k', CAST(c_custkey % 12 AS VARCHAR(10)), 'a-0b1 ')
            WHEN c_custkey % 5 = 1 THEN CONCAT(CAST(1000 + c_custkey % 9000 AS VARCHAR(10)), ' ab')
            WHEN c_custkey % 5 = 2 THEN CONCAT(split_part('GY JE IM SW d', ' ', CAST(c_custkey % 3 AS INT) + 1 + CAST(c_custkey % 2 AS INT)),
                                               CAST(c_custkey % 120 AS VARCHAR(10)), '.', 'ab')
            WHEN c_custkey % 25 = 3 THEN CONCAT('D02-', CAST(c_custkey % 10000 AS VARCHAR(20)))
            ELSE LPAD(CAST(c_custkey AS VARCHAR(20)), CAST(3 + c_custkey % 7 AS INT), '0') END AS postal_code
FROM {customer}""",
    "json_docs": """
SELECT event_id,
       CONCAT('{{"id":', CAST(event_id AS VARCHAR(20)),
              ',"kind":"', event_type,
              '","user":{{"id":', CAST(user_id AS VARCHAR(20)), ',"flag":{{"odd":', CASE WHEN user_id % 2 = 1 THEN 'true' ELSE 'false' END,
              '}}}},"tags":[', CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '"a"' ELSE '"a","b"' END,
              '],"scores":[', CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '1' ELSE '1,2' END, ']}}') AS doc
FROM {events}""",
}

# A list document per event: its props object and its id as a bare scalar.
ADAPTERS["json_list_docs"] = """
SELECT event_id, CONCAT('[', props, ',', CAST(event_id AS VARCHAR(20)), ']') AS doc
FROM {events}"""

# Fields whose values have several JSON types.
ADAPTERS["json_mixed_docs"] = """
SELECT event_id,
       CONCAT('{{"id":', CAST(event_id AS VARCHAR(20)),
              ',"n":', CASE event_id % 4 WHEN 0 THEN '"12"' WHEN 1 THEN '2.5' WHEN 2 THEN 'true' ELSE '7' END,
              ',"s":', CASE event_id % 3 WHEN 0 THEN '5' ELSE '"a"' END,
              ',"f":', CASE event_id % 5 WHEN 0 THEN '1' WHEN 1 THEN 'null' ELSE '0.25' END,
              ',"user":{{"id":', CAST(user_id AS VARCHAR(20)), '}}',
              ',"tags":[', CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '"a"' ELSE '"a",3' END, ']}}') AS doc
FROM {events}"""

# An object with exactly one list field per event (0, 1 or 2 tags).
ADAPTERS["json_tag_docs"] = """
SELECT event_id,
       CONCAT('{{"id":', CAST(event_id AS VARCHAR(20)), ',"kind":"', event_type, '","tags":[',
              CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '"a"' ELSE '"a","b"' END, ']}}') AS doc
FROM {events}"""

# The small label dimensions share one shape, each with its own label prefix.
SMALL_DIMS = {
    "dim_product_status": "Status",
    "dim_dexterity": "Dexterity",
    "dim_standard_flex": "Flex",
    "dim_standard_loft": "Loft",
    "dim_shaft_material": "Shaft",
    "dim_product_condition": "Condition",
    "dim_purchase_channel": "Channel",
}
for _name, _label in SMALL_DIMS.items():
    ADAPTERS[_name] = f"SELECT r_regionkey AS id, CONCAT('{_label} ', r_name) AS name FROM {{region}}"

_REF = re.compile(r"(?<!\{)\{([a-z_]+)\}(?!\})")


def base_tables(name: str) -> list[str]:
    return sorted(set(_REF.findall(ADAPTERS[name])))


def adapter(spark: SparkSession, sf_dir: str, name: str,
            bases: dict[str, DataFrame] | None = None) -> DataFrame:
    """One adapter view; ``bases`` lets several adapters share base-table reads."""
    bases = bases if bases is not None else {}
    for t in base_tables(name):
        if t not in bases:
            bases[t] = table(spark, sf_dir, t)
    return spark.sql(ADAPTERS[name], **{t: bases[t] for t in base_tables(name)})


def adapters(spark: SparkSession, sf_dir: str, names) -> dict[str, DataFrame]:
    bases: dict[str, DataFrame] = {}
    return {n: adapter(spark, sf_dir, n, bases) for n in names}


def adapter_sql(name: str) -> str:
    """The adapter as plain SQL over the base tables (for DuckDB)."""
    return ADAPTERS[name].format(**{t: t for t in base_tables(name)})


def with_adapters(names: list[str], body: str) -> str:
    """``WITH a AS (…), b AS (…) <body>`` for an oracle query."""
    ctes = ",\n".join(f"{n} AS ({adapter_sql(n)}\n)" for n in names)
    return f"WITH {ctes}\n{body}" if names else body
