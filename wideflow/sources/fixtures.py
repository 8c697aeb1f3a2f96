"""Invoice-shaped views derived from the driver's TPC-H-like tables.

The source system reads all-string invoice tables from a catalogue; the test
data has none, so these views produce the same schemas from ``orders``,
``customer``, ``supplier``, ``lineitem``, ``part`` and ``events``. The SQL text
is shared verbatim with the DuckDB oracle (``{table}`` placeholders are filled
with DataFrames on Spark and with view names on DuckDB), so both engines read
identical inputs. Header numbers of either length repeat under different codes
(every twelfth order), so real key collisions are present.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import read_table, spread

INV_HEADER_SQL = """
SELECT CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 43 = 0 THEN '' WHEN o_orderkey % 47 = 0 THEN 'null'
            WHEN o_orderkey % 53 = 0 THEN concat('?', s_name) WHEN o_orderkey % 59 = 0 THEN 'no'
            WHEN o_orderkey % 61 = 0 THEN concat(chr(9), '  ', s_name, ' ', chr(1)) ELSE s_name END AS xfmc,
       CASE WHEN o_orderkey % 67 = 0 THEN NULL ELSE concat('TX', lpad(CAST(s_suppkey AS STRING), 8, '0')) END AS xfsbh,
       concat('addr-', CAST(s_nationkey AS STRING)) AS xfdzdh,
       CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS STRING) AS xfyhzh,
       CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE c_name END AS gfmc,
       concat('TX9', lpad(CAST(c_custkey AS STRING), 8, '0')) AS gfsbh,
       concat('addr-', CAST(c_nationkey AS STRING)) AS gfdzdh,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING) AS gfyhzh,
       CASE WHEN o_orderkey % 71 = 0 THEN '' ELSE concat('33021', lpad(CAST(c_custkey AS STRING), 7, '0')) END AS fpdm,
       CASE WHEN o_orderkey % 73 = 0 THEN NULL WHEN o_orderkey % 12 = 0 THEN lpad(CAST(o_orderkey % 5 AS STRING), 8, '0')
            WHEN o_orderkey % 12 = 7 THEN lpad(CAST(o_orderkey % 5 AS STRING), 18, '0') WHEN o_orderkey % 2 = 0 THEN lpad(CAST(o_orderkey AS STRING), 8, '0')
            ELSE lpad(CAST(o_orderkey AS STRING), 12, '0') END AS fphm,
       substr(o_orderpriority, 1, 1) AS fp_lb,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS je,
       CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '0.13' END AS se,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS jshj,
       o_orderstatus AS kpr,
       CAST(CAST(o_orderdate AS DATE) AS STRING) AS kprq,
       CASE WHEN o_orderkey % 79 = 0 THEN NULL ELSE replace(substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7), '-', '') END AS kpyf,
       CASE WHEN o_orderkey % 5 = 0 THEN 'null' ELSE 'M1' END AS kpjh,
       'N' AS qdbz, CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS zfbz, CAST(NULL AS STRING) AS zfsj
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
     LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS first_supp FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey
                GROUP BY l_orderkey) ON l_orderkey = o_orderkey
     JOIN {supplier} ON s_suppkey = COALESCE(first_supp, o_orderkey % 10)
"""

INV_DETAIL_SQL = """
SELECT CASE WHEN l_orderkey % 41 = 0 THEN 'null' ELSE concat('TX', lpad(CAST(l_suppkey AS STRING), 8, '0')) END AS xf_nsrsbh,
       concat('TX9', lpad(CAST(o_custkey AS STRING), 8, '0')) AS gf_nsrsbh,
       CASE WHEN l_orderkey % 43 = 0 THEN '' ELSE concat('33021', lpad(CAST(o_custkey AS STRING), 7, '0')) END AS fpdm,
       CASE WHEN l_orderkey % 61 = 0 THEN concat('33021', lpad(CAST(o_custkey AS STRING), 7, '0'))
            WHEN l_orderkey % 2 = 0 THEN lpad(CAST(l_orderkey AS STRING), 8, '0') ELSE lpad(CAST(l_orderkey AS STRING), 12, '0') END AS fphm,
       CASE WHEN l_orderkey % 47 = 0 THEN NULL WHEN l_orderkey % 53 = 0 THEN concat('-', CAST(l_linenumber AS STRING)) ELSE CAST(l_linenumber AS STRING) END AS fpmxxh,
       CASE WHEN l_partkey % 4 = 0 THEN '' ELSE lpad(CAST(l_partkey AS STRING), 19, '1') END AS flbm,
       CAST(CAST(l_shipdate AS DATE) AS STRING) AS kprq,
       CASE WHEN l_orderkey % 59 = 0 THEN '2019' ELSE replace(substr(CAST(CAST(l_shipdate AS DATE) AS STRING), 1, 7), '-', '') END AS kpyf,
       p_name AS spmc, 'EA' AS jldw,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) AS je,
       CAST(CAST(l_quantity AS DECIMAL(18,2)) AS STRING) AS se,
       CAST(CAST(l_tax AS DECIMAL(18,2)) AS STRING) AS slv,
       l_linestatus AS zfbz, 'src' AS sjly, CAST(NULL AS STRING) AS ext
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey
"""

CODE_BY_NAME_SQL = """
SELECT s_name AS row_key, CASE WHEN s_suppkey % 7 = 0 THEN 'null' ELSE concat('S', lpad(CAST(s_suppkey AS STRING), 6, '0')) END AS qybm
FROM {supplier} WHERE s_suppkey % 5 <> 0
UNION ALL
SELECT c_name, concat('C', lpad(CAST(c_custkey AS STRING), 6, '0')) FROM {customer} WHERE c_custkey % 3 <> 0
"""

CODE_BY_TAX_SQL = """
SELECT concat('TX', lpad(CAST(s_suppkey AS STRING), 8, '0')) AS row_key, concat('T', lpad(CAST(s_suppkey AS STRING), 6, '0')) AS qybm
FROM {supplier} WHERE s_suppkey % 10 <> 0
"""

CELLS_SQL = """
SELECT lpad(CAST(user_id AS STRING), 8, '0') AS row_key, 'ev' AS family, event_type AS qualifier, ts, event_id AS seq,
       CAST(CAST(value AS DECIMAL(18,2)) AS STRING) AS value FROM {events}
UNION ALL
SELECT lpad(CAST(CASE WHEN event_id % 9 = 0 THEN user_id + 70000000 ELSE user_id END AS STRING), 8, '0'), 'meta',
       CASE WHEN event_id % 2 = 0 THEN 'click' ELSE 'origin' END, ts, event_id, CAST(event_id AS STRING)
FROM {events} WHERE event_id % 3 = 0
"""

FIXTURES = {
    "inv_header": (INV_HEADER_SQL, ("orders", "customer", "lineitem", "supplier")),
    "inv_detail": (INV_DETAIL_SQL, ("lineitem", "orders", "part")),
    "code_by_name": (CODE_BY_NAME_SQL, ("supplier", "customer")),
    "code_by_tax": (CODE_BY_TAX_SQL, ("supplier",)),
    "cells": (CELLS_SQL, ("events",)),  # two families; some rows have one of them only
}
# the fact table that drives each invoice view (spread when it scans as too few tasks)
DRIVING = {"inv_header": "orders", "inv_detail": "lineitem"}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql, tables = FIXTURES[name]
    frames = {t: read_table(spark, sf_dir, t) for t in tables}
    if name in DRIVING:
        frames[DRIVING[name]] = spread(frames[DRIVING[name]])
    return spark.sql(sql, **frames)


def fixture_sql(name: str) -> str:
    """The same view as plain SQL over pre-registered tables (for DuckDB)."""
    sql, tables = FIXTURES[name]
    return sql.format(**{t: t for t in tables}).strip()


def inv_header(spark, sf_dir):
    return fixture(spark, sf_dir, "inv_header")


def inv_detail(spark, sf_dir):
    return fixture(spark, sf_dir, "inv_detail")


def code_by_name(spark, sf_dir):
    return fixture(spark, sf_dir, "code_by_name")


def code_by_tax(spark, sf_dir):
    return fixture(spark, sf_dir, "code_by_tax")


def cells(spark, sf_dir):
    return fixture(spark, sf_dir, "cells")
