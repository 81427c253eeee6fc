"""The pipeline's tables as views over the star-schema Parquet files used in tests.

Each text is valid in Spark SQL and DuckDB alike, so the checks read the same rows
on both sides.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

BASE_FILES = ("region", "nation", "customer", "orders", "lineitem", "events")

# The files' events end years after their orders; they are moved to end with them, so
# that weekly histories differ in what had been browsed.
VIEWS: dict[str, str] = {
    "customer_master": """
SELECT concat('CUST_', CAST(c_custkey AS VARCHAR(20))) AS customer_id,
       r_name AS region,
       c_mktsegment AS age_bracket
FROM customer
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
    "transactions": """
SELECT concat('TXN_', CAST(o_orderkey AS VARCHAR(20))) AS transaction_id,
       concat('CUST_', CAST(o_custkey AS VARCHAR(20))) AS customer_id,
       CAST(o_orderdate AS DATE) AS transaction_date,
       o_totalprice AS amount,
       CASE o_orderkey % 10
         WHEN 0 THEN 'Lumber' WHEN 1 THEN 'Plumbing' WHEN 2 THEN 'Electrical'
         WHEN 3 THEN 'Paint' WHEN 4 THEN 'Garden & Outdoor' WHEN 5 THEN 'Appliances'
         WHEN 6 THEN 'Hardware' WHEN 7 THEN 'Flooring' WHEN 8 THEN 'Kitchen & Bath'
         ELSE 'Lighting' END AS category,
       CASE WHEN o_orderstatus = 'O' THEN 'online' ELSE 'in_store' END AS channel,
       o_orderpriority IN ('1-URGENT', '2-HIGH') AS promo_flag,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
            THEN CAST(5 + o_orderkey % 31 AS DOUBLE) / CAST(100 AS DOUBLE)
            ELSE CAST(0 AS DOUBLE) END AS discount_pct
FROM orders""",
    "web_events": """
SELECT concat('EVT_', CAST(event_id AS VARCHAR(20))) AS event_id,
       concat('CUST_', CAST(user_id AS VARCHAR(20))) AS customer_id,
       concat('SESS_', CAST(user_id AS VARCHAR(20)), '_', CAST(CAST(ts AS DATE) AS VARCHAR(20))) AS session_id,
       CAST(CAST(ts AS DATE) - INTERVAL '8217' DAY AS DATE) AS event_date,
       CASE WHEN event_type = 'view' THEN 'product'
            WHEN event_type = 'click' THEN 'category'
            WHEN event_type = 'signup' THEN 'home'
            WHEN event_type = 'error' THEN 'search'
            WHEN value < 30 THEN 'cart' ELSE 'checkout' END AS page_type,
       CASE event_id % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END AS device,
       CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS BIGINT) AS search_flag
FROM events""",
    "loyalty": """
SELECT concat('CUST_', CAST(c_custkey AS VARCHAR(20))) AS customer_id,
       CASE WHEN c_acctbal >= 7500 THEN 'Gold' WHEN c_acctbal >= 4000 THEN 'Silver'
            WHEN c_acctbal >= 0 THEN 'Bronze' ELSE 'None' END AS loyalty_tier,
       CAST(CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal) ELSE 0 END AS BIGINT) AS points_balance
FROM customer
WHERE c_custkey % 10 <> 0""",
    "old_segments": """
SELECT concat('CUST_', CAST(c_custkey AS VARCHAR(20))) AS customer_id,
       CAST(CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2
            WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END AS BIGINT) AS old_segment_id,
       c_mktsegment AS segment_name,
       DATE '2023-01-15' AS assignment_date
FROM customer""",
    "campaigns": """
SELECT concat('CAMP_', CAST(l_linenumber AS VARCHAR(20))) AS campaign_id,
       concat('Campaign_', CAST(l_linenumber AS VARCHAR(20))) AS campaign_name,
       CASE l_linenumber % 3 WHEN 0 THEN 'sms' WHEN 1 THEN 'email' ELSE 'push' END AS channel,
       CAST(l_shipdate AS DATE) AS send_date,
       concat('CUST_', CAST(o_custkey AS VARCHAR(20))) AS customer_id,
       CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS BIGINT) AS opened,
       CAST(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 1 ELSE 0 END AS BIGINT) AS clicked,
       CAST(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' AND l_quantity > 35 THEN 1 ELSE 0 END AS BIGINT) AS converted,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' AND l_quantity > 35
            THEN l_extendedprice ELSE CAST(0 AS DOUBLE) END AS revenue
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey""",
    # A stand-in assignment, for tests of the reports alone.
    "segment_assignments": """
SELECT customer_id, CAST(old_segment_id - 1 AS BIGINT) AS segment_id,
       CASE old_segment_id WHEN 1 THEN 'Weekend Warriors' WHEN 2 THEN 'Project Planners'
            WHEN 3 THEN 'Price Hunters' WHEN 4 THEN 'Loyal Regulars'
            ELSE 'Dormant / At-Risk' END AS segment_name,
       DATE '2001-08-01' AS assignment_date
FROM old_segments""",
}


@lru_cache(maxsize=16)
def sample_tables(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """The six base tables and the stand-in assignment over one data directory."""
    for name in BASE_FILES:
        spark.read.parquet(f"{directory}/{name}.parquet").createOrReplaceTempView(name)
    tables = {}
    for name, text in VIEWS.items():
        tables[name] = spark.sql(text)
        tables[name].createOrReplaceTempView(name)
    return tables
