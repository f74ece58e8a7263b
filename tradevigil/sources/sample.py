"""Views that give the sample TPC-H-like parquet tables the shape of the five feeds.

The SQL text runs unchanged in Spark and in other ANSI engines, so that a check
in another engine starts from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SAMPLE_TABLES = ("nation", "customer", "part", "orders", "lineitem", "events")

FEED_SQL = {
    "clients_raw": """
SELECT concat('C', CAST(c_custkey AS STRING)) AS client_id, c_name AS name, n_name AS country,
 CASE WHEN c_acctbal < 0 THEN 'High' WHEN c_acctbal < 3000 THEN 'Medium' ELSE 'Low' END AS risk_rating
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "client_sends": """
SELECT concat('C', CAST(c_custkey AS STRING)) AS client_id, c_name AS name, n_name AS country, risk_rating, sent FROM (
 SELECT *, CASE WHEN c_acctbal < 0 THEN 'High' WHEN c_acctbal < 3000 THEN 'Medium' ELSE 'Low' END AS risk_rating, DATE '1992-01-01' AS sent FROM {customer}
 UNION ALL SELECT *, CASE WHEN c_acctbal < 5000 THEN 'High' ELSE 'Medium' END AS risk_rating, DATE '1995-06-17' AS sent FROM {customer} WHERE c_custkey % 3 = 0
 UNION ALL SELECT *, 'Low' AS risk_rating, DATE '1997-03-01' AS sent FROM {customer} WHERE c_custkey % 9 = 0) x
JOIN {nation} ON c_nationkey = n_nationkey""",
    "instruments_raw": """
SELECT concat('I', CAST(MIN(p_partkey) AS STRING)) AS instrument_id, p_brand AS underlying, p_type AS isin, p_type AS sector
FROM {part} GROUP BY p_brand, p_type""",
    "trades_raw": """
SELECT concat('SWP', CAST(o_orderkey AS STRING)) AS trade_id, CAST(o_orderdate AS DATE) AS trade_date,
 CAST(o_orderdate AS DATE) + 2 AS booking_date, o_orderstatus AS trade_status,
 CASE WHEN o_orderkey % 3 = 0 THEN 'TRS' ELSE 'EQS' END AS product_type, p_brand AS underlying,
 CASE WHEN o_orderkey % 9 = 0 THEN concat(p_type, ' (unlisted)') ELSE p_type END AS isin, 'USD' AS currency,
 CAST(CAST(o_totalprice AS DECIMAL(20,2)) * 2500 AS DOUBLE) AS notional, CAST(p_size AS DOUBLE) AS quantity, p_retailprice AS price,
 CASE WHEN o_orderkey % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS direction, concat('C', CAST(o_custkey AS STRING)) AS client_id, c_name AS client_name,
 concat('T', CAST(o_orderkey % 40 AS STRING)) AS trader_id, c_mktsegment AS desk, concat('LE', CAST(c_nationkey % 5 AS STRING)) AS legal_entity,
 concat('PF', CAST(o_custkey % 10 AS STRING)) AS portfolio, CAST(o_orderkey % 7 AS DOUBLE) / 8 AS dividend_rate, CAST(o_orderkey % 11 AS DOUBLE) / 16 AS financing_spread,
 CAST(o_orderdate AS DATE) + 365 AS maturity_date,
 CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 400000 THEN 'Insider' ELSE 'Normal' END AS risk_flag,
 CASE WHEN o_orderpriority = '1-URGENT' THEN 'High' WHEN o_orderpriority = '3-MEDIUM' THEN 'Medium' ELSE 'Low' END AS jurisdiction_risk
FROM {orders} JOIN {part} ON p_partkey = o_orderkey % (SELECT COUNT(*) FROM {part}) JOIN {customer} ON c_custkey = o_custkey""",
    "events_raw": """
SELECT concat('E', CAST(event_id AS STRING)) AS event_id, concat('Brand#', CAST(1 + user_id % 30 AS STRING)) AS underlying,
 CASE WHEN event_type = 'purchase' THEN 'Earnings Release' ELSE event_type END AS event_type,
 DATE '1995-01-01' + CAST((event_id * 37) % 2400 AS INT) AS event_date,
 CASE WHEN value >= 20 THEN 'High' ELSE 'Low' END AS importance
FROM {events}""",
    "relationships_raw": """
SELECT concat('C', CAST(a AS STRING)) AS from_client, concat('C', CAST(b AS STRING)) AS to_client,
 CASE WHEN l_partkey % 2 = 0 THEN 'FAMILY' ELSE 'SHARED_DIRECTOR' END AS relationship FROM (
 SELECT l_partkey, o_custkey AS a, LEAD(o_custkey) OVER (PARTITION BY l_partkey ORDER BY bought DESC, o_custkey) AS b,
 ROW_NUMBER() OVER (PARTITION BY l_partkey ORDER BY bought DESC, o_custkey) AS place
 FROM (SELECT l_partkey, o_custkey, SUM(CAST(l_quantity AS DECIMAL(20,2))) AS bought FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey GROUP BY l_partkey, o_custkey) x) y
WHERE place <= 2 AND b IS NOT NULL""",
}


def feed_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the five feeds as a DataFrame over the parquet files in `sf_dir`."""
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in SAMPLE_TABLES if f"{{{t}}}" in FEED_SQL[name]}
    return spark.sql(FEED_SQL[name], **used)


def feed_cte(name: str) -> str:
    """The same feed as SQL text over tables named like the files."""
    return FEED_SQL[name].format(**{t: t for t in SAMPLE_TABLES})
