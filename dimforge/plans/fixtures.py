"""Staged relations derived from the driver's TPC-H-like tables.

The warehouse transforms consume nine staged relations (company, people,
acquisition, funding_rounds, investments, relationship, ipo, funds,
milestones).  These recipes derive look-alikes of them from the base
tables, deterministically and over the whole base tables, and plant the
hazards the transforms must handle: prefix collisions (``c:5`` vs ``f:5``),
malformed and missing keys, duplicate keys, empty strings, NULL and zero
values, dangling references, bad URLs, bare tickers, ``NaN`` text,
accents and mojibake.

Each text is plain SQL that runs unchanged in Spark SQL and in DuckDB, so
the same relation can be rebuilt by an independent engine for checking.
Timestamps are staged as text (as they arrive from CSV); the transforms
parse them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from dimforge.schemas import STAGED_DDL

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

FIXTURE_SQL: dict[str, str] = {}

FIXTURE_SQL["st_company"] = """
WITH b AS (SELECT c_custkey AS k, c_name, c_mktsegment, n_name, r_name FROM customer
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
u AS (SELECT b.*, k AS office, 'c:' || CAST(k AS STRING) AS object_id, 0 AS v FROM b
  UNION ALL SELECT b.*, k + 1000000, 'f:' || CAST(k AS STRING), 1 FROM b WHERE k % 20 = 0
  UNION ALL SELECT b.*, k + 2000000, 'c:' || CAST(k AS STRING), 2 FROM b WHERE k % 17 = 0
  UNION ALL SELECT b.*, k + 3000000, CASE WHEN k % 2 = 0 THEN '' ELSE CAST(k AS STRING) END, 3 FROM b WHERE k % 97 = 0)
SELECT CAST(office AS INT) AS office_id, object_id,
  CASE WHEN k % 5 = 0 THEN '' WHEN k % 7 = 0 THEN 'CafÃ© ' || c_mktsegment ELSE ' ' || c_mktsegment || ' ' END AS description,
  r_name AS region, CASE WHEN k % 6 = 0 THEN '' ELSE c_name END AS address1, '' AS address2, n_name AS city,
  CASE WHEN k % 9 = 0 THEN '' ELSE CAST(10000 + k AS STRING) END AS zip_code,
  CASE WHEN k % 3 = 0 THEN '' ELSE 'ST' END AS state_code, 'C' || CAST(k % 25 AS STRING) AS country_code,
  CASE WHEN k % 13 = 0 THEN CAST(0 AS DECIMAL(9,6)) WHEN k % 29 = 0 THEN NULL ELSE CAST((k % 120) - 60.5 AS DECIMAL(9,6)) END AS latitude,
  CASE WHEN k % 31 = 0 THEN CAST(0 AS DECIMAL(9,6)) ELSE CAST((k % 340) - 170.25 AS DECIMAL(9,6)) END AS longitude,
  '2007-01-01 22:19:54' AS created_at, '200' || CAST(7 + v % 3 AS STRING) || '-01-01 22:19:54' AS updated_at
FROM u
"""

FIXTURE_SQL["st_people"] = """
WITH u AS (SELECT s_suppkey AS k, s_name, s_nationkey, 0 AS v FROM supplier
  UNION ALL SELECT s_suppkey, s_name, s_nationkey, 1 FROM supplier WHERE s_suppkey % 10 = 0)
SELECT CAST(k + v * 1000000 AS STRING) AS people_id, 'p:' || CAST(k AS STRING) AS object_id,
  CASE WHEN k % 11 = 0 THEN '' ELSE 'José-' || CAST(k AS STRING) END AS first_name,
  CASE WHEN k % 11 = 0 OR k % 4 = 0 THEN '' ELSE s_name END AS last_name,
  CASE WHEN k % 3 = 0 THEN 'Zürich, ' || CAST(s_nationkey AS STRING) ELSE '' END AS birthplace,
  CASE WHEN k % 8 = 0 THEN '' ELSE 'Acme & Co. #' || CAST(k AS STRING) END AS affiliation_name
FROM u
"""

FIXTURE_SQL["st_acquisition"] = """
SELECT CAST(o_orderkey AS INT) AS acquisition_id, 'c:' || CAST(o_custkey AS STRING) AS acquiring_object_id,
  'c:' || CAST((o_orderkey * 7) % (SELECT CAST(FLOOR(COUNT(*) * 18 / 15.0) AS BIGINT) FROM customer) AS STRING) AS acquired_object_id, 'cash' AS term_code,
  CASE WHEN o_orderkey % 4 = 0 THEN CAST(0 AS DECIMAL(15,2)) WHEN o_orderkey % 15 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(15,2)) END AS price_amount,
  CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE 'USD' END AS price_currency_code,
  CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS acquired_at,
  CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE 'http://x/' || CAST(o_orderkey AS STRING) END AS source_url,
  '' AS source_description, '2013-12-12 12:38:35' AS created_at, '2013-12-12 12:38:35' AS updated_at
FROM orders
"""

FIXTURE_SQL["st_funding_rounds"] = """
SELECT CAST(o_orderkey AS INT) AS funding_round_id,
  CASE WHEN o_orderkey % 10 = 3 THEN 'p:' || CAST(o_custkey % (SELECT CAST(FLOOR(COUNT(*) * 12 / 10.0) AS BIGINT) FROM supplier) AS STRING) WHEN o_orderkey % 10 = 6 THEN 'f:' || CAST(o_custkey AS STRING)
       WHEN o_orderkey % 50 = 9 THEN '' ELSE 'c:' || CAST(o_custkey AS STRING) END AS object_id,
  CASE WHEN o_orderkey % 40 = 1 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS funded_at,
  CASE o_orderstatus WHEN 'F' THEN 'venture' WHEN 'O' THEN 'series-a' ELSE '' END AS funding_round_type,
  CASE o_orderstatus WHEN 'F' THEN 'b' WHEN 'O' THEN 'a' ELSE '' END AS funding_round_code,
  CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(15,2)) END AS raised_amount_usd,
  CAST(o_totalprice AS DECIMAL(15,2)) AS raised_amount,
  CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE 'EUR' END AS raised_currency_code,
  CAST(NULL AS DECIMAL(15,2)) AS pre_money_valuation_usd, CAST(NULL AS DECIMAL(15,2)) AS pre_money_valuation,
  '' AS pre_money_currency_code,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_totalprice AS DECIMAL(15,2)) END AS post_money_valuation_usd,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_totalprice AS DECIMAL(15,2)) END AS post_money_valuation,
  CASE WHEN o_orderkey % 3 = 0 THEN 'GBP' ELSE '' END AS post_money_currency_code,
  CAST(o_orderkey % 33 AS STRING) AS participants, FALSE AS is_first_round, FALSE AS is_last_round,
  CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'http://r/' || CAST(o_orderkey AS STRING) END AS source_url,
  CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE 'Raises round ' || CAST(o_orderkey AS STRING) END AS source_description,
  '' AS created_by, '2007-07-18 15:56:25' AS created_at, '2011-10-23 04:04:39' AS updated_at
FROM orders
"""

FIXTURE_SQL["st_investments"] = """
SELECT DISTINCT CAST(l_orderkey * 10 + l_linenumber AS INT) AS investment_id, CAST(l_orderkey AS INT) AS funding_round_id,
  'c:' || CAST((l_orderkey * 3 + l_linenumber) % (SELECT CAST(FLOOR(COUNT(*) * 17 / 15.0) AS BIGINT) FROM customer) AS STRING) AS funded_object_id,
  CASE l_linenumber % 3 WHEN 0 THEN 'p:' WHEN 1 THEN 'c:' ELSE 'f:' END || CAST((l_orderkey + l_linenumber * 11) % (SELECT CAST(FLOOR(COUNT(*) * 16 / 15.0) AS BIGINT) FROM customer) AS STRING) AS investor_object_id,
  '2007-07-18 15:56:25' AS created_at, '2013-05-30 10:36:47' AS updated_at
FROM lineitem
"""

FIXTURE_SQL["st_relationship"] = """
SELECT CAST(MIN(l_orderkey * 10 + l_linenumber) AS STRING) AS relationship_id, 'p:' || CAST(l_suppkey + l_linenumber % 2 * 15 AS STRING) AS person_object_id,
  'c:' || CAST(l_partkey AS STRING) AS relationship_object_id, CAST(CAST(MIN(l_shipdate) AS DATE) AS STRING) || ' 00:00:00.000' AS start_at,
  CASE WHEN COUNT(*) % 2 = 0 THEN '' ELSE CAST(CAST(MAX(l_shipdate) AS DATE) AS STRING) || ' 00:00:00.000' END AS end_at,
  'false' AS is_past, CAST(l_linenumber AS STRING) AS sequence,
  CASE WHEN l_partkey % 25 = 0 THEN '' ELSE 'VP, Sales/Ops & R&D  (' || CAST(l_linenumber AS STRING) || ')' END AS title,
  CAST(CAST(MIN(l_shipdate) AS DATE) AS STRING) || ' 08:00:00.000' AS created_at,
  CAST(CAST(MAX(l_shipdate) AS DATE) AS STRING) || ' 09:30:00.000' AS updated_at
FROM lineitem GROUP BY l_suppkey, l_linenumber, l_partkey
"""

FIXTURE_SQL["st_ipo"] = """
SELECT CAST(p_partkey AS STRING) AS ipo_id, CASE WHEN p_partkey % 12 = 5 THEN 'f:' ELSE 'c:' END || CAST(p_partkey AS STRING) AS object_id,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_retailprice AS DECIMAL(15,2)) END AS valuation_amount,
  CASE WHEN p_partkey % 4 = 0 THEN '' ELSE 'GBP' END AS valuation_currency_code,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_retailprice AS DECIMAL(15,2)) END AS raised_amount,
  CASE WHEN p_partkey % 6 = 0 THEN '' ELSE 'USD' END AS raised_currency_code,
  CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE CAST('2011-12-27' AS DATE) END AS public_at,
  CASE WHEN p_partkey % 7 = 0 THEN CAST(78340 + p_partkey AS STRING) WHEN p_partkey % 11 = 0 THEN '' ELSE 'NASDAQ:S' || CAST(p_partkey AS STRING) END AS stock_symbol,
  CASE WHEN p_partkey % 8 = 0 THEN '' ELSE 'http://ipo/' || CAST(p_partkey AS STRING) END AS source_url,
  p_name AS source_description, '2009-12-16 10:41:51' AS created_at, '2009-12-16 10:41:51' AS updated_at
FROM part
"""

FIXTURE_SQL["st_funds"] = """
SELECT CAST(s_suppkey AS STRING) AS fund_id, 'f:' || CAST(s_suppkey AS STRING) AS object_id, s_name AS name,
  CASE WHEN s_suppkey % 13 = 0 THEN '' ELSE '2012-04-17' END AS funded_at, CAST(s_acctbal AS DECIMAL(15,2)) AS raised_amount,
  CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE 'USD' END AS raised_currency_code,
  CASE s_suppkey % 4 WHEN 0 THEN 'ttp://broken' WHEN 1 THEN '' ELSE 'https://x.org/' || CAST(s_suppkey AS STRING) END AS source_url,
  CASE WHEN s_suppkey % 6 = 0 THEN '' ELSE 'Closes $59M (Fund ' || CAST(s_suppkey AS STRING) || ')!' END AS source_description,
  '2010-01-31 09:30:06' AS created_at, '2011-06-16 14:28:18' AS updated_at
FROM supplier
"""

FIXTURE_SQL["st_milestones"] = """
SELECT event_id AS milestone_id, CASE WHEN event_id % 9 = 4 THEN 'f:' ELSE 'c:' END || CAST((user_id * 37 + event_id) % (SELECT CAST(FLOOR(COUNT(*) * 17 / 15.0) AS BIGINT) FROM customer) AS STRING) AS object_id,
  CAST(CAST(ts AS DATE) AS STRING) AS milestone_at, event_type AS milestone_code, 'Did: ' || event_type || ' ' || props AS description,
  CASE event_id % 4 WHEN 0 THEN 'NaN' WHEN 1 THEN 'www://bad' ELSE 'http://m/' || CAST(event_id AS STRING) END AS source_url,
  CASE WHEN event_id % 5 = 0 THEN 'NaN' ELSE props END AS source_description,
  CAST(CAST(ts AS DATE) AS STRING) || ' 23:08:38.000' AS created_at,
  CAST(CAST(ts AS DATE) AS STRING) || ' 01:20:43.000' AS updated_at
FROM events
"""



def _with_older_copies(view: str, staged_name: str, where: str, **changed: str) -> None:
    """Add an older, differing copy of some rows: the keyed dedupe must drop it."""
    cols = [c.split()[0] for c in re.sub(r"\([^)]*\)", "", STAGED_DDL[staged_name]).split(",")]
    copy = ", ".join(f"{changed[c]} AS {c}" if c in changed else c for c in cols)
    FIXTURE_SQL[view] = (f"WITH base AS ({FIXTURE_SQL[view]}) SELECT {', '.join(cols)} FROM base "
                         f"UNION ALL SELECT {copy} FROM base WHERE {where}")


_OLD = "'2001-02-03 04:05:06'"
_with_older_copies("st_acquisition", "acquisition", "acquisition_id % 23 = 0", updated_at=_OLD, term_code="'stock'")
_with_older_copies("st_funding_rounds", "funding_rounds", "funding_round_id % 29 = 0", updated_at=_OLD,
                   raised_currency_code="'JPY'")
_with_older_copies("st_investments", "investments", "investment_id % 31 = 0", updated_at=_OLD, funded_object_id="'c:1'")
_with_older_copies("st_ipo", "ipo", "CAST(ipo_id AS INT) % 19 = 0", updated_at=_OLD, raised_currency_code="'JPY'")
_with_older_copies("st_funds", "funds", "CAST(fund_id AS INT) % 9 = 0", updated_at=_OLD, name="'older name'")
_with_older_copies("st_milestones", "milestones", "milestone_id % 37 = 0", updated_at="'2001-02-03 04:05:06.000'",
                   milestone_code="'older'")

# base tables the recipes read
FIXTURE_BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# staged relation name -> fixture view
STAGED = {
    "company": "st_company", "people": "st_people", "acquisition": "st_acquisition",
    "funding_rounds": "st_funding_rounds", "investments": "st_investments",
    "relationship": "st_relationship", "ipo": "st_ipo", "funds": "st_funds",
    "milestones": "st_milestones",
}


def register_base_tables(spark: SparkSession, data_dir: str, tables=BASE_TABLES) -> None:
    """Register the driver's parquet tables as temp views."""
    for t in tables:
        spark.read.parquet(f"{data_dir.rstrip('/')}/{t}.parquet").createOrReplaceTempView(t)


def fixture(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """One staged relation (``'company'`` or ``'st_company'``) as a DataFrame."""
    view = name if name.startswith("st_") else STAGED[name]
    register_base_tables(spark, data_dir, FIXTURE_BASE)
    return spark.sql(FIXTURE_SQL[view])


def staged(spark: SparkSession, data_dir: str) -> dict[str, DataFrame]:
    """All nine staged relations, keyed by staged name (``company`` ...)."""
    register_base_tables(spark, data_dir, FIXTURE_BASE)
    return {name: spark.sql(FIXTURE_SQL[view]) for name, view in STAGED.items()}
