"""Oracle SQL for the load-path queries."""

from __future__ import annotations

from dimforge import schemas as S
from oracle.duckdb_sql import with_ctes
from oracle.ops import OPS, _cols

WAREHOUSE = ("dim_company", "dim_people", "dim_funding_rounds", "dim_milestones", "fact_acquisition", "fact_relationship", "fact_ipo",
             "fact_investments", "dim_funds")

LOAD: dict[str, str] = {}


def _broken(table: str, extra: str = "") -> str:
    """The violated constraints of a row as one text (NULL: none)."""
    parts = [f"CASE WHEN {c} IS NULL THEN '{c} is NULL' END" for c in S.NOT_NULL.get(table, [])]
    parts += [f"CASE WHEN length({c}) > {n} THEN '{c} is longer than {n}' END" for c, n in S.MAX_LENGTH.get(table, {}).items()]
    parts += [f"CASE WHEN {c} IS NOT NULL AND TRY_CAST({c} AS DECIMAL(15,2)) IS NULL THEN '{c} exceeds numeric(15,2)' END"
              for c in S.NUMERIC_15_2.get(table, [])]
    return f"NULLIF(array_to_string(list_filter(CAST([{', '.join(parts + ([extra] if extra else []))}] AS VARCHAR[]), lambda x: x IS NOT NULL), '; '), '')"


def _ctes(select: str, *more: str) -> str:
    """``batch`` (planted company rows) and ``judged`` (with what they break) before ``select``."""
    steps = [
        "batch AS (SELECT * FROM dim_company"
        " UNION ALL SELECT * REPLACE (company_id + 10000000 AS company_id, repeat('x', 256) AS description) FROM dim_company"
        " UNION ALL SELECT * REPLACE (company_id + 20000000 AS company_id, CAST(NULL AS VARCHAR) AS company_entity_type) FROM dim_company"
        " UNION ALL SELECT * REPLACE (company_id + 30000000 AS company_id) FROM dim_company)",
        f"single AS (SELECT *, {_broken('dim_company')} AS broken1 FROM batch)",
        "judged AS (SELECT *, COALESCE(broken1, CASE WHEN company_object_id IS NOT NULL AND company_id <> "
        "max(CASE WHEN broken1 IS NULL THEN company_id END) OVER (PARTITION BY company_object_id) "
        "THEN 'company_object_id is not unique' END) AS broken FROM single)",
        *more]
    return with_ctes(f"SELECT * FROM (WITH {', '.join(steps)} {select})", "dim_company")


LOAD["enforce_row_checks"] = _ctes("SELECT company_id, broken FROM judged")
LOAD["enforce_foreign_key"] = with_ctes(
    f"SELECT ipo_id, {_broken('fact_ipo', '''CASE WHEN ipo_object_id IS NOT NULL AND ipo_object_id NOT IN (SELECT company_object_id FROM dim_company WHERE company_object_id IS NOT NULL) THEN 'ipo_object_id is not in dim_company.company_object_id' END''')} AS broken FROM ipo_checked",
    "ipo_checked", "dim_company")
# the largest key kept each company; the second load renames these and brings new keys for the same companies
_LOADED = "loaded AS (SELECT * EXCLUDE (broken, broken1) FROM judged WHERE broken IS NULL)"
LOAD["upsert_enforced"] = _ctes("SELECT * REPLACE (region || '~' AS region) FROM loaded", _LOADED)
LOAD["quarantine_enforced"] = _ctes("""
SELECT CAST(company_id AS VARCHAR) AS record_id, broken AS reason FROM judged WHERE broken IS NOT NULL
UNION ALL SELECT CAST(company_id AS VARCHAR), broken FROM second WHERE broken IS NOT NULL""", f"""
second0 AS (SELECT * REPLACE (company_id + 30000000 AS company_id, region || '~' AS region) FROM dim_company),
second1 AS (SELECT * FROM second0 UNION ALL SELECT * REPLACE (company_id + 40000000 AS company_id) FROM second0),
second2 AS (SELECT *, {_broken('dim_company')} AS broken1 FROM second1),
second AS (SELECT s.company_id, COALESCE(s.broken1, CASE WHEN t.company_id <> s.company_id
  THEN 'company_object_id is not unique in the table' END) AS broken
  FROM second2 s LEFT JOIN (SELECT company_id, company_object_id FROM judged WHERE broken IS NULL) t USING (company_object_id))""")
LOAD["warehouse_enforced_counts"] = with_ctes(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) FILTER (WHERE {_broken(t)} IS NULL) AS n_rows FROM {t}" for t in WAREHOUSE), *WAREHOUSE)

# ------------------------------------------------------------------ targets laid out by key
_ROUNDS = """b AS (
  SELECT funding_round_id, round_type, CAST(raised_amount_usd + 1 AS DECIMAL(15,2)) AS raised_amount_usd FROM dim_funding_rounds
  WHERE funding_round_id >= (SELECT (min(funding_round_id) + max(funding_round_id)) // 2 FROM dim_funding_rounds)
), batch AS (
  SELECT * FROM b UNION ALL SELECT * REPLACE (CAST(funding_round_id + (SELECT max(funding_round_id) FROM dim_funding_rounds) AS INTEGER) AS funding_round_id) FROM b
), after AS (
  SELECT t.* REPLACE (coalesce(i.raised_amount_usd, t.raised_amount_usd) AS raised_amount_usd) FROM dim_funding_rounds t LEFT JOIN batch i USING (funding_round_id)
  UNION ALL BY NAME SELECT * FROM batch WHERE funding_round_id NOT IN (SELECT funding_round_id FROM dim_funding_rounds)
)"""
LOAD["upsert_bucketed"] = with_ctes(f"SELECT * FROM (WITH {_ROUNDS} SELECT * FROM after)", "dim_funding_rounds")
LOAD["upsert_partitioned"] = with_ctes(
    f"SELECT * FROM (WITH {_ROUNDS} SELECT *, funding_round_id // 1000 NOT IN (SELECT funding_round_id // 1000 FROM batch) AS kept_file FROM after)",
    "dim_funding_rounds")

# ------------------------------------------------------------------ sources and profiles
LOAD["src_api"] = OPS["filter_date_range"]
LOAD["src_api_outcomes"] = with_ctes("""
SELECT CAST(w AS DATE) AS window_start, count(milestone_id) AS n_records,
  CASE CAST(w AS DATE) WHEN DATE '2023-12-28' THEN 'bad_status' WHEN DATE '2023-12-29' THEN 'malformed'
    WHEN DATE '2023-12-30' THEN 'empty' WHEN DATE '2023-12-31' THEN 'transport_error' ELSE 'ok' END AS outcome,
  CASE CAST(w AS DATE) WHEN DATE '2023-12-28' THEN 503 WHEN DATE '2023-12-31' THEN NULL ELSE 200 END AS status
FROM generate_series(TIMESTAMP '2023-12-28', TIMESTAMP '2024-01-21', INTERVAL 1 DAY) AS g(w)
LEFT JOIN st_milestones ON TRY_CAST(milestone_at AS DATE) = CAST(w AS DATE) GROUP BY w""", "st_milestones")
LOAD["src_catalog"] = OPS["src_all_tables"]
LOAD["src_csv_rows"] = with_ctes(
    "SELECT acquisition_id, acquiring_object_id, acquired_object_id, price_amount, acquired_at FROM st_acquisition", "st_acquisition")
LOAD["src_csv_bad_rows"] = with_ctes(f"""
SELECT CAST(acquisition_id AS VARCHAR) AS first_value, 'too many columns: {len(_cols('acquisition')) + 1}' AS reason FROM st_acquisition
UNION ALL SELECT CAST(acquisition_id AS VARCHAR), 'too few columns: 1' FROM st_acquisition
UNION ALL SELECT 'x' || CAST(acquisition_id AS VARCHAR), 'acquisition_id is no int' FROM st_acquisition""", "st_acquisition")
LOAD["profile_merged"] = f"SELECT * EXCLUDE (unique_count), TRUE AS distinct_close FROM ({OPS['profile_lineitem']})"
LOAD["profile_documents"] = ("SELECT table_name, n_rows, n_cols, column_name, data_type, unique_count, null_count, "
                             f"percentage_missing_value, min_value, max_value, percentage_valid_date FROM ({OPS['profile_all']})")
LOAD["fk_runtime_filter"] = with_ctes(
    "SELECT * FROM investments_pre WHERE funding_round_id IN (SELECT funding_round_id FROM rounds_clean WHERE raised_currency <> 'USD')",
    "investments_pre", "rounds_clean")
