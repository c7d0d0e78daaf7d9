"""Oracle SQL for the single-operator queries."""

from __future__ import annotations

from dimforge import schemas as S
from dimforge.plans.fixtures import STAGED
from oracle.duckdb_sql import (clean_alpha, clean_text, desc, dt, fix_enc, ident, normalize, nz, prefix,
                               survivor, symbol, table, ts, url, with_ctes)

OPS: dict[str, str] = {}

KEY_COLUMNS = [("st_company", "object_id"), ("st_people", "object_id"),
               ("st_acquisition", "acquiring_object_id"), ("st_acquisition", "acquired_object_id"),
               ("st_funding_rounds", "object_id"), ("st_investments", "funded_object_id"),
               ("st_investments", "investor_object_id"), ("st_relationship", "person_object_id"),
               ("st_relationship", "relationship_object_id"), ("st_ipo", "object_id"),
               ("st_funds", "object_id"), ("st_milestones", "object_id")]


def _keys(expr, alias):
    sel = " UNION ALL ".join(
        f"SELECT '{fx}.{c}' AS source, {c} AS raw, {expr(c)} AS {alias} FROM {fx}" for fx, c in KEY_COLUMNS)
    return with_ctes(sel, *sorted({fx for fx, _ in KEY_COLUMNS}))


OPS["entity_prefix"] = _keys(prefix, "entity_type")
OPS["entity_id"] = _keys(ident, "object_id")
OPS["clean_integer"] = _keys(
    lambda c: f"(CASE WHEN regexp_matches({c}, '^[a-zA-Z]:[0-9]+') "
              f"THEN TRY_CAST(regexp_extract({c}, '^[a-zA-Z]:([0-9]+)', 1) AS INTEGER) END)", "object_id")
OPS["stock_market"] = with_ctes(f"SELECT ipo_id, {prefix('stock_symbol')} AS stock_market FROM st_ipo", "st_ipo")
OPS["stock_symbol"] = with_ctes(f"SELECT ipo_id, {symbol('stock_symbol')} AS stock_symbol FROM st_ipo", "st_ipo")
for _name, _fn in (("clean_text", clean_text), ("normalize_text", normalize), ("clean_alpha_text", clean_alpha),
                   ("fix_encoding", fix_enc)):
    OPS[_name] = f"SELECT doc_id, {_fn('text')} AS {_name} FROM documents"
OPS["clean_text_company"] = with_ctes(
    "SELECT office_id, " + ", ".join(f"{clean_text(c)} AS {c}" for c in ("description", "address1", "zip_code",
                                                                          "region")) + " FROM st_company",
    "st_company")

# ------------------------------------------------------------------ projections, casts, nulls


def _cols(name):
    return [(p.strip().split(" ")[0], p.strip().split(" ", 1)[1]) for p in _split_ddl(S.STAGED_DDL[name])]


def _split_ddl(ddl):
    out, depth, cur = [], 0, ""
    for ch in ddl:
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        if ch == "," and depth == 0:
            out.append(cur)
            cur = ""
        else:
            cur += ch
    out.append(cur)
    return out


def _nullified(name, *sentinels):
    sel = []
    for c, t in _cols(name):
        if t == "string":
            e = c
            for s_ in sentinels:
                e = f"NULLIF({e}, '{s_}')"
            sel.append(f"{e} AS {c}")
        else:
            sel.append(c)
    return ", ".join(sel)


OPS["project_rename"] = with_ctes(
    "SELECT ipo_id, object_id AS ipo_object_key, valuation_currency_code AS valuation_currency, "
    "raised_currency_code AS raised_currency FROM st_ipo", "st_ipo")
OPS["empty_to_null"] = with_ctes(f"SELECT {_nullified('company', '')} FROM st_company", "st_company")
OPS["nan_to_null"] = with_ctes(f"SELECT {_nullified('milestones', '', 'NaN')} FROM st_milestones", "st_milestones")
OPS["cast_decimal"] = with_ctes(
    "SELECT acquisition_id, TRY_CAST(price_amount AS DECIMAL(7,2)) AS price_7_2, "
    "TRY_CAST(CAST(acquisition_id AS VARCHAR) AS DECIMAL(9,6)) AS id_9_6 FROM st_acquisition", "st_acquisition")
OPS["cast_int"] = with_ctes(
    "SELECT relationship_id, TRY_CAST(relationship_id AS INTEGER) AS relationship_int, "
    "TRY_CAST(sequence AS INTEGER) AS sequence_int, TRY_CAST(title AS INTEGER) AS title_int FROM st_relationship",
    "st_relationship")
OPS["parse_date"] = with_ctes(
    f"SELECT relationship_id, {dt('start_at')} AS start_date, {dt('end_at')} AS end_date, "
    f"{dt('title')} AS title_date FROM st_relationship", "st_relationship")
OPS["parse_timestamp"] = with_ctes(
    f"SELECT relationship_id, {ts('created_at')} AS created_ts, {ts('end_at')} AS end_ts FROM st_relationship",
    "st_relationship")
_fill = {"valuation_amount": "0", "valuation_currency_code": "'USD'", "raised_amount": "0",
         "raised_currency_code": "'USD'", "source_url": "'Unknown'", "public_at": "DATE '1970-01-01'"}
OPS["fill_defaults"] = with_ctes(
    "SELECT " + ", ".join(
        (f"COALESCE({nz(c) if t == 'string' else c}, {_fill[c]}) AS {c}" if c in _fill
         else (f"{nz(c)} AS {c}" if t == "string" else c)) for c, t in _cols("ipo")) + " FROM st_ipo", "st_ipo")
OPS["drop_null_rows"] = with_ctes(
    "SELECT * FROM st_acquisition WHERE acquired_at IS NOT NULL AND price_amount IS NOT NULL", "st_acquisition")
OPS["full_name"] = with_ctes(
    f"SELECT people_id, concat_ws(' ', {nz('first_name')}, {nz('last_name')}) AS full_name FROM st_people",
    "st_people")
OPS["normalize_entity_type"] = with_ctes(
    f"SELECT funding_round_id, CASE WHEN {prefix(nz('object_id'))} IN ('c', 'p') THEN {prefix(nz('object_id'))} "
    f"ELSE 'c' END AS entity_type FROM st_funding_rounds", "st_funding_rounds")
OPS["valid_url"] = with_ctes(f"SELECT milestone_id, {url('source_url')} AS source_url FROM st_milestones",
                             "st_milestones")

# ------------------------------------------------------------------ filters
OPS["filter_geo"] = with_ctes("SELECT * FROM st_company WHERE latitude <> 0 AND longitude <> 0", "st_company")
OPS["filter_neq"] = with_ctes("SELECT * FROM st_acquisition WHERE price_amount <> 0", "st_acquisition")
OPS["filter_eq"] = with_ctes(f"SELECT * FROM st_ipo WHERE {prefix('object_id')} = 'c'", "st_ipo")
OPS["filter_notnull"] = OPS["drop_null_rows"]
OPS["filter_null_or"] = with_ctes(
    "SELECT * FROM st_acquisition WHERE acquired_at IS NULL OR price_amount IS NULL", "st_acquisition")
OPS["filter_date_range"] = with_ctes(
    f"SELECT * FROM st_milestones WHERE {dt('milestone_at')} BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'",
    "st_milestones")

# ------------------------------------------------------------------ joins
OPS["fk_valid_milestones"] = table("dim_milestones")
OPS["fk_invalid_milestones"] = with_ctes(
    "SELECT * EXCLUDE (in_company) FROM milestones_checked WHERE NOT in_company", "milestones_checked")
OPS["fk_valid_ipo"] = table("fact_ipo")
OPS["fk_invalid_ipo"] = with_ctes(
    "SELECT * EXCLUDE (is_company, in_company) FROM ipo_checked WHERE is_company AND NOT in_company",
    "ipo_checked")
OPS["fk_two_sided_acquisition"] = table("fact_acquisition")
OPS["fk_relationship"] = table("fact_relationship")
OPS["poly_fk_funding"] = table("dim_funding_rounds")
OPS["poly_fk_untyped"] = with_ctes(
    "SELECT investment_id, funded_object_id, funded_entity_type FROM investments_checked", "investments_checked")
OPS["poly_fk_typed_investor"] = with_ctes(
    "SELECT investment_id, investor_entity_type, investor_object_id FROM investments_checked WHERE investor_ok",
    "investments_checked")
OPS["fk_funding_round"] = with_ctes(
    "SELECT investment_id, funding_round_id FROM investments_checked WHERE round_ok", "investments_checked")

# ------------------------------------------------------------------ dedupe, distinct, union
OPS["dedupe_company"] = table("company_dedup")
OPS["dedupe_company_strict"] = with_ctes(
    "SELECT * FROM dim_company_pre " + survivor(
        "company_entity_type, company_object_id",
        desc("updated_at", "company_id", "company_id", "description", "address", "region", "city", "zip_code",
             "state_code", "country_code", "latitude", "longitude", "created_at", "updated_at")),
    "dim_company_pre")
OPS["dedupe_people"] = table("people_dedup")
OPS["dedupe_milestones_entity"] = with_ctes(
    "SELECT * FROM milestones_dedup WHERE milestone_object_id IS NOT NULL", "milestones_dedup")
OPS["dedupe_relationship"] = table("relationship_dedup")
OPS["dedupe_lineitem"] = "SELECT * FROM lineitem " + survivor(
    "l_orderkey, l_linenumber",
    desc("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
         "l_returnflag", "l_linestatus", "l_shipdate"))
OPS["distinct_keys"] = with_ctes(
    f"SELECT DISTINCT {ident('relationship_object_id')} AS object_id FROM st_relationship "
    f"WHERE {ident('relationship_object_id')} IS NOT NULL", "st_relationship")
OPS["union_by_name"] = with_ctes(
    "SELECT DISTINCT entity_type, object_id FROM (SELECT 'c' AS entity_type, company_object_id AS object_id "
    "FROM dim_company UNION ALL SELECT 'p', people_object_id FROM dim_people) WHERE object_id IS NOT NULL",
    "dim_company", "dim_people")

# ------------------------------------------------------------------ profiling
DATE_TYPES = ("date", "timestamp", "timestamp_ntz")
# Spark types of the driver's base tables used below.
BASE_TYPES = {
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")],
    "lineitem": [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                 ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                 ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                 ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")],
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
                 ("c_mktsegment", "string")],
    "events": [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"),
               ("value", "double"), ("props", "string")],
}


def _pct(part, whole):
    return (f"(CASE WHEN {whole} > 0 THEN CAST((({part}) * 20000 + {whole}) // (2 * {whole}) AS DOUBLE) / 100 "
            f"ELSE 0.0 END)")


def _profile_sql(table_name, src, cols):
    parts = []
    for i, (c, t) in enumerate(cols):
        n, nulls = "COUNT(*)", f'COUNT(*) FILTER (WHERE "{c}" IS NULL)'
        valid = _pct(f"{n} - {nulls}", n) if t in DATE_TYPES else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT '{table_name}' AS table_name, '{c}' AS column_name, {i} AS ordinal, '{t}' AS data_type, "
            f"{n} AS n_rows, {len(cols)} AS n_cols, {nulls} AS null_count, "
            f'COUNT(DISTINCT "{c}") + COALESCE(MAX(CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END), 0) AS unique_count, '
            f"{_pct(nulls, n)} AS percentage_missing_value, "
            f'CAST(MIN("{c}") AS VARCHAR) AS min_value, CAST(MAX("{c}") AS VARCHAR) AS max_value, '
            f"{valid} AS percentage_valid_date FROM {src}")
    return "\n UNION ALL ".join(parts)


for _name, _view in STAGED.items():
    OPS[f"profile_{_name}"] = with_ctes(_profile_sql(_name, _view, _cols(_name)), _view)
for _t, _cols_t in BASE_TYPES.items():
    OPS[f"profile_{_t}"] = _profile_sql(_t, _t, _cols_t)
OPS["profile_all"] = with_ctes("\n UNION ALL ".join(_profile_sql(n, v, _cols(n)) for n, v in STAGED.items()),
                               *STAGED.values())
OPS["distinct_count"] = with_ctes(
    f"SELECT table_name, column_name, unique_count FROM ({_profile_sql('relationship', 'st_relationship', _cols('relationship'))})",
    "st_relationship")
OPS["profile_counts"] = with_ctes(" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS n_rows, {len(_cols(n))} AS n_cols FROM {v}"
    for n, v in STAGED.items()), *STAGED.values())


def _samples_sql(table_name, src, cols, k=5):
    parts = []
    for c, _t in cols:
        parts.append(
            f"SELECT '{table_name}' AS table_name, '{c}' AS column_name, CAST(rn AS INTEGER) AS sample_rank, "
            f"sample_value FROM (SELECT CAST(v AS VARCHAR) AS sample_value, "
            f"ROW_NUMBER() OVER (ORDER BY v, CAST(v AS VARCHAR)) AS rn "
            f'FROM (SELECT DISTINCT "{c}" AS v FROM {src} WHERE "{c}" IS NOT NULL)) WHERE rn <= {k}')
    return "\n UNION ALL ".join(parts)


OPS["profile_samples"] = with_ctes(
    _samples_sql("company", "st_company", _cols("company")) + "\n UNION ALL " +
    _samples_sql("funding_rounds", "st_funding_rounds", _cols("funding_rounds")),
    "st_company", "st_funding_rounds")

# ------------------------------------------------------------------ declared constraints
_WH = ("dim_company", "dim_people", "dim_milestones", "fact_acquisition", "dim_funding_rounds",
       "fact_relationship", "fact_ipo", "fact_investments", "dim_funds")


def _check(sel_parts):
    return with_ctes("\n UNION ALL ".join(sel_parts), *_WH)


OPS["check_not_null"] = _check([
    f"SELECT '{t}' AS table_name, 'not_null' AS check_name, '{c}' AS column_name, "
    f"COUNT(*) FILTER (WHERE {c} IS NULL) AS violations FROM {t}" for t, cs in S.NOT_NULL.items() for c in cs])
OPS["check_unique"] = _check([
    f"SELECT '{t}' AS table_name, 'unique' AS check_name, '{k}' AS column_name, "
    f"(SELECT COUNT(*) FROM (SELECT {k} FROM {t} GROUP BY {k} HAVING COUNT(*) > 1)) AS violations"
    for t, ks in S.UNIQUE.items() for k in ks])
OPS["check_length"] = _check([
    f"SELECT '{t}' AS table_name, 'max_length' AS check_name, '{c}' AS column_name, "
    f"COUNT(*) FILTER (WHERE length({c}) > {n}) AS violations FROM {t}"
    for t, b in S.MAX_LENGTH.items() for c, n in b.items()])
OPS["check_decimal"] = _check([
    f"SELECT '{t}' AS table_name, 'numeric(15,2)' AS check_name, '{c}' AS column_name, "
    f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DECIMAL(15,2)) IS NULL) AS violations FROM {t}"
    for t, cs in S.NUMERIC_15_2.items() for c in cs])
OPS["check_fk"] = _check([
    f"SELECT '{t}' AS table_name, 'foreign_key' AS check_name, '{c}' AS column_name, "
    f"(SELECT COUNT(*) FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN "
    f"(SELECT {rc} FROM {rt} WHERE {rc} IS NOT NULL)) AS violations" for t, c, rt, rc in S.FOREIGN_KEYS])

# ------------------------------------------------------------------ sources and sinks
# CSV cannot tell an empty field from a missing one: both read back as NULL
OPS["src_csv"] = with_ctes(f"SELECT {_nullified('people', '')} FROM st_people", "st_people")
OPS["src_json_records"] = OPS["filter_date_range"]
OPS["src_all_tables"] = with_ctes(" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS n_rows FROM {v}" for n, v in STAGED.items()), *STAGED.values())
OPS["sink_overwrite"] = with_ctes("SELECT * FROM st_funds", "st_funds")
OPS["sink_append"] = with_ctes("SELECT * FROM st_funds UNION ALL SELECT * FROM st_funds", "st_funds")
_UPSERT = with_ctes("""
SELECT COALESCE(i.fund_id, t.fund_id) AS fund_id, t.fund_entity_type, t.fund_object_id,
  CASE WHEN i.fund_id IS NOT NULL THEN i.fund_name ELSE t.fund_name END AS fund_name, t.funding_date,
  CASE WHEN i.fund_id IS NOT NULL THEN i.raised_currency ELSE t.raised_currency END AS raised_currency,
  CASE WHEN i.fund_id IS NOT NULL THEN i.raised_amount ELSE t.raised_amount END AS raised_amount,
  t.source_url, t.source_description, t.created_at, t.updated_at
FROM dim_funds t FULL OUTER JOIN (
  SELECT fund_id, NULLIF(name, '') AS fund_name, 'EUR' AS raised_currency,
    CAST(raised_amount * 2 AS DECIMAL(15,2)) AS raised_amount FROM st_funds
  QUALIFY ROW_NUMBER() OVER (PARTITION BY fund_id ORDER BY updated_at DESC) = 1) i ON t.fund_id = i.fund_id""",
                    "dim_funds", "st_funds")
OPS["upsert_merge"] = _UPSERT
OPS["upsert_versioned"] = _UPSERT

# ------------------------------------------------------------------ jobs
OPS["stage_all"] = OPS["src_all_tables"]
OPS["profile_job"] = OPS["profile_all"]
OPS["warehouse_counts"] = with_ctes(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in _WH), *_WH)

# ------------------------------------------------------------------ dead letter, run log, profile JSON
OPS["dead_letter"] = with_ctes(
    "SELECT *, 'upsert: key column ''fund_key'' is missing from the input' AS error_message FROM st_funds",
    "st_funds")
OPS["etl_log"] = " UNION ALL ".join(
    f"SELECT 'Load Staging' AS step, 'Success' AS status, 'Staging' AS source, '{n}' AS table_name"
    for n in STAGED)
OPS["profile_json"] = with_ctes(" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, 'from Staging' AS format_file, COUNT(*) AS n_rows, "
    f"{len(_cols(n))} AS n_cols, {len(_cols(n))} AS n_report FROM {v}" for n, v in STAGED.items()),
    *STAGED.values())

# ------------------------------------------------------------------ strict keys, optional people check
_COMPANY_STRICT = with_ctes("SELECT * FROM dim_company_pre " + survivor(
    "company_entity_type, company_object_id",
    desc("updated_at", "company_id", "company_id", "description", "address", "region", "city", "zip_code",
         "state_code", "country_code", "latitude", "longitude", "created_at", "updated_at")), "dim_company_pre")
OPS["dim_company_strict"] = f"SELECT * FROM ({_COMPANY_STRICT}) WHERE latitude <> 0 AND longitude <> 0"
OPS["fact_acquisition_strict"] = with_ctes(f"""
SELECT acquisition_id, acquiring_entity_type, acquired_entity_type, price_amount, price_currency_code,
  acquired_at, source_url, created_at, updated_at, acquiring_object_id, acquired_object_id
FROM acquisition_clean a
WHERE EXISTS (SELECT 1 FROM ({OPS['dim_company_strict']}) c WHERE c.company_object_id = a.acquiring_object_id
               AND c.company_entity_type = a.acquiring_entity_type)
  AND EXISTS (SELECT 1 FROM ({OPS['dim_company_strict']}) c WHERE c.company_object_id = a.acquired_object_id
               AND c.company_entity_type = a.acquired_entity_type)""", "acquisition_clean")
OPS["dim_people_company_check"] = with_ctes(
    "SELECT * FROM dim_people p WHERE EXISTS (SELECT 1 FROM dim_company c "
    "WHERE c.company_object_id = p.people_object_id)", "dim_people", "dim_company")
# the longer name is the larger row of a key; rows without a name tie and are copies
OPS["upsert_rerun"] = with_ctes("SELECT * REPLACE (fund_name || '~' AS fund_name) FROM dim_funds", "dim_funds")
OPS["col_defaults"] = with_ctes("""
SELECT * FROM (WITH i AS (
  SELECT fund_id, NULLIF(name, '') AS fund_name, 'EUR' AS raised_currency,
    CAST(raised_amount * 2 AS DECIMAL(15,2)) AS raised_amount FROM st_funds
  QUALIFY ROW_NUMBER() OVER (PARTITION BY fund_id ORDER BY updated_at DESC) = 1)
SELECT i.fund_id, t.fund_entity_type, t.fund_object_id, i.fund_name, t.funding_date, i.raised_currency, i.raised_amount, t.source_url,
  CASE WHEN t.fund_id IS NULL THEN 'second load' ELSE 'none given' END AS source_description, t.created_at, t.updated_at
FROM i LEFT JOIN dim_funds t ON t.fund_id = i.fund_id
UNION ALL SELECT 'n' || i.fund_id, NULL, NULL, i.fund_name, NULL, i.raised_currency, i.raised_amount, NULL, 'second load', NULL, NULL FROM i)""",
                              "dim_funds", "st_funds")
OPS["upsert_rejected"] = with_ctes(
    "SELECT fund_id, fund_name, 'duplicate key' AS reason FROM dim_funds "
    "UNION ALL SELECT NULL, fund_name, 'NULL key' FROM dim_funds", "dim_funds")
