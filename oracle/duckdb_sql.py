"""Independent DuckDB SQL for every registered query.

Written directly in SQL from the rules (not generated from the Spark
plans).  The staged fixtures are the same SQL texts both engines run; the
oracle inlines them as CTEs because only the base tables are registered
on the DuckDB side.  Small SQL helpers below expand the per-value rules
(key parsing, text cleaning) into DuckDB expressions.
"""

from __future__ import annotations

from dimforge.plans.fixtures import FIXTURE_SQL

# --------------------------------------------------------------- expression helpers
SP = r"\s\x0b\x1c-\x1f\x85\p{Z}"          # Python str whitespace
WORD = r"\p{L}\p{N}_"                      # Python str \w
ASCII_SP = r"\t\n\x0b\x0c\r\x1c-\x1f "


def nz(v: str) -> str:
    return f"NULLIF({v}, '')"


def prefix(v: str) -> str:
    return f"(CASE WHEN contains({v}, ':') THEN split_part({v}, ':', 1) END)"


def ident(v: str) -> str:
    part = f"split_part({v}, ':', 2)"
    return (f"(CASE WHEN contains({v}, ':') AND regexp_full_match({part}, '\\s*[+-]?[0-9]+\\s*') "
            f"THEN TRY_CAST(trim({part}) AS INTEGER) END)")


def symbol(v: str) -> str:
    return f"(CASE WHEN contains({v}, ':') THEN split_part({v}, ':', 2) END)"


# Latin-1 characters whose bytes are well-formed UTF-8 (code points stand for bytes)
_TAIL = "[\\x80-\\xBF]"
UTF8_AS_LATIN1 = (
    f"([\\x00-\\x7F]|[\\xC2-\\xDF]{_TAIL}|\\xE0[\\xA0-\\xBF]{_TAIL}|[\\xE1-\\xEC\\xEE\\xEF]{_TAIL}{{2}}"
    f"|\\xED[\\x80-\\x9F]{_TAIL}|\\xF0[\\x90-\\xBF]{_TAIL}{{2}}|[\\xF1-\\xF3]{_TAIL}{{3}}|\\xF4[\\x80-\\x8F]{_TAIL}{{2}})*")


def repair(v: str) -> str:
    hexed = f"array_to_string(list_transform(string_split({v}, ''), lambda ch: printf('%02x', ord(ch))), '')"
    return (f"(CASE WHEN NOT regexp_full_match({v}, '[\\x00-\\x7F]*') AND regexp_full_match({v}, '{UTF8_AS_LATIN1}') "
            f"THEN decode(unhex({hexed})) ELSE {v} END)")


def clean_text(v: str) -> str:
    body = f"regexp_replace(strip_accents({repair(v)}), '[^\\x00-\\x7F]+', '', 'g')"
    return (f"(CASE WHEN {v} IS NULL OR {v} = '' THEN {v} ELSE "
            f"regexp_replace({body}, '^[{ASCII_SP}]+|[{ASCII_SP}]+$', '', 'g') END)")


def clean_alpha(v: str) -> str:
    kept = f"regexp_replace({v}, '[^{WORD}{SP}]', '', 'g')"
    return (f"(CASE WHEN {v} IS NOT NULL AND {v} <> '' THEN "
            f"regexp_replace({kept}, '^[{SP}]+|[{SP}]+$', '', 'g') END)")


def normalize(v: str) -> str:
    s = f"regexp_replace(lower({v}), '[^{WORD}{SP},&/]', '', 'g')"
    s = f"regexp_replace({s}, '[/,&]', ' ', 'g')"
    s = f"regexp_replace({s}, '[{SP}]+', ' ', 'g')"
    s = f"regexp_replace({s}, '^ | $', '', 'g')"
    return f"(CASE WHEN NOT regexp_full_match({v}, '[{SP}]*') THEN {s} END)"


# Letters and marks without a decomposition, and what stands for them.
TRANSLITERATED = [
    ("ß", "ss"), ("ẞ", "SS"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"), ("ø", "o"), ("Ø", "O"), ("ł", "l"), ("Ł", "L"),
    ("đ", "d"), ("Đ", "D"), ("ð", "d"), ("Ð", "D"), ("þ", "th"), ("Þ", "Th"), ("ı", "i"), ("ħ", "h"), ("Ħ", "H"), ("\u00a0", " "),
    ("‘", "'"), ("’", "'"), ("“", '"'), ("”", '"'), ("–", "-"), ("—", "--"), ("…", "..."),
]


def fix_enc(v: str) -> str:
    t = v
    for a, b in TRANSLITERATED:
        t = f"replace({t}, '{a}', '{b.replace(chr(39), chr(39) * 2)}')"
    return (f"(CASE WHEN regexp_full_match({v}, '[\\x00-\\x7F]*') THEN {v} "
            f"ELSE regexp_replace(strip_accents({t}), '[^\\x00-\\x7F]', '', 'g') END)")


def url(v: str) -> str:
    return f"(CASE WHEN regexp_matches({v}, '^(http|https)://.*') THEN {v} ELSE 'Unknown' END)"


def ts(v: str) -> str:
    return f"TRY_CAST({v} AS TIMESTAMP)"


def dt(v: str) -> str:
    return f"TRY_CAST({v} AS DATE)"


def survivor(keys: str, order: str) -> str:
    return f"QUALIFY ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"


def desc(*cols: str) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


# --------------------------------------------------------------- CTE library
CTE: dict[str, tuple[str, tuple[str, ...]]] = {}   # name -> (sql, dependencies)
for _name, _sql in FIXTURE_SQL.items():
    CTE[_name] = (_sql.strip(), ())


def cte(name: str, deps: tuple[str, ...], sql: str) -> None:
    CTE[name] = (sql.strip(), deps)


# T1 company
cte("dim_company_pre", ("st_company",), f"""
SELECT office_id AS company_id, {prefix(nz('object_id'))} AS company_entity_type,
  {ident(nz('object_id'))} AS company_object_id,
  COALESCE({clean_text(nz('description'))}, 'Unknown') AS description,
  COALESCE({clean_text(nz('address1'))}, 'Unknown') AS address,
  COALESCE({clean_text(nz('region'))}, 'Unknown') AS region,
  COALESCE({nz('city')}, 'Unknown') AS city,
  COALESCE({clean_text(nz('zip_code'))}, 'Unknown') AS zip_code,
  COALESCE({nz('state_code')}, 'Unknown') AS state_code,
  COALESCE({nz('country_code')}, 'Unknown') AS country_code,
  TRY_CAST(latitude AS DECIMAL(9,6)) AS latitude, TRY_CAST(longitude AS DECIMAL(9,6)) AS longitude,
  {ts(nz('created_at'))} AS created_at, {ts(nz('updated_at'))} AS updated_at
FROM st_company""")
_company_rest = ("company_entity_type", "description", "address", "region", "city", "zip_code", "state_code",
                 "country_code", "latitude", "longitude", "created_at", "updated_at")
cte("company_dedup", ("dim_company_pre",), f"""
SELECT * FROM dim_company_pre
{survivor('company_object_id', desc('updated_at', 'company_id', 'company_id', *_company_rest))}""")
cte("dim_company", ("company_dedup",), """
SELECT * FROM company_dedup WHERE latitude <> 0 AND longitude <> 0""")

# T2 people
cte("dim_people_pre", ("st_people",), f"""
SELECT people_id, {prefix(nz('object_id'))} AS people_entity_type, {ident(nz('object_id'))} AS people_object_id,
  COALESCE({clean_alpha(f"concat_ws(' ', {nz('first_name')}, {nz('last_name')})")}, 'Unknown') AS full_name,
  COALESCE({fix_enc(nz('birthplace'))}, 'Unknown') AS birthplace,
  COALESCE({clean_alpha(nz('affiliation_name'))}, 'Unknown') AS affiliation_name
FROM st_people""")
cte("people_dedup", ("dim_people_pre",), f"""
SELECT * FROM dim_people_pre
{survivor('people_entity_type, people_object_id',
          desc('TRY_CAST(people_id AS BIGINT)', 'people_id', 'people_id', 'full_name', 'birthplace',
               'affiliation_name'))}""")
cte("dim_people", ("people_dedup",), """
SELECT * FROM people_dedup WHERE full_name <> 'Unknown'""")

# T3 milestones
cte("milestones_pre", ("st_milestones",), f"""
SELECT milestone_id, {prefix("NULLIF(NULLIF(object_id, ''), 'NaN')")} AS milestone_entity_type,
  {ident("NULLIF(NULLIF(object_id, ''), 'NaN')")} AS milestone_object_id,
  {dt("NULLIF(NULLIF(milestone_at, ''), 'NaN')")} AS milestone_date,
  COALESCE({clean_alpha("NULLIF(NULLIF(description, ''), 'NaN')")}, 'No Description') AS description,
  {url("NULLIF(NULLIF(source_url, ''), 'NaN')")} AS source_url,
  COALESCE({clean_alpha("NULLIF(NULLIF(source_description, ''), 'NaN')")}, 'Unknown') AS source_description,
  {ts("NULLIF(NULLIF(created_at, ''), 'NaN')")} AS created_at,
  {ts("NULLIF(NULLIF(updated_at, ''), 'NaN')")} AS updated_at
FROM st_milestones""")
_ms_rest = ("milestone_entity_type", "milestone_object_id", "milestone_date", "description", "source_url",
            "source_description", "created_at", "updated_at")
cte("milestones_dedup", ("milestones_pre",), f"""
SELECT * FROM (SELECT * FROM milestones_pre
  {survivor('milestone_id', desc('updated_at', 'milestone_id', *_ms_rest))})
{survivor('milestone_entity_type, milestone_object_id',
          desc('updated_at', 'milestone_id', 'milestone_id', 'milestone_date', 'description', 'source_url',
               'source_description', 'created_at', 'updated_at'))}""")
cte("milestones_checked", ("milestones_dedup", "dim_company"), """
SELECT m.*, EXISTS (SELECT 1 FROM dim_company c WHERE c.company_object_id = m.milestone_object_id) AS in_company
FROM milestones_dedup m WHERE m.milestone_object_id IS NOT NULL""")
cte("dim_milestones", ("milestones_checked",), """
SELECT * EXCLUDE (in_company) FROM milestones_checked WHERE in_company""")
cte("quarantine_milestones", ("milestones_checked",), """
SELECT 'milestones' AS table_name, CAST(milestone_id AS VARCHAR) AS record_id,
  milestone_entity_type AS entity_type, CAST(milestone_object_id AS VARCHAR) AS object_id,
  CAST(NULL AS VARCHAR) AS extra_entity_type_1, CAST(NULL AS VARCHAR) AS extra_object_id_1,
  'no match in dim_company' AS reason
FROM milestones_checked WHERE NOT in_company""")

# T4 acquisition
cte("acquisition_pre", ("st_acquisition",), f"""
SELECT acquisition_id,
  {prefix(nz('acquiring_object_id'))} AS acquiring_entity_type, {ident(nz('acquiring_object_id'))} AS acquiring_object_id,
  {prefix(nz('acquired_object_id'))} AS acquired_entity_type, {ident(nz('acquired_object_id'))} AS acquired_object_id,
  COALESCE(TRY_CAST(price_amount AS DECIMAL(15,2)), 0) AS price_amount,
  COALESCE({nz('price_currency_code')}, 'Unknown') AS price_currency_code,
  {dt('acquired_at')} AS acquired_at,
  COALESCE({nz('source_url')}, 'Unknown') AS source_url,
  {ts(nz('created_at'))} AS created_at, {ts(nz('updated_at'))} AS updated_at
FROM st_acquisition""")
_acq_rest = ("acquiring_entity_type", "acquiring_object_id", "acquired_entity_type", "acquired_object_id",
             "price_amount", "price_currency_code", "acquired_at", "source_url", "created_at", "updated_at")
cte("acquisition_clean", ("acquisition_pre",), f"""
SELECT * FROM (SELECT * FROM acquisition_pre {survivor('acquisition_id', desc('updated_at', *_acq_rest))})
WHERE price_amount <> 0 AND acquired_at IS NOT NULL""")
cte("acquisition_checked", ("acquisition_clean", "dim_company"), """
SELECT a.*,
  EXISTS (SELECT 1 FROM dim_company c WHERE c.company_object_id = a.acquiring_object_id) AS acquiring_ok,
  EXISTS (SELECT 1 FROM dim_company c WHERE c.company_object_id = a.acquired_object_id) AS acquired_ok
FROM acquisition_clean a""")
cte("fact_acquisition", ("acquisition_checked",), """
SELECT acquisition_id, acquiring_entity_type, acquired_entity_type, price_amount, price_currency_code,
  acquired_at, source_url, created_at, updated_at, acquiring_object_id, acquired_object_id
FROM acquisition_checked WHERE acquiring_ok AND acquired_ok""")
cte("quarantine_acquisition", ("acquisition_checked",), """
SELECT 'acquisition' AS table_name, CAST(acquisition_id AS VARCHAR) AS record_id,
  acquiring_entity_type AS entity_type, CAST(acquiring_object_id AS VARCHAR) AS object_id,
  acquired_entity_type AS extra_entity_type_1, CAST(acquired_object_id AS VARCHAR) AS extra_object_id_1,
  CASE WHEN NOT acquiring_ok AND NOT acquired_ok THEN 'no match in dim_company: both sides'
       WHEN NOT acquiring_ok THEN 'no match in dim_company: acquiring'
       ELSE 'no match in dim_company: acquired' END AS reason
FROM acquisition_checked WHERE NOT (acquiring_ok AND acquired_ok)""")

# T5 funding rounds
cte("rounds_pre", ("st_funding_rounds",), f"""
SELECT funding_round_id, {prefix(nz('object_id'))} AS funding_entity_type, {ident(nz('object_id'))} AS funding_object_id,
  COALESCE({nz('funding_round_type')}, 'Unknown') AS round_type, {dt('funded_at')} AS funding_date,
  COALESCE({nz('raised_currency_code')}, 'USD') AS raised_currency, raised_amount,
  COALESCE(raised_amount_usd, 0) AS raised_amount_usd,
  COALESCE({nz('pre_money_currency_code')}, 'USD') AS pre_money_currency, pre_money_valuation, pre_money_valuation_usd,
  COALESCE({nz('post_money_currency_code')}, 'USD') AS post_money_currency, post_money_valuation, post_money_valuation_usd,
  TRY_CAST({nz('participants')} AS INTEGER) AS participants,
  COALESCE({nz('source_url')}, 'Unknown') AS source_url,
  COALESCE({nz('source_description')}, 'Unknown') AS source_description,
  {ts(nz('created_at'))} AS created_at, {ts(nz('updated_at'))} AS updated_at
FROM st_funding_rounds""")
_rounds_rest = ("funding_entity_type", "funding_object_id", "round_type", "funding_date", "raised_currency",
                "raised_amount", "raised_amount_usd", "pre_money_currency", "pre_money_valuation",
                "pre_money_valuation_usd", "post_money_currency", "post_money_valuation",
                "post_money_valuation_usd", "participants", "source_url", "source_description",
                "created_at", "updated_at")
cte("rounds_clean", ("rounds_pre",), f"""
SELECT * REPLACE (CASE WHEN funding_entity_type IN ('c', 'p') THEN funding_entity_type ELSE 'c' END AS funding_entity_type)
FROM (SELECT * FROM rounds_pre {survivor('funding_round_id', desc('updated_at', *_rounds_rest))})
WHERE round_type <> 'Unknown'""")
cte("rounds_checked", ("rounds_clean", "dim_company", "dim_people"), """
SELECT r.*,
  CASE WHEN r.funding_entity_type = 'p'
       THEN EXISTS (SELECT 1 FROM dim_people p WHERE p.people_object_id = r.funding_object_id)
       ELSE EXISTS (SELECT 1 FROM dim_company c WHERE c.company_object_id = r.funding_object_id) END AS entity_ok
FROM rounds_clean r""")
cte("dim_funding_rounds", ("rounds_checked",), """
SELECT * EXCLUDE (entity_ok) FROM rounds_checked WHERE entity_ok""")
cte("quarantine_funding_rounds", ("rounds_checked",), """
SELECT 'funding_rounds' AS table_name, CAST(funding_round_id AS VARCHAR) AS record_id,
  funding_entity_type AS entity_type, CAST(funding_object_id AS VARCHAR) AS object_id,
  CAST(NULL AS VARCHAR) AS extra_entity_type_1, CAST(NULL AS VARCHAR) AS extra_object_id_1,
  'no match in ' || CASE WHEN funding_entity_type = 'p' THEN 'dim_people' ELSE 'dim_company' END AS reason
FROM rounds_checked WHERE NOT entity_ok""")

# T6 relationship
cte("relationship_pre", ("st_relationship",), f"""
SELECT relationship_id,
  {prefix(nz('person_object_id'))} AS people_entity_type, {ident(nz('person_object_id'))} AS people_object_id,
  {prefix(nz('relationship_object_id'))} AS relationship_entity_type,
  {ident(nz('relationship_object_id'))} AS relationship_object_id,
  {dt(nz('start_at'))} AS start_at, {dt(nz('end_at'))} AS end_at,
  COALESCE({normalize(nz('title'))}, 'Unknown') AS title,
  {ts(nz('created_at'))} AS created_at, {ts(nz('updated_at'))} AS updated_at
FROM st_relationship""")
_rel_rest = ("people_entity_type", "people_object_id", "relationship_entity_type", "relationship_object_id",
             "start_at", "end_at", "title", "created_at", "updated_at")
cte("relationship_dedup", ("relationship_pre",), f"""
SELECT * FROM relationship_pre {survivor('relationship_id', desc('updated_at', *_rel_rest))}""")
cte("relationship_checked", ("relationship_dedup", "dim_company", "dim_people"), """
SELECT r.*,
  EXISTS (SELECT 1 FROM dim_people p WHERE p.people_object_id = r.people_object_id) AS person_ok,
  EXISTS (SELECT 1 FROM dim_company c WHERE c.company_object_id = r.relationship_object_id) AS company_ok
FROM relationship_dedup r""")
cte("fact_relationship", ("relationship_checked",), """
SELECT people_object_id, relationship_id, people_entity_type, relationship_entity_type, relationship_object_id,
  start_at, end_at, title, created_at, updated_at
FROM relationship_checked WHERE person_ok AND company_ok""")
cte("quarantine_relationship", ("relationship_checked",), """
SELECT 'relationship' AS table_name, CAST(relationship_id AS VARCHAR) AS record_id,
  people_entity_type AS entity_type, CAST(people_object_id AS VARCHAR) AS object_id,
  relationship_entity_type AS extra_entity_type_1, CAST(relationship_object_id AS VARCHAR) AS extra_object_id_1,
  CASE WHEN NOT person_ok AND NOT company_ok THEN 'no match in dim_people and dim_company'
       WHEN NOT person_ok THEN 'no match in dim_people' ELSE 'no match in dim_company' END AS reason
FROM relationship_checked WHERE NOT (person_ok AND company_ok)""")

# T7 ipo
cte("ipo_pre", ("st_ipo",), f"""
SELECT ipo_id, {prefix(nz('object_id'))} AS ipo_entity_type, {ident(nz('object_id'))} AS ipo_object_id,
  COALESCE({nz('valuation_currency_code')}, 'USD') AS valuation_currency,
  COALESCE(valuation_amount, 0) AS valuation_amount,
  COALESCE({nz('raised_currency_code')}, 'USD') AS raised_currency,
  COALESCE(raised_amount, 0) AS raised_amount, {dt('public_at')} AS public_at,
  COALESCE({prefix(nz('stock_symbol'))}, 'N/A') AS stock_market,
  COALESCE({symbol(nz('stock_symbol'))}, 'N/A') AS stock_symbol,
  COALESCE({nz('source_url')}, 'Unknown') AS source_url,
  COALESCE({nz('source_description')}, 'Unknown') AS source_description,
  {ts(nz('created_at'))} AS created_at, {ts(nz('updated_at'))} AS updated_at
FROM st_ipo""")
_ipo_rest = ("ipo_entity_type", "ipo_object_id", "valuation_currency", "valuation_amount", "raised_currency",
             "raised_amount", "public_at", "stock_market", "stock_symbol", "source_url", "source_description",
             "created_at", "updated_at")
cte("ipo_checked", ("ipo_pre", "dim_company"), f"""
SELECT i.*, COALESCE(i.ipo_entity_type = 'c', FALSE) AS is_company,
  EXISTS (SELECT 1 FROM dim_company c WHERE c.company_object_id = i.ipo_object_id) AS in_company
FROM (SELECT * FROM ipo_pre {survivor('ipo_id', desc('updated_at', *_ipo_rest))}) i""")
cte("fact_ipo", ("ipo_checked",), """
SELECT * EXCLUDE (is_company, in_company) FROM ipo_checked WHERE is_company AND in_company""")
cte("quarantine_ipo", ("ipo_checked",), """
SELECT 'ipo' AS table_name, CAST(ipo_id AS VARCHAR) AS record_id, ipo_entity_type AS entity_type,
  CAST(ipo_object_id AS VARCHAR) AS object_id, CAST(NULL AS VARCHAR) AS extra_entity_type_1,
  CAST(NULL AS VARCHAR) AS extra_object_id_1,
  CASE WHEN NOT is_company THEN 'not a company' ELSE 'no match in dim_company' END AS reason
FROM ipo_checked WHERE NOT (is_company AND in_company)""")

# T8 investments
cte("investments_pre", ("st_investments",), f"""
SELECT investment_id, TRY_CAST(funding_round_id AS INTEGER) AS funding_round_id,
  {prefix(nz('funded_object_id'))} AS funded_prefix, {ident(nz('funded_object_id'))} AS funded_object_id,
  {prefix(nz('investor_object_id'))} AS investor_entity_type, {ident(nz('investor_object_id'))} AS investor_object_id
FROM (SELECT * FROM st_investments
  {survivor('investment_id', desc(ts(nz('updated_at')), 'funding_round_id', 'funded_object_id',
                                   'investor_object_id', 'created_at', 'updated_at'))})""")
cte("investments_checked", ("investments_pre", "dim_company", "dim_people", "dim_funding_rounds"), """
SELECT i.*,
  CASE WHEN EXISTS (SELECT 1 FROM dim_company c WHERE c.company_object_id = i.funded_object_id) THEN 'c'
       WHEN EXISTS (SELECT 1 FROM dim_people p WHERE p.people_object_id = i.funded_object_id) THEN 'p' END
    AS funded_entity_type,
  CASE i.investor_entity_type
       WHEN 'c' THEN EXISTS (SELECT 1 FROM dim_company c WHERE c.company_object_id = i.investor_object_id)
       WHEN 'p' THEN EXISTS (SELECT 1 FROM dim_people p WHERE p.people_object_id = i.investor_object_id)
       ELSE FALSE END AS investor_ok,
  EXISTS (SELECT 1 FROM dim_funding_rounds r WHERE r.funding_round_id = i.funding_round_id) AS round_ok
FROM investments_pre i""")
cte("fact_investments", ("investments_checked",), """
SELECT funding_round_id, investment_id, funded_entity_type, funded_object_id, investor_entity_type,
  investor_object_id
FROM investments_checked WHERE funded_entity_type IS NOT NULL AND investor_ok AND round_ok""")
cte("quarantine_investments", ("investments_checked",), """
SELECT 'investments' AS table_name, CAST(investment_id AS VARCHAR) AS record_id, funded_prefix AS entity_type,
  CAST(funded_object_id AS VARCHAR) AS object_id, investor_entity_type AS extra_entity_type_1,
  CAST(investor_object_id AS VARCHAR) AS extra_object_id_1,
  CASE WHEN funded_entity_type IS NULL THEN 'funded entity not found'
       WHEN NOT investor_ok THEN 'investor not found' ELSE 'no match in dim_funding_rounds' END AS reason
FROM investments_checked WHERE NOT (funded_entity_type IS NOT NULL AND investor_ok AND round_ok)""")

# T9 funds
cte("funds_pre", ("st_funds",), f"""
SELECT fund_id, {prefix(nz('object_id'))} AS fund_entity_type, {ident(nz('object_id'))} AS fund_object_id,
  {nz('name')} AS fund_name, {dt(nz('funded_at'))} AS funding_date,
  COALESCE({nz('raised_currency_code')}, 'USD') AS raised_currency, COALESCE(raised_amount, 0) AS raised_amount,
  COALESCE({nz('source_url')}, 'Unknown') AS source_url,
  COALESCE({nz('source_description')}, 'Unknown') AS source_description,
  {ts(nz('created_at'))} AS created_at, {ts(nz('updated_at'))} AS updated_at
FROM st_funds""")
_funds_rest = ("fund_entity_type", "fund_object_id", "fund_name", "funding_date", "raised_currency",
               "raised_amount", "source_url", "source_description", "created_at", "updated_at")
cte("dim_funds", ("funds_pre",), f"""
SELECT * REPLACE ({url('source_url')} AS source_url, {clean_alpha('source_description')} AS source_description)
FROM (SELECT * FROM funds_pre {survivor('fund_id', desc('updated_at', *_funds_rest))})
WHERE funding_date IS NOT NULL""")


def with_ctes(select: str, *needed: str) -> str:
    """``WITH <needed CTEs in dependency order> <select>``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTE[n][1]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    body = ",\n".join(f"{n} AS (\n{CTE[n][0]}\n)" for n in order)
    return f"WITH {body}\n{select.strip()}"


def table(name: str) -> str:
    return with_ctes(f"SELECT * FROM {name}", name)
