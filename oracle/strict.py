"""Oracle SQL for strict keys: entity keys compare prefix and id."""

from __future__ import annotations

from oracle.duckdb_sql import cte, desc, survivor, table

cte("company_s", ("dim_company_pre",), "SELECT * FROM (SELECT * FROM dim_company_pre " + survivor(
    "company_entity_type, company_object_id",
    desc("updated_at", "company_id", "company_id", "description", "address", "region", "city", "zip_code",
         "state_code", "country_code", "latitude", "longitude", "created_at", "updated_at"))
    + ") WHERE latitude <> 0 AND longitude <> 0")
cte("entity_s", ("company_s", "dim_people"), """
SELECT DISTINCT company_entity_type AS entity_type, company_object_id AS object_id FROM company_s
  WHERE company_entity_type IS NOT NULL AND company_object_id IS NOT NULL
UNION SELECT DISTINCT people_entity_type, people_object_id FROM dim_people
  WHERE people_entity_type IS NOT NULL AND people_object_id IS NOT NULL""")
cte("dim_milestones_strict", ("milestones_dedup", "company_s"), """
SELECT * FROM milestones_dedup m WHERE m.milestone_object_id IS NOT NULL AND EXISTS (
  SELECT 1 FROM company_s c WHERE c.company_object_id = m.milestone_object_id
  AND c.company_entity_type = m.milestone_entity_type)""")
cte("fact_ipo_strict", ("ipo_checked", "company_s", "st_ipo"), """
SELECT * EXCLUDE (is_company, in_company, ticker) REPLACE (COALESCE(b.ticker, i.stock_symbol) AS stock_symbol)
FROM ipo_checked i LEFT JOIN (
  SELECT DISTINCT ipo_id, stock_symbol AS ticker FROM st_ipo
  WHERE stock_symbol <> '' AND NOT contains(stock_symbol, ':')) b USING (ipo_id)
WHERE is_company AND EXISTS (
  SELECT 1 FROM company_s c WHERE c.company_object_id = i.ipo_object_id AND c.company_entity_type = i.ipo_entity_type)""")
cte("fact_relationship_strict", ("relationship_dedup", "company_s", "dim_people"), """
SELECT people_object_id, relationship_id, people_entity_type, relationship_entity_type, relationship_object_id,
  start_at, end_at, title, created_at, updated_at
FROM relationship_dedup r
WHERE EXISTS (SELECT 1 FROM dim_people p WHERE p.people_object_id = r.people_object_id
              AND p.people_entity_type = r.people_entity_type)
  AND EXISTS (SELECT 1 FROM company_s c WHERE c.company_object_id = r.relationship_object_id
              AND c.company_entity_type = r.relationship_entity_type)""")
cte("dim_funding_rounds_strict", ("rounds_pre", "entity_s"), """
SELECT * FROM (SELECT * FROM rounds_pre """ + survivor("funding_round_id", desc(
    "updated_at", "funding_entity_type", "funding_object_id", "round_type", "funding_date", "raised_currency",
    "raised_amount", "raised_amount_usd", "pre_money_currency", "pre_money_valuation", "pre_money_valuation_usd",
    "post_money_currency", "post_money_valuation", "post_money_valuation_usd", "participants", "source_url",
    "source_description", "created_at", "updated_at")) + """) r
WHERE round_type <> 'Unknown' AND EXISTS (SELECT 1 FROM entity_s e
  WHERE e.entity_type = r.funding_entity_type AND e.object_id = r.funding_object_id)""")
cte("fact_investments_strict", ("investments_pre", "entity_s", "dim_funding_rounds_strict"), """
SELECT funding_round_id, investment_id, funded_prefix AS funded_entity_type, funded_object_id,
  investor_entity_type, investor_object_id
FROM investments_pre i
WHERE EXISTS (SELECT 1 FROM entity_s e WHERE e.entity_type = i.funded_prefix AND e.object_id = i.funded_object_id)
  AND EXISTS (SELECT 1 FROM entity_s e WHERE e.entity_type = i.investor_entity_type
              AND e.object_id = i.investor_object_id)
  AND EXISTS (SELECT 1 FROM dim_funding_rounds_strict r WHERE r.funding_round_id = i.funding_round_id)""")

STRICT = {f"{t}_strict": table(f"{t}_strict")
          for t in ("dim_milestones", "fact_relationship", "fact_ipo", "dim_funding_rounds", "fact_investments")}
