"""Fixed layouts: staged relations, quarantine, run log, and the declared
warehouse constraints (NOT NULL, unique keys, text length bounds,
numeric(15,2) columns, foreign keys)."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Staged relations as produced by the fixtures (Spark DDL).
STAGED_DDL = {
    "company": "office_id int, object_id string, description string, region string, address1 string, "
               "address2 string, city string, zip_code string, state_code string, country_code string, "
               "latitude decimal(9,6), longitude decimal(9,6), created_at string, updated_at string",
    "people": "people_id string, object_id string, first_name string, last_name string, birthplace string, "
              "affiliation_name string",
    "acquisition": "acquisition_id int, acquiring_object_id string, acquired_object_id string, term_code string, "
                   "price_amount decimal(15,2), price_currency_code string, acquired_at date, source_url string, "
                   "source_description string, created_at string, updated_at string",
    "funding_rounds": "funding_round_id int, object_id string, funded_at date, funding_round_type string, "
                      "funding_round_code string, raised_amount_usd decimal(15,2), raised_amount decimal(15,2), "
                      "raised_currency_code string, pre_money_valuation_usd decimal(15,2), "
                      "pre_money_valuation decimal(15,2), pre_money_currency_code string, "
                      "post_money_valuation_usd decimal(15,2), post_money_valuation decimal(15,2), "
                      "post_money_currency_code string, participants string, is_first_round boolean, "
                      "is_last_round boolean, source_url string, source_description string, created_by string, "
                      "created_at string, updated_at string",
    "investments": "investment_id int, funding_round_id int, funded_object_id string, investor_object_id string, "
                   "created_at string, updated_at string",
    "relationship": "relationship_id string, person_object_id string, relationship_object_id string, "
                    "start_at string, end_at string, is_past string, sequence string, title string, "
                    "created_at string, updated_at string",
    "ipo": "ipo_id string, object_id string, valuation_amount decimal(15,2), valuation_currency_code string, "
           "raised_amount decimal(15,2), raised_currency_code string, public_at date, stock_symbol string, "
           "source_url string, source_description string, created_at string, updated_at string",
    "funds": "fund_id string, object_id string, name string, funded_at string, raised_amount decimal(15,2), "
             "raised_currency_code string, source_url string, source_description string, created_at string, "
             "updated_at string",
    "milestones": "milestone_id bigint, object_id string, milestone_at string, milestone_code string, "
                  "description string, source_url string, source_description string, created_at string, "
                  "updated_at string",
}


def staged_schema(name: str) -> StructType:
    return StructType.fromDDL(STAGED_DDL[name])


QUARANTINE_DDL = ("table_name string, record_id string, entity_type string, object_id string, "
                  "extra_entity_type_1 string, extra_object_id_1 string, reason string, logged_at timestamp")
RUN_LOG_DDL = "step string, status string, source string, table_name string, etl_date timestamp"

# ------------------------------------------------------------------ declared warehouse constraints
# The warehouse DDL contract.
NOT_NULL = {
    "dim_company": ["company_entity_type", "company_object_id"],
    "dim_people": ["people_entity_type", "people_object_id"],
    "dim_milestones": ["milestone_entity_type", "milestone_object_id"],
    "fact_acquisition": ["acquiring_entity_type", "acquiring_object_id", "acquired_entity_type",
                         "acquired_object_id"],
    "fact_investments": ["funding_round_id", "funded_entity_type", "funded_object_id", "investor_entity_type",
                         "investor_object_id"],
}
UNIQUE = {
    "dim_company": ["company_id", "company_object_id"],
    "dim_people": ["people_id", "people_object_id"],
    "dim_milestones": ["milestone_id"],
    "fact_acquisition": ["acquisition_id"],
    "dim_funding_rounds": ["funding_round_id"],
    "fact_investments": ["investment_id"],
    "fact_ipo": ["ipo_id"],
    "dim_funds": ["fund_id"],
}
MAX_LENGTH = {
    "dim_company": {"company_entity_type": 5, "description": 255, "address": 255, "region": 255, "city": 255,
                    "zip_code": 255, "state_code": 255, "country_code": 255},
    "dim_people": {"people_entity_type": 5, "full_name": 255, "birthplace": 255, "affiliation_name": 255},
    "dim_milestones": {"milestone_entity_type": 5, "source_url": 255, "source_description": 255},
    "fact_acquisition": {"acquiring_entity_type": 10, "acquired_entity_type": 10, "price_currency_code": 10,
                         "source_url": 255},
    "dim_funding_rounds": {"funding_entity_type": 10, "round_type": 100, "raised_currency": 10,
                           "pre_money_currency": 10, "post_money_currency": 10, "source_url": 255,
                           "source_description": 255},
    "fact_investments": {"funded_entity_type": 10, "investor_entity_type": 10},
    "fact_ipo": {"ipo_entity_type": 10, "valuation_currency": 10, "raised_currency": 10, "stock_market": 20,
                 "stock_symbol": 20, "source_url": 255, "source_description": 255},
    "dim_funds": {"fund_entity_type": 10, "fund_name": 255, "raised_currency": 10, "source_url": 255,
                  "source_description": 255},
}
NUMERIC_15_2 = {
    "fact_acquisition": ["price_amount"],
    "dim_funding_rounds": ["raised_amount", "raised_amount_usd", "pre_money_valuation", "pre_money_valuation_usd",
                           "post_money_valuation", "post_money_valuation_usd"],
    "fact_ipo": ["valuation_amount", "raised_amount"],
    "dim_funds": ["raised_amount"],
}
# (table, column) -> (referenced table, referenced column)
FOREIGN_KEYS = [
    ("dim_milestones", "milestone_object_id", "dim_company", "company_object_id"),
    ("fact_acquisition", "acquiring_object_id", "dim_company", "company_object_id"),
    ("fact_acquisition", "acquired_object_id", "dim_company", "company_object_id"),
    ("fact_investments", "funding_round_id", "dim_funding_rounds", "funding_round_id"),
    ("fact_ipo", "ipo_object_id", "dim_company", "company_object_id"),
]
# tables whose DDL fills created_at / updated_at with the load time
DEFAULT_NOW = {"dim_company", "dim_people", "dim_milestones", "fact_acquisition", "dim_funding_rounds",
               "fact_investments", "fact_ipo", "dim_funds"}
