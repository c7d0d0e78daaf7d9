"""Oracle SQL per registered query key."""

from __future__ import annotations

from oracle.duckdb_sql import table

ORACLE: dict[str, str] = {}

for _t in ("dim_company", "dim_people", "dim_milestones", "fact_acquisition", "dim_funding_rounds",
           "fact_relationship", "fact_ipo", "fact_investments", "dim_funds"):
    ORACLE[_t] = table(_t)
for _q in ("milestones", "acquisition", "funding_rounds", "relationship", "ipo", "investments"):
    ORACLE[f"quarantine_{_q}"] = table(f"quarantine_{_q}")

from oracle.ops import OPS  # noqa: E402

ORACLE.update(OPS)

from oracle.strict import STRICT  # noqa: E402

ORACLE.update(STRICT)

from oracle.load import LOAD  # noqa: E402

ORACLE.update(LOAD)
