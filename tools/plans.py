"""Write the executed physical plans (after AQE's run-time decisions) of the
warehouse transforms, the profile and the merge to PLANS.md.

    python tools/plans.py [data_dir]      (default /root/testdata/sf0.1)
"""

from __future__ import annotations

import contextlib
import io
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dimforge.operators.profile import profile  # noqa: E402
from dimforge.operators.upsert import merge  # noqa: E402
from dimforge.plans import jobs  # noqa: E402
from dimforge.plans import warehouse as W  # noqa: E402
from dimforge.session import get_session  # noqa: E402
from dimforge.sinks import tables as T  # noqa: E402


def tree(df) -> str:
    """Run the plan (rows are counted, not collected) through the same query
    execution, then print its final adaptive plan: run-time decisions such as
    broadcast joins and reused exchanges are visible there."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    text = qe.executedPlan().treeString()
    final = text.split("+- == Initial Plan ==")[0]
    lines = [ln for ln in final.splitlines()]
    # keep operator names, drop long expression lists
    short = []
    for ln in lines:
        cut = ln.find("[")
        short.append(ln if cut < 0 or len(ln) < 160 else ln[:cut].rstrip() + " [...]")
    return "\n".join(short)


def main() -> None:
    data = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16)
    root = tempfile.mkdtemp(prefix="plans-", dir=os.environ.get("DIMFORGE_SCRATCH", "/tmp"))
    jobs.stage_all(spark, data, f"{root}/staging")
    st = jobs.read_staged(spark, f"{root}/staging")
    out = [f"# Executed physical plans ({data}, local[8])\n",
           "Final adaptive plans after execution (AQE decisions applied). Dimensions are read back "
           "from their written versions, as in the warehouse job. Generated by `tools/plans.py`.\n"]

    def section(title, df):
        out.append(f"## {title}\n\n```\n{tree(df)}\n```\n")

    company_b = W.transform_company(st["company"])
    section("dim_company", company_b.classified)
    T.upsert(company_b.valid, f"{root}/c", "company_id")
    people_b = W.transform_people(st["people"])
    T.upsert(people_b.valid, f"{root}/p", "people_id")
    c, p = T.read_table(spark, f"{root}/c"), T.read_table(spark, f"{root}/p")
    rounds_b = W.transform_funding_rounds(st["funding_rounds"], c, p)
    section("dim_funding_rounds (classified)", rounds_b.classified)
    T.upsert(rounds_b.valid, f"{root}/r", "funding_round_id")
    r = T.read_table(spark, f"{root}/r")
    section("fact_acquisition (classified)", W.transform_acquisition(st["acquisition"], c).classified)
    section("fact_relationship (classified)", W.transform_relationship(st["relationship"], c, p).classified)
    section("fact_investments (classified)", W.transform_investments(st["investments"], c, p, r).classified)
    section("profile (funding_rounds, with samples)", profile(st["funding_rounds"], "funding_rounds", sample_k=5))
    section("merge (dim_company onto itself)", merge(c, company_b.valid, "company_id"))
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
