"""Benchmark: the full batch pipeline (stage -> profile -> warehouse) plus
each warehouse transform on its own, at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"value" is the end-to-end pipeline time (stage + profile + warehouse).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dimforge.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, cpus * 4))))
    spark = get_session(f"local[{cpus}]", app="dimforge-bench", shuffle_partitions=partitions,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    from dimforge.plans import jobs
    from dimforge.plans.catalog import WAREHOUSE_TABLES, Warehouse

    root = tempfile.mkdtemp(prefix="bench-", dir=os.environ.get("BENCH_SCRATCH", "/tmp"))
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.time()
        out = fn()
        times[name] = round(time.time() - t, 3)
        return out

    # warm-up: JVM start, first planning, Python workers
    Warehouse(spark, sf_dir).get("dim_people").valid.write.format("noop").mode("overwrite").save()

    log = f"{root}/etl_logs"
    timed("stage_all", lambda: jobs.stage_all(spark, sf_dir, f"{root}/staging", log))
    timed("profile_all", lambda: jobs.profile_all(spark, f"{root}/staging", f"{root}/data_profiling", log))
    counts = timed("build_warehouse",
                   lambda: jobs.build_warehouse(spark, f"{root}/staging", f"{root}/warehouse", "compat", log))
    pipeline = times["stage_all"] + times["profile_all"] + times["build_warehouse"]

    # each transform alone, straight from the base tables (fixtures included)
    wh = Warehouse(spark, sf_dir)
    for t in WAREHOUSE_TABLES:
        timed(t, lambda t=t: wh.get(t).valid.write.format("noop").mode("overwrite").save())

    print(json.dumps({
        "metric": "pipeline_seconds (stage + profile + warehouse)",
        "value": round(pipeline, 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": cpus,
        "rows": counts,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
