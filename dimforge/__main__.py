"""Command line: run the batch jobs.

    python -m dimforge --data /path/to/base/tables --root /shared/run [--steps stage,profile,warehouse]
                       [--mode compat|strict] [--master local[8]]

On a cluster, ``spark-submit`` a two-line driver script that calls
``dimforge.__main__.main()`` (ship the package with ``--py-files``) and
leave ``--master`` unset; ``--root`` must be shared storage.
"""

from __future__ import annotations

import argparse
import json

from dimforge.session import get_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="dimforge")
    ap.add_argument("--data", required=True, help="folder with the base tables (<name>.parquet)")
    ap.add_argument("--root", required=True, help="output root: staging/, data_profiling/, warehouse/, etl_logs/")
    ap.add_argument("--steps", default="stage,profile,warehouse")
    ap.add_argument("--mode", default="compat", choices=("compat", "strict"))
    ap.add_argument("--master", default=None)
    ap.add_argument("--approx-profile", action="store_true", help="HyperLogLog distinct counts, no samples")
    ap.add_argument("--shuffle-partitions", type=int, default=None,
                    help="initial shuffle partitions (AQE merges small ones); size them to the largest shuffle")
    ap.add_argument("--buckets", type=int, default=None, help="bucket the warehouse tables by their keys")
    ap.add_argument("--no-constraints", action="store_true", help="load rows that break declared constraints too")
    a = ap.parse_args(argv)

    from dimforge.plans import jobs
    spark = get_session(a.master, app="dimforge", shuffle_partitions=a.shuffle_partitions)
    root = a.root.rstrip("/")
    log = f"{root}/etl_logs"
    steps = [s.strip() for s in a.steps.split(",") if s.strip()]
    out: dict[str, object] = {}
    if "stage" in steps:
        out["staged_rows"] = jobs.stage_all(spark, a.data, f"{root}/staging", log)
    if "profile" in steps:
        jobs.profile_all(spark, f"{root}/staging", f"{root}/data_profiling", log, exact=not a.approx_profile)
        out["profile"] = f"{root}/data_profiling"
    if "warehouse" in steps:
        out["warehouse_rows"] = jobs.build_warehouse(spark, f"{root}/staging", f"{root}/warehouse", a.mode, log,
                                                     enforce=not a.no_constraints, buckets=a.buckets)
    print(json.dumps(out))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
