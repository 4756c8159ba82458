"""Benchmark: every registered job on the claims tables at one scale factor.

Setup (not timed): the claims-shaped views of ``$BENCH_SF_DIR`` are written
once as Parquet to a fresh scratch folder, then read back with
``load_tables`` — the way a user's claims tables arrive.  Each job is then
run to completion with the ``noop`` sink (full execution, nothing collected
to the driver) and timed.

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    from claimscope.plans import registry
    from claimscope.session import local_session
    from claimscope.sources import load_tables
    from claimscope.sources.testdata import VIEW_SQL, register_base_tables

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    spark = local_session(cores=cpus, shuffle_partitions=2 * cpus, app="claimscope-bench")
    scratch = tempfile.mkdtemp(prefix="claimscope-bench-")

    t0 = time.time()
    register_base_tables(spark, sf_dir)
    for name, sql in VIEW_SQL.items():
        spark.sql(sql).write.mode("overwrite").parquet(os.path.join(scratch, name))
    tables = load_tables(spark, scratch)
    setup = time.time() - t0

    jobs = {k: v for k, v in registry.JOBS.items() if not only or k in only}
    # warm the JVM (code paths, class loading) on one small job, untimed
    registry.JOBS["eligible_days"](spark, tables).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name, job in jobs.items():
        start = time.time()
        job(spark, tables).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)

    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_job_time",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": sf,
                "cpus": cpus,
                "setup_sec": round(setup, 3),
                "flagship_sec": times.get(registry.FLAGSHIP),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
