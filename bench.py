"""Benchmark: the whole batch job on one scale factor, one JSON line on stdout.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Stages timed: model (sources -> staged dimensions and facts, written as parquet), then each
result table computed and written (q1 turnover, q2 stock-outs, q3 month over month, q4 margin
detail / systemic / mixed, KPIs). ``value`` is the end-to-end time of the job after the session
is up, the same scope as the reference's published wall time (ingest + transform + questions +
sink).
"""

from __future__ import annotations

import json
import os
import platform
import sys
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from kardex.plans.analytics import Periods
    from kardex.plans.job import answer_and_write, build_staged_model
    from kardex.session import build_session, ensure_checkpoint_dir

    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    for kv in filter(None, os.environ.get("BENCH_CONF", "").split(",")):  # k=v,k=v overrides for experiments
        k, v = kv.split("=", 1)
        extra[k] = v
    if os.environ.get("BENCH_EVENT_LOG"):  # scratch folder for stage/task times
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"],
                      "spark.eventLog.compress": "false"})
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus * 2)))
    spark = build_session(f"local[{cpus}]", app_name="kardex-bench", shuffle_partitions=parts, extra=extra)
    base = os.path.join(ensure_checkpoint_dir(spark), "bench-" + uuid.uuid4().hex[:8])
    timings: dict = {}
    t0 = time.time()
    with ThreadPoolExecutor(max_workers=int(os.environ.get("BENCH_CONCURRENCY", "4"))) as pool:
        volumes: dict = {}
        model, lookback = build_staged_model(spark, sf_dir, os.path.join(base, "model"), timings, pool, volumes)
        timings["model"] = round(time.time() - t0, 3)
        queries: dict = {}
        rows = answer_and_write(model, lookback, os.path.join(base, "results"), Periods(), pool, queries)
    queries = {k.replace("result_", ""): v for k, v in queries.items()}
    total = round(time.time() - t0, 3)
    queries["model_build"] = timings["model"]
    out = {
        "metric": "pipeline_wall_time", "value": total, "unit": "sec", "queries": queries,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""), "rows": rows,
        "stages": {k: v for k, v in timings.items() if k.startswith("stage_")},
        "volumes": volumes,
        "hardware": {"cpus": cpus, "machine": platform.machine(), "python": platform.python_version()},
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
