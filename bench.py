"""Benchmark: run the catalogue queries on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and print one JSON line.

Each query is fully executed into Spark's ``noop`` sink (every row computed,
nothing collected to the driver); the time includes any fitting the query
does. ``BENCH_QUERIES`` (comma list) restricts the set; without it all catalogue
queries run but those in ``LONG``. The checks' rounding of results is not timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from furrow.plans import catalog  # noqa: E402
from furrow.plans.registry import all_queries  # noqa: E402
from furrow.session import build_session  # noqa: E402

#: Fits models or plans hundreds of columns; run by name with BENCH_QUERIES.
LONG = {"build_features_wide", "score_requests_stream"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES")
    spark = build_session(app="furrow-bench", cpus=cpus)
    catalog.DIGITS = None  # results as the operators give them
    qs = all_queries()
    names = [n.strip() for n in wanted.split(",")] if wanted else [n for n in qs if n not in LONG]
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        t0 = time.time()
        try:
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        except Exception as e:  # noqa: BLE001 - report and continue
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
        print(f"[bench] {name}: {times.get(name, 'ERROR')}", file=sys.stderr, flush=True)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
