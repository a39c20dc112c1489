"""Headline benchmark: prints one JSON line.

Runs the headline queries over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and times each one to full
materialisation (the ``noop`` sink runs the whole plan without collecting).
Cached tables are dropped between queries, so none rides on another's work;
``$BENCH_RUNS`` runs of the whole list (default 1) give the median.
"""
from __future__ import annotations

import json
import os
import re
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerflow.plans.queries import QUERIES  # noqa: E402
from ledgerflow.session import local_session  # noqa: E402

HEADLINE = [
    "messages_by_type",                  # parse and route all messages
    "flagship_ledger",                   # messages -> payments -> ledger
    "ledger",                            # ledger from payments
    "employee_totals",                   # totals over canonical members
    "trigram_match",                     # similarity join of distinct names
    "reconciliation_by_period_source",   # reconciliation by period and source
    "match_exact_tiers",
    "gap_scan",
    "ingest_dedup",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, 2 * int(cpus)))))
    spark = local_session(cores=cpus, shuffle_partitions=parts, app="ledgerflow-bench")
    runs: dict[str, list[float]] = {name: [] for name in HEADLINE}
    for _ in range(int(os.environ.get("BENCH_RUNS", "1"))):
        for name in HEADLINE:
            t0 = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs[name].append(time.time() - t0)
            spark.catalog.clearCache()
    times = {name: round(median(t), 3) for name, t in runs.items()}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else None}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
