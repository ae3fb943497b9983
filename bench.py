#!/usr/bin/env python
"""Bench: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

1. prepare -- the stand-in tables are derived from the test data and
   written once as Parquet (what a deployment reads instead of the stand-ins);
2. run -- each query is executed to a ``noop`` sink over those Parquet tables,
   three times; the fastest run counts (the first also warms the JVM).

Prints ONE JSON line on stdout.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tokoledger import catalog  # noqa: E402
from tokoledger.session import checkpoint_dir, local_session  # noqa: E402
from tokoledger.sources.tables import from_parquet, from_testdata, materialize  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    passes = int(os.environ.get("BENCH_PASSES", "3"))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = local_session(cores=cpus, shuffle_partitions=max(2 * cpus, 8), app="tokoledger-bench")

    root = f"{checkpoint_dir(spark).rstrip('/')}/bench-tables-{uuid.uuid4().hex[:8]}"
    t0 = time.perf_counter()
    materialize(from_testdata(spark, sf_dir), root)
    spark.catalog.clearCache()          # the stand-ins are stored now; queries read the Parquet copies
    prepare = time.perf_counter() - t0

    tables = from_parquet(spark, root)
    builders = catalog.builders()
    names = [n for n in builders if not wanted or n in wanted]
    best: dict[str, float] = {}
    for _ in range(passes):
        for name in names:
            t0 = time.perf_counter()
            builders[name](tables).write.format("noop").mode("overwrite").save()
            sec = time.perf_counter() - t0
            best[name] = min(sec, best.get(name, float("inf")))

    sf = os.path.basename(sf_dir).removeprefix("sf")
    out = {
        "metric": "total_query_sec",
        "value": round(sum(best.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in best.items()},
        "sf": sf,
        "prepare_sec": round(prepare, 3),
        "cpus": cpus,
        "passes": passes,
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
