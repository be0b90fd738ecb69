"""Time the 34 metrics over the star tables and print one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) on local[BENCH_CPUS]. The billing
tables are derived and written first, timed as `derive`; the metrics then read them as
a user reads stored billing tables. Every row of every result is produced. The seconds
are of one cold run; BENCH_WARM=n adds the best of n further runs.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from functools import lru_cache

from subtally.catalog import metric_queries
from subtally.session import build_session
from subtally.sources.schemas import SCHEMAS
from subtally.sources.star import billing_tables


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        f"local[{cpus}]",
        "subtally-bench",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(run) -> float:
        start = time.perf_counter()
        run()
        return round(time.perf_counter() - start, 3)

    # The bench is one local process, so a folder of its own may be local.
    root = os.environ.get("BENCH_FOLDER") or tempfile.mkdtemp(prefix="subtally-bench-")

    @lru_cache
    def stored(session, folder, layout):
        return billing_tables(session, folder, layout, f"{root}/{layout}")

    def derive() -> None:
        for layout, tables in SCHEMAS.items():
            for name in tables:
                getattr(stored(spark, sf_dir, layout), name)

    def produce(query) -> None:
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()

    derive_seconds = timed(derive)
    wanted = sys.argv[1:]
    queries = {k: q for k, q in metric_queries(stored).items() if not wanted or k in wanted}
    seconds = {key: timed(lambda q=query: produce(q)) for key, query in queries.items()}
    again = int(os.environ.get("BENCH_WARM", "0"))
    warm = {
        key: min(timed(lambda q=query: produce(q)) for _ in range(again))
        for key, query in queries.items() if again
    }
    print(
        json.dumps(
            {
                "metric": "metrics_total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "derive": derive_seconds,
                **({"warm": warm, "warm_total": round(sum(warm.values()), 3)} if warm else {}),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
