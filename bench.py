"""Time the registered queries; prints one JSON line.

Each query runs once untimed on the smallest sample, so that code generation and class
loading are warm, then once timed on ``$BENCH_SF_DIR``. Results go to a sink that takes
every row and stores none. ``BENCH_QUERIES`` limits the run to some names.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.registry import queries  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    wanted = os.environ.get("BENCH_QUERIES", "")
    spark = build_session(
        "tidemark-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    found = queries()
    names = wanted.split(",") if wanted else list(found)
    seconds = {}
    for name in names:
        if os.path.isdir(warm_dir):
            found[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
        start = time.perf_counter()
        found[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
