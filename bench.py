"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores. A query is timed from
building its plan to the last row, every column computed (``noop`` sink).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from lakeloom.session import build_session  # noqa: E402

HEADLINE = [
    "norm_4",
    "agg_1",
    "agg_10",
    "join_2",
    "win_1",
    "type_1",
    "rsh_3",
    "rsh_4",
    "rsh_5",
    "rsh_7",
    "comb_1",
    "comb_2",
    "sub_1",
    "sub_3",
    "est_6",
    "prp_1",
    "job_1",
    "job_3",
    "job_4",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        # shuffles are megabytes here: small targets keep all cores busy in writes
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4m",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["agg_3"](spark, folder).write.format("noop").mode("overwrite").save()  # starts the JVM's engines
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        runs = []
        for _ in range(repeats):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(sorted(runs)[len(runs) // 2], 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
