"""Time every registered query and print one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS set the tables, the local cores and the runs per query, of
which the fastest counts. The time includes building the query and whatever it writes on the way;
its rows go to Spark's noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cartpath import build_session  # noqa: E402
from cartpath.plans.queries import queries  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(query) -> float:
        started = time.perf_counter()
        query(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    registered = queries()
    seconds(registered["customer_journeys"])  # start-up of the JVM is not a query's time
    times = {name: round(min(seconds(query) for _ in range(runs)), 3) for name, query in registered.items()}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
