"""Time the registered queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the number of cores; arguments choose queries.
"""

import json
import os
import sys
import time

from clickmill.plans.queries import REGISTRY
from clickmill.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
# These run the whole daily job once more, as `daily_run_by_day` does; name them to time them.
REPEATS = {"users_by_day", "weekly_estimates_by_day", "future_rows_by_run", "stream_fact"}
CPUS = os.environ.get("BENCH_CPUS", "8")


def seconds(spark, name: str) -> float:
    """One full evaluation, all columns of all rows; queries that write tables run as a whole."""
    start = time.perf_counter()
    REGISTRY[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    names = sys.argv[1:] or [name for name in REGISTRY if name not in REPEATS]
    spark = build_session(
        "clickmill-bench",
        master=f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds(spark, "daily_kpis")  # start-up of the session and the code cache is not timed
    times = {name: seconds(spark, name) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of all queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
