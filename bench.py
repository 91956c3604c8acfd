"""Time the headline queries and print one JSON line.

Each query is written to the no-op sink, so all of its columns are computed. It is
run once to warm up and then a few times; the median counts. Planning and the
size checks of dimensions are part of the time. The "yardstick" times the same
results from separate id sets joined to the events; it is not in the total.
"""

import json
import os
import statistics
import time

from tallyfold.session import build_session
from tallyfold.workload.queries import QUERIES
from tallyfold.workload.yardstick import YARDSTICK

HEADLINE = [
    "ios_transactions",
    "play_transactions",
    "unified_transactions",
    "customer_rollup_any",
    "customer_rollup_latest",
    "activation_rollup",
    "ad_spend",
    "asa_flatten",
    "tiktok_flatten",
    "meta_flatten",
    "price_lookup",
    "adgroup_lookup",
    "trial_semi_join",
    "latest_product",
]


def seconds(run):
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def median(query):
        def run():
            query(spark, folder).write.format("noop").mode("overwrite").save()

        run()
        return round(statistics.median(seconds(run) for _ in range(repeats)), 3)

    times = {name: median(QUERIES[name]) for name in names}
    yardstick = {name: median(q) for name, q in YARDSTICK.items() if name in names}
    print(
        json.dumps(
            {
                "metric": "headline queries, median warm run, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "yardstick": yardstick,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
