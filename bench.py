"""Headline queries, timed warm; prints one JSON line.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the local cores.
``--variants`` times alternative plans of the same operator instead, ``--duckdb``
the SQL of the headline queries on DuckDB with as many threads.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.adapters import DATES, Tables  # noqa: E402
from tidemark.plans.catalog import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "clean_transactions",
    "make_anchors",
    "lookback_join",
    "forward_join",
    "customer_features",
    "attach_target",
    "time_series_folds",
    "zone_stats",
    "latest_per_entity",
    "pit_join",
    "pit_training_set",
    "drift_report",
    "categorize",
    "enrich_results",
    "conditional_counts_2key",
    "describe_column",
    "distinct_counts",
    "monthly_rollup",
    "keys_with_many",
    "one_hot_ignore_unknown",
    "head_tail_split",
    "binary_metrics",
    "pareto_front",
    "rouge_1",
    "bleu",
    "prepare_trips",
    "fold_summary",
    "target_correlation",
    "stream_latest_features",
    "stream_categorize",
    "train_classifier",
]
RUNS = 3


def run(build) -> None:
    build().write.format("noop").mode("overwrite").save()


def timed(build) -> float:
    run(build)
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run(build)
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 4)


def variants(t: Tables) -> dict:
    from tidemark.operators import customers as U

    def separate():
        tx = t.clean()
        joined = U.lookback_join(U.make_anchors(tx, DATES), tx, 90)
        return U.assemble(U.base_features(joined), U.activity_features(joined))

    return {
        "features from one reading": lambda: U.customer_features(t.clean(), DATES),
        "features from two joins": separate,
    }


def duckdb_seconds(sf_dir: str, cpus: str) -> dict[str, float]:
    from tests.oracle import connect

    con = connect(sf_dir)
    con.execute(f"SET threads = {cpus}")
    out = {}
    for name in (n for n in HEADLINE if QUERIES[n].sql):
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            con.execute(QUERIES[name].sql).fetchall()
            times.append(time.perf_counter() - start)
        out[name] = round(statistics.median(times), 4)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    if "--duckdb" in sys.argv:
        print(json.dumps(duckdb_seconds(sf_dir, cpus)))
        return
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    if "--variants" in sys.argv:
        builds = variants(Tables(spark, sf_dir))
    else:
        builds = {n: lambda n=n: QUERIES[n](spark, sf_dir) for n in HEADLINE}
    seconds = {name: timed(build) for name, build in builds.items()}
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
