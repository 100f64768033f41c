"""python -m tests.run_oracle [--sf 0.01] [name ...]: all queries against their SQL."""

from __future__ import annotations

import argparse
import time
import traceback

from tests.oracle import compare, connect
from tidemark.plans.catalog import QUERIES
from tidemark.session import build_session


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark = build_session(
        "oracle",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in args.names or sorted(QUERIES):
        start = time.time()
        try:
            q = QUERIES[name]
            df = q(spark, sf_dir)
            if q.sql:
                verdict, detail = compare(df, con, q.sql)
            else:
                rows = df.collect()
                verdict, detail = "rows", f"{len(rows)} rows {rows[:1]}"
        except Exception as exc:  # noqa: BLE001
            verdict, detail = "error", str(exc)[:600]
            if args.names:
                traceback.print_exc()
        bad += verdict not in ("ok", "rows")
        print(f"{verdict:6} {name:26} {time.time() - start:6.2f}s {detail}", flush=True)
    print(f"{bad} not ok of {len(args.names or QUERIES)}")
    return bool(bad)


if __name__ == "__main__":
    raise SystemExit(main())
