"""Time every registered query; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Each query runs
whole into a sink that discards rows. A first pass warms the JVM up; the
second is measured (BENCH_WARMUP=0 leaves the first pass out).
"""

from __future__ import annotations

import json
import os
import sys
import time

from hearthmill.queries import QUERIES
from hearthmill.session import local_session


# Its time goes into creating one local file per message before the scan.
NOT_TIMED = {"email_corpus_scan"}


def timed(query, spark, sf_dir) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or [name for name in QUERIES if name not in NOT_TIMED]
    spark = local_session(cpus)
    if os.environ.get("BENCH_WARMUP", "1") != "0":
        for name in names:
            timed(QUERIES[name], spark, sf_dir)
    seconds = {name: timed(QUERIES[name], spark, sf_dir) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
