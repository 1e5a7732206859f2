"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the folder of the tables, ``BENCH_CPUS`` the number of local threads. Every query runs
once to warm up; the best of three further runs counts. Results go to a sink that discards them, so a run
evaluates every row and column. Delimited input files are made once, in the warm-up.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from tallybook.queries import QUERIES  # noqa: E402
from tallybook.session import get_session  # noqa: E402
from tallybook.sources import adapters  # noqa: E402

HEADLINE = (
    "tx_report",
    "tx_rejects",
    "tx_outcome_counts",
    "tx_dedup_first",
    "tx_dedup_skew_safe",
    "tx_literal_key_dedup",
    "acct_interest",
    "acct_rejects",
    "mov_statement",
    "mov_statement_ids",
    "mov_account_summary",
    "csv_tx_report",
    "tx_commit_prefix",
    "run_all",
)
RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    made, write_lines = {}, adapters._write_lines

    def written_once(rows, purpose, header):
        if purpose not in made:
            made[purpose] = write_lines(rows, purpose, header)
        return made[purpose]

    adapters._write_lines = written_once
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of best runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
