"""Benchmark: the headline queries and the whole job on one scale factor.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_ROUNDS / BENCH_DEPTH (default 200 / 9, the job's own model settings),
BENCH_SEARCH (default 0; 1: the job's five search pairs are tried too, as a part of
its own after the rest), BENCH_SECONDS (default 1500: after so long, or when told to end,
the line is printed with the parts that are done and the others named).
Each part is reported on standard error as it ends; one JSON line goes to standard
output at the end. ``value`` is the whole job in seconds with all rounds
grown, timed from an existing session as the job timed itself (its timer
starts after its Spark context exists). Query times run each plan to completion with a ``noop``
sink, so no result is shipped to the driver.
"""

from __future__ import annotations

import json
import os
import re
import signal
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rateflow.operators.materialize import new_run_folder  # noqa: E402
from rateflow.plans.model import MAX_BINS, SEARCH_PAIRS  # noqa: E402
from rateflow.plans.pipeline import run_pipeline  # noqa: E402
from rateflow.plans.queries import QUERIES  # noqa: E402
from rateflow.session import build_session, ensure_checkpoint_dir  # noqa: E402
from rateflow.sources.tables import inputs_from_tables  # noqa: E402

# Fixed value: seconds that the original reports for its whole job, on hardware it does not state.
REFERENCE_SECONDS = 378.4

HEADLINE = [
    "feature_matrix",
    "join_business",
    "join_user",
    "join_tip",
    "rivals_per_area",
    "photo_count",
    "checkin_total",
    "tip_likes",
    "user_features",
    "rating_var_business",
    "rating_var_user",
    "eval_error_hist",
]


def search_times(spark, inputs, pairs=SEARCH_PAIRS) -> dict:
    """Seconds of a whole job that searches the pairs, and the held-out RMSE of each."""
    start = time.time()
    res = run_pipeline(spark, inputs=inputs, search_pairs=pairs)
    return {"seconds": round(time.time() - start, 3), "tried": res.tried, "trees": res.trees, "rmse": res.rmse}


def finish(report: dict) -> None:
    print(json.dumps(report), flush=True)


def stop_at(report: dict, seconds: int) -> None:
    """Print what is done when the time is up or the process is told to end; the running job ends with the process."""

    def stop(signum, _frame):
        report["stopped"] = signal.Signals(signum).name
        finish(report)
        os._exit(0)

    signal.signal(signal.SIGALRM, stop)
    signal.signal(signal.SIGTERM, stop)
    signal.alarm(seconds)


def part(report: dict, name: str, run) -> None:
    """Run one part, keep its seconds, and say so at once."""
    report["unfinished"].insert(0, name)
    start = time.time()
    run()
    report["queries"][name] = round(time.time() - start, 3)
    report["unfinished"].remove(name)
    print(f"bench: {name} {report['queries'][name]} s", file=sys.stderr, flush=True)


def measure(report: dict, spark, sf_dir: str, rounds: int, depth: int, with_search: bool) -> None:
    """All parts, the short ones first."""
    for name in HEADLINE:
        part(report, name, lambda name=name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())

    made = {}

    def job():
        made["inputs"] = inputs_from_tables(spark, sf_dir, gaps=True, folder=new_run_folder(spark))
        made["job"] = run_pipeline(spark, inputs=made["inputs"], max_iter=rounds, max_depth=depth)

    part(report, "pipeline", job)
    res = made["job"]
    report["value"] = report["queries"]["pipeline"]
    report["vs_reference"] = round(report["value"] / REFERENCE_SECONDS, 3)
    report.update({"stages": {k: round(v, 3) for k, v in res.stages.items()}, "trees": res.trees, "rmse": res.rmse,
               "n_val": res.n_val, "error_histogram": res.histogram})
    if with_search:
        part(report, "search", lambda: report.update(search=search_times(spark, made["inputs"])))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    rounds = int(os.environ.get("BENCH_ROUNDS", "200"))
    depth = int(os.environ.get("BENCH_DEPTH", "9"))
    match = re.search(r"sf([0-9.]+)", sf_dir)
    report = {
        "metric": f"whole_job_{rounds}x{depth}", "value": None, "unit": "sec", "queries": {}, "unfinished": [],
        "max_bins": MAX_BINS, "sf": float(match.group(1)) if match else sf_dir, "cpus": cpus,
    }
    stop_at(report, int(os.environ.get("BENCH_SECONDS", "1500")))
    spark = build_session(f"local[{cpus}]", cpus)
    ensure_checkpoint_dir(spark)
    measure(report, spark, sf_dir, rounds, depth, os.environ.get("BENCH_SEARCH", "0") != "0")
    signal.alarm(0)
    finish(report)


if __name__ == "__main__":
    main()
