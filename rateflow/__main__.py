"""``python -m rateflow INPUT_FOLDER VALIDATION_FILE OUTPUT``: the whole job from the command line."""

from __future__ import annotations

import argparse

from rateflow.plans.model import DEPTH, MAX_BINS, ROUNDS, SEARCH_PAIRS
from rateflow.plans.pipeline import run_pipeline
from rateflow.session import build_session, ensure_checkpoint_dir


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="rateflow", description=__doc__)
    parser.add_argument("input_folder")
    parser.add_argument("val_file")
    parser.add_argument("output")
    parser.add_argument("--master", default="local[*]")
    parser.add_argument("--rounds", type=int, default=ROUNDS)
    parser.add_argument("--depth", type=int, default=DEPTH)
    parser.add_argument("--max-bins", type=int, default=MAX_BINS)
    parser.add_argument("--search", action="store_true", help=f"choose among the (rounds, depth) pairs {SEARCH_PAIRS}")
    parser.add_argument("--bucketed", action="store_true", help="look values up over bucketed storage")
    parser.add_argument("--parity", action="store_true", help="keep the original arithmetic where code and intent differ")
    given = parser.parse_args(args)
    spark = build_session(given.master)
    ensure_checkpoint_dir(spark)
    result = run_pipeline(
        spark, given.input_folder, given.val_file, given.output, parity=given.parity, max_iter=given.rounds,
        max_depth=given.depth, max_bins=given.max_bins, search_pairs=SEARCH_PAIRS if given.search else None,
        bucketed=given.bucketed,
    )
    for bucket, n in result.histogram:
        print(f"bucket {bucket}: {n}")
    print(f"RMSE: {result.rmse}\nrows: {result.n_val}\nseconds: {result.seconds:.1f}")
    result.close()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
