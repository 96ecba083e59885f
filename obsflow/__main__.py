"""Command line of the training job."""

from __future__ import annotations

import argparse
import json

from obsflow.plans.job import run_job
from obsflow.sources.session import create_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="obsflow", description="Train temperature models from observation files")
    parser.add_argument("--data-path", required=True, help="directory of observation files")
    parser.add_argument("--output-path", required=True, help="directory for models and metrics")
    parser.add_argument("--train-ratio", type=float, default=0.7, help="share of rows used for training")
    parser.add_argument("--resume", help="directory of a stopped run to go on with")
    args = parser.parse_args()
    spark = create_session()
    try:
        metrics = run_job(spark, args.data_path, args.output_path, args.train_ratio, resume=args.resume)
        print(json.dumps(metrics))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
