"""``python -m courtline --input <csv glob> --output <folder>``"""

from __future__ import annotations

import argparse

from .plans.pipeline import run_pipeline
from .session import create_spark_session
from .sources.event_files import DEFAULT_PATH


def main() -> None:
    parser = argparse.ArgumentParser(prog="courtline", description="Build the fact tables.")
    parser.add_argument("--input", default=DEFAULT_PATH)
    parser.add_argument("--output", default="data/processed")
    parser.add_argument("--three-point-rule", choices=("points", "3PT"), default="points")
    parser.add_argument("--overwrite", choices=("static", "dynamic"), default="static")
    parser.add_argument(
        "--work", help="folder for intermediate tables that all executors share; on a cluster needed"
    )
    args = parser.parse_args()
    conf = {"spark_checkpoint_dir": args.work} if args.work else {}
    spark = create_spark_session(**conf)
    seconds = run_pipeline(spark, args.input, args.output, args.three_point_rule, args.overwrite)
    for step, value in seconds.items():
        print(f"{step:<22}{value:9.2f} s")
    spark.stop()


if __name__ == "__main__":
    main()
