"""Command line: ``python -m sensorloom STEP --root TABLES``, also for ``spark-submit``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from sensorloom.plans import jobs
from sensorloom.plans.models import load
from sensorloom.streaming import refresh
from sensorloom.streaming.eventtime import CursorLog


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="sensorloom")
    steps = parser.add_subparsers(dest="step", required=True)
    step = {
        name: steps.add_parser(name)
        for name in (
            "etl", "eda", "features", "train", "predict", "forecast", "report", "stream", "compact"
        )
    }
    for one in step.values():
        one.add_argument("--root", required=True, help="folder of the tables")
    for name in ("etl", "stream"):
        step[name].add_argument("--raw", required=True, help="landing folder")
        step[name].add_argument("--parameter", default="pm25")
        step[name].add_argument("--json-lines", action="store_true", help="one object per line")
    for name in ("etl", "stream"):
        step[name].add_argument("--no-fallback", action="store_true", help="ignore daily files")
        step[name].add_argument("--sensors", help="comma-separated ids; all if not given")
        step[name].add_argument("--from", dest="start", help="first time")
        step[name].add_argument("--to", dest="end", help="last time")
        step[name].add_argument("--lag-hours", type=int, help="leave out newer readings; they count later")
    step["stream"].add_argument("--every", default="600 seconds")
    step["stream"].add_argument("--once", action="store_true")
    step["stream"].add_argument("--max-files", type=int)
    step["stream"].add_argument("--score-with", help="folder of a stored model")
    step["stream"].add_argument("--progress", help="folder for a line per batch of event times and late rows")
    for name in ("stream", "compact"):
        step[name].add_argument("--fan", type=int, default=8, help="folders of a table that are merged into one")
    step["train"].add_argument("--models", default="lr,rf,gbt")
    step["train"].add_argument("--tree-sample", type=float, default=0.3)
    step["train"].add_argument("--rf-trees", type=int, default=30)
    step["train"].add_argument("--rf-depth", type=int, default=6)
    step["train"].add_argument("--rf-bins", type=int, default=32)
    step["train"].add_argument("--gbt-iterations", type=int, default=50)
    step["train"].add_argument("--gbt-depth", type=int, default=5)
    for name in ("predict", "forecast", "report"):
        step[name].add_argument("--model", default="lr")
    step["report"].add_argument("--rows", type=int, default=200, help="newest predictions; 0 for all")
    step["report"].add_argument("--table", choices=["holdout", "scored"], default="holdout")
    step["report"].add_argument("--year", type=int, help="year of the monthly means")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"sensorloom-{args.step}").getOrCreate()
    if args.step in ("etl", "stream"):
        layout = {"multi_line": not args.json_lines, "fallback": not args.no_fallback}
        layout |= {"sensors": args.sensors, "start": args.start, "end": args.end}
        layout["lag_hours"] = args.lag_hours
        if args.json_lines:
            layout["files"] = "*.json"
    if args.step == "etl":
        print(jobs.etl(spark, args.raw, args.root, args.parameter, **layout))
    elif args.step == "eda":
        jobs.eda(spark, args.root)
    elif args.step == "features":
        print(jobs.build_features(spark, args.root))
    elif args.step == "train":
        params = {
            "random_forest": {
                "numTrees": args.rf_trees,
                "maxDepth": args.rf_depth,
                "maxBins": args.rf_bins,
            },
            "gbt_regression": {"maxIter": args.gbt_iterations, "maxDepth": args.gbt_depth},
        }
        jobs.train(spark, args.root, args.models.split(","), args.tree_sample, params).show()
    elif args.step == "predict":
        print(jobs.predict(spark, args.root, args.model))
    elif args.step == "forecast":
        print(jobs.forecast(spark, args.root, args.model))
    elif args.step == "report":
        jobs.report(spark, args.root, args.model, args.table, args.rows or None, args.year)
    elif args.step == "compact":
        print(refresh.compact(spark, args.root, args.fan))
    else:
        if args.progress:
            spark.streams.addListener(CursorLog(spark, args.progress))
        query = refresh.start_landing_refresh(
            spark,
            args.raw,
            args.root,
            parameter=args.parameter,
            every=args.every,
            once=args.once,
            max_files_per_trigger=args.max_files,
            model=load(args.score_with) if args.score_with else None,
            fan=args.fan,
            **layout,
        )
        query.awaitTermination()


if __name__ == "__main__":
    main()
