"""python -m wayfuse discover | topics | records | report"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from .plans import runs
from .sources import side_files


def bbox(text: str) -> tuple[float, ...]:
    found = tuple(float(x) for x in text.split(","))
    if len(found) != 4:
        raise argparse.ArgumentTypeError("min_lon,min_lat,max_lon,max_lat")
    return found


def origin(text: str) -> tuple[float, ...]:
    found = tuple(float(x) for x in text.split(","))
    if len(found) != 2:
        raise argparse.ArgumentTypeError("lon,lat")
    return found


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="wayfuse")
    top.add_argument("-v", "--verbose", action="store_true")
    sub = top.add_subparsers(dest="command", required=True)
    d = sub.add_parser("discover", help="profile the JSON files of a folder")
    d.add_argument("input_dir")
    d.add_argument("--sample", type=int)
    t = sub.add_parser("topics", help="topic documents to result tables")
    t.add_argument("-i", "--input-dir", required=True)
    t.add_argument("-o", "--output-dir", required=True)
    t.add_argument("-f", "--format", choices=("parquet", "csv"), default="parquet")
    t.add_argument("--mode", default="scenarios", choices=("all", "scenarios", "joined", "smart"))
    t.add_argument("--scenario-dirs", nargs="*")
    r = sub.add_parser("records", help="records to trajectories and fused records")
    r.add_argument("--config", help="YAML or JSON; flags that are given count before it")
    for name in ("--input-dir", "--output-dir", "--region-polygon-path", "--ids-map-path", "--rsu-ids-path", "--metadata-out", "--format"):
        r.add_argument(name)
    r.add_argument("--region-bbox", type=bbox)
    r.add_argument("--origin", type=origin)
    for name in ("--hz", "--sync-tolerance-ms", "--sample", "--workers"):
        r.add_argument(name, type=int)
    r.add_argument("--gap-threshold-s", type=float)
    r.add_argument("--use-enu", action=argparse.BooleanOptionalAction)
    p = sub.add_parser("report", help="the standard report over written tables")
    p.add_argument("data_dir")
    p.add_argument("--write", action="store_true")
    return top


def config_of(args: argparse.Namespace) -> side_files.PipelineConfig:
    given = {k: v for k, v in vars(args).items() if v is not None and k not in ("command", "config", "verbose")}
    base = {}
    if args.config:
        loaded = side_files.load_config(args.config)
        base = {f: getattr(loaded, f) for f in loaded.__dataclass_fields__}
    return side_files.config_from(base | given)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if args.verbose else logging.INFO)
    spark = SparkSession.builder.appName("wayfuse").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.command == "discover":
        from .operators.records import discovery_table

        discovery_table(runs.discover(spark, args.input_dir, args.sample)).show(truncate=False)
    elif args.command == "topics":
        runs.run_topics(spark, args.input_dir, args.output_dir, fmt=args.format, mode=args.mode, scenario_dirs=args.scenario_dirs).show()
    elif args.command == "records":
        print(runs.run_records(spark, config_of(args)).origin)
    else:
        for name, df in runs.report(spark, args.data_dir).items():
            print(name)
            df.show(20, truncate=False)
        if args.write:
            runs.write_report(spark, args.data_dir)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
