"""Command line: `spark-submit -m`-style entry for each job.

    python -m segmart generate --counts valid=700000 bad_age=60000 --out users_csv
    python -m segmart load     --users users_csv --landing landing
    python -m segmart clean    --landing landing --clean clean --profile strict
    python -m segmart star     --clean clean --star star
    python -m segmart check    --star star
    python -m segmart merge    --target star_old --staging star --out star_new
    python -m segmart version  --star star --root star_versions
    python -m segmart merge    --root star_versions --staging star_new
    python -m segmart publish  --star star --url jdbc:... --properties props.json
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from segmart import fixed_values as fv
from segmart.plans import jobs, versioned
from segmart.session import build_session
from segmart.sources import lists, synthetic, tables
from segmart.sources.jdbc import JdbcTarget
from segmart.sources.landing import write_users_csv


def class_count(text: str) -> tuple[str, int]:
    name, _, count = text.partition("=")
    return name, int(count)


def read_map(spark: SparkSession, path: str) -> DataFrame:
    """A lookup map: one pair a line in a `.jsonl` file, else one JSON object."""
    return (lists.read_lookup_lines if path.endswith(".jsonl") else lists.read_lookup)(spark, path)


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="segmart")
    commands = root.add_subparsers(dest="command", required=True)

    generate = commands.add_parser("generate", help="write synthetic dirty users as CSV")
    generate.add_argument("--counts", nargs="+", type=class_count, required=True, metavar="CLASS=N")
    generate.add_argument("--cities", help="CSV with a city column; a short list if it is missing")
    generate.add_argument("--as-of", type=date.fromisoformat, default=date.today())
    generate.add_argument("--out", required=True)

    load = commands.add_parser("load", help="user CSV to landing files of JSON documents")
    load.add_argument("--users", required=True)
    load.add_argument("--landing", required=True)
    load.add_argument("--append", action="store_true")
    load.add_argument("--single-line", action="store_true", help="no line breaks inside values")

    clean = commands.add_parser("clean", help="landing files to the cleaned table")
    clean.add_argument("--landing", required=True)
    clean.add_argument("--clean", required=True)
    clean.add_argument("--profile", choices=("strict", "sentinel", "tag", "tag_flat"), default="strict")
    clean.add_argument("--provinces", help="CSV with a city column; the built-in list if not given")
    clean.add_argument("--run-date", type=date.fromisoformat, default=date.today())
    clean.add_argument("--overwrite", choices=("dynamic", "static"), default="dynamic")
    clean.add_argument("--rejects", help="folder for the rows that the strict profile rejects")
    clean.add_argument("--single-line", action="store_true", help="no line breaks inside values")

    star = commands.add_parser("star", help="cleaned table to dimensions, fact and insight")
    star.add_argument("--clean", required=True)
    star.add_argument("--star", required=True)
    star.add_argument("--known", help="star of an earlier run whose ids are kept")
    star.add_argument("--regions", help="province to region, a JSON object or .jsonl with a pair a line; built-in if not given")
    star.add_argument("--categories", help="occupation to category, in the same forms")
    star.add_argument("--repeated", choices=("stop", "aside"), default="stop", help="ids with several names")
    star.add_argument("--run-date", type=date.fromisoformat, default=date.today())

    check = commands.add_parser("check", help="list violated constraints")
    check.add_argument("--star", required=True)

    version = commands.add_parser("version", help="first version of a versioned star")
    version.add_argument("--star", required=True)
    version.add_argument("--root", required=True, help="folder of the versions")

    merge = commands.add_parser("merge", help="upsert one star into another")
    into = merge.add_mutually_exclusive_group(required=True)
    into.add_argument("--root", help="versioned star that gets a further version")
    into.add_argument("--target", help="star that stays as it is; the merged one goes to --out")
    merge.add_argument("--staging", required=True)
    merge.add_argument("--out")

    publish = commands.add_parser("publish", help="star to a relational target")
    publish.add_argument("--star", required=True)
    publish.add_argument("--url", required=True)
    publish.add_argument("--properties", help="JSON file with user, password, driver")
    publish.add_argument("--mode", choices=("overwrite", "staging"), default="overwrite")
    return root


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"segmart {args.command}")
    if args.command == "generate":
        cities = fv.PROVINCES
        if args.cities:
            # The list of cities is a literal of the plan, so it is read to the driver.
            found = lists.read_city_list(spark, args.cities, fallback=fv.FALLBACK_CITIES)
            cities = lists.bounded_values(found)
        users = synthetic.synth_users(spark, dict(args.counts), args.as_of, cities)
        write_users_csv(users, args.out)
    elif args.command == "load":
        jobs.load_job(spark, args.users, args.landing, args.append, not args.single_line)
    elif args.command == "clean":
        provinces = lists.read_city_list(spark, args.provinces) if args.provinces else fv.PROVINCES
        jobs.clean_job(
            spark, args.landing, args.clean, args.profile, args.run_date, provinces,
            args.overwrite, multi_line=not args.single_line, rejects_root=args.rejects,
        )
    elif args.command == "star":
        maps = [p and read_map(spark, p) for p in (args.regions, args.categories)]
        jobs.star_job(spark, args.clean, args.star, args.run_date, args.known, *maps, args.repeated)
    elif args.command == "check":
        jobs.failed_constraints(spark, args.star).show(100, truncate=False)
    elif args.command == "version":
        versioned.create_version(spark, args.root, tables.read_tables(spark, args.star))
    elif args.command == "merge" and args.root:
        versioned.merge_version(spark, args.root, tables.read_tables(spark, args.staging))
    elif args.command == "merge":
        if not args.out:
            raise SystemExit("merge --target needs --out")
        jobs.merge_job(spark, args.target, args.staging, args.out)
    elif args.command == "publish":
        properties = {}
        if args.properties:
            with open(args.properties, encoding="utf-8") as file:
                properties = json.load(file)
        jobs.publish_job(spark, args.star, JdbcTarget(args.url, properties), args.mode)


if __name__ == "__main__":
    main()
