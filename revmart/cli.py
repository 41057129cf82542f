"""Run one stage as a batch job, e.g. with spark-submit:

    python -m revmart.cli landing --pages /lake/pages --out /lake/landing
    python -m revmart.cli bronze --in /lake/landing --out /lake/bronze [--months 2022-07]
    python -m revmart.cli silver --in /lake/bronze --out /lake/silver
    python -m revmart.cli gold   --in /lake/silver --out /lake/gold
    python -m revmart.cli report --in /lake/silver [--landing /lake/landing] --out /lake/report

Paths are whatever the cluster's file system accepts. An option that a stage does
not use is refused. ``report`` writes every
validation result whole, as Parquet under its name, and prints where and how
many rows.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import functions as F

from revmart.plans.jobs import (
    bronze_job,
    gold_job,
    landing_job,
    landing_job_from_xml_files,
    quality_report,
    silver_job,
)
from revmart.session import get_session
from revmart.sources.feed import read_pages, unknown_tags


#: What each stage uses besides ``--master``; landing by its page format.
LANDING = {"pages", "pages_format", "out", "files", "quarantine", "mode"}
USES = {
    "landing": LANDING | {"log_unknown_tags"},
    "landing xml-entries": LANDING,
    "bronze": {"src", "out", "months", "files"},
    "silver": {"src", "out", "months", "files"},
    "gold": {"src", "out", "files"},
    "report": {"src", "out", "landing"},
}


def refuse_unused(ap: argparse.ArgumentParser, args: argparse.Namespace) -> None:
    stage = f"{args.stage} {args.pages_format}" if f"{args.stage} {args.pages_format}" in USES else args.stage
    names = {a.dest: a.option_strings[0] for a in ap._actions if a.option_strings}
    given = {d for d in names if d not in ("help", "master") and getattr(args, d) != ap.get_default(d)}
    unused = sorted(names[d] for d in given - USES[stage])
    if unused:
        ap.error(f"{stage} does not use {', '.join(unused)}")


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="revmart")
    ap.add_argument("stage", choices=["landing", "bronze", "silver", "gold", "report"])
    ap.add_argument("--in", dest="src", help="input zone (bronze, silver, gold, report)")
    ap.add_argument("--pages", help="landed pages (landing)")
    ap.add_argument("--pages-format", default="parquet", choices=["parquet", "xml", "xml-entries"])
    ap.add_argument("--out", help="output zone or report folder")
    ap.add_argument("--landing", default=None, help="report: landing zone, for its two checks")
    ap.add_argument("--log-unknown-tags", action="store_true", help="landing: count feed tags that are not kept (one more pass)")
    ap.add_argument("--files", default=None, help="landing/bronze/silver/gold: keep, rebalance, compact or a number of files")
    ap.add_argument("--quarantine", default=None, help="landing, PERMISSIVE: zone for malformed pages")
    ap.add_argument("--mode", default="FAILFAST", choices=["FAILFAST", "PERMISSIVE"])
    ap.add_argument("--months", default=None, help="bronze/silver: comma list of yyyy-MM to rebuild")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    refuse_unused(ap, args)
    logging.basicConfig(level=logging.INFO, format="%(message)s")

    spark = get_session(master=args.master)
    months = [m.strip() for m in args.months.split(",")] if args.months else None
    files = {} if args.files is None else {"files": int(args.files) if args.files.isdigit() else args.files}
    if args.stage == "landing" and args.pages_format == "xml-entries":
        landing_job_from_xml_files(spark, args.pages, args.out, args.mode, quarantine_path=args.quarantine, **files)
    elif args.stage == "landing":
        pages = read_pages(spark, args.pages, args.pages_format)
        landing_job(spark, pages, args.out, args.mode, quarantine_path=args.quarantine, **files)
        if args.log_unknown_tags:
            for tag, count in sorted(unknown_tags(pages).collect()):  # one row per tag name
                logging.info("feed tag not kept: %s (%d times)", tag, count)
    elif args.stage == "bronze":
        bronze_job(spark, args.src, args.out, months=months, **files)
    elif args.stage == "silver":
        silver_job(spark, args.src, args.out, months=months, **files)
    elif args.stage == "gold":
        gold_job(spark, args.src, args.out, **files)
    else:
        if not args.out:
            ap.error("report needs --out")
        for name, df in quality_report(spark, args.src, landing_path=args.landing).items():
            path = f"{args.out.rstrip('/')}/{name}"
            # typed: a check of empty columns has no value to take a type from
            typed = [F.col(c).cast("string").alias(c) if t == "void" else F.col(c) for c, t in df.dtypes]
            df.select(*typed).write.mode("overwrite").parquet(path)
            print(f"-- {name}: {spark.read.parquet(path).count()} rows in {path}")


if __name__ == "__main__":
    main()
