"""Command line: ``spark-submit`` or ``python -m salesflow <job> ...``."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from salesflow import session
from salesflow.plans import jobs
from salesflow.rules import CleansingRules
from salesflow.sinks import files, warehouse
from salesflow.sources import landing, synthetic
from salesflow.streaming import ingest, refresh


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="salesflow")
    root.add_argument("--input-gb", type=float, help="size of the input, from which shuffle partitions and file splits follow")
    job = root.add_subparsers(dest="job", required=True)
    generate = job.add_parser("generate", help="write synthetic landing CSV")
    generate.add_argument("--rows", type=int, default=1_200_000)
    generate.add_argument("--seed", type=int, default=42)
    generate.add_argument("--landing", required=True)
    cleanse = job.add_parser("cleanse", help="landing CSV to the cleansed zone")
    cleanse.add_argument("--landing", required=True)
    cleanse.add_argument("--cleansed", required=True)
    cleanse.add_argument("--table", help="catalog table to register")
    cleanse.add_argument("--multi-line", action="store_true", help="values may hold quoted line breaks")
    cleanse.add_argument("--malformed", help="write malformed lines here instead of trimming or padding them")
    curate = job.add_parser("curate", help="cleansed zone to the fact and the KPIs")
    curate.add_argument("--cleansed", required=True)
    curate.add_argument("--curated", required=True)
    curate.add_argument("--full", action="store_true", help="replace the whole fact instead of merging touched days")
    refreshed = job.add_parser("refresh", help="landing rows that are new since the last call into the curated zone")
    refreshed.add_argument("--landing", required=True)
    refreshed.add_argument("--curated", required=True)
    refreshed.add_argument("--checkpoint", required=True)
    load = job.add_parser("load", help="curated zone to the warehouse tables and views")
    load.add_argument("--curated", required=True)
    load.add_argument("--database", default="sales_dw")
    load.add_argument("--warehouse", required=True)
    load.add_argument("--months", nargs="*", help="load only these months of the fact, written 2024-05")
    return root


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"salesflow-{args.job}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if args.input_gb:
        session.apply(spark, int(args.input_gb * 1e9))
    now = datetime.now(timezone.utc)
    run_ts = jobs.run_timestamp(now.strftime("%Y-%m-%d %H:%M:%S+00:00"))
    if args.job == "generate":
        files.write_csv(synthetic.generate_sales(spark, args.rows, args.seed), args.landing)
    elif args.job == "cleanse":
        if args.malformed:
            raw, malformed = landing.split_corrupt(landing.read_landing_lines(spark, args.landing))
            malformed.write.mode("overwrite").parquet(args.malformed)
        else:
            raw = landing.with_arrival(landing.read_landing_csv(spark, args.landing, multi_line=args.multi_line))
        rules = CleansingRules(first_by=landing.ARRIVAL)
        checked = jobs.cleanse(spark, raw, args.cleansed, rules, run_ts=run_ts, table=args.table)
        jobs.step_drops(jobs.quality_funnel(checked)).show(truncate=False)
    elif args.job == "curate":
        zone = landing.read_cleansed(spark, args.cleansed)
        made = jobs.curate(spark, zone, args.curated, run_ts, full=args.full)
        for name, excerpt in jobs.console_summary(made).items():
            print(name)
            excerpt.show(truncate=False)
    elif args.job == "refresh":
        refresh.refresh_available(ingest.stream_landing_csv(spark, args.landing), args.curated, args.checkpoint)
    else:
        load_id = now.strftime("%Y%m%dT%H%M%S")
        months = [tuple(int(part) for part in month.split("-")) for month in args.months] if args.months else None
        jobs.load(spark, args.curated, args.database, args.warehouse, load_id, months=months).show(truncate=False)
        warehouse.create_views(spark, args.database)


if __name__ == "__main__":
    main()
