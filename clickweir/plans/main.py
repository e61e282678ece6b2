"""Command line: ``spark-submit`` entry for the bronze, silver, gold and live jobs."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from clickweir.plans import bronze, gold, live, silver
from clickweir.plans.config import Layout
from clickweir.sources import raw


def _arguments(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="clickweir")
    parser.add_argument("--root", required=True, help="folder that holds the tables")
    parser.add_argument("--format", default="parquet", help="table format")
    jobs = parser.add_subparsers(dest="job", required=True)

    ingest = jobs.add_parser("bronze", help="ingest raw events")
    ingest.add_argument("--mode", choices=["batch", "streaming"], default="streaming")
    ingest.add_argument("--input", help="line files (batch), or a folder to watch instead of a topic")
    ingest.add_argument("--json-array", action="store_true", help="each input file is one JSON array")
    ingest.add_argument("--output", default="", help="bronze table path")
    ingest.add_argument("--kafka-servers", default="localhost:9092")
    ingest.add_argument("--topic", default="raw_events")
    ingest.add_argument("--trigger-interval", default="10 seconds")

    def dated(job):
        job.add_argument("--date", help="one date; default is the newest partition")
        job.add_argument("--start-date")
        job.add_argument("--end-date")
        job.add_argument("--silver-path", default="")

    def alerting(job):
        job.add_argument("--alert-format", default="json", help="format of the alert sink; kafka sends messages")
        job.add_argument("--alert-option", action="append", default=[], metavar="NAME=VALUE", help="option of the alert sink")

    refine = jobs.add_parser("silver", help="bronze to silver")
    dated(refine)
    refine.add_argument("--bronze-path", default="")
    refine.add_argument("--skip-anomalies", action="store_true")
    alerting(refine)

    follow = jobs.add_parser("live", help="keep silver and gold in step with bronze")
    follow.add_argument("--trigger-interval", default="1 minute")
    follow.add_argument("--available-now", action="store_true", help="stop when all that is there is done")
    follow.add_argument("--with-gold", action="store_true")
    follow.add_argument("--skip-anomalies", action="store_true")

    roll = jobs.add_parser("gold", help="silver to gold")
    dated(roll)
    roll.add_argument("--mode", choices=[*gold.MODES, "trends", "all"], default="all")
    roll.add_argument("--window", help="window width; default 1h, funnels 24h, trends 5m")
    alerting(roll)
    return parser.parse_args(argv)


def main(argv=None) -> dict | None:
    args = _arguments(argv)
    spark = SparkSession.builder.appName(f"clickweir-{args.job}").getOrCreate()
    paths = {
        "bronze": getattr(args, "output", "") or getattr(args, "bronze_path", ""),
        "silver": getattr(args, "silver_path", ""),
    }
    options = dict(text.split("=", 1) for text in getattr(args, "alert_option", []))
    layout = Layout(args.root, fmt=args.format, alert_fmt=getattr(args, "alert_format", "json"), alert_options=options, **paths)
    if args.job == "bronze" and args.mode == "streaming":
        source = raw.stream_lines(spark, args.input) if args.input else raw.stream_topic(
            spark, args.kafka_servers, args.topic)
        bronze.start_stream(source, layout, trigger={"processingTime": args.trigger_interval}).awaitTermination()
        return None
    if args.job == "live":
        trigger = {"availableNow": True} if args.available_now else {"processingTime": args.trigger_interval}
        live.start_silver(
            spark, layout, trigger=trigger, with_gold=args.with_gold, skip_anomalies=args.skip_anomalies).awaitTermination()
        return None
    if args.job == "bronze":
        stats = bronze.run_batch(spark, layout, args.input, json_array=args.json_array)
    else:
        dates = {"event_date": args.date, "start": args.start_date, "end": args.end_date}
        if args.job == "silver":
            stats = silver.run(spark, layout, skip_anomalies=args.skip_anomalies, **dates)
        elif args.mode == "all":
            widths = {"kpi_window": args.window, "funnel_window": args.window} if args.window else {}
            stats = gold.run_all(spark, layout, **widths, **dates)
        else:
            width = {"window": args.window} if args.window and args.mode != "sessions" else {}
            stats = getattr(gold, f"run_{args.mode}")(spark, layout, **width, **dates)
    print(json.dumps(stats))
    return stats


if __name__ == "__main__":
    main()
