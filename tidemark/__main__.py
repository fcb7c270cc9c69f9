"""Run the jobs: ``spark-submit --py-files tidemark.zip -m tidemark <command> --root <folder>``.

    seed       write the device seed
    land       both message streams into bronze           (standing)
    enrich     silver and the health windows              (standing)
    tier       flush every table at its own freshness     (standing)
    watch      sample the gap between the tiers, round by round
    maintain   compact, expire and age out, once
    sql        answer one query over the tables' views
"""

from __future__ import annotations

import argparse
import time

from tidemark.operators import maintenance
from tidemark.plans import analytics
from tidemark.session import build_session
from tidemark.sources import messages
from tidemark.streaming.jobs import Lakehouse
from tidemark.streaming.monitor import FreshnessMonitor


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__.split("\n")[0])
    parser.add_argument("command", choices=["seed", "land", "enrich", "tier", "watch", "maintain", "sql"])
    parser.add_argument("query", nargs="?", help="the SELECT of the sql command")
    parser.add_argument("--root", required=True, help="folder of the tables, shared by all executors")
    parser.add_argument("--master", help="default: what spark-submit says")
    parser.add_argument("--servers", help="Kafka bootstrap servers; the topics are the two below")
    parser.add_argument("--telemetry", default="iot-telemetry", help="topic, or folder of JSON lines")
    parser.add_argument("--events", default="iot-events", help="topic, or folder of JSON lines")
    parser.add_argument("--every", default="10 seconds", help="trigger of the land and enrich jobs")
    parser.add_argument("--windows", choices=["arrival", "ingest_time", "event_time"], default="arrival")
    parser.add_argument("--files-per-batch", type=int, help="files one micro-batch may write to a table")
    parser.add_argument("--slices", type=int, default=8, help="files the device dimension is hashed into")
    parser.add_argument("--rounds", type=int, default=6)
    parser.add_argument("--pause", type=float, default=15.0)
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    spark = build_session(args.master, f"tidemark-{args.command}")
    house = Lakehouse(spark, args.root, args.slices, args.files_per_batch)
    every = {"processingTime": args.every}

    def source(name: str):
        return messages.from_topic(spark, args.servers, name) if args.servers else messages.from_folder(spark, name)

    if args.command == "seed":
        house.dimension.seed()
    elif args.command == "land":
        house.start_landing(source(args.telemetry), source(args.events), every)
        spark.streams.awaitAnyTermination()
    elif args.command == "enrich":
        house.start_enrichment(every)
        house.start_health(every, over=args.windows)
        spark.streams.awaitAnyTermination()
    elif args.command == "tier":
        house.start_tiering()
        spark.streams.awaitAnyTermination()
    elif args.command == "watch":
        monitor = FreshnessMonitor(spark, f"{args.root}/freshness")
        for _ in range(args.rounds):
            monitor.sample(house.silver)
            monitor.samples().orderBy("round").show(truncate=False)
            analytics.hot_devices(house.silver.read()).show(truncate=False)
            time.sleep(args.pause)
    elif args.command == "maintain":
        for table in house.tables.values():
            print(table.spec.name, maintenance.compact(table), maintenance.expire(table), maintenance.purge(table))
    else:
        house.register_views()
        spark.sql(args.query).show(100, truncate=False)


if __name__ == "__main__":
    main()
