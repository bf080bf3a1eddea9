"""The jobs as commands: ``python -m signalmill <job> …``, settings by the usual Spark means."""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation, SparkSession

from signalmill.operators.inventory import elements, inventory_from_elements
from signalmill.operators.status import (
    health,
    landing_lag,
    lookup_status,
    status_by_id,
    status_json,
)
from signalmill.plans import jobs
from signalmill.schemas import DEFAULT_BBOX, SIGNAL_STATES, WATERMARK
from signalmill.session import configure
from signalmill.sources import core as core_table
from signalmill.sources import events as source
from signalmill.sources import inventory as places
from signalmill.sources import landing as table
from signalmill.sources import latest as latest_table
from signalmill.sources import partials
from signalmill.streaming import pipelines as streams


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="signalmill", description=__doc__)
    job = root.add_subparsers(dest="job", required=True)

    def add(name: str, text: str, *required: str) -> argparse.ArgumentParser:
        command = job.add_parser(name, help=text)
        for option in required:
            command.add_argument(f"--{option}", required=True)
        return command

    ingest = add("ingest", "validate event text and route it to folders", "events", "out")
    ingest.add_argument("--load", default="all", help="name of the load; a rerun replaces it")
    aggregate = add("aggregate", "aggregate event text into the landing table", "events", "landing")
    aggregate.add_argument("--ingested-at")
    aggregate.add_argument("--strict", action="store_true", help="valid events only")
    stream = add("stream", "stream events into the landing log", "log", "checkpoint")
    stream.add_argument("--events", help="folder of event text")
    stream.add_argument("--bootstrap-servers", help="topic instead of a folder")
    stream.add_argument("--topic", default="traffic-events")
    stream.add_argument("--from-earliest", action="store_true")
    stream.add_argument("--strict", action="store_true", help="valid events only")
    stream.add_argument("--watermark", default=WATERMARK, help="how late events may be")
    stream.add_argument("--keep-late", action="store_true",
                        help="log partial windows, which late events add to, in place of versions")
    stream.add_argument("--metrics", help="folder of counts that outlast the run")
    stream.add_argument("--continuous", action="store_true", help="run until stopped")
    fold = add("fold", "merge the landing log into the landing table", "log", "landing")
    fold.add_argument("--before", help="only days ahead of this one")
    fold.add_argument("--partials", help="store of a log that keeps late events")
    add("warehouse", "rebuild core and report orphans", "landing", "inventory", "core")
    refresh = add("refresh", "rebuild the recent days of core", "landing", "inventory", "core")
    refresh.add_argument("--since", help="first day, by default the days that changed")
    refresh.add_argument("--latest", help="table of latest rows to move on by the changed days")
    for name, text in (("status", "write the status feed"), ("health", "print the health row")):
        command = add(name, text)
        rows = command.add_mutually_exclusive_group(required=True)
        rows.add_argument("--core", help="core table, of which the latest rows are sought")
        rows.add_argument("--latest", help="table of latest rows, which is much smaller")
        command.add_argument("--inventory")
        if name == "status":
            command.add_argument("--out", help="folder of the feed")
            command.add_argument("--id", help="print one intersection instead")
            command.add_argument("--bottleneck-only", action="store_true")
        else:
            command.add_argument("--as-of")
    checks = add("checks", "count the failures of all declared checks", "landing", "inventory")
    checks.add_argument("--core")
    freshness = add("freshness", "print the landing lag", "landing")
    freshness.add_argument("--as-of")
    extract = add("inventory", "turn a map extract into the inventory file", "extract", "out")
    extract.add_argument("--bbox", type=float, nargs=4, default=DEFAULT_BBOX,
                         metavar=("SOUTH", "WEST", "NORTH", "EAST"))
    return root


def _day(text: str | None) -> dt.date | None:
    return None if text is None else dt.date.fromisoformat(text)


def _observed(counts: Observation) -> dict[str, int]:
    """The counts; none where the planner found nothing to do and dropped the counting as well."""
    try:
        return dict(counts.get)
    except Py4JJavaError:
        return {}


def _status_source(spark: SparkSession, args: argparse.Namespace):
    """The table of latest rows where there is one, else core."""
    if args.latest:
        return latest_table.read_latest(spark, args.latest)
    return core_table.read_core(spark, args.core)


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    """Run one job and return its exit code."""
    inventory = None
    if getattr(args, "inventory", None):
        required = args.job in ("warehouse", "refresh", "checks")
        inventory = places.read_inventory(spark, args.inventory, required=required)

    if args.job == "ingest":
        raw = source.read_text(spark, args.events)
        print(jobs.ingest(raw, args.out, args.load))
    elif args.job == "aggregate":
        raw = source.read_text(spark, args.events, ordered=True)
        counts = Observation("ingest")
        rows = jobs.payloads_to_landing(
            raw, args.landing, args.ingested_at, strict=args.strict, observe=counts
        )
        print(f"landing_rows={rows} {_observed(counts)}")
    elif args.job == "stream":
        if args.bootstrap_servers:
            raw = source.stream_topic(
                spark, args.bootstrap_servers, args.topic, earliest=args.from_earliest
            )
        else:
            raw = source.stream_text(spark, args.events)
        events = streams.flat_events(raw, strict=args.strict)
        metrics = streams.RunMetrics.listen(spark, args.metrics)
        if args.keep_late:
            query = streams.start_partials(
                events, args.log, args.checkpoint,
                watermark=args.watermark, continuous=args.continuous,
            )
        else:
            states = SIGNAL_STATES if args.strict else None
            windows = streams.stream_windows(events, states=states, watermark=args.watermark)
            query = streams.start_landing(
                windows, args.log, args.checkpoint, continuous=args.continuous
            )
        query.awaitTermination()
        print(metrics.of(query))
    elif args.job == "fold":
        before = _day(args.before)
        if args.partials:
            rows = partials.fold_partials(
                spark, args.log, args.partials, args.landing, before=before
            )
        else:
            rows = table.fold_versions(spark, args.log, args.landing, before=before)
        print(f"folded_rows={rows}")
    elif args.job == "warehouse":
        report = jobs.build_warehouse(spark, args.landing, inventory, args.core)
        print(f"core_rows={core_table.read_core(spark, args.core).count()}")
        print(f"orphan_ids={report.count()}")
    elif args.job == "refresh":
        since = core_table.merge_core(
            spark, args.landing, inventory, args.core, since=_day(args.since)
        )
        if args.latest:
            core = core_table.read_core(spark, args.core, since=since)
            latest_table.upsert_latest(core, args.latest)
        first = "none" if since == core_table.NO_DAY else since
        print(f"since={first or 'changed days'}")
    elif args.job == "status" and args.id:
        known = None if inventory is None or inventory.isEmpty() else inventory
        asked = spark.createDataFrame([(args.id,)], "intersection_id string")
        found = status_by_id(_status_source(spark, args), args.id, known)
        answer = lookup_status(found, asked).first()
        if answer.code is not None:
            print({"code": answer.code, "message": answer.message})
            return 1
        print(status_json(found).first().value)
    elif args.job == "status":
        if not args.out:
            print("status needs --out or --id", file=sys.stderr)
            return 2
        rows = _status_source(spark, args)
        items = jobs.current_status(rows, inventory, bottleneck_only=args.bottleneck_only)
        jobs.write_status_feed(items, args.out)
    elif args.job == "health":
        rows = _status_source(spark, args)
        print(health(rows, inventory, as_of=args.as_of).toJSON().first())
    elif args.job == "checks":
        core = core_table.read_core(spark, args.core) if args.core else None
        report = jobs.quality_report(table.read_landing(spark, args.landing), inventory, core)
        results = report.collect()
        for row in results:
            print(f"{row.table_name} {row.check_name} {row.column_name} failures={row.failures}")
        return int(any(row.failures for row in results))
    elif args.job == "freshness":
        newest = table.newest_day(spark, args.landing)
        rows = table.read_landing(spark, args.landing, since=newest)
        lag = landing_lag(rows, as_of=args.as_of).first().max_landing_lag_seconds
        if lag is None:
            print("no landing rows yet", file=sys.stderr)
            return 1
        # Fixed output format, which monitors read.
        print(f"max_landing_lag_seconds={lag:.1f}")
    elif args.job == "inventory":
        nodes = elements(places.read_map_extract(spark, args.extract))
        rows = inventory_from_elements(nodes, tuple(args.bbox))
        if not places.write_inventory(rows, args.out):
            print("no nodes found, the inventory stays as it is", file=sys.stderr)
            return 1
    return 0


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = configure(SparkSession.builder.appName(f"signalmill-{args.job}").getOrCreate())
    return run(spark, args)


if __name__ == "__main__":
    sys.exit(main())
