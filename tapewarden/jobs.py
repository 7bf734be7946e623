"""Command line of the streaming jobs, for spark-submit.

    spark-submit --py-files tapewarden.zip tapewarden/jobs.py wash \\
        --format kafka --option kafka.bootstrap.servers=host:9092 \\
        --option subscribe=market-trades --root /tables --checkpoint /checkpoints/wash
"""

from __future__ import annotations

import argparse
import json
import sys
import time
from collections.abc import Sequence
from dataclasses import dataclass, fields
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from tapewarden.config import SYMBOLS, DetectionConfig
from tapewarden.schema import PD_SENSITIVITY, PUMP_DUMP_ALERTS, WASH_ALERTS, WASH_SENSITIVITY
from tapewarden.sinks.keyed import compact, crowded_dates
from tapewarden.sinks.messages import MessageTarget
from tapewarden.sources.exchange import normalize_exchange_events
from tapewarden.sources.streams import (
    MESSAGE,
    alert_message_stream,
    read_stream,
    trade_file_stream,
    trade_message_stream,
)
from tapewarden.streaming.ingest import start_ingest
from tapewarden.streaming.jobs import TRIGGER, stream_session
from tapewarden.streaming.persist import start_alert_persister
from tapewarden.streaming.progress import StreamCounters, store_triggers
from tapewarden.streaming.pump_dump import start_bar_rescoring, start_pump_dump_detector
from tapewarden.streaming.wash import start_wash_detector


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description="Trade-abuse detection streams")
    top.add_argument("job", choices=("ingest", "wash", "pump-dump", "persist", "compact"))
    top.add_argument("--format", default="kafka", help="source format")
    top.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    top.add_argument("--root", required=True, help="folder of the result tables")
    top.add_argument("--checkpoint", help="of the stream; compact needs none")
    top.add_argument("--older-than", type=int, default=1, help="compact: days before today that are closed")
    top.add_argument("--writer", help="name of this writer; new with every fresh checkpoint")
    top.add_argument("--symbols", default=",".join(SYMBOLS), help="comma list, or * for any")
    top.add_argument("--delay", default="1 minute", help="how late a trade may come")
    top.add_argument("--within", default="1 hour", help="ingest: how long a trade is remembered")
    top.add_argument("--trigger", default=TRIGGER, help="time between micro-batches")
    top.add_argument(
        "--setting", action="append", default=[], metavar="NAME=VALUE",
        help="a field of DetectionConfig; lists by comma, grid points as price:volume",
    )
    top.add_argument("--trade-table", action="store_true", help="read trade files, not messages")
    top.add_argument("--rescore", action="store_true", help="complete mode")
    top.add_argument("--state-partitions", type=int)
    top.add_argument("--once", action="store_true", help="drain what is there, then stop")
    top.add_argument("--alert-format", help="also publish results (alerts; ingest: trades) in this format")
    top.add_argument("--alert-option", action="append", default=[], metavar="KEY=VALUE")
    top.add_argument("--alert-path")
    return top


def _pairs(items: Sequence[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def _points(text: str) -> tuple:
    return tuple(tuple(map(float, point.split(":"))) for point in text.split(","))


def configured(settings: dict[str, str], symbols: tuple[str, ...] | None) -> DetectionConfig:
    """Detector settings from texts, each read as the type of the field's default."""
    defaults = {f.name: f.default for f in fields(DetectionConfig)}
    values = {}
    for name, text in settings.items():
        if name not in defaults or name == "symbols":
            raise ValueError(f"unknown setting: {name}")
        if name == "pd_grid":
            values[name] = _points(text)
        elif name == "report_point":
            values[name] = _points(text)[0]
        elif isinstance(defaults[name], tuple):
            values[name] = tuple(map(float, text.split(",")))
        else:
            values[name] = type(defaults[name])(text)
    return DetectionConfig(symbols=symbols, **values)


@dataclass(frozen=True)
class Running:
    """The queries of a job and the counters of what they did."""

    queries: Sequence[StreamingQuery]
    counters: StreamCounters
    root: str

    def awaitTermination(self) -> None:  # noqa: N802  as a query has it
        for query in self.queries:
            query.awaitTermination()

    def stop(self) -> None:
        for query in self.queries:
            query.stop()

    def store_triggers(self, spark: SparkSession) -> None:
        """Keep what each trigger read, rejected and found too late as rows of a table under the root."""
        for query in self.queries:
            store_triggers(spark, query, self.root)

    def report(self) -> str:
        """One JSON line: totals by query and counter, late rows among them."""
        return json.dumps({f"{name}.{what}": n for (name, what), n in sorted(self.counters.totals.items())})


def compact_closed(spark: SparkSession, root: str, older_than: int = 1, today: date | None = None) -> None:
    """Rewrite the closed days of all keyed tables as one batch each; writers may go on meanwhile."""
    last = (today or datetime.now(timezone.utc).date()) - timedelta(days=older_than)
    for table, first in ((WASH_ALERTS, True), (PUMP_DUMP_ALERTS, True), (WASH_SENSITIVITY, False), (PD_SENSITIVITY, False)):
        compact(spark, root, table, [day for day in crowded_dates(spark, root, table) if day <= last], first)


def launch(spark: SparkSession, arguments: Sequence[str]) -> Running:
    """Start the job the arguments describe."""
    args = parser().parse_args(arguments)
    if args.job != "compact" and not args.checkpoint:
        raise SystemExit(f"{args.job} needs --checkpoint")
    if args.job == "compact":
        compact_closed(spark, args.root, args.older_than)
        return Running([], StreamCounters(), args.root)
    session = stream_session(spark, args.state_partitions)
    counters = StreamCounters()
    session.streams.addListener(counters)
    started = _start(session, args)
    return Running(started if isinstance(started, list) else [started], counters, args.root)


def _start(session: SparkSession, args: argparse.Namespace) -> StreamingQuery | list[StreamingQuery]:
    options = _pairs(args.option)
    symbols = None if args.symbols == "*" else tuple(args.symbols.split(","))
    trigger = None if args.once else args.trigger
    common = {"trigger": trigger, "writer": args.writer or args.job}
    target = None
    if args.alert_format:
        target = MessageTarget(args.alert_format, _pairs(args.alert_option), args.alert_path)
    if args.job == "persist":
        messages = alert_message_stream(session, args.format, options)
        return start_alert_persister(messages, args.root, args.checkpoint, **common)
    if args.job == "ingest":
        schema = None if args.format == "kafka" else MESSAGE
        raw = read_stream(session, args.format, options, schema).select("value")
        return start_ingest(
            normalize_exchange_events(raw),
            symbols,
            f"{args.root}/trades",
            f"{args.root}/rejected_trades",
            args.checkpoint,
            within=args.within,
            target=target,
            **common,
        )
    config = configured(_pairs(args.setting), symbols)
    read = trade_file_stream if args.trade_table else trade_message_stream
    trades = read(session, args.format, options)
    place = (trades, config, args.root, args.checkpoint)
    if args.job == "wash":
        return start_wash_detector(
            *place, delay=args.delay, complete=args.rescore, target=target, **common
        )
    if args.rescore:
        return start_bar_rescoring(*place, target=target, **common)
    return start_pump_dump_detector(*place, delay=args.delay, target=target, **common)


def main() -> None:
    spark = SparkSession.builder.appName("tapewarden").getOrCreate()
    running = launch(spark, sys.argv[1:])
    while any(query.isActive for query in running.queries):
        time.sleep(60 if "--once" not in sys.argv else 1)
        print(running.report(), flush=True)
        running.store_triggers(spark)
    # Raises what a query failed with.
    running.awaitTermination()


if __name__ == "__main__":
    main()
