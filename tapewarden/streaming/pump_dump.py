"""Pump-and-dump detector on a stream of closed bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapewarden.config import PD_ALERTS_TOPIC, DetectionConfig
from tapewarden.operators.partials import BAR
from tapewarden.operators.running import BARS, carried_bars, running_bars, running_matches
from tapewarden.operators.sweeps import pump_dump_sweep
from tapewarden.operators.trades import clean_trades
from tapewarden.operators.windows import ohlcv_bars
from tapewarden.plans.pump_dump import alerts_from_bars, rated_bars
from tapewarden.schema import PD_SENSITIVITY, PUMP_DUMP_ALERTS
from tapewarden.sinks.keyed import insert_ignore, upsert
from tapewarden.sinks.messages import MessageTarget
from tapewarden.streaming.carry import Carried
from tapewarden.streaming.closed import WindowTable
from tapewarden.streaming.jobs import TRIGGER, batch_time, each_nonempty, start

def bar_stream(trades: DataFrame, config: DetectionConfig, delay: str | None) -> DataFrame:
    """OHLCV bars of a trade stream; see ``window_stream`` for ``delay``."""
    clean = clean_trades(trades, config.symbols)
    if delay is not None:
        clean = clean.withWatermark("event_time", delay)
    return ohlcv_bars(clean, config.bar_width, keep_event_time=delay is not None)


def start_pump_dump_detector(
    trades: DataFrame,
    config: DetectionConfig,
    root: str,
    checkpoint: str,
    delay: str = "1 minute",
    trigger: str | None = TRIGGER,
    writer: str = "pump-dump",
    detected_at: Column | None = None,
    target: MessageTarget | None = None,
) -> StreamingQuery:
    """Write pump-and-dump alerts (first wins) and sweep rows (last wins) as bars close.

    The bars of a trigger are rated and matched by time blocks; of each symbol
    only its totals and the PUMP that is still open are carried to the next
    trigger, under the checkpoint. Alerts are also published to ``target``.
    """

    carried = Carried(f"{checkpoint}/carried", BARS)

    def publish(bars: DataFrame, batch_id: int) -> None:
        seen = batch_time(detected_at)
        before = carried.before(bars.sparkSession, batch_id)
        rated = running_bars(bars, before, config).persist()
        try:
            alerts = running_matches(rated, before, config).withColumn("detected_at", seen)
            on_new = None if target is None else lambda new: target.publish(new, PD_ALERTS_TOPIC)
            insert_ignore(alerts, root, PUMP_DUMP_ALERTS, batch_id, writer, on_new=on_new)
            sweep = pump_dump_sweep(rated, config.pd_grid, seen)
            upsert(sweep, root, PD_SENSITIVITY, batch_id, writer)
            # Bars come in order of time: what closed last is the newest of the feed.
            horizon = bars.agg(F.max("window_end").alias("x")).first().x
            carried.store(carried_bars(rated, before, config, F.lit(horizon)), batch_id)
        finally:
            rated.unpersist()

    bars = bar_stream(trades, config, delay)
    return start(bars, each_nonempty(publish), checkpoint, "append", trigger, writer)


def start_bar_rescoring(
    trades: DataFrame,
    config: DetectionConfig,
    root: str,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    writer: str = "pump-dump-rescore",
    baseline: str = "leave_one_out",
    detected_at: Column | None = None,
    target: MessageTarget | None = None,
) -> StreamingQuery:
    """Alerts and sweep rows of all closed bars of every symbol that a trigger changes.

    This gives the leave-one-out baseline, which needs later bars as well. Bars lie
    in a table under the checkpoint, the stream has no state. Only new alerts
    and changed sweep rows are stored and published: the first verdict of a
    PUMP stays, whatever later bars make of its ratio.
    """
    table = WindowTable(f"{checkpoint}/bars", BAR, config.bar_width)

    def on_trades(batch: DataFrame, batch_id: int) -> None:
        closed = table.changed(batch, batch_id)
        if closed is None:
            return
        held = closed.persist()
        try:
            seen = batch_time(detected_at)
            alerts = alerts_from_bars(held, config, baseline, seen)
            on_new = None if target is None else lambda new: target.publish(new, PD_ALERTS_TOPIC)
            insert_ignore(alerts, root, PUMP_DUMP_ALERTS, batch_id, writer, on_new=on_new)
            sweep = pump_dump_sweep(rated_bars(held, config, "trailing"), config.pd_grid, seen)
            upsert(sweep, root, PD_SENSITIVITY, batch_id, writer, only_changes=True)
        finally:
            held.unpersist()

    return start(clean_trades(trades, config.symbols), on_trades, checkpoint, "append", trigger, writer)
