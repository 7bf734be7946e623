"""Wash detector on a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapewarden.config import WASH_ALERTS_TOPIC, DetectionConfig
from tapewarden.operators.baselines import with_zscores
from tapewarden.operators.partials import VOLUME
from tapewarden.operators.running import SPREAD, block_seconds, running_zscores
from tapewarden.operators.sweeps import wash_sweep
from tapewarden.operators.trades import clean_trades
from tapewarden.operators.windows import volume_windows
from tapewarden.plans.wash import alerts_from_scored
from tapewarden.schema import WASH_ALERTS, WASH_SENSITIVITY
from tapewarden.sinks.keyed import insert_ignore, upsert
from tapewarden.sinks.messages import MessageTarget
from tapewarden.streaming.carry import Carried
from tapewarden.streaming.closed import WindowTable
from tapewarden.streaming.jobs import TRIGGER, batch_time, each_nonempty, start


def window_stream(trades: DataFrame, config: DetectionConfig, delay: str | None) -> DataFrame:
    """Volume windows of a trade stream.

    With a ``delay`` a window is final once the watermark passes its end and
    its state is dropped; trades later than that are dropped too. Without one
    (complete mode) every window stays in state.
    """
    clean = clean_trades(trades, config.symbols)
    if delay is not None:
        clean = clean.withWatermark("event_time", delay)
    return volume_windows(clean, config.wash_window)


def start_wash_detector(
    trades: DataFrame,
    config: DetectionConfig,
    root: str,
    checkpoint: str,
    delay: str = "1 minute",
    complete: bool = False,
    trigger: str | None = TRIGGER,
    writer: str = "wash",
    detected_at: Column | None = None,
    target: MessageTarget | None = None,
) -> StreamingQuery:
    """Write wash alerts (first wins) and sweep rows (last wins) under ``root``.

    Default: append mode; each window is scored once, when it closes, against
    the running statistics of its symbol, of which a summary is carried from
    trigger to trigger under the checkpoint. ``complete=True`` scores the closed
    windows of every symbol that a trigger changes again, so sweep rows follow
    the whole history, late trades included; windows lie in a table under the
    checkpoint, the stream has no state, and only what changed is stored. Alerts
    that are new are also published to ``target``.
    """

    def publish(scored: DataFrame, batch_id: int) -> None:
        seen = batch_time(detected_at)
        alerts = alerts_from_scored(scored, config.wash_threshold, seen)
        on_new = None if target is None else lambda new: target.publish(new, WASH_ALERTS_TOPIC)
        insert_ignore(alerts, root, WASH_ALERTS, batch_id, writer, on_new=on_new)
        sweep = wash_sweep(scored, config.wash_grid, seen)
        upsert(sweep, root, WASH_SENSITIVITY, batch_id, writer, only_changes=complete)

    if complete:
        table = WindowTable(f"{checkpoint}/windows", VOLUME, config.wash_window)

        def rescore(batch: DataFrame, batch_id: int) -> None:
            closed = table.changed(batch, batch_id)
            if closed is not None:
                held = with_zscores(closed, config.symbol_bound).persist()
                try:
                    publish(held, batch_id)
                finally:
                    held.unpersist()

        return start(clean_trades(trades, config.symbols), rescore, checkpoint, "append", trigger, writer)

    carried = Carried(f"{checkpoint}/carried", SPREAD)

    def score(windows: DataFrame, batch_id: int) -> None:
        before = carried.before(windows.sparkSession, batch_id)
        scored, after = running_zscores(windows, before, block_seconds(config.wash_window), config.symbol_bound)
        held = scored.persist()
        try:
            publish(held, batch_id)
        finally:
            held.unpersist()
        carried.store(after, batch_id)

    windows = window_stream(trades, config, delay)
    return start(windows, each_nonempty(score), checkpoint, "append", trigger, writer)
