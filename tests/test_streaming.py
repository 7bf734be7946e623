"""Streams against their batch twins, late data, restarts and replays."""

from __future__ import annotations

import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tapewarden import DetectionConfig
from tapewarden.operators.windows import ohlcv_bars, volume_windows
from tapewarden.operators.sweeps import pump_dump_sweep
from tapewarden.plans.pump_dump import alerts_from_bars, pump_dump_sweep_rows, rated_bars
from tapewarden.plans.wash import alerts_from_scored, scored_windows
from tapewarden.schema import (
    PD_SENSITIVITY,
    PUMP_DUMP_ALERTS,
    WASH_ALERTS,
    WASH_SENSITIVITY,
)
from tapewarden.sinks.keyed import read_inserted, read_upserted
from tapewarden.sinks.messages import MessageTarget, encode_alerts, write_messages
from tapewarden.sources.streams import alert_message_stream
from tapewarden.streaming.ingest import dedup_stream
from tapewarden.streaming.jobs import start_files, stream_session
from tapewarden.streaming.persist import start_alert_persister
from tapewarden.streaming.progress import StreamCounters
from tapewarden.streaming.pump_dump import (
    bar_stream,
    start_bar_rescoring,
    start_pump_dump_detector,
)
from tapewarden.streaming.wash import start_wash_detector, window_stream

CONFIG = DetectionConfig(symbols=("A", "B"), wash_threshold=0.5, volume_ratio=0.9)
T0 = datetime(2026, 1, 1, 23, 30)
SCHEMA = (
    "trade_id string, order_id string, symbol string, event_time timestamp, price double, "
    "quantity double"
)
MINUTES = 60


def random_trades(seed: int, minutes: int = MINUTES):
    rng = random.Random(seed)
    rows, price = [], {"A": 100.0, "B": 50.0}
    for second in range(0, minutes * 60, 5):
        symbol = rng.choice("AB")
        price[symbol] *= 1 + rng.gauss(0, 0.002)
        rows.append(
            (str(second), str(second), symbol, T0 + timedelta(seconds=second), price[symbol],
             float(rng.randint(1, 9)))
        )
    return rows


def write_parts(spark, folder, rows, parts):
    """One file per part, in event order, so that each trigger reads the next one."""
    size = -(-len(rows) // parts)
    for n in range(parts):
        spark.createDataFrame(rows[n * size : (n + 1) * size], SCHEMA).coalesce(1).write.mode(
            "append"
        ).parquet(str(folder))


def trade_stream(session, folder):
    return (
        session.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))
    )


@pytest.fixture()
def session(spark):
    return stream_session(spark, 2)


def closed(df, delay_seconds, last):
    return df.filter(F.col("window_end") <= F.lit(last - timedelta(seconds=delay_seconds)))


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_append_windows_and_bars_equal_batch(spark, session, tmp_path):
    trades = random_trades(1)
    write_parts(spark, tmp_path / "in", trades, 4)
    batch = spark.createDataFrame(trades, SCHEMA)
    last = trades[-1][3]
    for name, live, still in (
        ("w", window_stream(trade_stream(session, tmp_path / "in"), CONFIG, "30 seconds"),
         volume_windows(batch, CONFIG.wash_window)),
        ("b", bar_stream(trade_stream(session, tmp_path / "in"), CONFIG, "30 seconds").drop("event_time"),
         ohlcv_bars(batch, CONFIG.bar_width)),
    ):
        start_files(live, f"{tmp_path}/{name}", f"{tmp_path}/{name}c", trigger=None).awaitTermination()
        got = spark.read.parquet(f"{tmp_path}/{name}")
        names = [c for c in got.columns if not c.startswith(("mean", "std"))]
        assert rows_of(got, *names) == rows_of(closed(still, 30, last), *names)


def test_late_trades_are_dropped_and_counted(spark, session, tmp_path):
    first = [("1", "1", "A", T0, 1.0, 1.0), ("2", "2", "A", T0 + timedelta(minutes=30), 1.0, 1.0)]
    # Spark judges lateness by the watermark of the trigger before the last one.
    between = [("5", "5", "A", T0 + timedelta(minutes=31), 1.0, 1.0)]
    late = [("3", "3", "A", T0 + timedelta(seconds=5), 1.0, 100.0)]
    last = [("4", "4", "A", T0 + timedelta(minutes=60), 1.0, 1.0)]
    for part in (first, between, late, last):
        write_parts(spark, tmp_path / "in", part, 1)
    live = window_stream(trade_stream(session, tmp_path / "in"), CONFIG, "1 minute")
    query = start_files(live, f"{tmp_path}/out", f"{tmp_path}/c", trigger=None, name="late")
    query.awaitTermination()
    dropped = sum(
        s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators
    )
    got = rows_of(spark.read.parquet(f"{tmp_path}/out"), "window_start", "total_volume")
    assert got == [(T0, 1.0), (T0 + timedelta(minutes=30), 2.0)]
    assert dropped == 1


def detector(spark, session, tmp_path, folder="in"):
    return start_pump_dump_detector(
        trade_stream(session, tmp_path / folder), CONFIG, f"{tmp_path}/t", f"{tmp_path}/c",
        delay="30 seconds", trigger=None, detected_at=F.col("window_end"),
    )


def pump_dump_twin(spark, trades):
    bars = closed(
        ohlcv_bars(spark.createDataFrame(trades, SCHEMA), CONFIG.bar_width), 30, trades[-1][3]
    )
    return alerts_from_bars(bars, CONFIG, "trailing", F.col("window_end"))


ALERT_COLUMNS = (
    "symbol", "window_start", "window_end", "pump_price_chg_pct", "dump_price_chg_pct",
    "volume_ratio", "severity",
)


def test_stateful_pump_dump_equals_batch_over_many_triggers(spark, session, tmp_path):
    trades = random_trades(2)
    write_parts(spark, tmp_path / "in", trades, 6)
    detector(spark, session, tmp_path).awaitTermination()
    got = read_inserted(spark, f"{tmp_path}/t", PUMP_DUMP_ALERTS)
    want = pump_dump_twin(spark, trades)
    assert rows_of(got, *ALERT_COLUMNS) == rows_of(want, *ALERT_COLUMNS)
    assert got.count() > 5


def test_state_survives_a_restart(spark, session, tmp_path):
    trades = random_trades(3)
    half = len(trades) // 2
    write_parts(spark, tmp_path / "in", trades[:half], 2)
    detector(spark, session, tmp_path).awaitTermination()
    early = read_inserted(spark, f"{tmp_path}/t", PUMP_DUMP_ALERTS).count()
    write_parts(spark, tmp_path / "in", trades[half:], 2)
    detector(spark, session, tmp_path).awaitTermination()
    got = read_inserted(spark, f"{tmp_path}/t", PUMP_DUMP_ALERTS)
    assert rows_of(got, *ALERT_COLUMNS) == rows_of(pump_dump_twin(spark, trades), *ALERT_COLUMNS)
    assert 0 < early < got.count()


def test_quiet_pump_expires(spark, session, tmp_path):
    """A PUMP, silence past twice the window, then a DUMP: no alert, whatever the timers did."""

    def bar(minute, start, end):
        at = T0 + timedelta(minutes=minute)
        return [
            (f"{minute}a", f"{minute}0", "A", at, start, 1.0),
            (f"{minute}b", f"{minute}1", "A", at + timedelta(seconds=30), end, 1.0),
        ]

    for part in (bar(0, 100.0, 110.0), bar(3, 100.0, 100.0), bar(20, 100.0, 100.0),
                 bar(21, 100.0, 90.0), bar(30, 100.0, 110.0), bar(32, 100.0, 90.0),
                 bar(50, 1.0, 1.0)):
        write_parts(spark, tmp_path / "in", part, 1)
    detector(spark, session, tmp_path).awaitTermination()
    got = read_inserted(spark, f"{tmp_path}/t", PUMP_DUMP_ALERTS)
    want = [(T0 + timedelta(minutes=30), T0 + timedelta(minutes=32))]
    assert rows_of(got, "window_start", "window_end") == want


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_running_zscores_do_not_depend_on_triggers(spark, session, tmp_path, parts):
    trades = random_trades(5)
    write_parts(spark, tmp_path / "in", trades, parts)
    query = start_wash_detector(
        trade_stream(session, tmp_path / "in"), CONFIG, f"{tmp_path}/t", f"{tmp_path}/c",
        delay="30 seconds", trigger=None, detected_at=F.col("window_end"),
    )
    query.awaitTermination()
    # Each closed window against those of its symbol up to and with it.
    batch = volume_windows(spark.createDataFrame(trades, SCHEMA), CONFIG.wash_window)
    mark = max(t[3] for t in trades) - timedelta(seconds=30)
    want, seen = {}, {"A": [], "B": []}
    for r in sorted(batch.collect(), key=lambda r: r.window_start):
        if r.window_end <= mark:
            history = seen[r.symbol]
            history.append(r.total_volume)
            spread = statistics.stdev(history) if len(history) > 1 else 0.0
            mean = statistics.fmean(history)
            want[r.symbol, r.window_end] = (r.total_volume - mean) / spread if spread else 0.0
    sweep = read_upserted(spark, f"{tmp_path}/t", WASH_SENSITIVITY).filter("threshold = 0.5")
    got = {(r.symbol, r.window_end): r.z_score for r in sweep.collect()}
    assert got == pytest.approx(want)
    alerts = read_inserted(spark, f"{tmp_path}/t", WASH_ALERTS)
    assert {(r.symbol, r.window_end) for r in alerts.collect()} == {
        k for k, z in want.items() if abs(z) > 0.5
    }


def test_rescored_wash_equals_batch_for_sweep_rows(spark, session, tmp_path):
    trades = random_trades(6)
    write_parts(spark, tmp_path / "in", trades, 3)
    query = start_wash_detector(
        trade_stream(session, tmp_path / "in"), CONFIG, f"{tmp_path}/t", f"{tmp_path}/c",
        complete=True, trigger=None, detected_at=F.current_timestamp(),
    )
    query.awaitTermination()
    windows = volume_windows(spark.createDataFrame(trades, SCHEMA), CONFIG.wash_window)
    newest = windows.agg(F.max("window_start")).first()[0]
    still = spark.createDataFrame(trades, SCHEMA).filter(F.col("event_time") < F.lit(newest))
    want = {
        (r.symbol, r.window_start): r.z_score for r in scored_windows(still, CONFIG).collect()
    }
    sweep = read_upserted(spark, f"{tmp_path}/t", WASH_SENSITIVITY).filter("threshold = 0.1")
    got = {(r.symbol, r.window_start): r.z_score for r in sweep.collect()}
    assert got == pytest.approx(want)


def test_rescored_bars_equal_batch(spark, session, tmp_path):
    trades = random_trades(7)
    write_parts(spark, tmp_path / "in", trades, 1)
    start_bar_rescoring(
        trade_stream(session, tmp_path / "in"), CONFIG, f"{tmp_path}/t", f"{tmp_path}/c",
        trigger=None, detected_at=F.col("window_end"),
    ).awaitTermination()
    frame = spark.createDataFrame(trades, SCHEMA)
    bars = ohlcv_bars(frame, CONFIG.bar_width)
    newest = bars.agg(F.max("window_start")).first()[0]
    done = bars.filter(F.col("window_end") <= F.lit(newest))
    got = read_inserted(spark, f"{tmp_path}/t", PUMP_DUMP_ALERTS)
    want = alerts_from_bars(done, CONFIG, "leave_one_out", F.col("window_end"))
    assert rows_of(got, *ALERT_COLUMNS) == rows_of(want, *ALERT_COLUMNS)
    sweep = read_upserted(spark, f"{tmp_path}/t", PD_SENSITIVITY)
    columns = ("symbol", "window_start", "price_threshold", "vol_threshold", "phase", "flagged")
    still = pump_dump_sweep_rows(frame.filter(F.col("event_time") < F.lit(newest)), CONFIG)
    assert rows_of(sweep, *columns) == rows_of(still, *columns)


def test_dedup_stream_forgets_only_after_the_delay(spark, session, tmp_path):
    trades = random_trades(8, 10)
    write_parts(spark, tmp_path / "in", trades, 1)
    write_parts(spark, tmp_path / "in", trades, 1)
    live = dedup_stream(trade_stream(session, tmp_path / "in"), "1 hour")
    start_files(live, f"{tmp_path}/out", f"{tmp_path}/c", trigger=None).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.count() == got.select("order_id").distinct().count() == len(trades)


def test_persisting_alerts_twice_adds_nothing_and_loses_nothing(spark, session, tmp_path):
    trades = spark.createDataFrame(random_trades(9), SCHEMA)
    alerts = alerts_from_scored(scored_windows(trades, CONFIG), 0.5, F.col("window_end")).cache()
    write_messages(encode_alerts(alerts, "wash-alerts"), "json", {}, f"{tmp_path}/topics")
    write_messages(encode_alerts(alerts, "wash-alerts"), "json", {}, f"{tmp_path}/topics")
    write_messages(encode_alerts(alerts, "gossip"), "json", {}, f"{tmp_path}/topics")
    junk = spark.createDataFrame([("wash-alerts", "k", "{}")], "topic string, key string, value string")
    write_messages(junk, "json", {}, f"{tmp_path}/topics")

    for writer in ("first", "again"):
        messages = alert_message_stream(session, "json", {"path": f"{tmp_path}/topics"})
        start_alert_persister(
            messages, f"{tmp_path}/t", f"{tmp_path}/{writer}", trigger=None, writer=writer
        ).awaitTermination()
    got = read_inserted(spark, f"{tmp_path}/t", WASH_ALERTS)
    columns = ("symbol", "window_start", "z_score", "severity", "detected_at")
    assert rows_of(got, *columns) == rows_of(alerts, *columns)
    rejected = spark.read.parquet(f"{tmp_path}/t/rejected_alerts").filter("writer = 'first'")
    reasons = {r.reason: r["count"] for r in rejected.groupBy("reason").count().collect()}
    assert reasons == {"unknown_topic": alerts.count(), "null:window_start": 1}
    critical = spark.read.parquet(f"{tmp_path}/t/critical_alerts").filter("writer = 'first'")
    assert critical.count() >= alerts.filter("severity = 'CRITICAL'").count()


def test_counters_follow_a_stream(spark, session, tmp_path):
    trades = random_trades(10, 5)
    write_parts(spark, tmp_path / "in", trades, 2)
    counters = StreamCounters()
    session.streams.addListener(counters)
    live = trade_stream(session, tmp_path / "in").observe("seen", F.count(F.lit(1)).alias("rows"))
    start_files(live, f"{tmp_path}/o", f"{tmp_path}/c", trigger=None, name="feed").awaitTermination()
    import time

    for _ in range(50):  # listener events arrive on their own thread
        if counters.totals["feed", "input_rows"] == len(trades):
            break
        time.sleep(0.1)
    session.streams.removeListener(counters)
    assert counters.totals["feed", "batches"] == 2
    assert counters.totals["feed", "input_rows"] == len(trades)
    assert counters.totals["feed", "rows"] == len(trades)
    assert counters.totals["feed", "errors"] == 0


def test_detector_publishes_and_persister_stores(spark, session, tmp_path):
    """Trades to alert messages to the alert table, as two separate jobs."""
    trades = random_trades(11)
    write_parts(spark, tmp_path / "in", trades, 2)
    target = MessageTarget("json", {}, f"{tmp_path}/topics")
    start_wash_detector(
        trade_stream(session, tmp_path / "in"), CONFIG, f"{tmp_path}/own", f"{tmp_path}/c1",
        trigger=None, detected_at=F.col("window_end"), target=target,
    ).awaitTermination()
    start_pump_dump_detector(
        trade_stream(session, tmp_path / "in"), CONFIG, f"{tmp_path}/own", f"{tmp_path}/c2",
        trigger=None, detected_at=F.col("window_end"), target=target,
    ).awaitTermination()
    messages = alert_message_stream(session, "json", {"path": f"{tmp_path}/topics"})
    start_alert_persister(messages, f"{tmp_path}/t", f"{tmp_path}/c3", trigger=None).awaitTermination()
    for table in (WASH_ALERTS, PUMP_DUMP_ALERTS):
        stored = read_inserted(spark, f"{tmp_path}/t", table)
        own = read_inserted(spark, f"{tmp_path}/own", table)
        assert stored.count() > 0
        assert rows_of(stored, *table.schema.names) == rows_of(own, *table.schema.names)


def test_live_pump_dump_sweep_equals_batch(spark, session, tmp_path):
    trades = random_trades(12)
    write_parts(spark, tmp_path / "in", trades, 3)
    detector(spark, session, tmp_path).awaitTermination()
    bars = closed(
        ohlcv_bars(spark.createDataFrame(trades, SCHEMA), CONFIG.bar_width), 30, trades[-1][3]
    )
    still = pump_dump_sweep(rated_bars(bars, CONFIG, "trailing"), CONFIG.pd_grid)
    got = read_upserted(spark, f"{tmp_path}/t", PD_SENSITIVITY)
    names = [n for n in PD_SENSITIVITY.schema.names if n != "detected_at"]
    assert rows_of(got, *names) == rows_of(still, *names)
