"""Running ratings from carried summaries: any split into triggers, any size of a symbol's back-fill."""

from __future__ import annotations

import random
import statistics
import threading
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_streaming import CONFIG as STREAM_CONFIG
from test_streaming import SCHEMA, random_trades, rows_of, trade_stream, write_parts

from tapewarden import DetectionConfig
from tapewarden.jobs import compact_closed
from tapewarden.operators import running
from tapewarden.operators.partials import BAR, VOLUME
from tapewarden.operators.windows import ohlcv_bars, volume_windows
from tapewarden.plans.pump_dump import alerts_from_bars
from tapewarden.schema import PUMP_DUMP_ALERTS, WASH_ALERTS
from tapewarden.sinks.keyed import crowded_dates, insert_ignore, read_inserted
from tapewarden.sinks.messages import encode_alerts, write_messages
from tapewarden.sources.streams import alert_message_stream
from tapewarden.streaming import closed
from tapewarden.streaming.carry import Carried
from tapewarden.streaming.jobs import stream_session
from tapewarden.streaming.persist import start_alert_persister
from tapewarden.streaming.pump_dump import start_bar_rescoring
from tapewarden.streaming.wash import start_wash_detector

T0 = datetime(2026, 1, 1)
CONFIG = DetectionConfig(symbols=("A", "B"))


def windows_of(spark, volumes):
    rows = [(s, T0 + timedelta(minutes=2 * k), T0 + timedelta(minutes=2 * k + 2), v) for s, k, v in volumes]
    return spark.createDataFrame(rows, "symbol string, window_start timestamp, window_end timestamp, total_volume double")


def running_over(spark, volumes, cuts, seconds):
    """Scores by symbol and window when the windows come in parts that end at the cuts."""
    carried = spark.createDataFrame([], running.SPREAD)
    out, low = {}, 0
    for high in [*cuts, 1 << 40]:
        part = [v for v in volumes if low <= v[1] < high]
        low = high
        if part:
            scored, carried = running.running_zscores(windows_of(spark, part), carried, seconds, 2)
            out |= {(r.symbol, r.window_start): r.z_score for r in scored.collect()}
            carried = spark.createDataFrame(carried.collect(), running.SPREAD)
    return out


def plain_zscores(volumes):
    want, seen = {}, {}
    for s, k, v in sorted(volumes, key=lambda x: x[1]):
        own = seen.setdefault(s, [])
        own.append(v)
        spread = statistics.stdev(own) if len(own) > 1 else 0.0
        want[s, T0 + timedelta(minutes=2 * k)] = (v - statistics.fmean(own)) / spread if spread else 0.0
    return want


@pytest.mark.parametrize("base, spread", [(100.0, 40.0), (1e9, 1.0), (0.1, 0.0)])
def test_zscores_do_not_depend_on_triggers_or_blocks(spark, base, spread):
    draw = random.Random(4)
    volumes = [(s, k, base + draw.gauss(0, 1) * spread) for k in range(150) for s in "AB" if draw.random() < 0.8]
    want = plain_zscores(volumes)
    for cuts, seconds in (((), 1 << 20), ((40, 41, 90), 600), ((7, 77), 240)):
        assert running_over(spark, volumes, cuts, seconds) == pytest.approx(want, rel=1e-6, abs=1e-6)


def test_a_back_fill_of_a_million_bars_of_one_symbol(spark):
    """All bars in one trigger: equal to the batch, and no task holds more than a few blocks of them."""
    n = 1_000_000
    k = F.col("id")
    price = 100 + F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    bars = spark.range(n, numPartitions=8).select(
        F.lit("A").alias("symbol"),
        (F.lit(T0) + F.make_dt_interval(mins=k)).alias("window_start"),
        (F.lit(T0) + F.make_dt_interval(mins=k + 1)).alias("window_end"),
        F.lit(100.5).alias("open_price"),
        price.alias("close_price"),
        (1 + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100))).cast("double").alias("total_volume"),
    )
    empty = spark.createDataFrame([], running.BARS)
    rated = running.running_bars(bars, empty, CONFIG).cache()
    assert rated.count() == n
    matched = running.running_matches(rated, empty, CONFIG)
    plan = matched._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    # Every order of bars is within a symbol's block; over whole symbols only block totals are ordered.
    orders = [x for x in rated._jdf.queryExecution().executedPlan().toString().splitlines() if "Window [" in x and "window_start" in x]
    assert orders and all("_block" in x for x in orders)
    blocks = rated.groupBy(F.floor(F.unix_timestamp("window_start") / running.block_seconds(CONFIG.bar_width))).count()
    assert blocks.agg(F.max("count")).first()[0] <= running.BLOCK_ROWS
    want = alerts_from_bars(bars, CONFIG, "trailing", F.col("window_end"))
    assert matched.count() == want.count() > 1000
    after = running.carried_bars(rated, empty, CONFIG, F.lit(T0 + timedelta(days=10_000))).collect()
    assert len(after) == 1 and after[0].bars == n and after[0].pump is None
    rated.unpersist()


def test_a_pump_is_carried_replaced_ended_and_forgotten(spark):
    def rated(*bars):
        rows = [("A", T0 + timedelta(minutes=m), 1.0, 1.0 + c, 10.0, c, 2.0) for m, c in bars]
        return spark.createDataFrame(
            rows, "symbol string, window_start timestamp, open_price double, close_price double, total_volume double, price_change double, volume_ratio double"
        )

    carried = spark.createDataFrame([], running.BARS)

    def after(minutes, *bars):
        nonlocal carried
        out = running.carried_bars(rated(*bars), carried, CONFIG, F.lit(T0 + timedelta(minutes=minutes)))
        carried = spark.createDataFrame(out.collect(), running.BARS)
        (row,) = carried.collect()
        return row.bars, row.pump and (row.pump.window_start - T0).seconds // 60

    assert after(1, (0, 0.01)) == (1, 0), "opened"
    assert after(3, (1, 0.0), (2, 0.02)) == (3, 2), "replaced by a later one"
    assert [r.window_start for r in running.running_matches(rated((4, -0.02)), carried, CONFIG).collect()] == [T0 + timedelta(minutes=2)]
    assert after(6, (5, 0.0)) == (4, 2), "not marked, still open"
    assert after(5, (5, -0.02)) == (5, None), "ended by a DUMP"
    assert after(7, (6, 0.02)) == (6, 6)
    assert after(16, (15, 0.0)) == (7, None), "two pair windows past its start"


@pytest.mark.parametrize("kind, width, still", [(VOLUME, "2 minutes", volume_windows), (BAR, "1 minute", ohlcv_bars)])
def test_merged_parts_are_the_whole_windows(spark, kind, width, still):
    trades = random_trades(21)
    random.Random(1).shuffle(trades)
    parts = [spark.createDataFrame(trades[k::3], SCHEMA) for k in range(3)]
    of = [kind.of_trades(p, width) for p in parts]
    twice = kind.merged(kind.merged(of[0].unionByName(of[1])).unionByName(of[2]))
    names = ["symbol", "window_start", *[c for c in kind.whole(twice).columns if c not in ("symbol", "window_start")]]
    got = {r[:2]: r[2:] for r in rows_of(kind.whole(twice), *names)}
    want = {r[:2]: r[2:] for r in rows_of(still(spark.createDataFrame(trades, SCHEMA), width), *names)}
    assert got.keys() == want.keys()
    for key, values in want.items():
        for a, b in zip(got[key], values, strict=True):
            assert a == (pytest.approx(b) if isinstance(b, float) else b)


def test_rescoring_keeps_no_state_and_merges_its_parts(spark, tmp_path, monkeypatch):
    """Many triggers, with trades of closed windows that come late: no state rows, few folders, the same rows."""
    monkeypatch.setattr(closed, "MERGE_EVERY", 3)
    trades = random_trades(22)
    late = [trades.pop(100), trades.pop(200)]
    write_parts(spark, tmp_path / "in", trades, 9)
    write_parts(spark, tmp_path / "in", late, 1)
    session = stream_session(spark, 2)
    query = start_bar_rescoring(
        trade_stream(session, tmp_path / "in"), STREAM_CONFIG, f"{tmp_path}/t", f"{tmp_path}/c",
        trigger=None, baseline="trailing", detected_at=F.col("window_end"),
    )
    query.awaitTermination()
    assert all(not p.stateOperators for p in query.recentProgress)
    folders = [f.name for f in (tmp_path / "c/bars").iterdir()]
    assert len([f for f in folders if f.startswith("part=")]) <= 5
    table = closed.WindowTable(f"{tmp_path}/c/bars", BAR, STREAM_CONFIG.bar_width)
    files, found = table._listed(spark)
    base = max(found["merged"])
    parts = [f"{tmp_path}/c/bars/part={n}" for n in found["part"] if n > base] + [f"{tmp_path}/c/bars/merged={base}"]
    got = BAR.whole(BAR.merged(spark.read.schema(BAR.schema).parquet(*parts)))
    want = ohlcv_bars(spark.createDataFrame(trades + late, SCHEMA), STREAM_CONFIG.bar_width)
    names = ("symbol", "window_start", "open_price", "close_price", "high_price", "low_price", "total_volume", "trade_count")
    assert rows_of(got, *names) == rows_of(want, *names)


def test_only_changed_symbols_are_read_back(spark, tmp_path):
    table = closed.WindowTable(f"{tmp_path}/w", VOLUME, "2 minutes")

    def feed(*trades):
        rows = [(str(k), str(k), s, T0 + timedelta(minutes=m), 1.0, 1.0) for k, (s, m) in enumerate(trades)]
        return spark.createDataFrame(rows, SCHEMA)

    symbols = lambda df: sorted({r.symbol for r in df.collect()})
    assert table.changed(feed(("A", 0), ("B", 1)), 0).count() == 0, "nothing is closed"
    assert symbols(table.changed(feed(("A", 2)), 1)) == ["A", "B"], "both close"
    assert symbols(table.changed(feed(("A", 4)), 2)) == ["A"], "B has nothing new"
    assert table.changed(feed(("A", 5)), 3).count() == 0, "still the open window"
    assert symbols(table.changed(feed(("B", 0)), 4)) == ["B"], "a late trade"
    assert {(r.symbol, r.trade_count) for r in table.changed(feed(("B", 0)), 4).collect()} == {("B", 2)}, "a repeated trigger"


def test_carried_versions_survive_a_repeated_trigger(spark, tmp_path):
    carried = Carried(f"{tmp_path}/c", "x bigint")
    of = lambda n: [r.x for r in carried.before(spark, n).collect()]
    assert of(0) == []
    for n in (0, 1, 4):
        carried.store(spark.createDataFrame([(n,)], "x bigint"), n)
    assert of(4) == [1] and of(9) == [4]
    carried.store(spark.createDataFrame([(40,)], "x bigint"), 4)
    assert of(5) == [40] and of(4) == [1]
    assert sorted(f.name for f in (tmp_path / "c").iterdir() if "=" in f.name) == ["batch_id=1", "batch_id=4"]


def test_wash_stream_state_holds_open_windows_only(spark, tmp_path):
    trades = random_trades(23)
    write_parts(spark, tmp_path / "in", trades, 4)
    query = start_wash_detector(
        trade_stream(stream_session(spark, 2), tmp_path / "in"), STREAM_CONFIG, f"{tmp_path}/t", f"{tmp_path}/c",
        delay="30 seconds", trigger=None,
    )
    query.awaitTermination()
    rows = [o.numRowsTotal for p in query.recentProgress for o in p.stateOperators]
    assert rows and max(rows) <= 2 * (15 + 2), "at most a trigger's windows of two symbols"
    assert [o.operatorName for p in query.recentProgress[:1] for o in p.stateOperators] == ["stateStoreSave"]


def test_jobs_of_a_persisting_trigger(spark, tmp_path):
    """Both tables in one pass: the number of Spark jobs a trigger does not grow with tables or days."""
    day = lambda k: T0 + timedelta(days=k)
    wash = [(day(k), day(k + 1), "A", 1, 1.0, 1.0, 0.0, 5.0, "CRITICAL", "WASH_TRADE", day(k + 1)) for k in range(6)]
    pump = [(day(k), day(k + 1), "A", "DUMP", 1.0, -1.0, -1.0, 2.0, "HIGH", "PUMP_DUMP", day(k + 1)) for k in range(6)]
    for topic, rows, table in (("wash-alerts", wash, WASH_ALERTS), ("pump-dump-alerts", pump, PUMP_DUMP_ALERTS)):
        frame = spark.createDataFrame(rows, table.schema)
        write_messages(encode_alerts(frame, topic), "json", {}, f"{tmp_path}/topics")
    messages = alert_message_stream(stream_session(spark, 2), "json", {"path": f"{tmp_path}/topics"})
    tracker = spark.sparkContext.statusTracker()
    before = max(tracker.getJobIdsForGroup(None), default=0)
    spark.range(1).count()
    query = start_alert_persister(messages, f"{tmp_path}/t", f"{tmp_path}/c", trigger=None, writer="one")
    query.awaitTermination()
    jobs = len(tracker.getJobIdsForGroup(str(query.runId)))
    assert before >= 0 and 0 < jobs <= 16
    assert read_inserted(spark, f"{tmp_path}/t", WASH_ALERTS).count() == 6
    assert read_inserted(spark, f"{tmp_path}/t", PUMP_DUMP_ALERTS).count() == 6


def test_compaction_while_a_writer_goes_on(spark, tmp_path):
    def alerts(k):
        rows = [
            (T0 + timedelta(days=d), T0 + timedelta(days=d, minutes=2), f"S{k % 3}", k, 1.0, 1.0, 0.0, 5.0, "HIGH", "WASH_TRADE", T0 + timedelta(days=d, hours=k))
            for d in range(2)
        ]
        return spark.createDataFrame(rows, WASH_ALERTS.schema)

    for k in range(4):
        insert_ignore(alerts(k), f"{tmp_path}", WASH_ALERTS, k)
    want = rows_of(read_inserted(spark, f"{tmp_path}", WASH_ALERTS), "window_start", "symbol", "trade_count")
    assert len(want) == 6 and len(crowded_dates(spark, f"{tmp_path}", WASH_ALERTS)) == 2
    failed = []

    def write():
        try:
            for k in range(4, 8):
                insert_ignore(alerts(k), f"{tmp_path}", WASH_ALERTS, k, "other")
        except Exception as error:  # noqa: BLE001
            failed.append(error)

    writer = threading.Thread(target=write)
    writer.start()
    compact_closed(spark, f"{tmp_path}", 1, date(2026, 1, 2))
    writer.join()
    assert not failed
    compact_closed(spark, f"{tmp_path}", 0, date(2026, 1, 2))
    assert crowded_dates(spark, f"{tmp_path}", WASH_ALERTS) == []
    assert rows_of(read_inserted(spark, f"{tmp_path}", WASH_ALERTS), "window_start", "symbol", "trade_count") == want
