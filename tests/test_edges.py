"""Hand-made frames for the edges of each rule."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tapewarden import DetectionConfig
from tapewarden.operators.baselines import with_leave_one_out, with_trailing, with_zscores
from tapewarden.operators.sequences import (
    bars_since,
    classify_bars,
    consuming_matches,
    earliest_pairs,
    latest_bar_per_symbol,
)
from tapewarden.operators.sweeps import (
    pump_dump_sweep,
    pump_dump_sweep_summary,
    wash_sweep,
    wash_sweep_summary,
)
from tapewarden.operators.trades import clean_trades
from tapewarden.operators.windows import ohlcv_bars, volume_windows
from tapewarden.plans.pump_dump import matched_pairs
from tapewarden.plans.wash import alerts_from_scored

T0 = datetime(2026, 1, 1)
CONFIG = DetectionConfig()


def minute(n: float) -> datetime:
    return T0 + timedelta(minutes=n)


def windows(spark, *rows):
    """rows: (symbol, minute, volume)"""
    return spark.createDataFrame(
        [(minute(m), minute(m + 2), s, 1, float(v), 1.0, 0.0) for s, m, v in rows],
        "window_start timestamp, window_end timestamp, symbol string, trade_count long, "
        "total_volume double, mean_volume double, std_volume double",
    )


def bars(spark, *rows):
    """rows: (symbol, minute, open, close, volume)"""
    return spark.createDataFrame(
        [
            (minute(m), minute(m + 1), s, float(o), float(c), 0.0, 0.0, float(v), 1)
            for s, m, o, c, v in rows
        ],
        "window_start timestamp, window_end timestamp, symbol string, open_price double, "
        "close_price double, high_price double, low_price double, total_volume double, "
        "trade_count long",
    )


def classified(spark, *rows):
    """rows: (symbol, minute, phase)"""
    change = {"PUMP": 0.01, "DUMP": -0.01, None: 0.0}
    return spark.createDataFrame(
        [(s, minute(m), p, change[p], 2.0) for s, m, p in rows],
        "symbol string, window_start timestamp, phase string, price_change double, "
        "volume_ratio double",
    )


def flagged(spark, *rows):
    """rows: (symbol, minute, phase)"""
    return spark.createDataFrame(
        [(s, minute(m), minute(m + 1), p, 0.1, 1.0, minute(m + 1)) for s, m, p in rows],
        "symbol string, window_start timestamp, window_end timestamp, phase string, "
        "price_change_pct double, volume_ratio double, detected_at timestamp",
    )


def trades(spark, *rows):
    """rows: (order id, symbol, seconds, price, quantity)"""
    return spark.createDataFrame(
        [(o, o, s, T0 + timedelta(seconds=t), float(p), float(q)) for o, s, t, p, q in rows],
        "trade_id string, order_id string, symbol string, event_time timestamp, price double, "
        "quantity double",
    )


def scores(df):
    return {(r.symbol, r.window_start): r.z_score for r in df.collect()}


def test_lone_window_and_equal_volumes_score_zero(spark):
    got = scores(with_zscores(windows(spark, ("A", 0, 5), ("B", 0, 7), ("B", 2, 7))))
    assert set(got.values()) == {0.0}


def test_zscore_uses_sample_deviation(spark):
    got = scores(with_zscores(windows(spark, ("A", 0, 1), ("A", 2, 3)), symbol_bound=1))
    assert got["A", minute(2)] == pytest.approx(1 / 2**0.5)


def test_wash_threshold_is_strict_and_two_sided(spark):
    scored = windows(spark, ("A", 0, 1), ("B", 0, 1), ("C", 0, 1), ("D", 0, 1)).withColumn(
        "z_score",
        F.expr("CASE symbol WHEN 'A' THEN 0.5 WHEN 'B' THEN -0.6 WHEN 'C' THEN 1.1 ELSE 2.6 END"),
    )
    got = {r.symbol: r.severity for r in alerts_from_scored(scored, 0.5).collect()}
    assert got == {"B": "MEDIUM", "C": "HIGH", "D": "CRITICAL"}


def test_one_trade_has_no_spread(spark):
    row = volume_windows(trades(spark, ("1", "A", 1, 10, 4)), "2 minutes").first()
    assert (row.trade_count, row.total_volume, row.std_volume) == (1, 4.0, 0.0)
    assert (row.window_start, row.window_end) == (minute(0), minute(2))


def test_clean_drops_bad_time_quantity_and_symbol(spark):
    rows = spark.createDataFrame(
        [
            ("1", "BTCUSDT", "2026-01-01T00:00:00", 1.0),
            ("2", "BTCUSDT", "soon", 1.0),
            ("3", "BTCUSDT", "2026-01-01T00:00:00", 0.0),
            ("4", "DOGE", "2026-01-01T00:00:00", 1.0),
            ("5", None, "2026-01-01T00:00:00", 1.0),
        ],
        "order_id string, symbol string, timestamp string, quantity double",
    )
    assert [r.order_id for r in clean_trades(rows, CONFIG.symbols).collect()] == ["1"]


def test_open_and_close_follow_event_time_then_numeric_id(spark):
    rows = trades(
        spark,
        ("10", "A", 5, 3, 1), ("9", "A", 5, 2, 1), ("11", "A", 50, 8, 1), ("100", "A", 50, 9, 1),
        ("12", "A", 30, 100, 1),
    )
    for order in (rows, rows.orderBy(F.desc("event_time"))):
        bar = ohlcv_bars(order.repartition(3), "1 minute").first()
        assert (bar.open_price, bar.close_price, bar.high_price, bar.low_price) == (2, 9, 100, 2)


def test_text_ids_give_a_stable_order(spark):
    rows = trades(spark, *[(f"id-{i}", "A", 5, i, 1) for i in range(20)])
    opened = {ohlcv_bars(rows.repartition(n), "1 minute").first().open_price for n in (1, 2, 7)}
    assert len(opened) == 1


def test_leave_one_out_baseline(spark):
    frame = bars(spark, ("A", 0, 1, 1, 1), ("A", 1, 1, 1, 2), ("A", 2, 1, 1, 6), ("B", 0, 1, 1, 5))
    got = {(r.symbol, r.window_start): r.volume_ratio for r in with_leave_one_out(frame).collect()}
    assert got["A", minute(0)] == pytest.approx(1 / 4)
    assert got["A", minute(2)] == pytest.approx(6 / 1.5)
    assert got["B", minute(0)] == 1.0


def test_zero_baseline_gives_ratio_one(spark):
    frame = bars(spark, ("A", 0, 1, 1, 0), ("A", 1, 1, 1, 0))
    assert {r.volume_ratio for r in with_leave_one_out(frame).collect()} == {1.0}
    assert {r.volume_ratio for r in with_trailing(frame).collect()} == {1.0}


def test_trailing_baseline_crosses_days(spark):
    day = 24 * 60
    frame = bars(
        spark, ("A", 0, 1, 1, 2), ("A", 1, 1, 1, 4), ("A", day + 5, 1, 1, 9), ("A", 9 * day, 1, 1, 5)
    )
    got = [r.volume_ratio for r in with_trailing(frame).orderBy("window_start").collect()]
    assert got == pytest.approx([1.0, 2.0, 3.0, 1.0])


def test_phase_bounds_are_inclusive_and_bad_opens_drop_out(spark):
    rated = with_leave_one_out(
        bars(
            spark,
            ("A", 0, 1000, 1001, 110), ("A", 1, 1000, 999, 110), ("A", 2, 1000, 1000.9, 110),
            ("A", 3, 0, 5, 110),
        )
    )
    # Equal volumes: the ratio is exactly 1.
    config = DetectionConfig(volume_ratio=1.0)
    got = {r.window_start: r.phase for r in classify_bars(rated, config).collect()}
    assert got == {minute(0): "PUMP", minute(1): "DUMP", minute(2): None}


def test_bad_open_still_counts_in_the_baseline(spark):
    rated = with_leave_one_out(bars(spark, ("A", 0, 0, 5, 10), ("A", 1, 1, 1, 20)))
    row = classify_bars(rated, CONFIG).first()
    assert row.volume_ratio == 2.0


def matches(spark, *rows):
    got = consuming_matches(classified(spark, *rows), CONFIG).collect()
    return sorted((r.symbol, r.window_start, r.window_end) for r in got)


def test_dump_at_the_window_limit_matches_and_past_it_does_not(spark):
    assert matches(spark, ("A", 0, "PUMP"), ("A", 5, "DUMP")) == [("A", minute(0), minute(5))]
    assert matches(spark, ("A", 0, "PUMP"), ("A", 6, "DUMP")) == []


def test_later_pump_replaces_and_dump_consumes(spark):
    rows = [("A", 0, "PUMP"), ("A", 1, "PUMP"), ("A", 2, "DUMP"), ("A", 3, "DUMP")]
    assert matches(spark, *rows) == [("A", minute(1), minute(2))]


def test_unmarked_bars_between_do_not_matter(spark):
    rows = [("A", 0, "PUMP"), ("A", 1, None), ("A", 2, "DUMP")]
    assert matches(spark, *rows) == [("A", minute(0), minute(2))]


def test_match_crosses_a_day_border(spark):
    late = 24 * 60 - 2
    rows = [("A", late, "PUMP"), ("A", late + 4, "DUMP"), ("B", late, "PUMP")]
    assert matches(spark, *rows) == [("A", minute(late), minute(late + 4))]


def test_alert_fields(spark):
    row = consuming_matches(classified(spark, ("A", 0, "PUMP"), ("A", 1, "DUMP")), CONFIG).first()
    assert (row.phase, row.alert_type, row.severity) == ("DUMP", "PUMP_DUMP", "CRITICAL")
    assert (row.pump_price_chg_pct, row.dump_price_chg_pct, row.price_change_pct) == (1, -1, -1)


def test_report_pairs_share_a_dump_and_take_the_earliest(spark):
    rows = [("A", 0, "PUMP"), ("A", 1, "PUMP"), ("A", 3, "DUMP"), ("A", 4, "DUMP"), ("A", 9, "PUMP")]
    got = earliest_pairs(flagged(spark, *rows), "5 minutes").collect()
    assert sorted((r.pump_start, r.dump_start) for r in got) == [
        (minute(0), minute(3)),
        (minute(1), minute(3)),
    ]


def test_report_filters_come_before_the_limit(spark):
    sweep = flagged(
        spark, ("A", 0, "PUMP"), ("A", 1, "DUMP"), ("B", 10, "PUMP"), ("B", 11, "DUMP")
    ).withColumns(
        {"flagged": F.lit(True), "price_threshold": F.lit(0.0005), "vol_threshold": F.lit(0.5)}
    )
    got = matched_pairs(sweep, CONFIG, symbol="A", limit=1).collect()
    assert [(r.symbol, r.phase, r.window_end) for r in got] == [("A", "PUMP→DUMP", minute(2))]
    assert matched_pairs(sweep, CONFIG, severity="CRITICAL").count() == 0


def test_sweep_severity_calls_high_from_twice_the_threshold(spark):
    rated = with_trailing(bars(spark, ("A", 0, 1000, 1002.5, 10)))
    got = pump_dump_sweep(rated, [(0.001, 0.5)]).collect()
    assert {(r.phase, r.flagged, r.severity) for r in got} == {
        ("PUMP", True, "HIGH"),
        ("DUMP", False, None),
    }


def test_sweep_summaries(spark):
    scored = with_zscores(windows(spark, ("A", 0, 1), ("A", 2, 3)))
    got = wash_sweep_summary(wash_sweep(scored, [0.1, 1.0])).orderBy("z_threshold").collect()
    assert [(r.total_windows, r.alerts_fired, r.alert_rate_pct) for r in got] == [
        (2, 2, 100.0),
        (2, 0, 0.0),
    ]
    rated = with_trailing(bars(spark, ("A", 0, 1000, 1010, 1), ("A", 1, 1000, 990, 1)))
    row = pump_dump_sweep_summary(pump_dump_sweep(rated, [(0.001, 0.5)])).first()
    assert (row.total_bars, row.pumps_detected, row.dumps_detected) == (2, 1, 1)
    assert row.alert_rate_pct == 100.0


def test_latest_and_newer_bars(spark):
    frame = bars(spark, ("A", 0, 1, 1, 1), ("A", 7, 1, 1, 1), ("B", 3, 1, 1, 1))
    latest = {r.symbol: r.window_start for r in latest_bar_per_symbol(frame).collect()}
    assert latest == {"A": minute(7), "B": minute(3)}
    seen = frame.filter("symbol = 'A' AND window_start < '2026-01-01 00:05:00'")
    new = {(r.symbol, r.window_start) for r in bars_since(frame, seen).collect()}
    assert new == {("A", minute(7)), ("B", minute(3))}


def test_settings():
    tuned = DetectionConfig.from_settings({"wash_zscore_threshold": 0.1, "pd_window_minutes": 5})
    assert (tuned.wash_threshold, tuned.pair_window, tuned.pump_threshold) == (
        0.1, "5 minutes", 0.01,
    )
    with pytest.raises(ValueError):
        DetectionConfig(pump_threshold=-0.1)
    with pytest.raises(TypeError):
        DetectionConfig.from_settings({}, colour="red")
