"""Validation order, number and time forms, exchange events, gaps and back-fill."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tapewarden.config import SYMBOLS
from tapewarden.functions.timestamps import parse_iso_timestamp
from tapewarden.functions.validation import number_text, parse_number
from tapewarden.operators.gaps import feed_gaps, new_trades, trades_in_gaps
from tapewarden.operators.trades import dedup_trades, rejected_only, valid_only, validate_trades
from tapewarden.plans.ingest import ingest_trades, repair_gaps
from tapewarden.schema import DEAD_LETTER_COLUMNS, TEXT_TRADE
from tapewarden.sources.exchange import decode_trades, normalize_exchange_events

GOOD = {
    "trade_id": "1", "timestamp": "2026-01-01T00:00:00", "symbol": "BTCUSDT", "price": "10.5",
    "quantity": "2", "side": "BUY", "order_id": "7", "event_type": "TRADE", "trader_id": None,
}

REASONS = [
    ({}, None),
    ({"event_type": "WASH"}, None),
    ({"trade_id": None}, "missing_field:trade_id"),
    ({"timestamp": " \t"}, "missing_field:timestamp"),
    ({"symbol": ""}, "missing_field:symbol"),
    ({"price": None}, "missing_field:price"),
    ({"quantity": " "}, "missing_field:quantity"),
    ({"side": ""}, "missing_field:side"),
    ({"order_id": None}, "missing_field:order_id"),
    ({"event_type": None}, "missing_field:event_type"),
    ({"price": "0"}, "non_positive_price:0.0"),
    ({"price": "-3.25"}, "non_positive_price:-3.25"),
    ({"price": "ten"}, "invalid_price:ten"),
    ({"price": "1d"}, "invalid_price:1d"),
    ({"price": "nan"}, "invalid_price:nan"),
    ({"price": " 1_0.5e1 "}, None),
    ({"quantity": "-1"}, "non_positive_quantity:-1.0"),
    ({"quantity": "x"}, "invalid_quantity:x"),
    ({"timestamp": "2026-02-30T00:00:00"}, "invalid_timestamp:2026-02-30T00:00:00"),
    ({"side": "buy"}, "invalid_side:buy"),
    ({"event_type": "QUOTE"}, "invalid_event_type:QUOTE"),
    ({"symbol": "DOGE"}, "unknown_symbol:DOGE"),
    # The first failing check names the reason.
    ({"price": "-1", "trade_id": ""}, "missing_field:trade_id"),
    ({"price": "-1", "quantity": "-1"}, "non_positive_price:-1.0"),
    ({"quantity": "-1", "timestamp": "x"}, "non_positive_quantity:-1.0"),
    ({"timestamp": "x", "side": "x"}, "invalid_timestamp:x"),
    ({"side": "x", "event_type": "x"}, "invalid_side:x"),
    ({"event_type": "x", "symbol": "x"}, "invalid_event_type:x"),
]


def test_reasons_and_their_order(spark):
    rows = [tuple({**GOOD, **change, "trader_id": str(i)}.values()) for i, (change, _) in enumerate(REASONS)]
    checked = validate_trades(spark.createDataFrame(rows, TEXT_TRADE), SYMBOLS)
    got = {int(r.trader_id): r.rejection_reason for r in checked.collect()}
    assert got == {i: reason for i, (_, reason) in enumerate(REASONS)}


def test_split_keeps_every_row(spark):
    rows = [tuple({**GOOD, **change}.values()) for change, _ in REASONS]
    checked = validate_trades(spark.createDataFrame(rows, TEXT_TRADE), SYMBOLS)
    valid, rejected = valid_only(checked), rejected_only(checked)
    assert valid.count() + rejected.count() == len(REASONS)
    assert dict(valid.dtypes)["price"] == "double"
    assert tuple(rejected.columns) == DEAD_LETTER_COLUMNS


def test_absent_column_counts_as_missing(spark):
    frame = spark.createDataFrame([tuple(GOOD.values())], TEXT_TRADE).drop("order_id")
    assert validate_trades(frame, SYMBOLS).first().rejection_reason == "missing_field:order_id"


def test_numeric_columns_are_checked_too(spark):
    frame = spark.createDataFrame([tuple(GOOD.values())] * 3, TEXT_TRADE)
    frame = frame.withColumn("price", F.lit(float("nan"))).withColumn("quantity", F.lit(1.0))
    assert validate_trades(frame, SYMBOLS).first().rejection_reason == "invalid_price:NaN"


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2026-01-31", datetime(2026, 1, 31)),
        ("20260131", datetime(2026, 1, 31)),
        ("2026-01-31T10", datetime(2026, 1, 31, 10)),
        ("2026-01-31 10:05", datetime(2026, 1, 31, 10, 5)),
        ("2026-01-31T10:05:06", datetime(2026, 1, 31, 10, 5, 6)),
        ("2026-01-31T10:05:06.123456", datetime(2026, 1, 31, 10, 5, 6, 123456)),
        ("2026-01-31T10:05:06.5Z", datetime(2026, 1, 31, 10, 5, 6, 500000)),
        ("2026-01-31T10:05:06+05:30", datetime(2026, 1, 31, 4, 35, 6)),
        ("20260131T100506", datetime(2026, 1, 31, 10, 5, 6)),
        ("20260131T100506+0530", datetime(2026, 1, 31, 4, 35, 6)),
        ("2026", None),
        ("2026-01", None),
        ("2026-1-1", None),
        ("2026-13-01", None),
        ("2026-01-31T25:00:00", None),
        ("2026-01-31T10:05:06 Europe/Paris", None),
        ("now", None),
        ("", None),
        (None, None),
    ],
)
def test_iso_forms(spark, text, want):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(parse_iso_timestamp(F.col("t")).alias("t")).first().t == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("1", 1.0), (" 2.5 ", 2.5), (".5", 0.5), ("5.", 5.0), ("1e3", 1000.0), ("1_000", 1000.0),
     ("-7", -7.0), ("1f", None), ("0x10", None), ("1__0", None), ("inf", None), ("", None)],
)
def test_number_forms(spark, text, want):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(parse_number(F.col("t")).alias("n")).first().n == want


def test_exchange_events_in_both_shapes(spark):
    bare = '{"T":1767225600123,"s":"BTCUSDT","p":"1.5","q":"2","m":true,"a":5,"M":false}'
    wrapped = f'{{"stream":"x","data":{bare.replace("true", "false")}}}'
    frame = spark.createDataFrame([(bare,), (wrapped,), ("junk",)], "value string")
    got = sorted(normalize_exchange_events(frame).collect(), key=lambda r: str(r.side))
    assert [r.side for r in got] == ["BUY", None, "SELL"]
    assert got[0].event_time == datetime(2026, 1, 1, 0, 0, 0, 123000)
    assert got[0].timestamp == "2026-01-01T00:00:00.123000"
    assert (got[0].order_id, got[0].trade_id, got[0].price) == ("5", "5", "1.5")
    assert got[1].symbol is None and len(got[1].order_id) == 64


def test_paged_events_take_the_asked_symbol(spark):
    paged = '{"T":1767225600000,"p":"1","q":"2","m":true,"a":5}'
    frame = spark.createDataFrame([(paged, "ETHUSDT")], "value string, symbol string")
    row = normalize_exchange_events(frame).first()
    assert (row.symbol, row.side) == ("ETHUSDT", "SELL")


def test_ingest_drops_copies_and_reports_junk(spark):
    event = '{"T":1767225600000,"s":"BTCUSDT","p":"1","q":"2","m":true,"a":5}'
    same_id = event.replace("BTCUSDT", "ETHUSDT")
    frame = spark.createDataFrame([(event,), (event,), (same_id,), ("junk",)], "value string")
    valid, rejected = ingest_trades(frame, SYMBOLS)
    assert sorted(r.symbol for r in valid.collect()) == ["BTCUSDT", "ETHUSDT"]
    assert [r.rejection_reason for r in rejected.collect()] == ["missing_field:timestamp"]


def test_decode_tolerates_garbage(spark):
    frame = spark.createDataFrame(
        [('{"trade_id":"1","timestamp":"2026-01-01T00:00:00","price":2.5}',), ("garbage",), (None,)],
        "value string",
    )
    got = decode_trades(frame).collect()
    assert len(got) == 3
    assert sum(r.event_time is not None for r in got) == 1


T0 = datetime(2026, 1, 1, 23, 59, 50)


def feed(spark, *rows):
    """rows: (order id, symbol, seconds)"""
    return spark.createDataFrame(
        [(o, o, s, T0 + timedelta(seconds=t), 1.0, 1.0) for o, s, t in rows],
        "trade_id string, order_id string, symbol string, event_time timestamp, price double, "
        "quantity double",
    )


def test_gap_must_exceed_the_threshold(spark):
    frame = feed(spark, ("1", "A", 0), ("2", "A", 5), ("3", "B", 10.5), ("4", "A", 90000))
    got = sorted((r.gap_start, r.gap_end, r.gap_seconds) for r in feed_gaps(frame).collect())
    assert [g[2] for g in got] == [5.5, 89989.5]
    assert got[1][:2] == (T0 + timedelta(seconds=10.5), T0 + timedelta(seconds=90000))


def test_gaps_by_symbol(spark):
    frame = feed(spark, ("1", "A", 0), ("2", "B", 3), ("3", "A", 6), ("4", "B", 8))
    got = [(r.symbol, r.gap_seconds) for r in feed_gaps(frame, by=["symbol"]).collect()]
    assert got == [("A", 6.0)]
    assert feed_gaps(frame).count() == 0


def test_random_gaps_equal_a_plain_scan(spark):
    import random

    rng = random.Random(4)
    times, at = [], 0.0
    for _ in range(3000):
        at += rng.choice((0.1, 1, 4.9, 5, 5.000001, 7, 300, 90000))
        times.append(round(at, 6))
    frame = feed(spark, *[(str(i), "A", t) for i, t in enumerate(times)])
    stamps = [T0 + timedelta(seconds=t) for t in times]
    want = [(a, b) for a, b in zip(stamps, stamps[1:]) if b - a > timedelta(seconds=5)]
    got = sorted((r.gap_start, r.gap_end) for r in feed_gaps(frame).collect())
    assert got == want


def test_backfill_takes_each_unseen_trade_once(spark):
    seen = feed(spark, ("1", "A", 0), ("2", "A", 60))
    fetched = feed(
        spark, ("1", "A", 0), ("3", "A", 30), ("3", "A", 30), ("2", "B", 31), ("9", "A", 500)
    )
    got = new_trades(fetched, seen, F.lit(T0), F.lit(T0 + timedelta(seconds=60))).collect()
    assert sorted((r.symbol, r.order_id) for r in got) == [("A", "3"), ("B", "2")]


def test_trades_in_gaps_and_repair(spark):
    history = feed(spark, ("1", "A", 0), ("2", "A", 60), ("3", "A", 62), ("4", "A", 64))
    fetched = feed(
        spark, ("1", "A", 0), ("5", "A", 10), ("6", "A", 59.9), ("7", "A", 61), ("8", "A", 70)
    )
    gaps = feed_gaps(history)
    inside = trades_in_gaps(fetched, gaps).collect()
    assert sorted(r.order_id for r in inside) == ["1", "5", "6"]
    full = fetched.withColumns(
        {
            "timestamp": F.lit("2026-01-01"), "side": F.lit("BUY"), "event_type": F.lit("TRADE"),
            "price": F.when(F.col("order_id") == "6", -1.0).otherwise(F.col("price")),
        }
    )
    merged = repair_gaps(history, full, ["A"]).collect()
    assert sorted(r.order_id for r in merged) == ["1", "2", "3", "4", "5"]


def test_gaps_of_any_length(spark):
    """Random feeds against brute force, and a gap of fifty years that costs no more than a short one."""
    draw = random.Random(9)
    for by in ((), ("symbol",)):
        times = sorted(draw.sample(range(0, 400_000), 60))
        history = feed(spark, *[(str(k), draw.choice("AB"), t) for k, t in enumerate(times)])
        fetched = feed(spark, *[(f"f{k}", draw.choice("AB"), draw.randrange(-10, 400_010)) for k in range(300)])
        gaps = feed_gaps(history, 3600, by).collect()
        want = sorted(
            t.order_id for t in fetched.collect()
            if any(g.gap_start <= t.event_time <= g.gap_end and (not by or g.symbol == t.symbol) for g in gaps)
        )
        got = trades_in_gaps(fetched, feed_gaps(history, 3600, by), by).collect()
        assert sorted(t.order_id for t in got) == want
    years = 50 * 365 * 86_400
    long = feed_gaps(feed(spark, ("1", "A", -years), ("2", "A", 0)))
    inside = trades_in_gaps(feed(spark, ("3", "A", -years / 2), ("4", "A", 1)), long).collect()
    assert [t.order_id for t in inside] == ["3"]


def test_numbers_in_reasons_are_plain(spark):
    numbers = [-0.0005, -12345678.0, -0.0012, -1.5, -123456789012.25, 0.0]
    frame = spark.createDataFrame([(x,) for x in numbers], "x double")
    assert [r.t for r in frame.select(number_text(F.col("x")).alias("t")).collect()] == [
        "-0.0005", "-12345678.0", "-0.0012", "-1.5", "-123456789012.25", "0.0"
    ]


def test_dedup_keeps_the_earliest_copy(spark):
    frame = feed(spark, ("1", "A", 5), ("1", "A", 0), ("1", "B", 3))
    got = sorted((r.symbol, r.event_time) for r in dedup_trades(frame).collect())
    assert got == [("A", T0), ("B", T0 + timedelta(seconds=3))]


def test_a_day_with_half_of_all_trades_is_no_task(spark):
    """Trades of one busy day: what is ordered is slots, at most 1,440 a day, and trades are not ordered at all."""
    history = feed(spark, ("1", "A", 0), ("2", "A", 60_000))
    base = spark.range(200_000).select(
        F.lit("A").alias("symbol"),
        F.col("id").cast("string").alias("order_id"),
        (F.lit(T0) + F.make_dt_interval(secs=F.col("id") % 80_000)).alias("event_time"),
    )
    found = trades_in_gaps(base, feed_gaps(history))
    assert found.count() == base.filter(F.col("event_time") <= F.lit(T0 + timedelta(seconds=60_000))).count()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    ordered = [line for line in plan.splitlines() if "Window [" in line or "Sort [" in line]
    assert ordered and not any("order_id" in line for line in ordered)
    slots = base.select(F.floor(F.unix_timestamp("event_time") / 60)).distinct().count()
    assert slots <= 1_440
