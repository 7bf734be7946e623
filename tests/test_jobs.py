"""The command line, report panels and settings of running streams."""

from __future__ import annotations

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tapewarden import DetectionConfig
from tapewarden.jobs import configured, launch, parser
from tapewarden.plans.pump_dump import pump_dump_alerts, pump_dump_sweep_rows
from tapewarden.plans.report import build_report
from tapewarden.plans.wash import scored_windows, wash_alerts
from tapewarden.schema import PD_SENSITIVITY, PUMP_DUMP_ALERTS, WASH_ALERTS
from tapewarden.sinks.keyed import read_inserted, read_upserted
from tapewarden.sinks.messages import encode_trades, write_messages
from tapewarden.streaming.jobs import start

T0 = datetime(2026, 1, 1)


@pytest.fixture(scope="module")
def trades(spark):
    """An hour of trades of three symbols, one every two seconds; SOLUSDT is quiet and loud."""
    n = F.col("id")
    symbol = F.element_at(F.array(*map(F.lit, ("BTCUSDT", "ETHUSDT", "SOLUSDT"))), (n % 3 + 1).cast("int"))
    wave = F.sin(n / 40.0) * F.when(n % 3 == 0, 3.0).otherwise(1.0)
    return spark.range(1800).select(
        n.cast("string").alias("trade_id"),
        n.cast("string").alias("order_id"),
        symbol.alias("symbol"),
        (100 + wave).alias("price"),
        (1 + (n * 7 % 11) * F.when((n > 900) & (n < 960), 20).otherwise(1)).cast("double").alias("quantity"),
        F.lit("BUY").alias("side"),
        F.lit("TRADE").alias("event_type"),
        (F.lit(T0) + F.make_dt_interval(secs=(n * 2).cast("decimal(18,6)"))).alias("event_time"),
    )


def test_jobs_run_end_to_end_from_the_command_line(spark, trades, tmp_path):
    raw = F.to_json(
        F.struct(
            F.unix_millis("event_time").alias("T"), F.col("symbol").alias("s"),
            F.col("price").cast("string").alias("p"), F.col("quantity").cast("string").alias("q"),
            F.lit(True).alias("m"), F.col("order_id").cast("long").alias("a"),
        )
    )
    write_messages(trades.select(raw.alias("value")), "json", {}, f"{tmp_path}/raw")
    write_messages(encode_trades(trades), "json", {}, f"{tmp_path}/trades")
    base = ["--format", "json", "--once", "--state-partitions", "2", "--root", f"{tmp_path}/t"]
    launch(
        spark, ["ingest", *base, "--option", f"path={tmp_path}/raw", "--checkpoint", f"{tmp_path}/c0"]
    ).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/t/trades").count() == trades.count()

    launch(
        spark,
        ["wash", *base, "--option", f"path={tmp_path}/trades", "--checkpoint", f"{tmp_path}/c1",
         "--alert-format", "json", "--alert-path", f"{tmp_path}/topics"],
    ).awaitTermination()
    own = read_inserted(spark, f"{tmp_path}/t", WASH_ALERTS)
    assert own.count() > 10

    stored_base = [*base[:-1], f"{tmp_path}/stored"]
    launch(
        spark,
        ["persist", *stored_base, "--option", f"path={tmp_path}/topics", "--checkpoint", f"{tmp_path}/c2"],
    ).awaitTermination()
    stored = read_inserted(spark, f"{tmp_path}/stored", WASH_ALERTS)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, own.collect()))


def test_raw_feed_with_duplicates_through_all_jobs(spark, trades, tmp_path):
    raw = F.to_json(
        F.struct(
            F.unix_millis("event_time").alias("T"), F.col("symbol").alias("s"),
            F.when(F.col("order_id") == "7", "-1").otherwise(F.col("price").cast("string")).alias("p"),
            F.col("quantity").cast("string").alias("q"), F.lit(True).alias("m"),
            F.col("order_id").cast("long").alias("a"),
        )
    )
    once = trades.select(raw.alias("value"))
    write_messages(once.union(once), "json", {}, f"{tmp_path}/raw")
    base = ["--format", "json", "--once", "--state-partitions", "2", "--root", f"{tmp_path}/t"]
    ingest = launch(
        spark,
        ["ingest", *base, "--option", f"path={tmp_path}/raw", "--checkpoint", f"{tmp_path}/c0",
         "--alert-format", "json", "--alert-path", f"{tmp_path}/topics"],
    )
    ingest.awaitTermination()
    stored = spark.read.parquet(f"{tmp_path}/t/trades")
    assert stored.count() == stored.select("symbol", "order_id").distinct().count() == trades.count() - 1
    assert {f.name for f in (tmp_path / "t/trades").iterdir() if "=" in f.name} == {"event_date=2026-01-01"}
    rejected = spark.read.option("header", True).csv(f"{tmp_path}/t/rejected_trades")
    assert {r.rejection_reason for r in rejected.collect()} == {"non_positive_price:-1.0"}
    wait = time.time() + 20
    while time.time() < wait and not ingest.counters.totals["ingest", "valid"]:
        time.sleep(0.2)
    assert ingest.counters.totals["ingest", "valid"] == trades.count() - 1
    assert ingest.counters.totals["ingest-rejects", "rejected"] == 2
    assert '"ingest.valid"' in ingest.report()

    from_messages = [*base, "--option", f"path={tmp_path}/topics/topic=market-trades"]
    table = f"{tmp_path}/t/trades/event_date=2026-01-01/writer=ingest"
    from_table = ["--format", "parquet", *base[2:], "--option", f"path={table}", "--trade-table"]
    for k, (job, source) in enumerate((("wash", from_messages), ("pump-dump", from_table))):
        launch(
            spark,
            [job, *source, "--checkpoint", f"{tmp_path}/c{k + 1}", "--setting", "wash_threshold=0.5",
             "--alert-format", "json", "--alert-path", f"{tmp_path}/alerts"],
        ).awaitTermination()
    assert read_inserted(spark, f"{tmp_path}/t", WASH_ALERTS).count() > 0
    # Bars of the table's trades that closed, as a batch has them.
    bars = read_upserted(spark, f"{tmp_path}/t", PD_SENSITIVITY)
    batch = pump_dump_sweep_rows(trades.filter("order_id <> '7'"), DetectionConfig(), F.col("window_end"))
    want = batch.filter(F.col("window_end") <= trades.agg(F.max("event_time")).first()[0] - timedelta(minutes=1))
    columns = ("symbol", "window_start", "price_threshold", "vol_threshold", "phase", "flagged")
    assert sorted(map(tuple, bars.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))
    assert bars.count() > 1000
    assert all(abs(r.z_score) > 0.5 for r in read_inserted(spark, f"{tmp_path}/t", WASH_ALERTS).collect())
    kept = [*base[:-1], f"{tmp_path}/kept"]
    launch(
        spark, ["persist", *kept, "--option", f"path={tmp_path}/alerts", "--checkpoint", f"{tmp_path}/c3"]
    ).awaitTermination()
    for table in (WASH_ALERTS, PUMP_DUMP_ALERTS):
        one, two = (read_inserted(spark, f"{tmp_path}/{x}", table).drop("detected_at") for x in ("t", "kept"))
        assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))


def test_settings_from_the_command_line():
    config = configured(
        {"wash_window": "1 minute", "wash_grid": "1,2", "pd_grid": "0.1:2,0.2:3", "report_point": "0.1:2", "volume_ratio": "2"},
        ("A",),
    )
    assert config == DetectionConfig(
        symbols=("A",), wash_window="1 minute", wash_grid=(1.0, 2.0), pd_grid=((0.1, 2.0), (0.2, 3.0)),
        report_point=(0.1, 2.0), volume_ratio=2.0,
    )
    with pytest.raises(ValueError):
        configured({"speed": "1"}, None)


def test_panels_count_more_than_any_table_shows(spark):
    """2,500 wash alerts and 600 pairs: totals are whole, tables show the newest 50."""
    at = F.lit(T0) + F.make_dt_interval(mins=(F.col("id") * 10).cast("int"))
    ids = spark.range(2500)
    wash = ids.select(
        at.alias("window_start"), (at + F.expr("INTERVAL 2 MINUTES")).alias("window_end"),
        F.lit("BTCUSDT").alias("symbol"), F.lit(1).alias("trade_count"), F.lit(1.0).alias("total_volume"),
        F.lit(1.0).alias("mean_volume"), F.lit(0.0).alias("std_volume"), F.lit(3.0).alias("z_score"),
        F.lit("HIGH").alias("severity"), F.lit("WASH_TRADE").alias("alert_type"), at.alias("detected_at"),
    )
    config = DetectionConfig()
    price, volume = config.report_point
    bars = spark.range(1200).withColumn("at", F.lit(T0) + F.make_dt_interval(
        mins=(F.floor(F.col("id") / 2) * 30 + F.col("id") % 2).cast("int")))
    sweep = bars.select(
        F.col("at").alias("window_start"), (F.col("at") + F.expr("INTERVAL 1 MINUTE")).alias("window_end"),
        F.lit("ETHUSDT").alias("symbol"), F.when(F.col("id") % 2 == 0, 2.0).otherwise(-2.0).alias("price_change_pct"),
        F.lit(3.0).alias("volume_ratio"), F.lit(price).alias("price_threshold"), F.lit(volume).alias("vol_threshold"),
        F.when(F.col("id") % 2 == 0, "PUMP").otherwise("DUMP").alias("phase"), F.lit(True).alias("flagged"),
        F.lit("HIGH").alias("severity"), F.col("at").alias("detected_at"),
    )
    panels = build_report(wash, sweep, config).panels()
    overview = panels["overview"].first()
    assert (overview.wash_alerts, overview.pump_dump_alerts) == (2500, 600)
    assert len(panels["recent_wash"].collect()) == len(panels["recent_pairs"].collect()) == 50


def test_command_line_defaults():
    args = parser().parse_args(["wash", "--root", "r", "--checkpoint", "c"])
    assert (args.format, args.symbols, args.once) == ("kafka", "BTCUSDT,ETHUSDT,SOLUSDT", False)
    with pytest.raises(SystemExit):
        parser().parse_args(["spoof", "--root", "r", "--checkpoint", "c"])


def test_any_symbol_gives_the_same_answer_without_a_broadcast_bound(spark, trades):
    some, any_symbol = DetectionConfig(), DetectionConfig(symbols=None)
    columns = ["symbol", "window_start", "severity"]
    for detect in (wash_alerts, pump_dump_alerts):
        one, other = detect(trades, some), detect(trades, any_symbol)
        assert sorted(map(tuple, one.select(columns).collect())) == sorted(
            map(tuple, other.select(columns).collect())
        )
    plan = scored_windows(trades, any_symbol)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan


def test_report_panels_agree_with_each_other(spark, trades):
    config = DetectionConfig()
    report = build_report(
        wash_alerts(trades, config, F.col("window_end")),
        pump_dump_sweep_rows(trades, config, F.col("window_end")),
        config,
    )
    panels = {name: frame.collect() for name, frame in report.panels().items()}
    overview = panels["overview"][0]
    assert overview.total_alerts == overview.wash_alerts + overview.pump_dump_alerts > 0
    assert sum(r.alerts for r in panels["timeline"]) == overview.total_alerts
    assert sum(r.alerts for r in panels["wash_severity"]) == overview.wash_alerts
    assert sum(r.alerts for r in panels["pair_severity"]) == overview.pump_dump_alerts
    assert len(panels["pair_points"]) == overview.pump_dump_alerts
    risk = panels["symbol_risk"]
    assert [r.symbol for r in risk] == [
        r.symbol for r in sorted(risk, key=lambda r: (-r.risk_score, r.symbol))
    ]
    assert sum(r.wash_alerts for r in risk) == overview.wash_alerts
    assert len(panels["recent_wash"]) == min(50, overview.wash_alerts)


def test_report_look_back_counts_pairs_by_their_pump(spark, trades):
    config = DetectionConfig()
    now = F.lit(T0 + timedelta(minutes=60))
    inputs = (
        wash_alerts(trades, config, F.col("window_end")),
        pump_dump_sweep_rows(trades, config, F.col("window_end")),
    )
    full = build_report(*inputs, config).pairs.collect()
    recent = build_report(*inputs, config, lookback_minutes=20, as_of=now).pairs.collect()
    limit = T0 + timedelta(minutes=40)
    assert sorted(r.pump_start for r in recent) == sorted(
        r.pump_start for r in full if r.pump_start >= limit
    )
    assert recent


def test_processing_time_trigger(spark, trades, tmp_path):
    trades.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(trades.schema).parquet(f"{tmp_path}/in")
    seen = []
    query = start(
        stream, lambda batch, _: seen.append(batch.count()), f"{tmp_path}/c", trigger="1 second"
    )
    query.processAllAvailable()
    query.stop()
    assert sum(seen) == trades.count()
