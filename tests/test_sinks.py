"""Keyed tables under replays, dead letters, messages, connector options."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tapewarden.config import PD_ALERTS_TOPIC, WASH_ALERTS_TOPIC
from tapewarden.operators.alerts import (
    check_constraints,
    decode_alerts,
    known_symbols,
    query_alerts,
    route_alerts,
    within_lookback,
)
from tapewarden.schema import (
    DEAD_LETTER_COLUMNS,
    KEYED_TABLES,
    PUMP_DUMP_ALERTS,
    WASH_ALERTS,
    WASH_SENSITIVITY,
)
from tapewarden.sinks.dead_letter import write_dead_letters
from tapewarden.sinks import keyed
from tapewarden.sinks.keyed import (
    compact,
    insert_ignore,
    read_inserted,
    read_upserted,
    touched_dates,
    upsert,
)
from tapewarden.sinks.messages import encode_alerts, write_messages
from tapewarden.sinks.relational import jdbc_options
from tapewarden.sources.streams import alert_broker_options, trade_broker_options
from tapewarden.sources.workspace import workspace

T0 = datetime(2026, 1, 1)


def wash_rows(spark, *rows):
    """rows: (minute, symbol, severity, z_score, detection minute)"""
    return spark.createDataFrame(
        [
            (
                T0 + timedelta(minutes=m), T0 + timedelta(minutes=m + 2), s, 1, 1.0, 1.0, 0.0, z, sev,
                "WASH_TRADE", T0 + timedelta(minutes=seen),
            )
            for m, s, sev, z, seen in rows
        ],
        "window_start timestamp, window_end timestamp, symbol string, trade_count int, "
        "total_volume double, mean_volume double, std_volume double, z_score double, "
        "severity string, alert_type string, detected_at timestamp",
    )


def sweep_rows(spark, *rows):
    """rows: (minute, threshold, z_score, detection minute)"""
    return spark.createDataFrame(
        [
            (
                T0 + timedelta(minutes=m), T0 + timedelta(minutes=m + 2), "A", 1, 1.0, z, t, z > t,
                None, T0 + timedelta(minutes=seen),
            )
            for m, t, z, seen in rows
        ],
        WASH_SENSITIVITY.schema,
    )


def stored(spark, root):
    return sorted((r.symbol, r.window_start, r.severity) for r in read_inserted(spark, root, WASH_ALERTS).collect())


def test_insert_ignore_keeps_the_first(spark, tmp_path):
    root = str(tmp_path)
    first = wash_rows(spark, (0, "A", "HIGH", 2.0, 1), (0, "A", "MEDIUM", 1.0, 2))
    second = wash_rows(spark, (0, "A", "CRITICAL", 9.0, 3), (1440, "A", "HIGH", 2.0, 3))
    insert_ignore(first, root, WASH_ALERTS, 0)
    insert_ignore(second, root, WASH_ALERTS, 1)
    want = [("A", T0, "HIGH"), ("A", T0 + timedelta(days=1), "HIGH")]
    assert stored(spark, root) == want


def test_insert_ignore_replay_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    batches = [
        wash_rows(spark, (0, "A", "HIGH", 2.0, 1), (2, "A", "HIGH", 2.0, 1)),
        wash_rows(spark, (2, "A", "CRITICAL", 9.0, 2), (4, "A", "MEDIUM", 1.0, 2)),
    ]
    for batch_id in (0, 0, 1, 1):
        insert_ignore(batches[batch_id], root, WASH_ALERTS, batch_id)
    assert [s for *_, s in stored(spark, root)] == ["HIGH", "HIGH", "MEDIUM"]


def test_a_second_writer_does_not_replace_the_first(spark, tmp_path):
    root = str(tmp_path)
    insert_ignore(wash_rows(spark, (0, "A", "HIGH", 2.0, 1)), root, WASH_ALERTS, 0, "one")
    insert_ignore(
        wash_rows(spark, (0, "A", "CRITICAL", 2.0, 1), (2, "A", "MEDIUM", 1.0, 1)),
        root, WASH_ALERTS, 0, "two",
    )
    assert [s for *_, s in stored(spark, root)] == ["HIGH", "MEDIUM"]


def test_empty_batch_and_empty_table(spark, tmp_path):
    insert_ignore(wash_rows(spark, (0, "A", "HIGH", 1.0, 1)).filter("false"), str(tmp_path), WASH_ALERTS, 0)
    assert stored(spark, str(tmp_path)) == []


def test_upsert_keeps_the_last_and_survives_replay(spark, tmp_path):
    root = str(tmp_path)
    first = sweep_rows(spark, (0, 0.1, 1.0, 1), (0, 0.5, 0.2, 1))
    second = sweep_rows(spark, (0, 0.5, 0.9, 2), (0, 0.5, 0.7, 1))
    for batch_id, rows in ((0, first), (1, second), (1, second)):
        upsert(rows, root, WASH_SENSITIVITY, batch_id)
    rows = read_upserted(spark, root, WASH_SENSITIVITY).orderBy("threshold").collect()
    assert [(r.threshold, r.z_score, r.flagged) for r in rows] == [(0.1, 1.0, True), (0.5, 0.9, True)]


def test_compaction_keeps_the_rows(spark, tmp_path):
    root = str(tmp_path)
    for batch_id in range(3):
        upsert(sweep_rows(spark, (0, 0.1, 1.0 + batch_id, batch_id)), root, WASH_SENSITIVITY, batch_id)
    day = touched_dates(sweep_rows(spark, (0, 0.1, 1.0, 0)))
    for _ in range(2):
        compact(spark, root, WASH_SENSITIVITY, day, first=False)
        folders = list((tmp_path / f"target_table={WASH_SENSITIVITY.name}").glob("event_date=*/writer=*/batch_id=*"))
        assert [f.parent.name for f in folders] == ["writer=compacted"]
    upsert(sweep_rows(spark, (0, 0.5, 9.0, 9)), root, WASH_SENSITIVITY, 3)
    rows = read_upserted(spark, root, WASH_SENSITIVITY).orderBy("threshold").collect()
    assert [r.z_score for r in rows] == [3.0, 9.0]


def test_compaction_of_a_first_wins_table(spark, tmp_path):
    root = str(tmp_path)
    insert_ignore(wash_rows(spark, (0, "A", "HIGH", 1.0, 1)), root, WASH_ALERTS, 0)
    insert_ignore(wash_rows(spark, (0, "A", "LOW", 1.0, 0), (2, "A", "MEDIUM", 1.0, 1)), root, WASH_ALERTS, 1)
    before = stored(spark, root)
    compact(spark, root, WASH_ALERTS, touched_dates(wash_rows(spark, (0, "A", "HIGH", 1.0, 1))), first=True)
    assert stored(spark, root) == before
    # A replayed batch finds its keys stored.
    insert_ignore(wash_rows(spark, (2, "A", "CRITICAL", 1.0, 0)), root, WASH_ALERTS, 1)
    assert stored(spark, root) == before


def test_concurrent_writers_leave_one_row_a_key(spark, tmp_path):
    root = str(tmp_path)
    rows = [(k, "A", "HIGH", 1.0, 1) for k in range(50)]
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda w: insert_ignore(wash_rows(spark, *rows), root, WASH_ALERTS, 0, w), ("x", "y")))
    assert len(stored(spark, root)) == 50
    assert read_inserted(spark, root, WASH_ALERTS).count() == 50


def test_a_batch_lists_only_its_dates(spark, tmp_path):
    root = str(tmp_path)
    insert_ignore(wash_rows(spark, (0, "A", "HIGH", 1.0, 1), (5000, "A", "HIGH", 1.0, 1)), root, WASH_ALERTS, 0)
    days = touched_dates(wash_rows(spark, (5000, "A", "HIGH", 1.0, 1)))
    files = keyed._stored(spark, root, WASH_ALERTS, days).inputFiles()
    assert files and all(f"event_date={days[0].isoformat()}" in f for f in files)


def test_only_changes_are_stored(spark, tmp_path):
    root = str(tmp_path)
    upsert(sweep_rows(spark, (0, 0.1, 1.0, 1), (0, 0.5, 2.0, 1)), root, WASH_SENSITIVITY, 0)
    upsert(
        sweep_rows(spark, (0, 0.1, 1.0, 2), (0, 0.5, 3.0, 2)), root, WASH_SENSITIVITY, 1, only_changes=True
    )
    added = keyed._stored(spark, root, WASH_SENSITIVITY).filter("batch_id = 1").collect()
    assert [(r.threshold, r.z_score) for r in added] == [(0.5, 3.0)]


def test_new_rows_are_handed_on_once(spark, tmp_path):
    root, got = str(tmp_path), []
    hand_on = lambda new: got.append(sorted(r.window_start for r in new.collect()))
    insert_ignore(wash_rows(spark, (0, "A", "HIGH", 1.0, 1)), root, WASH_ALERTS, 0, on_new=hand_on)
    both = wash_rows(spark, (0, "A", "HIGH", 1.0, 1), (2, "A", "HIGH", 1.0, 1))
    insert_ignore(both, root, WASH_ALERTS, 1, on_new=hand_on)
    assert [len(x) for x in got] == [1, 1] and got[0] != got[1]


def test_date_bounds_prune_partitions(spark, tmp_path):
    root = str(tmp_path)
    upsert(sweep_rows(spark, (0, 0.1, 1.0, 0), (1440, 0.1, 2.0, 0)), root, WASH_SENSITIVITY, 0)
    since = read_upserted(spark, root, WASH_SENSITIVITY, since=F.lit("2026-01-02").cast("date"))
    assert [r.z_score for r in since.collect()] == [2.0]
    assert "PartitionFilters: [isnotnull(event_date" in since._jdf.queryExecution().toString()


def test_key_columns_exist_and_are_required_where_declared():
    for table in KEYED_TABLES:
        assert set(table.key) <= set(table.schema.names)
        assert {"window_start", "window_end", "symbol"} <= set(table.required)


def test_dead_letters_round_trip(spark, tmp_path):
    frame = spark.createDataFrame(
        [tuple(["a,b", 'q"x'] + [None] * 6 + ["why:x", "now"])],
        ", ".join(f"{c} string" for c in DEAD_LETTER_COLUMNS),
    )
    for batch_id in (0, 0, 1):
        write_dead_letters(frame, str(tmp_path), batch_id)
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path))
    assert back.count() == 2
    assert tuple(c for c in back.columns if c not in ("writer", "batch_id")) == DEAD_LETTER_COLUMNS
    row = back.first()
    assert (row.trade_id, row.rejection_reason) == ("a,b", "why:x")


def test_alert_messages_round_trip_by_topic(spark, tmp_path):
    rows = wash_rows(spark, (0, "A", "HIGH", 2.5, 1))
    write_messages(encode_alerts(rows, WASH_ALERTS_TOPIC), "json", {}, str(tmp_path))
    assert (tmp_path / f"topic={WASH_ALERTS_TOPIC}").is_dir()
    messages = spark.read.json(str(tmp_path))
    back = decode_alerts(messages, WASH_ALERTS).drop("value")
    assert back.collect() == rows.collect()


def test_alias_and_defaults(spark):
    text = (
        '{"window_start":"2026-06-01T12:00:00","window_end":"2026-06-01T12:01:00",'
        '"symbol":"SOLUSDT","trade_count":42,"total_volume":999.0,"mean_volume":100.0,'
        '"std_volume":20.0,"zscore":4.5,"severity":"HIGH"}'
    )
    messages = spark.createDataFrame([(text,)], "value string")
    row = decode_alerts(messages, WASH_ALERTS, F.lit(T0)).first()
    assert (row.z_score, row.alert_type, row.detected_at) == (4.5, "WASH_TRADE", T0)


def test_broken_rows_are_named(spark):
    texts = [
        '{"window_end":"2026-06-01T12:01:00","symbol":"A","severity":"HIGH"}',
        '{"window_start":"x","window_end":"2026-06-01T12:01:00","symbol":"A","severity":"HIGH"}',
        '{"window_start":"2026-06-01","window_end":"2026-06-01","symbol":"A","severity":"VERY CRITICAL"}',
        "junk",
        '{"window_start":"2026-06-01","window_end":"2026-06-01","symbol":"A","severity":"HIGH"}',
    ]
    messages = spark.createDataFrame([(t,) for t in texts], "value string")
    checked = check_constraints(decode_alerts(messages, WASH_ALERTS), WASH_ALERTS).collect()
    assert [r.constraint_error for r in checked] == [
        "null:window_start", "null:window_start", "too_long:severity", "null:window_start", None,
    ]


def test_routing(spark):
    frame = spark.createDataFrame(
        [(WASH_ALERTS_TOPIC,), (PD_ALERTS_TOPIC,), ("other",)], "topic string"
    )
    assert [r.target_table for r in route_alerts(frame).collect()] == [
        WASH_ALERTS.name, PUMP_DUMP_ALERTS.name, None,
    ]


def test_search_limit_holds_per_table(spark):
    wash = wash_rows(spark, *[(m, "A", "HIGH", 1.0, m) for m in range(5)])
    pump = wash.select("window_start", "window_end", "symbol", "severity", "detected_at").withColumn(
        "alert_type", F.lit("PUMP_DUMP")
    )
    both = query_alerts(wash, pump, limit=2).collect()
    assert sorted((r.alert_type, r.detected_at) for r in both) == [
        ("PUMP_DUMP", T0 + timedelta(minutes=3)), ("PUMP_DUMP", T0 + timedelta(minutes=4)),
        ("WASH_TRADE", T0 + timedelta(minutes=3)), ("WASH_TRADE", T0 + timedelta(minutes=4)),
    ]
    assert query_alerts(wash, pump, "wash", symbol="B").count() == 0
    with pytest.raises(ValueError):
        query_alerts(wash, pump, "spoofing")


def test_lookback_and_known_symbols(spark):
    wash = wash_rows(spark, (0, "A", "HIGH", 1.0, 0), (30, "B", "HIGH", 1.0, 30))
    now = F.lit(T0 + timedelta(minutes=40))
    assert [r.symbol for r in within_lookback(wash, "detected_at", 10, now).collect()] == ["B"]
    assert within_lookback(wash, "detected_at", None, now).count() == 2
    table = spark.createDataFrame([("B",)], "symbol string")
    assert [r.symbol for r in known_symbols(wash, table).collect()] == ["B"]
    assert [r.symbol for r in known_symbols(wash, ["A"]).collect()] == ["A"]


def test_connector_options():
    assert trade_broker_options("host:9092") == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "market-trades",
        "startingOffsets": "latest", "failOnDataLoss": "false",
    }
    alert = alert_broker_options("host:9092", maxOffsetsPerTrigger="1000")
    assert alert["subscribe"] == "wash-alerts,pump-dump-alerts"
    assert (alert["startingOffsets"], alert["maxOffsetsPerTrigger"]) == ("earliest", "1000")
    assert jdbc_options("jdbc:x", "t", user="u", numPartitions="4") == {
        "url": "jdbc:x", "dbtable": "t", "user": "u", "numPartitions": "4",
    }


def test_workspace_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = workspace(spark, "x"), workspace(spark, "x")
    assert one.startswith(shared) and one != two
