"""What the plans must look like to hold at scale."""

from __future__ import annotations

import pytest

from tapewarden.catalog import all_queries

FOLDER = "/root/testdata/sf0.001"
ONE_SCAN = (
    "wash_alerts", "wash_zscores", "wash_sweep", "wash_sweep_summary", "ohlcv_bars",
    "volume_ratio_loo", "volume_ratio_trailing", "pump_dump_alerts", "pump_dump_alerts_trailing",
    "pd_sweep", "pd_sweep_summary", "pump_dump_candidates", "pump_dump_pairs", "feed_gaps",
    "feed_gaps_by_symbol", "pd_report_table",
)


def final_plan(spark, name):
    df = all_queries()[name](spark, FOLDER)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("name", ONE_SCAN)
def test_trades_are_read_and_shuffled_once(spark, name):
    plan = final_plan(spark, name)
    assert plan.count("FileScan") == 1
    for unwanted in ("Python", "NestedLoop", "Cartesian", "SortAggregate"):
        assert unwanted not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = final_plan(spark, "wash_alerts")
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>" in plan
    assert "In(event_type" in plan


def test_a_limit_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in final_plan(spark, "pump_dump_pairs")


def test_copies_are_dropped_before_the_shuffle(spark):
    plan = final_plan(spark, "ingest_trades")
    assert plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")


def test_json_is_parsed_once_per_row(spark):
    assert final_plan(spark, "ingest_trades").count("from_json") <= 2  # one per union branch


def test_stored_tables_are_pruned_by_day_and_symbol(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = final_plan(spark, "report_from_tables")
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert plan.count("PartitionFilters: [isnotnull(event_date") == plan.count("FileScan") > 0
    assert plan.count("EqualTo(symbol,purchase)") == plan.count("FileScan")


def test_the_stream_join_has_a_time_block(spark, tmp_path):
    from tapewarden.streaming.pairs import pair_stream

    schema = "symbol string, window_start timestamp, price_change_pct double"
    (tmp_path / "in").mkdir()
    side = lambda: spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    plan = pair_stream(side(), side(), "5 minutes", "1 minute")._jdf.queryExecution().analyzed().toString()
    assert "_pump_block" in plan.split("Join Inner", 1)[1].split("\n", 1)[0]
