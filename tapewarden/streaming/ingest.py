"""Streaming ingest: dead letters apart, duplicates out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapewarden.config import TRADES_TOPIC
from tapewarden.operators.trades import rejected_only, valid_only, validate_trades
from tapewarden.schema import TRADE_KEY
from tapewarden.sinks.dead_letter import write_dead_letters
from tapewarden.sinks.messages import MessageTarget, encode_trades, write_messages
from tapewarden.streaming.jobs import TRIGGER, each_nonempty, start


def dedup_stream(trades: DataFrame, within: str) -> DataFrame:
    """First copy of each (symbol, order_id); a key is forgotten after ``within``."""
    return trades.withWatermark("event_time", within).dropDuplicatesWithinWatermark(
        list(TRADE_KEY)
    )


def store_trades(trades: DataFrame, path: str, batch_id: int, writer: str) -> None:
    """A batch of trades under ``event_date / writer / batch_id``, so that readers prune by day."""
    (
        trades.withColumns(
            {
                "event_date": F.to_date("event_time"),
                "writer": F.lit(writer),
                "batch_id": F.lit(batch_id).cast("long"),
            }
        )
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date", "writer", "batch_id")
        .parquet(path)
    )


def start_ingest(
    raw: DataFrame,
    symbols: Sequence[str] | None,
    valid_path: str,
    rejected_path: str,
    checkpoint: str,
    within: str = "1 hour",
    trigger: str | None = TRIGGER,
    rejected_at: Column | None = None,
    writer: str = "ingest",
    target: MessageTarget | None = None,
) -> list[StreamingQuery]:
    """Trades of a raw feed to a table of valid ones, each once, and a place of rejected ones.

    Two queries read the feed, as only valid trades have a time that can age
    out of the state that drops duplicates. Of a trade that comes again within
    ``within`` one copy stays; one that comes later than that behind the feed
    is dropped and counted as late. Valid trades also go to ``target`` as
    messages keyed by symbol, which the detectors read.
    """
    checked = validate_trades(raw, symbols)

    def store(batch: DataFrame, batch_id: int) -> None:
        store_trades(batch, valid_path, batch_id, writer)
        if target is not None:
            messages = encode_trades(batch).withColumn("topic", F.lit(TRADES_TOPIC))
            write_messages(messages, target.fmt, target.options, target.path)

    def reject(batch: DataFrame, batch_id: int) -> None:
        write_dead_letters(rejected_only(batch, rejected_at), rejected_path, batch_id, writer)

    valid = dedup_stream(valid_only(checked), within).observe(
        "ingest", F.count(F.lit(1)).alias("valid")
    )
    rejects = checked.filter(F.col("rejection_reason").isNotNull()).observe(
        "rejects", F.count(F.lit(1)).alias("rejected")
    )
    return [
        start(valid, each_nonempty(store), f"{checkpoint}/valid", "append", trigger, writer),
        start(
            rejects, each_nonempty(reject), f"{checkpoint}/rejected", "append", trigger, f"{writer}-rejects"
        ),
    ]


def start_validation(
    trades: DataFrame,
    symbols: Sequence[str] | None,
    valid_path: str,
    rejected_path: str,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    rejected_at: Column | None = None,
    writer: str = "validation",
) -> StreamingQuery:
    """Validate once per batch; valid trades to parquet, rejects to CSV.

    Each batch owns its folders in either place, so a replay rewrites them.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        store_trades(valid_only(batch), valid_path, batch_id, writer)
        write_dead_letters(rejected_only(batch, rejected_at), rejected_path, batch_id, writer)

    checked = validate_trades(trades, symbols).observe(
        "validation",
        F.count(F.lit(1)).alias("trades"),
        F.count("rejection_reason").alias("rejected"),
    )
    return start(checked, each_nonempty(split), checkpoint, "append", trigger, writer)
