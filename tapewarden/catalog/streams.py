"""Streaming queries: each drains the table as a stream and returns what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewarden.catalog import alerting, detection, ingestion, reporting, sample
from tapewarden.catalog.ingestion import spoiled_trades
from tapewarden.catalog.sample import CONFIG, checked, with_ctes
from tapewarden.config import PD_ALERTS_TOPIC, WASH_ALERTS_TOPIC
from tapewarden.operators.alerts import all_alerts
from tapewarden.operators.running import BARS
from tapewarden.operators.sequences import flagged_at
from tapewarden.schema import PD_SENSITIVITY, PUMP_DUMP_ALERTS, WASH_ALERTS, WASH_SENSITIVITY
from tapewarden.plans.pump_dump import pump_dump_sweep_rows
from tapewarden.plans.report import build_report
from tapewarden.sinks.keyed import insert_ignore, read_inserted, read_upserted, upsert
from tapewarden.sinks.messages import encode_trades, write_messages
from tapewarden.sources.exchange import normalize_exchange_events
from tapewarden.sources.streams import alert_message_stream, trade_message_stream
from tapewarden.sources.tables import EVENTS, read_events, trades_from_events
from tapewarden.sources.workspace import workspace
from tapewarden.streaming.carry import Carried
from tapewarden.streaming.ingest import dedup_stream, start_ingest, start_validation
from tapewarden.streaming.jobs import start, start_files, stream_session
from tapewarden.streaming.pairs import pair_stream
from tapewarden.streaming.persist import start_alert_persister
from tapewarden.streaming.progress import read_triggers, store_triggers
from tapewarden.streaming.pump_dump import bar_stream, start_bar_rescoring, start_pump_dump_detector
from tapewarden.streaming.wash import start_wash_detector, window_stream

_DELAY = "1 minute"
_ONE_FILE = {"maxFilesPerTrigger": "1"}


#: Data triggers of each stream at least: one for each slice of the events by time.
SLICES = 4


#: Rows of a file of a slice, about: large slices are written and read by many tasks.
SLICE_ROWS = 50_000


def _sliced(rows, time, path, turns=None):
    """Rows as files in order of time: equal spans one after the other, as a feed would bring them.

    With ``turns`` only these spans (1 to SLICES), in this order. Rows without a
    time come with the span brought last. Returns the number of files, which
    every span has: a stream that takes so many per trigger takes one span.
    """
    turns = turns or range(1, SLICES + 1)
    spark = rows.sparkSession
    held = rows.persist()
    moment = F.col(time)
    if not dict(rows.dtypes)[time] == "bigint":
        moment = F.unix_micros(moment.cast("timestamp"))
    span = held.agg(F.min(moment).alias("lo"), F.max(moment).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    bounds = [None if span.lo is None else span.lo + (span.hi - span.lo) * k // SLICES for k in range(SLICES + 1)]
    files = max(1, min(spark.sparkContext.defaultParallelism, span.n // (SLICES * SLICE_ROWS)))
    for turn, k in enumerate(turns, 1):
        inside = F.lit(span.lo is not None)
        if span.lo is not None and k > 1:
            inside = inside & (moment > bounds[k - 1])
        if span.lo is not None and k < SLICES:
            inside = inside & (moment <= bounds[k])
        untimed = moment.isNull() if SLICES in turns and turn == len(turns) else F.lit(False)
        part = held.filter((moment.isNotNull() & inside) | untimed)
        # Ranges of time, so that a batch stored by day has few files a day.
        part = part.coalesce(1) if files == 1 else part.repartitionByRange(files, moment)
        part.write.mode("append").parquet(path)
        # A task without rows writes no file: files without rows make up the number.
        written = len(spark.read.schema(rows.schema).parquet(path).inputFiles())
        for _ in range(-written % files):
            held.limit(0).coalesce(1).write.mode("append").parquet(path)
    held.unpersist()
    return files


def _feed(session, schema, path, files):
    """The files of ``_sliced`` as a stream: a slice in each trigger."""
    return session.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def _events(session, folder, root):
    """The events as a stream of several triggers, a slice of time in each."""
    place = f"{root}/events"
    return _feed(session, EVENTS, place, _sliced(read_events(session, folder), "ts", place))


def _trades(session, folder, root):
    return trades_from_events(_events(session, folder, root))


def _drain(query):
    query.awaitTermination()


def _through_files(spark, stream, root):
    _drain(start_files(stream, f"{root}/out", f"{root}/checkpoint", trigger=None))
    return spark.read.parquet(f"{root}/out")


def _write_alert_messages(spark, folder, root):
    messages = alerting.alert_messages(spark, folder).repartition(SLICES)
    write_messages(messages, "json", {}, f"{root}/topics")


@checked
def src_trade_stream(spark, folder):
    """Trades published as JSON messages and read back as a typed stream."""
    root = workspace(spark, "trade-messages")
    messages = encode_trades(sample.trades(spark, folder)).repartition(SLICES)
    write_messages(messages, "json", {}, f"{root}/topic")
    session = stream_session(spark)
    trades = trade_message_stream(session, "json", {"path": f"{root}/topic", **_ONE_FILE})
    return _through_files(spark, trades.drop("timestamp"), root)


@checked
def src_alert_stream(spark, folder):
    """Both alert topics read as one stream, the topic kept."""
    root = workspace(spark, "alert-messages")
    _write_alert_messages(spark, folder, root)
    session = stream_session(spark)
    messages = alert_message_stream(session, "json", {"path": f"{root}/topics", **_ONE_FILE})
    wanted = messages.filter(F.col("topic").isin(WASH_ALERTS_TOPIC, PD_ALERTS_TOPIC)).select(
        "topic",
        F.get_json_object("value", "$.symbol").alias("symbol"),
        F.get_json_object("value", "$.window_start").alias("window_start"),
    )
    return _through_files(spark, wanted, root)


@checked
def stream_wash_windows(spark, folder):
    root = workspace(spark, "wash-windows")
    session = stream_session(spark)
    return _through_files(spark, window_stream(_trades(session, folder, root), CONFIG, _DELAY), root)


@checked
def stream_wash_complete(spark, folder):
    """Complete mode: the table always holds every window, open ones too."""
    root = workspace(spark, "wash-complete")
    windows = window_stream(_trades(stream_session(spark), folder, root), CONFIG, None)

    def replace(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{root}/out")

    _drain(start(windows, replace, f"{root}/checkpoint", "complete", trigger=None))
    return spark.read.parquet(f"{root}/out")


def _wash_tables(spark, folder, complete=False):
    root = workspace(spark, "wash-detector")
    _drain(
        start_wash_detector(
            _trades(stream_session(spark), folder, root),
            CONFIG,
            f"{root}/tables",
            f"{root}/checkpoint",
            delay=_DELAY,
            complete=complete,
            trigger=None,
            detected_at=F.col("window_end"),
        )
    )
    return f"{root}/tables"


@checked
def stream_wash_alerts(spark, folder):
    root = _wash_tables(spark, folder)
    return read_inserted(spark, root, WASH_ALERTS).drop("event_date")


@checked
def stream_wash_rescored(spark, folder):
    root = _wash_tables(spark, folder, complete=True)
    return read_inserted(spark, root, WASH_ALERTS).drop("event_date")


@checked
def stream_sweep(spark, folder):
    root = _wash_tables(spark, folder)
    return read_upserted(spark, root, WASH_SENSITIVITY).drop("event_date")


@checked
def stream_ohlcv_append(spark, folder):
    root = workspace(spark, "bars")
    bars = bar_stream(_trades(stream_session(spark), folder, root), CONFIG, _DELAY).drop("event_time")
    return _through_files(spark, bars, root)


def _pump_dump_tables(spark, folder):
    root = workspace(spark, "pump-dump")
    _drain(
        start_pump_dump_detector(
            _trades(stream_session(spark), folder, root),
            CONFIG,
            f"{root}/tables",
            f"{root}/checkpoint",
            delay=_DELAY,
            trigger=None,
            detected_at=F.col("window_end"),
        )
    )
    return f"{root}/tables"


@checked
def stream_pump_dump(spark, folder):
    root = _pump_dump_tables(spark, folder)
    return read_inserted(spark, root, PUMP_DUMP_ALERTS).drop("event_date")


@checked
def stream_pd_sweep(spark, folder):
    root = _pump_dump_tables(spark, folder)
    return read_upserted(spark, root, PD_SENSITIVITY).drop("event_date")


@checked
def stream_resumed(spark, folder):
    """The pump-and-dump detector stopped after half of the feed and started again from its checkpoint."""
    root = workspace(spark, "resumed")
    for turns in ((1, 2), (3, 4)):
        session = stream_session(spark)
        files = _sliced(read_events(session, folder), "ts", f"{root}/events", turns)
        feed = _feed(session, EVENTS, f"{root}/events", files)
        _drain(
            start_pump_dump_detector(
                trades_from_events(feed),
                CONFIG,
                f"{root}/tables",
                f"{root}/checkpoint",
                delay=_DELAY,
                trigger=None,
                detected_at=F.col("window_end"),
            )
        )
    return read_inserted(spark, f"{root}/tables", PUMP_DUMP_ALERTS).drop("event_date")


@checked
def stream_pump_expiry(spark, folder):
    """What the detector carries at the end of a feed with a quiet day after each day.

    Two symbols stop 40 hours before the others: a PUMP of theirs that is still
    open then is forgotten by the time of the others' bars.
    """
    root = workspace(spark, "expiry")
    session = stream_session(spark)
    quiet = F.make_dt_interval(days=F.datediff(F.col("ts"), F.lit("2024-01-01").cast("date")))
    ahead = F.make_dt_interval(hours=F.when(F.col("event_type").isin("click", "view"), 40).otherwise(0))
    events = read_events(session, folder).withColumn("ts", F.col("ts") + quiet - ahead)
    feed = _feed(session, EVENTS, f"{root}/events", _sliced(events, "ts", f"{root}/events"))
    _drain(
        start_pump_dump_detector(
            trades_from_events(feed), CONFIG, f"{root}/tables", f"{root}/checkpoint", delay=_DELAY, trigger=None
        )
    )
    carried = Carried(f"{root}/checkpoint/carried", BARS).before(spark, 1 << 40)
    return carried.select(
        "symbol",
        "bars",
        "volume",
        "newest",
        F.col("pump.window_start").alias("pump_start"),
        F.col("pump.price_change").alias("pump_change"),
    )


@checked
def stream_counters(spark, folder):
    """Counters of each trigger of the ingest job, for a feed whose second part comes last."""
    root = workspace(spark, "counters")
    session = stream_session(spark)
    files = _sliced(read_events(session, folder), "ts", f"{root}/events", (1, 3, 4, 2))
    feed = _feed(session, EVENTS, f"{root}/events", files)
    queries = start_ingest(
        spoiled_trades(feed),
        CONFIG.symbols,
        f"{root}/trades",
        f"{root}/rejected",
        f"{root}/checkpoint",
        trigger=None,
    )
    for query in queries:
        _drain(query)
        store_triggers(spark, query, root)
    kept = read_triggers(spark, root)
    valid = kept.filter("stream = 'ingest'").select(
        "batch_id", F.col("input_rows").alias("rows"), F.col("metrics")["valid"].alias("valid"), "late_rows"
    )
    rejected = kept.filter("stream = 'ingest-rejects'").select("batch_id", F.col("metrics")["rejected"].alias("rejected"))
    return valid.join(rejected, "batch_id")


@checked
def stream_dedup(spark, folder):
    """Two feeds of the same trades: each trade is kept once."""
    root = workspace(spark, "dedup")
    session = stream_session(spark)
    once = _trades(session, folder, root)
    twice = once.union(once)
    return _through_files(spark, dedup_stream(twice, "1 hour"), root)


@checked
def stream_validate(spark, folder):
    root = workspace(spark, "validate")
    trades = spoiled_trades(_events(stream_session(spark), folder, root))
    _drain(
        start_validation(
            trades,
            CONFIG.symbols,
            f"{root}/valid",
            f"{root}/rejected",
            f"{root}/checkpoint",
            trigger=None,
        )
    )
    valid = spark.read.parquet(f"{root}/valid").select(
        "trade_id", F.lit(None).cast("string").alias("rejection_reason")
    )
    rejected = spark.read.option("header", True).csv(f"{root}/rejected")
    return valid.unionByName(rejected.select("trade_id", "rejection_reason"))


@checked
def stream_ingest(spark, folder):
    """Raw messages, each twice, through the ingest job: valid trades, each once."""
    root = workspace(spark, "ingest")
    raw = ingestion.raw_messages(sample.trades(spark, folder))
    place = f"{root}/raw"
    at = F.coalesce(*[F.get_json_object("value", path).cast("long") for path in ("$.data.T", "$.T")])
    files = _sliced(raw.withColumn("at", at), "at", place)
    once = _feed(stream_session(spark), "value string", place, files)
    queries = start_ingest(
        normalize_exchange_events(once.union(once)),
        CONFIG.symbols,
        f"{root}/trades",
        f"{root}/rejected",
        f"{root}/checkpoint",
        trigger=None,
    )
    for query in queries:
        _drain(query)
    return spark.read.parquet(f"{root}/trades").drop("timestamp", "event_date", "writer", "batch_id")


def _rescored_bars(spark, folder):
    root = workspace(spark, "bar-rescoring")
    query = start_bar_rescoring(
        _trades(stream_session(spark), folder, root),
        CONFIG,
        f"{root}/tables",
        f"{root}/checkpoint",
        trigger=None,
        detected_at=F.col("window_end"),
    )
    _drain(query)
    return f"{root}/tables"


@checked
def stream_pump_dump_rescored(spark, folder):
    """The rescoring job's sweep rows over all closed bars."""
    root = _rescored_bars(spark, folder)
    return read_upserted(spark, root, PD_SENSITIVITY).drop("event_date", "detected_at")


@checked
def stream_rescored_alerts(spark, folder):
    """The rescoring job's alerts by the leave-one-out baseline: the first verdict of a PUMP stays."""
    root = _rescored_bars(spark, folder)
    return read_inserted(spark, root, PUMP_DUMP_ALERTS).drop("event_date")


@checked
def report_from_tables(spark, folder):
    """The report's overview over stored alert tables: filters reach the scan, days are folders."""
    root = workspace(spark, "report-tables")
    insert_ignore(sample.wash(spark, folder), root, WASH_ALERTS, 0)
    sweep = pump_dump_sweep_rows(sample.trades(spark, folder), CONFIG, F.col("window_end"))
    upsert(sweep, root, PD_SENSITIVITY, 0)
    since = F.lit(sample.AS_OF).cast("timestamp") - F.make_dt_interval(days=F.lit(15))
    day = F.to_date(since)
    report = build_report(
        read_inserted(spark, root, WASH_ALERTS, since=day),
        read_upserted(spark, root, PD_SENSITIVITY, since=day),
        CONFIG,
        symbol="purchase",
        lookback_minutes=20_160,
        as_of=F.lit(sample.AS_OF).cast("timestamp"),
    )
    return report.panels()["overview"]


@checked
def stream_alert_persist(spark, folder):
    root = workspace(spark, "persist")
    _write_alert_messages(spark, folder, root)
    options = {"path": f"{root}/topics", **_ONE_FILE}
    messages = alert_message_stream(stream_session(spark), "json", options)
    _drain(start_alert_persister(messages, f"{root}/tables", f"{root}/checkpoint", trigger=None))
    stored = [
        read_inserted(spark, f"{root}/tables", table).drop("event_date")
        for table in (WASH_ALERTS, PUMP_DUMP_ALERTS)
    ]
    return all_alerts(*stored)


@checked
def stream_pump_dump_join(spark, folder):
    root = workspace(spark, "pair-join")
    flagged = flagged_at(sample.report_sweep(spark, folder), CONFIG.report_point)
    columns = ("symbol", "window_start", "price_change_pct", "phase")
    files = _sliced(flagged.select(*columns), "window_start", f"{root}/flagged")
    session = stream_session(spark)
    schema = spark.read.parquet(f"{root}/flagged").schema

    def side(phase):
        return _feed(session, schema, f"{root}/flagged", files).filter(F.col("phase") == phase)

    live = pair_stream(side("PUMP"), side("DUMP"), CONFIG.pair_window, _DELAY)
    return _through_files(spark, live, root)


QUERIES = {
    "src_trade_stream": src_trade_stream,
    "src_alert_stream": src_alert_stream,
    "stream_wash_windows": stream_wash_windows,
    "stream_wash_complete": stream_wash_complete,
    "stream_wash_alerts": stream_wash_alerts,
    "stream_wash_rescored": stream_wash_rescored,
    "stream_sweep": stream_sweep,
    "stream_ohlcv_append": stream_ohlcv_append,
    "stream_pump_dump": stream_pump_dump,
    "stream_pd_sweep": stream_pd_sweep,
    "stream_resumed": stream_resumed,
    "stream_pump_expiry": stream_pump_expiry,
    "stream_counters": stream_counters,
    "stream_dedup": stream_dedup,
    "stream_validate": stream_validate,
    "stream_ingest": stream_ingest,
    "stream_pump_dump_rescored": stream_pump_dump_rescored,
    "stream_rescored_alerts": stream_rescored_alerts,
    "report_from_tables": report_from_tables,
    "stream_alert_persist": stream_alert_persist,
    "stream_pump_dump_join": stream_pump_dump_join,
}

_MARK = "(SELECT max(event_time) - INTERVAL 1 MINUTE FROM clean)"
_CLOSED_WINDOWS = (
    sample.TRADES + sample.WINDOWS.replace("windows AS", "every_window AS")
    + f""",
windows AS (SELECT * FROM every_window WHERE window_end <= {_MARK})"""
)
# Each window against those of its symbol up to and with it.
_RUNNING = """,
rated AS (
  SELECT *, avg(total_volume) OVER so_far AS mu, stddev_samp(total_volume) OVER so_far AS sd
  FROM windows
  WINDOW so_far AS (PARTITION BY symbol ORDER BY window_start ROWS UNBOUNDED PRECEDING)),
scored AS (
  SELECT * EXCLUDE (mu, sd), CASE WHEN sd > 1e-9 THEN (total_volume - mu) / sd ELSE 0.0 END AS z_score
  FROM rated)"""
_TURNS = f""",
turns AS (
  SELECT k, lo + (hi - lo) * k // {SLICES} AS bound
  FROM (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events), range(1, {SLICES} + 1) r(k))"""
# Rescoring alerts by trigger: all windows closed so far, and the first verdict of a window stays.
_BY_TRIGGER = (
    sample.TRADES + sample.WINDOWS + _TURNS
    + """,
reached AS (
  SELECT k, max(CAST(date_trunc('day', event_time) AS TIMESTAMP)) AS open_from
  FROM clean, turns WHERE epoch_us(event_time) <= bound GROUP BY k),
settled AS (SELECT w.*, k FROM windows w JOIN reached ON window_end <= open_from),
rescored AS (
  SELECT w.*, CASE WHEN sd > 0 THEN (w.total_volume - mu) / sd ELSE 0.0 END AS z_score
  FROM settled w JOIN (
    SELECT k, symbol, avg(total_volume) AS mu, stddev_samp(total_volume) AS sd
    FROM settled GROUP BY k, symbol) b ON b.symbol = w.symbol AND b.k = w.k),
scored AS (
  SELECT * FROM rescored WHERE abs(z_score) > 0.1
  QUALIFY row_number() OVER (PARTITION BY symbol, window_start ORDER BY k) = 1)"""
)
_CLOSED_BARS = (
    sample.TRADES + sample.BARS.replace("bars AS", "every_bar AS")
    + f""",
bars AS (SELECT * FROM every_bar WHERE window_end <= {_MARK})"""
)

_SETTLED_BARS = (
    sample.TRADES + sample.BARS.replace("bars AS", "every_bar AS")
    + """,
bars AS (SELECT * FROM every_bar WHERE window_end <= (SELECT max(window_start) FROM every_bar))"""
)
# The same for bars: by trigger a bar's ratio, the PUMP and DUMP bars, and the first verdict of a PUMP.
_BARS_BY_TRIGGER = (
    sample.TRADES + sample.BARS + _TURNS
    + """,
reached AS (
  SELECT k, max(date_trunc('hour', event_time)) AS open_from
  FROM clean, turns WHERE epoch_us(event_time) <= bound GROUP BY k),
settled AS (
  SELECT b.*, k, count(*) OVER own AS n, sum(total_volume) OVER own AS s
  FROM bars b JOIN reached ON window_end <= open_from
  WINDOW own AS (PARTITION BY k, symbol)),
based AS (
  SELECT *, CASE WHEN n > 1 THEN (s - total_volume) / (n - 1) ELSE total_volume END AS baseline FROM settled),
loo AS (
  SELECT *, CASE WHEN baseline > 0 THEN total_volume / baseline ELSE 1.0 END AS volume_ratio,
         CASE WHEN open_price > 0 THEN (close_price - open_price) / open_price END AS price_change
  FROM based)"""
    + sample.phase_sql("loo")
    + sample.PUMP_DUMP.replace("PARTITION BY symbol", "PARTITION BY k, symbol").replace("AS detected_at", "AS detected_at, k")
    + """,
first_verdicts AS (
  SELECT * EXCLUDE (k) FROM pump_dump
  QUALIFY row_number() OVER (PARTITION BY window_start, symbol, phase ORDER BY k) = 1)"""
)
# A quiet day after each day; two symbols stop 40 hours before the others.
_QUIET = """
stretched AS (
  SELECT * REPLACE (ts + to_days(CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER))
                    - CASE WHEN event_type IN ('click', 'view') THEN INTERVAL 40 HOUR ELSE INTERVAL 0 HOUR END AS ts)
  FROM events),
"""
_EXPIRY = """,
state AS (
  SELECT symbol, count(*) AS bars, sum(total_volume) AS volume, max(window_start) AS newest FROM rated GROUP BY symbol),
marks AS (
  SELECT symbol, arg_max(phase, window_start) AS phase, max(window_start) AS pump_start,
         arg_max(price_change, window_start) AS pump_change
  FROM classified WHERE phase IS NOT NULL GROUP BY symbol),
still_open AS (
  SELECT * FROM marks
  WHERE phase = 'PUMP' AND pump_start + INTERVAL 10 HOURS > (SELECT max(window_end) FROM rated))"""
_COUNTED = (
    sample.TRADES + ingestion._SPOILED + _TURNS
    + """,
brought AS (
  SELECT v.*, CASE (SELECT min(k) FROM turns WHERE epoch_us(ts) <= bound)
                WHEN 1 THEN 0 WHEN 3 THEN 1 WHEN 4 THEN 2 ELSE 3 END AS batch_id
  FROM validated v),
newest AS (
  SELECT batch_id, max(epoch_us(event_time)) // 1000 AS ms FROM brought WHERE rejection_reason IS NULL GROUP BY batch_id),
judged AS (
  SELECT b.*, rejection_reason IS NULL AND coalesce(epoch_us(event_time) <= 1000 * (
           SELECT max(ms) - 3600000 FROM newest n WHERE n.batch_id <= b.batch_id - 2), false) AS late
  FROM brought b)"""
)


def _select_of(name: str, module) -> str:
    """The final SELECT of another oracle."""
    return module.ORACLES[name].rsplit("\n", 1)[-1]


ORACLES = {
    "src_trade_stream": ingestion.ORACLES["json_decode_trades"],
    "src_alert_stream": with_ctes(
        sample.WASH_PATH + sample.BARS + sample.LOO + sample.phase_sql("loo") + sample.PUMP_DUMP,
        f"SELECT '{WASH_ALERTS_TOPIC}' AS topic, symbol, "
        "strftime(window_start, '%Y-%m-%dT%H:%M:%S.%f') AS window_start FROM wash UNION ALL "
        f"SELECT '{PD_ALERTS_TOPIC}', symbol, "
        "strftime(window_start, '%Y-%m-%dT%H:%M:%S.%f') FROM pump_dump",
    ),
    "stream_wash_windows": with_ctes(_CLOSED_WINDOWS, _select_of("wash_windows", detection)),
    "stream_wash_complete": detection.ORACLES["wash_windows"],
    "stream_wash_alerts": with_ctes(
        _CLOSED_WINDOWS + _RUNNING + sample.WASH, sample.WASH_SELECT
    ),
    "stream_wash_rescored": with_ctes(
        _BY_TRIGGER + sample.WASH, sample.WASH_SELECT
    ),
    "stream_sweep": with_ctes(
        _CLOSED_WINDOWS + _RUNNING + detection._WASH_SWEEP, "SELECT * FROM sweep"
    ),
    "stream_ohlcv_append": with_ctes(_CLOSED_BARS, _select_of("ohlcv_bars", detection)),
    "stream_pump_dump": with_ctes(
        _CLOSED_BARS + sample.TRAILING + sample.phase_sql("rated") + sample.PUMP_DUMP,
        "SELECT * FROM pump_dump",
    ),
    "stream_pd_sweep": with_ctes(
        _CLOSED_BARS + sample.TRAILING + sample.FULL_SWEEP, "SELECT * FROM sweep"
    ),
    "stream_resumed": with_ctes(
        _CLOSED_BARS + sample.TRAILING + sample.phase_sql("rated") + sample.PUMP_DUMP,
        "SELECT * FROM pump_dump",
    ),
    "stream_pump_expiry": with_ctes(
        _QUIET + _CLOSED_BARS.strip().replace("FROM events", "FROM stretched")
        + sample.TRAILING + sample.phase_sql("rated") + _EXPIRY,
        "SELECT symbol, bars, volume, newest, pump_start, round(pump_change, 6) AS pump_change "
        "FROM state LEFT JOIN still_open USING (symbol)",
    ),
    "stream_counters": with_ctes(
        _COUNTED,
        "SELECT batch_id::BIGINT AS batch_id, count(*) AS rows, "
        "count_if(rejection_reason IS NULL AND NOT late)::BIGINT AS valid, "
        "count_if(late)::BIGINT AS late_rows, count(rejection_reason) AS rejected FROM judged GROUP BY batch_id",
    ),
    "stream_dedup": ingestion.ORACLES["json_decode_trades"],
    "stream_validate": ingestion.ORACLES["validate_trades"],
    "stream_ingest": ingestion.ORACLES["ingest_trades"],
    "stream_pump_dump_rescored": with_ctes(
        _SETTLED_BARS + sample.TRAILING + sample.FULL_SWEEP, "SELECT * EXCLUDE (detected_at) FROM sweep"
    ),
    "stream_rescored_alerts": with_ctes(_BARS_BY_TRIGGER, "SELECT * FROM first_verdicts"),
    "report_from_tables": reporting.ORACLES["report_overview"],
    "stream_alert_persist": alerting.ORACLES["all_alerts"],
    "stream_pump_dump_join": with_ctes(
        sample.TRADES + sample.BARS + sample.TRAILING + sample.REPORT_SWEEP + sample.CANDIDATES,
        "SELECT symbol, pump_start, dump_start, pump_price_chg_pct, dump_price_chg_pct "
        "FROM candidates",
    ),
}
