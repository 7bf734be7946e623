"""Feeds of the streaming queries: slices of time in several files, a slice in each trigger."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tapewarden.catalog import streams
from tapewarden.sources.tables import EVENTS

START = datetime(2024, 1, 1)


def feed(spark, minutes):
    rows = [(i, None if m is None else START + timedelta(minutes=m), i, "view", 1.0, '{"k": 20}') for i, m in enumerate(minutes)]
    return spark.createDataFrame(rows, EVENTS)


def triggers(spark, path, files, root):
    """Event ids that each trigger of the feed brings."""
    seen = []

    def keep(batch, _):
        seen.append(sorted(r.event_id for r in batch.select("event_id").collect()))

    streams._drain(streams.start(streams._feed(spark, EVENTS, path, files), keep, f"{root}/checkpoint", trigger=None))
    return seen


@pytest.mark.parametrize("turns", [None, (1, 3, 4, 2)])
def test_slices_are_written_in_parallel_and_read_one_by_one(spark, tmp_path, monkeypatch, turns):
    monkeypatch.setattr(streams, "SLICE_ROWS", 10)
    minutes = list(range(400))
    path = f"{tmp_path}/events"
    files = streams._sliced(feed(spark, minutes), "ts", path, turns)
    assert files == min(10, spark.sparkContext.defaultParallelism) > 1
    rows = spark.read.parquet(path).groupBy(F.input_file_name()).count()
    # No file holds a whole slice.
    assert rows.count() == 4 * files
    assert rows.agg(F.max("count")).first()[0] < 100
    slices = [list(range(100 * k, 100 * k + 100)) for k in range(4)]
    assert triggers(spark, path, files, tmp_path) == [slices[k - 1] for k in turns or (1, 2, 3, 4)]


def test_sparse_slices_have_their_own_triggers(spark, tmp_path, monkeypatch):
    """A slice with fewer rows than files, and one without rows, take nothing of the next one."""
    monkeypatch.setattr(streams, "SLICE_ROWS", 10)
    minutes = [*range(200), 900, 910, 920, *range(1501, 1600), 2000]
    path = f"{tmp_path}/events"
    files = streams._sliced(feed(spark, minutes), "ts", path)
    assert files > 1
    assert triggers(spark, path, files, tmp_path) == [list(range(200)), [200, 201, 202], [], list(range(203, 303))]


@pytest.mark.parametrize("turns", [None, (1, 3, 4, 2)])
@pytest.mark.parametrize("minutes", [[0, 10, None, 20, 30, 40], [None, None]])
def test_rows_without_a_time_come_once_with_the_last_slice(spark, tmp_path, minutes, turns):
    path = f"{tmp_path}/events"
    files = streams._sliced(feed(spark, minutes), "ts", path, turns)
    got = triggers(spark, path, files, tmp_path)
    assert len(got) == 4
    assert sorted(i for ids in got for i in ids) == list(range(len(minutes)))
    assert {i for i, m in enumerate(minutes) if m is None} <= set(got[-1])
