"""Block-wise matching against plain state machines on random bar sequences."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from tapewarden import DetectionConfig
from tapewarden.operators.sequences import candidate_pairs, consuming_matches, earliest_pairs

START = datetime(2026, 1, 1, 22)
PAIR = timedelta(minutes=5)
SEQUENCES = 1500


def random_sequences(seed: int):
    """Per symbol: sorted bars around a day border, some minutes missing."""
    rng = random.Random(seed)
    for n in range(SEQUENCES):
        at = START + timedelta(minutes=rng.randint(0, 200))
        bars = []
        for _ in range(rng.randint(1, 30)):
            at += timedelta(minutes=rng.choice((1, 1, 1, 2, 3, 5, 6, 9)))
            bars.append((at, rng.choice(("PUMP", "DUMP", None))))
        yield f"s{n}", bars


def machine(bars):
    """Remember the last PUMP; a DUMP in range reports it and forgets it."""
    pump, found = None, []
    for at, phase in bars:
        if phase == "PUMP":
            pump = at
        elif phase == "DUMP" and pump is not None and timedelta(0) < at - pump <= PAIR:
            found.append((pump, at))
            pump = None
    return found


def all_pairs(bars):
    return [
        (p, d)
        for p, is_p in bars if is_p == "PUMP"
        for d, is_d in bars if is_d == "DUMP" and timedelta(0) < d - p <= PAIR
    ]


def test_consuming_matches_equal_the_state_machine(spark):
    sequences = list(random_sequences(1))
    frame = spark.createDataFrame(
        [(s, at, p, 0.0, 1.0) for s, bars in sequences for at, p in bars],
        "symbol string, window_start timestamp, phase string, price_change double, "
        "volume_ratio double",
    )
    got = {
        (r.symbol, r.window_start, r.window_end)
        for r in consuming_matches(frame, DetectionConfig()).collect()
    }
    want = {(s, p, d) for s, bars in sequences for p, d in machine(bars)}
    assert got == want
    assert len(want) > SEQUENCES


def test_pair_operators_equal_brute_force(spark):
    sequences = list(random_sequences(2))
    frame = spark.createDataFrame(
        [
            (s, at, at + timedelta(minutes=1), p, 0.0, 1.0, at)
            for s, bars in sequences
            for at, p in bars
        ],
        "symbol string, window_start timestamp, window_end timestamp, phase string, "
        "price_change_pct double, volume_ratio double, detected_at timestamp",
    )
    want = [(s, p, d) for s, bars in sequences for p, d in all_pairs(bars)]
    got = candidate_pairs(frame, "5 minutes").select("symbol", "pump_start", "dump_start").collect()
    assert sorted(map(tuple, got)) == sorted(want)

    first: dict = {}
    for s, p, d in want:
        first[s, p] = min(first.get((s, p), d), d)
    nearest = earliest_pairs(frame, "5 minutes").collect()
    assert {(r.symbol, r.pump_start): r.dump_start for r in nearest} == first
    assert len(nearest) == len(first)
