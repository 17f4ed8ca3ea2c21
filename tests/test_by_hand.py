"""Targets, training set, report and probe against plain loops over a small market.

The market has gaps, bars without volume, an infinite price and targets just before midnight, which
the test tables lack.
"""

import math
import random
from datetime import timedelta
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import DAY
from tidemark import Grid
from tidemark import schemas as S
from tidemark.operators.targets import targets
from tidemark.plans import training as P

GRID = Grid()
NAMES = [f"price_increase_{k}" for k in (1, 2, 3, 7)]
LOOKBACK, BEFORE, AFTER = 30, 24, 9
STOP, PROFIT = 0.985, 1.011


def market(seed):
    """Minute -> (usd, coins, high, low) per symbol, from 150 minutes before DAY to two days later."""
    chance = random.Random(seed)
    symbols = {}
    for symbol in ("A", "B", "C"):
        bars, price = {}, 100.0
        for minute in range(-150, 2 * 1440 + 60):
            price *= math.exp(chance.gauss(0, 0.004))
            coins = float(chance.randint(1, 2000))
            kind = chance.random()
            if kind < 0.01:
                continue
            usd = round(price * coins, 2)
            if kind < 0.015:
                usd = coins = 0.0
            elif kind < 0.017:
                coins = 0.0
            elif kind < 0.019:
                usd = 0.0
            low = 0.0 if kind < 0.02 else price * (1 - abs(chance.gauss(0, 0.003)))
            bars[minute] = (usd, coins, price * (1 + abs(chance.gauss(0, 0.003))), low)
        symbols[symbol] = bars
    return symbols


def ieee(a, b):
    with np.errstate(all="ignore"):
        return float(np.float64(a) / np.float64(b))


def average(bar):
    usd, coins = bar[:2]
    return usd / coins if usd * coins != 0 else 0.0


def day_of(minute):
    return minute // 1440


def growth(bars, minutes, i, k):
    if i < LOOKBACK or minutes[i - LOOKBACK] != minutes[i] - LOOKBACK:
        return None
    now, then = (ieee(*bars[minutes[j]][:2]) for j in (i, i - k))
    scaled = ieee(now, then) * 1000
    return math.floor(scaled) / 1000 if math.isfinite(scaled) else None


def hand_targets(symbols):
    found = {}
    for symbol, bars in symbols.items():
        minutes = sorted(bars)
        for i, minute in enumerate(minutes):
            for k in (1, 2, 3, 7):
                value = growth(bars, minutes, i, k)
                if value is not None and value >= 1.01:
                    key = (f"price_increase_{k}", symbol, minute // 10)
                    found.setdefault(key, (minute, float(np.float32(value))))
    return sorted((name, symbol, m, v) for (name, symbol, _), (m, v) in found.items())


def seen(bars, minute):
    """Bars that a target at this minute may use: its own day and the one before."""
    day = day_of(minute)
    return {m: b for m, b in bars.items() if day - 1 <= day_of(m) <= day}


def step(price, neighbour):
    return math.floor((price * 100 / neighbour - 100) * 1000) if neighbour else 0


def hundredths(total):
    return float(Decimal(total).scaleb(-1).to_integral_value("ROUND_HALF_EVEN")) / 100 + 0.0


def sums(steps):
    return (
        hundredths(sum(s for s in steps if s > 0)),
        hundredths(sum(s for s in steps if s < 0)),
        hundredths(sum(steps)),
    )


def gain(walk, entry, close):
    """``walk`` holds (low, average, high) in walking order, None for a bar that is missing."""
    for i, bar in enumerate(walk):
        if bar is None or bar[0] == 0 or bar[1] == 0:
            continue
        low, avg, high = bar
        if low <= entry * STOP:
            return -50.0
        if (high + avg) / 2 >= entry * PROFIT:
            return 1.0
        if i == len(walk) - 1:
            return float(np.rint(((bar[close] * 0.999 * 100) / entry - 100) * 1000)) / 1000 + 0.0
    return 0.0


def hand_training(symbols, found):
    rows = []
    for name, symbol, minute, value in found:
        bars = seen(symbols[symbol], minute)
        entry = average(bars[minute + 1]) * 1.001 if minute + 1 in bars else 0.0
        case = [m for m in range(minute - BEFORE, minute + AFTER + 1) if m in bars]
        case = [m for m in case if bars[m][0] != 0 and bars[m][1] != 0]
        if entry == 0:
            continue
        prices = [average(bars[m]) for m in case]
        steps = [step(p, n) for p, n in zip(prices, prices[1:] + [0.0])]
        lead_up = [i for i, m in enumerate(case) if m <= minute]
        later = [m for m in case if m > minute + 1]
        walk = [(bars[m][3], average(bars[m]), bars[m][2]) for m in later]
        gains = [average(bars[m]) * 0.999 * 100 / entry - 100 for m in later]
        usd = sum(Decimal(str(bars[case[i]][0])) for i in lead_up)
        volume = math.floor(float(usd) / len(lead_up)) if lead_up else -1
        if volume >= 50000:
            rows.append(
                (name, symbol, minute, value, entry, gain(walk, entry, 1))
                + (float(math.floor(max(gains))) if gains else 0.0,)
                + sums([steps[i] for i in lead_up])
                + (float(volume),)
            )
    return sorted(rows)


def hand_gains(symbols, found):
    rows = []
    for name, symbol, minute, _ in found:
        bars = seen(symbols[symbol], minute)
        entry = average(bars[minute + 1]) * 1.001 if minute + 1 in bars else 0.0
        later = [bars.get(m) for m in range(minute + AFTER, minute + 1, -1)]
        walk = [b and (b[3], average(b), b[2]) for b in later]
        rows.append((name, symbol, minute, gain(walk, entry, 0)))
    return sorted(rows)


def hand_probe(symbols, found):
    rows = []
    for name, symbol, minute, _ in found:
        if name == "price_increase_1":
            bars = seen(symbols[symbol], minute)
            prices = [average(bars[m]) if m in bars else 0.0 for m in range(minute - 6, minute + 1)]
            steps = [0] + [step(now, then) for then, now in zip(prices, prices[1:])]
            rows.append((symbol, minute, *sums(steps)))
    return sorted(rows)


@pytest.fixture(scope="module", params=[1, 2])
def studied(request, spark):
    symbols = market(request.param)
    records = [
        (symbol, at, at.date(), 1.0, high, low, 1.0, usd, coins, 0.0, 0.0, 1)
        for symbol, bars in symbols.items()
        for m, (usd, coins, high, low) in bars.items()
        for at in [DAY + timedelta(minutes=m)]
    ]
    bars = spark.createDataFrame(records, S.BARS).repartition(4)
    found = hand_targets(symbols)
    stored = spark.createDataFrame(
        [
            (name, symbol, at.date(), at, value)
            for name, symbol, m, value in found
            for at in [DAY + timedelta(minutes=m)]
        ],
        S.TARGETS,
    )
    return symbols, bars, found, stored


def minute(at):
    return (at - DAY) // timedelta(minutes=1)


def test_targets(studied):
    _, bars, found, _ = studied
    built = targets(bars, GRID, horizons=(1, 2, 3, 7), lookback=LOOKBACK).collect()
    rows = [(r["target_name"], r["symbol"], minute(r["time_open"]), r["value"]) for r in built]
    assert sorted(rows) == found and len(found) > 500


def test_training_set(studied):
    symbols, bars, found, stored = studied
    built = P.training_set(
        stored, bars, GRID, names=NAMES, before=BEFORE, after=AFTER, stop_ratio=STOP, profit_ratio=PROFIT
    ).collect()
    columns = ["target_value", S.ENTRY, S.GAIN, S.BEST, S.RISES, S.FALLS, S.MOVES, S.AVG_VOLUME]
    rows = [
        (r["target_name"], r["target_symbol"], minute(r["target_timestamp"]), *[r[c] for c in columns])
        for r in built
    ]
    expected = hand_training(symbols, found)
    assert sorted(rows) == expected
    assert {-50.0, 0.0, 1.0} < {r[5] for r in expected} and len(expected) < len(found)


def test_gains(studied):
    symbols, bars, found, stored = studied
    settings = dict(after=AFTER, stop_ratio=STOP, profit_ratio=PROFIT)
    built = P.case_gains(stored, bars, GRID, **settings).collect()
    rows = [
        (r["target_name"], r["symbol"], minute(r["target_timestamp"]), r[S.GAIN]) for r in built
    ]
    expected = hand_gains(symbols, found)
    assert sorted(rows) == expected
    report = P.backtest_report(stored, bars, GRID, **settings).collect()
    for line in report:
        gains = [g for name, _, _, g in expected if name == line["target_name"]]
        assert line["ttl_ins"] == len(gains)
        assert line["ttl_gain_pct"] == pytest.approx(sum(gains))
        assert line["win_pct"] == sum(g > 0 for g in gains) / len(gains)


def test_probe(studied):
    symbols, bars, found, stored = studied
    listed = stored.select("symbol", "time_open").distinct()
    built = P.feature_probe(stored, bars, GRID, listed).collect()
    rows = [
        (r["symbol"], minute(r["target_timestamp"]), r[S.RISES], r[S.FALLS], r[S.MOVES])
        for r in built
    ]
    assert sorted(rows) == hand_probe(symbols, found)


def test_market_has_what_the_test_tables_lack(studied):
    _, bars, found, stored = studied
    zero = F.col(S.USD) * F.col(S.COINS) == 0
    assert bars.where(zero).count() > 10
    last = F.date_format("time_open", "HH:mm") == "23:59"
    late = F.date_format("time_open", "HH:mm") > "23:50"
    assert stored.where(late).count() > 0 and bars.where(last).count() > 0
