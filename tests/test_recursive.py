import random

import pytest
from pyspark.sql import functions as F

from barwright.operators import recursive_ema, wilder_rsi
from barwright.plans.blocks import measure_blocks

KEYS = {"by": ("symbol",), "order": ("id",)}


def series(spark, values):
    rows = [(s, i, None if v is None else float(v)) for s, own in values.items() for i, v in enumerate(own)]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, "symbol string, id long, close double")


def ema_by_hand(values, n):
    out, seen, last = [], [], None
    for v in values:
        if v is None or v != v:
            out.append(None)
            continue
        seen.append(v)
        if len(seen) == n:
            last = sum(seen) / n
        elif len(seen) > n:
            last = v * 2 / (n + 1) + last * (1 - 2 / (n + 1))
        out.append(last if len(seen) >= n else None)
    return out


def rsi_by_hand(values, n):
    out, before, moves, gain, loss = [], None, [], 0.0, 0.0
    for v in values:
        if v is None:
            out.append(None)
            continue
        if before is not None:
            moves.append((max(v - before, 0), max(before - v, 0)))
            if len(moves) == n:
                gain, loss = (sum(m[k] for m in moves) / n for k in (0, 1))
            elif len(moves) > n:
                gain, loss = ((a * (n - 1) + b) / n for a, b in zip((gain, loss), moves[-1]))
        before = v
        out.append(None if len(moves) < n else 100.0 if loss == 0 else 100 - 100 / (1 + gain / loss))
    return out


def test_first_values(spark):
    rows = recursive_ema(series(spark, {"A": [2, 4, 6, 12, 0, 6]}), periods=(3,), **KEYS).orderBy("id").collect()
    assert [r["EMA_recursive_3_close"] for r in rows] == [None, None, 4.0, 8.0, 4.0, 5.0]


@pytest.mark.parametrize("target", [None, 100])
def test_recursive_averages_by_hand(spark, target):
    rng = random.Random(8)
    values = {"HOT": [None if rng.random() < 0.1 else rng.uniform(-5, 100) for _ in range(2500)], "SHORT": [1.0, 2.0],
              "GAP": [3.0] + [None] * 400 + [5.0, float("nan"), 7.0, 9.0], "NONE": [None] * 5, "FLAT": [4.0] * 30,
              "HUGE": [1e12] * 5 + [1.0] * 900}
    df = series(spark, values)
    blocks = measure_blocks(df, **KEYS, target_rows=target) if target else None
    rows = recursive_ema(df, periods=(1, 2, 10), blocks=blocks, chunk_rows=target or 1, **KEYS).collect()
    assert len(rows) == sum(map(len, values.values()))
    for n in (1, 2, 10):
        want = {s: ema_by_hand(own, n) for s, own in values.items()}
        for r in rows:
            got, hand = r[f"EMA_recursive_{n}_close"], want[r["symbol"]][r["id"]]
            assert got == hand if hand is None else got == pytest.approx(hand, rel=1e-11)
    values = {k: v for k, v in values.items() if k not in ("GAP", "HUGE")}
    rated = wilder_rsi(series(spark, values), periods=(2, 5), blocks=blocks, chunk_rows=target or 1, **KEYS).collect()
    for n in (2, 5):
        want = {s: rsi_by_hand(own, n) for s, own in values.items()}
        for r in rated:
            got, hand = r[f"RSI_wilder_{n}_close"], want[r["symbol"]][r["id"]]
            assert got == hand if hand is None else got == pytest.approx(hand, rel=1e-9), (r, hand)


def test_one_shuffle_without_cuts(spark):
    df = series(spark, {"A": [1.0, 2.0]}).where(F.col("close") > 0)
    plan = recursive_ema(df, **KEYS)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Union")[0].count("Exchange") + plan.count("Exchange hashpartitioning") == 1
