import statistics

import pytest
from pyspark.sql import functions as F
from test_indicators import series, wavy

from barwright import operators as ops
from barwright.plans.blocks import measure_blocks


@pytest.fixture(scope="module")
def bars(spark):
    hot = series(spark, wavy(420, 11), "HOT")
    return hot.unionByName(series(spark, wavy(90), "COLD")).select(
        "*", (F.col("close") + 5).alias("high"), (F.col("close") - 5).alias("low"),
        F.lit(2.0).alias("volume")).cache()


@pytest.fixture(scope="module")
def blocks(bars):
    return measure_blocks(bars, ("symbol",), ("datetime",), target_rows=200)


OPTIONS = {"by": ("symbol",), "order": ("datetime",)}


def ordered(df, key="datetime"):
    return [tuple(r) for r in df.orderBy("symbol", key).collect()]


def turn(before, now):
    if before is None or now is None:
        return 0
    return 1 if before <= 0 < now else -1 if before >= 0 > now else 0


def test_trend_flags(bars, blocks):
    flagged = ops.trend_flags(bars, fast=10, slow=50, **OPTIONS)
    rows = flagged.orderBy("symbol", "datetime").collect()
    before = None
    turns = 0
    for r in rows:
        gap = r["SMA_10_close"] - r["SMA_50_close"]
        same = before is not None and before[0] == r["symbol"]
        assert r["SMA_cross"] == turn(before[1] if same else None, gap)
        assert r["MACD_cross"] == turn(before[2] if same else None, r["MACD_line_close"])
        above = None if r["close"] is None else r["close"] > r["SMA_50_close"]
        assert r["above_SMA_50"] == above
        turns += abs(r["SMA_cross"]) + abs(r["MACD_cross"])
        before = (r["symbol"], gap, r["MACD_line_close"])
    assert turns > 10
    cut = ops.trend_flags(bars, fast=10, slow=50, blocks=blocks, **OPTIONS)
    assert blocks.cuts and ordered(cut) == ordered(flagged)


def test_market_report(bars, blocks):
    report = ops.market_report(bars, **OPTIONS)
    groups, last = {}, {}
    for r in bars.orderBy("symbol", "datetime").collect():
        before, close = last.get(r["symbol"]), r["close"]
        change = None if before is None or close is None else close / before - 1
        key = (r["symbol"], r["datetime"].replace(day=1))
        groups.setdefault(key, []).append((close, change))
        last[r["symbol"]] = close
    got = {(r["symbol"], r["period"]): r for r in report.collect()}
    assert got.keys() == groups.keys()
    for key, rows in groups.items():
        closes = [c for c, _ in rows if c is not None]
        changes = [c for _, c in rows if c is not None]
        r = got[key]
        assert (r["n_bars"], r["high"], r["low"]) == (len(rows), max(closes) + 5, min(closes) - 5)
        assert r["volatility"] == pytest.approx(statistics.stdev(changes), rel=1e-9)
        first, final = rows[0][0], rows[-1][0]
        if first is not None and final is not None:
            assert r["period_return"] == pytest.approx(final / first - 1, rel=1e-12)
        assert r["mean_volume"] == 2
    cut = ops.market_report(bars, blocks=blocks, **OPTIONS).drop("volatility")
    assert ordered(cut, "period") == ordered(report.drop("volatility"), "period")


def test_properties(bars):
    numbered = ops.gold(bars, by=("symbol",)).orderBy("symbol", "datetime").collect()
    hot = [r for r in numbered if r["symbol"] == "HOT"]
    for r in numbered:
        assert 0 <= r["RSI_14_close"] <= 100 and 0 <= r["RSI_21_close"] <= 100
    for n in (10, 50, 100, 200):
        assert hot[n - 1][f"EMA_{n}_close"] == hot[n - 1][f"SMA_{n}_close"]
        assert hot[n - 2][f"EMA_{n}_close"] is None
    filled = ops.fill_gaps(bars).join(bars.select("symbol", "datetime", F.col("close").alias("was")),
                                      ["symbol", "datetime"])
    assert filled.where("was is not null and close <> was").count() == 0
    assert filled.where("close is null").count() == 0


def test_alerts(spark):
    df = spark.createDataFrame([("A", 1, 10.0), ("A", 2, 15.0), ("A", 3, 14.0), ("A", 4, 0.0),
                                ("A", 5, 9.0), ("B", 6, 1.0)], "symbol string, ts long, price double")
    got = ops.price_alerts(df, 0.5).orderBy("ts").collect()
    assert [(r["ts"], r["previous"], r["change"]) for r in got] == [(2, 10.0, 0.5), (4, 14.0, -1.0)]
