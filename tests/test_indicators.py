import math

import pytest
from pyspark.sql import functions as F

from barwright.operators import indicators as I
from barwright.plans.blocks import measure_blocks


def series(spark, closes, symbol="A", start="2024-01-01"):
    rows = [(symbol, i, None if c is None else float(c)) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, i int, close double").select(
        "symbol", F.expr(f"timestamp_ntz'{start}' + make_interval(0,0,0,i)").alias("datetime"),
        "close")


def values(df, column, key="datetime"):
    return [r[column] for r in df.orderBy("symbol", key).collect()]


def approx(expected):
    return [None if e is None else pytest.approx(e, rel=1e-12) for e in expected]


def reference(closes):
    """Row-by-row brute force of all 15 indicators for one series."""
    def mean(xs):
        xs = [x for x in xs if x is not None]
        return sum(xs) / len(xs) if xs else None

    def window(xs, t, n):
        return mean(xs[max(0, t - n + 1): t + 1])

    def shape(xs, n, gate, alpha):
        out = []
        for t in range(len(xs)):
            r = t + 1
            if r < gate:
                out.append(None)
                continue
            before = window(xs, t - 1, n) if r > gate else None
            if before is None:
                out.append(window(xs, t, n))
            else:
                out.append(None if xs[t] is None else xs[t] * alpha + before * (1 - alpha))
        return out

    out = {}
    for n in I.SMA_PERIODS:
        out[f"SMA_{n}_close"] = [window(closes, t, n) for t in range(len(closes))]
    for n in (*I.EMA_PERIODS, 12, 26):
        out[f"EMA_{n}_close"] = shape(closes, n, n, 2.0 / (n + 1))
    for n in I.RSI_PERIODS:
        gains, losses, rsi = [], [], []
        for t, c in enumerate(closes):
            p = closes[t - 1] if t else None
            d = 0.0 if c is None or p is None else c - p
            gains.append(max(d, 0.0))
            losses.append(max(-d, 0.0))
            g, l = window(gains, t, n), window(losses, t, n)
            rsi.append(100.0 if l == 0 else 100 - 100 / (1 + g / l))
        out[f"RSI_{n}_close"] = rsi
    line = [None if a is None or b is None else a - b
            for a, b in zip(out["EMA_12_close"], out["EMA_26_close"])]
    out["MACD_line_close"] = line
    out["MACD_signal_close"] = shape(line, 9, 35, 0.2)
    out["MACD_histogram_close"] = [None if a is None or b is None else a - b
                                   for a, b in zip(line, out["MACD_signal_close"])]
    return out


def test_three_row_means(spark):
    df = series(spark, [2, 4, 6, 12, 0, 6])
    out = I.add_indicators(df, sma=(3,), ema=(3,), rsi=(3,))
    assert values(out, "SMA_3_close") == approx([2, 3, 4, 22 / 3, 6, 6])
    assert values(out, "EMA_3_close") == approx([None, None, 4, 8, 11 / 3, 6])
    assert values(out, "RSI_3_close") == approx([100, 100, 100, 100, 40, 50])


def wavy(n, gap=None):
    return [None if gap and i % gap == gap - 1 else round(1000 + 300 * math.sin(i / 7) + i % 13)
            for i in range(n)]


@pytest.mark.parametrize("gap", [None, 7])
def test_gold_equals_brute_force(spark, gap):
    closes = wavy(460, gap)
    closes[100:130] = [None] * 30 if gap else closes[100:130]
    out = I.gold(series(spark, closes), by=("symbol",)).orderBy("datetime").collect()
    for name, expected in reference(closes).items():
        assert [r[name] for r in out] == approx(expected), name


def test_gold_column_order(spark):
    df = series(spark, [1, 2]).withColumn("year", F.year("datetime"))
    assert I.gold(df).columns[4:] == [
        "SMA_10_close", "SMA_50_close", "SMA_100_close", "SMA_200_close",
        "EMA_10_close", "EMA_50_close", "EMA_100_close", "EMA_200_close",
        "RSI_14_close", "RSI_21_close", "EMA_12_close", "EMA_26_close",
        "MACD_line_close", "MACD_signal_close", "MACD_histogram_close"]


def test_macd_gates(spark):
    out = I.macd(series(spark, wavy(40)))
    assert [v is None for v in values(out, "MACD_line_close")] == [True] * 25 + [False] * 15
    assert [v is None for v in values(out, "MACD_signal_close")] == [True] * 34 + [False] * 6
    assert [v is None for v in values(out, "MACD_histogram_close")] == [True] * 34 + [False] * 6


def test_years_restart(spark):
    df = series(spark, wavy(40), start="2023-12-20").withColumn("year", F.year("datetime"))
    first = F.col("datetime") == F.lit("2024-01-01").cast("timestamp_ntz")
    by_year = I.gold(df).where(first).first()
    assert by_year["SMA_10_close"] == by_year["close"] and by_year["RSI_14_close"] == 100
    through = I.gold(df, by=("symbol",)).where(first).first()
    assert through["SMA_10_close"] != through["close"] and through["RSI_14_close"] != 100


def test_null_close(spark):
    out = I.add_indicators(series(spark, [2, 4, None, None, 6, 8]), sma=(3,), ema=(3,), rsi=(3,))
    assert values(out, "SMA_3_close") == approx([2, 3, 3, 4, 6, 7])
    assert values(out, "EMA_3_close") == approx([None, None, 3, None, 5, 7])
    assert values(out, "RSI_3_close") == approx([100] * 6)


@pytest.mark.parametrize("target", [50])
def test_cut_series_equal_uncut(spark, target):
    # One symbol holds most rows; its days are unevenly filled; another stays whole.
    hot = series(spark, wavy(700, 7), "HOT").withColumn(
        "datetime", F.expr("datetime + make_dt_interval(0, pmod(hash(datetime), 20))"))
    rows = hot.unionByName(series(spark, wavy(40), "COLD"))
    order = ("datetime",)
    blocks = measure_blocks(rows, ("symbol",), order, target_rows=target)
    assert blocks.cuts and blocks.sizes[0] == 1
    keys = {"by": ("symbol",), "order": order}
    whole = I.gold(rows, **keys).orderBy("symbol", "datetime").collect()
    cut = I.gold(rows, blocks=blocks, **keys).orderBy("symbol", "datetime").collect()
    assert whole == cut


@pytest.mark.parametrize("periods,direct", [((10, 50, 100, 200), [10]), ((14, 21), [7]), ((3,), [3]),
                                            ((37,), [37])])
def test_ladder_sums_few_rows(periods, direct):
    ladder = I._ladder(periods)
    assert [n for n, base in ladder.items() if n == base] == direct
    assert all(n in ladder for n in periods)
