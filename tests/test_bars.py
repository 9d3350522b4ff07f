import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barwright import operators as ops
from barwright.functions import INTERVALS, canonical_symbol, file_safe, symbol_list
from barwright.plans.blocks import newest_spans


def ticks(spark, kind="timestamp_ntz"):
    return spark.range(4000).select(
        F.expr("if(id % 3 = 0, 'A', 'B')").alias("symbol"), "id",
        (F.expr("timestamp_ntz'2023-12-28 10:00:00'") +
         F.make_dt_interval(mins=F.pmod(F.hash("id"), F.lit(60 * 24 * 50)))).cast(kind).alias("ts"),
        F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("price")).cache()


def start_of(ts, code):
    width = INTERVALS[code]
    day = ts.replace(hour=0, minute=0, second=0, microsecond=0)
    if width == "month":
        return day.replace(day=1)
    if width == "week":
        return day - dt.timedelta(days=day.weekday())
    number, unit = width.split()
    minutes = int(number) * {"minute": 1, "hour": 60, "day": 1440}[unit.rstrip("s")]
    return day + dt.timedelta(minutes=(ts - day).seconds // 60 // minutes * minutes)


def expected(rows, code):
    groups = {}
    for r in sorted(rows, key=lambda r: (r["ts"], r["id"])):
        groups.setdefault((r["symbol"], start_of(r["ts"], code)), []).append(r["price"])
    return {k: (p[0], max(p), min(p), p[-1], float(len(p))) for k, p in groups.items()}


@pytest.mark.parametrize("code", sorted(INTERVALS))
def test_every_width(spark, code):
    df = ticks(spark)
    out = ops.bars(df, code, order=("ts", "id"))
    got = {(r["symbol"], r["datetime"]): (r["open"], r["high"], r["low"], r["close"], r["volume"])
           for r in out.collect()}
    assert got == expected(df.collect(), code)
    assert out.schema["datetime"].dataType == df.schema["ts"].dataType


def test_ticks_are_hashed_not_sorted(spark):
    for kind in ("timestamp", "timestamp_ntz"):
        plan = ops.bars(ticks(spark, kind), "1H", order=("ts", "id")) \
            ._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_ties_and_negative_tie_breaks(spark):
    df = spark.createDataFrame([(0, -9 * 10**18, 1.0), (0, 9 * 10**18, 2.0), (0, 0, 3.0),
                                (1, -9 * 10**18, 4.0)], "s long, id long, price double").select(
        F.lit("A").alias("symbol"), F.timestamp_seconds("s").alias("ts"), "id", "price")
    row = ops.bars(df, "1", order=("ts", "id")).first()
    assert (row["open"], row["close"]) == (1.0, 4.0)


def test_traded_volume_and_missing_times(spark):
    df = spark.createDataFrame([(5, 1.0, 10), (6, 2.0, 20), (None, 9.0, 99)],
                               "s long, price double, size long").select(
        F.lit("A").alias("symbol"), F.timestamp_seconds("s").alias("ts"), "price", "size")
    row = ops.bars(df, "1D", volume="size").first()
    assert (row["high"], row["volume"]) == (2.0, 30.0)


def test_wider_bars_from_narrow_ones(spark):
    df = ticks(spark)
    narrow = ops.bars(df, "1H", order=("ts", "id"))
    for code in ("4H", "1D", "1W"):
        wide = ops.bars(df, code, order=("ts", "id"))
        again = ops.rebar(narrow, code).select(wide.columns)
        assert sorted(map(str, again.collect())) == sorted(map(str, wide.collect()))


def test_unknown_width(spark):
    with pytest.raises(ValueError):
        ops.bars(ticks(spark), "7")


def test_latest_bars(spark):
    bars = ops.bars(ticks(spark), "1H", order=("ts", "id"))
    got = ops.last_n_bars(bars, 7, salts=3).collect()
    everything = sorted(bars.collect(), key=lambda r: r["datetime"])
    want = [r for s in "AB" for r in [r for r in everything if r["symbol"] == s][-7:]]
    assert sorted(map(str, got)) == sorted(map(str, want))
    order = ("datetime", "symbol")
    ordered = sorted(everything, key=lambda r: (r["datetime"], r["symbol"]))
    assert ops.head_bars(bars, order=order).collect() == ordered[:5]
    assert ops.tail_bars(bars, order=order).collect() == ordered[:-6:-1]


@pytest.mark.parametrize("n", [7, 1460, 100_000])
def test_latest_of_a_long_series(spark, n):
    """One symbol holds most ticks, over many days and with one crowded second; few rows are shuffled."""
    at = (F.when(F.col("id") < 20_000, F.col("id") * 600).when(F.col("id") < 26_000, F.lit(13_000_000))
          .otherwise(13_000_000 + F.col("id") % 7 * 90_000))
    df = (spark.range(27_000).withColumn("ts", F.when(F.col("id") % 911 > 0, F.timestamp_seconds(at)))
          .withColumn("symbol", F.when(F.col("id") % 50 > 1, "HOT").when(F.col("id") % 50 == 1, "B")))
    latest = Window.partitionBy("symbol").orderBy(F.desc("ts"), F.desc("id"))
    want = df.withColumn("r", F.row_number().over(latest)).where(F.col("r") <= n).drop("r")
    got = ops.last_n_bars(df, n, order=("ts", "id"), salts=3)
    assert got.count() == want.count()
    assert got.exceptAll(want).isEmpty()
    for slack in (0, 2000):
        kept = newest_spans(df, ("symbol",), ("ts", "id"), n, slack)
        assert want.exceptAll(kept).isEmpty()
        assert kept.groupBy("symbol").count().agg(F.max("count")).first()[0] <= n + slack + 256


def test_latest_without_spans(spark):
    df = spark.createDataFrame([("A", str(i)) for i in range(10, 40)], "symbol string, at string")
    got = ops.last_n_bars(df, 3, order=("at",)).collect()
    assert sorted(r["at"] for r in got) == ["37", "38", "39"]
    assert ops.last_n_bars(df.where("false"), 3, order=("at",)).count() == 0
    empty = spark.createDataFrame([], "symbol string, ts timestamp, id long")
    assert ops.last_n_bars(empty, 3, order=("ts", "id")).count() == 0


def test_symbols(spark):
    df = spark.createDataFrame(
        [("NSE", "NIFTY", "1"), ("NSE", "NIFTY", None), ("X", "A:B", None), ("X", "A:B", "z")],
        "exchange string, symbol string, contract string")
    got = [r[0] for r in df.select(canonical_symbol("symbol", "exchange", "contract")).collect()]
    assert got == ["NSE:NIFTY1!", "NSE:NIFTY", "A:B", "A:B"]
    assert df.select(canonical_symbol("symbol", "exchange")).first()[0] == "NSE:NIFTY"
    one = spark.range(1)
    assert one.select(file_safe(F.lit("A:B"))).first()[0] == "AB"
    assert one.select(symbol_list(F.lit("A:B, A:C"))).first()[0] == ["A:B", "A:C"]
    bad = spark.createDataFrame([("N", "S", "1.5")], "exchange string, symbol string, contract string")
    with pytest.raises(Exception, match="not a valid contract"):
        bad.select(canonical_symbol("symbol", "exchange", "contract")).collect()
