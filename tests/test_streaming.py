import datetime as dt

import pytest
from pyspark.sql import functions as F

from barwright.operators import bars, price_alerts
from barwright.sources import stream_files
from barwright.streaming import (
    compact_live_bars, ordered_alerts, read_live_bars, start_ingest, start_live_bars, start_price_alerts, stream_bars,
)


def tick_files(spark, path, parts=4, rows=2000):
    """Ticks in files, each later than the one before."""
    df = spark.range(rows).select(
        F.expr("if(id % 3 = 0, 'A', if(id % 7 = 0, null, 'B'))").alias("symbol"), "id",
        F.expr("timestamp'2024-01-01' + make_dt_interval(0, 0, 0, id * 97)").alias("ts"),
        (F.pmod(F.hash("id"), F.lit(100)) + 1).cast("double").alias("price"))
    for part in range(parts):
        df.where(F.col("id") % rows * parts / rows >= part) \
            .where(F.col("id") % rows * parts / rows < part + 1) \
            .coalesce(1).write.mode("append").parquet(path)
    return df


def test_alerts_across_batches_equal_the_batch_result(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = tick_files(spark, source)
    stream = stream_files(spark, source, df.schema, files_per_batch=1)
    start_price_alerts(stream, 0.8, out, str(tmp_path / "state"), str(tmp_path / "checkpoint"),
                       order=("ts", "id")).awaitTermination()
    got = spark.read.parquet(out)
    assert got.select("batch").distinct().count() == 4
    want = price_alerts(df, 0.8, order=("ts", "id"))
    assert want.count() > 100
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))

    # New files after a restart go on from the stored prices.
    later = df.select("symbol", (F.col("id") + 2000).alias("id"),
                      (F.col("ts") + F.expr("INTERVAL 90 DAYS")).alias("ts"), "price")
    later.coalesce(1).write.mode("append").parquet(source)
    stream = stream_files(spark, source, df.schema, files_per_batch=1)
    start_price_alerts(stream, 0.8, out, str(tmp_path / "state"), str(tmp_path / "checkpoint"),
                       order=("ts", "id")).awaitTermination()
    want = price_alerts(df.unionByName(later), 0.8, order=("ts", "id"))
    got = spark.read.parquet(out).select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("code", ["1H", "1D", "1W"])
def test_closed_bars_equal_batch_bars(spark, tmp_path, code):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = tick_files(spark, source, rows=9000)
    live = stream_bars(stream_files(spark, source, df.schema), code)
    start_ingest(live, out, str(tmp_path / "checkpoint")).awaitTermination()
    length = {"1H": dt.timedelta(hours=1), "1D": dt.timedelta(days=1),
              "1W": dt.timedelta(weeks=1)}[code]
    closed = df.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=10) - length
    want = bars(df, code).where(F.col("datetime") <= F.lit(closed))
    got = spark.read.schema(want.schema).parquet(out)
    assert want.count() > 0
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_no_live_months(spark, tmp_path):
    df = tick_files(spark, str(tmp_path / "in"), parts=1, rows=5)
    with pytest.raises(ValueError):
        stream_bars(df, "1M")


def test_ingestion_writes_each_row_once(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = tick_files(spark, source)
    for _ in range(2):
        stream = stream_files(spark, source, df.schema, files_per_batch=2)
        start_ingest(stream, out, str(tmp_path / "checkpoint"), partitions=["symbol"]) \
            .awaitTermination()
    got = spark.read.parquet(out).select(df.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))


def shuffled_files(spark, path, minutes, parts=4, rows=1500):
    """Ticks in files, each tick up to `minutes` late, also across files."""
    df = spark.range(rows).select(
        F.expr("if(id % 3 = 0, 'A', if(id % 7 = 0, null, 'B'))").alias("symbol"), "id",
        F.expr("timestamp'2024-01-01' + make_dt_interval(0, 0, 0, (id div 2) * 97)").alias("ts"),
        F.when(F.pmod(F.hash("id"), F.lit(13)) != 0, (F.pmod(F.hash("id"), F.lit(100)) + F.when(F.col("id") % 50 != 0, 1).otherwise(0)).cast("double")).alias("price"))
    length = rows // 2 * 97 // parts + 1
    part = F.floor((F.unix_seconds("ts") - F.unix_seconds(F.lit("2024-01-01").cast("timestamp")) + F.pmod(F.xxhash64("id"), F.lit(minutes * 60))) / length)
    for i in range(parts + 3):
        df.where(part == i).coalesce(1).orderBy(F.xxhash64("id")).write.mode("append").parquet(path)
    return df


def test_shuffled_ticks_raise_the_alerts_of_the_batch(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = shuffled_files(spark, source, 60)
    stream = ordered_alerts(stream_files(spark, source, df.schema, files_per_batch=1), 0.8, id="id", delay="61 minutes")
    start_ingest(stream, out, str(tmp_path / "checkpoint")).awaitTermination()
    last = df.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=61)
    want = price_alerts(df, 0.8, order=("ts", "id")).where(F.col("ts") <= F.lit(last)).select("symbol", "ts", "id", "price", "previous", "change")
    got = spark.read.parquet(out)
    assert want.count() > 100
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_live_bars_take_in_late_ticks(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = shuffled_files(spark, source, 600)
    for _ in range(2):  # the second time there is nothing new
        stream = stream_files(spark, source, df.schema, files_per_batch=1)
        start_live_bars(stream, "1H", out, str(tmp_path / "checkpoint"), order=("ts", "id")).awaitTermination()
    want = sorted(map(str, bars(df, "1H", order=("ts", "id")).collect()))
    columns = bars(df, "1H").columns
    assert sorted(map(str, read_live_bars(spark, out).select(columns).collect())) == want
    compact_live_bars(spark, out)
    spark.catalog.refreshByPath(out)
    assert spark.read.parquet(out).select("batch").distinct().count() == 2
    assert sorted(map(str, read_live_bars(spark, out).select(columns).collect())) == want


def test_waiting_ticks_are_kept_as_one_value():
    """A series may hold all ticks of a micro-batch, so its state has a few bytes for each and no value of its own."""
    import pandas as pd

    from barwright.streaming.alerts import _in_order

    class State:
        exists, get, mark, wakes = False, None, 0, None

        def getCurrentWatermarkMs(self):
            return self.mark

        def update(self, value):
            self.exists, self.get = True, value

        def setTimeoutTimestamp(self, at):
            self.wakes = at

    state, n = State(), 50_000
    ticks = pd.DataFrame({"ts": pd.to_datetime(range(n), unit="s"), "id": range(n), "price": [1.0, 3.0, 1.0, None, 5.0] * (n // 5)})
    assert not list(_in_order(0.5)(("A",), iter([ticks[n // 2:], ticks[:n // 2]]), state))
    assert all(x is None or len(x) == 24 * n for x in state.get)
    state.mark = 10_000_000
    (first,) = _in_order(0.5)(("A",), iter([]), state)
    assert state.wakes == 10_001_001 and len(state.get[0]) == 24 * (n - 10_001)
    state.mark = n * 1000
    (rest,) = _in_order(0.5)(("A",), iter([]), state)
    got = pd.concat([first, rest])
    assert got["id"].tolist() == [i for i in range(1, n) if i % 5 in (0, 1, 2)]
    assert (got["change"].round(6) == [{0: -0.8, 1: 2.0, 2: -0.666667}[i % 5] for i in got["id"]]).all()
