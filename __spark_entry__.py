"""

Three tables of bars or ticks are derived from the given data (FIXTURES.md, section 2). Prices are
whole cents, so that sums are exact and both engines agree to the last bit; means of differences
are rounded on both sides.
"""

from __future__ import annotations

import importlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright import operators as ops
from barwright.functions import (
    canonical_symbol, exchange_of, file_safe, symbol_list, ticker_of,
)
from barwright.plans.blocks import measure_blocks, numbered
from barwright.plans.durable import cut, scratch_path
from barwright.plans.jobs import bronze_to_silver, silver_to_gold, update_gold
from barwright.schema import (
    BAR_COLUMNS, EMA_PERIODS, MACD_PERIODS, RSI_PERIODS, SMA_PERIODS, UNDATED_TEXT_SCHEMA,
)
from barwright.sinks import register_tables, write_partitioned
from barwright.sources import (
    count_files, decode_messages, read_bars_csv, read_bars_parquet, stream_files, typed_bars,
)
from barwright.streaming import (
    ordered_alerts, read_live_bars, start_ingest, start_live_bars, start_price_alerts, stream_bars,
)


def _optional(name: str):
    """A module that may have been taken out, or whose libraries are not here."""
    try:
        return importlib.import_module(name)
    except ImportError:
        return None


# The operators on documents and their pipeline; everything else works without them.
_documents = _optional("barwright.llm.queries")
_pipeline = _optional("corpus_pipeline") if _documents else None

SMOKE_DIR = "/root/testdata/sf0.001"
ALERT_THRESHOLD = 0.5
# Means of sums of millions of cents are compared to 1/1000 cent, as above 1e-9 the last bits depend on the order of additions. Means of 16
# values lie on the boundary between two such numbers, so they are moved off it before they are rounded.
OFF_TIES = 0.0002
# Series length from which the cut variants of queries cut, small so that test data are cut too.
SMALL_BLOCK = 500


# ---------------------------------------------------------------- inputs

def _table(spark, sf_dir, name) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ticks(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"), "ts", "event_id",
        F.round(F.col("value") * 100).alias("price"))


def _gappy_ticks(spark, sf_dir) -> DataFrame:
    """All ticks, with every seventh price missing."""
    return _ticks(spark, sf_dir).withColumn(
        "price", F.when(F.col("event_id") % 7 != 0, F.col("price")))


def _order_ticks(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("symbol"), F.col("o_orderdate").alias("ts"), "o_orderkey",
        F.round(F.col("o_totalprice") * 100).alias("price"))


def _hourly(spark, sf_dir) -> DataFrame:
    return ops.bars(_ticks(spark, sf_dir), "1H")


def _daily(spark, sf_dir) -> DataFrame:
    """Daily bars over seven years. A symbol has one bar a day, so a series is bounded by the
    calendar and needs no cutting."""
    bars = ops.bars(_order_ticks(spark, sf_dir), "1D", order=("ts", "o_orderkey"))
    return bars.withColumn("year", F.year("datetime"))


def _rounded(df: DataFrame, names, digits: int) -> DataFrame:
    return df.select(
        *[F.round(c, digits).alias(c) if c in names else F.col(c) for c in df.columns])


def _rounded_signal(df: DataFrame) -> DataFrame:
    """Rounds the two MACD columns whose sums are not of whole numbers to 1/1000 cent; they run
    into millions of cents, where the last bit of a double is near 1e-9."""
    return _rounded(df, ("MACD_signal_close", "MACD_histogram_close"), 3)


# ---------------------------------------------------------------- queries

def _bars(source, interval, **options):
    return lambda spark, sf_dir: ops.bars(source(spark, sf_dir), interval, **options)


def rebar_daily(spark, sf_dir):
    return ops.rebar(_hourly(spark, sf_dir), "1D", source="1H")


def row_numbers(spark, sf_dir):
    ticks = _ticks(spark, sf_dir)
    blocks = measure_blocks(ticks, ("symbol",), ("ts", "event_id"))
    return numbered(ticks, ("symbol",), ("ts", "event_id"), blocks=blocks)


def row_numbers_cut(spark, sf_dir):
    ticks = _ticks(spark, sf_dir)
    blocks = measure_blocks(ticks, ("symbol",), ("ts", "event_id"), SMALL_BLOCK)
    return numbered(ticks, ("symbol",), ("ts", "event_id"), blocks=blocks)


def sma(spark, sf_dir):
    return ops.sma(_hourly(spark, sf_dir))


def ema(spark, sf_dir):
    return ops.ema(_hourly(spark, sf_dir))


def rsi(spark, sf_dir):
    return ops.rsi(_hourly(spark, sf_dir))


def macd(spark, sf_dir):
    return _rounded_signal(ops.macd(_hourly(spark, sf_dir)))


def ema_recursive(spark, sf_dir):
    averaged = ops.recursive_ema(_hourly(spark, sf_dir))
    return _rounded(averaged, [c for c in averaged.columns if c.startswith("EMA")], 6)


def ema_recursive_cut(spark, sf_dir):
    """Ticks, of which every seventh has no price, in chunks of the shortest length that does."""
    ticks, keys = _gappy_ticks(spark, sf_dir), {"by": ("symbol",), "order": ("ts", "event_id")}
    blocks = measure_blocks(ticks, **keys, target_rows=SMALL_BLOCK)
    averaged = ops.recursive_ema(ticks, "price", (3, 10), blocks=blocks, chunk_rows=SMALL_BLOCK, **keys)
    return _rounded(averaged, [c for c in averaged.columns if c.startswith("EMA")], 6)


def rsi_wilder(spark, sf_dir):
    rated = ops.wilder_rsi(_hourly(spark, sf_dir))
    return _rounded(rated, [c for c in rated.columns if c.startswith("RSI")], 6)


def _text_ticks(spark, sf_dir) -> DataFrame:
    """Ticks whose time is text, as in silver files that hold it so."""
    return _ticks(spark, sf_dir).withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def row_numbers_text_key(spark, sf_dir):
    ticks, keys = _text_ticks(spark, sf_dir), {"by": ("symbol",), "order": ("ts", "event_id")}
    return numbered(ticks, blocks=measure_blocks(ticks, **keys, target_rows=SMALL_BLOCK), **keys)


def last_n_text_key(spark, sf_dir):
    return ops.last_n_bars(_text_ticks(spark, sf_dir), 1460, order=("ts", "event_id"))


def gap_fill_text_key(spark, sf_dir):
    ticks = _gappy_ticks(spark, sf_dir).withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    keys = {"by": ("symbol",), "order": ("ts", "event_id")}
    return ops.fill_gaps(ticks, ["price"], blocks=measure_blocks(ticks, **keys, target_rows=SMALL_BLOCK), **keys)


def gold_by_year(spark, sf_dir):
    return _rounded_signal(ops.gold(_daily(spark, sf_dir)))


def gold_continuous(spark, sf_dir):
    return _rounded_signal(ops.gold(_daily(spark, sf_dir), by=("symbol",)))


def gold_continuous_cut(spark, sf_dir):
    bars = cut(_daily(spark, sf_dir))
    keys = {"by": ("symbol",), "order": ("datetime",)}
    blocks = measure_blocks(bars, **keys, target_rows=SMALL_BLOCK)
    return _rounded_signal(ops.gold(bars, blocks=blocks, **keys))


def _gap_fill(spark, sf_dir, **target):
    ticks = _gappy_ticks(spark, sf_dir)
    keys = {"by": ("symbol",), "order": ("ts", "event_id")}
    return ops.fill_gaps(ticks, ["price"], blocks=measure_blocks(ticks, **keys, **target), **keys)


def gap_fill(spark, sf_dir):
    return _gap_fill(spark, sf_dir)


def gap_fill_cut(spark, sf_dir):
    return _gap_fill(spark, sf_dir, target_rows=SMALL_BLOCK)


def missing_profile(spark, sf_dir):
    return ops.missing_profile(_gappy_ticks(spark, sf_dir))


def last_n_bars(spark, sf_dir):
    return ops.last_n_bars(_hourly(spark, sf_dir), 168)


def last_n_ticks(spark, sf_dir):
    return ops.last_n_bars(_ticks(spark, sf_dir), 1460, order=("ts", "event_id"))


def head_bars(spark, sf_dir):
    return ops.head_bars(_hourly(spark, sf_dir), order=("datetime", "symbol"))


def tail_bars(spark, sf_dir):
    return ops.tail_bars(_hourly(spark, sf_dir), order=("datetime", "symbol"))


def distinct_years(spark, sf_dir):
    return ops.years(_order_ticks(spark, sf_dir).withColumnRenamed("ts", "datetime"))


def conform_schema(spark, sf_dir):
    partial = _hourly(spark, sf_dir).select(
        F.col("volume").cast("string"), "close", "datetime", F.col("symbol").alias("coin"))
    return ops.conform(partial)


def numbers_as_doubles(spark, sf_dir):
    return ops.numbers_as_doubles(_table(spark, sf_dir, "orders"))


def symbol_format(spark, sf_dir):
    named = _table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("NYSE:"), "event_type"))
        .otherwise(F.col("event_type")).alias("name"),
        F.when(F.col("user_id") % 2 == 0, F.col("event_id") % 4).alias("contract"))
    symbol = canonical_symbol("name", F.lit("NSE"), "contract")
    return named.select("event_id", symbol.alias("symbol")).select(
        "*", exchange_of("symbol").alias("exchange"), ticker_of("symbol").alias("ticker"),
        file_safe("symbol").alias("file_name"))


def symbol_lists(spark, sf_dir):
    listed = F.concat(F.lit("NSE:"), "event_type", F.lit(", BSE:"), "event_type")
    return _table(spark, sf_dir, "events").select(
        "event_id", F.explode(symbol_list(listed)).alias("symbol")).select(
        "event_id", exchange_of("symbol").alias("exchange"), ticker_of("symbol").alias("ticker"))


def decoded_messages(spark, sf_dir):
    """One message per symbol and day, whose midnight bar has no volume."""
    price = [F.col(c).cast("string") for c in ("open", "high", "low", "close")]
    epoch = F.unix_seconds(F.col("datetime").cast("timestamp")).cast("double").cast("string")
    volume = F.when(F.hour("datetime") != 0, F.col("volume").cast("string"))
    values = F.concat_ws(",", epoch, *price, volume)
    bar = F.struct(
        "datetime",
        F.concat(F.lit('{"i":'), F.hour("datetime"), F.lit(',"v":['), values, F.lit("]}"))
        .alias("text"))
    listed = F.concat_ws(",", F.sort_array(F.collect_list(bar))["text"])
    messages = _hourly(spark, sf_dir).groupBy("symbol", F.to_date("datetime").alias("day")).agg(
        F.concat(F.lit('~m~99~m~{"m":"timescale_update","p":["cs_a",{"s1":{"node":"x","s":['),
                 listed, F.lit('],"ns":{"d":"","indexes":[]}}}]}')).alias("message"))
    return decode_messages(messages).withColumn(
        "datetime", F.col("datetime").cast("timestamp_ntz"))


def _stored_daily(spark, sf_dir) -> str:
    """Daily bars written by coin and year; returns the folder."""
    path = scratch_path(spark, "daily")
    write_partitioned(_daily(spark, sf_dir).withColumn("coin", file_safe("symbol")), path)
    return path


def year_split_roundtrip(spark, sf_dir):
    bars = read_bars_parquet(spark, _stored_daily(spark, sf_dir))
    return bars.groupBy("coin", "year").agg(
        F.count("*").alias("n_rows"), F.sum("close").alias("sum_close"),
        F.min("datetime").alias("first_day"), F.max("datetime").alias("last_day"))


def files_per_partition(spark, sf_dir):
    return count_files(read_bars_parquet(spark, _stored_daily(spark, sf_dir)), ("coin", "year"))


def pruned_scan(spark, sf_dir):
    return read_bars_parquet(spark, _stored_daily(spark, sf_dir), coins=["1-URGENT", "5-LOW"],
                             years=[1996, 1999])


def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    bars = _hourly(spark, sf_dir).select(*BAR_COLUMNS, F.col("symbol").alias("coin"))
    write_partitioned(bars, path, partitions=["coin"], format="csv", header=True)
    return typed_bars(read_bars_csv(spark, path), "timestamp_ntz")


def csv_semicolon(spark, sf_dir):
    path = scratch_path(spark, "csv")
    bars = _daily(spark, sf_dir).select(*BAR_COLUMNS[1:], F.col("symbol").alias("coin"), "year")
    write_partitioned(bars, path, format="csv", header=True, sep=";")
    return read_bars_csv(spark, path, sep=";", schema=UNDATED_TEXT_SCHEMA, coin=False)


def catalog_register(spark, sf_dir):
    path, database = scratch_path(spark, "gold"), f"bars_{uuid.uuid4().hex}"
    gold = ops.gold(_daily(spark, sf_dir)).withColumn("coin", F.col("symbol"))
    write_partitioned(gold, path, gather=False)
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, database)}'")
    counts = [
        spark.table(f"{database}.{name}").agg(
            F.lit(name).alias("table_name"), F.count("*").alias("n_rows"),
            F.countDistinct("year").alias("n_years"),
            F.count("SMA_200_close").alias("n_averages"))
        for name in register_tables(spark, path, database)
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def _odd_ticks(spark, sf_dir) -> DataFrame:
    """All ticks; every seventh price is missing, every eleventh is NaN."""
    return _gappy_ticks(spark, sf_dir).withColumn(
        "price", F.when(F.col("event_id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("price")))


def bars_gappy(spark, sf_dir):
    return ops.bars(_odd_ticks(spark, sf_dir), "1H", order=("ts", "event_id"))


def price_alerts_gappy(spark, sf_dir):
    found = ops.price_alerts(_odd_ticks(spark, sf_dir), ALERT_THRESHOLD, order=("ts", "event_id"))
    return found.select("symbol", "ts", "event_id", "price", "previous", F.round("change", 9).alias("change"))


def gap_fill_default(spark, sf_dir):
    filled = ops.fill_gaps(_gappy_ticks(spark, sf_dir), order=("ts",))
    return filled.withColumn("price", F.round("price", 6))


def missing_profile_by_symbol(spark, sf_dir):
    return ops.missing_profile(_odd_ticks(spark, sf_dir), by=("symbol",))


def _order_bars_text(spark, sf_dir) -> DataFrame:
    """Daily bars as text; every ninth close is missing, and every fiftieth day unreadable."""
    day = F.datediff("datetime", F.lit("1970-01-01").cast("date"))
    return _daily(spark, sf_dir).select(
        F.substring("symbol", 1, 1).alias("coin"),
        F.when(day % 50 != 0, F.date_format("datetime", "yyyy-MM-dd HH:mm:ss")).otherwise(F.lit("?")).alias("datetime"),
        "symbol", "open", "high", "low", F.when(day % 9 != 0, F.col("close")).alias("close"), "volume")


def _silver(spark, sf_dir) -> str:
    """Silver from two runs of the job over different coins, the second from files whose columns stand in two other
    orders, one of them with names in capitals."""
    silver, text = scratch_path(spark, "silver"), cut(_order_bars_text(spark, sf_dir), "text")
    runs = (
        [(["1", "2", "3"], ["datetime", "symbol", "open", "high", "low", "close", "volume"])],
        [(["4"], ["close", "symbol", "volume", "datetime", "low", "high", "open"]),
         (["5"], ["SYMBOL", "DateTime", "Close", "OPEN", "High", "Low", "Volume"])],
    )
    for run in runs:
        bronze = scratch_path(spark, "bronze")
        for i, (coins, columns) in enumerate(run):
            rows = text.where(F.col("coin").isin(coins)).select("coin", *[F.col(c).alias(c) for c in columns])
            write_partitioned(rows, f"{bronze}/{i}", partitions=("coin",), format="csv", header=True)
        bronze_to_silver(spark, bronze, silver, scratch_path(spark, "quarantine"))
    return silver


def bronze_to_silver_job(spark, sf_dir):
    stored = read_bars_parquet(spark, _silver(spark, sf_dir))
    return stored.select(F.col("coin").cast("string").alias("coin"), "symbol", F.col("datetime").cast("timestamp_ntz").alias("datetime"),
                         "open", "high", "low", F.round("close", 6).alias("close"), "volume", "year")


def silver_to_gold_job(spark, sf_dir):
    gold = scratch_path(spark, "gold")
    silver_to_gold(spark, _silver(spark, sf_dir), gold)
    stored = read_bars_parquet(spark, gold)
    return stored.select("symbol", F.col("datetime").cast("timestamp_ntz").alias("datetime"), "year",
                         *[F.round(F.col(c) + OFF_TIES, 3).alias(c) for c in ("SMA_10_close", "SMA_200_close")])


def replace_partition(spark, sf_dir):
    """All coins are written, then one year of one coin anew with a tenth of the volume."""
    path = scratch_path(spark, "replaced")
    bars = ops.dated(_daily(spark, sf_dir)).withColumn("coin", F.substring("symbol", 1, 1))
    write_partitioned(bars, path)
    write_partitioned(bars.where("coin = '5' and year = 1996").withColumn("volume", F.col("volume") / 10), path, replace="present")
    return read_bars_parquet(spark, path).groupBy(F.col("coin").cast("string").alias("coin"), "year").agg(
        F.count("*").alias("n_rows"), F.round(F.sum("volume"), 6).alias("sum_volume"))


def trend_flags(spark, sf_dir):
    flagged = ops.trend_flags(_daily(spark, sf_dir), by=("symbol",))
    return flagged.select("symbol", "datetime", "close", "above_SMA_200", "SMA_cross", "MACD_cross")


def market_report(spark, sf_dir):
    return _rounded(ops.market_report(_daily(spark, sf_dir)), ("mean_volume", "volatility"), 6)


def _event_prices(spark, sf_dir):
    return _table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"), "ts", "event_id", F.col("value").alias("price"))


def _alerts(spark, sf_dir, **target):
    ticks = _event_prices(spark, sf_dir)
    keys = {"by": ("symbol",), "order": ("ts", "event_id")}
    blocks = measure_blocks(ticks, **keys, **target)
    return ops.price_alerts(ticks, ALERT_THRESHOLD, blocks=blocks, **keys)


def price_alerts_batch(spark, sf_dir):
    return _alerts(spark, sf_dir)


def price_alerts_cut(spark, sf_dir):
    return _alerts(spark, sf_dir, target_rows=SMALL_BLOCK)


def _event_stream(spark, sf_dir):
    schema = _table(spark, sf_dir, "events").schema
    return stream_files(spark, sf_dir, schema, glob="events.parquet").select(
        F.col("event_type").alias("symbol"), "ts", "event_id", F.col("value"))


def _finish(query) -> None:
    query.awaitTermination()


def price_alerts_stream(spark, sf_dir):
    path = scratch_path(spark, "alerts")
    ticks = _event_stream(spark, sf_dir).withColumnRenamed("value", "price")
    _finish(start_price_alerts(ticks, ALERT_THRESHOLD, f"{path}/out", f"{path}/state",
                               f"{path}/checkpoint", order=("ts", "event_id")))
    return spark.read.parquet(f"{path}/out").drop("batch")


def bars_stream(spark, sf_dir):
    path = scratch_path(spark, "bars")
    ticks = _event_stream(spark, sf_dir).withColumn("price", F.round(F.col("value") * 100))
    _finish(start_ingest(stream_bars(ticks, "1H"), f"{path}/out", f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/out").withColumn(
        "datetime", F.col("datetime").cast("timestamp_ntz"))


def ingest_stream(spark, sf_dir):
    path = scratch_path(spark, "ticks")
    ticks = _event_stream(spark, sf_dir).withColumn("year", F.year("ts"))
    _finish(start_ingest(ticks, f"{path}/out", f"{path}/checkpoint",
                         partitions=["symbol", "year"]))
    return spark.read.parquet(f"{path}/out")


def _shuffled_stream(spark, sf_dir) -> DataFrame:
    """All events as a stream of files, in each of which times of some minutes stand in no order and reach into the next file."""
    path, events = scratch_path(spark, "events"), _table(spark, sf_dir, "events")
    first = events.agg(F.min("ts")).head()[0]
    minutes = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lit(first).cast("timestamp"))) / 60_000_000)
    late = F.pmod(F.xxhash64("event_id"), F.lit(240))
    part = F.floor((minutes + late) / (8 * 1440))
    (events.withColumn("part", part).repartition("part").sortWithinPartitions("part", F.xxhash64("event_id"))
     .write.partitionBy("part").parquet(path))
    for number in sorted(r["part"] for r in spark.read.parquet(path).select("part").distinct().collect()):
        spark.read.schema(events.schema).parquet(f"{path}/part={number}").coalesce(1).write.mode("append").parquet(f"{path}-files")
    return stream_files(spark, f"{path}-files", events.schema, files_per_batch=1)


def price_alerts_ordered(spark, sf_dir):
    """Times up to four hours late, across micro-batches; the watermark waits for them."""
    path = scratch_path(spark, "alerts")
    ticks = _shuffled_stream(spark, sf_dir).select(F.col("event_type").alias("symbol"), "ts", "event_id", F.col("value").alias("price"))
    _finish(start_ingest(ordered_alerts(ticks, ALERT_THRESHOLD, delay="5 hours"), f"{path}/out", f"{path}/checkpoint"))
    found = spark.read.parquet(f"{path}/out")
    return found.withColumn("ts", F.col("ts").cast("timestamp_ntz")).withColumn("change", F.round("change", 9))


def bars_live(spark, sf_dir):
    path = scratch_path(spark, "bars")
    ticks = _shuffled_stream(spark, sf_dir).select(
        F.col("event_type").alias("symbol"), "ts", "event_id", F.round(F.col("value") * 100).alias("price"))
    _finish(start_live_bars(ticks, "1H", f"{path}/out", f"{path}/checkpoint"))
    return read_live_bars(spark, f"{path}/out")


def gap_fill_week(spark, sf_dir):
    """Daily bars, of which every ninth close is missing, filled from seven days on either side."""
    day = F.datediff("datetime", F.lit("1970-01-01").cast("date"))
    bars = _daily(spark, sf_dir).withColumn("close", F.when(day % 9 != 0, F.col("close")))
    return ops.fill_gaps_within(bars, ["close"], days=7).withColumn("close", F.round("close", 6))


def update_gold_job(spark, sf_dir):
    """Gold of all years but the last months of one, then of all: only the partitions concerned are computed anew."""
    silver, gold, ledger = (scratch_path(spark, n) for n in ("silver", "gold", "ledger"))
    bars = cut(ops.dated(_daily(spark, sf_dir)).withColumn("coin", F.substring("symbol", 1, 1)), "bars")
    write_partitioned(bars.where(~((F.col("year") == 1997) & (F.month("datetime") > 9))), silver)
    update_gold(spark, silver, gold, ledger)
    write_partitioned(bars.where("year = 1997"), silver, replace="present")
    n_written = update_gold(spark, silver, gold, ledger)
    stored = read_bars_parquet(spark, gold)
    return stored.groupBy(F.col("coin").cast("string").alias("coin"), "year").agg(
        F.count("*").alias("n_rows"), F.round(F.sum("SMA_50_close"), 3).alias("sum_average")).withColumn(
        "n_written", F.lit(n_written).cast("bigint"))


# Query names of the thirteen bar widths.
TICK_BARS = {
    "bars_1m": "1", "bars_3m": "3", "bars_5m": "5", "bars_15m": "15", "bars_30m": "30",
    "bars_45m": "45", "bars_hourly": "1H", "bars_2h": "2H", "bars_3h": "3H", "bars_4h": "4H",
}
ORDER_BARS = {"bars_daily": "1D", "bars_weekly": "1W", "bars_monthly": "1M"}


def entry(spark: SparkSession) -> DataFrame:
    """All indicators of daily bars, restarting every year."""
    return gold_by_year(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    bars = {name: _bars(_ticks, code) for name, code in TICK_BARS.items()}
    bars |= {name: _bars(_order_ticks, code, order=("ts", "o_orderkey"))
             for name, code in ORDER_BARS.items()}
    others = (
        rebar_daily, row_numbers, row_numbers_cut, sma, ema, rsi, macd, gold_by_year,
        gold_continuous, gold_continuous_cut, gap_fill, gap_fill_cut, missing_profile,
        last_n_bars, last_n_ticks, head_bars, tail_bars, distinct_years, conform_schema,
        numbers_as_doubles, symbol_format, symbol_lists, decoded_messages, year_split_roundtrip,
        files_per_partition, pruned_scan, csv_roundtrip, csv_semicolon, catalog_register,
        trend_flags, market_report, price_alerts_batch, price_alerts_cut, price_alerts_stream,
        bars_stream, ingest_stream, bars_gappy, price_alerts_gappy, gap_fill_default,
        missing_profile_by_symbol, bronze_to_silver_job, silver_to_gold_job, replace_partition,
        ema_recursive, ema_recursive_cut, rsi_wilder, row_numbers_text_key, last_n_text_key, gap_fill_text_key,
        price_alerts_ordered, bars_live, gap_fill_week, update_gold_job,
    )
    found = bars | {f.__name__: f for f in others}
    if _documents:
        found |= _documents.QUERIES
    if _pipeline:
        found["pipeline"] = _pipeline.run
    return found


# ---------------------------------------------------------------- SQL

_TICKS = "SELECT event_type AS symbol, ts, event_id, round(value * 100) AS price FROM events"
_GAPPY = ("SELECT event_type AS symbol, ts, event_id, CASE WHEN event_id % 7 <> 0 "
          "THEN round(value * 100) END AS price FROM events")
_ORDERS = ("SELECT o_orderpriority AS symbol, o_orderdate AS ts, o_orderkey, "
           "round(o_totalprice * 100) AS price FROM orders")


def _bars_sql(source: str, start: str, rank: str) -> str:
    return (f"SELECT symbol, CAST({start} AS TIMESTAMP) AS datetime, arg_min(price, {rank}) AS open, "
            f"max(price) AS high, min(price) AS low, arg_max(price, {rank}) AS close, "
            f"CAST(count(*) AS DOUBLE) AS volume FROM ({source}) GROUP BY 1, 2")


def _bucket(interval: str) -> str:
    return f"time_bucket(INTERVAL '{interval}', ts, TIMESTAMP '1970-01-01')"


_HOURLY = _bars_sql(_TICKS, "date_trunc('hour', ts)", "ts")
_ORDER_RANK = "(ts, o_orderkey)"
_DAILY = (f"SELECT *, CAST(year(datetime) AS INT) AS year FROM "
          f"({_bars_sql(_ORDERS, _bucket('1 day'), _ORDER_RANK)})")
_BAR_STARTS = {
    **{name: _bucket(f"{code} minutes") for name, code in TICK_BARS.items() if code.isdigit()},
    **{name: _bucket(f"{code[:-1]} hours") for name, code in TICK_BARS.items()
       if code.endswith("H")},
    "bars_daily": _bucket("1 day"), "bars_weekly": "date_trunc('week', ts)",
    "bars_monthly": "date_trunc('month', ts)",
}


def _indicator_sql(bars: str, by: str, sma=(), ema=(), rsi=(), macd=None, keep="*") -> str:
    """The indicator definitions, written as plain windows."""
    order = f"PARTITION BY {by} ORDER BY datetime"
    plain, late = [], []

    def mean(column, first, last):
        back = f"{last} PRECEDING" if last else "CURRENT ROW"
        return f"avg({column}) OVER ({order} ROWS BETWEEN {first} PRECEDING AND {back})"

    def shape(column, n, gate, now, before):
        return (f"CASE WHEN rn < {gate} THEN NULL WHEN rn = {gate} OR {before} IS NULL THEN {now} "
                f"ELSE {column} * (2e0 / {n + 1}) + {before} * (1 - 2e0 / {n + 1}) END")

    for n in sma:
        plain.append(f"{mean('close', n - 1, 0)} AS SMA_{n}_close")
    for n in [*ema, *(macd[:2] if macd else ())]:
        column = shape("close", n, n, mean("close", n - 1, 0), mean("close", n, 1))
        plain.append(f"{column} AS EMA_{n}_close")
    for n in rsi:
        gain, loss = mean("gain", n - 1, 0), mean("loss", n - 1, 0)
        plain.append(f"CASE WHEN {loss} = 0 THEN 100.0::DOUBLE "
                     f"ELSE 100 - 100 / (1 + {gain} / {loss}) END AS RSI_{n}_close")
    base = f"SELECT *, row_number() OVER ({order}) AS rn, close - lag(close) OVER ({order}) AS move"
    sql = (f"SELECT *, CASE WHEN move > 0 THEN move ELSE 0 END AS gain, "
           f"CASE WHEN move < 0 THEN -move ELSE 0 END AS loss FROM ({base} FROM ({bars}))")
    sql = f"SELECT *, {', '.join(plain)} FROM ({sql})"
    if macd:
        fast, slow, signal = macd
        sql = f"SELECT *, EMA_{fast}_close - EMA_{slow}_close AS MACD_line_close FROM ({sql})"
        column = shape("MACD_line_close", signal, signal + max(fast, slow),
                       mean("MACD_line_close", signal - 1, 0), mean("MACD_line_close", signal, 1))
        late = [f"{column} AS signal"]
        sql = (f"SELECT *, round(signal, 3) AS MACD_signal_close, "
               f"round(MACD_line_close - signal, 3) AS MACD_histogram_close "
               f"FROM (SELECT *, {', '.join(late)} FROM ({sql}))")
        return f"SELECT {keep} EXCLUDE (rn, move, gain, loss, signal) FROM ({sql})"
    return f"SELECT {keep} EXCLUDE (rn, move, gain, loss) FROM ({sql})"


def _recursive_sql(rows: str, state: dict[str, tuple[str, str]], order: str = "rn") -> str:
    """Every row of a series from the one before it: the first value of each state column, and the next one from `old` and `b`."""
    first = ", ".join(f"{start} AS {name}" for name, (start, _) in state.items())
    step = ", ".join(f"{after} AS {name}" for name, (_, after) in state.items())
    return (f"WITH RECURSIVE b AS MATERIALIZED ({rows}), r AS (SELECT symbol, rn, {first} FROM b WHERE rn = 1 UNION ALL "
            f"SELECT b.symbol, b.rn, {step} FROM r old JOIN b ON b.symbol = old.symbol AND b.rn = old.rn + 1)")


def _ema_state(value: str, periods) -> dict[str, tuple[str, str]]:
    return {f"e{n}": (f"CASE WHEN {n} = 1 THEN {value} END", f"CASE WHEN b.rn < {n} THEN NULL WHEN b.rn = {n} THEN b.m{n} "
                      f"ELSE b.{value} * (2e0 / {n + 1}) + old.e{n} * (1 - 2e0 / {n + 1}) END") for n in periods}


def _ema_recursive_sql(source: str, value: str, periods, order: str) -> str:
    means = ", ".join(f"avg({value}) OVER (PARTITION BY symbol ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS m{n}"
                      for n in periods)
    rows = f"SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY {order}) AS rn, {means} FROM ({source}) WHERE {value} IS NOT NULL"
    out = ", ".join(f"round(e{n}, 6) AS EMA_recursive_{n}_{value}" for n in periods)
    empty = ", ".join(f"CAST(NULL AS DOUBLE) AS EMA_recursive_{n}_{value}" for n in periods)
    kept = f"b.* EXCLUDE (rn, {', '.join(f'm{n}' for n in periods)})"
    return (f"{_recursive_sql(rows, _ema_state(value, periods))} SELECT {kept}, {out} FROM b JOIN r USING (symbol, rn) "
            f"UNION ALL BY NAME SELECT *, {empty} FROM ({source}) WHERE {value} IS NULL")


def _rsi_wilder_sql(source: str, periods) -> str:
    window = "OVER (PARTITION BY symbol ORDER BY datetime"
    moved = (f"SELECT *, row_number() {window}) AS rn, greatest(close - lag(close) {window}), 0) AS gain, "
             f"greatest(lag(close) {window}) - close, 0) AS loss FROM ({source})")
    means = ", ".join(f"avg({m}) {window} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS {m}{n}" for n in periods for m in ("gain", "loss"))
    state = {f"{m}_{n}": ("NULL::DOUBLE", f"CASE WHEN b.rn <= {n} THEN NULL WHEN b.rn = {n + 1} THEN b.{m}{n} "
                          f"ELSE (old.{m}_{n} * ({n} - 1) + b.{m}) / {n} END") for n in periods for m in ("gain", "loss")}
    out = ", ".join(f"round(CASE WHEN loss_{n} = 0 THEN 100 ELSE 100 - 100 / (1 + gain_{n} / loss_{n}) END, 6) AS RSI_wilder_{n}_close" for n in periods)
    dropped = ", ".join(["rn", "gain", "loss", *[f"{m}{n}" for n in periods for m in ("gain", "loss")]])
    return f"{_recursive_sql(f'SELECT *, {means} FROM ({moved})', state)} SELECT b.* EXCLUDE ({dropped}), {out} FROM b JOIN r USING (symbol, rn)"


_ALL = {"sma": SMA_PERIODS, "ema": EMA_PERIODS, "rsi": RSI_PERIODS, "macd": MACD_PERIODS}
_ALERTS = (
    f"SELECT *, price / previous - 1 AS change FROM (SELECT event_type AS symbol, ts, event_id, "
    "value AS price, lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS previous "
    f"FROM events) WHERE previous <> 0 AND abs(price / previous - 1) >= {ALERT_THRESHOLD}"
)


def _turn_sql(name: str, before: str, now: str) -> str:
    return (f"CAST(CASE WHEN {before} <= 0 AND {now} > 0 THEN 1 "
            f"WHEN {before} >= 0 AND {now} < 0 THEN -1 ELSE 0 END AS INT) AS {name}")


def oracle_sql() -> dict[str, str]:
    order = "PARTITION BY symbol ORDER BY datetime"
    row_numbers_sql = ("SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts, event_id) "
                       f"AS row_num FROM ({_TICKS})")
    gap_fill_sql = (
        "SELECT symbol, ts, event_id, coalesce(price, avg(price) OVER (PARTITION BY symbol "
        "ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)) AS price "
        f"FROM ({_GAPPY})")
    continuous = _indicator_sql(_DAILY, "symbol", **_ALL)
    stored = f"SELECT *, replace(symbol, ':', '') AS coin FROM ({_DAILY})"
    sql = {name: _bars_sql(_TICKS, start, "ts") for name, start in _BAR_STARTS.items()
           if name in TICK_BARS}
    sql |= {name: _bars_sql(_ORDERS, _BAR_STARTS[name], _ORDER_RANK) for name in ORDER_BARS}
    sql |= {
        "rebar_daily": _bars_sql(_TICKS, "date_trunc('day', ts)", "ts"),
        "row_numbers": row_numbers_sql,
        "row_numbers_cut": row_numbers_sql,
        "sma": _indicator_sql(_HOURLY, "symbol", sma=SMA_PERIODS),
        "ema": _indicator_sql(_HOURLY, "symbol", ema=EMA_PERIODS),
        "rsi": _indicator_sql(_HOURLY, "symbol", rsi=RSI_PERIODS),
        "macd": _indicator_sql(_HOURLY, "symbol", macd=MACD_PERIODS),
        "gold_by_year": _indicator_sql(_DAILY, "symbol, year", **_ALL),
        "gold_continuous": continuous,
        "gold_continuous_cut": continuous,
        "gap_fill": gap_fill_sql,
        "gap_fill_cut": gap_fill_sql,
        "missing_profile": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, "
            f"100.0::DOUBLE * (count(*) - count({c})) / count(*) AS percent, "
            "4 * count(*) - count(symbol) - count(ts) - count(event_id) - count(price) "
            f"AS total_missing FROM ({_GAPPY})"
            for c in ("symbol", "ts", "event_id", "price")),
        "last_n_bars": f"SELECT * FROM ({_HOURLY}) QUALIFY row_number() OVER "
                       "(PARTITION BY symbol ORDER BY datetime DESC) <= 168",
        "last_n_ticks": f"SELECT * FROM ({_TICKS}) QUALIFY row_number() OVER "
                        "(PARTITION BY symbol ORDER BY ts DESC, event_id DESC) <= 1460",
        "head_bars": f"SELECT * FROM ({_HOURLY}) ORDER BY datetime, symbol LIMIT 5",
        "tail_bars": f"SELECT * FROM ({_HOURLY}) ORDER BY datetime DESC, symbol DESC LIMIT 5",
        "distinct_years": "SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year FROM orders",
        "conform_schema":
            "SELECT datetime, upper(symbol) AS symbol, CAST(NULL AS DOUBLE) AS open, "
            "CAST(NULL AS DOUBLE) AS high, CAST(NULL AS DOUBLE) AS low, close, volume, "
            f"symbol AS coin FROM ({_HOURLY})",
        "numbers_as_doubles":
            "SELECT * REPLACE (CAST(o_orderkey AS DOUBLE) AS o_orderkey, "
            "CAST(o_custkey AS DOUBLE) AS o_custkey) FROM orders",
        "symbol_format":
            "SELECT event_id, symbol, split_part(symbol, ':', 1) AS exchange, "
            "split_part(symbol, ':', 2) AS ticker, replace(symbol, ':', '') AS file_name FROM ("
            "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'NYSE:' || event_type "
            "WHEN user_id % 2 = 0 THEN 'NSE:' || event_type || (event_id % 4) || '!' "
            "ELSE 'NSE:' || event_type END AS symbol FROM events)",
        "symbol_lists":
            "SELECT event_id, exchange, event_type AS ticker FROM events, "
            "(VALUES ('NSE'), ('BSE')) AS e(exchange)",
        "decoded_messages":
            "SELECT datetime, symbol, open, high, low, close, "
            "CASE WHEN hour(datetime) = 0 THEN 0.0::DOUBLE ELSE volume END AS volume "
            f"FROM ({_HOURLY})",
        "year_split_roundtrip":
            "SELECT coin, year, count(*) AS n_rows, sum(close) AS sum_close, "
            "min(datetime) AS first_day, max(datetime) AS last_day "
            f"FROM ({stored}) GROUP BY coin, year",
        "files_per_partition":
            f"SELECT DISTINCT coin, year, CAST(1 AS BIGINT) AS n_files FROM ({stored})",
        "pruned_scan": f"SELECT * FROM ({stored}) WHERE coin IN ('1-URGENT', '5-LOW') "
                       "AND year IN (1996, 1999)",
        "csv_roundtrip": f"SELECT *, symbol AS coin FROM ({_HOURLY})",
        "csv_semicolon": f"SELECT symbol, open, high, low, close, volume FROM ({_DAILY})",
        "catalog_register":
            "SELECT 'trade_data_' || regexp_replace(lower(symbol), '[^a-z0-9_]', '_', 'g') AS table_name, count(*) AS n_rows, "
            "count(DISTINCT year) AS n_years, count(close) AS n_averages "
            f"FROM ({_DAILY}) GROUP BY 1",
        "trend_flags":
            "SELECT symbol, datetime, close, close > SMA_200_close AS above_SMA_200, "
            + _turn_sql("SMA_cross", "gap_before", "gap") + ", "
            + _turn_sql("MACD_cross", "line_before", "MACD_line_close") +
            f" FROM (SELECT *, lag(gap) OVER ({order}) AS gap_before, "
            f"lag(MACD_line_close) OVER ({order}) AS line_before FROM ("
            f"SELECT *, SMA_50_close - SMA_200_close AS gap FROM ({continuous})))",
        "market_report":
            "SELECT symbol, CAST(date_trunc('month', datetime) AS TIMESTAMP) AS period, "
            "count(*) AS n_bars, arg_min(close, datetime) AS first_close, "
            "arg_max(close, datetime) AS last_close, "
            "arg_max(close, datetime) / arg_min(close, datetime) - 1 AS period_return, "
            "max(high) AS high, min(low) AS low, round(avg(volume), 6) AS mean_volume, "
            "round(stddev_samp(change), 6) AS volatility FROM (SELECT *, "
            f"close / lag(close) OVER ({order}) - 1 AS change FROM ({_DAILY})) GROUP BY 1, 2",
        "price_alerts_batch": _ALERTS,
        "price_alerts_cut": _ALERTS,
        "price_alerts_stream": _ALERTS,
        "bars_stream":
            f"SELECT * FROM ({_HOURLY}) WHERE datetime + INTERVAL 1 HOUR <= "
            "(SELECT max(ts) - INTERVAL 10 MINUTE FROM events)",
        "ingest_stream":
            "SELECT event_type AS symbol, ts, event_id, value, CAST(year(ts) AS INT) AS year "
            "FROM events",
    }
    odd = ("SELECT event_type AS symbol, ts, event_id, CASE WHEN event_id % 7 <> 0 AND event_id % 11 <> 0 "
           "THEN round(value * 100) END AS price FROM events")
    whole = "PARTITION BY symbol ORDER BY ts, event_id"
    sql["bars_gappy"] = (
        "SELECT symbol, date_trunc('hour', ts) AS datetime, arg_min(price, (ts, event_id)) AS open, max(price) AS high, "
        "min(price) AS low, arg_max(price, (ts, event_id)) AS close, CAST(count(*) AS DOUBLE) AS volume "
        f"FROM ({odd}) WHERE price IS NOT NULL GROUP BY 1, 2")
    sql["price_alerts_gappy"] = (
        "SELECT symbol, ts, event_id, price, previous, round(price / previous - 1, 9) AS change FROM "
        f"(SELECT *, lag(price) OVER ({whole}) AS previous FROM ({odd})) "
        f"WHERE previous <> 0 AND abs(price / previous - 1) >= {ALERT_THRESHOLD}")
    sql["gap_fill_default"] = (
        "SELECT symbol, ts, event_id, round(coalesce(price, avg(price) OVER (PARTITION BY symbol ORDER BY ts "
        f"ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)), 6) AS price FROM ({_GAPPY})")
    missing = "count(*) FILTER (CASE WHEN event_id % 7 <> 0 AND event_id % 11 <> 0 THEN value END IS NULL)"
    sql["missing_profile_by_symbol"] = " UNION ALL ".join(
        f"SELECT event_type AS symbol, '{c}' AS column_name, {m if c != 'price' else missing} AS missing, "
        f"{m if c != 'price' else missing} * 100.0 / count(*) AS percent, {missing} AS total_missing "
        "FROM events GROUP BY event_type" for c, m in (("ts", "0"), ("event_id", "0"), ("price", "")))
    day = "date_diff('day', DATE '1970-01-01', CAST(datetime AS DATE))"
    silver = (
        "SELECT substring(symbol, 1, 1) AS coin, symbol, datetime, open, high, low, coalesce(gap, avg(gap) OVER "
        "(PARTITION BY symbol ORDER BY datetime ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)) AS close, volume, "
        f"CAST(year(datetime) AS INT) AS year FROM (SELECT *, CASE WHEN {day} % 9 <> 0 THEN close END AS gap "
        f"FROM ({_DAILY}) WHERE {day} % 50 <> 0)")
    sql["bronze_to_silver_job"] = f"SELECT * REPLACE (round(close, 6) AS close) FROM ({silver})"
    mean = ("round(avg(close) OVER (PARTITION BY symbol, year ORDER BY datetime "
            f"ROWS BETWEEN {{}} PRECEDING AND CURRENT ROW) + {OFF_TIES}, 3)")
    sql["silver_to_gold_job"] = (
        f"SELECT symbol, datetime, year, {mean.format(9)} AS SMA_10_close, {mean.format(199)} AS SMA_200_close FROM ({silver})")
    sql["replace_partition"] = (
        "SELECT substring(symbol, 1, 1) AS coin, CAST(year(datetime) AS INT) AS year, count(*) AS n_rows, "
        "round(sum(CASE WHEN symbol = '5-LOW' AND year(datetime) = 1996 THEN volume / 10 ELSE volume END), 6) AS sum_volume "
        f"FROM ({_DAILY}) GROUP BY 1, 2")
    sql["ema_recursive"] = _ema_recursive_sql(_HOURLY, "close", EMA_PERIODS, "datetime")
    sql["ema_recursive_cut"] = _ema_recursive_sql(_GAPPY, "price", (3, 10), "ts, event_id")
    sql["rsi_wilder"] = _rsi_wilder_sql(_HOURLY, RSI_PERIODS)
    sql["price_alerts_ordered"] = (
        f"SELECT * REPLACE (round(change, 9) AS change) FROM ({_ALERTS}) WHERE ts <= (SELECT max(ts) - INTERVAL 5 HOUR FROM events)")
    sql["bars_live"] = _HOURLY
    sql["gap_fill_week"] = (
        "SELECT * REPLACE (round(coalesce(close, avg(close) OVER (PARTITION BY symbol ORDER BY datetime RANGE BETWEEN "
        f"INTERVAL 7 DAY PRECEDING AND INTERVAL 7 DAY FOLLOWING)), 6) AS close) FROM (SELECT * REPLACE (CASE WHEN {day} % 9 <> 0 "
        f"THEN close END AS close) FROM ({_DAILY}))")
    sql["update_gold_job"] = (
        "SELECT substring(symbol, 1, 1) AS coin, year, count(*) AS n_rows, round(sum(average), 3) AS sum_average, "
        "(SELECT count(DISTINCT symbol) FROM (" + _DAILY + ") WHERE year = 1997) AS n_written FROM (SELECT *, avg(close) OVER "
        "(PARTITION BY symbol, year ORDER BY datetime ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS average "
        f"FROM ({_DAILY})) GROUP BY 1, 2")
    text = "* REPLACE (strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts)"
    sql["row_numbers_text_key"] = f"SELECT {text} FROM ({row_numbers_sql})"
    sql["last_n_text_key"] = f"SELECT {text} FROM ({sql['last_n_ticks']})"
    sql["gap_fill_text_key"] = f"SELECT {text} FROM ({gap_fill_sql})"
    if _documents:
        sql |= _documents.ORACLE_SQL
    if _pipeline and _pipeline.ORACLE_SQL:
        sql["pipeline"] = _pipeline.ORACLE_SQL
    return sql
