"""Live bars. The lateness rule is this package's own."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import INTERVALS, number, sort_rank, without_nan
from ..operators.bars import bar_states, finished_bars, merged_states
from ..plans.durable import removed


def stream_bars(stream: DataFrame, interval: str, *, price="price", volume=None, ts="ts",
                by=("symbol",), order=None, delay="10 minutes") -> DataFrame:
    """Bars of a tick stream, each emitted once, when no tick up to `delay` late can change it.

    Ticks later than that are dropped. Months vary in length and are not available. `order` and
    `volume` are those of `bars`, and ticks without a price take no part, as there.
    """
    width = INTERVALS[interval]
    if width == "month":
        raise ValueError("a stream has no bars of varying length")
    # Windows are aligned to 1970-01-01, a Thursday; weeks start on Monday, four days later.
    length, offset = ("7 days", "4 days") if width == "week" else (width, "0 seconds")
    rank = sort_rank(stream, order) if order else F.col(ts).cast("timestamp")
    timed = (
        stream.withColumn("_rank", rank).withColumn("_price", without_nan(number(price)))
        .withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
        .where(F.col("_price").isNotNull())
    )
    traded = F.count("*") if volume is None else F.sum(volume)
    return (
        timed.groupBy(*by, F.window(ts, length, startTime=offset).alias("_window"))
        .agg(
            F.min_by("_price", "_rank").alias("open"),
            F.max("_price").alias("high"),
            F.min("_price").alias("low"),
            F.max_by("_price", "_rank").alias("close"),
            traded.cast("double").alias("volume"),
        )
        .select(*by, F.col("_window.start").alias("datetime"),
                "open", "high", "low", "close", "volume")
    )


def start_live_bars(stream: DataFrame, interval: str, out: str, checkpoint: str, *, price="price", volume=None,
                    ts="ts", by=("symbol",), order=None, trigger=None) -> StreamingQuery:
    """Keeps bars that take in every tick, however late. Starts a query.

    Micro-batch n writes the states of its own bars to `<out>/batch=<n>`, over what an earlier attempt left there, so a
    batch counts once; nothing is read or kept in memory from batch to batch. `read_live_bars` merges them.
    """
    def write(ticks: DataFrame, batch: int) -> None:
        states = bar_states(ticks, interval, price=price, volume=volume, ts=ts, by=by, order=order)
        states.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def read_live_bars(spark: SparkSession, out: str, by=("symbol",)) -> DataFrame:
    """The bars of all ticks that have arrived so far."""
    return finished_bars(spark.read.parquet(out).drop("batch"), by)


def compact_live_bars(spark: SparkSession, out: str, by=("symbol",)) -> None:
    """Merges all batches but the last into that before it, so that readers have fewer files. The query must not run meanwhile."""
    batches = sorted(row["batch"] for row in spark.read.parquet(out).select("batch").distinct().collect())
    if len(batches) < 3:
        return
    merged, into = f"{out.rstrip('/')}-merged", f"{out.rstrip('/')}/batch={batches[-2]}"
    old = spark.read.parquet(out).where(F.col("batch") < batches[-1]).drop("batch")
    merged_states(old, by).write.mode("overwrite").parquet(merged)
    spark.read.parquet(merged).write.mode("overwrite").parquet(into)
    removed(spark, *[f"{out.rstrip('/')}/batch={b}" for b in batches[:-2]], merged)
