"""Market performance per symbol and period. The definitions are this package's own."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bar_start, sort_rank
from ..plans.blocks import Blocks, as_series


def market_report(df: DataFrame, interval="1M", *, by=("symbol",), order=("datetime",),
                  blocks: Blocks | None = None) -> DataFrame:
    """Per series and period: bars, first and last close and the return between them, high, low,
    mean volume, and the standard deviation of bar-to-bar returns.

    Returns look one bar back, also across a period's start. A period's rows are partly
    aggregated before they move.
    """
    start = bar_start("datetime", interval, df.schema["datetime"].dataType.simpleString())
    series = as_series(df, by, order, reads=["close"], back=1, blocks=blocks)
    change = F.try_divide("close", F.lag("close").over(series.spec)) - 1
    moves = series.own(series.frame.withColumn("_return", change), [*df.columns, "_return"])
    moves = moves.withColumn("_rank", sort_rank(moves, order))
    first, last = F.min_by("close", "_rank"), F.max_by("close", "_rank")
    return moves.groupBy(*by, start.alias("period")).agg(
        F.count("*").alias("n_bars"),
        first.alias("first_close"),
        last.alias("last_close"),
        (F.try_divide(last, first) - 1).alias("period_return"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.avg("volume").alias("mean_volume"),
        F.stddev_samp("_return").alias("volatility"),
    )
