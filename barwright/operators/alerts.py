"""Significant price changes. The definition is this package's own."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import number, without_nan
from ..plans.blocks import Blocks, as_series


def change_from(price, previous):
    """Relative change; NULL without a previous price or from a price of zero."""
    return F.try_divide(price, previous) - 1


def price_alerts(df: DataFrame, threshold: float, *, price="price", by=("symbol",),
                 order=("ts",), blocks: Blocks | None = None) -> DataFrame:
    """Ticks whose price differs from that of the tick before by `threshold` or more, relatively.

    A missing price, NaN included, raises no alert, neither its own nor the next tick's. Without
    `blocks` a whole series is one task's work; measure blocks where a symbol may hold most ticks.
    """
    series = as_series(df, by, order, reads=[price], back=1, blocks=blocks)
    known = without_nan(number(price))
    moved = series.frame.withColumn("previous", F.lag(known).over(series.spec))
    moved = series.own(moved, [*df.columns, "previous"])
    return moved.withColumn("change", change_from(known, F.col("previous"))).where(
        F.abs("change") >= threshold)
