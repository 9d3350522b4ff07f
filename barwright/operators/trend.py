"""Trend flags on top of the indicators. The definitions are this package's own."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .indicators import add_indicators


def _turn(before, now):
    """1 where a difference turns positive, -1 where it turns negative, else 0."""
    return (F.when((before <= 0) & (now > 0), 1)
            .when((before >= 0) & (now < 0), -1)
            .otherwise(0))


def trend_flags(df: DataFrame, value="close", *, fast=50, slow=200, macd=(12, 26, 9),
                by=("symbol", "year"), **options) -> DataFrame:
    """Adds whether the price is above its slow average, and on which rows the fast average
    crosses the slow one and the MACD line crosses zero (1 upwards, -1 downwards, else 0)."""
    fast_name, slow_name = f"SMA_{fast}_{value}", f"SMA_{slow}_{value}"
    line = f"MACD_line_{value}"

    def flags(row_before):
        return {
            f"above_SMA_{slow}": F.col(value) > F.col(slow_name),
            "SMA_cross": _turn(row_before(fast_name) - row_before(slow_name),
                               F.col(fast_name) - F.col(slow_name)),
            "MACD_cross": _turn(row_before(line), F.col(line)),
        }

    return add_indicators(df, value, sma=(fast, slow), macd=macd, by=by, crossings=flags,
                          **options)
