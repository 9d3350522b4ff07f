"""Bars from ticks, and wider bars from narrower ones."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bar_start, number, sort_rank, width_divides, without_nan


def bars(df: DataFrame, interval: str, *, price="price", volume=None, ts="ts", by=("symbol",),
         order=None) -> DataFrame:
    """Open, high, low, close and volume of each `interval`; `volume` defaults to tick counts.

    Ticks are partly aggregated before the shuffle, so a symbol with most of the ticks costs no
    more than one with few. `order` picks the first and last tick; it defaults to `ts` and may
    name further columns to break ties. Ticks without a price, NaN included, take no part: they
    set no open or close, do not count, and their volume is left out.
    """
    start = bar_start(ts, interval, df.schema[ts].dataType.simpleString())
    traded = F.count("*") if volume is None else F.sum(volume)
    kept = dict.fromkeys([*by, *([] if volume is None else [volume])])
    ticks = df.where(F.col(ts).isNotNull()).select(
        *kept, without_nan(number(price)).alias("_price"), start.alias("_start"),
        (sort_rank(df, order) if order else F.col(ts)).alias("_rank"))
    return ticks.where(F.col("_price").isNotNull()).groupBy(
        *by, F.col("_start").alias("datetime")).agg(
        F.min_by("_price", "_rank").alias("open"),
        F.max("_price").alias("high"),
        F.min("_price").alias("low"),
        F.max_by("_price", "_rank").alias("close"),
        traded.cast("double").alias("volume"),
    )


def bar_states(df: DataFrame, interval: str, *, price="price", volume=None, ts="ts", by=("symbol",),
               order=None) -> DataFrame:
    """Bars that can still be merged with others of the same interval: `opened` and `closed` say where in `order` the
    first and last price stand. The parameters are those of `bars`."""
    start = bar_start(ts, interval, df.schema[ts].dataType.simpleString())
    traded = F.count("*") if volume is None else F.sum(volume)
    kept = dict.fromkeys([*by, *([] if volume is None else [volume])])
    rank = sort_rank(df, order or (ts,))
    ticks = df.where(F.col(ts).isNotNull()).select(
        *kept, without_nan(number(price)).alias("_price"), start.alias("datetime"), rank.alias("_rank"))
    return ticks.where(F.col("_price").isNotNull()).groupBy(*by, "datetime").agg(
        F.min_by("_price", "_rank").alias("open"), F.min("_rank").alias("opened"),
        F.max("_price").alias("high"), F.min("_price").alias("low"),
        F.max_by("_price", "_rank").alias("close"), F.max("_rank").alias("closed"),
        traded.cast("double").alias("volume"))


def merged_states(states: DataFrame, by=("symbol",)) -> DataFrame:
    """One state of each bar from those of parts of its ticks, in whichever order they were seen."""
    return states.groupBy(*by, "datetime").agg(
        F.min_by("open", "opened").alias("open"), F.min("opened").alias("opened"), F.max("high").alias("high"),
        F.min("low").alias("low"), F.max_by("close", "closed").alias("close"), F.max("closed").alias("closed"),
        F.sum("volume").alias("volume"))


def finished_bars(states: DataFrame, by=("symbol",)) -> DataFrame:
    """The bars of states that may belong together."""
    return merged_states(states, by).drop("opened", "closed")


def rebar(df: DataFrame, interval: str, *, by=("symbol",), source: str | None = None) -> DataFrame:
    """Wider bars from narrower ones; bars without a time are left out.

    `source` is the interval of `df`; where it is given and its bars can lie across the ends of
    wider ones, this fails.
    """
    if source is not None and not width_divides(source, interval):
        raise ValueError(f"bars of {source} do not fit into bars of {interval}")
    start = bar_start("datetime", interval, df.schema["datetime"].dataType.simpleString())
    opened, closed = (F.when(F.col(c).isNotNull(), F.col("datetime")) for c in ("open", "close"))
    return (
        df.where(F.col("datetime").isNotNull()).groupBy(*by, start.alias("_start"))
        .agg(
            F.min_by("open", opened).alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", closed).alias("close"),
            F.sum("volume").alias("volume"),
        )
        .withColumnRenamed("_start", "datetime")
    )
