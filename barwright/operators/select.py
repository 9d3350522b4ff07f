"""First, last and latest bars."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.blocks import newest_spans
from ..schema import bar_order

# Parts a series is spread over before its latest rows are picked.
SALTS = 64


def head_bars(df: DataFrame, n=5, order=None) -> DataFrame:
    """The first n rows; every task keeps only its own first n."""
    return df.orderBy(*(order or bar_order(df.columns))).limit(n)


def tail_bars(df: DataFrame, n=5, order=None) -> DataFrame:
    """The last n rows, latest first."""
    return df.orderBy(*[F.col(c).desc() for c in order or bar_order(df.columns)]).limit(n)


def last_n_bars(df: DataFrame, n: int, *, by=("symbol",), order=None, salts=SALTS) -> DataFrame:
    """The latest n rows of every series. Runs counting jobs.

    Rows are counted by span of the sort key, and only the newest spans that hold n rows of their
    series are shuffled, whatever n is. Those are ranked in two rounds, each salted part of a
    series first, then the series. Times, numbers and text have spans; all rows are shuffled for sort keys that start
    with anything else.
    """
    order = list(order or bar_order(df.columns))
    latest = [F.col(c).desc() for c in order]
    recent = newest_spans(df, by, order, n)
    salted = recent.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    for keys in ([*by, "_salt"], [*by]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*latest))
        salted = salted.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
    return salted.select(*df.columns)
