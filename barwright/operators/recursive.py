"""Averages in which every row builds on the one before: the textbook EMA and Wilder's RSI.

An average with a share `a` of the newest value is an affine map of the one before, (1 - a) x + a v. Maps of neighbouring rows are
composed in rounds, each over twice as many rows as the one before (a prefix scan), with one column and one lag a round: after k
rounds a row holds the composition of the last 2^k maps. Older values have a weight below 2^-110, less than
rounding leaves of them, so some log2(76 / a) rounds do, and a row never needs more than the rows of those rounds.
Nothing is subtracted, so no precision is lost.

Long series are dealt out by row number: a chunk of rows is one task's, and borrows the rows its first ones need from the
chunk before. That takes no second read, and no measuring beyond that for the row numbers.

Rows without a value, NaN included, take no part: they have no average, and the next one builds on the row before them.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import number, without_nan
from ..plans.blocks import OWN, Blocks, numbered
from ..schema import EMA_PERIODS, RSI_PERIODS, bar_order

#: Rows of a chunk of a long series.
CHUNK_ROWS = 1_000_000
#: Binary digits beyond which the weight of a value is nothing.
_DIGITS = 110


def _rounds(share: float) -> int:
    """Rounds after which all values that count are in."""
    if share >= 1:
        return 0
    return math.ceil(math.log2(max(2.0, _DIGITS * math.log(2) / -math.log1p(-share))))


def _smoothed(df: DataFrame, spec, terms: dict[str, float]) -> DataFrame:
    """Each column of `terms` replaced by the sum of its values so far, weighted by (1 - share) to the power of their distance."""
    for k in range(max(_rounds(share) for share in terms.values())):
        now = {c: share for c, share in terms.items() if k < _rounds(share)}
        more = {c: F.lag(c, 2**k, 0.0).over(spec) * F.lit((1 - share) ** 2**k) for c, share in now.items()}
        df = df.select(*[(F.col(c) + more[c]).alias(c) if c in now else F.col(c) for c in df.columns])
    return df


def _chunked(df: DataFrame, value: str, by, order, blocks: Blocks | None, reach: int, chunk_rows: int):
    """Rows with a value, their number `_row` in the series, and the window over a series or over its chunks."""
    known = without_nan(number(value))
    rows = numbered(df.withColumn("_value", known).where(F.col("_value").isNotNull()), by, order, "_row", blocks)
    if blocks is None or not blocks.cuts:
        return rows.withColumn(OWN, F.lit(True)), Window.partitionBy(*by).orderBy(*order)
    size = max(chunk_rows, reach)
    chunk, place = F.floor((F.col("_row") - 1) / size), F.pmod(F.col("_row") - 1, F.lit(size))
    lent = F.when(place >= size - reach, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    rows = rows.withColumn("_own_chunk", chunk).withColumn("_chunk", F.explode(lent)).withColumn(
        OWN, F.col("_chunk") == F.col("_own_chunk"))
    return rows, Window.partitionBy(*by, "_chunk").orderBy("_row")


def _term(value: Column, spec, first: int, share: float) -> Column:
    """What a row adds: nothing before row `first`, the mean so far there, and its share of the value from then on."""
    sofar = spec.rowsBetween(Window.unboundedPreceding, 0)
    row = F.col("_row")
    begun = F.avg(F.when(row <= first, value)).over(sofar)
    return F.when(row < first, 0.0).when(row == first, begun).otherwise(value * share)


def _with_rest(df: DataFrame, own: DataFrame, value: str, names) -> DataFrame:
    rest = df.where(without_nan(number(value)).isNull())
    return own.select(*df.columns, *names).unionByName(rest.select("*", *[F.lit(None).cast("double").alias(n) for n in names]))


def recursive_ema(df: DataFrame, value="close", periods=EMA_PERIODS, *, by=("symbol",), order=None,
                  blocks: Blocks | None = None, chunk_rows=CHUNK_ROWS) -> DataFrame:
    """Adds `EMA_recursive_<n>_<value>`: from row n, where it is the mean of the first n rows, each row blends its value with the
    average of the row before by 2 / (n + 1).

    `blocks`, from `measure_blocks`, cuts series too long for one task.
    """
    order = tuple(order or (blocks.order if blocks else bar_order(df.columns)))
    shares = {f"_ema_{n}": 2.0 / (n + 1) for n in periods}
    reach = max(2 ** max(map(_rounds, shares.values())), *periods)
    rows, spec = _chunked(df, value, by, order, blocks, reach, chunk_rows)
    terms = rows.select("*", *[_term(F.col("_value"), spec, n, 2.0 / (n + 1)).alias(f"_ema_{n}") for n in periods])
    found = _smoothed(terms, spec, shares).where(OWN)
    names = {n: f"EMA_recursive_{n}_{value}" for n in periods}
    found = found.select("*", *[F.when(F.col("_row") >= n, F.col(f"_ema_{n}")).alias(name) for n, name in names.items()])
    return _with_rest(df, found, value, names.values())


def wilder_rsi(df: DataFrame, value="close", periods=RSI_PERIODS, *, by=("symbol",), order=None,
               blocks: Blocks | None = None, chunk_rows=CHUNK_ROWS) -> DataFrame:
    """Adds `RSI_wilder_<n>_<value>`: gains and losses are averaged with a share of 1 / n, beginning with the mean of the first n
    changes at row n + 1. 100 where there was no loss, or none that still counts."""
    order = tuple(order or (blocks.order if blocks else bar_order(df.columns)))
    shares = {f"_{kind}_{n}": 1.0 / n for n in periods for kind in ("gain", "loss")}
    reach = max(2 ** max(map(_rounds, shares.values())), *periods) + 1
    rows, spec = _chunked(df, value, by, order, blocks, reach, chunk_rows)
    rows = rows.withColumn("_change", F.col("_value") - F.lag("_value").over(spec))
    gain, loss = F.greatest(F.col("_change"), F.lit(0.0)), F.greatest(-F.col("_change"), F.lit(0.0))
    moves = [(n, kind, F.when(F.col("_change").isNotNull(), c)) for n in periods for kind, c in (("gain", gain), ("loss", loss))]
    # the borrowed row a chunk begins with has no change in it; what it would add no longer counts
    terms = rows.select("*", *[F.coalesce(_term(c, spec, n + 1, 1.0 / n), F.lit(0.0)).alias(f"_{kind}_{n}") for n, kind, c in moves])
    found = _smoothed(terms, spec, shares).where(OWN)
    names = {n: f"RSI_wilder_{n}_{value}" for n in periods}
    found = found.select("*", *[
        F.when(F.col("_row") > n, F.when(F.col(f"_loss_{n}") == 0, 100.0).otherwise(
            100 - 100 / (1 + F.col(f"_gain_{n}") / F.col(f"_loss_{n}")))).alias(name) for n, name in names.items()])
    return _with_rest(df, found, value, names.values())
