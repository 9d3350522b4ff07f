"""Filling gaps with a centred moving mean."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import DAY_MICROS, epoch_micros, finite, without_nan
from ..plans.blocks import Blocks, as_series
from ..schema import MEASURES
from .conform import floating_columns, numeric_columns

# Rows on either side of a gap that its mean looks at.
SIDE_ROWS = 3


def fill_gaps(df: DataFrame, columns=None, *, by=("symbol",), order=("datetime",),
              side=SIDE_ROWS, blocks: Blocks | None = None) -> DataFrame:
    """Replaces missing numbers by the mean of the finite original values among the `side` rows
    before and after; a gap with none stays NULL. Infinite values are kept but not averaged.

    Columns to fill become doubles, all others are unchanged. By default these are the measures
    and the other floating columns; whole numbers, which may be identifiers with more digits than
    a double holds, are filled only if named. Filled values feed no further fill. Ties in `order`
    should be broken by a unique column for a repeatable result. Without `blocks` a whole series
    is one task's work; measure blocks where a symbol may hold most rows.
    """
    if columns is None:
        # Measures may break ties and are filled all the same; other sort columns are left alone.
        sorting = {*by, *order} - set(MEASURES)
        wanted = {*floating_columns(df), *set(MEASURES).intersection(numeric_columns(df))}
        columns = [c for c in df.columns if c in wanted and c not in sorting]
    floating = floating_columns(df)
    series = as_series(df, by, order, reads=columns, back=side, ahead=side, blocks=blocks)
    near = series.rows(-side, side)

    def filled(c):
        value = F.col(c).cast("double")
        value = without_nan(value) if c in floating else value
        return F.coalesce(value, F.avg(finite(value)).over(near)).alias(c)

    out = series.frame.select(
        *[filled(c) if c in columns else F.col(c) for c in series.frame.columns])
    return series.own(out, df.columns)


def fill_gaps_within(df: DataFrame, columns, *, days: float, by=("symbol",), ts="datetime", spans_a_chunk=32) -> DataFrame:
    """Replaces missing numbers by the mean of the finite original values less than or exactly `days` days before and after;
    a gap with none stays NULL, as does one in a row without a time.

    Frames are measured in time, however many rows that is, so nothing is counted first: a series is cut into chunks of time, each
    `spans_a_chunk` times as long as a frame reaches, and rows within reach of the next or last chunk are lent to it, with the columns to fill only.
    Spark adds a frame up anew for each row, so the work grows with the rows of a frame.
    """
    floating, reach = floating_columns(df), int(days * DAY_MICROS)
    length = max(1, reach * spans_a_chunk)
    at = epoch_micros(ts, df.schema[ts].dataType)
    chunk = lambda t: F.floor(t / F.lit(length))
    own = df.withColumn("_at", at).withColumn("_chunk", chunk(F.col("_at"))).withColumn("_own", F.lit(True))
    near = F.array_compact(F.array(*[F.when(chunk(F.col("_at") + d) != F.col("_chunk"), chunk(F.col("_at") + d)) for d in (-reach, reach)]))
    lent = (own.select(*dict.fromkeys([*by, *columns]), "_at", near.alias("_near")).withColumn("_chunk", F.explode("_near"))
            .drop("_near").withColumn("_own", F.lit(False)))
    frame = own.unionByName(lent, allowMissingColumns=True)
    around = Window.partitionBy(*by, "_chunk").orderBy("_at").rangeBetween(-reach, reach)

    def filled(c):
        value = F.col(c).cast("double")
        value = without_nan(value) if c in floating else value
        return F.coalesce(value, F.when(F.col("_at").isNotNull(), F.avg(finite(value)).over(around))).alias(c)

    out = frame.select(*[filled(c) if c in columns else F.col(c) for c in frame.columns])
    return out.where("_own").select(*df.columns)
