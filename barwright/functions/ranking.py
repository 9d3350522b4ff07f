"""One sortable value for a sort key of several columns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .intervals import epoch_micros

_WHOLE = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)
# Below every timestamp and every 64-bit number: missing values come first, as in a sort.
_BEFORE_TIMES, _BEFORE_WHOLE = "-999999999999999999", "-9300000000000000000"
# Above the span from there to the largest 64-bit number.
_STEP = "20000000000000000000"


def _decimal(text: str, digits: int) -> Column:
    return F.lit(text).cast(f"decimal({digits},0)")


def sort_rank(df: DataFrame, order) -> Column:
    """A value that sorts as the `order` columns do, ascending.

    A time, a whole number, or a time with a whole-number tie-break become a decimal: an
    aggregation buffer of fixed width keeps the hash aggregate for `max_by` and `min_by`, where a
    struct would force a sort of all rows.
    """
    order = list(order)
    types = [df.schema[c].dataType for c in order]
    time = isinstance(types[0], _TIMES)
    whole = isinstance(types[-1], _WHOLE)
    if time:
        micros = epoch_micros(order[0], types[0]).cast("decimal(18,0)")
        micros = F.coalesce(micros, _decimal(_BEFORE_TIMES, 18))
    if whole:
        number = F.coalesce(F.col(order[-1]).cast("decimal(19,0)"), _decimal(_BEFORE_WHOLE, 19))
    if len(order) == 1 and (time or whole):
        return micros if time else number
    if len(order) == 2 and time and whole:
        return micros * _decimal(_STEP, 20) + number
    return F.struct(*order)
