"""The bar schema and the fixed output names built on it."""

from pyspark.sql import types as T

PRICES = ("open", "high", "low", "close")
MEASURES = (*PRICES, "volume")
BAR_COLUMNS = ("datetime", "symbol", *MEASURES)

# Text files carry the timestamp as text; `typed_bars` turns it into a timestamp.
BAR_TEXT_SCHEMA = T.StructType(
    [T.StructField("datetime", T.StringType()), T.StructField("symbol", T.StringType())]
    + [T.StructField(name, T.DoubleType()) for name in MEASURES]
)

# A variant without the timestamp, which appears in `;`-separated files.
UNDATED_TEXT_SCHEMA = T.StructType(BAR_TEXT_SCHEMA.fields[1:])

# The indicator periods of the gold table.
SMA_PERIODS = (10, 50, 100, 200)
EMA_PERIODS = (10, 50, 100, 200)
RSI_PERIODS = (14, 21)
MACD_PERIODS = (12, 26, 9)

TABLE_PREFIX = "trade_data_"


def bar_order(columns):
    """Sort key of a bar series: time first, then the measures, so that ties sort the same way
    on every run (rows equal in all of these are interchangeable)."""
    return tuple(c for c in ("datetime", "close", "open", "high", "low", "volume") if c in columns)
