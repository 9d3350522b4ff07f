"""Bars inside vendor messages."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import number, number_or_zero
from ..schema import BAR_COLUMNS, PRICES

# The bar list inside a message, and its shape. Values are read as text so that
# one bad number spoils neither its bar nor the list.
_BAR_LIST = r'"s":\[(.+?)\}\]'
_BAR_LIST_TYPE = "array<struct<i: int, v: array<string>>>"


def decode_messages(df: DataFrame, message="message") -> DataFrame:
    """One row per bar of the first bar list in each message; `df` names the `symbol`.

    Times are epoch seconds, read as UTC. A missing volume is 0.0, a missing or unreadable price
    is NULL. Messages without bars give no rows.
    """
    listed = F.concat(F.lit("["), F.regexp_extract(message, _BAR_LIST, 1), F.lit("}]"))
    bar = df.select("symbol", F.explode(F.from_json(listed, _BAR_LIST_TYPE)).alias("_bar"))

    def value(position):
        return F.get("_bar.v", F.lit(position))

    return bar.select(
        F.timestamp_seconds(number(value(0))).alias("datetime"),
        "symbol",
        *[number(value(k)).alias(name) for k, name in enumerate(PRICES, start=1)],
        number_or_zero(value(len(PRICES) + 1)).alias("volume"),
    ).select(*BAR_COLUMNS)
