"""Bar widths and the start of the bar a timestamp falls into."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_MICROS = 86_400_000_000

# Interval codes and the bar width each stands for.
INTERVALS = {
    "1": "1 minute",
    "3": "3 minutes",
    "5": "5 minutes",
    "15": "15 minutes",
    "30": "30 minutes",
    "45": "45 minutes",
    "1H": "1 hour",
    "2H": "2 hours",
    "3H": "3 hours",
    "4H": "4 hours",
    "1D": "1 day",
    "1W": "week",
    "1M": "month",
}


def bar_start(ts, interval: str, data_type: str) -> Column:
    """Start of the `interval` bar holding `ts`, as `data_type` (the type of `ts`).

    Widths up to a day divide the day, so epoch-aligned tumbling windows are right for them.
    Weeks start on Monday and months vary in length, so both truncate the calendar date.
    """
    if interval not in INTERVALS:
        raise ValueError(f"unknown interval {interval!r}; expected one of {sorted(INTERVALS)}")
    column = F.col(ts) if isinstance(ts, str) else ts
    width = INTERVALS[interval]
    if width in ("week", "month"):
        return F.trunc(column.cast("date"), width).cast(data_type)
    return F.window(column, width)["start"].cast(data_type)


def width_divides(narrow: str, wide: str) -> bool:
    """Whether every bar of `narrow` lies inside one bar of `wide`."""
    minutes = {"minute": 1, "minutes": 1, "hour": 60, "hours": 60, "day": 1440}

    def length(interval):
        parts = INTERVALS[interval].split()
        return int(parts[0]) * minutes[parts[1]] if len(parts) == 2 else None

    inner, outer = length(narrow), length(wide)
    if outer is None:  # weeks and months consist of days
        return narrow == wide or inner is not None and 1440 % inner == 0
    return inner is not None and outer % inner == 0


def epoch_micros(name: str, data_type: T.DataType) -> Column:
    """Microseconds since 1970, never through the session time zone for zone-less types."""
    c = F.col(name)
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(data_type, T.DateType):
        return F.unix_date(c) * F.lit(DAY_MICROS)
    since = c - F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    return F.call_function("div", since, F.expr("INTERVAL '0.000001' SECOND"))
