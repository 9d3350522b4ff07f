"""Missing, non-finite and unparsable numbers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c) -> Column:
    """`c` as a double; NULL where it does not parse."""
    return _col(c).try_cast("double")


def without_nan(c) -> Column:
    """A double with NaN turned into NULL, so that averages skip it."""
    return F.nanvl(_col(c), F.lit(None).cast("double"))


def number_or_zero(c) -> Column:
    """`c` as a double; 0.0 where it is missing or does not parse."""
    return F.coalesce(without_nan(number(c)), F.lit(0.0))


def finite(c) -> Column:
    """`c` where it is a finite number, else NULL (NaN compares above infinity in Spark)."""
    c = _col(c)
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def missing(c, floating: bool) -> Column:
    """Whether `c` is NULL, or NaN when it is a floating-point column."""
    c = _col(c)
    return (c.isNull() | F.isnan(c)) if floating else c.isNull()
