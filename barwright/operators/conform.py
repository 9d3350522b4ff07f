"""Bringing arbitrary bar tables to the bar schema."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import number, without_nan
from ..schema import BAR_COLUMNS, MEASURES

_NUMERIC = (T.DoubleType, T.LongType)


def numeric_columns(df: DataFrame) -> list[str]:
    """The 64-bit floating and whole-number columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def floating_columns(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))}


def numbers_as_doubles(df: DataFrame) -> DataFrame:
    """Casts numeric columns to double; all others are unchanged."""
    numeric = set(numeric_columns(df))
    return df.select(*[number(c).alias(c) if c in numeric else F.col(c) for c in df.columns])


def conform(df: DataFrame, symbol: str | Column | None = None) -> DataFrame:
    """The bar columns in order, then any others.

    Without a `symbol` column the upper-cased `symbol` argument (a name or a column) or the
    `coin` column takes its place. Missing measures become NULL doubles, measures are cast to
    double (what does not parse becomes NULL), NaN becomes NULL. `datetime` is required.
    """
    if "datetime" not in df.columns:
        raise ValueError("the bars have no 'datetime' column")
    present = set(df.columns)

    def column(name):
        if name in MEASURES:
            if name not in present:
                return F.lit(None).cast("double").alias(name)
            return without_nan(number(name)).alias(name)
        if name == "symbol" and name not in present:
            if symbol is None and "coin" not in present:
                raise ValueError("the bars have no 'symbol' column and none was given")
            source = F.col("coin") if symbol is None else symbol
            return F.upper(F.lit(source)).alias(name)
        return F.col(name)

    others = [c for c in df.columns if c not in BAR_COLUMNS]
    return df.select(*[column(c) for c in BAR_COLUMNS], *others)


def dated(df: DataFrame) -> DataFrame:
    """Rows with a timestamp, with the whole-number `year` they belong to."""
    return df.where(F.col("datetime").isNotNull()).withColumn("year", F.year("datetime"))


def undated(df: DataFrame) -> DataFrame:
    """Rows without a timestamp, for quarantine; they belong to no year."""
    return df.where(F.col("datetime").isNull())


def of_year(df: DataFrame, year: int) -> DataFrame:
    return df.where(F.col("year") == year)


def years(df: DataFrame) -> DataFrame:
    """The distinct years, without the undated."""
    return dated(df).select("year").distinct()
