"""How much of each column is missing."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import missing
from .conform import floating_columns


def missing_profile(df: DataFrame, columns=None, *, by=()) -> DataFrame:
    """Per column: rows missing, their percentage, and the total missing over all columns.

    With `by` per group as well, such as a file or a series. One pass over the table, partly
    aggregated before it moves; NaN counts as missing. An empty table has NULL percentages.
    """
    by = list(by)
    columns = list(columns or [c for c in df.columns if c not in by])
    floating = floating_columns(df)
    counts = [F.count_if(missing(c, c in floating)).alias(f"_{i}") for i, c in enumerate(columns)]
    total = sum((F.col(f"_{i}") for i in range(len(columns))), F.lit(0).cast("bigint"))
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("missing"),
                 F.try_divide(F.col(f"_{i}") * 100.0, F.col("_rows").cast("double"))
                 .alias("percent"),
                 total.alias("total_missing"))
        for i, c in enumerate(columns)
    ]
    counted = df.groupBy(*by).agg(F.count("*").alias("_rows"), *counts)
    return counted.select(*by, F.inline(F.array(*entries)))
