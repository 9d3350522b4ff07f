"""Partitioned file output."""

from pyspark.sql import DataFrame

PARTITIONS = ("coin", "year")
ROWS_PER_FILE = 20_000_000


def write_partitioned(df: DataFrame, path: str, *, partitions=PARTITIONS, format="parquet",
                      replace="all", gather=True, **options) -> None:
    """Writes `df` below `path`, one folder per partition. Runs a Spark job.

    `replace="all"` overwrites the whole tree, `replace="present"` only partitions `df` has rows
    for. `gather` first brings each partition's rows together, so that folders hold few files;
    it balances by measured size, so a partition holding most rows is spread over several tasks.
    Turn it off where the rows are gathered already, as after a window over the partitions.
    """
    modes = {"all": "static", "present": "dynamic"}
    rows = df.hint("rebalance", *partitions) if gather else df
    (
        rows.write.format(format).mode("overwrite")
        .option("partitionOverwriteMode", modes[replace])
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .options(**options)
        .partitionBy(*partitions)
        .save(path)
    )
