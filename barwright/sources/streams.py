"""Ticks or bars arriving as files."""

from pyspark.sql import DataFrame, SparkSession

FILES_PER_BATCH = 1_000


def stream_files(spark: SparkSession, path: str, schema, *, format="parquet", glob=None,
                 files_per_batch=FILES_PER_BATCH, **options) -> DataFrame:
    """A stream of the files appearing under `path`; `files_per_batch` bounds a micro-batch, also the
    first one over all files there are (None: no bound)."""
    reader = spark.readStream.format(format).schema(schema).options(**options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
