"""Continuous ingestion into storage."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def start_ingest(stream: DataFrame, path: str, checkpoint: str, *, partitions=(),
                 format="parquet", trigger=None) -> StreamingQuery:
    """Appends the stream to files below `path`, each row once. Starts a query."""
    writer = (
        stream.writeStream.format(format).outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    return (writer.partitionBy(*partitions) if partitions else writer).start(path)
