"""Tables that outlive an executor, in the folder the cluster shares."""

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Folders written by `cut` in the innermost open `dropped` block of a thread; other threads have blocks of their own.
_open: ContextVar[list[str] | None] = ContextVar("_open", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, from `spark.checkpoint.dir`.

    A private temporary folder stands in only in local mode, where driver and executors share
    one disk; on a cluster an unset folder is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
            folder = tempfile.mkdtemp(prefix="barwright-")
        context.setCheckpointDir(folder)
    return folder or context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared folder; nothing is created yet."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name="cut") -> DataFrame:
    """Runs `df` once, keeps its rows as a table in the shared folder and reads that from then on.

    A written table costs one run, where a reliable checkpoint costs two unless the rows are
    cached as well, and it tells the optimizer its true size. The folder stays until the reader
    is done: wrap the work in `dropped`, or remove the folder with the application's scratch.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    if (written := _open.get()) is not None:
        written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, *paths: str) -> None:
    """Removes folders this package has written; missing ones are no error."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def dropped(spark: SparkSession):
    """Removes what `cut` writes inside the block, in this thread, when the block ends; results must be
    written by then."""
    written: list[str] = []
    before = _open.set(written)
    try:
        yield
    finally:
        _open.reset(before)
        removed(spark, *written)
