"""The batch jobs from text files to the gold table. Each function runs Spark jobs."""

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.conform import conform, dated, undated
from ..operators.fill import fill_gaps
from ..operators.indicators import gold
from ..operators.profile import missing_profile
from ..schema import MEASURES, bar_order
from ..sinks import write_partitioned
from ..sources import read_bars_csv, read_bars_parquet, typed_bars
from .blocks import TARGET_ROWS, measure_blocks
from .durable import cut, dropped, removed

_FILE = "_bronze_file"


def bronze_to_silver(spark: SparkSession, bronze: str, silver: str, quarantine: str,
                     *, sep=",", replace="present", profile: str | None = None, unread: str | None = None,
                     target_rows=TARGET_ROWS) -> None:
    """Reads the CSV tree, fills gaps per coin and symbol across year ends, and writes Parquet
    by coin and year.

    Columns are bound by each file's header, and further columns are carried along as text. Files that cannot be bound
    fail the job, or go to `unread`, line by line (see `read_bars_csv`). Rows
    without a readable timestamp go to `quarantine`, which a run overwrites. `replace="present"` replaces the coins
    and years the bronze tree has rows for and leaves all others; a coin and year is replaced
    whole, so bronze must hold all of its rows. `replace="all"` replaces the tree. `profile`
    names a folder for the missing-data profile per coin, symbol and file, taken before the fill.
    """
    # The text is parsed once; profile, measuring and fill read the typed copy.
    with dropped(spark):
        raw = read_bars_csv(spark, bronze, sep=sep, unread=unread, file=True).withColumnRenamed("file", _FILE)
        raw = cut(conform(typed_bars(raw)), "bronze")
        by = ("coin", "symbol")
        if profile:
            columns = [c for c in raw.columns if c not in (*by, _FILE)]
            found = missing_profile(raw, columns, by=(*by, _FILE)).withColumnRenamed(_FILE, "file")
            found.write.mode("overwrite").parquet(profile)
        raw = raw.drop(_FILE)
        undated(raw).write.mode("overwrite").parquet(quarantine)
        bars = dated(raw)
        order = bar_order(bars.columns)
        blocks = measure_blocks(bars, by, order, target_rows)
        write_partitioned(fill_gaps(bars, MEASURES, by=by, order=order, blocks=blocks), silver,
                          replace=replace)


def silver_to_gold(spark: SparkSession, silver: str, gold_path: str, *, coins=None, years=None,
                   target_rows=TARGET_ROWS) -> None:
    """Adds the indicators to every symbol and year in one job and replaces the partitions
    written. The windows leave each coin and year together, so no further shuffle follows."""
    bars = conform(read_bars_parquet(spark, silver, coins=coins, years=years),
                   symbol=F.col("coin"))
    by, order = ("coin", "symbol", "year"), bar_order(bars.columns)
    blocks = measure_blocks(bars, by, order, target_rows)
    write_partitioned(gold(bars, by=by, order=order, blocks=blocks), gold_path,
                      replace="present", gather=False)


def _partition_states(spark: SparkSession, silver: str):
    """coin, year and a fingerprint of the names, sizes and times of the files of every partition; reads no column."""
    files = read_bars_parquet(spark, silver).select(
        F.col("coin").cast("string").alias("coin"), "year", F.col("_metadata.file_path").alias("file"),
        F.struct("_metadata.file_size", "_metadata.file_modification_time").alias("state"))
    # a file is one row here before its rows are shuffled
    files = files.groupBy("coin", "year", "file").agg(F.max("state").alias("state"))
    state = F.xxhash64("file", "state").cast("decimal(38,0)")
    return files.groupBy("coin", "year").agg(F.concat_ws("-", F.count("*"), F.sum(state)).alias("fingerprint"))


def update_gold(spark: SparkSession, silver: str, gold_path: str, ledger: str, *, target_rows=TARGET_ROWS) -> int:
    """Computes gold for the coins and years whose silver files have changed since the last update, and removes
    those that are gone; returns how many partitions were written or removed.

    `ledger` is a folder that holds what each coin and year was computed from, one folder a run. Indicators restart every year, so a
    partition depends on its own rows only. The ledger is written last: a run that ends early is done again.
    """
    with dropped(spark):
        now = cut(_partition_states(spark, silver), "states")
        runs = _runs(spark, ledger)
        if runs:
            before = spark.read.parquet(f"{ledger}/run={runs[-1]}").withColumnRenamed("fingerprint", "old")
        else:
            before = now.limit(0).withColumnRenamed("fingerprint", "old")
        changed = cut(now.join(before, ["coin", "year"], "full").where(~F.col("fingerprint").eqNullSafe(F.col("old"))), "changed")
        n = changed.count()
        if not n:
            return 0
        todo = changed.where("fingerprint is not null").select(F.col("coin").alias("_coin"), F.col("year").alias("_year"))
        bars = read_bars_parquet(spark, silver)
        # partitions that did not change are pruned by the list of those that did
        bars = bars.join(F.broadcast(todo), (F.col("coin").cast("string") == F.col("_coin")) & (F.col("year") == F.col("_year")), "left_semi")
        bars = conform(bars, symbol=F.col("coin"))
        by, order = ("coin", "symbol", "year"), bar_order(bars.columns)
        if not todo.isEmpty():
            blocks = measure_blocks(bars, by, order, target_rows)
            write_partitioned(gold(bars, by=by, order=order, blocks=blocks), gold_path, replace="present", gather=False)
        gone = changed.where("fingerprint is null").select("coin", "year").toLocalIterator()
        removed(spark, *[f"{gold_path.rstrip('/')}/coin={row['coin']}/year={row['year']}" for row in gone])
        now.write.mode("overwrite").parquet(f"{ledger}/run={runs[-1] + 1 if runs else 0}")
    removed(spark, *[f"{ledger}/run={run}" for run in runs])
    return n


def _runs(spark: SparkSession, ledger: str) -> list[int]:
    """Numbers of the finished runs in a ledger."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    paths = [f.getPath() for f in files.listStatus(folder)]
    return sorted(int(p.getName().split("=")[1]) for p in paths if p.getName().startswith("run=")
                  and files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))
