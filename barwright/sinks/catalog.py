"""Registering partitioned datasets as tables."""

import re
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..schema import TABLE_PREFIX

THREADS = 8


def _quoted(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def _coins(spark: SparkSession, path: str) -> list[str]:
    """The coins with a `coin=` folder below `path`; this lists names only and reads no data."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [f.getPath().getName() for f in files if f.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith("coin="))


def table_name(coin: str, prefix: str = TABLE_PREFIX) -> str:
    """The table of a coin folder: lower case, `_` for all but letters a to z, digits and `_`."""
    return prefix.lower() + re.sub("[^a-z0-9_]", "_", unquote(coin).lower())


def _ddl(spark: SparkSession, fields) -> str:
    """Column definitions with their whole types; the short form of a type leaves fields out."""
    return spark.createDataFrame([], T.StructType(list(fields)))._jdf.schema().toDDL()


def register_tables(spark: SparkSession, path: str, database: str,
                    prefix: str = TABLE_PREFIX, threads: int = THREADS) -> list[str]:
    """One external table `<prefix><coin>` per coin folder below `path`; returns their names.

    Creates what is missing, finds new partitions, adds new columns to known tables, makes tables anew in which a column has
    another type than in the files (their data are the files', and stay), and marks
    tables whose folder is gone with the property `deprecated`. All tables have the columns of the whole tree: one job reads the
    footers of all files in its tasks, however many coins there are. A column with types in different files that cannot be one is an error
    that names it. Coins whose table names would be the same are refused. Catalog commands run in `threads` threads.
    """
    folders: dict[str, str] = {}
    for coin in _coins(spark, path):
        name = table_name(coin, prefix)
        if name in folders:
            raise ValueError(f"coins {folders[name]!r} and {coin!r} would both be table {name!r}")
        folders[name] = coin
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    known = {t.name for t in spark.catalog.listTables(database)}
    fields = spark.read.option("mergeSchema", True).parquet(path).schema.fields if folders else []
    # partition columns stand last, the coin's folder first among them
    place = next((i for i, f in enumerate(fields) if f.name == "coin"), len(fields))
    columns, partitions = fields[:place], fields[place + 1:]

    def register(name: str, coin: str) -> None:
        table, folder = _quoted(database, name), f"{path.rstrip('/')}/coin={coin}"
        present = {}
        if name in known:
            present = {f.name.lower(): f.dataType for f in spark.table(f"{database}.{_quoted(name)}").schema.fields}
            changed = [f.name for f in fields if f.name.lower() in present and present[f.name.lower()] != f.dataType]
            if changed:
                spark.sql(f"DROP TABLE {table}")
                present = {}
        if not present:
            location = folder.replace("\\", "\\\\").replace("'", "\\'")
            by = f"PARTITIONED BY ({', '.join(_quoted(f.name) for f in partitions)})" if partitions else ""
            spark.sql(f"CREATE TABLE {table} ({_ddl(spark, columns + partitions)}) USING parquet {by} LOCATION '{location}'")
        else:
            spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('deprecated')")
            new = [f for f in columns if f.name.lower() not in present]
            if new:
                spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_ddl(spark, new)})")
        if partitions:
            spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
        spark.catalog.refreshTable(f"{database}.{name}")

    def deprecate(name: str) -> None:
        spark.sql(f"ALTER TABLE {_quoted(database, name)} SET TBLPROPERTIES ('deprecated' = 'true')")

    gone = sorted(n for n in known if n.startswith(prefix.lower()) and n not in folders)
    with ThreadPoolExecutor(threads) as pool:
        list(pool.map(register, folders, folders.values()))
        list(pool.map(deprecate, gone))
    return list(folders)
