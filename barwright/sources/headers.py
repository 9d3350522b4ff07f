"""The headers of a tree of CSV files: which columns each file has, and which files cannot be read.

Every file is looked at, but only its first line: a task reads one file, or one part of a large one, and stops after the
first line with anything in it. What is known about files stays in a table; the driver gets one row for each different header.
"""

from __future__ import annotations

import csv
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.durable import cut

#: Layouts of which the driver gets every file; a header that each file spells differently is no header.
LAYOUTS = 10_000

_FIRST = pa.schema([("file", pa.string()), ("header", pa.string())])
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_DAY = r"^\d{4}-\d{1,2}-\d{1,2}"


def _text(spark: SparkSession, path: str, single: bool) -> DataFrame:
    """Lines of all `.csv` files below `path`; with `single` no task reads more than one file."""
    if single:
        spark = spark.newSession()  # its settings are its own
        spark.conf.set("spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(path)
            .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")))


def _first(batches):
    """The first line that is not blank of the file a task reads; the rest is not even fetched."""
    for batch in batches:
        lines, files, starts = (batch.column(i).to_pylist() for i in range(3))
        for line, file, start in zip(lines, files, starts):
            if start:
                return
            if line.strip("﻿ \t\r\n"):
                yield pa.RecordBatch.from_pylist([{"file": file, "header": line}], schema=_FIRST)
                return


def first_lines(spark: SparkSession, path: str) -> DataFrame:
    """file and header, its first line; for every file below `path` with a line that is not blank. Runs jobs."""
    found = cut(_text(spark, path, True).mapInArrow(_first, "file string, header string"), "headers")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(path)
             .select(F.col("_metadata.file_path").alias("file"), "length").where("length > 0"))
    left = cut(files.join(found, "file", "left_anti").select("file"), "headers")
    if left.isEmpty():
        return found
    # blank beginnings beyond a part of a file, or files that shared a task: these are read whole
    whole = (_text(spark, path, False).where(F.trim(F.translate("value", "﻿\t\r", "")) != "").join(left, "file")
             .withColumn("line", F.monotonically_increasing_id()).groupBy("file")
             .agg(F.min_by("value", F.struct("start", "line")).alias("header")))
    return cut(found.unionByName(whole), "headers")


def split_header(header: str, sep: str) -> list[str]:
    """The names in a header line, without quotes, white space around them and a byte order mark."""
    names = next(csv.reader([header.lstrip("﻿").rstrip("\r\n")], delimiter=sep, skipinitialspace=True))
    return [name.strip().strip('"') for name in names]


def bound_names(header: str, sep: str, known: list[str], required) -> tuple[list[str] | None, bool, str]:
    """Names for the columns of a file, whether its first line is a header, and else why it cannot be read.

    Names match those of the schema without regard to case. A header without any known name, or data in the first line, binds by
    position if there are as many columns as in the schema.
    """
    names = split_header(header, sep)
    spelled = {k.lower(): k for k in known}
    own = [spelled.get(n.lower(), n) for n in names]
    if any(k in own for k in known):
        twice = sorted({n for n in own if own.count(n) > 1 and n})
        lacking = [r for r in required if r not in own]
        if twice or lacking:
            return None, True, f"{', '.join(twice)} named twice" if twice else f"no column {', '.join(lacking)}"
        return [n or f"_c{i}" for i, n in enumerate(own)], True, ""
    data = any(re.match(_NUMBER, n) or re.match(_DAY, n) for n in names)
    if len(names) == len(known):
        return list(known), not data, ""
    return None, not data, "no known column name, and not as many columns as the schema"


def layouts(lines: DataFrame, sep: str, known: list[str], required) -> list[tuple]:
    """Of each different header, most frequent first: header, number of files, names, whether it is one, and why it cannot be read."""
    counts = lines.groupBy("header").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "header").limit(LAYOUTS + 1).collect()
    if len(counts) > LAYOUTS:
        raise ValueError(f"more than {LAYOUTS} different first lines, such as {counts[-1]['header'][:200]!r}: these files have no headers")
    return [(row["header"], row["n"], *bound_names(row["header"], sep, known, required)) for row in counts]
