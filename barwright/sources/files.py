"""Bars in CSV and Parquet trees."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import BAR_TEXT_SCHEMA
from .headers import first_lines, layouts

# The folder naming the coin: the file's parent, or its grandparent above a year folder. Plain
# and `key=value` folder names are both understood.
_COIN_FOLDER = r"/(?:coin=)?([^/=]+)/(?:(?:year=)?\d{4}/)?[^/]+$"


def _folder():
    """The coin's folder. File paths are URIs: a space reads %20, while a plus sign stands for itself."""
    found = F.regexp_extract(F.col("_metadata.file_path"), _COIN_FOLDER, 1)
    return F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B")))


def read_bars_csv(spark: SparkSession, path: str, *, sep=",", schema=BAR_TEXT_SCHEMA,
                  coin=True, file=False, required=None, unread=None) -> DataFrame:
    """All `.csv` files below `path`, columns bound by the names in each file's first line.

    Names are matched without regard to case; a first line without any known name, or with data, binds by position if it
    has as many columns as the schema. Columns of `schema` a file lacks are NULL; further columns are kept as text after those of
    the schema. A field that does not parse becomes NULL and its row is kept. `coin` adds the name of the
    folder the file lies in, `file` its path.

    No file is skipped: one that cannot be bound, because it lacks a `required` column (`datetime`, where the
    schema has it), names one twice or has no known name, is an error that names it. With `unread`, a folder, the lines
    of such files are written there instead, with `coin`, `file` and `reason`.

    Runs jobs that read the first line of each file. The files of the most frequent header are read by folder; the driver
    lists only those of others, and each header is one read.
    """
    types = {f.name: f.dataType for f in schema.fields}
    required = [c for c in ("datetime",) if c in types] if required is None else required
    lines = first_lines(spark, path)
    found = layouts(lines, sep, list(types), required)
    bad = [entry for entry in found if entry[2] is None]
    if bad and not unread:
        examples = lines.where(F.col("header").isin([h for h, *_ in bad])).limit(5).collect()
        raise ValueError("files that cannot be bound: " + "; ".join(
            f"{r['file']} ({next(why for h, *_, why in bad if h == r['header'])})" for r in examples))
    good = [entry for entry in found if entry[2] is not None]
    main = good[0][0] if good else None
    rest = lines.where(F.col("header") != main) if main else lines
    rest = rest.toLocalIterator() if len(found) > bool(main) else ()
    others: dict[str, list[str]] = {}
    for row in rest:
        others.setdefault(row["header"], []).append(row["file"])
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    if bad:
        _write_unread(reader, bad, others, path, unread)
    # headers that mean the same are one read
    parts: dict[tuple, list[str] | None] = {}
    for header, _, names, named, _ in good:
        known = parts.setdefault((tuple(names), named), [])
        if header == main:
            parts[tuple(names), named] = None
        elif known is not None:
            known += others[header]
    away = [f for key, files in parts.items() if files is not None for f in files]
    away += [f for header, *_ in bad for f in others.get(header, ())]

    def read(names, named, files):
        own = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
        options = spark.read.schema(own).option("header", named).option("sep", sep)
        if files is None:
            df = options.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(path)
            if away:  # the list of files is pruned, none of these is opened
                df = df.where(~F.col("_metadata.file_path").isin(away))
        else:
            df = options.csv([_plain(f) for f in files])
        columns = [F.col(f"`{c}`") if c in names else F.lit(None).cast(types[c]).alias(c)
                   for c in types]
        further = [F.col(f"`{c}`") for c in names if c not in types]
        return df.select(*columns, *further, *([_folder().alias("coin")] if coin else []),
                         *([F.col("_metadata.file_path").alias("file")] if file else []))

    if not parts:  # no file has a line, or none that can be bound
        return read(tuple(types), True, None).where(F.lit(not bad))
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                   [read(*key, files) for key, files in sorted(parts.items(), key=lambda p: p[1] is not None)])
    last = [c for c, wanted in (("coin", coin), ("file", file)) if wanted]
    return whole.select(*[F.col(f"`{c}`") for c in whole.columns if c not in last], *last)


def _write_unread(reader, bad, others, path: str, unread: str) -> None:
    why = {h: reason for h, *_, reason in bad}
    reasons = F.create_map(*[F.lit(x) for h in why for f in others[h] for x in (f, why[h])])
    lines = reader.text(path).where(F.col("_metadata.file_path").isin([f for h in why for f in others[h]]))
    lines.select(_folder().alias("coin"), F.col("_metadata.file_path").alias("file"), reasons[F.col("_metadata.file_path")].alias("reason"),
                 F.col("value").alias("line")).write.mode("overwrite").parquet(unread)


def _plain(uri: str) -> str:
    """A file URI as a path pattern that matches this file alone."""
    from urllib.parse import unquote

    plain = unquote(uri)
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in plain)


def typed_bars(df: DataFrame, data_type="timestamp") -> DataFrame:
    """Parses the `datetime` text; what does not parse becomes NULL (see `undated`)."""
    return df.withColumn("datetime", F.col("datetime").try_cast(data_type))


def read_bars_parquet(spark: SparkSession, path: str, *, coins=None, years=None) -> DataFrame:
    """A tree partitioned by `coin` and `year`; unwanted partitions are not even listed as input."""
    df = spark.read.parquet(path)
    if coins is not None:
        df = df.where(F.col("coin").isin(list(coins)))
    if years is not None:
        df = df.where(F.col("year").isin(list(years)))
    return df


def count_files(df: DataFrame, by=()) -> DataFrame:
    """How many files a scan reads, in all or per group. `df` must be a plain file scan."""
    return df.groupBy(*by).agg(F.countDistinct("_metadata.file_path").alias("n_files"))
